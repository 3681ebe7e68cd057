"""Inputs: parquet scans of the driver's tables and the eight derived input tables."""

from .fixtures import FIXTURES, Inputs, build, oracle_ctes
from .schemas import SCHEMAS, TableInputs, conform
from .tables import TABLES, read

__all__ = ["FIXTURES", "Inputs", "SCHEMAS", "TABLES", "TableInputs", "build", "conform",
           "oracle_ctes", "read"]
