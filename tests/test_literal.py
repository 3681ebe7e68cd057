"""The plain forms that the bench times give the same tables."""

from __future__ import annotations

import pytest

from compare import compare, duck
from conftest import SF001
from rxreach.plans.literal import LITERAL
from rxreach.plans.oracle import oracle_sql
from rxreach.sources import Inputs


@pytest.mark.parametrize("key", sorted(LITERAL))
def test_literal_form_equals_the_oracle(spark, key):
    got = LITERAL[key](Inputs(spark, SF001))
    ok, msg = compare(got, duck(SF001), oracle_sql()[key])
    assert ok, msg
