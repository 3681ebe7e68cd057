"""Operators: DataFrame-in, DataFrame-out functions, one per output table."""
