"""Operators: DataFrame in, DataFrame out, with keys, time and value columns as parameters."""
