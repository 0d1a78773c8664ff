"""Operators: DataFrame in, DataFrame out, nothing is run or written."""
