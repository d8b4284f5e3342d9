"""Operators: DataFrame in, DataFrame out; time and parameters are arguments."""
