"""Relational operators: DataFrame(s) in, DataFrame out; column names are parameters."""
