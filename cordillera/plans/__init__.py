"""Whole plans over the star-schema tables, composed of operators."""
