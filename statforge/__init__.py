"""Medallion-style entity statistics on Spark: every public function maps DataFrames to DataFrames."""

__version__ = "0.1.0"
