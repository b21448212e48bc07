"""Risk-table toolkit on Spark DataFrames: ingest, audit, split, prepare, score, compare, monitor."""

__version__ = "0.1.0"
