"""Accounting-ledger analytics on Spark DataFrames."""
