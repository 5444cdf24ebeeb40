"""Deposit run-off analytics on Spark."""
