"""Customer analytics over a transaction ledger, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
