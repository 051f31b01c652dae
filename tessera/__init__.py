"""tessera: a Spark engine for corpora of regulatory filings."""

__version__ = "0.1.0"
