"""Retail lakehouse data operators expressed as Spark DataFrame and stream plans."""

__version__ = "0.1.0"
