"""Weftline: DataFrame operators for curated text-normalisation corpora."""

__version__ = "0.1.0"
