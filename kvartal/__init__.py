"""Kvartal: classified-ad listings to an analytics-ready star schema, on Spark."""

__version__ = "0.1.0"
