"""Access-log analytics on Spark: parsing, behaviour metrics, rule scoring, funnels and reports."""

__version__ = "0.1.0"
