"""Survey analytics on Spark: decode, consolidate and summarise survey microdata."""

__version__ = "0.1.0"
