"""Entity-profile consolidation on Spark: extract, normalise, match, merge, enrich, write."""

__version__ = "0.1.0"
