"""Market-feed analytics on Spark: bars, book imbalance, oracle spread and peg alerts."""

__version__ = "0.1.0"
