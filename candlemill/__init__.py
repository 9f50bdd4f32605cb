"""candlemill: growth-rate reports over price ticks, written for Spark."""

__version__ = "0.1.0"
