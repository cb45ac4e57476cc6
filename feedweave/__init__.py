"""feedweave: data-feed preparation written as plain Spark DataFrame code."""

__version__ = "0.1.0"
