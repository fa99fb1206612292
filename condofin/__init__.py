"""condofin: building-administration finance reports as Spark jobs."""

__version__ = "0.1.0"
