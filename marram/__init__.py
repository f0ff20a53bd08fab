"""Feature tables, training, scoring and monitoring as ordinary Spark jobs."""

__version__ = "0.1.0"
