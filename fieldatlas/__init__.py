"""fieldatlas: a three-level map of research fields, built as Spark jobs."""

__version__ = "0.1.0"
