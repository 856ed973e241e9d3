"""plumbline: data-quality profiling, checks, scoring and drift as Spark jobs."""

__version__ = "0.1.0"
