"""martloom: a retail and finance star-schema toolkit written as Spark jobs."""

__version__ = "0.1.0"
