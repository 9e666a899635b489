"""millrace: a Spark-first engine that turns raw document sources into clean text corpora."""

__version__ = "0.1.0"
