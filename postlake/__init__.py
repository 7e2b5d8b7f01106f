"""postlake: a Spark-native story lake -- ingestion, curation, features,
models, vectors and search as DataFrame / SQL / MLlib / Structured
Streaming jobs."""

__version__ = "0.1.0"
