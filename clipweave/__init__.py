"""clipweave: curation and analysis of speech corpora as Spark DataFrame plans."""

__version__ = "0.1.0"
