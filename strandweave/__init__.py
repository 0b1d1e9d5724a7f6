"""strandweave: record linkage on Spark, plus an optional training-data toolkit in ``strandweave.llm``."""

__version__ = "0.1.0"
