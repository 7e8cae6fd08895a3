"""spanlake: entity extraction and span analytics over document collections, on Spark DataFrames."""

__version__ = "0.1.0"
