"""Text attribution and stylometry on Spark DataFrames."""

__version__ = "0.1.0"
