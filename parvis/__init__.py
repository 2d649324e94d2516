"""City open-data analytics on Spark DataFrames: landing, cleaning, areas, indicators, serving."""

__version__ = "0.1.0"
