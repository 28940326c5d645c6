"""Spark-first lakehouse and star-schema toolkit: raw, conformed and star layers as lazy DataFrames."""

__version__ = "0.1.0"
