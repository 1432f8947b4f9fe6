"""Tabular risk screening on Spark: profile, clean, split, prepare, train, evaluate and score."""

__version__ = "0.1.0"
