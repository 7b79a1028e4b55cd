"""Spark operators for preparing, checking, modelling and scoring tabular data."""

__version__ = "0.1.0"
