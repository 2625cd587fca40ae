"""Checked, columnar movement of DataFrames into and out of SQL storage."""

__version__ = "0.1.0"
