"""Basketry: a PySpark library that turns shop clickstream events into a tested sales warehouse."""

__version__ = "0.1.0"
