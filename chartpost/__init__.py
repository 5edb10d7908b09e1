"""Deliver analytics results to health-record endpoints with Spark."""

__version__ = "0.1.0"
