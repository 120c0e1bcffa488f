"""Layered policy-and-claims analytics on PySpark DataFrames."""

from strata.session import get_spark

__all__ = ["get_spark"]
