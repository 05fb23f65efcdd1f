"""Marketplace seller analytics as Spark DataFrame transformations."""

from marketlens.session import configure

__all__ = ["configure"]
