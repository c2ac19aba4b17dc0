"""Tabular quality and rare-failure analytics as Spark jobs."""

from yieldloom.spec import EntitySpec

__all__ = ["EntitySpec"]
