"""Bindings of the operators to the driver tables."""

from flowwarden.bindings import blocking, detection, features, files, model, streams  # noqa: F401
from flowwarden.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
