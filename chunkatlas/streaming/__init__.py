"""Append new granules to a combined dataset, in batches or from a stream."""

from .append import CombinedStore

__all__ = ["CombinedStore"]
