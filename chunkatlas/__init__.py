"""Chunk manifests of very large collections of array files, as Spark tables."""

from .schemas import Dataset, Manifest
from .session import build_session, prepare

__all__ = ["Dataset", "Manifest", "build_session", "prepare"]
