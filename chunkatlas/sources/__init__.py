"""Catalog search, per-file manifests, reference files, arrays and listings."""
