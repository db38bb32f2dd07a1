"""Cutting lineage in the folder that all machines share."""

from tallyweave.folders import checkpoint, rewritten

__all__ = ["checkpoint", "rewritten"]
