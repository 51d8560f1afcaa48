"""All named queries."""

from . import discovery, documents, filters, matching, streams  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
