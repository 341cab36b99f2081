"""All registered queries."""

from amihan.catalog import (  # noqa: F401
    detections,
    expressions,
    extensions,
    marts,
    quality,
    relational,
    sources,
)
from amihan.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
