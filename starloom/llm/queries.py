"""All operators' queries; importing this module registers them."""

from __future__ import annotations

from . import audit, centroids, chat, counting, forest, language, mixing, packing, paths, pii, quality, sharding, topk  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
