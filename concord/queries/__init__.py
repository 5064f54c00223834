"""Queries over the given tables, one per operator, with equivalent SQL."""

from concord.queries import cells, keyed, landed, merging, stored  # noqa: F401
from concord.queries.base import REGISTRY

__all__ = ["REGISTRY"]
