"""All queries of this subpackage (importing a module registers its queries)."""

from concord.llm import conversations, decontaminate, embeddings, packing, pages, pii, sharding, simhash, spelling, substrings, token_files, toxicity, warc  # noqa: F401
from concord.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
