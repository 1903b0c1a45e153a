"""Importing this module registers every query of this folder."""

from staylens.llm import bpe, huffman, jaccard, mixing, pivots, projections, quality, repeats, trie, urls, vcodes, warc, wrappers  # noqa: F401
from staylens.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
