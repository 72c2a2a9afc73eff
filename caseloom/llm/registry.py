"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, clustering, exact_dedup, line_dedup, mixing, ngram_join, packing, prefix_trie, quality, simhash, suffix_dedup, toxicity, vector_search

MODULES = (toxicity, suffix_dedup, quality, ngram_join, exact_dedup, packing, chat, line_dedup, vector_search, mixing, prefix_trie, clustering, simhash)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
