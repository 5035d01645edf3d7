"""Importing this fills the registry of the subpackage's queries."""

from cascara.llm.common import ORACLE, QUERIES  # noqa: F401
from cascara.llm import (  # noqa: F401
    alignment, chat, decontaminate, line_dedup, mixing, ngram_join, prefix_trie, quality_model, quality_rules, simhash,
    substring_dedup, token_counts, token_records,
)
