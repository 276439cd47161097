"""Queries of the subpackage and their DuckDB SQL, one module per operator."""

from __future__ import annotations

from sitecast.llm import (q_bpe, q_chat, q_counts, q_decontam, q_html, q_join, q_licenses, q_lines, q_lm, q_quality,
                          q_search, q_spelling, q_tokens)

MODULES = (q_tokens, q_html, q_chat, q_bpe, q_join, q_quality, q_decontam, q_lm, q_counts, q_licenses, q_search, q_spelling,
           q_lines)

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
