"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from glossarium.llm import p1_characters, p2_terms, p3_copies, p4_senses, p5_near, p7_containers, p8_leaks, p9_subjects

_MODULES = (p1_characters, p2_terms, p3_copies, p4_senses, p5_near, p7_containers, p8_leaks, p9_subjects)
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in _MODULES for k, s in m.SQL.items()}
