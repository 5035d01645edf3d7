"""The query catalog: one named Spark query per operator of the inventory,
each with the DuckDB SQL that computes the same result where SQL can.

Conventions for comparable results: every computed column is aliased with the
same name on both sides, counts are BIGINT, doubles are rounded to 6 places.
"""

from cascara.plans.registry import ORACLE, QUERIES, query, r6  # noqa: F401

# Importing the query modules fills the registries.
from cascara.plans import q_tables, q_text, q_items, q_segments, q_ml, q_facts, q_io  # noqa: E402,F401
