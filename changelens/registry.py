"""All queries of the library but those of the subpackage llm, by name, with their SQL."""

from __future__ import annotations

from changelens.plans import lookups, more, patches, reports, scalars, sheets  # noqa: F401  (add their queries)
from changelens.plans.queries import ORACLE_SQL, QUERIES

FLAGSHIP = "a14_evidence_fold"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
