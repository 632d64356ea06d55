"""All registered queries and their oracle SQL, merged from the topic modules."""

from __future__ import annotations

from strata.plans import flagship, q_clean, q_io, q_ml, q_panel, q_stats

MODULES = [(q_panel.QUERIES, q_panel.ORACLE), (q_clean.QUERIES, q_clean.ORACLE),
           (q_stats.QUERIES, q_stats.ORACLE),
           (q_io.QUERIES, q_io.ORACLE), (q_ml.QUERIES, q_ml.ORACLE),
           (flagship.QUERIES, flagship.ORACLE)]

QUERIES: dict = {}
ORACLE: dict = {}
for _q, _s in MODULES:
    dup = set(_q) & set(QUERIES)
    if dup:
        raise RuntimeError(f"duplicate query keys {dup}")
    QUERIES.update(_q)
    ORACLE.update({k: v for k, v in _s.items() if k in _q})
