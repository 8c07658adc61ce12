"""Every query of the library's own operators, and the SQL that computes the same rows."""

from __future__ import annotations

from tallyloom.operators import contracts, coverage, cumulative, documents, emit, enrich, grids, history, identity, labels, ledger, manifest, orders, parsed, people, ranges, report, stores, summaries, transfers, triage, trust, verify
from tallyloom.plans import weekly
from tallyloom.streaming import ingest

MODULES = (cumulative, enrich, history, report, ledger, trust, people, identity, transfers, orders, summaries, labels, grids, verify, emit, contracts, stores, manifest, ranges, parsed, documents, triage, coverage, weekly, ingest)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}
