"""Every query of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from tallyloom.llm import align, bpe, chat, embeddings, media, mixing, quality, runs, secrets, simhash, tokens, urls, warc

MODULES = (simhash, mixing, urls, media, quality, secrets, warc, embeddings, chat, bpe, tokens, align, runs)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}
