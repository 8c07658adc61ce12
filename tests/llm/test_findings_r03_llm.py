"""What the findings of the third review named, in the corpus operators."""

import numpy as np
from test_llm import DOCS, document

from tallyloom.llm import shingles


def test_fingerprints_find_near_duplicates_of_the_pipeline(spark):
    """the stage is SimHash first. Texts that differ in one word of 400 are linked by it, and what it links is checked exactly."""
    rng = np.random.default_rng(4)
    base = [document(rng, 400) for _ in range(20)]
    edited = [" ".join(x if i != 200 else "omega" for i, x in enumerate(t.split())) for t in base]  # similar to 0.97 and more
    rows = [*base, *edited, *[document(rng, 4) for _ in range(20)], "", None]
    docs = spark.createDataFrame([(i, t, "en", "src", 1) for i, t in enumerate(rows)], DOCS)
    sketches = shingles.sketches(docs, "doc_id", "text")
    nodes = {r.id: r.node for r in sketches.collect()}
    classes = sketches.selectExpr("node", "struct(id, hash) AS first", "chars", "fp", "keys")
    keyed = shingles.fingerprint_keys(classes)
    k = {}
    for r in keyed.collect():
        k.setdefault(r.node, set()).add(r.k)
    together = [i for i in range(20) if k[nodes[i]] & k[nodes[20 + i]]]
    assert len(together) >= 15 and nodes[60] not in k  # radius 4 misses some; a text without words has no fingerprint
    linked = {frozenset(r) for r in shingles.similarity_links(docs, keyed, "doc_id", "text").collect()}
    assert linked == {frozenset((nodes[i], nodes[20 + i])) for i in together}
