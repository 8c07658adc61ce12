"""A corpus pipeline: quality, near-duplicates, secrets, mixture, tokens. Each stage takes what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, mixing, quality, secrets, shingles, simhash
from tallyloom.llm.common import stored, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Every row is judged by its whole text, null as empty, repeated ids each by itself; other columns are kept and not looked at. An
    empty table stays empty; without usable labels every score is 0.5 and all rows stay.
    """
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, by five-word shingles of similarity 0.8, the document with the smallest id stays.

    doc_id must be an integer; of rows with equal ids one stays, and so does every row without an id. Null, empty and blank texts are
    one class, of which one document stays; texts of any length are compared whole. An empty table stays empty.
    """
    return simhash.keep_one(docs, by=shingles.near_duplicates)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that few owners have are replaced in the text; n_chars, where there is such a column, follows.

    Null texts stay null and so does their n_chars; rows with equal or null ids keep their own texts, of any length. Null sources and
    languages count as one. An empty table stays empty.
    """
    out = secrets.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources come near their target weights; the order is shuffled.

    A null source is a source; rows with equal ids draw equal counts, a null id draws as the text 'null'. Columns called copy_no or
    shuffle_key are not kept. An empty table stays empty.
    """
    docs = docs.drop("copy_no", "shuffle_key")
    return mixing.mix(docs).select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the token ids of the whole text; a null or empty text has none. Every row by itself, so ids may repeat or be null."""
    return bpe.encode(docs.select("doc_id", "source", "text"))


STAGES = [
    ("quality classifier", reject_low_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("byte-level bpe", tokenise),
]

#: The classifier, the fingerprints' components and the encoder are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
