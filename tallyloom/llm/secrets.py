"""Secret scans over whole texts, and how widely each candidate is owned across the corpus.

Base spans come from fixed patterns. Every candidate value is hashed; the hashes are counted by distinct repositories and owners over
the whole corpus. A value in many repositories of many owners is a copied example; one that few own looks live and gets one more span.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored, table

# The patterns of the three kinds, and the least length of what each finds.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "live")

#: A value looks live unless it has more owners than this, and is in more repositories than this: only then it is a copied example.
OWNERS, REPOSITORIES = 2, 3

_assign, _access, _hex = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)
#: Holds wherever a base span can be; texts without it need no scan and meet no join.
MAY = r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}"
CANDIDATES = "array<struct<kind:int,start:int,end:int,value:long>>"


def find(text: str | None) -> list[tuple[int, int, int, int]]:
    """(kind index, start, end, hash of the value) of every base span, by start, then kind. Code points, end exclusive."""
    t = text or ""
    key = lambda s: xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)
    found = [(0, m.start(), m.end(), key(m[2])) for m in _assign.finditer(t) if len(m[2]) >= LEAST["assign"]]
    found += [(1, m.start(), m.end(), key(m[0])) for m in _access.finditer(t) if len(m[0]) >= LEAST["access"]]
    found += [(2, m.start(), m.end(), key(m[0])) for m in _hex.finditer(t)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def digest(found: list[tuple[int, int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in found).encode()).hexdigest()


def base_spans(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` of every row, with its base spans (found) and their digest (base_sha256). A null text counts as empty."""
    kinds = docs.select(*keep)
    names = [*keep, "found", "base_sha256"]
    struct = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64())]))

    def run(batches):
        for b in batches:
            found = [find(x.as_py()) for x in b.column(b.num_columns - 1)]
            rows = pa.array([[dict(zip(("kind", "start", "end", "value"), y)) for y in x] for x in found], struct)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], rows, pa.array([digest(x) for x in found], pa.string())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.schema.fields)
    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, f"{schema}, found {CANDIDATES}, base_sha256 string")


def ownership(found: DataFrame, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """(value, owners, repositories, live) of every candidate hash in found(_owner, _repository, found); null counts as one owner."""
    each = found.select(F.explode("found.value").alias("value"), F.coalesce("_owner", F.lit("")).alias("o"), F.coalesce("_repository", F.lit("")).alias("r")).distinct()
    counts = each.groupBy("value", "o").agg(F.count("*").alias("r")).groupBy("value").agg(F.count("*").alias("owners"), F.sum("r").alias("repositories"))
    return counts.withColumn("live", (F.col("owners") <= owners) | (F.col("repositories") <= repositories))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None, repository: Column | None = None, **bounds) -> DataFrame:
    """One row per row of docs: id_col, found (base spans with kind index and value hash), base_sha256, live (the found spans that look live).

    owner and repository are string columns, by default source, and source with language; repositories are counted within their owner.
    Two spans with equal values get one class. Empty and null texts have no spans; an empty table gives an empty result; rows with
    equal ids keep their own spans. Other columns are not read.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    narrow = docs.select(F.col(id_col).alias("_id"), owner.alias("_owner"), repository.alias("_repository"), F.col(text_col).alias("_text"))
    found = stored(base_spans(narrow, ["_id", "_owner", "_repository"], "_text").withColumn("_row", F.monotonically_increasing_id()), "secrets", scan=True)
    live = ownership(found, **bounds).where("live").select("value")
    spans = found.select("_row", F.explode("found").alias("s")).select("_row", "s", F.col("s.value").alias("value")).join(live, "value", "left_semi")
    spans = spans.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("s.start", "s.end"))).alias("live"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return found.join(spans, "_row", "left").select(F.col("_id").alias(id_col), "found", "base_sha256", F.coalesce("live", none).alias("live"))


def spans_text(found: Column, live: Column) -> Column:
    """All spans as kind:start:end, by start, then kind, joined by commas."""
    base = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    more = F.transform(live, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index("live")).alias("kind"), s["end"].alias("end")))
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(F.concat(base, more)), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "<secret>", **how) -> DataFrame:
    """docs with every live-looking span of text_col replaced by mark; overlapping spans become one. Copied examples stay.

    Rows without live spans keep their text, null texts included. Spans meet their rows by id and the text's hash, so ids may repeat or
    be null. Texts that can hold no secret are neither scanned nor shuffled.
    """
    may = F.coalesce(F.col(text_col).rlike(MAY), F.lit(False))
    some = docs.where(may)
    key = [F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash")]
    rows = some.select(F.struct(*docs.columns).alias("d"), *key)
    own = some.select(F.struct(*key).alias("key"), text_col, *[c for c in ("source", "lang") if c in docs.columns])
    live = scan(own, "key", text_col, **how).where(F.size("live") > 0).select(F.col("key.id").alias("i"), F.col("key.hash").alias("h"), "live").dropDuplicates(["i", "h"])
    out = rows.join(live, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")), "left")
    text = F.col("d")[text_col]
    text = F.when(F.col("live").isNotNull(), cut(text, F.col("live"), mark)).otherwise(text)
    return out.select(*[(text if c == text_col else F.col("d")[c]).alias(c) for c in docs.columns]).unionByName(docs.where(~may))


def cut(text: Column, spans: Column, mark: str) -> Column:
    """text with the sorted spans replaced by mark, one mark for spans that touch or overlap."""
    whole = F.array().cast("array<struct<start:int,end:int>>")

    def merge(a, s):
        last = F.get(a, F.size(a) - 1)
        longer = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(a) > 0) & (s["start"] <= last["end"]), longer).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    def parts(gaps):
        before = lambda i: F.coalesce(F.get(gaps, i - 1)["end"], F.lit(0))
        kept = F.transform(F.sequence(F.lit(0), F.size(gaps)), lambda i: F.substring(text, before(i) + 1, F.coalesce(F.get(gaps, i)["start"], F.length(text)) - before(i)))
        return F.array_join(kept, mark)

    return F.get(F.transform(F.array(F.aggregate(spans, whole, merge)), parts), 0)


def op6_secret_scans(spark, sf_dir):
    rows = scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", n("assign"), n("access"), n("hex"), "base_sha256", spans_text(F.col("found"), F.col("live")).alias("spans"), F.size("live").cast("long").alias("n_live"))


QUERIES = {"op6_secret_scans": op6_secret_scans}
ORACLE: dict[str, str] = {}
