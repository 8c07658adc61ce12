"""WARC archives with revisit records: equal payloads are stored once.

Headers alone are shuffled by payload digest to find each payload's original; pages then learn whether they revisit one, and tasks write
archives of their own, one gzip member a record. Reading joins revisit records to the original responses.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import new_path, stored, table, text_or_empty
from tallyloom.llm.files import Roll, stream

#: Payloads below this size are stored again each time.
LEAST_BYTES = 100
ARCHIVE_BYTES, LEVEL = 256 << 20, 1
# Fixed values of the format: the profile of a revisit with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


def resolve(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """(id_col, payload_bytes, digest, refers_to) of every row; refers_to is null for responses.

    Of rows with equal payloads of at least `least` bytes, those with the smallest id are responses. Null ids never are an original
    while another id is. digest is binary SHA-256. A hot payload is pre-aggregated, and only headers are shuffled.
    """
    payload = text_or_empty(html_col).cast("binary")
    heads = stored(pages.select(id_col, F.octet_length(payload).cast("long").alias("payload_bytes"), F.unhex(F.sha2(payload, 256)).alias("digest")), "heads", scan=True)
    first = heads.where(F.col("payload_bytes") >= least).groupBy("digest").agg(F.min(id_col).alias("original"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = heads.join(first, "digest", "left")
    return out.select(id_col, "payload_bytes", "digest", F.when(~F.col(id_col).eqNullSafe(F.col("original")), F.col("original")).alias("refers_to"))


def record(page_id, url: str | None, payload: bytes, digest: bytes, refers_to, date: str) -> bytes:
    """One record: WARC headers made afresh, HTTP headers, and for a response the payload. Signs that a header can't hold are escaped in the url."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest.hex()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None, **how) -> DataFrame:
    """(path, bytes) of the archives written; a stored table, since making it writes them. Names are never used by another attempt.

    A record a row: null html counts as empty, a null or empty url has no target header, and rows with a null id get records without a
    number in their id, which read back as null. Rows with equal ids are records of their own; if their payloads are equal too and they
    revisit another page, each is a revisit. Payloads of any length are written whole; an empty table writes no archive. Other columns
    are not read.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisits = resolve(pages, id_col, html_col, **how).where("refers_to IS NOT NULL").select(F.col(id_col).alias("_id"), F.col("digest").alias("_digest"), "refers_to").distinct()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    rows = rows.join(revisits, rows["id"].eqNullSafe(revisits["_id"]) & (rows["digest"] == revisits["_digest"]), "left").select("id", "url", "html", "digest", "refers_to")

    def run(batches):
        roll = Roll(folder, ".warc.gz", ARCHIVE_BYTES)
        for b in batches:
            for page_id, url, html, digest, refers_to in zip(*b.columns):
                data = record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), digest.as_py(), refers_to.as_py(), date)
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                roll.write(pack.compress(data) + pack.flush())
        roll.close()
        path, size = zip(*roll.done) if roll.done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(size, pa.int64())], ["path", "bytes"])

    return stored(rows.mapInArrow(run, "path string, bytes long"), "archives")


def members(path: str):
    """The gzip members of a file, one after another."""
    unpack, out = None, []
    for data in stream(path):
        while data:
            unpack = unpack or zlib.decompressobj(31)
            out.append(unpack.decompress(data))
            if not unpack.eof:
                break
            yield b"".join(out)
            data, unpack, out = unpack.unused_data, None, []
    if unpack is not None:
        raise ValueError(f"{path} ends within a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """WARC headers, by lower-case name, and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def read_archives(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to) of every record in the archives (path).

    A response's figures are taken from its payload. A revisit's length is that of the original response it is joined to, by record id
    and digest; it is null if the archives lack that response. Spark casts ids from text to id_type.
    """
    fields = {"page_id": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.string()}

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for data in members(path):
                    h, payload = parse(data)
                    name = lambda k: h[k][1:-1].removeprefix(ID) or None if k in h else None
                    new = h["warc-type"] == "response"
                    rows.append((name("warc-record-id"), h["warc-type"], len(payload) if new else None, hashlib.sha256(payload).hexdigest() if new else h["warc-payload-digest"].partition(":")[2], name("warc-refers-to")))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), fields.values())], list(fields))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), fields.values())], list(fields))

    files = archives.select("path").repartition(max(1, archives.count()))
    found = files.mapInArrow(run, "page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string")
    found = stored(found.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type), "payload_digest": F.unhex("payload_digest")}), "records")
    new, again = found.where("record_type = 'response'"), found.where("record_type = 'revisit'").drop("payload_bytes")
    originals = new.join(again.select(F.col("refers_to").alias("page_id"), "payload_digest").distinct(), ["page_id", "payload_digest"], "left_semi")
    originals = originals.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    rows = new.unionByName(again.join(originals, ["refers_to", "payload_digest"], "left"))
    return rows.withColumn("payload_digest", F.lower(F.hex("payload_digest")))


def op7_warc_revisits(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archives = write_archives(pages, new_path(spark, "warc"))
    return read_archives(archives, pages.schema["page_id"].dataType.simpleString()).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op7_warc_revisits": op7_warc_revisits}
ORACLE = {
    "op7_warc_revisits": f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, min(page_id) AS original FROM p WHERE payload_bytes >= {LEAST_BYTES} GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
  CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN o ON p.payload_digest = o.payload_digest AND payload_bytes >= {LEAST_BYTES}"""
}
