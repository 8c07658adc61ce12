"""Media columns: payloads as grey PNG images in tar shards, addressed by content.

A payload's bytes are the image's 8-bit samples, 64 to a row. A member's name is the digest of its bytes, and a shard holds a digest
once; rows carry digest, shard, offset and length. Metadata columns come from range reads of the images' headers alone.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import new_path, stored, table
from tallyloom.llm.files import Ranges, Roll

WIDTH, LEVEL = 64, 1
#: A tar shard's size at most, where it holds more than one member.
SHARD_BYTES = 256 << 20
#: Bytes of members that one reading task takes at least, and such tasks at most.
READ_BYTES, READ_TASKS = 8 << 20, 50_000
# Fixed values of the PNG format: signature, and bytes up to the end of the header chunk.
SIGNATURE, HEADER_BYTES = b"\x89PNG\r\n\x1a\n", 33


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes filled up with zeros to a positive multiple of WIDTH, and their number before that."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(1, -(-len(raw) // WIDTH)) * WIDTH, b"\0"), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    plain = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each row begins with its filter: none
    plain[:, 1:] = rows
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(plain.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def header_of(head: bytes) -> tuple[int, int, int]:
    """Width, height and bits a sample, from an image's first HEADER_BYTES."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">IIB", head[16:25])


def from_png(image: bytes) -> bytes:
    width, height, _ = header_of(image)
    at, packed = 8, []
    while at < len(image):
        (n,), kind = struct.unpack(">I", image[at : at + 4]), image[at + 4 : at + 8]
        data = image[at + 8 : at + 8 + n]
        if struct.unpack(">I", image[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + data):
            raise ValueError("a PNG chunk is damaged")
        if kind == b"IDAT":
            packed.append(data)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    return rows[:, 1:].tobytes()


def _member(name: str, data: bytes) -> tuple[bytes, int]:
    """A tar member with its header and padding, and the offset of its data."""
    info = tarfile.TarInfo(name)
    info.size = len(data)
    head = info.tobuf(tarfile.USTAR_FORMAT)
    return head + data + b"\0" * (-len(data) % tarfile.BLOCKSIZE), len(head)


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, digest, shard, offset, length) for every row; a stored table, since making it writes the shards.

    Each task writes shards of its own under names no other attempt uses, so a task run again leaves unused shards but no wrong rows.
    A null text counts as empty. Within a shard equal payloads are one member; rows of other shards are brought to one member of each
    digest by `objects`.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        roll = Roll(folder, ".tar", SHARD_BYTES, tail=b"\0" * 2 * tarfile.BLOCKSIZE)
        held: dict[bytes, tuple] = {}
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                rows = []
                for text in part.column(1):
                    payload, n = payload_of(text.as_py())
                    key = hashlib.sha256(payload).digest()
                    if key not in held:
                        image = to_png(payload)
                        digest = hashlib.sha256(image).hexdigest()
                        member, skip = _member(f"{digest}.png", image)
                        path, at, new = roll.write(member)
                        if new:
                            held.clear()
                        held[key] = (digest, path, at + skip, len(image))
                    rows.append((n, *held[key]))
                n, digest, path, at, size = map(list, zip(*rows)) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(path, pa.string()), pa.array(at, pa.int64()), pa.array(size, pa.int64())], ["id", "n_bytes", "digest", "shard", "offset", "length"])
        roll.close()

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, n_bytes long, digest string, shard string, offset long, length long")
    return stored(out, "media", scan=True).withColumnRenamed("id", id_col)


def objects(rows: DataFrame) -> DataFrame:
    """(digest, shard, offset, length): one place for each digest."""
    place = F.min(F.struct("shard", "offset", "length")).alias("at")
    return rows.groupBy("digest").agg(place).select("digest", "at.shard", "at.offset", "at.length")


def _by_place(places: DataFrame) -> DataFrame:
    """Neighbouring members go to one task, READ_BYTES of them; the number of tasks follows the bytes stored, up to READ_TASKS."""
    places = stored(places, "objects")
    total = places.agg(F.sum("length")).first()[0] or 0
    return places.repartitionByRange(max(1, min(READ_TASKS, -(-total // READ_BYTES))), "shard", "offset").sortWithinPartitions("shard", "offset")


def _read(places: DataFrame, fields: str, length, made) -> DataFrame:
    """places with `fields` made of the first length(row) bytes of each member."""
    names, more = places.columns, [f.split() for f in fields.split(", ")]
    arrow = {"long": pa.int64(), "string": pa.string()}
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in places.schema.fields)

    def run(batches):
        ranges = Ranges()
        for b in batches:
            shard, at, size = (b.column(names.index(c)).to_pylist() for c in ("shard", "offset", "length"))
            out = [made(ranges.read(p, o, length(n))) for p, o, n in zip(shard, at, size)]
            columns = map(list, zip(*out)) if out else [[] for _ in more]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, arrow[t]) for c, (_, t) in zip(columns, more))], [*names, *(n for n, _ in more)])
        ranges.close()

    return places.mapInArrow(run, f"{schema}, {fields}")


def with_metadata(places: DataFrame) -> DataFrame:
    """places with width, height and bits, each from a range read of the header only."""
    return _read(places, "width long, height long, bits long", lambda n: min(n, HEADER_BYTES), header_of)


def features_of(image: bytes) -> tuple:
    payload = from_png(image)
    x = np.frombuffer(payload, np.uint8)
    counts = np.bincount(x, minlength=256)
    share = counts[counts > 0] / len(x)
    feature = f"mean={x.mean():.3f};sd={x.std():.3f};values={len(share)};zeros={counts[0]};bits={-(share * np.log2(share)).sum():.3f}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), feature


def with_features(places: DataFrame) -> DataFrame:
    """places with digests and features of the payloads, read back from the shards and decoded."""
    return _read(places, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", lambda n: n, features_of)


def media_columns(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: where its media lies, the header's metadata, and digests and features of what was read back.

    Equal texts give equal values, null and empty ones too (one row of zeros). An empty table gives an empty result; rows with equal ids
    keep their own values. Other columns are not read.
    """
    rows = write_shards(docs, folder or new_path(docs.sparkSession, "shards"), id_col, text_col)
    read = with_features(with_metadata(_by_place(objects(rows))))
    return rows.select(id_col, "n_bytes", "digest").join(read, "digest", "left")


def op4_media_columns(spark, sf_dir):
    out = media_columns(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bits", F.col("digest").alias("address"))


QUERIES = {"op4_media_columns": op4_media_columns}
ORACLE: dict[str, str] = {}
