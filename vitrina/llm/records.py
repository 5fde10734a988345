"""Token ids as length-delimited binary records, with a separate offset index.

File format (all numbers little-endian), record after record:

    u64  length of the payload
    u32  masked CRC-32 of those 8 bytes
         payload:  u8 flags (1: the key is not NULL) | i64 key | u8 bytes per id (2 or 4) | ids
    u32  masked CRC-32 of the payload
    u8   0x0A, the end of the record

masked(c) = rotate c right by 15 bits, then add 0xA282EAD8, modulo 2**32: a checksum
that is itself part of checked data stays a good checksum.

``<path>/data`` holds the shards, ``<path>/index`` (Parquet) one row for each record
with shard, byte offset and length, so that a shuffled read can take any record
without reading the others.  Shards are range partitions of the key, each sorted
by it: shard order is key order.  The text writer of Spark writes the bytes
(its commit protocol makes retried and speculative tasks harmless, and it
reaches any file system that Spark reaches).  A shard holds about ``SHARD_BYTES`` of
the table's files (a table of more than ``MAX_SHARDS`` such shards has larger ones) and is
read back as one value.

Defined results: NULL or empty text has only the end id; NULL keys come first;
repeated keys are ordered by the hash of their text, then by it.  An empty table gives no records.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vitrina.llm.pieces import ByteLevelEncoder, encode_texts, release_encoders, row_runs, worker_encoder
from vitrina.operators.broadcast import estimated_bytes

SHARD_BYTES, MAX_SHARDS = 64 << 20, 100_000
HEAD, FOOT, KEY = struct.Struct("<QI"), struct.Struct("<IB"), struct.Struct("<BqB")
INDEX_SCHEMA = "shard string, record bigint, doc_id bigint, offset bigint, length bigint, n_tokens bigint"
RECORD_SCHEMA = "shard string, record bigint, doc_id bigint, n_tokens bigint, ids binary"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray) -> bytes:
    """One record."""
    small = ids.astype("<u2") if not len(ids) or ids.max() < 65536 else ids.astype("<u4")
    payload = KEY.pack(key is not None, key or 0, small.itemsize) + small.tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + FOOT.pack(masked_crc(payload), 10)


def unframe(data: bytes | memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """(key, ids as unsigned 32-bit, offset of the next record); ValueError where a checksum fails."""
    length, crc = HEAD.unpack_from(data, offset)
    if masked_crc(data[offset:offset + 8]) != crc:
        raise ValueError(f"damaged record length at byte {offset}")
    start = offset + HEAD.size
    payload = data[start:start + length]
    crc, end = FOOT.unpack_from(data, start + length)
    if masked_crc(payload) != crc or end != 10:
        raise ValueError(f"damaged record at byte {offset}")
    has_key, key, width = KEY.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=KEY.size).astype("<u4")
    return key if has_key else None, ids, start + length + FOOT.size


def write_records(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, write shards and index under ``path``."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The hash parts a key that many rows share (or that is NULL) over several shards, in order.
    ranges = [F.col("doc_id"), F.xxhash64("text")]
    shards = min(MAX_SHARDS, estimated_bytes(src) // SHARD_BYTES + 1)
    many = shards > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = src.repartitionByRange(shards, *ranges) if many else src.repartitionByRange(*ranges)
    src = src.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(ByteLevelEncoder, tokenizer_path)
        for batch in row_runs(batches):
            out, size = [], 0
            ids_of = encode_texts(encoder, batch.column(1).to_pylist())
            for key, ids in zip(batch.column(0).to_pylist(), ids_of):
                out.append(frame(key, np.append(ids, np.uint32(end_id))))
                size += len(out[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
            del out, ids_of  # before the memory is given back

    # The record's last byte is the writer's line end.
    (src.mapInArrow(frames, "frame binary")
     .select(F.expr("cast(substring(frame, 1, length(frame) - 1) as string)").alias("value"))
     .write.option("lineSep", "\n").text(f"{path}/data"))
    index = _shards(df.sparkSession, path).mapInArrow(_scan(INDEX_SCHEMA), INDEX_SCHEMA)
    index.write.parquet(f"{path}/index")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
            .select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content"))


def _scan(schema: str):
    """A function that reads whole shards and gives the columns named in ``schema``."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()  # a whole shard needs the room
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, offset, record, rows, size = memoryview(content.as_buffer()), 0, 0, [], 0
                while offset < len(data):
                    key, ids, after = unframe(data, offset)
                    row = {"shard": shard, "record": record, "doc_id": key, "offset": offset, "length": after - offset,
                           "n_tokens": len(ids)}
                    if "ids" in names:
                        row["ids"] = ids.tobytes()
                    if "ids_crc32" in names:
                        row["ids_crc32"] = zlib.crc32(ids.tobytes())
                    rows.append([row[n] for n in names])
                    size += (after - offset) * ("ids" in names) + 64
                    offset, record = after, record + 1
                    if size > 8_000_000:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
                yield _batch(rows, names, types)

    return scan


def _batch(rows: list, names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """shard, record, doc_id, offset, length, n_tokens, and start: the ids of all records before.

    The running sum goes over the shards (one row each), then inside each shard."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    return _with_start(index)


def _with_start(records: DataFrame) -> DataFrame:
    part = F.regexp_extract("shard", r"part-(\d+)", 1).cast("long")
    piece = F.coalesce(F.regexp_extract("shard", r"-c(\d+)", 1).cast("long"), F.lit(0))
    sums = records.groupBy("shard").agg(F.sum("n_tokens").alias("__sum"))
    before = Window.orderBy(part, piece).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("shard", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("shard").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    return (records.withColumn("__in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(bases, "shard").withColumn("start", F.col("__base") + F.col("__in")).drop("__base", "__in"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records with their ids, checksums checked."""
    return _shards(spark, path).mapInArrow(_scan(RECORD_SCHEMA), RECORD_SCHEMA)


def read_at(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """The records that ``index`` (shard, offset, ...) names, in any order: each shard is opened
    once, and only the named records are decoded."""
    wanted = index.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("offset", "record"))).alias("wanted"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "record", "doc_id", "n_tokens", "ids"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for shard, content, wants in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = memoryview(content.as_buffer())
                rows = []
                for w in wants:
                    key, ids, _ = unframe(data, w["offset"])
                    rows.append([shard, w["record"], key, len(ids), ids.tobytes()])
                yield _batch(rows, names, types)

    return _shards(spark, path).join(wanted, "shard").mapInArrow(take, RECORD_SCHEMA)


def record_digest(spark: SparkSession, path: str) -> DataFrame:
    """Of each record as it is read back: doc_id, start, n_tokens, crc32 of its ids (32 bits each),
    and where it lies (shard, offset)."""
    schema = "shard string, record bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"
    read = _shards(spark, path).mapInArrow(_scan(schema), schema)
    starts = read_index(spark, path).select("shard", "record", "start")
    return read.join(starts, ["shard", "record"])
