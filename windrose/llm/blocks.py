"""Documents in buckets, and small messages between buckets and shards of a key space.

Operators that look for text which repeats anywhere need to ask about every window of every document, and to hear back.
Rows for windows would outweigh the corpus. Instead documents are dealt once to buckets of a few MB, as compressed Arrow
blocks. A bucket's task makes one message for each shard of the hash space, with the bucket's distinct hashes in order;
a shard's task meets the messages of all buckets, and answers each bucket with a few bits for each hash, in that order.
A bucket sends each distinct hash once, so a window that stands in a third of all documents makes one entry for each
bucket. Tasks hold one bucket, or the messages of one shard; the number of either grows with the input.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, give_back, giving_back, shuffle_partitions, text_bytes

#: bytes of text in a bucket, on average
BUCKET_BYTES = 8 << 20
#: bytes of text that a task gathers before it writes blocks
GATHER_BYTES = 24 << 20

MESSAGE = "kind int, bucket int, shard int, data binary"


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed message: bytes of equal weight stand together, as they compress best."""
    head = json.dumps([(k, v.dtype.str, len(v)) for k, v in arrays.items()]).encode()
    planes = [np.ascontiguousarray(v).view(np.uint8).reshape(len(v), -1).T.tobytes() if len(v) else b"" for v in arrays.values()]
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(planes))


def unpack(data: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = {}
    for name, kind, n in json.loads(raw[4:at]):
        kind = np.dtype(kind)
        size = n * kind.itemsize
        out[name] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T).view(kind).reshape(n)
        at += size
    return out


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending whole numbers as differences, in as few bytes as hold the largest."""
    gaps = np.diff(values, prepend=np.zeros(1, values.dtype))
    kind = np.min_scalar_type(int(gaps.max())) if len(gaps) else np.dtype(np.uint8)
    return pack(gaps=gaps.astype(kind))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data)["gaps"], dtype=np.uint64)


def _write(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _packer(schema: pa.Schema):
    def flush(parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).cast(pa.schema([*schema, ("__bucket", pa.int32())])).combine_chunks()
        order = np.argsort(bucket := table.column("__bucket").to_numpy(), kind="stable")
        table, bucket = table.take(pa.array(order)).drop_columns(["__bucket"]), bucket[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
        ends = [*cut[1:].tolist(), len(bucket)]
        blocks = [_write(table.slice(a, b - a)) for a, b in zip(cut.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "block"])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
                size += batch.nbytes
            if size >= GATHER_BYTES:
                yield flush(parts)
                parts, size = [], 0
        if parts:
            yield flush(parts)

    return run


class Buckets:
    """Documents as (bucket, block), written once to the shared checkpoint folder, a bucket's blocks side by side."""

    def __init__(self, docs: DataFrame, text_col: str, spread: list[str], bucket_bytes: int = BUCKET_BYTES):
        """spread: the columns whose values deal rows to buckets: id and text, so that one id does not fill a bucket."""
        self.schema = arrow_schema(docs)
        self.bytes = text_bytes(docs, text_col)
        self.n = 1 + self.bytes // bucket_bytes
        self.partitions = max(shuffle_partitions(docs.sparkSession), -(-self.n // 2))
        bucket = F.pmod(F.xxhash64(*spread), F.lit(self.n)).cast("int")
        packed = docs.withColumn("__bucket", bucket).mapInArrow(giving_back(_packer(self.schema)), "bucket int, block binary")
        # without adaptive planning the checkpoint keeps its partitioning, and later passes need no exchange of blocks
        conf = docs.sparkSession.conf
        adaptive = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "false")
        try:
            self.blocks = packed.repartition(self.partitions, "bucket").checkpoint()
        finally:
            conf.set("spark.sql.adaptive.enabled", adaptive)

    def each(self, f, schema) -> DataFrame:
        """f(bucket number, table of its documents) -> table."""
        read = reader(self.schema)
        return self.blocks.groupBy("bucket").applyInArrow(_trimmed(lambda key, t: f(key[0].as_py(), read(t))), schema)

    def each_with(self, messages: DataFrame, f, schema) -> DataFrame:
        """f(bucket number, table of its documents, messages to it as (kind, shard, data)) -> table."""
        read = reader(self.schema)

        def run(key, blocks, answers):
            got = sorted(zip(*(answers.column(c).to_pylist() for c in ("kind", "shard", "data")), strict=True)) if answers.num_rows else []
            return f(key[0].as_py(), read(blocks), got)

        return self.blocks.groupBy("bucket").cogroup(messages.groupBy("bucket")).applyInArrow(_trimmed(run), schema)


def _trimmed(f):
    """f, and then what it freed goes back to the system. applyInArrow looks at the number of parameters."""

    def one(key, table):
        out = f(key, table)
        give_back()
        return out

    def two(key, left, right):
        out = f(key, left, right)
        give_back()
        return out

    return two if f.__code__.co_argcount == 3 else one


def reader(schema: pa.Schema):
    def read(table: pa.Table) -> pa.Table:
        # blocks come in any order; their bytes put them in one that each pass sees
        blocks = sorted(table.column("block").to_pylist())
        parts = [pa.ipc.open_stream(b).read_all() for b in blocks]
        return pa.concat_tables(parts).combine_chunks() if parts else schema.empty_table()

    return read


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    kind, bucket, shard, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"kind": pa.array(kind, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "shard": pa.array(shard, pa.int32()), "data": pa.array(data, pa.binary())})


def each_shard(sent: DataFrame, f) -> DataFrame:
    """f(shard, messages as (kind, bucket, data)) -> table of messages, for each shard."""

    def run(key, table):
        return f(key[0].as_py(), sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "data")), strict=True)))

    return sent.groupBy("shard").applyInArrow(_trimmed(run), MESSAGE)
