"""Operator 9: token ids in chunks of compressed byte or bit planes, with a chunk index.

A chunk holds a fixed number of ids of one shard; a shard is a range of ``doc_id``. The
ids of a chunk are transposed into planes (one per byte or bit of an id), so that bytes of
like meaning lie together, and each plane is compressed with zstandard. A chunk's payload
is::

    b"IDP1", kind (1: byte, 2: bit), planes, 2 unused bytes, ids (uint32), plane sizes (uint32 each), planes

The files are a table written by Spark, so that any store and lost executors are handled
by its commit protocol. Its columns besides the payload are the chunk index: ``shard``,
``chunk``, ``first_id`` (ids of the shard before it), ``n_ids``, and for the documents
that start in the chunk ``doc_ids``, ``doc_starts`` (in the shard) and ``doc_lengths``.

Null and empty texts are a lone end id. Repeated rows are documents of their own; equal
``doc_id`` follow one another in the order of their texts, null ``doc_id`` come last. Extra
columns are not read. An empty table gives no chunks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordloom.llm.common import by_arrow, partitions, shared_folder, small_batches, table, utf8, with_range
from recordloom.llm.tokens import encoder_of

MAGIC = b"IDP1"
KINDS = {"byte": 1, "bit": 2}
FILE_SCHEMA = (
    "shard int, chunk int, first_id long, n_ids int, payload binary, "
    "doc_ids array<long>, doc_starts array<long>, doc_lengths array<long>"
)
FILE_COLUMNS = ("shard", "chunk", "payload", "doc_ids", "doc_starts", "doc_lengths")


def packed(ids: np.ndarray, planes: str = "byte", level: int = 3) -> bytes:
    """The payload of a chunk of unsigned 32-bit ids."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        rows = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)
    else:
        rows = raw.T
    compress = zstandard.ZstdCompressor(level=level).compress
    parts = [compress(np.ascontiguousarray(row).tobytes()) for row in rows]
    head = MAGIC + struct.pack("<BBxxI", KINDS[planes], len(parts), len(ids))
    return head + struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def unpacked(payload: bytes) -> np.ndarray:
    if payload[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    kind, n_planes, n = struct.unpack_from("<BBxxI", payload, 4)
    sizes = struct.unpack_from(f"<{n_planes}I", payload, 12)
    at, rows, expand = 12 + 4 * n_planes, [], zstandard.ZstdDecompressor().decompress
    for size in sizes:
        rows.append(np.frombuffer(expand(payload[at : at + size]), np.uint8))
        at += size
    if kind == KINDS["bit"]:
        bits = np.stack([np.unpackbits(row, count=n) for row in rows], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    else:
        raw = np.stack(rows, axis=1)
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    chunk_ids: int = 16_384,
    planes: str = "byte",
    shards: int | None = None,
) -> None:
    """Writes the ids of every text, each followed by ``end_id``, in ascending ``doc_id`` order."""
    n = shards or partitions(docs.sparkSession)

    def chunks(batches) -> Iterator[list[tuple]]:
        encoder, end = encoder_of(tokenizer), struct.pack("<I", end_id)
        shard, chunk, done, buffer, starts = None, 0, 0, bytearray(), []

        def flush(size: int):
            nonlocal chunk, done, starts
            row = (
                shard, chunk, done, size, packed(np.frombuffer(bytes(buffer[: 4 * size]), "<u4"), planes),
                [s[0] for s in starts], [s[1] for s in starts], [s[2] for s in starts],
            )
            del buffer[: 4 * size]
            chunk, done, starts = chunk + 1, done + size, []
            return row

        for batch in small_batches(batches):
            out = []
            for of, doc_id, text in zip(batch["range"], batch["doc_id"], batch["text"], strict=True):
                if of != shard:
                    if buffer:
                        out.append(flush(len(buffer) // 4))
                    shard, chunk, done = of, 0, 0
                ids = encoder.encode(text) + end
                at = done + len(buffer) // 4
                starts.append((doc_id, at, len(ids) // 4))
                buffer += ids
                while len(buffer) >= 4 * chunk_ids:
                    out.append(flush(chunk_ids))
            yield out
        if buffer:
            yield [flush(len(buffer) // 4)]

    dealt = with_range(docs.select("doc_id", utf8(F.col("text")).alias("text")), "doc_id", n)
    dealt = dealt.repartition(n, "range").sortWithinPartitions("range", F.col("doc_id").asc_nulls_last(), "text")
    by_arrow(dealt, chunks, FILE_SCHEMA).write.mode("overwrite").parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start, ids (little-endian unsigned 32-bit bytes)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def documents(batches) -> Iterator[list[tuple]]:
        shard, buffer, at, open_docs = None, bytearray(), 0, []
        for batch in small_batches(batches, 16):
            out = []
            for row in zip(*(batch[c] for c in FILE_COLUMNS), strict=True):
                if row[0] != shard:
                    shard, buffer, at, open_docs = row[0], bytearray(), 0, []
                buffer += unpacked(row[2]).tobytes()
                open_docs.extend(zip(*row[3:], strict=True))
                taken, used = 0, 0
                for doc_id, start, length in open_docs:
                    if 4 * (start - at + length) > len(buffer):
                        break
                    out.append((doc_id, shard, start, bytes(buffer[4 * (start - at) : 4 * (start - at + length)])))
                    taken, used = taken + 1, start - at + length
                del open_docs[:taken], buffer[: 4 * used]
                at += used
            yield out

    ordered = files.select(*FILE_COLUMNS).repartition(partitions(spark), "shard")
    ordered = ordered.sortWithinPartitions("shard", "chunk")
    found = by_arrow(ordered, documents, "doc_id long, shard int, start long, ids binary")
    # One small row per shard, whose number the writer set.
    found = found.join(F.broadcast(bases), "shard")
    return found.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "ids")


def digests(ids: DataFrame) -> DataFrame:
    return ids.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_folder(spark)
    write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), 2)
    return digests(read_ids(spark, folder))
