"""Operator 2: best-fit packing of token pieces into sequences, improved by local search.

Documents longer than a sequence are cut into a first piece, which may be shorter, and full
ones after it. Full pieces are sequences by themselves. The others are dealt at random to shards of a bounded
number of pieces; a shard is packed best-fit, longest piece first, and then improved: a
fuller sequence takes a piece from an emptier one, or swaps one of its pieces for one or
two longer ones of it. Each such exchange raises the sum of the squared fills, and emptied
sequences go. What is still underfull meets in a second, smaller round of shards.

Null and empty texts are a piece of the end id alone. Repeated rows are packed each on
their own. Extra columns are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import by_arrow, small_batches, stored, table, utf8
from recordloom.llm.tokens import encoder_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SHARD_PIECES = 16_384


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, kept: int | None = None) -> DataFrame:
    """The pieces of ``size`` ids, the first maybe shorter, that each text and its end id are cut into.

    ``kept`` bounds the words that a worker's encoder keeps.
    """

    def cut(batches) -> Iterator[list[tuple]]:
        encoder, end = encoder_of(tokenizer, kept), end_id.to_bytes(4, "little")
        for batch in small_batches(batches):
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.encode(text) + end
                # What full pieces leave over comes first; ids take four bytes.
                first = len(ids) % (4 * size) or 4 * size
                for k, end_at in enumerate(range(first, len(ids) + 1, 4 * size)):
                    at = max(0, end_at - 4 * size)
                    part = ids[at:end_at]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield out

    return by_arrow(docs.select("doc_id", utf8(F.col("text")).alias("text")), cut, PIECES)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each where the least room is left."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        above = rooms >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


def exchange(bins: list[list[int]], lengths: list[int], size: int, partners: int = 64) -> list[list[int]]:
    """Local search over the underfull bins; see the module's text."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    for _ in range(8):
        under = sorted((b for b in range(len(bins)) if 0 < fill[b] < size), key=lambda b: -fill[b])
        changed = False
        for k, x in enumerate(under):
            # The emptiest come first: they are the ones to empty.
            for y in [*reversed(under[k + 1 :])][:partners]:
                room = size - fill[x]
                if not room or not fill[y]:
                    continue
                if fill[x] < fill[y]:
                    x, y = y, x
                    room = size - fill[x]
                give = [(0, None), *((lengths[i], i) for i in set(bins[x]))]
                take: dict[int, tuple[int, ...]] = {lengths[i]: (i,) for i in bins[y]}
                if len(bins[y]) <= 48:
                    for a in range(len(bins[y])):
                        for b in range(a):
                            i, j = bins[y][a], bins[y][b]
                            take.setdefault(lengths[i] + lengths[j], (i, j))
                gain, out, into = max(
                    ((t - g, i, ids) for g, i in give for t, ids in take.items() if 0 < t - g <= room),
                    key=lambda m: m[0],
                    default=(0, None, ()),
                )
                if gain and fill[x] + gain > fill[y] - gain:
                    for i in into:
                        bins[y].remove(i)
                        bins[x].append(i)
                    if out is not None:
                        bins[x].remove(out)
                        bins[y].append(out)
                    fill[x] += gain
                    fill[y] -= gain
                    changed = True
        if not changed:
            break
    return [b for b in bins if b]


def _packed_shards(loose: DataFrame, columns: list[str], size: int, seed: int) -> DataFrame:
    """Adds ``shard``, ``bin``, ``offset`` and ``filled`` to pieces, packed in shards of bounded size."""
    shards = max(1, -(-loose.count() // SHARD_PIECES))
    dealt = loose.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards)).cast("int"))

    def pack(group: pa.Table) -> pa.Table:
        order = group.column("uid").to_pylist()
        group = group.take(pa.array(sorted(range(len(order)), key=order.__getitem__)))
        lengths = group.column("length").to_pylist()
        bins = exchange(best_fit(lengths, size), lengths, size)
        rows = [(i, k) for k, b in enumerate(bins) for i in b]
        offsets, filled, at, last = [], [], 0, -1
        fills = [sum(lengths[i] for i in b) for b in bins]
        for i, k in rows:
            at, last = (0 if k != last else at), k
            offsets.append(at)
            filled.append(fills[k])
            at += lengths[i]
        out = group.take(pa.array([i for i, _ in rows], pa.int64()))
        out = out.append_column("bin", pa.array([k for _, k in rows], pa.int64()))
        out = out.append_column("offset", pa.array(offsets, pa.int64()))
        return out.append_column("filled", pa.array(filled, pa.int64()))

    schema = ", ".join(f"{n} {t}" for n, t in dealt.dtypes) + ", bin long, offset long, filled long"
    return dealt.groupBy("shard").applyInArrow(pack, schema).select(*columns, "shard", "bin", "offset", "filled")


def packed(cut: DataFrame, size: int, tolerance: int = 8) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; ``tolerance`` ids of room count as full."""
    columns = cut.columns
    rows = stored(cut.withColumn("uid", F.monotonically_increasing_id()))
    full = rows.where(F.col("length") >= size)
    full = full.select(*columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = stored(_packed_shards(rows.where(F.col("length") < size), [*columns, "uid"], size, 1))
    done = F.col("filled") >= size - tolerance
    second = _packed_shards(first.where(~done).select(*columns, "uid"), columns, size, 2)
    number = F.shiftleft(F.col("shard").cast("long") * 2 + F.col("round"), 24) + F.col("bin")
    loose = [
        part.withColumn("round", F.lit(k).cast("long")).select(*columns, number.alias("sequence_id"), "offset")
        for k, part in enumerate((first.where(done), second))
    ]
    return full.unionByName(loose[0]).unionByName(loose[1])


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024, kept: int | None = None
) -> DataFrame:
    return packed(pieces(docs, tokenizer, end_id, size, kept), size)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
