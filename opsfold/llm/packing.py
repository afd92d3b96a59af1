"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Best-fit decreasing looks at lengths only.  So the plan is made for counts of
equal lengths: at most ``capacity`` of them, however many documents there are.
A segment tree over remaining capacities finds the tightest open bin in
logarithmic time; bins with equal room and equal items are handled as one run,
and a run of equal lengths is placed run by run.  Spark then ranks the pieces
of each length and looks up their places.

Cases: a null or empty text is one piece holding only the end id; an empty
table gives an empty result; repeated documents (and ids) are packed each for
itself; ties between equal lengths go to any of them; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.frames import stored, trimmed
from opsfold.llm.tokens import CACHE_PIECES, default_tokenizer, encoder

CAPACITY = 2048
END_ID = 0


class RoomTree:
    """Segment tree over remaining capacities: how many open bin runs have each."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open = [0] * (2 * self.size)

    def add(self, room: int, change: int) -> None:
        at = room + self.size
        while at:
            self.open[at] += change
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that an open bin has."""
        at = length + self.size
        if self.open[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts[length]`` items of each length.

    Returns rows ``(length, first_rank, first_bin, per_bin, used)``: the items of
    this length from ``first_rank`` on (up to the next row's) fill bins from
    ``first_bin`` on, ``per_bin`` of them each, beginning at offset ``used``.
    """
    tree, runs, plan, bins = RoomTree(capacity), defaultdict(list), [], 0

    def put(room: int, first: int, count: int) -> None:
        if count and room:
            runs[room].append((first, count))
            tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, bins, -(-left // (capacity // length))
                bins += count
            else:
                first, count = runs[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(count, left // each)
            if full:
                plan.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
                first, count = first + full, count - full
            if count and left:  # fewer items are left than one more bin takes
                plan.append((length, rank, first, each, capacity - room))
                put(room - left * length, first, 1)
                left, first, count = 0, first + 1, count - 1
            put(room, first, count)
    return plan


def cut_points(n: int, capacity: int) -> list[int]:
    """Piece boundaries: only the first piece may be shorter than ``capacity``."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n + 1, capacity)]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID, cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """Pieces of each document's ids: place, checksum, and rank among its task's equals."""
    path = tokenizer or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType),
        *(T.StructField(c, T.LongType()) for c in
          ("piece", "start", "length", "ids_crc32", "part", "rank"))])

    def run(batches):
        part, ranks = TaskContext.get().partitionId(), defaultdict(int)
        encode = encoder(path, cache_pieces).encode
        for batch in batches:
            rows, out = [], [[] for _ in range(6)]
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for i, ids in enumerate(encode(texts)):
                ids += end
                cuts = cut_points(len(ids) // 4, capacity)
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(i)
                    values = (k, a, b - a, zlib.crc32(ids[4 * a:4 * b]), part, ranks[b - a])
                    ranks[b - a] += 1
                    for column, value in zip(out, values):
                        column.append(value)
            ids_column = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids_column, *(pa.array(c, pa.int64()) for c in out)], names=schema.names)

    return source.mapInArrow(trimmed(run), schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``cache_pieces`` bounds the encoder's memory in each worker: fewer pieces cost time only.
    """
    pieces = stored(token_pieces(docs, id_col, text_col, tokenizer, capacity, end_id, cache_pieces), "pieces")
    by_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in
              by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = best_fit_plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part")
    offsets = by_task.select("length", "part", (F.sum("n").over(before) - F.col("n")).alias("skip"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("skip"))
    # Rows of the plan sort by (length, first_rank); length < 2**21 leaves 42 bits for ranks.
    table = np.array(sorted(plan), dtype=np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 42) + table[:, 1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([*(ranked.schema[c] for c in columns),
                           T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            row = table[np.searchsorted(keys, (length << 42) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence = row[:, 2] + nth // row[:, 3]
            offset = row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                names=schema.names)

    out = ranked.select(*columns, "rank").mapInArrow(place, schema)
    return out.withColumn("piece", F.col("piece").cast("int"))


def sequences(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: ``sequence_id, ids array<int>``; ids must be unique in ``docs``.

    A sequence is one group of at most ``capacity`` tokens.
    """
    path = tokenizer or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")
    places = packed.groupBy("doc_id").agg(F.collect_list(
        F.struct("start", "length", "sequence_id", "offset")).alias("places"))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = source.join(places, "doc_id").select("text", "places")

    def run(batches):
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(0).to_pylist()]
            rows = []
            for ids, places in zip(encoder(path).encode(texts), batch.column(1).to_pylist()):
                ids = np.frombuffer(ids + end, dtype="<u4").astype(np.int32)
                rows += [(p["sequence_id"], p["offset"], ids[p["start"]:p["start"] + p["length"]])
                         for p in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                names=["sequence_id", "offset", "ids"])

    parts = both.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
