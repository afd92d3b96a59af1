"""Ranked lexical search over an inverted index by Block-Max MaxScore.

``build_index`` turns documents into segments, one row each: the segment's documents with their
lengths, its terms (64-bit hashes, sorted), and for every term a posting list in blocks of 128
(gaps and frequencies in as few bytes as the block needs).  Lists and blocks carry the largest
impact found in them.  Segments hold about ``SEGMENT_BYTES`` of text and are made where the
documents lie; no document moves.

``search`` takes items in blocks.  One narrow pass over the dictionaries gives each query term's
document frequency and its largest impact anywhere.  The second pass goes over the segments: each
task keeps one heap per item and carries it from segment to segment.  Terms in ascending order of
their global bound whose bounds add up to less than the heap's threshold form the non-essential
lists.  Only the essential lists produce candidates.  Non-essential lists are probed from the
largest bound down, and a candidate is given up, before a block is unpacked, as soon as its score
with the block's maximum and the bounds of the lists that remain cannot reach the threshold.  The
heaps of all tasks are merged by a ranked window, first by groups of tasks.  Results are exact.

Scores are whole numbers: a term weighs floor(1000 ln((2N+2)/(2df+1))), its impact in a document
is 10^9 tf div (1000 tf + 20 m) with m = 50 + (50 n N) div L.

Cases: null and empty texts hold no term, count for nothing and are never found; an item without
terms, or whose terms no document holds, has no results; equal items each get their results; rows
that repeat are documents of their own; equal scores rank by ascending document id, null first,
and rows that agree in both in any order; empty tables give an empty result; other columns,
whatever their names, are ignored.  A text of any length is cut into pieces of ``SLICE`` bytes for
counting and is one document all the same.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.frames import shared_folder, stored
from opsfold.llm.hashing import RangeHash

TOP = 50
BLOCK = 128
SLICE = 2_000_000
SEGMENT_BYTES = 12_000_000
SEGMENT_DOCS = 65_536
# Text of the items that are searched for in one go; more items take further passes.
ITEM_BYTES = 8_000_000
# Tasks whose heaps are merged first.
MERGE_GROUPS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_TERM = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _IS_TERM[_a:_b] = True

PARTS = ["n_docs", "n_terms", "doc_ids", "lengths", "terms", "list_docs", "list_max",
         "first_block", "block_first", "block_last", "block_max", "block_at", "block_kind", "data"]


def _text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch and where each begins (nulls are empty)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), at


def _pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece starts (and the end) and the text of each piece; long texts are cut between terms."""
    sizes = np.diff(at)
    if not len(sizes) or sizes.max() <= SLICE:
        return at, np.arange(len(sizes))
    cuts, owner = [], []
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        cuts.append(a)
        owner.append(i)
        cut = a + SLICE
        while cut < b:
            window = np.flatnonzero(~_IS_TERM[data[cut:min(b, cut + SLICE)]])
            if not len(window):  # inside a term longer than a slice
                cut += SLICE
                continue
            cuts.append(cut + int(window[0]))
            owner.append(i)
            cut = cuts[-1] + SLICE
    return np.array([*cuts, int(at[-1])], dtype=np.int64), np.array(owner)


def _groups(starts: np.ndarray, most: int):
    """Ranges of pieces of at most ``most`` bytes together (or one piece)."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of runs of rows that agree in all columns."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _term_places(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start and end of each term; a term ends with its piece."""
    word = _IS_TERM[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    inner = starts[(starts > 0) & (starts < len(data))]
    begin[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[inner - 1] = word[inner - 1]
    return _LOWER[data], np.flatnonzero(begin), np.flatnonzero(last) + 1


def count_terms(column: pa.Array) -> np.ndarray:
    """Number of terms of each text."""
    data, at = _text_buffers(column)
    counts = np.zeros(len(at) - 1, dtype=np.int64)
    pieces, owner = _pieces(data, at)
    for i, j in _groups(pieces, 4 * SLICE):
        a, b = int(pieces[i]), int(pieces[j])
        word = _IS_TERM[data[a:b]]
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        inner = pieces[i:j] - a
        inner = inner[(inner > 0) & (inner < b - a)]
        begin[inner] = word[inner]
        ends = np.concatenate([[0], np.cumsum(begin)])
        per = ends[pieces[i + 1:j + 1] - a] - ends[pieces[i:j] - a]
        np.add.at(counts, owner[i:j], per)
    return counts


def term_counts(column: pa.Array):
    """Yields (hash, text, tf) arrays, by hash and text, for groups of texts in order."""
    data, at = _text_buffers(column)
    pieces, owner = _pieces(data, at)
    for i, j in _groups(pieces, SLICE):
        a, b = int(pieces[i]), int(pieces[j])
        lowered, s, e = _term_places(data[a:b], pieces[i:j] - a)
        if not len(s):
            continue
        h = RangeHash(lowered).of(s, e)
        doc = owner[i + np.searchsorted(pieces[i + 1:j + 1] - a, s, side="right")]
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        run = _runs(h, doc)
        yield h[run], doc[run], np.diff(np.append(run, len(h)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 50 + (50 * n * n_docs) // n_terms


def _width(x: np.ndarray) -> np.ndarray:
    """0, 1 or 2 for values of one, two or four bytes."""
    return (x > 0xFF).astype(np.int64) + (x > 0xFFFF)


def _put(data: np.ndarray, at: np.ndarray, values: np.ndarray, width: int) -> None:
    for k in range(width):
        data[at + k] = (values >> (8 * k)) & 0xFF


def _get(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    out = data[at].astype(np.int64)
    for k in range(1, width):
        out |= data[at + k].astype(np.int64) << (8 * k)
    return out


def build_segment(h: np.ndarray, doc: np.ndarray, tf: np.ndarray, ids: pa.Array,
                  n_docs: int, n_terms: int) -> dict:
    """One segment from (hash, text, tf) rows; texts without terms are left out."""
    order = np.argsort(h, kind="stable")  # rows come in text order, which stays within a hash
    h, doc, tf = h[order], doc[order], tf[order]
    run = _runs(h, doc)  # pieces of one text
    h, doc, tf = h[run], doc[run], np.add.reduceat(tf, run)
    present, doc = np.unique(doc, return_inverse=True)
    lengths = np.bincount(doc, weights=tf).astype(np.int64)
    impact = impacts(tf, length_norms(lengths, n_docs, n_terms)[doc])
    lists = _runs(h)
    sizes = np.diff(np.append(lists, len(h)))
    place = np.arange(len(h)) - np.repeat(lists, sizes)
    blocks = np.flatnonzero(place % BLOCK == 0)
    counts = np.diff(np.append(blocks, len(h)))
    in_block = np.repeat(np.arange(len(blocks)), counts)
    gap = np.diff(doc, prepend=0)
    gap[blocks] = 0
    gap_kind = _width(np.maximum.reduceat(gap, blocks))
    most_tf = np.maximum.reduceat(tf, blocks)
    tf_kind = np.where(most_tf == 1, 0, 1 + _width(most_tf))
    gap_bytes, tf_bytes = np.array([1, 2, 4])[gap_kind], np.array([0, 1, 2, 4])[tf_kind]
    begins = np.concatenate([[0], np.cumsum(counts * (gap_bytes + tf_bytes))])
    data = np.zeros(int(begins[-1]), dtype=np.uint8)
    i = np.arange(len(h)) - blocks[in_block]
    for kind in (0, 1, 2):
        at = np.flatnonzero(gap_kind[in_block] == kind)
        b = in_block[at]
        _put(data, begins[b] + i[at] * gap_bytes[b], gap[at], (1, 2, 4)[kind])
    for kind in (1, 2, 3):
        at = np.flatnonzero(tf_kind[in_block] == kind)
        b = in_block[at]
        _put(data, begins[b] + counts[b] * gap_bytes[b] + i[at] * tf_bytes[b], tf[at], (0, 1, 2, 4)[kind])
    first_block = np.searchsorted(blocks, np.append(lists, len(h)))
    return {
        "n_docs": len(present), "n_terms": int(lengths.sum()),
        "doc_ids": ids.take(pa.array(present)), "lengths": lengths.astype("<i8").tobytes(),
        "terms": h[lists].astype("<u8").tobytes(), "list_docs": sizes.astype("<u4").tobytes(),
        "list_max": np.maximum.reduceat(impact, lists).astype("<i8").tobytes(),
        "first_block": first_block.astype("<u4").tobytes(),
        "block_first": doc[blocks].astype("<u4").tobytes(),
        "block_last": doc[blocks + counts - 1].astype("<u4").tobytes(),
        "block_max": np.maximum.reduceat(impact, blocks).astype("<i8").tobytes(),
        "block_at": begins.astype("<i8").tobytes(),
        "block_kind": (4 * gap_kind + tf_kind).astype(np.uint8).tobytes(), "data": data.tobytes()}


class Segment:
    """A segment read back: lists are unpacked block by block, as far as they are asked for."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.terms = read("terms", "<u8")
        self.list_max, self.first_block = read("list_max", "<i8"), read("first_block", "<u4")
        self.first = read("block_first", "<u4").astype(np.int64)
        self.last = read("block_last", "<u4").astype(np.int64)
        self.block_max, self.at = read("block_max", "<i8"), read("block_at", "<i8")
        self.kind, self.data = read("block_kind", np.uint8), read("data", np.uint8)
        sizes = read("list_docs", "<u4").astype(np.int64)
        self.count = np.full(len(self.kind), BLOCK, dtype=np.int64)
        self.count[self.first_block[1:] - 1] = (sizes - 1) % BLOCK + 1
        self.n_docs = row["n_docs"]
        self.norms = length_norms(read("lengths", "<i8"), n_docs, n_terms)
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks in order."""
        self.unpacked += len(blocks)
        counts = self.count[blocks]
        ends = np.cumsum(counts)
        begin = ends - counts
        total = int(ends[-1])
        gap, tf = np.empty(total, np.int64), np.ones(total, np.int64)
        kinds = self.kind[blocks]
        for kind in np.unique(kinds).tolist():
            mine = np.flatnonzero(kinds == kind)
            n = counts[mine]
            i = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out = np.repeat(begin[mine], n) + i
            base = np.repeat(self.at[blocks[mine]], n)
            gap_bytes, tf_bytes = (1, 2, 4)[kind >> 2], (0, 1, 2, 4)[kind & 3]
            gap[out] = _get(self.data, base + i * gap_bytes, gap_bytes)
            if tf_bytes:
                tf[out] = _get(self.data, base + np.repeat(n, n) * gap_bytes + i * tf_bytes, tf_bytes)
        steps = np.cumsum(gap)
        doc = steps + np.repeat(self.first[blocks] - steps[begin], counts)
        return doc, impacts(tf, self.norms[doc])

    def whole_list(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        if t not in self.whole:
            self.whole[t] = self.unpack(np.arange(self.first_block[t], self.first_block[t + 1]))
        return self.whole[t]

    def candidates(self, lists: np.ndarray, weights: np.ndarray, bounds: np.ndarray,
                   threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may reach ``threshold``, with exact scores; ``bounds`` are global."""
        order = np.argsort(bounds, kind="stable")
        lists, weights = lists[order], weights[order]
        here = weights * self.list_max[lists]
        if here.sum() < threshold:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        essential = int(np.searchsorted(np.cumsum(bounds[order]), threshold))
        score = np.zeros(self.n_docs, dtype=np.int64)
        found = np.zeros(self.n_docs, dtype=bool)
        for t, w in zip(lists[essential:].tolist(), weights[essential:].tolist(), strict=True):
            doc, impact = self.whole_list(t)
            score[doc] += w * impact
            found[doc] = True
        doc = np.flatnonzero(found)
        score = score[doc]
        left = int(here[:essential].sum())
        for k in range(essential - 1, -1, -1):
            alive = score + left >= threshold
            doc, score = doc[alive], score[alive]
            if not len(doc):
                break
            t, w = int(lists[k]), int(weights[k])
            left -= int(here[k])
            a, b = int(self.first_block[t]), int(self.first_block[t + 1])
            if t in self.whole:
                has, impact = self.whole[t]
                at = np.minimum(np.searchsorted(has, doc), len(has) - 1)
                score = score + np.where(has[at] == doc, w * impact[at], 0)
                continue
            block = np.minimum(a + np.searchsorted(self.last[a:b], doc), b - 1)
            inside = (self.first[block] <= doc) & (doc <= self.last[block])
            bound = np.where(inside, w * self.block_max[block], 0)
            alive = score + bound + left >= threshold
            doc, score, block, inside = doc[alive], score[alive], block[alive], inside[alive]
            if inside.any():
                has, impact = self.unpack(np.unique(block[inside]))
                at = np.minimum(np.searchsorted(has, doc), len(has) - 1)
                score = score + np.where(inside & (has[at] == doc), w * impact[at], 0)
        alive = score >= threshold
        return doc[alive], score[alive]


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.scores = [np.zeros(0, np.int64)] * items
        self.ids = [np.zeros(0, np.int64)] * items
        self.threshold = [1] * items

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores = np.concatenate([self.scores[item], scores])
        ids = np.concatenate([self.ids[item], ids])
        if len(scores) > self.top:
            # Everything above the last score, and the smallest ids among those equal to it.
            cut = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            keep = scores >= cut
            scores, ids = scores[keep], ids[keep]
            best = np.lexsort((ids, -scores))[:self.top]
            scores, ids = scores[best], ids[best]
        self.scores[item], self.ids[item] = scores, ids
        if len(scores) == self.top:
            self.threshold[item] = int(scores.min())


def collection(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with at least one term, and the number of their terms."""
    def run(batches):
        n = terms = 0
        for batch in batches:
            counts = count_terms(batch.column(0))
            n += int((counts > 0).sum())
            terms += int(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([terms])], names=["n", "terms"])

    row = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n long, terms long")
           .agg(F.sum("n").alias("n"), F.sum("terms").alias("terms")).first())
    return row["n"] or 0, row["terms"] or 0


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES, path: str | None = None) -> tuple[str, int, int]:
    """Write the segments of ``docs``; returns their folder and the collection's two totals."""
    spark = docs.sparkSession
    path = path or shared_folder(spark, "index")
    n_docs, n_terms = collection(docs, text_col)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in PARTS[:2]]
                          + [T.StructField("doc_ids", T.ArrayType(T.LongType()))]
                          + [T.StructField(c, T.BinaryType()) for c in PARTS[3:]])
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * (len(PARTS) - 3)

    def run(batches):
        rows, ids, size, docs_held = [], [], 0, 0

        def flush():
            h, doc, tf = (np.concatenate(c) for c in zip(*rows, strict=True))
            row = build_segment(h, doc, tf, pa.chunked_array(ids).combine_chunks(), n_docs, n_terms)
            row["doc_ids"] = row["doc_ids"].to_pylist()
            return pa.RecordBatch.from_arrays(
                [pa.array([row[c]], k) for c, k in zip(PARTS, kinds, strict=True)], names=PARTS)

        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            for a, b in _groups(ends, segment_bytes):
                part = batch.slice(a, b - a)
                if docs_held and (size + ends[b] - ends[a] > segment_bytes
                                  or docs_held + b - a > SEGMENT_DOCS):
                    if rows:
                        yield flush()
                    rows, ids, size, docs_held = [], [], 0, 0
                for h, doc, tf in term_counts(part.column(1)):
                    rows.append((h, doc + docs_held, tf))
                ids.append(part.column(0))
                size, docs_held = size + int(ends[b] - ends[a]), docs_held + b - a
        if rows:
            yield flush()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return path, n_docs, n_terms


def query_terms(texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct term hashes of all texts, and each text's terms as places among them, once each."""
    hashes, owners = [], []
    for h, doc, _ in term_counts(pa.array(texts, pa.string())):
        hashes.append(h)
        owners.append(doc)
    if not hashes:
        return np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * len(texts)
    terms, at = np.unique(np.concatenate(hashes), return_inverse=True)
    owner = np.concatenate(owners)
    return terms, [np.unique(at[owner == i]) for i in range(len(texts))]


def _find(terms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted term among sorted terms, or -1."""
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    return np.where(terms[at] == wanted, at, -1)


def term_statistics(index: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold each term, and its largest impact, over all segments."""
    def run(batches):
        docs, most = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                has, n, top = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=k)
                               for c, k in ((0, "<u8"), (1, "<u4"), (2, "<i8")))
                at = _find(has, terms)
                hit = at >= 0
                docs[hit] += n[at[hit]]
                most[hit] = np.maximum(most[hit], top[at[hit]])
        t = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(docs[t]), pa.array(most[t])],
                                         names=["t", "docs", "most"])

    rows = (index.select("terms", "list_docs", "list_max")
            .mapInArrow(run, "t long, docs long, most long")
            .groupBy("t").agg(F.sum("docs"), F.max("most")).collect())  # one row a term of the block
    docs, most = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
    for t, n, top in rows:
        docs[t], most[t] = n, top
    return docs, most


def _search_block(index: DataFrame, texts: list[str | None], n_docs: int, n_terms: int,
                  top: int) -> DataFrame:
    """(item, doc_id, score, task): the best documents of each item in each task's segments."""
    terms, items = query_terms(texts)
    df, most = term_statistics(index, terms)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) if d else 0
                       for d in df], dtype=np.int64)
    items = [i[weight[i] > 0] for i in items]
    bound = weight * most

    def run(batches):
        heaps, part = Heaps(len(items), top), TaskContext.get().partitionId()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_buffer() for k, c in enumerate(PARTS[3:], 3)}
                row["n_docs"] = batch.column(0)[i].as_py()
                segment = Segment(row, n_docs, n_terms)
                # Null ids sort before all others.
                ids = batch.column(2)[i].values.fill_null(_NULL).to_numpy()
                at = _find(segment.terms, terms)
                for k, mine in enumerate(items):
                    mine = mine[at[mine] >= 0]
                    if not len(mine):
                        continue
                    doc, score = segment.candidates(at[mine], weight[mine], bound[mine],
                                                    heaps.threshold[k])
                    if len(doc):
                        heaps.add(k, ids[doc], score)
        sizes = [len(s) for s in heaps.scores]
        if sum(sizes):
            ids = np.concatenate(heaps.ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(items)), sizes)),
                 pa.array(ids, mask=ids == _NULL), pa.array(np.concatenate(heaps.scores)),
                 pa.array(np.full(sum(sizes), part, dtype=np.int64))],
                names=["item", "doc_id", "score", "task"])

    return index.select(*PARTS).mapInArrow(run, "item long, doc_id long, score long, task long")


_NULL = np.iinfo(np.int64).min


def _item_blocks(items: DataFrame, id_col: str, text_col: str, item_bytes: int):
    """Items in blocks of about ``item_bytes``; the driver holds one of them at a time."""
    block, size = [], 0
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    for row in rows.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"] or "") + 64
        if size >= item_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
           segment_bytes: int = SEGMENT_BYTES, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score."""
    path, n_docs, n_terms = build_index(docs, id_col, text_col, segment_bytes)
    return search_index(docs.sparkSession, path, n_docs, n_terms, items, top, item_id_col,
                        item_text_col, item_bytes)


def search_index(spark: SparkSession, path: str, n_docs: int, n_terms: int, items: DataFrame,
                 top: int = TOP, item_id_col: str = "item_id", item_text_col: str = "text",
                 item_bytes: int = ITEM_BYTES) -> DataFrame:
    """As :func:`search`, over an index written before."""
    kind = items.schema[item_id_col].dataType
    index = spark.read.parquet(path)
    out = None
    for block in _item_blocks(items, item_id_col, item_text_col, item_bytes):
        found = _search_block(index, [t for _, t in block], n_docs, n_terms, top)
        merged = found.withColumn("group", F.pmod("task", F.lit(MERGE_GROUPS)))
        for keys in (["item", "group"], ["item"]):
            best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
            merged = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)],
                                      T.StructType([T.StructField("item", T.LongType()),
                                                    T.StructField("item_id", kind)]))
        # ``names`` is one block of items, so it is as small as the block.
        ranked = stored(merged.join(F.broadcast(names), "item")
                        .select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], T.StructType([
            T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return out
