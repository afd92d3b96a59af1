"""Exact removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``length`` bytes that also starts earlier
(smaller document, or same document and smaller start) goes.

Parsing.  A rolling hash over ``width`` bytes picks a trigger in every string
of ``length`` bytes: the leftmost least hash in it.  The strings of one trigger
start at consecutive places; together they form a phrase, which holds all of
them in full.  Equal strings have equal triggers at equal distances, so a text
is the sequence of its phrases, and repeated text repeats them.

Dictionary.  Phrases are grouped by trigger and content; only the first
occurrence of a phrase goes on, as all strings of the others start earlier too.
With few distinct phrases in highly repetitive text, the rest is small: phrases
that share a trigger but differ.  Their suffixes from the trigger on, and the
prefixes before it, are compared within the trigger's bucket in corpus order,
which tells for every string whether an earlier phrase holds it.  No bucket of
more than ``bucket`` phrases is gathered whole: there Spark groups parts of
phrases, and strings of parts that are equal only in part, by 128-bit hashes.

Only the order of equal strings matters here, so buckets take the place of the
global suffix arrays of dictionary and parse.

Cases: null and empty texts have no bytes; texts shorter than ``length`` stay
whole; ties of one id (null ids come first) are ordered by text, equal rows in
any order; an empty table gives an empty result; other columns are ignored by
``repeated_bytes`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.frames import stored, text_or_empty, trimmed
from opsfold.llm.hashing import U64, RangeHash, joined, mix, slices
from opsfold.llm.sharding import number_rows

LENGTH = 100
WIDTH = 16
BUCKET = 16
STEP = 10
SLICE_BYTES = 500_000
SEGMENT = 4_000_000
# Marks of documents are broadcast up to this many bytes; beyond it, texts are shuffled to them.
MAX_BROADCAST_BYTES = 48_000_000
_PLACE = U64((1 << 24) - 1)


def phrases(parts: list[bytes], length: int, width: int):
    """(text, start, strings, trigger place, trigger hash, content hash) of all phrases."""
    buf, starts = joined(parts)
    ranges = RangeHash(buf)
    grams = ranges.grams(width)
    spread = length - width + 1  # places of a trigger in a string
    if len(grams) < spread:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4)) + (np.empty(0, U64),) * 2
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
    k = 1
    while 2 * k <= spread:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    if spread > k:
        low = np.minimum(low[:-(spread - k)], low[spread - k:])
    at = (low & _PLACE).astype(np.int64)
    counts = np.maximum(np.diff(starts) - 1 - length + 1, 0)
    text = np.repeat(np.arange(len(parts)), counts)
    first = np.cumsum(counts) - counts
    p = starts[text] + np.arange(len(text)) - first[text]
    at = at[p]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    s = np.flatnonzero(new)
    n = np.diff(np.append(s, len(p)))
    begin, trigger, text = p[s], at[s], text[s]
    content = ranges.of(begin, begin + n + length - 1)
    return text, begin - starts[text], n, trigger - starts[text], grams[trigger], content


def _segments(data: bytes, length: int):
    """Long texts in segments that share ``length - 1`` bytes, so each string is in one."""
    if len(data) <= SEGMENT:
        yield 0, data
        return
    for a in range(0, len(data) - length + 1, SEGMENT):
        yield a, data[a:a + SEGMENT + length - 1]


def _parse(docs: DataFrame, bits: int, length: int, width: int) -> DataFrame:
    """anchor, unit (content), loc (document and start) and n (strings) of all phrases."""

    def run(batches):
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            todo = [(i, a, d) for i, t in enumerate(texts) if len(t) >= length
                    for a, d in _segments(t, length)]
            for x, y in slices([len(d) for _, _, d in todo], SLICE_BYTES):
                some = todo[x:y]
                text, start, n, _, anchor, unit = phrases([d for _, _, d in some], length, width)
                base = np.array([(int(numbers[i]) << bits) + a for i, a, _ in some], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(unit.view(np.int64)),
                     pa.array(base[text] + start), pa.array(n.astype(np.int32))],
                    names=["anchor", "unit", "loc", "n"])

    return docs.select("no", "text").mapInArrow(trimmed(run), "anchor long, unit long, loc long, n int")


def _numbered(docs: DataFrame, id_col: str, text_col: str, rest: bool = False) -> tuple[DataFrame, int]:
    """``no`` (order of documents), doc_id, text, and the other columns as the struct ``rest``;
    and the bits that starts need.

    Ids that are distinct non-negative integers are their own numbers; other ids
    are numbered in order, with their rows, in a written table.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] if rest else []
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
                       *([F.struct(*others).alias("rest")] if rest else []))
    whole = isinstance(rows.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType))
    facts = rows.agg(F.max(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("rows"),
                     *((F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")) if whole else ())).first()
    bits = max(1, (facts["size"] or 0).bit_length())
    if whole and facts["rows"] and facts["lo"] is not None and facts["lo"] >= 0 \
            and facts["hi"] >> (63 - bits) == 0:
        ids = rows.select("doc_id").distinct().filter("doc_id is not null").count()
        if ids == facts["rows"]:
            return rows.withColumn("no", F.col("doc_id").cast("long")), bits
    tied = rows.withColumn("__tie", F.xxhash64("text"))
    return number_rows(tied, ["doc_id", "__tie"], "no").drop("__tie"), bits


def _runs(firsts: DataFrame, bits: int) -> DataFrame:
    """Adjoining first phrases of a document joined to runs of string starts [a, b)."""
    mask = (1 << bits) - 1
    rows = firsts.select(F.shiftright("loc", bits).alias("no"), "loc", "n")
    rows = rows.repartition("no").sortWithinPartitions("loc")

    def run(batches):
        left = None  # the run that the next batch may go on with: loc, end
        for batch in batches:
            if batch.num_rows == 0:
                continue
            loc = batch.column(1).to_numpy()
            end = loc + batch.column(2).to_numpy()
            if left is not None:
                loc, end = np.append(left[0], loc), np.append(left[1], end)
            new = np.ones(len(loc), dtype=bool)
            new[1:] = (loc[1:] != end[:-1]) | (loc[1:] >> bits != loc[:-1] >> bits)
            s = np.flatnonzero(new)
            a, b = loc[s], end[np.append(s[1:], len(loc)) - 1]
            left = a[-1:], b[-1:]
            yield out(a[:-1], b[:-1])
        if left is not None:
            yield out(*left)

    def out(a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(a >> bits), pa.array(a & mask), pa.array((a & mask) + b - a)],
            names=["no", "a", "b"])

    return rows.mapInArrow(trimmed(run), "no long, a long, b long")


def _with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Join the marks to the texts; which side moves depends on the size of the marks."""
    total = marks.agg(F.sum(F.size("marks")), F.count(F.lit(1))).first()
    small = (total[0] or 0) * 8 + total[1] * 64 <= MAX_BROADCAST_BYTES
    return docs.join(F.broadcast(marks) if small else marks.hint("merge"), "no", "left")


def _entries(docs: DataFrame, unclear: DataFrame, bits: int, length: int, width: int) -> DataFrame:
    """Content of the phrases to be compared: anchor, m, loc, n, trigger offset, bytes."""
    mask = (1 << bits) - 1
    lists = unclear.groupBy(F.shiftright("loc", bits).alias("no")).agg(F.collect_list(
        F.struct(F.col("loc").bitwiseAND(mask).alias("a"), "n", "anchor", "m")).alias("todo"))
    rows = docs.join(lists.hint("merge"), "no").select("no", "text", "todo")

    def run(batches):
        for batch in batches:
            todo = batch.column(2)
            fields = {f: todo.values.field(f).to_numpy() for f in ("a", "n", "anchor", "m")}
            bounds = todo.offsets.to_numpy()
            for i, no in enumerate(batch.column(0).to_pylist()):
                data = batch.column(1)[i].as_py().encode()
                x, y = bounds[i], bounds[i + 1]
                a, n = fields["a"][x:y], fields["n"][x:y]
                parts = [data[s:s + k + length - 1] for s, k in zip(a.tolist(), n.tolist())]
                buf, starts = joined(parts)
                grams = RangeHash(buf).grams(width)
                offset = _trigger_offsets(grams, starts, n, length, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fields["anchor"][x:y]), pa.array(fields["m"][x:y]),
                     pa.array((no << bits) + a), pa.array(n.astype(np.int32)),
                     pa.array(offset.astype(np.int32)), pa.array(parts, pa.binary())],
                    names=["anchor", "m", "loc", "n", "at", "bytes"])

    return rows.mapInArrow(trimmed(run), "anchor long, m long, loc long, n int, at int, bytes binary")


def _trigger_offsets(grams, starts, n, length, width) -> np.ndarray:
    """Place of the trigger in each phrase: the leftmost least hash all its strings hold."""
    spread = length - width + 1
    # All strings of a phrase hold the places n - 1 to spread - 1; the trigger is among them.
    counts = spread - n + 1
    first = np.cumsum(counts) - counts
    which = np.repeat(np.arange(len(n)), counts)
    off = np.arange(counts.sum()) - first[which] + (n - 1)[which]
    key = grams[starts[:-1][which] + off] & ~_PLACE
    least = np.minimum.reduceat(key, first)
    hits = np.flatnonzero(key == least[which])
    _, once = np.unique(which[hits], return_index=True)
    return off[hits[once]]


def _compare(entries: DataFrame, length: int) -> DataFrame:
    """Strings of a bucket's phrases that an earlier phrase of it holds: loc, n (a run)."""
    rows = (entries.select("anchor", "loc", "n", "at", "bytes")
            .repartition("anchor").sortWithinPartitions("anchor", "loc"))

    def bucket(group, locs, runs):
        seen = []
        for loc, n, at, data in group:
            left, right = data[:at], data[at:]
            x = int.from_bytes(left.rjust(2 * length, b"\0"), "big")
            y = int.from_bytes(right.ljust(2 * length, b"\0"), "big")
            marks = 0
            for l2, r2, x2, y2 in seen:
                d = y ^ y2
                rext = min(2 * length - (d.bit_length() + 7) // 8, len(right), r2)
                d = x ^ x2
                lext = ((d & -d).bit_length() - 1) // 8 if d else 2 * length
                lext = min(lext, at, l2)
                lo, hi = max(0, at - lext), min(n - 1, at - length + rext)
                if lo <= hi:
                    marks |= (1 << (hi + 1)) - (1 << lo)
            seen.append((at, len(right), x, y))
            i = 0
            while marks >> i:
                rest = marks >> i
                skip = (rest & -rest).bit_length() - 1
                rest >>= skip
                k = (~rest & (rest + 1)).bit_length() - 1
                locs.append(loc + i + skip)
                runs.append(k)
                i += skip + k

    def run(batches):
        key, group = None, []
        for batch in batches:
            locs, runs = [], []
            for anchor, *entry in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != key:
                    bucket(group, locs, runs)
                    key, group = anchor, []
                group.append(entry)
            yield pa.RecordBatch.from_arrays([pa.array(locs, pa.int64()), pa.array(runs, pa.int64())],
                                             names=["loc", "n"])
        locs, runs = [], []
        bucket(group, locs, runs)
        yield pa.RecordBatch.from_arrays([pa.array(locs, pa.int64()), pa.array(runs, pa.int64())],
                                         names=["loc", "n"])

    return rows.mapInArrow(trimmed(run), "loc long, n long")


def _parts(entries: DataFrame, length: int) -> DataFrame:
    """Phrases in parts of ``STEP`` neighbouring strings, by distance to the trigger.

    ``core`` is the hash of the bytes that all strings of the part share; phrases
    of one trigger with different cores have no string of this part in common.
    ``whole`` is the hash of all its bytes.
    """

    def run(batches):
        for batch in batches:
            anchor, loc, n, at = (c.to_numpy() for c in batch.columns[:4])
            buf, starts = joined(batch.column(4).to_pylist())
            low, high = at - n + 1, at  # distances of the trigger from the strings' starts
            counts = high // STEP - low // STEP + 1
            which = np.repeat(np.arange(len(n)), counts)
            part = low[which] // STEP + np.arange(len(which)) - (np.cumsum(counts) - counts)[which]
            lo = np.maximum(low[which], part * STEP)
            hi = np.minimum(high[which], part * STEP + STEP - 1)
            x = starts[:-1][which] + at[which]
            ranges = RangeHash(buf)
            core = ranges.of(x - part * STEP, x + length - (part * STEP + STEP - 1))
            whole = ranges.of(x - hi, x + length - lo)
            core = mix(core + part.astype(U64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[which]), pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)),
                 pa.array(loc[which]), pa.array((at[which] - hi).astype(np.int32)),
                 pa.array((hi - lo + 1).astype(np.int32))],
                names=["anchor", "core", "whole", "loc", "skip", "k"])

    return entries.select("anchor", "loc", "n", "at", "bytes").mapInArrow(
        trimmed(run), "anchor long, core long, whole long, loc long, skip int, k int")


def _strings(entries: DataFrame, length: int) -> DataFrame:
    """The strings of the listed parts by 128-bit hash: h1, h2, loc."""

    def run(batches):
        for batch in batches:
            loc, data, lists = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2)
            buf, starts = joined(data)
            which = np.repeat(np.arange(len(loc)), np.diff(lists.offsets.to_numpy()))
            skip, k = (lists.values.field(f).to_numpy() for f in ("skip", "k"))
            row = np.repeat(np.arange(len(k)), k)
            off = skip[row] + np.arange(len(row)) - (np.cumsum(k) - k)[row]
            which = which[row]
            p = starts[:-1][which] + off
            keys = [RangeHash(buf, seed).of(p, p + length).view(np.int64) for seed in (1, 2)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(loc[which] + off)],
                                             names=["h1", "h2", "loc"])

    return entries.mapInArrow(trimmed(run), "h1 long, h2 long, loc long")


def _grouped(entries: DataFrame, length: int) -> DataFrame:
    """Strings of large buckets that an earlier phrase holds: loc, n (a run).

    Parts whose core is shared are equal as a whole (and all but the first start
    earlier too), or they give up their strings, which are grouped one by one.
    """
    parts = stored(_parts(entries, length), "parts")
    shared = (parts.groupBy("anchor", "core").agg(
        F.count(F.lit(1)).alias("c"), F.min("whole").alias("lo"), F.max("whole").alias("hi"),
        F.min("loc").alias("first")).filter("c > 1")
        .select("anchor", "core", "first", (F.col("lo") == F.col("hi")).alias("same")))
    both = stored(parts.join(shared, ["anchor", "core"])
                  .filter("not same or loc > first").select("loc", "skip", "k", "same"), "shared")
    equal = both.filter("same").select((F.col("loc") + F.col("skip")).alias("loc"),
                                       F.col("k").cast("long").alias("n"))
    todo = both.filter("not same").groupBy("loc").agg(F.collect_list(F.struct("skip", "k")).alias("todo"))
    strings = stored(_strings(entries.select("loc", "bytes").join(todo, "loc"), length), "strings")
    again = (strings.groupBy("h1", "h2").agg(F.min("loc").alias("first"), F.count(F.lit(1)).alias("c"))
             .filter("c > 1").drop("c"))
    later = (strings.join(again, ["h1", "h2"]).filter("loc > first")
             .select("loc", F.lit(1).cast("long").alias("n")))
    return equal.union(later)


def _marked(docs: DataFrame, bits: int, length: int, width: int, bucket: int) -> DataFrame:
    """Per document: runs of strings that start here first, and runs that do not although
    their phrase does; two numbers each, 2 * start + (1 if first) and end."""
    mask = (1 << bits) - 1
    dictionary = stored(_parse(docs, bits, length, width).groupBy("anchor", "unit")
                        .agg(F.min("loc").alias("loc"), F.min("n").alias("n"))
                        .select("anchor", "loc", "n"), "phrases")
    shared = dictionary.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    unclear = dictionary.join(shared, "anchor")
    entries = stored(_entries(docs, unclear, bits, length, width), "entries")
    held = _compare(entries.filter(F.col("m") <= bucket), length)
    held = held.union(_grouped(entries.filter(F.col("m") > bucket), length))
    held = held.select(
        F.shiftright("loc", bits).alias("no"), F.col("loc").bitwiseAND(mask).alias("a"),
        (F.col("loc").bitwiseAND(mask) + F.col("n")).alias("b"), F.lit(False).alias("first"))
    runs = _runs(dictionary, bits).withColumn("first", F.lit(True))
    mark = F.array((F.shiftleft("a", 1) + F.col("first").cast("long")).alias("x"), F.col("b"))
    return stored(runs.union(held).groupBy("no").agg(
        F.flatten(F.collect_list(mark)).alias("marks")), "marks")


def removed_spans(size: int, first: np.ndarray, held: np.ndarray, length: int) -> np.ndarray:
    """Byte ranges to remove, from runs of first starts and of starts held earlier ([a, b) rows)."""
    strings = size - length + 1
    if strings <= 0:
        return np.empty((0, 2), dtype=np.int64)
    first = first[np.argsort(first[:, 0], kind="stable")]
    a = np.append(0, first[:, 1])
    b = np.append(first[:, 0], strings)
    spans = np.concatenate([np.stack([a, b], axis=1)[a < b], held])
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    spans[:, 1] += length - 1
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), dtype=bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    s = np.flatnonzero(new)
    return np.stack([spans[s, 0], reach[np.append(s[1:], len(spans)) - 1]], axis=1)


def _spans_of(marks, i: int, size: int, length: int) -> np.ndarray:
    if not marks[0][i].is_valid:
        rows, first = np.empty((0, 2), dtype=np.int64), np.empty(0, dtype=bool)
    else:
        x, y = marks[1][i], marks[1][i + 1]
        rows, first = marks[2][x:y], marks[3][x:y]
    return removed_spans(size, rows[first], rows[~first], length)


def _marks_column(column):
    pairs = column.values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
    rows = np.stack([pairs[:, 0] >> 1, pairs[:, 1]], axis=1)
    return column, column.offsets.to_numpy() // 2, rows, (pairs[:, 0] & 1).astype(bool)


def _cut(data: bytes, spans: np.ndarray) -> bytes:
    at, out = 0, []
    for a, b in spans.tolist():
        out.append(data[at:a])
        at = b
    out.append(data[at:])
    return b"".join(out)


def _pruned(batch, text: int, marks: int, length: int):
    """For a few rows at a time: their range and, for each, its bytes, spans and kept bytes."""
    lists = _marks_column(batch.column(marks))
    texts = batch.column(text).cast(pa.binary()).to_pylist()
    for x, y in slices([len(t) for t in texts], 1_000_000):
        spans = [_spans_of(lists, i, len(texts[i]), length) for i in range(x, y)]
        yield x, y - x, [(t, s, _cut(t, s)) for t, s in zip(texts[x:y], spans)]


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, width: int = WIDTH, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans ([start, end) pairs)."""
    numbered, bits = _numbered(docs, id_col, text_col)
    marks = _marked(numbered, bits, length, width, bucket)
    rows = _with_marks(numbered, marks).select("doc_id", "text", "marks")
    schema = T.StructType([
        rows.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))])
    kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.list_(pa.int64()))]

    def run(batches):
        for batch in batches:
            for x, n, found in _pruned(batch, 1, 2, length):
                out = [[len(t) for t, _, _ in found], [len(t) - len(k) for t, _, k in found],
                       [len(s) for _, s, _ in found],
                       [hashlib.sha256(k).hexdigest() for _, _, k in found],
                       [s.tolist() for _, s, _ in found]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, n), *(pa.array(c, k) for c, k in zip(out, kinds))],
                    names=schema.names)

    return rows.mapInArrow(trimmed(run), schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = LENGTH, width: int = WIDTH, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; all rows and columns stay.

    A character that a cut leaves in part goes as a whole; a null text becomes empty.
    """
    numbered, bits = _numbered(docs, id_col, text_col, rest=True)
    marks = _marked(numbered, bits, length, width, bucket)
    rows = _with_marks(numbered, marks).select("rest", "text", "marks")
    schema = T.StructType([rows.schema["rest"], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            for x, n, found in _pruned(batch, 1, 2, length):
                texts = [(k if len(k) < len(t) else t).decode("utf-8", "ignore") for t, _, k in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, n), pa.array(texts, pa.string())], names=schema.names)

    cut = rows.mapInArrow(trimmed(run), schema)
    return cut.select(*(F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
                        for c in docs.columns))
