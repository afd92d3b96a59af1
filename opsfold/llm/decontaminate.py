"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel distance.

Texts are lower-cased and runs of white space become one space.  An item of n
characters may be matched with up to ``floor(error_rate * n)`` edits; cut into
one piece more than that, any such match holds at least one piece unchanged.
An automaton over all pieces finds the piece hits of a document in one pass,
and Myers' algorithm computes the exact distance around each of them.

Items are taken in blocks of bounded size, all documents against each block.

Cases: null or blank items match nothing; items shorter than ``whole_words_below``
match with the same share of edits, but only from word edge to word edge;
null and empty texts hold nothing; items with equal texts each get their rows;
repeated documents each get theirs; an empty table on either side gives no
matches; only id and text are read, and ``clean`` keeps all columns.
"""

from __future__ import annotations

import os
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR_RATE = 0.05
WHOLE_WORDS_BELOW = 20
BLOCK_CHARS = 2_000_000


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` consecutive pieces of nearly equal length, with their offsets."""
    n = budget + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return masks


def _myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring, and the end of the first such."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    get = masks.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def _whole_words(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit at an edge of the range goes on outside of it."""
    return not ((start > 0 and text[start - 1].isalnum() and text[start].isalnum())
                or (end < len(text) and text[end - 1].isalnum() and text[end].isalnum()))


def _edits(a: str, b: str) -> int:
    """Edit distance of two short strings."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _whole_match(text: str, item: str, k: int, starts: set[int]) -> tuple[int, int, int] | None:
    """Least (distance, start, end) of the matches around these starts that end at word edges."""
    ranges = {(a, b) for s in starts for a in range(max(0, s - k), min(len(text) - 1, s + k) + 1)
              for b in range(max(a + 1, a + len(item) - k), min(len(text), a + len(item) + k) + 1)}
    found = [(0 if text[a:b] == item else _edits(item, text[a:b]), a, b)
             for a, b in ranges if _whole_words(text, a, b)]
    return min((x for x in found if x[0] <= k), default=None)


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float,
                 whole_words_below: int = WHOLE_WORDS_BELOW):
        import ahocorasick

        self.items, self.whole_words_below = items, whole_words_below
        self.budgets = [int(error_rate * len(t)) for _, t in items]
        self.masks = [(_masks(t), _masks(t[::-1])) for _, t in items]
        places = defaultdict(list)
        for i, (_, t) in enumerate(items):
            for offset, piece in pieces(t, self.budgets[i]):
                places[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, start, end) of the best match of each item found."""
        if self.empty or not text:
            return []
        spots = defaultdict(set)
        for end, (length, at) in self.automaton.iter(text):
            for i, offset in at:
                spots[i].add(end + 1 - length - offset)
        out = []
        for i, starts in spots.items():
            item, k = self.items[i][1], self.budgets[i]
            if len(item) < self.whole_words_below:
                whole = _whole_match(text, item, k, starts)
                if whole:
                    out.append((i, *whole))
                continue
            windows: list[list[int]] = []
            for s in sorted(starts):
                a, b = max(0, s - k), min(len(text), s + len(item) + k)
                if windows and a <= windows[-1][1]:
                    windows[-1][1] = max(windows[-1][1], b)
                else:
                    windows.append([a, b])
            best = None
            for a, b in windows:
                distance, end = _myers(self.masks[i][0], len(item), text[a:b])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, a, a + end)
            if best:
                distance, a, end = best
                _, back = _myers(self.masks[i][1], len(item), text[a:end][::-1])
                out.append((i, distance, end - back, end))
        return out


_matchers: dict[tuple, Matcher] = {}


def _matcher(items: list[tuple[object, str]], error_rate: float, whole_words_below: int) -> Matcher:
    """One matcher per worker process: that of the block it works on."""
    key = (os.getpid(), error_rate, whole_words_below, hash(tuple(items)))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(items, error_rate, whole_words_below)
    return _matchers[key]


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_chars: int = BLOCK_CHARS):
    """The items, normalised, as lists of about ``block_chars`` characters in all."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for b in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        items = [(r["id"], normalized(r["text"])) for r in mine.collect()]
        yield [(i, t) for i, t in items if t]


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE,
            whole_words_below: int = WHOLE_WORDS_BELOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, distance, start, end.

    ``start`` and ``end`` are characters of the normalised text.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        source.schema["doc_id"],
        T.StructField("item_id", benchmark.schema[item_col].dataType),
        *(T.StructField(c, T.IntegerType()) for c in ("distance", "start", "end"))])

    def against(items):
        def run(batches):
            matcher = _matcher(items, error_rate, whole_words_below)
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(batch.column(1)):
                    hits = matcher.find(normalized(text.as_py()))
                    rows += [i] * len(hits)
                    found += hits
                columns = list(zip(*found)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())),
                     pa.array([items[i][0] for i in columns[0]], item_type),
                     *(pa.array(c, pa.int32()) for c in columns[1:])], names=schema.names)
        return source.mapInArrow(run, schema)

    item_type = _arrow_type(schema["item_id"].dataType)
    out = None
    for items in item_blocks(benchmark, item_col, item_text, block_chars):
        found = against(items)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", error_rate: float = ERROR_RATE, whole_words_below: int = WHOLE_WORDS_BELOW,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold an item; nothing is shuffled."""
    at = docs.columns.index(text_col)

    def without(df, items):
        def run(batches):
            matcher = _matcher(items, error_rate, whole_words_below)
            for batch in batches:
                keep = [not matcher.find(normalized(t.as_py())) for t in batch.column(at)]
                yield batch.filter(pa.array(keep, pa.bool_()))
        return df.mapInArrow(run, df.schema)

    for items in item_blocks(benchmark, item_col, item_text, block_chars):
        docs = without(docs, items)
    return docs


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
