"""Token counts that follow edits: only what an edit touches is encoded again.

A document is cut into segments at places where a pre-token must begin: a space
or newline between two non-blank characters.  Token counts of segments do not
depend on each other, so a segment tree over them, with sums of characters and
tokens, gives the document's count at its root.  An edit replaces the segments
it touches, together with neighbours whose boundary it may have moved, encodes
these anew and updates the sums above them.

Trees are kept: ``count_trees`` writes one row per document with its text and the
sums of its segments; ``edited_trees`` joins a table of edits to it and returns
the trees that these change; ``updated`` puts them in the place of the old ones,
ready for the next edits.  The sums above the segments follow from theirs when a
row is read; nothing is encoded for that.

Cases: a null or empty text has no tokens; texts with any white space work (a
stretch without a safe boundary is one segment); edits outside the text are an
error, and so are edits of one batch that overlap; edits of documents that are
not there do nothing; repeated rows each have their tree and get the edits of their
id; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.config import fits
from opsfold.llm.frames import stored, text_or_empty, trimmed
from opsfold.llm.hashing import slices
from opsfold.llm.tokens import BLANK, PieceEncoder, default_tokenizer, encoder

_BOUNDARY = re.compile(f"(?<=[^{BLANK}])(?=[ \n][^{BLANK}])")
SLICE_CHARS = 1_000_000
CACHE_PIECES = 400_000
# Broadcast of at most this many bytes of edits or ids; beyond it, shuffle joins.
MAX_BROADCAST_BYTES = 16_000_000
_IS_BLANK = re.compile(f"[{BLANK}]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}")


def segments(text: str) -> list[str]:
    """Parts of the text whose token counts add up."""
    return [s for s in _BOUNDARY.split(text) if s]


def _joins_safely(left: str, right: str) -> bool:
    return (len(right) > 1 and right[0] in " \n" and not _IS_BLANK.match(right[1])
            and bool(left) and not _IS_BLANK.match(left[-1]))


class CountTree:
    """A document's segments with a tree of (characters, tokens) sums."""

    def __init__(self, text: str, enc: PieceEncoder):
        parts = segments(text) or [""]
        self._build(parts, np.fromiter(map(len, parts), np.int64, len(parts)), enc.counts(parts), enc)

    @classmethod
    def of_leaves(cls, text: str, chars: np.ndarray, tokens: np.ndarray, enc: PieceEncoder) -> CountTree:
        """A kept tree: its segments' characters and tokens are known."""
        ends = np.cumsum(chars).tolist()
        tree = cls.__new__(cls)
        tree._build([text[a:b] for a, b in zip([0, *ends], ends)] or [""],
                    chars if len(ends) else [0], tokens if len(ends) else [0], enc)
        return tree

    def _build(self, parts: list[str], chars, tokens, enc: PieceEncoder) -> None:
        self.enc, self.parts = enc, parts
        self.encoded = 0  # segments encoded after the first time
        n = len(parts)
        self.size = 1 << (n - 1).bit_length()
        self.chars = np.zeros(2 * self.size, dtype=np.int64)
        self.tokens = np.zeros(2 * self.size, dtype=np.int64)
        self.chars[self.size:self.size + n] = chars
        self.tokens[self.size:self.size + n] = tokens
        for sums in (self.chars, self.tokens):
            level = self.size
            while level > 1:
                sums[level // 2:level] = sums[level:2 * level].reshape(-1, 2).sum(axis=1)
                level //= 2

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the segments that are not empty."""
        chars, tokens = (x[self.size:self.size + len(self.parts)] for x in (self.chars, self.tokens))
        return chars[chars > 0], tokens[chars > 0]

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def text(self) -> str:
        return "".join(self.parts)

    def _leaf(self, char: int) -> tuple[int, int]:
        """The segment that holds this character (or, at the end, the last one), and its start."""
        at, begin = 1, 0
        while at < self.size:
            at *= 2
            if char - begin >= self.chars[at] and self.chars[at + 1]:
                begin += int(self.chars[at])
                at += 1
        return at - self.size, begin

    def _set(self, leaf: int, part: str, tokens: int) -> None:
        self.parts[leaf] = part
        at = leaf + self.size
        dc, dt = len(part) - self.chars[at], tokens - self.tokens[at]
        while at:
            self.chars[at] += dc
            self.tokens[at] += dt
            at //= 2

    def _neighbour(self, leaf: int, step: int) -> int | None:
        leaf += step
        while 0 <= leaf < len(self.parts):
            if self.parts[leaf]:
                return leaf
            leaf += step
        return None

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters ``[start, end)`` of the current text."""
        if not 0 <= start <= end <= self.chars[1]:
            raise ValueError(f"edit [{start}, {end}) outside the text")
        first, begin = self._leaf(start)
        last, last_begin = self._leaf(max(end - 1, start))
        head = self.parts[first][:start - begin]
        tail = self.parts[last][end - last_begin:]
        touched = {first, last, *range(first, last + 1)}
        region = head + replacement + tail
        while (left := self._neighbour(min(touched), -1)) is not None:
            if _joins_safely(self.parts[left], region):
                break
            region = self.parts[left] + region
            touched.add(left)
        while (right := self._neighbour(max(touched), 1)) is not None:
            if _joins_safely(region, self.parts[right]):
                break
            region += self.parts[right]
            touched.add(right)
        fresh = segments(region)
        self.encoded += len(fresh)
        leaf = min(touched)
        for other in touched - {leaf}:
            if self.parts[other]:
                self._set(other, "", 0)
        self._set(leaf, region, sum(self.enc.counts(fresh)))


def repeated_line_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that remove lines equal to an earlier one, each with the line end before it."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return []
    edits, seen, at = [], set(), 0
    for line in lines:
        end = at + len(line)
        if line.strip() and line in seen:
            edits.append((at - 1, end, ""))
        seen.add(line)
        at = end + 1
    return edits


def mask_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that mask mail addresses and phone numbers."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "<email>") for m in _EMAIL.finditer(text)]
    if "+" in text:
        found += [(m.start(), m.end(), "<phone>") for m in _PHONE.finditer(text)]
    return sorted(found)


def _int_lists(values: np.ndarray, sizes: list[int]) -> pa.ListArray:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _leaves(texts: list[str], enc: PieceEncoder) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Characters and tokens of the segments of each text.

    The segments of a text made of safe pieces are these: one begins at each space and newline.
    """
    chars, tokens = [], enc.piece_counts(texts)
    for i, text in enumerate(texts):
        if tokens[i] is None:
            parts = segments(text)
            chars.append(np.fromiter(map(len, parts), np.int32, len(parts)))
            tokens[i] = np.array(enc.counts(parts), dtype=np.int32)
        elif text:
            codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            chars.append(np.diff(np.flatnonzero((codes == 32) | (codes == 10)),
                                 prepend=0, append=len(codes)).astype(np.int32))
        else:
            chars.append(np.empty(0, dtype=np.int32))
    return chars, tokens


def count_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                tokenizer: str | None = None) -> DataFrame:
    """The kept table of trees: tree (a number), doc_id, text, chars and tokens of its segments."""
    path = tokenizer or default_tokenizer()
    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([source.schema["doc_id"], T.StructField("text", T.StringType()),
                           T.StructField("chars", ints), T.StructField("tokens", ints)])

    def run(batches):
        enc = encoder(path, CACHE_PIECES)
        for batch in batches:
            sizes = pa.compute.utf8_length(batch.column(1)).to_pylist()
            for a, b in slices(sizes, SLICE_CHARS):
                mine = batch.slice(a, b - a)
                chars, tokens = _leaves(mine.column(1).to_pylist(), enc)
                lengths = list(map(len, chars))
                yield pa.RecordBatch.from_arrays(
                    [*mine.columns, _int_lists(np.concatenate(chars), lengths),
                     _int_lists(np.concatenate(tokens), lengths)],
                    names=schema.names)

    trees = source.mapInArrow(trimmed(run), schema)
    return stored(trees.select(F.monotonically_increasing_id().alias("tree"), "*"), "trees", "zstd")


def found_edits(trees: DataFrame, find: Callable[[str], list[tuple[int, int, str]]]) -> DataFrame:
    """A table of the edits that ``find`` makes in each tree's text: tree, start, end, replacement."""
    def run(batches):
        for batch in batches:
            rows, edits = [], []
            for i, text in enumerate(batch.column(1)):
                mine = find(text.as_py())
                rows += [i] * len(mine)
                edits += mine
            starts, ends, new = zip(*edits) if edits else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int32()),
                 pa.array(ends, pa.int32()), pa.array(new, pa.string())],
                names=["tree", "start", "end", "replacement"])

    return stored(trees.select("tree", "text").mapInArrow(
        trimmed(run), "tree long, start int, end int, replacement string"), "edits")


def edited_trees(trees: DataFrame, edits: DataFrame, on: str = "tree",
                 tokenizer: str | None = None) -> DataFrame:
    """The trees that a table of edits changes, after it, with n_edits and n_encoded_again.

    ``edits`` has the column ``on`` (``tree`` or ``doc_id``), start, end and replacement (null:
    nothing); places are characters of the text before the batch.  Only the edits' bytes decide
    whether they are broadcast; a document's own edits come together in its row.
    """
    path = tokenizer or default_tokenizer()
    key = F.struct("start", "end", F.coalesce("replacement", F.lit("")).alias("replacement"))
    mine = edits.groupBy(F.col(on).alias("__of")).agg(F.array_sort(F.collect_list(key)).alias("__edits"))
    mine = F.broadcast(mine) if fits(edits, MAX_BROADCAST_BYTES) else mine
    names = ["tree", "doc_id", "text", "chars", "tokens"]
    todo = trees.select(*names).join(mine, F.col(on).eqNullSafe(F.col("__of"))).select(
        *names, F.col("__edits.start").alias("a"), F.col("__edits.end").alias("b"),
        F.col("__edits.replacement").alias("new"))
    schema = T.StructType([*trees.select(*names).schema, T.StructField("n_edits", T.LongType()),
                           T.StructField("n_encoded_again", T.LongType())])

    def run(batches):
        enc = encoder(path, CACHE_PIECES)
        for batch in batches:
            chars, tokens, starts, ends, news = (
                batch.column(i) for i in range(3, 8))
            texts, sums, counts, n_edits, encoded = [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                tree = CountTree.of_leaves(text.as_py(), chars[i].values.to_numpy(),
                                           tokens[i].values.to_numpy(), enc)
                batch_edits = list(zip(starts[i].as_py(), ends[i].as_py(), news[i].as_py()))
                if any(e[1] > f[0] for e, f in zip(batch_edits, batch_edits[1:])):
                    raise ValueError("edits of one batch overlap")
                for a, b, new in reversed(batch_edits):  # places before an edit stay as they are
                    tree.edit(a, b, new)
                texts.append(tree.text())
                c, t = tree.leaves()
                sums.append(c)
                counts.append(t)
                n_edits.append(len(batch_edits))
                encoded.append(tree.encoded)
            lengths = [len(c) for c in sums]
            none = [np.empty(0, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 _int_lists(np.concatenate(sums or none), lengths),
                 _int_lists(np.concatenate(counts or none), lengths),
                 pa.array(n_edits, pa.int64()), pa.array(encoded, pa.int64())],
                names=schema.names)

    return stored(todo.mapInArrow(trimmed(run), schema), "trees", "zstd")


def updated(trees: DataFrame, changed: DataFrame) -> DataFrame:
    """``trees`` with the changed ones in their places; only these were written anew."""
    ids = changed.select("tree")
    ids = F.broadcast(ids) if fits(ids, MAX_BROADCAST_BYTES) else ids
    return trees.join(ids, "tree", "left_anti").unionByName(changed.select(*trees.columns))


ROUNDS = (repeated_line_edits, mask_edits)


def edited_counts(docs: DataFrame,
                  rounds: Sequence[Callable[[str], list[tuple[int, int, str]]]] = ROUNDS,
                  id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str | None = None) -> DataFrame:
    """One row per document: tokens before and after rounds of edits, and what was encoded for them.

    Each round's edits are written as a table and applied to the kept trees; the next round
    finds its edits in the texts that are there then.  Counts come from the trees.
    """
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    first = trees = count_trees(docs, id_col, text_col, tokenizer)
    parts = []
    for number, find in enumerate(rounds):
        changed = edited_trees(trees, found_edits(trees, find), "tree", tokenizer)
        trees = updated(trees, changed)
        parts.append(changed.select(
            "tree", F.struct(F.lit(number).alias("round"), total("tokens").alias("tokens"),
                             total("chars").alias("chars")).alias("last"),
            "n_edits", "n_encoded_again"))
    before = first.select("tree", "doc_id", total("tokens").alias("n_tokens"),
                          F.size("chars").cast("long").alias("n_segments"), total("chars").alias("n_chars"))
    if not parts:
        after = before.sparkSession.createDataFrame(
            [], "tree long, last struct<tokens: long, chars: long>, n_edits long, n_encoded_again long")
    else:
        after = parts[0]
        for part in parts[1:]:
            after = after.unionByName(part)
        after = after.groupBy("tree").agg(F.max("last").alias("last"), F.sum("n_edits").alias("n_edits"),
                                          F.sum("n_encoded_again").alias("n_encoded_again"))
    return before.join(after, "tree", "left").select(
        "doc_id", "n_tokens", "n_segments", F.coalesce("n_edits", F.lit(0)).alias("n_edits"),
        F.coalesce("last.tokens", "n_tokens").alias("n_tokens_after"),
        F.coalesce("last.chars", "n_chars").alias("n_chars_after"),
        F.coalesce("n_encoded_again", F.lit(0)).alias("n_encoded_again"))
