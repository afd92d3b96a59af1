"""Cross-tokenizer alignment by interval coalescing, with corpus-wide link counts.

Two tokenizers cut the same bytes (a space and the text) into tokens: A is a byte-level BPE, B a
piece model with byte fallback that adds the space by itself.  The tokens of many texts lie end to
end on one line of bytes.  All A and B tokens are sorted by start; the running maximum of their ends
tells where a start reaches it, and there a group of tokens ends.  Within a group, each distinct
start begins one overlap of an A with a B token, which is a link.

Each document keeps its links as distinct (A id, B id) pairs with their numbers.  Their sums over
the corpus come from partial aggregates; the table of pairs goes to the documents by broadcast, in
blocks of at most ``MAX_PAIRS`` pairs, one pass over the stored pairs for each block.

Long texts are cut at single spaces between two other characters, which neither tokenizer joins
across (checked against the piece model's vocabulary when it is loaded), so that what a task holds
stays small whatever the length of a text.

Cases: null and empty texts, and texts whose A or B bytes differ from the space and the text (for
instance with U+2581, or an unknown piece), have no tokens: all numbers are 0 and the digest is '';
strings of special tokens in a text are plain text; repeated rows are documents of their own and
their links count each time; ids may be null or repeat; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.frames import stored
from opsfold.llm.hashing import slices
from opsfold.llm.tokens import PieceEncoder, default_tokenizer

CHUNK = 100_000
SLICE = 500_000
MAX_PAIRS = 1_000_000
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_IN_PART = 33
_encoders: dict[tuple, object] = {}


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print bytes that are no visible Latin-1 character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes and decimal digits of each token id, in flat arrays."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        digits = [str(i).encode() for i in range(len(tokens))]
        self.n_digits = np.array([len(d) for d in digits], dtype=np.int64)
        width = int(self.n_digits.max())
        self.digits = np.frombuffer(b"".join(d.ljust(width) for d in digits),
                                    dtype=np.uint8).reshape(len(tokens), width)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens one after the other."""
        n = self.length[ids]
        ends = np.cumsum(n)
        return self.data[np.repeat(self.begin[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


class ByteTokens:
    """Tokenizer A: ids of a space and a text, with a cache of pieces."""

    def __init__(self, path: str):
        self.encoder = PieceEncoder(path)
        library = self.encoder.library
        library.encode_special_tokens = True  # their strings in texts are plain text
        byte = _byte_of_char()
        added = library.get_added_tokens_decoder()
        self.vocabulary = Vocabulary([
            added[i].content.encode() if i in added
            else bytes(byte[c] for c in library.id_to_token(i) or "")
            for i in range(library.get_vocab_size())])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        e = self.encoder
        if e.cached:
            if len(e.young) > e.max_entries:
                e.old, e.young = e.young, {}
            # Each piece is led by the space that it was cut at, or by its newline.
            split = [(" " + t).replace("\n", " \n").split(" ")[1:] for t in texts]
            e.learn(set().union(*split))
        out = []
        for i, t in enumerate(texts):
            try:
                data = b"".join(map(e.young.__getitem__, split[i])) if e.cached else None
            except TypeError:  # a piece that cannot be encoded by itself
                data = None
            if data is None:
                data = e._whole([" " + t])[0]
            out.append(np.frombuffer(data, dtype="<u4"))
        return out


class PieceTokens:
    """Tokenizer B: ids of a text; the model adds the space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.vocabulary = Vocabulary([
            bytes([int(s[3:-1], 16)]) if self.model.is_byte(i) else s.replace("▁", " ").encode()
            for i, s in enumerate(names)])
        #: No piece holds a space after another character, so none crosses a cut at a space.
        self.cuts_at_spaces = not any("▁" in s.lstrip("▁") for s in names)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids = self.model.encode(texts, num_threads=1)
        sizes = [len(x) for x in ids]
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=sum(sizes))
        return np.split(flat, np.cumsum(sizes)[:-1]) if sizes else []


def tokenizers(byte_path: str, piece_path: str) -> tuple[ByteTokens, PieceTokens]:
    """One pair of tokenizers per worker process."""
    key = (byte_path, piece_path, os.getpid())
    if key not in _encoders:
        _encoders[key] = ByteTokens(byte_path), PieceTokens(piece_path)
    return _encoders[key]


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """``text`` cut at single spaces between other characters; joined by spaces it is whole again."""
    out, begin = [], 0
    while len(text) - begin > size:
        cut = text.find(" ", begin + size)
        while cut >= 0 and (text[cut - 1:cut].isspace() or text[cut + 1:cut + 2].isspace()
                            or cut + 1 == len(text)):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        out.append(text[begin:cut])
        begin = cut + 1
    out.append(text[begin:])
    return out


def _flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return (np.concatenate(parts) if len(parts) else np.zeros(0)).astype(np.int64), sizes


def _valid(data: list[bytes], ids: list[np.ndarray], vocabulary: Vocabulary) -> np.ndarray:
    """Which texts their tokens spell out exactly."""
    flat, sizes = _flat(ids)
    total = np.bincount(np.repeat(np.arange(len(ids)), sizes), weights=vocabulary.length[flat],
                        minlength=len(ids)).astype(np.int64)
    same = total == np.array([len(d) for d in data])
    begin = np.concatenate([[0], np.cumsum(total)])
    spelled = vocabulary.joined(flat).tobytes()
    if spelled == b"".join(data):
        return same
    return same & np.array([spelled[a:b] == d for a, b, d in zip(begin, begin[1:], data)], dtype=bool)


class Aligned:
    """Groups and links of texts that both tokenizers spell out.

    ``a`` and ``b`` hold the ids of all texts, ``n_a`` and ``n_b`` their numbers per text.
    """

    def __init__(self, a, n_a, b, n_b, voc_a: Vocabulary, voc_b: Vocabulary):
        self.a, self.b, self.voc_a, self.voc_b = a, b, voc_a, voc_b
        self.n_a, self.n_b = n_a, n_b
        length = np.concatenate([voc_a.length[a], voc_b.length[b]])
        end = np.concatenate([np.cumsum(length[:len(a)]), np.cumsum(length[len(a):])])
        start = end - length
        is_a = np.arange(len(start)) < len(a)
        order = np.lexsort((~is_a, start))
        s, e, from_a = start[order], end[order], is_a[order]
        reach = np.maximum.accumulate(e)
        breaks = np.ones(len(s), dtype=bool)
        breaks[1:] = s[1:] >= reach[:-1]
        group = np.empty(len(s), dtype=np.int64)
        group[order] = np.cumsum(breaks) - 1
        self.group_a, self.group_b = group[:len(a)], group[len(a):]
        # The last token at each distinct start: by then the A and the B token that overlap have begun.
        last = np.ones(len(s), dtype=bool)
        last[:-1] = s[1:] != s[:-1]
        seen_a = np.cumsum(from_a)
        self.link_a = seen_a[last] - 1
        self.link_b = (np.arange(1, len(s) + 1) - seen_a)[last] - 1
        text_a = np.repeat(np.arange(len(n_a)), n_a)
        self.link_text = text_a[self.link_a]
        first = np.ones(len(a), dtype=bool)
        first[1:] = self.group_a[1:] != self.group_a[:-1]
        self.n_groups = np.bincount(text_a[first], minlength=len(n_a))
        self.n_links = np.bincount(self.link_text, minlength=len(n_a))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, number) of each text's distinct linked id pairs; pair = A id * |B| + B id."""
        pair = self.a[self.link_a] * self.voc_b.size + self.b[self.link_b]
        span = self.voc_a.size * self.voc_b.size
        key, n = np.unique(self.link_text * span + pair, return_counts=True)
        return key // span, key % span, n

    def written(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        ids = np.concatenate([self.a, self.b])
        from_b = np.arange(len(ids)) >= len(self.a)
        group = np.concatenate([self.group_a, self.group_b])
        order = np.argsort(2 * group + from_b, kind="stable")
        from_b, group, ids = from_b[order], group[order], ids[order]
        before = np.full(len(ids), ord(","), dtype=np.uint8)
        before[1:][from_b[1:] & ~from_b[:-1]] = ord("|")
        before[np.flatnonzero(np.diff(group, prepend=-1))] = ord(";")
        n = np.empty(len(ids), dtype=np.int64)
        n[~from_b], n[from_b] = self.voc_a.n_digits[ids[~from_b]], self.voc_b.n_digits[ids[from_b]]
        ends = np.cumsum(n + 1)
        at = ends - n - 1
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
        out[at] = before
        for voc, mine in ((self.voc_a, ~from_b), (self.voc_b, from_b)):
            i, to, size = ids[mine], at[mine], n[mine]
            for k in range(voc.digits.shape[1]):
                has = size > k
                out[to[has] + 1 + k] = voc.digits[i[has], k]
        data = out.tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])]
        return [data[x + 1:y] for x, y in zip(cuts.tolist(), cuts[1:].tolist())]


def align_texts(texts: list[str | None], tools: tuple[ByteTokens, PieceTokens], chunk: int = CHUNK,
                size: int = SLICE) -> tuple[np.ndarray, list[str], tuple]:
    """Counts (n_a, n_b, n_groups, n_links) and digest per text, and (text, pair, number) arrays."""
    byte, piece = tools
    owner, parts = [], []
    for i, t in enumerate(texts):
        if t:
            cut = chunks(t, chunk) if piece.cuts_at_spaces else [t]
            parts += cut
            owner += [i] * len(cut)
    owner = np.array(owner, dtype=np.int64)
    counts = np.zeros((len(texts), 4), dtype=np.int64)
    good = np.ones(len(texts), dtype=bool)
    digests: dict[int, object] = {}
    found = []
    for x, y in slices([len(p) for p in parts], size):
        mine, of = parts[x:y], owner[x:y]
        data = [(" " + p).encode("utf-8", "replace") for p in mine]
        a, b = byte.encode(mine), piece.encode(mine)
        ok = _valid(data, a, byte.vocabulary) & _valid(data, b, piece.vocabulary)
        good[of[~ok]] = False
        keep = np.flatnonzero(ok)
        if not len(keep):
            continue
        of = of[keep]
        line = Aligned(*_flat([a[k] for k in keep]), *_flat([b[k] for k in keep]),
                       byte.vocabulary, piece.vocabulary)
        for c, n in enumerate((line.n_a, line.n_b, line.n_groups, line.n_links)):
            np.add.at(counts[:, c], of, n)
        for i, groups in zip(of.tolist(), line.written(), strict=True):
            if i in digests:
                digests[i].update(b";")
            else:
                digests[i] = hashlib.sha256()
            digests[i].update(groups)
        text, pair, n = line.pairs()
        found.append((of[text], pair, n))
    counts[~good] = 0
    digest = [digests[i].hexdigest() if i in digests and good[i] else "" for i in range(len(texts))]
    text, pair, n = (np.concatenate(c) for c in zip(*found, strict=True)) if found \
        else (np.zeros(0, np.int64),) * 3
    keep = good[text]
    return counts, digest, (text[keep], pair[keep], n[keep])


def aligned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      byte_tokenizer: str | None = None, piece_tokenizer: str | None = None) -> DataFrame:
    """One stored row per document: its counts, its digest, its pairs and their numbers."""
    paths = byte_tokenizer or default_tokenizer(), piece_tokenizer or default_pieces()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), source.schema["doc_id"]]
                          + [T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField("groups_sha256", T.StringType()),
                             T.StructField("pairs", T.ArrayType(T.LongType())),
                             T.StructField("numbers", T.ArrayType(T.LongType()))])

    def run(batches):
        tools = tokenizers(*paths)
        row = TaskContext.get().partitionId() << _IN_PART
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.utf8_length(batch.column(1)), 0).to_pylist()
            for a, b in slices(sizes, 8 * SLICE):
                part = batch.slice(a, b - a)
                counts, digest, (text, pair, n) = align_texts(part.column(1).to_pylist(), tools)
                order = np.argsort(text, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=b - a))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v[order])) for v in (pair, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + b - a)), part.column(0),
                     *(pa.array(counts[:, c].copy()) for c in range(4)), pa.array(digest, pa.string()), *lists],
                    names=schema.names)
                row += b - a

    return stored(source.mapInArrow(run, schema), "aligned")


def _links(rows: DataFrame) -> DataFrame:
    zipped = rows.select("row", F.explode(F.arrays_zip("pairs", "numbers")).alias("x"))
    return zipped.select("row", F.col("x.pairs").alias("pair"), F.col("x.numbers").alias("n"))


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best): links of each id pair over all documents; best of its B id or not."""
    counts = _links(rows).groupBy("pair").agg(F.sum("n").alias("count"))
    of_b = Window.partitionBy(F.pmod("pair", F.lit(b_size)))  # at most one row per A id
    return stored(counts.withColumn("best", F.col("count") == F.max("count").over(of_b)), "pairs")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          byte_tokenizer: str | None = None, piece_tokenizer: str | None = None,
          max_pairs: int = MAX_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = byte_tokenizer or default_tokenizer(), piece_tokenizer or default_pieces()
    rows = aligned_documents(docs, id_col, text_col, *paths)
    counts = pair_counts(rows, tokenizers(*paths)[1].vocabulary.size)
    blocks = max(1, -(-counts.count() // max_pairs))
    sums = []
    for k in range(blocks):
        # A block has about ``max_pairs`` rows of 17 bytes; documents' links do not move.
        block = counts if blocks == 1 else counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k)
        met = _links(rows).join(F.broadcast(block), "pair")
        part = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"),
                                      F.sum(F.col("n") * F.col("count")).alias("count_sum"))
        sums.append(part if blocks == 1 else stored(part, "sums"))
    total = sums[0]
    for part in sums[1:]:
        total = total.unionByName(part)
    if blocks > 1:
        total = total.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (rows.select("row", "doc_id", *COUNTS, "groups_sha256").join(total, "row", "left")
            .select("doc_id", *COUNTS, zero("n_best"), zero("count_sum"), "groups_sha256"))
