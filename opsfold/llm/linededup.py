"""Line deduplication across documents with keep bitmaps, in DataFrame functions only.

A line's key is the line without blanks (space, U+0009 to U+000D) at both ends and with A-Z
lower-cased; two 64-bit hashes stand for it.  The hashes of all lines are range-partitioned by
(hash, document part) and sorted by document and position within each key, so that one pass over
each sorted partition meets the first line of a key, and of each document that holds it.  Because
the range is cut by document parts too, a key that a third of all lines share spreads over many
partitions; what a partition knows of a key is one row per (key, document part), which are added
up per key: at most ``PARTS`` rows each, whatever the number of lines.

What comes back is no text but one keep bitmap per document, in run-length form: the runs
(start, length) of lines that stay.  ``without_repeated_lines`` and ``line_digests`` put it to use.

``keep`` says which lines of a frequent key (found in at least ``min_docs`` documents) stay:
``none`` of them, or the ``first`` in the order of document id, then text hash, then position.

Cases: a null or empty text is one empty line; keys of fewer than ``min_chars`` code points always
stay; repeated rows count as documents of their own, but rows with equal id and text share one
bitmap (so their first lines all stay with ``keep="first"``); null ids sort first; a text whose
lines all go becomes empty; an empty table gives an empty result; other columns, whatever their
names, are carried along or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsfold.llm.frames import stored, text_or_empty

MIN_CHARS = 1
MIN_DOCS = 10
PARTS = 4096
# Rows of one range partition; a row holds hashes, an id and a position, about 44 bytes.
ROWS_PER_PARTITION = 4_000_000
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC, KEY = ["doc_id", "t1", "t2"], ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without outer blanks, A-Z lower-cased (other letters stay as they are)."""
    bare = F.btrim(line, F.lit(BLANKS))
    # ``lower`` is much faster, and the same where all characters are ASCII.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, LOWER))


def _two_hashes(value: Column, names: list[str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a key of ``min_chars``: document, key hashes, position from 0."""
    text = text_or_empty(text_col)
    lines = docs.select(F.col(id_col).alias("doc_id"), *_two_hashes(text, DOC[1:]),
                        F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keyed = lines.select(*DOC, "pos", line_key(F.col("line")).alias("line"))
    return (keyed.where(F.length("line") >= min_chars)
            .select(*DOC, "pos", *_two_hashes(F.col("line"), KEY),
                    F.pmod("t1", F.lit(PARTS)).cast("int").alias("part")))


def _in_key_order(rows: DataFrame) -> DataFrame:
    """Range partitions by (hash, part); the windows below need no other shuffle."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(n, -(-rows.count() // ROWS_PER_PARTITION))
    return rows.repartitionByRange(n, *KEY, "part")


def first_lines(rows: DataFrame) -> DataFrame:
    """Per (key, part): documents that hold the key, and its first line there.

    One sort by (key, part, document, position) serves the windows and the aggregate.
    """
    of_document = Window.partitionBy(*KEY, "part", *DOC).orderBy("pos")
    streamed = _in_key_order(rows).withColumn("first", F.rank().over(of_document) == 1)
    return (streamed.where("first").groupBy(*KEY, "part")
            .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct(*DOC, "pos")).alias("first")))


def frequent_parts(rows: DataFrame, min_docs: int) -> DataFrame:
    """(key, part) of the keys in at least ``min_docs`` documents, with the key's first line."""
    of_key = Window.partitionBy(*KEY)
    parts = first_lines(rows).withColumns({
        "docs": F.sum("docs").over(of_key), "first": F.min("first").over(of_key)})
    return parts.where(F.col("docs") >= min_docs).select(*KEY, "part", "docs", "first")


def _runs(dropped: Column, n_lines: Column) -> Column:
    """Runs of lines that stay, from the sorted positions of those that go."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(n_lines))
    runs = F.zip_with(before, after, lambda a, b: F.struct(
        (a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  keep: str = "none") -> DataFrame:
    """Documents that lose lines: doc_id, two hashes of the text, sorted positions."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', got {keep!r}")
    rows = stored(line_rows(docs, id_col, text_col, min_chars), "lines")
    frequent = frequent_parts(rows, min_docs)
    # The key's parts share its lines out evenly, so this join has no hot key.
    found = rows.join(frequent, [*KEY, "part"])
    if keep == "first":
        found = found.where(~F.struct(*DOC, "pos").eqNullSafe(F.col("first")))
    return found.groupBy(*DOC).agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def _with_bitmaps(docs: DataFrame, id_col: str, text_col: str, payload: Column,
                  **options) -> DataFrame:
    """``row`` (payload), ``text``, ``lines``, ``dropped`` (null: none) of each document."""
    text = text_or_empty(text_col)
    base = docs.select(payload.alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"),
                       *_two_hashes(text, DOC[1:]))
    gone = dropped_lines(docs, id_col, text_col, **options)
    gone = gone.select(*[F.col(c).alias(f"of_{c}") for c in DOC], "dropped")
    same = (base["t1"] == gone["of_t1"]) & (base["t2"] == gone["of_t2"]) \
        & base["doc_id"].eqNullSafe(gone["of_doc_id"])
    joined = base.join(gone.hint("merge"), same, "left").select("row", "doc_id", "text", "dropped")
    return joined.withColumn("lines", F.split("text", "\n"))


def _kept_text() -> Column:
    runs = _runs(F.col("dropped"), F.size("lines"))
    kept = F.flatten(F.transform(runs, lambda r: F.slice(F.col("lines"), r["start"] + 1,
                                                         r["length"])))
    return F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, keep_runs (the lines that stay).

    ``keep_runs`` is the bitmap in run-length form, an array of (start, length); it is one run
    for a document that keeps all its lines, and empty for one that loses all.
    """
    found = _with_bitmaps(docs, id_col, text_col, F.lit(None).cast("int"), **options)
    n = F.size("lines")
    whole = F.array(F.struct(F.lit(0).alias("start"), n.alias("length")))
    return found.select("doc_id", n.cast("long").alias("n_lines"),
                        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                        F.when(F.col("dropped").isNull(), whole)
                        .otherwise(_runs(F.col("dropped"), n)).alias("keep_runs"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           **options) -> DataFrame:
    """``docs`` without the lines that go; all columns stay, null texts stay null."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = _with_bitmaps(docs, id_col, text_col, row, **options)
    old = F.col(f"row.`{text_col}`")
    text = F.when(old.isNull(), old).otherwise(_kept_text())
    return found.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
                          for c in docs.columns])


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256 of the lines that stay."""
    found = _with_bitmaps(docs, id_col, text_col, F.lit(None).cast("int"), **options)
    return found.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                        F.sha2(_kept_text().cast("binary"), 256).alias("kept_sha256"))
