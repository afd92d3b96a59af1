"""Quality rules with cross-document line frequencies per host, in DataFrame functions only.

Normalised lines are hashed and each host's documents that hold a line are
counted, each document once.  A line in more than ``max(min_docs, max_share *
documents of the host)`` documents is boilerplate; documents whose other lines hold too few words, or too small a share of their words, are rejected.

Words are maximal runs of characters other than space and U+0009 to U+000D.

Cases: a null text has no words, so it fails the base rules, as every text with
fewer than ``min_words`` words; a null host is a host of its own; repeated rows
each get their result and count each for line frequencies; an empty table gives
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsfold.llm.frames import free_name, stored, text_or_empty

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
MIN_DOCS = 10
MAX_SHARE = 0.05
MIN_KEPT_WORDS = 10
MIN_KEPT_SHARE = 0.5
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# A broadcast of at most this many 8-byte line keys; beyond it, a shuffle join.
MAX_BROADCAST_LINES = 100_000


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _shift(column: str, by: int) -> Column:
    c = F.col(column)
    return F.slice(c, by + 1, F.greatest(F.size(c) - by, F.lit(0)))


def _paired(column: str, by: int) -> Column:
    """Hash of each element with the one ``by`` further on, as far as there is one."""
    c = F.col(column)
    head = F.slice(c, 1, F.greatest(F.size(c) - by, F.lit(0)))
    return F.zip_with(head, _shift(column, by), lambda x, y: F.xxhash64(x, y))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Each array is a column of its own before it is used, and lambdas see only
    their own arguments: an expression over an array is evaluated once per row.
    """
    text = F.col("__text")
    d = docs.withColumn("__words", _words(text))
    d = d.withColumn("n_words", F.size("__words").cast("long"))
    d = d.withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
    d = d.withColumn("n_symbols", F.length(F.regexp_replace(
        text, "[^" + SYMBOLS.replace("&", r"\&") + "]+", "")).cast("long"))
    d = d.withColumn("__lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_dup_lines",
                     (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    d = d.withColumn("__h1", F.transform("__words", lambda w: F.xxhash64(w))).drop("__words")
    for k in (1, 2, 4):  # hashes of 2, 4 and 8 words in a row
        d = d.withColumn(f"__h{2 * k}", _paired(f"__h{k}", k)).drop(f"__h{k}")
    h = F.col("__h8")
    d = d.withColumn("__repeats", F.size(h) > F.size(F.array_distinct(h)))
    # Only texts with a repeated window sort their windows by hash and place.
    d = d.withColumn("__at", F.when(F.col("__repeats"), F.sort_array(F.transform(
        h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    d = d.withColumn("__next", _shift("__at", 1))
    pair = F.zip_with("__at", "__next", lambda a, b: F.struct(
        a["i"].alias("i"), b["i"].alias("j"), (a["h"] == b["h"]).alias("same")))
    d = d.withColumn("__pair", F.filter(pair, lambda p: p["same"]))
    d = d.withColumn("__starts", F.sort_array(F.array_distinct(F.flatten(F.transform(
        "__pair", lambda p: F.array(p["i"], p["j"]))))))
    covered = F.zip_with("__starts", _shift("__starts", 1),
                         lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    d = d.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long"))
    return d.drop("__lines", "__h8", "__repeats", "__at", "__next", "__pair", "__starts")


def _line_rows(rows: DataFrame) -> DataFrame:
    """Normalised lines of each row with their number of words."""
    norm = F.transform(F.split("__text", "\n"),
                       lambda x: F.trim(F.regexp_replace(F.lower(x), BLANK, " ")))
    lines = rows.select("__key", "__host", F.explode(norm).alias("line")).filter(F.col("line") != "")
    words = F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1
    return lines.select("__key", "__host", F.xxhash64("line").alias("line"), words.alias("words"))


def _document_lines(rows: DataFrame) -> DataFrame:
    """(host, line) of each document, each line once."""
    norm = F.transform(F.split("__text", "\n"),
                       lambda x: F.trim(F.regexp_replace(F.lower(x), BLANK, " ")))
    lines = rows.select("__host", F.explode(F.array_distinct(norm)).alias("line")).filter(F.col("line") != "")
    return lines.select("__host", F.xxhash64("line").alias("line"))


def frequent_lines(rows: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, line) pairs in more documents of the host than its limit."""
    limits = rows.groupBy("__host").agg(F.greatest(
        F.lit(min_docs).cast("double"), F.count(F.lit(1)) * F.lit(max_share)).alias("__limit"))
    counts = (_document_lines(rows).groupBy("__host", "line")
              .agg(F.count(F.lit(1)).alias("__docs")).filter(F.col("__docs") > min_docs))
    found = stored(counts.join(limits, "__host").filter(F.col("__docs") > F.col("__limit"))
                   .select("__host", "line"), "lines")
    # A host has at most (lines per text) / max_share such lines; still, their number is
    # checked, and a shuffle join takes over where it is large.
    return F.broadcast(found) if found.count() <= MAX_BROADCAST_LINES else found.hint("merge")


def line_frequency_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          host_col: str = "source", min_docs: int = MIN_DOCS,
                          max_share: float = MAX_SHARE, min_kept_words: int = MIN_KEPT_WORDS,
                          min_kept_share: float = MIN_KEPT_SHARE,
                          min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: base counts, base_failed, kept, n_removed_words."""
    host = F.xxhash64(F.col(host_col).cast("string"), F.col(host_col).isNull())
    rows = docs.select(F.col(id_col).alias("doc_id"), host.alias("__host"),
                       text_or_empty(text_col).alias("__text"))
    rows = rows.withColumn("__key", F.xxhash64("__host", "__text"))
    counted = stored(base_counts(rows).drop("__text"), "counts")
    texts = counted.groupBy("__key", "__host").agg(F.count(F.lit(1)).alias("__copies"))
    frequent = frequent_lines(rows, min_docs, max_share)
    # Copies of a text have one key, and each adds as many removed words.
    removed = (_line_rows(rows).join(frequent, ["__host", "line"])
               .groupBy("__key").agg(F.sum("words").alias("__sum"))
               .join(texts, "__key")
               .select("__key", F.expr("__sum div __copies").alias("__removed")))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (left < min_kept_words) | (left < min_kept_share * F.col("n_words"))
    return (counted.join(removed, "__key", "left")
            .withColumn("n_removed_words", F.coalesce("__removed", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~depleted)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept", "n_removed_words"))


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           host_col: str = "source", min_docs: int = MIN_DOCS,
                           max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text; all columns stay.

    Rows are told apart by a number of their own, as ids may repeat; the lines
    of one text are put together again in order.
    """
    host = F.xxhash64(F.col(host_col).cast("string"), F.col(host_col).isNull())
    rows = docs.select(host.alias("__host"), text_or_empty(text_col).alias("__text"))
    rows = rows.withColumn("__key", F.xxhash64("__host", "__text"))
    frequent = frequent_lines(rows, min_docs, max_share)
    key, lines = free_name("__key", docs), free_name("__cut", docs)
    cut = (_line_rows(rows).join(frequent, ["__host", "line"]).select("__key", "line").distinct()
           .groupBy(F.col("__key").alias(key)).agg(F.collect_set("line").alias(lines)))
    norm = lambda x: F.xxhash64(F.trim(F.regexp_replace(F.lower(x), BLANK, " ")))
    text = F.col(text_col).cast("string")
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col(lines), norm(x)))
    keyed = docs.withColumn(key, F.xxhash64(host, text_or_empty(text_col)))
    return (keyed.join(cut, key, "left")
            .withColumn(text_col, F.when(F.col(lines).isNull(), text)
                        .otherwise(F.array_join(kept, "\n")))
            .drop(key, lines))
