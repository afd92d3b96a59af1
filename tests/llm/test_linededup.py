"""Line deduplication against a plain version."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

from opsfold.llm import linededup
from tests.conftest import SF001
from tests.llm.fixtures import awkward, empty


@pytest.fixture(params=["awkward", "sf"])
def docs(request, spark):
    return awkward(spark) if request.param == "awkward" else spark.read.parquet(f"{SF001}/documents.parquet")


def key(line):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, min_docs, min_chars=1, keep="none"):
    """(id, positions that stay) of each (id, text), in document order."""
    counts, first = Counter(), {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in order:
        lines = (text or "").split("\n")
        counts.update({key(x) for x in lines})
        for p, x in enumerate(lines):
            first.setdefault(key(x), (i, text, p))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stays = [p for p, x in enumerate(lines)
                 if len(key(x)) < min_chars or counts[key(x)] < min_docs
                 or (keep == "first" and first[key(x)] == (i, text, p))]
        out.append((i, stays, "\n".join(lines[p] for p in stays)))
    return out


def source(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (2, 1), (2, 6), (10, 1)])
def test_digests(docs, min_docs, min_chars):
    rows = source(docs)
    got = linededup.line_digests(docs, min_docs=min_docs, min_chars=min_chars).collect()
    want = [(i, len((t or "").split("\n")), len((t or "").split("\n")) - len(stays),
             hashlib.sha256(kept.encode()).hexdigest())
            for (i, t), (_, stays, kept) in zip(rows, plain(rows, min_docs, min_chars), strict=True)]
    assert order(map(tuple, got)) == order(want)


def test_first_lines_stay(spark):
    rows = [(i, f"Header\nbody {i}\n  header \n\nfooter {i % 3}\nHEADER", i) for i in range(40)]
    rows += [(None, "header", -1), (7, "no line of theirs", -2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part long")
    got = linededup.keep_bitmaps(docs, keep="first", min_docs=2).collect()
    kept = {(r.doc_id, r.n_lines): sorted(p for run in r.keep_runs
                                          for p in range(run.start, run.start + run.length))
            for r in got}
    want = plain([r[:2] for r in rows], 2, keep="first")
    assert kept == {(i, len(t.split("\n"))): stays
                    for (i, stays, _), (_, t, _) in zip(want, rows, strict=True)}
    texts = linededup.without_repeated_lines(docs, keep="first", min_docs=2)
    assert texts.columns == docs.columns
    assert order((r.doc_id, r.text) for r in texts.collect()) == order((i, t) for i, _, t in want)


def test_a_line_of_every_document_spreads_over_partitions(spark):
    rows = [(i, f"the same line\nown line {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = linededup.line_rows(docs)
    hot = linededup._in_key_order(lines).where("pos = 0").selectExpr("spark_partition_id() as p")
    assert max(r["count"] for r in hot.groupBy("p").count().collect()) < 1000
    plan = linededup.first_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    got = linededup.line_digests(docs).collect()
    assert len(got) == 2000 and all(r.n_dropped == 1 for r in got)


def test_long_text_empty_table_and_bad_option(spark):
    long = "\n".join(f"line {i % 30_000}" for i in range(200_000))
    docs = spark.createDataFrame([(1, long), (2, "line 5\nx"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.line_digests(docs, min_docs=2).collect()}
    assert (got[1].n_lines, got[1].n_dropped) == (200_000, sum(i % 30_000 == 5 for i in range(200_000)))
    assert (got[2].n_dropped, got[3].n_lines, got[3].n_dropped) == (1, 1, 0)
    assert linededup.line_digests(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        linededup.line_digests(docs, keep="last")
