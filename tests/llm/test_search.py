"""Ranked search against scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opsfold.llm import search
from tests.conftest import SF001
from tests.llm.fixtures import awkward, empty

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]+", lambda m: m.group().lower(), x) for x in TERM.findall(text or "")]


def plain(docs, items, top):
    """Rows (item_id, rank, doc_id, score) from the scores of all documents."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    posts = defaultdict(list)
    for k, (_, c, _) in enumerate(counted):
        for w, tf in c.items():
            posts[w].append((k, tf))
    norms = [50 + (50 * n * n_docs) // n_terms for _, _, n in counted]
    out = []
    for item, text in items:
        scores = defaultdict(int)
        for w in set(terms(text)):
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * len(posts[w]) + 1)))
            for k, tf in posts[w]:
                scores[k] += weight * ((10**9 * tf) // (1000 * tf + 20 * norms[k]))
        best = sorted(((-s, counted[k][0] is not None, counted[k][0] or 0)
                       for k, s in scores.items() if s > 0))[:top]
        out += [(item, r, i if some else None, -s) for r, (s, some, i) in enumerate(best, 1)]
    return out


def check(docs, items, **options):
    got = search.search(docs, items, **options).collect()
    pairs = lambda df: [tuple(r) for r in df.collect()]
    want = plain(pairs(docs.select("doc_id", "text")), pairs(items.select("item_id", "text")),
                 options.get("top", search.TOP))
    assert Counter(map(tuple, got)) == Counter(want)
    return got


@pytest.mark.parametrize("segment_bytes,item_bytes", [(20_000, 1500), (search.SEGMENT_BYTES,
                                                                       search.ITEM_BYTES)])
def test_all_items(spark, segment_bytes, item_bytes):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    assert check(docs, items, top=5, segment_bytes=segment_bytes, item_bytes=item_bytes)


def test_awkward(spark):
    docs = awkward(spark)
    rows = [(1, "Lorem ipsum1 DOLOR"), (1, "Lorem ipsum1 DOLOR"), (None, "été 日本語"), (2, None), (3, ""),
            (4, " .,- "), (5, "nosuchterm"), (6, "the same same words"), (7, "a ab é é"), (8, "ID text repeated")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    for top in (1, 3, 50):
        check(docs, items, top=top)
        check(docs, items, top=top, segment_bytes=400)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "lorem")], "item_id long, text string")
    assert search.search(empty(spark), items).collect() == []
    none = spark.createDataFrame([], "item_id string, text string")
    got = search.search(awkward(spark), none)
    assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        size = rng.choice([1, 3, 20, 80])
        texts.append(" ".join(words[min(int(rng.expovariate(0.02)), 399)] for _ in range(size)))
    return texts


def segments(texts, totals, per):
    for a in range(0, len(texts), per):
        ids = pa.array(range(a, a + len(texts[a:a + per])), pa.int64())
        rows = list(search.term_counts(pa.array(texts[a:a + per])))
        h, doc, tf = (np.concatenate(c) for c in zip(*rows, strict=True))
        yield search.build_segment(h, doc, tf, ids, *totals)


def test_postings_round_trip_and_blocks_are_skipped():
    texts = corpus(6000, 1) + ["rare " + t for t in corpus(40, 2)]
    counts = search.count_terms(pa.array(texts))
    assert counts.tolist() == [len(terms(t)) for t in texts]
    totals = (len(texts), int(counts.sum()))
    row = next(segments(texts, totals, len(texts)))
    segment = search.Segment(row, *totals)
    wanted, (mine,) = search.query_terms(["w0 w1 w2 w150 rare"])
    at = search._find(segment.terms, wanted)
    for name in ("w0", "w150", "rare"):
        h, _ = search.query_terms([name])
        doc, impact = segment.whole_list(int(search._find(segment.terms, h)[0]))
        has = [(i, terms(t).count(name)) for i, t in enumerate(texts) if name in terms(t)]
        assert doc.tolist() == [i for i, _ in has]
        tf = np.array([n for _, n in has])
        assert impact.tolist() == search.impacts(tf, segment.norms[doc]).tolist()
    # With a high threshold only blocks that candidates need are unpacked.
    segment = search.Segment(row, *totals)
    df = np.frombuffer(row["list_docs"], "<u4")[at[mine]]
    weight = np.floor(1000 * np.log((2 * totals[0] + 2) / (2.0 * df + 1))).astype(np.int64)
    bounds = weight * segment.list_max[at[mine]]
    every, scores = segment.candidates(at[mine], weight, bounds, 1)
    total = segment.unpacked
    limit = int(np.sort(scores)[-3])
    segment = search.Segment(row, *totals)
    few, top = segment.candidates(at[mine], weight, bounds, limit)
    assert set(zip(few.tolist(), top.tolist())) == {
        (d, s) for d, s in zip(every.tolist(), scores.tolist()) if s >= limit}
    assert segment.unpacked < total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB 1.é日-", max_size=30), min_size=1, max_size=12))
def test_terms_of_slices(texts):
    old = search.SLICE
    for search.SLICE in (3, 10, old):
        got = Counter()
        for h, doc, tf in search.term_counts(pa.array(texts, pa.string())):
            for x, d, n in zip(h.tolist(), doc.tolist(), tf.tolist()):
                got[x, d] += n
        assert search.count_terms(pa.array(texts, pa.string())).tolist() == [len(terms(t)) for t in texts]
        names = {w for t in texts for w in terms(t)}
        hashes = {int(h): w for w in names for h, _, _ in search.term_counts(pa.array([w]))}
        assert len(hashes) == len(names)
        assert Counter({(hashes[x], d): n for (x, d), n in got.items()}) == Counter(
            (w, i) for i, t in enumerate(texts) for w in terms(t))


def test_a_long_text(spark):
    long = "alpha " * 900_000 + "omega " + "b" * 3_000_000
    docs = spark.createDataFrame([(1, long), (2, "alpha omega"), (3, "omega beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha"), (2, "omega"), (3, "b" * 3_000_000)], "item_id long, text string")
    check(docs, items)
