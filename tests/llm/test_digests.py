"""Sharding, packing, line frequencies and token files against plain versions."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsfold.llm import linefreq, packing, sharding, tokens, wavelet
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.fixtures import awkward, awkward_texts, empty


@pytest.fixture(params=["awkward", "sf"])
def docs(request, spark):
    return awkward(spark) if request.param == "awkward" else spark.read.parquet(f"{SF001}/documents.parquet")


def key(x):
    return (x is not None, x or 0)


def test_cached_ids_equal_the_library():
    enc = tokens.PieceEncoder(tokens.default_tokenizer(), max_entries=50)
    texts = [t or "" for t in awkward_texts()] * 2
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)]
    assert got == brute.library_ids(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1 é.,'\n\t\r  　\x1c\x85s!日|<>-"), max_size=60))
def test_cached_ids_of_odd_texts(text):
    enc = tokens.encoder()
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == brute.library_ids([text])[0]


def test_shards(docs):
    rows = sharding.shard_rows(docs, 7, seed=3).collect()
    src = docs.select("doc_id", "text").collect()
    assert len(rows) == len(src)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
                   for r in src)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    order = sorted(rows, key=lambda r: r.row_number)
    assert [r.row_number for r in order] == list(range(len(rows)))
    assert [key(r.doc_id) for r in order] == sorted(key(r.doc_id) for r in rows)
    again = sharding.shard_rows(docs.repartition(5), 7, seed=3).collect()
    assert Counter(again) == Counter(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4097])
def test_permutation_and_inverse(spark, n):
    df = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 5).alias("p"))
    df = df.withColumn("back", sharding.permuted(F.col("p"), n, 5, inverse=True))
    got = df.collect()
    assert sorted(r.p for r in got) == list(range(n))
    assert all(r.id == r.back for r in got)
    if n >= 97:
        assert sum(r.p == r.id for r in got) < n / 10


def test_more_rows_take_more_partitions(spark, docs, monkeypatch):
    want = sorted(map(str, sharding.shard_rows(docs, 3, seed=4).collect()))
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", 1)
    assert sorted(map(str, sharding.shard_rows(docs, 3, seed=4).collect())) == want


def test_random_access(spark, docs):
    rows = sharding.shard_rows(docs, 3)
    n = rows.count()
    got = rows.withColumn("r", sharding.row_of(F.col("shard"), F.col("slot"), 3, n))
    assert got.filter(F.col("r") != F.col("row_number")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_equals_item_by_item_best_fit(lengths):
    plan = packing.best_fit_plan(dict(Counter(lengths)), 40)
    bins = defaultdict(list)
    for length, n in Counter(lengths).items():
        mine = [p for p in plan if p[0] == length]
        for rank in range(n):
            _, first, b, each, used = max((p for p in mine if p[1] <= rank), key=lambda p: p[1])
            k = rank - first
            bins[b + k // each].append((used + k % each * length, length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 40
    rooms = Counter(40 - sum(x for _, x in items) for items in bins.values())
    assert rooms == Counter(brute.best_fit_bins(lengths, 40))


def test_packing(spark, docs):
    cap = 64
    rows = packing.pack(docs, capacity=cap).collect()
    src = docs.select("doc_id", "text").collect()
    want = Counter()
    lengths = []
    for r, ids in zip(src, brute.library_ids([r.text for r in src])):
        ids = ids + [0]
        first = len(ids) % cap or cap
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, cap)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, brute.crc(ids[a:b])] += 1
            lengths.append(b - a)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for items in seqs.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= cap
    if len(lengths) < 3000:
        assert len(seqs) == len(brute.best_fit_bins(lengths, cap))


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").filter("n_chars < 2000")
    packed = packing.pack(docs)
    seqs = {r.sequence_id: r.ids for r in packing.sequences(docs, packed).collect()}
    for r in packed.collect():
        ids = seqs[r.sequence_id][r.offset:r.offset + r.length]
        assert brute.crc(ids) == r.ids_crc32


def test_token_files(spark, docs):
    got = wavelet.write_and_read(docs, shard_tokens=700).collect()
    src = docs.select("doc_id", "text").collect()
    want = Counter()
    for r, ids in zip(src, brute.library_ids([r.text for r in src])):
        want[r.doc_id, len(ids) + 1, brute.crc(ids + [2])] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [key(r.doc_id) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60000), max_size=30), min_size=1, max_size=40))
def test_wavelet_access_rank_select(docs):
    data = [np.array(d + [2], dtype="<u4").tobytes() for d in docs]
    flat = [t for d in docs for t in d + [2]]
    shard = wavelet.WaveletShard(wavelet.build_shard(data))
    assert shard.tokens().tolist() == flat
    assert [shard.access(i) for i in range(len(flat))] == flat
    for token in {2, flat[0], 7}:
        at = [i for i, t in enumerate(flat) if t == token]
        assert shard.rank(token) == len(at)
        assert shard.rank(token, len(flat) // 2) == sum(i < len(flat) // 2 for i in at)
        assert [shard.select(token, k) for k in range(len(at))] == at


def test_line_frequencies(spark, docs):
    options = dict(min_docs=2, max_share=0.1, min_kept_words=10, min_kept_share=0.5)
    src = docs.select("doc_id", "text", "source").collect()
    got = linefreq.line_frequency_filter(docs, **options).collect()
    want = Counter()
    numbered = [(i, r.text, r.source) for i, r in enumerate(src)]
    removed = brute.line_verdicts(numbered, **options)
    for i, r in enumerate(src):
        c = brute.base_counts(r.text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        left = c[0] - removed[i]
        kept = not failed and left >= 10 and left >= 0.5 * c[0]
        want[(r.doc_id, *c, failed, kept, removed[i])] += 1
    assert Counter(tuple(r) for r in got) == want


def test_taking_lines_out(spark):
    rows = [(i, f"own line {i} has words\nShared  LINE here\nlast {i}", "h") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = linefreq.without_frequent_lines(docs, min_docs=3, max_share=0.1).collect()
    assert {r.doc_id: r.text for r in got} == {i: f"own line {i} has words\nlast {i}" for i in range(8)}


def test_taking_lines_out_keeps_columns_of_any_name(spark):
    rows = [(i, f"own line {i}\nshared line", "h", i, f"c{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __key long, __cut string")
    got = linefreq.without_frequent_lines(docs, min_docs=3, max_share=0.1)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(i, f"own line {i}", "h", i, f"c{i}") for i in range(8)]


def test_empty_tables(spark):
    assert sharding.shard_rows(empty(spark), 4).collect() == []
    assert packing.pack(empty(spark)).collect() == []
    assert linefreq.line_frequency_filter(empty(spark)).collect() == []
    assert wavelet.write_and_read(empty(spark)).collect() == []


def test_learning_pieces_makes_no_garbage_collections():
    import gc

    e = tokens.PieceEncoder(tokens.default_tokenizer())
    pieces = {f"{'wxyz'[i % 4]}ord{i:x}" + ("", ".", "", "é,", "")[i % 5] for i in range(40_000)} | {"\nled.", "a's"}
    runs = []
    gc.collect()
    gc.callbacks.append(lambda phase, info: runs.append(phase))
    try:
        e.learn(pieces)
    finally:
        gc.callbacks.pop()
    assert len(runs) <= 12
    for p in [*sorted(pieces)[::997], "\nled.", "a's"]:
        want = e.library.encode(p if p[0] == "\n" else " " + p, add_special_tokens=False).ids
        assert np.frombuffer(e.young[p], "<u4").tolist() == want
