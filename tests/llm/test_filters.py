"""Toxicity, decontamination and edited token counts; the pipeline as a whole."""

from __future__ import annotations

import random
import string

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

import corpus_pipeline
from opsfold.llm import decontaminate, tokencount, tokens, toxicity
from tests.conftest import SF001, SF01
from tests.llm import brute
from tests.llm.fixtures import awkward, empty


# -------------------------------------------------------------------- toxicity

def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    ids = sorted(r.doc_id for r in labels.collect())
    held = set(ids[::4])
    mask = labels["doc_id"].isin(list(held))
    chain = toxicity.train(docs, labels.filter(~mask), toxicity.label_categories())
    rows = toxicity.score(docs, chain).join(labels.filter(mask), "doc_id").collect()
    assert len(rows) == len(held)
    assert np.mean([r.is_toxic == bool(r.toxic) for r in rows]) >= 0.93
    assert not any(r.is_toxic and not r.toxic for r in rows) or \
        sum(r.is_toxic and not r.toxic for r in rows) <= 1
    assert np.mean([r.is_poor == (r.quality == 0) for r in rows]) >= 0.93
    assert toxicity.below(docs, chain, "toxic").columns == docs.columns


def test_later_models_see_earlier_categories():
    rng = random.Random(4)
    texts, y = [], []
    for _ in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        filler = [rng.choice("red blue green tree house") + rng.choice("abcde") for _ in range(30)]
        texts.append(" ".join(filler + ["alpha"] * a + ["beta"] * b))
        y.append((a, a != b))  # the second is no linear function of the words alone
    names = ["one", "two"]
    chain = toxicity.fit_chain(names, texts[:300], np.array(y[:300]))
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    p = chain.predict(texts[300:])
    assert np.mean((p[:, 0] > 0.5) == np.array(y[300:])[:, 0]) > 0.95


def test_chain_without_labels(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, labels, toxicity.label_categories())
    rows = toxicity.score(docs, chain).collect()
    assert len(rows) == docs.count() and not any(r.is_toxic for r in rows if r.p_toxic < 0.5)
    one = spark.createDataFrame([(6, 1, 0), (9, 1, 0), (None, 1, 1), (12, None, 1)], labels.schema)
    chain = toxicity.train(docs, one, toxicity.label_categories())
    assert not any(r.is_toxic for r in toxicity.score(docs, chain).collect())


# -------------------------------------------------------------- decontamination

def semi_global(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def whole_distance(a, b):
    rows = [[i + j for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = min(rows[i][j + 1] + 1, rows[i + 1][j] + 1, rows[i][j] + (x != y))
    return rows[-1][-1]


@settings(max_examples=150, deadline=None)
@given(st.text("ab c", min_size=1, max_size=12), st.text("ab c", max_size=40))
def test_myers_distance(pattern, text):
    got, end = decontaminate._myers(decontaminate._masks(pattern), len(pattern), text)
    assert got == semi_global(pattern, text)
    assert semi_global(pattern, text[:end]) == got


def mutated(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "q" + text[i:], text[:i] + "z" + text[i + 1:]])
    return text


@pytest.mark.parametrize("block_chars", [10 ** 6, 300])
def test_matches_equal_all_against_all(spark, block_chars):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(8, 30)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "short"), (53, items[0][1]), (None, items[1][1])]
    docs = []
    for i in range(40):
        parts = [" ".join(word() for _ in range(20)) for _ in range(3)]
        if i % 2:
            item = items[i % 12][1]
            parts.insert(1, mutated(rng, item, rng.randrange(0, len(item) // 14 + 1)).upper().replace(" ", "\n "))
        docs.append((i, " ".join(parts)))
    docs += [(90, None), (91, ""), (None, items[2][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(d, b, block_chars=block_chars).collect()}
    want = {}
    for i, t in docs:
        t = decontaminate.normalized(t)
        for j, x in items:
            x = decontaminate.normalized(x)
            if len(x) >= 20 and (n := semi_global(x, t)) <= int(0.05 * len(x)):
                want[i, j] = n
                r = got[i, j]
                assert semi_global(x, t[r.start:r.end]) == n
    assert {k: r.distance for k, r in got.items()} == want
    kept = {r.doc_id for r in decontaminate.clean(d, b, block_chars=block_chars).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_short_items_match_whole_words(spark):
    d = spark.createDataFrame([(1, "So Paris,  France it is"), (2, "comparis, francename"), (3, "paris")],
                              "doc_id long, text string")
    b = spark.createDataFrame([(7, "paris, FRANCE"), (8, " "), (9, "Paris")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance, r.start, r.end) for r in decontaminate.matches(d, b).collect()}
    assert got == {(1, 7, 0, 3, 16), (1, 9, 0, 3, 8), (3, 9, 0, 0, 5)}
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == {2}


def test_short_items_share_the_budget_of_edits(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 4)))) for i in range(10)]
    docs = [(i, " ".join(word() for _ in range(8)) + rng.choice(["", ".", "x"])) for i in range(40)]
    docs += [(40 + i, f"{word()} {mutated(rng, t, 1)}, {word()}") for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(d, b, error_rate=0.2).collect()
    want = {}
    for i, t in docs:
        t = decontaminate.normalized(t)
        for j, x in items:
            x, k = decontaminate.normalized(x), int(0.2 * len(x))
            edges = [p for p in range(len(t) + 1) if not t[max(0, p - 1):p + 1].isalnum() or p in (0, len(t))]
            n = min((whole_distance(x, t[s:e]) for s in edges for e in edges if s < e), default=k + 1)
            if n <= k:
                want[i, j] = n
    assert len(want) > 10 and {0, 1} <= set(want.values())
    assert {(r.doc_id, r.item_id): r.distance for r in found} == want


def test_benchmark_items_in_documents(spark):
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    items = [(r.item_id, decontaminate.normalized(r.text)) for r in bench.collect()]
    exact = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in decontaminate.normalized(d.text)}
    assert exact and exact <= got


# ----------------------------------------------------------------- token counts

ODD = st.text(alphabet=st.sampled_from("ab1 é.,'\n\t \x1c　!|s"), max_size=40)


@settings(max_examples=200, deadline=None)
@example(" \n1", [(0, 0, "")])
@given(ODD, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20), ODD), max_size=5))
def test_counts_follow_edits(text, edits):
    enc = tokens.encoder()
    tree = tokencount.CountTree(text, enc)
    for a, size, new in edits:
        a = min(a, len(text))
        b = min(a + size, len(text))
        text = text[:a] + new + text[b:]
        tree.edit(a, b, new)
        assert tree.text() == text
        assert tree.n_tokens == len(brute.library_ids([text])[0])


def test_only_touched_segments_are_encoded():
    text = " ".join("".join(random.Random(i).choices(string.ascii_lowercase, k=6)) for i in range(5000))
    tree = tokencount.CountTree(text, tokens.encoder())
    tree.edit(9000, 9003, "x y")
    assert tree.encoded <= 4
    with pytest.raises(ValueError):
        tree.edit(5, 10 ** 6, "")


@settings(max_examples=300, deadline=None)
@example(["", " \n1", "a b\nc", "a\tb c ", "<|endoftext|> x"])
@given(st.lists(ODD, max_size=6))
def test_leaves_are_the_segments(texts):
    enc = tokens.encoder()
    chars, counts = tokencount._leaves(texts, enc)
    for text, c, n in zip(texts, chars, counts, strict=True):
        parts = tokencount.segments(text)
        assert c.tolist() == [len(p) for p in parts]
        assert n.tolist() == [len(x) for x in brute.library_ids(parts)]


def apply_edits(text, edits):
    for a, b, new in reversed(edits):
        text = text[:a] + new + text[b:]
    return text


def scrubbed(text):
    """The text without repeated lines, then with masks, and the number of edits; by whole texts."""
    lines, n = [], 0
    for line in text.split("\n"):
        if line.strip() and line in lines:
            n += 1
        else:
            lines.append(line)
    text = "\n".join(lines)
    for pattern, mask in ((tokencount._EMAIL, "<email>"), (tokencount._PHONE, "<phone>")):
        text, k = pattern.subn(mask, text)
        n += k
    return text, n


@pytest.mark.parametrize("table", ["awkward", "sf"])
def test_edited_counts(spark, table):
    docs = awkward(spark) if table == "awkward" else spark.read.parquet(f"{SF001}/documents.parquet")
    got = sorted(tuple(r) for r in tokencount.edited_counts(docs).drop("n_encoded_again", "n_segments")
                 .fillna(-1).collect())
    src = docs.select("doc_id", "text").collect()
    after = [scrubbed(r.text or "") for r in src]
    before_ids, after_ids = (brute.library_ids(x) for x in ([r.text for r in src], [t for t, _ in after]))
    want = sorted((-1 if r.doc_id is None else r.doc_id, len(a), n, len(b), len(t))
                  for r, a, b, (t, n) in zip(src, before_ids, after_ids, after))
    assert got == want
    assert any(n for _, n in after)


@pytest.mark.parametrize("most", [tokencount.MAX_BROADCAST_BYTES, 0])
def test_kept_trees_follow_tables_of_edits(spark, monkeypatch, most):
    """Two batches of edits by doc_id, the second on the trees that the first left."""
    monkeypatch.setattr(tokencount, "MAX_BROADCAST_BYTES", most)
    rng = random.Random(12)
    docs = awkward(spark)
    trees = tokencount.count_trees(docs)
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    for _ in range(2):
        shortest = {}
        for i, t in texts:
            shortest[i] = min(shortest.get(i, 10 ** 9), len(t))
        edits = []
        for i, size in shortest.items():
            cuts = sorted(rng.randrange(size + 1) for _ in range(4))
            edits += [(i, cuts[0], cuts[1], rng.choice(["", "x y", None, "\n"])),
                      (i, cuts[2], cuts[3], " new. ")] if rng.random() < 0.8 else []
        table = spark.createDataFrame([*edits, (10 ** 9, 5, 7, "no such document")],
                                      "doc_id long, start int, end int, replacement string")
        trees = tokencount.updated(trees, tokencount.edited_trees(trees, table, "doc_id"))
        texts = [(i, apply_edits(t, sorted((a, b, n or "") for j, a, b, n in edits if j == i)))
                 for i, t in texts]
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.text, sum(r.tokens), sum(r.chars))
                     for r in trees.collect())
        ids = brute.library_ids([t for _, t in texts])
        assert got == sorted((-1 if i is None else i, t, len(x), len(t)) for (i, t), x in zip(texts, ids))
    overlapping = spark.createDataFrame([(0, 0, 0, "a"), (0, 0, 10 ** 8, "b")],
                                        "tree long, start int, end int, replacement string")
    with pytest.raises(Exception, match="outside the text"):
        tokencount.edited_trees(trees, overlapping).collect()


def test_empty_tables(spark):
    e = empty(spark)
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert decontaminate.matches(e, bench).collect() == []
    assert decontaminate.matches(bench.withColumnRenamed("item_id", "doc_id"), bench.limit(0)).collect() == []
    assert decontaminate.clean(e, bench).collect() == []
    assert tokencount.edited_counts(e).collect() == []
    chain = toxicity.train(e, none, toxicity.label_categories())
    assert toxicity.score(e, chain).collect() == []


# --------------------------------------------------------------------- pipeline

def test_pipeline(spark, tmp_path):
    """Each stage on its predecessor's rows, and the packed ids against the last texts."""
    from tests.llm.test_duplicates import as_sets, brute_repeats, classes_of

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, now, seen = docs.schema, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        stage(spark, now, SF001).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, now.collect())
        if name != "packing":
            assert [(f.name, f.dataType) for f in now.schema] == [(f.name, f.dataType) for f in columns]
    before, after = seen["toxicity"]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    toxic = {i for i, r in labels.items() if r.toxic}
    assert len(toxic & gone) >= 0.8 * len(toxic)
    assert sum(i in labels and not labels[i].toxic for i in gone) <= 2  # of 87 labels
    before, after = seen["near_duplicates"]
    classes = as_sets(zip([r.doc_id for r in before], classes_of([r.text for r in before])))
    assert {r.doc_id for r in after} == {min(c) for c in classes}
    before, after = seen["repeated_bytes"]
    order = sorted(before, key=lambda r: r.doc_id)
    kept = {r.doc_id: w[1] for r, w in zip(order, brute_repeats([r.text.encode() for r in order], 100))}
    texts = {r.doc_id: r for r in after}
    for r in before:
        if kept[r.doc_id] == 0:
            assert texts[r.doc_id] == r
        elif r.doc_id in texts:
            t = texts[r.doc_id]
            assert t.n_chars == len(t.text)
            size = len(r.text.encode()) - kept[r.doc_id]
            assert size - 6 * 3 <= len(t.text.encode()) <= size
        else:
            assert len(r.text.encode()) - kept[r.doc_id] < 6
    before, after = seen["decontamination"]
    items = [decontaminate.normalized(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    bad = {r.doc_id for r in before if any(x in decontaminate.normalized(r.text) for x in items)}
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} - bad
    assert len(after) >= len(before) - len(bad) - 1
    before, after = seen["packing"]
    n = {r.doc_id: len(ids) + 1 for r, ids in zip(before, brute.library_ids([r.text for r in before]))}
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == n
