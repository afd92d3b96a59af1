"""Near-duplicates, passages and exact repeats against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsfold.llm import components, neardup, passages, repeats
from tests.conftest import SF001
from tests.llm.fixtures import awkward, empty

WORDS = [a + b for a in "ka lo mi ne ru so ta vi".split() for b in "ba de fi go hu lan mer".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def edited(rng, text, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def frame(spark, texts, parts=4):
    rows = [(i, t, "s", -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, node long").repartition(parts)


# ------------------------------------------------------------- near-duplicates

def shingles(text):
    w = (text or "").lower().split()
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def similarity(a, b):
    total = 0.0
    every = set(a) | set(b)
    for i in set(a) & set(b):
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every)
    return total


def classes_of(texts, threshold=0.8):
    sh = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            equal = (texts[i] or "") == (texts[j] or "")
            if equal or (set(sh[i]) & set(sh[j]) and similarity(sh[i], sh[j]) >= threshold - 1e-9):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def as_sets(labels):
    out = defaultdict(set)
    for k, label in labels:
        out[label].add(k)
    return {frozenset(v) for v in out.values()}


def test_exact_similarity_equals_its_definition():
    rng = random.Random(3)
    for _ in range(200):
        a = Counter(rng.choices(range(12), k=rng.randrange(1, 20)))
        b = Counter(rng.choices(range(12), k=rng.randrange(1, 20)))
        pack = lambda c: (np.array(sorted(c), dtype=np.uint64),
                          np.array([c[k] for k in sorted(c)]))
        assert neardup.prob_jaccard(pack(a), pack(b)) == pytest.approx(similarity(a, b))


def test_registers_estimate_the_similarity():
    rng = np.random.Generator(np.random.PCG64(5))
    universe = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    a, b = np.sort(universe[:45]), np.sort(universe[15:])
    ca, cb = rng.integers(1, 5, 45), rng.integers(1, 5, 45)
    sig = neardup.prob_minhash(np.repeat([0, 1], 45), np.concatenate([a, b]),
                               np.concatenate([ca, cb]), 2, 4000)
    assert (sig != 0).all()
    assert (sig[0] == sig[1]).mean() == pytest.approx(neardup.prob_jaccard((a, ca), (b, cb)), abs=0.03)


def test_registers_do_not_depend_on_the_batch():
    rng = random.Random(1)
    parts = [prose(rng, n).encode() for n in (3, 6, 50, 400, 7)]
    together = neardup.prob_minhash(*neardup.weighted_shingles(parts), len(parts), 80)
    for i, p in enumerate(parts):
        alone = neardup.prob_minhash(*neardup.weighted_shingles([p]), 1, 80)
        assert (alone[0] == together[i]).all()


def near_texts():
    rng = random.Random(11)
    texts = []
    for size in (8, 30, 120, 400):
        for _ in range(4):
            base = prose(rng, size)
            texts += [base, base, base.upper()]
            texts += [edited(rng, base, k) for k in (1, max(1, size // 60), size // 40, size // 25)]
    base = prose(rng, 200)
    texts += [edited(rng, base, 3) for _ in range(60)]  # a large bucket, similar two by two or not
    shared = prose(rng, 60)
    texts += [prose(rng, 40) + " " + shared + " " + prose(rng, 40) for _ in range(50)]
    return [*texts, None, "", " ", "one", "one", "two words", "two  words"]


def test_near_duplicate_classes(spark):
    texts = near_texts()
    got = neardup.near_duplicates(frame(spark, texts), small=8).collect()
    want = as_sets(enumerate(classes_of(texts)))
    assert as_sets((r.doc_id, r.class_id) for r in got) == want
    assert len(got) == len(texts)
    kept = {r.doc_id for r in got if r.is_kept}
    assert kept == {min(c) for c in want}
    assert all(r.class_size == len(next(c for c in want if r.doc_id in c)) for r in got)


def test_no_link_is_lost_in_a_large_bucket(spark):
    rng = random.Random(17)
    template, texts = prose(rng, 150), []
    for _ in range(80):
        own = prose(rng, 30)
        texts += [edited(rng, template, k) + " " + own for k in (1, 2)]
    found = neardup.weighted_shingles([t.lower().encode() for t in texts])
    keys = neardup.band_keys(neardup.prob_minhash(*found, len(texts), 2), 2, 1)
    sets = [set(shingles(t)) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if (keys[i] == keys[j]).any()
            and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    got = neardup.near_duplicates(frame(spark, texts), bands=2, rows=1, small=4).collect()
    label = {r.doc_id: r.class_id for r in got}
    assert len(want) > 40 and len(set(label.values())) > 40
    assert [p for p in want if label[p[0]] != label[p[1]]] == []


def test_one_of_each_class_stays(spark):
    texts = near_texts()
    docs = frame(spark, texts)
    docs = docs.union(docs.filter("doc_id in (0, 3, 5)"))  # repeated rows
    left = neardup.deduplicated(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids) == sorted(min(c) for c in as_sets(enumerate(classes_of(texts))))


def test_columns_named_like_those_of_the_operator_stay(spark):
    docs = frame(spark, near_texts()).selectExpr("*", "doc_id as __text_key", "text as __KEY", "1 as __id")
    left = neardup.deduplicated(docs)
    assert left.columns == docs.columns
    assert left.count() < docs.count()
    assert left.filter("__text_key != doc_id or __KEY != text or __id != 1").count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    src = docs.select("doc_id", "text").collect()
    left = neardup.deduplicated(docs)
    assert left.columns == docs.columns
    want = as_sets(enumerate(classes_of([r.text for r in src])))
    assert left.count() == len(want)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    loops = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    assert {(r.node, r.label) for r in got} == {(x, find(x)) for x in parent} - {(x, x) for x in loops}


# -------------------------------------------------------------------- passages

def test_compact_windows_hold_every_stretch():
    rng = np.random.Generator(np.random.PCG64(4))
    texts = [rng.integers(0, 40, n).astype(np.uint64) for n in (0, 5, 12, 60, 90)]
    first = np.cumsum([0, *map(len, texts)])
    t, left, c, right, key = passages.compact_windows(np.concatenate(texts), first, 12, 1)
    windows = list(zip(t, left, c, right))
    h = neardup.mix(np.concatenate(texts) ^ neardup.mix(np.array([2], dtype=np.uint64))[0])
    value = (h & ~passages._PLACE) | np.arange(len(h), dtype=np.uint64)
    for i in range(len(texts)):
        for a in range(first[i], first[i + 1]):
            for b in range(a + 11, first[i + 1]):
                least = a + int(np.argmin(value[a:b + 1]))
                holds = [w for w in windows if w[0] == i and w[1] <= a <= w[2] <= b <= w[3]]
                assert [w[2] for w in holds] == [least]


def passage_texts():
    rng = random.Random(21)
    shared = [prose(rng, n) for n in (55, 80, 300)]
    texts, holds = [], []
    for k, s in enumerate(shared):
        for j in range(6):
            body = edited(rng, s, j % 3 * len(s.split()) // 150)
            texts.append(prose(rng, 30 + 20 * j) + " " + body + "\n" + prose(rng, 25))
            holds.append(k)
    for _ in range(30):
        texts.append(prose(rng, 150))
        holds.append(None)
    line = prose(rng, 12)  # a common line is no passage
    texts += [prose(rng, 60) + "\n" + line + "\n" + prose(rng, 60) for _ in range(30)]
    holds += [None] * 30
    return [*texts, texts[0], prose(rng, 20), None, ""], [*holds, 0, None, None, None]


def test_planted_passages_are_found(spark):
    texts, holds = passage_texts()
    got = passages.near_duplicate_passages(frame(spark, texts)).collect()
    found = {r.doc_id for r in got} | {r.other_doc_id for r in got}
    assert found == {i for i, k in enumerate(holds) if k is not None}
    label = {r.doc_id: r.class_id for r in got}
    for k in range(3):
        assert len({label[i] for i, h in enumerate(holds) if h == k and i in label}) == 1
    assert len(set(label.values())) == 3
    for r in got:
        if r.kind == "copy":
            assert texts[r.doc_id] == texts[r.other_doc_id]
            continue
        a, b = (texts[i].encode()[x:y].decode() for i, x, y in (
            (r.doc_id, r.start, r.end), (r.other_doc_id, r.other_start, r.other_end)))
        assert len(a.split()) >= 50 and len(b.split()) >= 50
        grams = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b)]
        assert len(grams[0] & grams[1]) / len(grams[0] | grams[1]) == pytest.approx(r.similarity)
        assert r.similarity >= 0.8


def test_passages_at_the_threshold_agree_in_enough_functions():
    rng = random.Random(43)
    missed = 0
    for _ in range(400):  # 50 words, one changed in the middle: 41 of 51 shingles
        words = prose(rng, 50).split(" ")
        other = [*words[:25], prose(rng, 1), *words[26:]]
        w = passages.Words([" ".join(x).encode() for x in (words, other)], passages.SPACE)
        sh, first = w.shingles(5)
        one, two = set(sh[:first[1]].tolist()), set(sh[first[1]:].tolist())
        assert len(one & two) / len(one | two) == pytest.approx(41 / 51)
        agree = 0
        for f in range(passages.FUNCTIONS):
            text, *_, key = passages.compact_windows(sh, first, 46, f)
            agree += bool(set(key[text == 0]) & set(key[text == 1]))
        missed += agree < passages.MIN_FUNCTIONS
    assert missed == 0


def best_windows(a, b, least=46):
    """The highest Jaccard similarity of any window of one text and any of the other, of ``least``
    shingles or more each; for texts that repeat no shingle.  Independent of the code under test."""
    one, two = ([tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)] for t in (a, b))
    if min(len(one), len(two)) < least:
        return 0.0
    equal = np.array([[x == y for y in two] for x in one], dtype=np.int32)
    total = np.zeros((len(one) + 1, len(two) + 1), dtype=np.int32)
    total[1:, 1:] = equal.cumsum(0).cumsum(1)
    x, y = np.triu_indices(len(two) + 1, least)
    best = 0.0
    for i in range(len(one) - least + 1):
        for j in range(i + least, len(one) + 1):
            both = total[j, y] - total[i, y] - total[j, x] + total[i, x]
            best = max(best, float((both / ((j - i) + (y - x) - both)).max()))
    return best


def word_edited(rng, words, edits):
    """Words replaced, added and removed at the start, in the middle and at the end."""
    out = list(words)
    for _ in range(edits):
        at = rng.choice([0, len(out) - 1, rng.randrange(len(out))])
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = prose(rng, 1)
        elif kind == 1:
            out.insert(at, prose(rng, 1))
        else:
            del out[at]
    return out


def test_verification_finds_what_all_windows_hold():
    rng = random.Random(53)
    held = 0
    for _ in range(150):
        body = prose(rng, rng.randrange(50, 64)).split(" ")
        other = word_edited(rng, body, rng.randrange(1, 5))
        a, b = (" ".join([prose(rng, rng.randrange(1, 9)), *x, prose(rng, rng.randrange(1, 9))])
                for x in (body, other))
        best = best_windows(a, b)
        for u, v in ((a, b), (b, a)):
            got = passages.passages(u.encode(), v.encode(), 50, 0.8)
            assert bool(got) == (best >= 0.8 - 1e-9), best
            for x, y, z, w, similarity in got:
                p, q = (t.encode()[i:j].decode().split() for t, i, j in ((u, x, y), (v, z, w)))
                grams = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (p, q)]
                assert min(len(p), len(q)) >= 50
                assert similarity == pytest.approx(len(grams[0] & grams[1]) / len(grams[0] | grams[1]))
                assert similarity >= 0.8 - 1e-9
        held += best >= 0.8
    assert held > 60


def test_parts_in_another_order_and_repeats_are_found():
    rng = random.Random(59)
    one, two, line = prose(rng, 40), prose(rng, 45), prose(rng, 12)
    assert passages.passages(f"{one} {two}".encode(), f"{two} {one}".encode(), 50, 0.8)
    assert passages.passages(f"{line} ".encode() * 30, f"{line} ".encode() * 9, 50, 0.8)
    assert passages.passages(f"{line} ".encode() * 30, f"{prose(rng, 90)} {line}".encode(), 50, 0.8) == []


def test_long_pairs_are_compared_in_near_linear_time():
    rng = random.Random(61)
    words = prose(rng, 6400).split(" ")
    every21 = [prose(rng, 1) if i % 21 == 0 else w for i, w in enumerate(words)]
    blocks = [words[i:i + 30] for i in range(0, len(words), 30)]
    rng.shuffle(blocks)
    for other, some in ((every21, False), ([w for b in blocks for w in b], None),
                        ([prose(rng, 1) if i % 60 == 0 else w for i, w in enumerate(words)], True)):
        start = time.perf_counter()
        got = passages.passages(" ".join(words).encode(), " ".join(other).encode(), 50, 0.8)
        assert time.perf_counter() - start < 5
        assert some is None or bool(got) == some


def test_edited_passages_are_found_as_by_all_windows(spark):
    rng = random.Random(47)
    texts, bodies = [], []
    for n in (50, 52, 55, 60, 66):
        for _ in range(3):
            body = prose(rng, n).split(" ")
            for edits in (0, 1, 1, 2, 3):
                texts.append(" ".join([prose(rng, 7), *word_edited(rng, body, edits), prose(rng, 6)]))
                bodies.append(len(bodies) // 5)
    line = prose(rng, 9)  # in every text: no passage, but a group of all texts
    texts = [f"{t}\n{line}\n{prose(rng, 8)}" for t in texts]
    texts += [f"{prose(rng, 40)}\n{line}\n{prose(rng, 40)}" for _ in range(60)]
    want = [(i, j) for j in range(len(bodies)) for i in range(j) if bodies[i] == bodies[j]
            and best_windows(texts[i], texts[j]) >= 0.8 - 1e-9]
    assert len(want) > 70
    for small in (2, passages.SMALL_GROUP):
        got = passages.near_duplicate_passages(frame(spark, texts), small=small).collect()
        label = {x: r.class_id for r in got for x in (r.doc_id, r.other_doc_id)}
        assert [p for p in want if p[0] not in label or label[p[0]] != label.get(p[1])] == []
        assert not any(x in label for x in range(len(bodies), len(texts)))


def test_families_that_share_a_line_within_their_passage(spark):
    # The line's groups hold both families and lone texts; each family must still find itself.
    rng = random.Random(67)
    line = prose(rng, 14)
    one, two = (f"{prose(rng, 30)} {line} {prose(rng, 30)}" for _ in range(2))
    texts = [f"{prose(rng, 20)} {p} {prose(rng, 20)}" for p in (one, two) for _ in range(25)]
    texts += [f"{prose(rng, 50)} {line} {prose(rng, 50)}" for _ in range(40)]
    got = passages.near_duplicate_passages(frame(spark, texts), small=4).collect()
    label = {x: r.class_id for r in got for x in (r.doc_id, r.other_doc_id)}
    assert set(label) == set(range(50))
    assert len({label[i] for i in range(25)}) == len({label[i] for i in range(25, 50)}) == 1
    assert len(set(label.values())) == 2


def test_no_partner_is_dropped_in_large_groups_of_passages(spark):
    # 42 of 50 words of each passage are one line, of which 38 shingles are too few for a passage:
    # most windows that meet do so in groups of all texts.
    rng = random.Random(79)
    line = prose(rng, 42)
    cores = [f"{prose(rng, 4)} {line} {prose(rng, 4)}" for _ in range(25)]
    texts = [f"{prose(rng, 20)} {p} {prose(rng, 20)}" for p in cores for _ in range(2)]
    texts += [f"x{k}a x{k}b x{k}c x{k}d {line} y{k}a y{k}b y{k}c y{k}d" for k in range(30)]
    for options in ({"small": 2}, {"small": 2, "turns": 0}):
        got = passages.near_duplicate_passages(frame(spark, texts), **options).collect()
        label = {x: r.class_id for r in got for x in (r.doc_id, r.other_doc_id)}
        assert [k for k in range(25) if 2 * k not in label or label[2 * k] != label.get(2 * k + 1)] == []
        assert set(label) == set(range(50)) and len(set(label.values())) == 25


def test_place_joins_reach_all_members_of_an_owner(spark):
    # Of two places with one owner only one was compared with the group's other owners.
    rows = spark.createDataFrame([(1, n, 0, 0, 9, o) for n, o in ((10, 10), (11, 10), (12, 12))],
                                 "key long, node long, c int, l int, r int, owner long")
    links = spark.createDataFrame([(10, 11, 0, 9, 0, 9)],
                                  "u long, v long, u_start long, u_end long, v_start long, v_end long")
    labels = spark.createDataFrame([(10, 10), (11, 10)], "node long, label long")
    texts = spark.createDataFrame([], "node long, text string")
    got = passages._rest(rows.drop("owner"), links, labels, None, texts, 50, 0.8, 4).collect()
    assert {(r.u, r.v) for r in got} == {(10, 12), (11, 12)}


def test_only_texts_that_may_hold_a_passage_have_windows(spark, monkeypatch):
    rng = random.Random(41)
    line, shared = prose(rng, 20), prose(rng, 60)
    texts = [f"{prose(rng, 70)} {line} {prose(rng, 70)}" for _ in range(40)]
    texts += [f"{prose(rng, 30)} {shared} {prose(rng, 40)}" for _ in range(2)]
    seen, stored = {}, passages.stored
    monkeypatch.setattr(passages, "stored", lambda df, name: seen.setdefault(name, stored(df, name)))
    got = passages.near_duplicate_passages(frame(spark, texts)).collect()
    assert {r.doc_id for r in got} | {r.other_doc_id for r in got} == {40, 41}
    assert seen["hits"].select("node").distinct().count() == 2


def test_filter_holds_all_shingles_of_several_texts(spark):
    rng = random.Random(42)
    line, shared = prose(rng, 60), prose(rng, 3000)
    texts = [f"{prose(rng, 500)} {line} {line} {shared}", f"{shared} {prose(rng, 500)}", prose(rng, 4000), ""]
    docs = frame(spark, texts).selectExpr("doc_id as node", "text")
    several = passages._shared_shingles(docs, 50)
    w = passages.Words([t.encode() for t in texts], passages.SPACE)
    shingles, first = w.shingles(passages.SHINGLE)
    sets = [set(shingles[x:y].tolist()) for x, y in zip(first[:-1], first[1:])]
    common = np.isin(shingles, np.array(list(sets[0] & sets[1]), dtype=np.uint64))
    for most in (passages.FILTER_BYTES, 1):
        held = passages._Filter(several, most).holds(shingles)
        assert held[common].all()
        assert most == 1 or held[~common].mean() < 0.2


def test_fewest_distinct_shingles_of_any_stretch():
    rng = np.random.default_rng(43)
    for size, kinds, least in ((60, 5, 10), (60, 200, 46), (46, 20, 46), (20, 4, 46), (300, 250, 46)):
        for _ in range(20):
            x = rng.integers(0, kinds, size).astype(np.uint64)
            plain = min((len(set(x[i:i + least].tolist())) for i in range(size - least + 1)), default=None)
            assert size < least or passages._least_distinct(x, least) == plain


def test_pairs_compared_together_give_what_each_gives(monkeypatch):
    rng = random.Random(44)
    shared = prose(rng, 80)
    left = [f"{prose(rng, 20)} {shared} {prose(rng, n)}".encode() for n in range(6)] + [b"", shared.encode()]
    right = [f"{prose(rng, n)} {shared}".encode() for n in range(6)] + [shared.encode()] * 2
    monkeypatch.setattr(passages, "SLICE_BYTES", 2000)
    each = [passages.passages(a, b, 50, 0.8) for a, b in zip(left, right)]
    assert list(passages._passages(left, right, 50, 0.8)) == each
    assert [len(x) for x in each] == [1] * 6 + [0, 1] and each[-1][0][4] == 1.0


def test_segments_hold_every_stretch_of_words():
    rng = random.Random(71)
    data = " ".join(rng.choice(WORDS) for _ in range(3000)).encode() + b"  \n" + b"x" * 900
    for size in (500, 2000, 10**6):
        parts = passages.segments(data, 50, size)
        assert all(data[a:a + len(p)] == p for a, p in parts) and parts[0][0] == 0
        assert parts[-1][0] + len(parts[-1][1]) == len(data)
        words = [m.span() for m in re.finditer(rb"[^ \n]+", data)]
        for i in range(0, len(words) - 49, 7):
            a, b = words[i][0], words[i + 49][1]
            assert any(at <= a and b <= at + len(p) for at, p in parts)


def test_long_texts_in_segments_find_the_same(spark, monkeypatch):
    rng = random.Random(73)
    shared = prose(rng, 70)
    texts = [f"{prose(rng, n)} {shared} {prose(rng, 900 - n)}" for n in (5, 300, 640, 880)]
    docs = frame(spark, texts, 1)
    shingles = []
    for size in (10**9, 3000):
        got = [r for b in passages._segmented(np.arange(4), pa.array(texts), 50)[2:] for r in b] \
            if size == 10**9 else [p for t in texts for _, p in passages.segments(t.encode(), 50, size)]
        found = set()
        for part in got:
            w = passages.Words([part], passages.SPACE)
            sh, first = w.shingles(5)
            for f in range(10):
                found |= set(passages.compact_windows(sh, first, 46, f)[4].tolist())
        shingles.append(found)
    assert shingles[0] <= shingles[1]  # no window is lost at a cut
    assert {r.doc_id for r in passages.near_duplicate_passages(docs).collect()} \
        | {r.other_doc_id for r in passages.near_duplicate_passages(docs).collect()} == {0, 1, 2, 3}


def test_neighbouring_passages_set_apart_are_found():
    rng = random.Random(41)
    p, q = prose(rng, 60), prose(rng, 60)
    u, v = f"{p} {q}".encode(), f"{p} {prose(rng, 30)} {q}".encode()
    for a, b in ((u, v), (v, u)):
        got = passages.passages(a, b, 50, 0.8)
        assert sorted(a[x:y].decode() for x, y, *_ in got) == sorted((p, q))
        assert all(a[x:y] == b[z:w] and s == 1 for x, y, z, w, s in got)


def test_passages_of_awkward_rows(spark):
    got = passages.near_duplicate_passages(awkward(spark)).collect()
    assert {r.kind for r in got} <= {"copy", "passage"}
    long = {(r.doc_id, r.other_doc_id) for r in got}
    assert any({51, 54} == set(x) for x in long)  # two equal long texts
    assert any(57 in x for x in long)  # and one with a tail


# --------------------------------------------------------------- exact repeats

def brute_repeats(rows, length):
    """rows in order of (document, text): bytes objects."""
    seen, out = set(), []
    for data in rows:
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                covered[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, m in zip(data, covered) if not m)
        spans = sum(1 for i, m in enumerate(covered) if m and not (i and covered[i - 1]))
        out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check_repeats(docs, length=100, **options):
    got = repeats.repeated_bytes(docs, length=length, **options).collect()
    src = docs.select("doc_id", "text").collect()
    order = sorted(src, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    ids = [r.doc_id for r in order]
    assert len(set(ids)) == len(ids)
    want = brute_repeats([(r.text or "").encode() for r in order], length)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(zip(ids, want))


@pytest.mark.parametrize("bucket", [0, 3, 16])
def test_repeats_of_planted_texts(spark, bucket):
    rng = random.Random(31)
    shared = [prose(rng, n) for n in (9, 12, 30, 60)]
    texts = [prose(rng, 20) + rng.choice(shared) + prose(rng, rng.randrange(15)) + rng.choice(shared)[rng.randrange(30):]
             for _ in range(60)]
    texts += ["ab" * 300, "ab" * 290 + "x", "a" * 400, "é" * 120, "é" * 121, texts[0], None, "", "short"]
    check_repeats(frame(spark, texts), bucket=bucket)


def test_repeats_of_documents(spark):
    check_repeats(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_repeats_with_odd_ids_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    rng = random.Random(8)
    long = prose(rng, 900)
    rows = [(i, t) for i, t in zip([None, -5, 7, 2, 9], [long, long[500:3000], prose(rng, 300) + long[50:900],
                                                         "z" * 250, "z" * 99])]
    check_repeats(spark.createDataFrame(rows, "doc_id long, text string"))


def test_repeats_with_repeated_rows(spark):
    docs = awkward(spark)
    got = repeats.repeated_bytes(docs).collect()
    src = docs.select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode())) for r in src)
    rng = random.Random(9)
    text = prose(rng, 50)
    twice = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert sorted(r.n_removed for r in repeats.repeated_bytes(twice).collect()) == [0, len(text)]


def test_texts_without_repeats(spark):
    rng = random.Random(12)
    a, b = prose(rng, 60), "é" * 30 + prose(rng, 60)
    docs = frame(spark, [a, b, prose(rng, 10) + " " + a, b[20:] + " own end", None])
    left = repeats.without_repeats(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[0] == a and texts[1] == b and a[:200] not in texts[2]
    assert texts[3].endswith(" own end") and len(texts[3]) < 20 and texts[4] == ""


def test_empty_tables(spark):
    assert neardup.near_duplicates(empty(spark)).collect() == []
    assert neardup.deduplicated(empty(spark)).collect() == []
    assert passages.near_duplicate_passages(empty(spark)).collect() == []
    assert repeats.repeated_bytes(empty(spark)).collect() == []
    assert repeats.without_repeats(empty(spark)).collect() == []


def test_likeliest_pairs_stay_few_for_hubs(spark):
    pairs = spark.range(1, 400).selectExpr("0L as u", "id as v", "id as n").union(
        spark.sql("select 1L as u, 2L as v, 9L as n"))
    got = {(r.u, r.v) for r in neardup._likeliest(pairs).collect()}
    assert (0, 399) in got and len(got) <= 400
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "node long, label long")
    left = neardup._across(pairs.filter("v < 4").select("u", "v"), labels).collect()
    assert {(r.u, r.v) for r in left} == {(0, 2), (1, 2), (0, 3)}


def test_one_template_in_many_versions_is_compared_in_few_pairs(spark, monkeypatch):
    # Versions just under the threshold from one another, and some families above it.
    rng = random.Random(83)
    body = prose(rng, 160).split(" ")
    texts, family = [], []
    for k in range(150):
        words = list(body)
        for at in rng.sample(range(160), 7):
            words[at] = prose(rng, 1)
        for _ in range(1 + (k % 5 == 0)):
            texts.append(" ".join([*words, *prose(rng, 2).split(" ")]))
            family.append(k)
    compared = []
    verified = neardup.verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(neardup, "verified", counted)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, texts), small=4).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    links = [(i, j) for j in range(len(texts)) for i in range(j)
             if len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j])]
    assert len(links) >= 30 and all(got[i] == got[j] for i, j in links)
    assert sum(compared) < len(texts) ** 2 / 4


def test_texts_that_repeat_a_sentence_are_compared_in_few_pairs(spark, monkeypatch):
    # Half of each text's weight is one sentence, many times over; some are near copies of others.
    rng = random.Random(29)
    sentence, texts = prose(rng, 8) + " ", []
    for k in range(120):
        own = prose(rng, 60)
        texts += [sentence * rng.randint(6, 12) + x for x in [own, edited(rng, own, 1)][:1 + (k % 4 == 0)]]
    owner, shingle, count = neardup.weighted_shingles([t.lower().encode() for t in texts])
    sets = [(shingle[owner == i], count[owner == i]) for i in range(len(texts))]
    keys = neardup.band_keys(neardup.prob_minhash(owner, shingle, count, len(texts), 20), 20, 1)
    want = [(i, j) for j in range(len(texts)) for i in range(j) if (keys[i] == keys[j]).any()
            and neardup.prob_jaccard(sets[i], sets[j]) >= 0.8]
    compared = []
    verified = neardup.verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(neardup, "verified", counted)
    docs = frame(spark, texts)
    docs = docs.union(docs.filter("doc_id < 9"))  # repeated rows
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs, bands=20, rows=1, small=4).collect()}
    assert len(want) >= 20 and all(got[i] == got[j] for i, j in want)
    assert sum(compared[1:]) < len(texts)  # the first are the pairs of buckets' heads


def test_pairs_of_the_threshold_are_within_the_bound_of_what_is_apart(spark):
    rng, rows = random.Random(31), []
    for _ in range(400):
        w = {k: rng.choice((1, 1, 1, 2, 9)) for k in range(rng.randint(4, 40))}
        v = {k: max(1, n + rng.choice((0, 0, 0, 1, -1))) for k, n in w.items() if rng.random() < 0.95}
        v |= {100 + k: rng.choice((1, 1, 3)) for k in range(rng.randint(0, 3))}
        pair = [(np.array(sorted(x), dtype=np.uint64), np.array([x[k] for k in sorted(x)])) for x in (w, v)]
        if len(v) and neardup.prob_jaccard(*pair) >= 0.8:
            apart = sum(n for x, y in ((w, v), (v, w)) for k, n in x.items() if k not in y)
            rows.append((len(w), sum(w.values()), len(v), sum(v.values()), apart))
    a, b = (spark.createDataFrame([(i, *r[k:k + 2], r[4]) for i, r in enumerate(rows)], "id int, size int, total long, apart long")
            .alias(x) for x, k in (("a", 0), ("b", 2)))
    joined = a.join(b, "id")
    assert len(rows) > 50 and joined.filter(neardup._most_apart(0.8) < F.col("a.apart")).count() == 0
    assert joined.filter(neardup._most_apart(0.8) < F.col("a.apart") + 2).count() > 0  # hardly wider than needed
