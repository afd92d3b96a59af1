"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is the multiset of its five-word shingles (lower-cased words between
white space).  Each shingle sends arrivals of a Poisson process of rate equal to
its count to random registers; a register keeps the shingle that arrives first,
and a process ends as soon as its next arrival cannot be first anywhere.  Two
documents agree in a register with the probability Jaccard similarity

    J_P(w, v) = sum over common i of 1 / sum_j max(w_j / w_i, v_j / v_i),

which is the Jaccard similarity where all counts are one.  Documents that agree
in a whole band of registers are compared exactly; links of at least the
threshold make classes.

Work per bucket stays linear.  Equal texts are one node.  In each bucket every
node is compared with the bucket's least node; what that links is one class.
Only buckets that still hold several classes compare across classes: pair by
pair up to ``small`` nodes; larger ones are joined on rare shingles, a filter that
loses no pair of the threshold.  Of these pairs each node's likeliest are compared
first, and then all whose classes still differ.

Cases: null and empty texts are copies of each other; a text of fewer than five
words is one shingle of all its words; repeated rows are copies; null ids are
kept; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsfold.llm.components import components
from opsfold.llm.frames import free_name, stored, text_or_empty, trimmed
from opsfold.llm.hashing import U64, Words, lowered, mix, slices

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 4
SMALL_BUCKET = 32
LIKELIEST = 3  # pairs of a node that are compared before the others
SLICE_BYTES = 500_000
# Broadcast of at most this many 16-byte text keys; beyond it, shuffle joins.
MAX_BROADCAST_TEXTS = 200_000


def weighted_shingles(parts: list[bytes], width: int = SHINGLE):
    """Distinct shingle hashes of each text with counts: (owner, hash, count), sorted."""
    w = Words(parts)
    hashes, first = w.shingles(width)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(parts)), counts)
    short = np.flatnonzero((counts == 0) & (np.diff(w.first) > 0))
    if len(short):  # fewer words than a shingle: one shingle of them all
        extra = []
        for i in short:
            h = np.array([w.first[i + 1] - w.first[i]], dtype=U64)
            for x in w.hashes[w.first[i]:w.first[i + 1]]:
                h = mix(h * U64(31) + x)
            extra.append(h[0])
        hashes = np.concatenate([hashes, np.array(extra, dtype=U64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return o[at], h[at], np.diff(np.append(at, len(h)))


def _exponential(h: np.ndarray) -> np.ndarray:
    u = ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
    return -np.log(u)


def prob_minhash(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int,
                 registers: int) -> np.ndarray:
    """The first shingle in each register of each text; zero where there is none."""
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, dtype=U64)
    total = np.bincount(owner, weights=count, minlength=texts)
    # All registers of most texts are filled by this time; arrivals after it are looked at
    # only for texts that have a register without an arrival before.
    soon = registers * (np.log(registers) + 3) / np.maximum(total, 1e-9)
    seed = mix(shingle ^ U64(0x5851F42D4C957F2D))
    time = _exponential(mix(seed + U64(1))) / count

    def run(live: np.ndarray, clock: np.ndarray, until: np.ndarray) -> tuple[list, list, list]:
        """Take all arrivals before ``until``; returns the processes that go on after it."""
        left = ([], [], [])
        step = np.ones(len(live), dtype=np.int64)
        while len(live):
            o = owner[live]
            late = clock >= until[o]
            for out, x in zip(left, (live, clock, step)):
                out.append(x[late])
            ok = ~late
            live, clock, step, o = live[ok], clock[ok], step[ok], o[ok]
            h = mix(seed[live] + U64(2) * step.astype(U64))
            cell = o * registers + (h % U64(registers)).astype(np.int64)
            np.minimum.at(first, cell, clock)
            won = first[cell] == clock
            kept[cell[won]] = shingle[live[won]]
            step = step + 1
            gap = _exponential(mix(seed[live] + U64(2) * step.astype(U64) + U64(1)))
            clock = clock + gap / count[live]
        return left

    left = run(np.arange(len(owner)), time, soon)
    while True:
        last = first.reshape(texts, registers).max(axis=1) if texts else np.empty(0)
        live, clock, step = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in left)
        on = clock < last[owner[live]] if len(live) else np.empty(0, dtype=bool)
        if not on.any():
            return kept.reshape(texts, registers)
        live, clock, step = live[on], clock[on], step[on]
        # One more arrival of every process that may still be first somewhere.
        o = owner[live]
        h = mix(seed[live] + U64(2) * step.astype(U64))
        cell = o * registers + (h % U64(registers)).astype(np.int64)
        np.minimum.at(first, cell, clock)
        won = first[cell] == clock
        kept[cell[won]] = shingle[live[won]]
        step = step + 1
        gap = _exponential(mix(seed[live] + U64(2) * step.astype(U64) + U64(1)))
        left = ([live], [clock + gap / count[live]], [step])


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, as signed integers."""
    out = np.empty((len(signature), bands), dtype=U64)
    for b in range(bands):
        key = np.full(len(signature), U64(b + 1))
        for r in range(rows):
            key = mix(key * U64(0x9E3779B97F4A7C15) + signature[:, b * rows + r])
        out[:, b] = key
    return out.view(np.int64)


def prob_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two (sorted hashes, counts)."""
    if len(a[0]) == 0 or len(b[0]) == 0:
        return float(len(a[0]) == len(b[0]))
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if len(both) == 0:
        return 0.0
    if a[1].max() == 1 and b[1].max() == 1:
        return len(both) / (len(a[0]) + len(b[0]) - len(both))
    w, v = a[1][i].astype(float), b[1][j].astype(float)
    # sum_j max(w_j / w_i, v_j / v_i): the common ones by the ratio v / w, in order.
    order = np.argsort(v / w, kind="stable")
    w, v = w[order], v[order]
    ws, vs = np.cumsum(w), np.cumsum(v[::-1])[::-1]
    w_only, v_only = a[1].sum() - ws[-1], b[1].sum() - vs[0]
    above = np.append(vs[1:], 0.0)
    return float((1 / ((ws + w_only) / w + (above + v_only) / v)).sum())


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """node, doc_id, text_key (of equal texts) and band keys of each row."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    keyed = source.withColumn("text_key", F.unhex(F.md5("text")))
    schema = T.StructType([source.schema["doc_id"], T.StructField("text_key", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            texts = lowered(batch.column(1))
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                owner, shingle, count = weighted_shingles(texts[a:b])
                sig = prob_minhash(owner, shingle, count, b - a, bands * rows)
                keys = band_keys(sig, bands, rows)
                none = np.bincount(owner, minlength=b - a) == 0
                offsets = np.arange(0, (b - a + 1) * bands, bands, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.compute.if_else(pa.array(none), pa.scalar(None, lists.type), lists)],
                    names=schema.names)

    return (keyed.mapInArrow(trimmed(run), schema)
            .select(F.monotonically_increasing_id().alias("node"), "*"))


def _shingle_rows(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingles and counts of the wanted nodes; one pass over the texts."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    keyed = source.withColumn("text_key", F.unhex(F.md5("text")))
    few = wanted.count() <= MAX_BROADCAST_TEXTS
    texts = keyed.join(F.broadcast(wanted) if few else wanted,
                       (keyed["text_key"] == wanted["key"]) & keyed["doc_id"].eqNullSafe(wanted["id"]))

    def run(batches):
        for batch in batches:
            parts = lowered(batch.column(1))
            for a, b in slices([len(t) for t in parts], SLICE_BYTES):
                owner, shingle, count = weighted_shingles(parts[a:b])
                offsets = np.zeros(b - a + 1, dtype=np.int32)
                np.cumsum(np.bincount(owner, minlength=b - a), out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingle.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(count.astype(np.int32)))],
                    names=["node", "shingles", "counts"])

    return texts.select("node", "text").mapInArrow(
        trimmed(run), "node long, shingles array<long>, counts array<int>")


def verified(pairs: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) of at least ``threshold``, with their similarity.

    ``rows`` has the shingles and counts of all their nodes.
    """
    u = rows.select(F.col("node").alias("u"), F.col("shingles").alias("su"), F.col("counts").alias("cu"))
    v = rows.select(F.col("node").alias("v"), F.col("shingles").alias("sv"), F.col("counts").alias("cv"))
    # A hub node's side holds one row; the many pairs of a hub are split by AQE.
    sides = pairs.join(v, "v").join(u, "u")

    def run(batches):
        for batch in batches:
            lists = []
            for name in ("su", "cu", "sv", "cv"):
                column = batch.column(batch.schema.get_field_index(name))
                lists.append((column.offsets.to_numpy(), column.values.to_numpy()))
            sims = np.empty(batch.num_rows)
            for i in range(batch.num_rows):
                su, cu, sv, cv = (x[o[i]:o[i + 1]] for o, x in lists)
                sims[i] = prob_jaccard((su.view(U64), cu), (sv.view(U64), cv))
            keep = pa.array(sims >= threshold - 1e-9)
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(sims)],
                names=["u", "v", "similarity"]).filter(keep)

    return sides.mapInArrow(trimmed(run), "u long, v long, similarity double").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    small: int = SMALL_BUCKET) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, is_kept, text_key.

    ``class_id`` is the least node number of the class; the kept row of each
    class is the one of the least id (nulls last), and of these one.
    """
    nodes = stored(signatures(docs, id_col, text_col, bands, rows), "nodes")
    copies = nodes.groupBy("text_key").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("n"))
    # Only texts with copies, and stored: a text that very many rows hold is broadcast, or its rows
    # are split by AQE in a join of its own.
    copies = stored(copies.filter("n > 1").select("text_key", "rep"), "copies")
    copies = F.broadcast(copies) if copies.count() <= MAX_BROADCAST_TEXTS else copies
    member = nodes.select("node", "doc_id", "text_key").join(copies, "text_key", "left")
    member = stored(member.withColumn("rep", F.coalesce("rep", "node")), "members")
    reps = member.filter("node = rep").select("node")
    banded = stored(nodes.select("node", "bands").join(reps, "node", "left_semi")
                    .filter(F.col("bands").isNotNull()), "bands")
    hits = banded.select("node", F.explode("bands").alias("key"))
    heads = (hits.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1"))
    hits = stored(hits.join(heads, "key"), "hits")
    pairs = stored(hits.filter("node != head").select(F.col("head").alias("u"), F.col("node").alias("v"))
                   .distinct(), "pairs")
    # The nodes of these pairs are those of all buckets, so one pass over the texts serves all that follows.
    wanted = stored(nodes.join(_ends(pairs), "node", "left_semi").select(
        "node", F.col("doc_id").alias("id"), F.col("text_key").alias("key")), "wanted")
    shingles = stored(_shingle_rows(docs, wanted, id_col, text_col), "shingles")
    if shingles.count() > wanted.count():  # repeated rows
        shingles = stored(shingles.dropDuplicates(["node"]), "shingles")
    compared = stored(verified(pairs, shingles, 0.0), "compared")
    links = compared.filter(F.col("similarity") >= threshold - 1e-9).select("u", "v")
    labels = components(links)
    # How far each node of a bucket is from the bucket's head, which tells others apart below.
    far = compared.select(F.col("u").alias("head"), F.col("v").alias("node"),
                          (1 - F.col("similarity")).alias("far"))
    mixed = _mixed(hits.join(far, ["head", "node"], "left").join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"),
        F.when(F.col("node") == F.col("head"), 0.0).otherwise(F.col("far")).alias("far")))
    if not mixed.isEmpty():
        rest = _rest_of_large(mixed.filter(F.col("n") > small), pairs, shingles, threshold)
        first = _across_small(mixed.filter(F.col("n") <= small), pairs, threshold)
        first = stored(first.union(_likeliest(rest)).distinct(), "pairs")
        found = stored(verified(first, _of_ends(shingles, first), threshold).select("u", "v"), "links")
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)
        rest = stored(_across(rest.join(first, ["u", "v"], "left_anti"), labels), "pairs")
        if not rest.isEmpty():
            found = stored(verified(rest, _of_ends(shingles, rest), threshold).select("u", "v"), "links")
            if not found.isEmpty():
                labels = components(links.union(found))
    classes = member.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select(
        "node", "doc_id", "text_key", F.coalesce("label", "rep").alias("class_id"))
    classes = stored(classes, "classes")
    sizes = classes.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("class_size"), F.min("doc_id").alias("__id"),
        F.min(F.when(F.col("doc_id").isNull(), F.col("node"))).alias("__null_node"))
    first = (classes.join(sizes, "class_id")
             .filter(F.col("doc_id").eqNullSafe(F.col("__id")))
             .groupBy("class_id", "class_size").agg(F.min("node").alias("__kept")))
    return classes.join(first, "class_id").select(
        "doc_id", "class_id", "class_size", (F.col("node") == F.col("__kept")).alias("is_kept"),
        "text_key", "node")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()


def _of_ends(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of the nodes of ``pairs``."""
    ends = stored(_ends(pairs), "ends")
    few = ends.count() <= MAX_BROADCAST_TEXTS
    return rows.join(F.broadcast(ends) if few else ends, "node", "left_semi")


def _across_small(mixed: DataFrame, done: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one small bucket whose classes differ, as far as not compared before.

    1 - J_P is a metric: two nodes whose distances from the bucket's head differ by more than
    1 - ``threshold`` are further apart than that, and make no pair.
    """
    return _all_pairs(mixed, 1 - threshold + 1e-9).distinct().join(done, ["u", "v"], "left_anti")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (u, v, n) up to ``LIKELIEST`` of each node, those of largest ``n``."""
    slot = F.pmod(F.xxhash64("u", "v"), F.lit(LIKELIEST)).alias("slot")
    ends = pairs.select(F.col("u").alias("node"), slot, "n", "u", "v").union(
        pairs.select("v", slot, "n", "u", "v"))
    best = ends.groupBy("node", "slot").agg(F.max(F.struct("n", "u", "v")).alias("x"))
    return best.select("x.u", "x.v").distinct()


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose classes differ."""
    a, b = (labels.select(F.col("node").alias(x), F.col("label").alias(f"of_{x}")) for x in "uv")
    joined = pairs.join(a, "u", "left").join(b, "v", "left")
    return joined.filter(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")


def _prefixes(rows: DataFrame, threshold: float) -> DataFrame:
    """key, node, label, size, total, left, before: the rarest shingles of each node, which other classes have.

    J_P is at most the sum over common i of min(w_i / sum w, v_i / sum v).  With
    shingles in one order for all nodes, take of each the first ones, up to where
    less than ``threshold`` of its weight is left: two nodes without a common one
    among these share less than ``threshold``.  ``left`` is the number of shingles from this one on,
    ``before`` the weight of those that come before it, ``total`` that of all ``size`` ones.

    Shingles of a single class come first in that order.  No pair across classes shares
    them, so they only count in the weight and the size of their node and are not joined.
    """
    each = rows.select(
        "node", "label", F.size("shingles").alias("size"),
        F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        F.explode(F.arrays_zip("shingles", "counts")).alias("x"))
    each = each.select("node", "label", "size", "total",
                       F.col("x.shingles").alias("key"), F.col("x.counts").alias("count"))
    of = (each.groupBy("key").agg(F.count(F.lit(1)).alias("of"), F.min("label").alias("lo"),
                                  F.max("label").alias("hi"))
          .filter("lo != hi").select("key", "of"))
    ranked = each.join(of, "key").groupBy("node", "label", "size", "total").agg(
        F.array_sort(F.collect_list(F.struct("of", "key", "count"))).alias("x"))
    ranked = ranked.select("node", "label", "size", "total", "x.key", "x.count")

    def run(batches):
        for batch in batches:
            node, label, size, total, key, count = batch.columns
            ends = key.offsets.to_numpy()
            key, count = (x.values.to_numpy()[ends[0]:ends[-1]] for x in (key, count))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            ends = ends - ends[0]
            sums = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
            left = sums[ends[1:]][row] - sums[:-1]
            weight = total.to_numpy()[row]
            at = np.flatnonzero(left / weight >= threshold - 1e-9)
            row = row[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), *(x.take(pa.array(row)) for x in (node, label, size, total)),
                 pa.array((ends[1:][row] - at).astype(np.int32)), pa.array((weight - left)[at])],
                names=["key", "node", "label", "size", "total", "left", "before"])

    return ranked.mapInArrow(
        trimmed(run), "key long, node long, label long, size int, total long, left int, before long")


def _most_apart(threshold: float):
    """The most weight of shingles that only one of two nodes a and b may have, if they make a pair.

    With D for that weight and S for the sum of max(w_j, v_j): 1 - J_P is at least D / S, as no
    common i has less than S / max(w_i, v_i) below it.  S is W + V, the weights of both, without
    the sum of min(w_i, v_i).  That sum is at least the number of common shingles, so at least
    (sizes - D) / 2; and at least ``threshold`` * min(W, V), as J_P is at most the sum of
    min(w_i / W, v_i / V).
    """
    t = threshold - 1e-9
    weights, sizes = F.col("a.total") + F.col("b.total"), F.col("a.size") + F.col("b.size")
    return (1 - t) * F.least((2 * weights - sizes) / (1 + t),
                             weights - t * F.least("a.total", "b.total")) + 1e-6


def _rest_of_large(mixed: DataFrame, done: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """All pairs across classes of large buckets that may reach ``threshold``, not compared before.

    ``n`` is the number of rare shingles that they share to that of the smaller one's shingles.
    """
    ends = stored(mixed.select("node", "label").distinct(), "rest")
    few = ends.count() <= MAX_BROADCAST_TEXTS
    rows = stored(shingles.join(F.broadcast(ends) if few else ends, "node"), "shingles")
    prefixes = stored(_prefixes(rows, threshold), "prefixes")
    prefixes = _mixed(prefixes)
    a, b = prefixes.alias("a"), prefixes.alias("b")
    # From the first shingle that they share on, both have all that they share.
    apart, size = _most_apart(threshold), F.least("a.size", "b.size")
    least = (F.col("a.size") + F.col("b.size") - apart) / 2
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node"))
                   & (F.col("a.label") != F.col("b.label"))
                   & (F.least("a.left", "b.left") >= least) & (F.col("a.before") + F.col("b.before") <= apart))
    pairs = pairs.groupBy(F.col("a.node").alias("u"), F.col("b.node").alias("v")).agg(
        (F.count(F.lit(1)) / F.first(size)).alias("n"))
    return stored(pairs.join(done, ["u", "v"], "left_anti"), "pairs")


def _all_pairs(rows: DataFrame, reach: float) -> DataFrame:
    """Pairs across classes of buckets of bounded size, about as far from the bucket's head."""
    a = rows.select("key", F.col("node").alias("u"), F.col("label").alias("a"), F.col("far").alias("x"))
    b = rows.select("key", F.col("node").alias("v"), F.col("label").alias("b"), F.col("far").alias("y"))
    near = (F.col("u") < F.col("v")) & (F.col("a") != F.col("b")) & (F.abs(F.col("x") - F.col("y")) <= reach)
    return a.join(b, "key").filter(near).select("u", "v")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold several classes, with the bucket's size."""
    of = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"),
                                 F.max("label").alias("hi")).filter("lo != hi").select("key", "n")
    return stored(rows.join(of, "key"), "mixed")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """``docs`` with one row of each class; all columns stay."""
    found = near_duplicates(docs, id_col, text_col, **options)
    counts = found.groupBy("text_key", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("is_kept").cast("int")).alias("kept"))
    counts = stored(counts, "decisions")
    goes = counts.filter("kept = 0").select(F.col("text_key").alias("__key"), F.col("doc_id").alias("__id"))
    goes = F.broadcast(goes) if goes.count() <= MAX_BROADCAST_TEXTS else goes
    key = F.unhex(F.md5(text_or_empty(text_col)))
    name = free_name("__text_key", docs)
    keyed = docs.withColumn(name, key)
    left = keyed.join(goes, (keyed[name] == goes["__key"])
                      & keyed[id_col].eqNullSafe(goes["__id"]), "left_anti")
    if not counts.filter("kept = 1 and n > 1").isEmpty():  # rows with one id and one text
        left = left.dropDuplicates([name, id_col])
    return left.drop(name)
