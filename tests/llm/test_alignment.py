"""Token alignment against offsets of the two libraries, text by text."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opsfold.llm import alignment
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.fixtures import awkward, awkward_texts, empty


def plain_tools():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(alignment.default_tokenizer())
    library.encode_special_tokens = True
    return library, alignment.tokenizers(alignment.default_tokenizer(), alignment.default_pieces())[1].model


def plain_tokens(text, tools):
    """(id, start, end) byte ranges of A and of B, or two empty lists."""
    library, model = tools
    if not text:
        return [], []
    byte = alignment._byte_of_char()
    out = []
    a = [(i, bytes(byte[c] for c in library.id_to_token(i)))
         for i in library.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
          else model.id_to_piece(i).replace("▁", " ").encode()) for i in model.encode(text)]
    for tokens in (a, b):
        at, spans = 0, []
        for i, data in tokens:
            spans.append((i, at, at + len(data)))
            at += len(data)
        out.append(spans)
        if b"".join(d for _, d in tokens) != (" " + text).encode():
            return [], []
    return out


def plain(texts):
    tools = plain_tools()
    cut = [plain_tokens(t, tools) for t in texts]
    links, counts = [], Counter()
    for a, b in cut:
        mine, j = [], 0
        for i, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                mine.append((i, b[k][0]))
                k += 1
        links.append(mine)
        counts.update(mine)
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for (a, b), mine in zip(cut, links, strict=True):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = written_groups(a, b, ends)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(ends), len(mine), sum(counts[p] == best[p[1]] for p in mine),
                    sum(counts[p] for p in mine), digest))
    return out


def written_groups(a, b, ends):
    groups, i, j = [], 0, 0
    for end in ends:
        one, two = [], []
        while i < len(a) and a[i][2] <= end:
            one.append(str(a[i][0]))
            i += 1
        while j < len(b) and b[j][2] <= end:
            two.append(str(b[j][0]))
            j += 1
        groups.append(",".join(one) + "|" + ",".join(two))
    return groups


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(docs, **options):
    source = docs.select("doc_id", "text").collect()
    got = Counter((r.doc_id, *(r[f] for f in FIELDS)) for r in alignment.align(docs, **options).collect())
    assert got == Counter((r.doc_id, *w) for r, w in zip(source, plain([r.text for r in source]), strict=True))
    return got


def test_documents(spark):
    got = check(spark.read.parquet(f"{SF001}/documents.parquet"))
    assert sum(r[4] for r in got) > 0


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, 700])
def test_awkward(spark, max_pairs):
    check(awkward(spark), max_pairs=max_pairs)


def test_texts_that_cannot_be_aligned_and_empty_table(spark):
    rows = [(1, "a▁b"), (2, "<s> and </s> <unk> <0x41>"), (3, "<|endoftext|>"), (4, "\n"), (5, " "),
            (6, "𝄞 clef"), (None, "a▁b"), (7, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs)
    got = {r.doc_id: r for r in alignment.align(docs).collect()}
    assert got[1].n_a == got[1].count_sum == 0 and got[1].groups_sha256 == ""
    assert got[3].n_a > 1 and got[2].n_links > 0
    assert alignment.align(empty(spark)).collect() == []


def test_long_texts_are_cut_without_a_trace():
    tools = alignment.tokenizers(alignment.default_tokenizer(), alignment.default_pieces())
    texts = [t for t in awkward_texts() if t] + ["word  two   spaces \n lines\n" * 3000, "x" * 20_000]
    texts = [t[:30_000] for t in texts]
    whole = alignment.align_texts(texts, tools, chunk=10**9)
    for chunk in (1, 7, 500):
        cut = alignment.align_texts(texts, tools, chunk=chunk, size=1000)
        assert (cut[0] == whole[0]).all() and cut[1] == whole[1]
        sums = [Counter() for _ in range(2)]
        for total, (text, pair, n) in zip(sums, (whole[2], cut[2]), strict=True):
            for t, p, k in zip(text.tolist(), pair.tolist(), n.tolist(), strict=True):
                total[t, p] += k
        assert sums[0] == sums[1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1 é.,'\n\t\r 　▁!s日|<>-🙂\x00"), max_size=50),
       st.integers(1, 20))
def test_odd_texts(text, chunk):
    tools = alignment.tokenizers(alignment.default_tokenizer(), alignment.default_pieces())
    assert " ".join(alignment.chunks(text, chunk)) == text
    counts, digest, _ = alignment.align_texts([text], tools, chunk=chunk)
    (want,) = plain([text])
    assert (*counts[0], digest[0]) == (*want[:4], want[6])


def test_a_library():
    tools = alignment.tokenizers(alignment.default_tokenizer(), alignment.default_pieces())
    texts = [t for t in awkward_texts() if t and "<|" not in t]
    assert [x.tolist() for x in tools[0].encode(texts)] == brute.library_ids([" " + t for t in texts])
