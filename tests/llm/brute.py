"""Plain single-process versions of the operators' contracts."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from functools import cache

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@cache
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library_ids(texts):
    return [e.ids for e in library().encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def best_fit_bins(lengths, capacity):
    """Number of bins of best-fit decreasing, item by item."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    return rooms


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i:i + 8])].append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def line_verdicts(rows, min_docs, max_share, min_kept_words, min_kept_share):
    """rows: (doc_id, text, host).  Returns doc_id -> words removed."""
    norm = lambda x: " ".join(WORD.findall(x.lower()))
    by_host = defaultdict(list)
    for _, text, host in rows:
        by_host[host].append(text or "")
    cut = {}
    for host, texts in by_host.items():
        count = defaultdict(int)
        for t in texts:
            for line in {norm(x) for x in t.split("\n")} - {""}:
                count[line] += 1
        limit = max(min_docs, len(texts) * max_share)
        cut[host] = {line for line, n in count.items() if n > limit}
    out = {}
    for doc_id, text, host in rows:
        n = [norm(x) for x in (text or "").split("\n")]
        out[doc_id] = sum(len(x.split(" ")) for x in n if x in cut[host])
    return out
