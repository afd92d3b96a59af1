"""Token ids of whole texts by the ``tokenizers`` library, with a cache of pieces.

A byte-level BPE never joins bytes across a word boundary.  A single space or
newline between two non-space characters always starts a new pre-token, so a
text without other white space is the sequence of its space- or newline-led
pieces, and equal pieces have equal ids.  Each distinct piece goes through the
library once; texts (or pieces) for which this does not hold go to it whole.
"""

from __future__ import annotations

import os
import re
import struct
from itertools import filterfalse
from operator import add

import numpy as np

from opsfold.llm.hashing import slices

BLANK = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u206f\u3000\ufeff"
# A letter or digit, then ASCII punctuation: always a pre-token boundary in between.
_WORD_END = frozenset(c for c in map(chr, range(0x250)) if c.isalpha() and c.upper() != c.lower()
                      or c in "0123456789")
_PUNCTUATION = ".,!?;:|*#&$%"
LINES = 256
CACHE_PIECES = 600_000
_encoders: dict[tuple[str, int, int], PieceEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces_of(text: str) -> list[str]:
    """Pieces led by a newline as they are, others without their leading space."""
    return ("\n" + text).replace("\n", " \n").split(" ")[1:]


class PieceEncoder:
    """``encode(texts)`` gives each text's ids as little-endian 32-bit bytes.

    The cache holds two generations of at most ``max_entries`` pieces each; the
    older one is dropped when the younger is full, so memory stays bounded.
    """

    def __init__(self, path: str, max_entries: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.max_entries = max_entries
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Pieces that are no piece by themselves: empty, white space next to their ends or
        # to other white space, or part of them is a special token.
        self.unsafe = re.compile("|".join(
            [f"^(?:\\n|(?!\\n))(?:[{BLANK}]|\\Z)", f"[{BLANK}](?:[{BLANK}]|\\Z)",
             *map(re.escape, special)])).search
        self.newline = self._whole(["\n"])[0]
        self.newline_id = int.from_bytes(self.newline[:4], "little")
        self.cached = (self.library.normalizer is None and len(self.newline) == 4
                       and not any(re.search(r"\s", s) for s in special))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids)
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without newlines, which are encoded as the lines of longer texts."""
        out: list[bytes] = []
        groups = [texts[a:a + LINES] for a in range(0, len(texts), LINES)]
        for group, data in zip(groups, self._whole(["\n".join(g) for g in groups]), strict=True):
            ids = np.frombuffer(data, dtype="<u4")
            cuts = (4 * np.flatnonzero(ids == self.newline_id)).tolist()
            if len(cuts) != len(group) - 1:
                out += self._whole(group)
                continue
            begins = [0, *(c + 4 for c in cuts)]
            cuts.append(len(data))
            out += [data[x:y] for x, y in zip(begins, cuts, strict=True)]
        return out

    def _unknown(self, pieces: set[str]) -> set[str]:
        """The pieces that are not cached; known ones move to the young generation."""
        new = set(filterfalse(self.young.__contains__, pieces))
        again = list(filter(self.old.__contains__, new))
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        new.difference_update(again)
        return new

    def learn(self, pieces: set[str]) -> None:
        """Cache the ids of new pieces, or None for those that are no piece by themselves."""
        young, new = self.young, self._unknown(pieces)
        # One search over all: an odd piece puts a blank next to one of the joining spaces.
        spaced = [p for p in new if p[:1] != "\n"]
        led = [p for p in new if p[:1] == "\n"]
        if self.unsafe(" ".join(spaced + [p[1:] for p in led])):
            odd = [p for p in new if self.unsafe(p)]
            young.update(dict.fromkeys(odd))
            new.difference_update(odd)
        # Lists of strings only: many small tuples would make the garbage collector run often.
        tailed = [p for p in new if p[-1] in _PUNCTUATION and p.rstrip(_PUNCTUATION)[-1:] in _WORD_END]
        bases = [p.rstrip(_PUNCTUATION) for p in tailed]
        new.difference_update(tailed)
        new |= self._unknown(set(bases))
        spaced = [p for p in new if p[0] != "\n"]
        led = [p for p in new if p[0] == "\n"]
        young.update(zip(spaced, self._lines([" " + p for p in spaced]), strict=True))
        bare = self._lines([p[1:] for p in led])
        young.update(zip(led, (self.newline + b for b in bare), strict=True))
        tails = [p[len(s):] for p, s in zip(tailed, bases, strict=True)]
        ends = list(set(tails))
        end_ids = dict(zip(ends, self._lines(ends), strict=True))
        young.update(zip(tailed, map(add, map(young.__getitem__, bases), map(end_ids.__getitem__, tails)),
                         strict=True))

    def counts(self, parts: list[str]) -> list[int]:
        """Token counts of parts of texts, mostly single pieces with the blank that leads them."""
        if not self.cached:
            return [len(b) // 4 for b in self._whole(parts)]
        if len(self.young) > self.max_entries:
            self.old, self.young = self.young, {}
        # A leading space is left out of a piece; a part without one is its own kind of piece.
        # A space before a newline is none: such a part goes to the library whole.
        keys = ["" if p[:2] == " \n" else p[1:] if p[:1] == " " else p if p[:1] == "\n" else "\n" + p
                for p in parts]
        self.learn(set(keys))
        values = list(map(self.young.__getitem__, keys))
        out = [len(v) // 4 if v is not None else -1 for v in values]
        for i, (p, n) in enumerate(zip(parts, out, strict=True)):
            if n < 0 or " " in keys[i]:
                out[i] = len(self._whole([p])[0]) // 4
            elif p[:1] not in (" ", "\n"):
                out[i] -= 1  # the newline that stands for its beginning
        return out

    def piece_counts(self, texts: list[str]) -> list[np.ndarray | None]:
        """Token counts of each text's pieces; None for texts that are not made of safe pieces."""
        if not self.cached:
            return [None] * len(texts)
        if len(self.young) > self.max_entries:
            self.old, self.young = self.young, {}
        split = [pieces_of(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        get = self.young.__getitem__
        out: list[np.ndarray | None] = []
        for pieces in split:
            try:
                n = np.fromiter(map(len, map(get, pieces)), np.int32, len(pieces)) // 4
                n[:1] -= 1  # the newline that stands for the text's beginning
                out.append(n)
            except TypeError:
                out.append(None)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cached:
            return self._whole(texts)
        out: list[bytes] = []
        for a, b in slices([len(t) for t in texts], 4_000_000):
            if len(self.young) > self.max_entries:
                self.old, self.young = self.young, {}
            split = [pieces_of(t) if t else [] for t in texts[a:b]]
            self.learn(set().union(*split))
            get = self.young.__getitem__
            for t, pieces in zip(texts[a:b], split, strict=True):
                try:
                    out.append(b"".join(map(get, pieces))[4:])
                except TypeError:
                    out += self._whole([t])
        return out


def encoder(path: str | None = None, cache_pieces: int = CACHE_PIECES) -> PieceEncoder:
    """One encoder per worker process, file and size of its cache."""
    path = path or default_tokenizer()
    key = (path, cache_pieces, os.getpid())
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, cache_pieces)
    return _encoders[key]
