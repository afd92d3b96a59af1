"""A small table of awkward documents; extra columns clash with operators' own names."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "shard string, rank double, part string, length string")


def awkward_texts():
    rng = random.Random(7)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "ça", "été", "naïve", "日本語", "🙂", "it's",
             "x=1;", "(a|b)", "don't", "1234", "A.B.C."]
    long = " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(6000))
    return [None, "", " ", "\n\n", "one", "two  spaces", " led by space", "trailing ",
            "tab\tand nbsp and em", "line one\nline two\nline one\n\n line  three",
            "crlf\r\nline\r\n", "a\n b \n\n\n c", "<|endoftext|> in text", "x<|endoftext|>y z",
            "é" * 50, "a" * 3000, "ab " * 900, long, long, long + " tail", "\x00\x01 ctl\x1f x",
            "same words again and again here now " * 6, "日本語 のテキスト です。" * 20,
            "foo,bar foo, foo. foo.\" 'foo' 's 't we're", "﻿bom start", "#*$%&|<> symbols #"]


def awkward_rows():
    rows = []
    for i, t in enumerate(awkward_texts()):
        rows.append((i * 3, t, "en", None if i % 5 == 0 else f"h{i % 3}", 1, "s", 0.5, "p", "l"))
    rows.append((None, "null id text", None, "h1", None, None, None, None, None))
    rows.append((3, "repeated id", None, "h1", None, None, None, None, None))
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
