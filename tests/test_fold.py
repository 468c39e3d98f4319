"""The folding expression against a plain one-character-at-a-time version."""

import random

import regex
from pyspark.sql import functions as F

from tessera.functions.text import fold_accents, replacements

PICTURES = regex.compile("[‍←-➿⤀-⯿︎️\U0001f000-\U0001faff]")
MARKS = regex.compile(r"([\x00-\x7F\p{IsLatin}\p{IsGreek}\p{IsCyrillic}])\p{M}+")


def plain(text):
    if text is None or text.isascii():
        return text
    table = replacements()
    return PICTURES.sub("", MARKS.sub(r"\1", "".join(table.get(c, c) for c in text)))


def texts():
    rng = random.Random(5)
    every = list(replacements())
    other = list("abc XYZ.,'0̧́̂हिन्दीไทย你好‍😀👍🏽→★") + ["\U0001f1e7\U0001f1f7"]
    out = [None, "", "plain", "".join(every), "ß", "ßß", "ß́é", "е́", "́", "a" * 10_000 + "œ" + "b" * 10_000]
    return out + ["".join(rng.choice(every if rng.random() < 0.3 else other) for _ in range(rng.randrange(1, 200))) for _ in range(500)]


def test_folding_equals_the_plain_version(spark):
    rows = texts()
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string")
    found = {r.i: r.f for r in df.select("i", fold_accents("s").alias("f")).collect()}
    assert [found[i] for i in range(len(rows))] == [plain(t) for t in rows]


def test_a_long_text_of_replaced_characters(spark):
    df = spark.createDataFrame([("ßж½" * 100_000,)], "s string")
    assert df.select(F.md5(fold_accents("s")) == F.md5(F.lit("sszh1/2" * 100_000))).first()[0]
