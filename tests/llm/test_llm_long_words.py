"""Token ids against the tokenizer itself, patterns in linear time against the plain ones, even shards of repeated rows."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest

pytest.importorskip("silverlode.llm.registry")

from pyspark.sql import functions as F  # noqa: E402

from silverlode.llm import line_quality, packing, pii_spans, sharding  # noqa: E402
from silverlode.llm.registry import packing_plan  # noqa: E402

MARKS = "̸़̧́̈̇̌각가KΩﬁẞ"
ODD = "İıΣσςßǅǆǰJ̌½²Ⅷ٣‍​ \u0085  　﻿ ᠎'’_<|>-.,!😀한글ภาษาไทยहिन्दी"


def random_text(source: random.Random) -> str:
    pool = "abcDEF éÉñÖ\t\n 019'" + MARKS + ODD
    if source.random() < 0.2:
        return "".join(chr(source.choice([source.randrange(0x20, 0xD7FF), source.randrange(0xE000, 0x20000)])) for _ in range(source.randint(1, 12)))
    return "".join(source.choice(pool) for _ in range(source.randint(1, 14)))


def test_ids_equal_the_tokenizer():
    plan = packing_plan()
    encoder = packing.WordEncoder(plan.tokenizer, 5000)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(plan.tokenizer)
    source = random.Random(77)
    texts = ["café", "äb", "İ.", "J̌'s", "ΟΔΟΣ ΣΑΣ.", "<|endoftext|> x", "it's we'll 'd", "\x1c a"]
    texts += [random_text(source) for _ in range(100_000)]
    wrong = [t for t, e in zip(texts, plain.encode_batch(texts, add_special_tokens=False), strict=True) if encoder.encode(t) != np.array(e.ids, "<u4").tobytes()]
    assert encoder.by_word and wrong == []


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = packing.WordEncoder(path, 100), Tokenizer.from_file(path)
    for text in ("Hello  World's", "café \n\t x", ""):
        assert not encoder.by_word and encoder.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_plain_patterns_and_fast_ones_agree():
    source = random.Random(5)
    for _ in range(30_000):
        text = "".join(source.choice("ab1._-@@..  +%é0123") for _ in range(source.randint(0, 24)))
        assert list(pii_spans.emails(text)) == [m.span() for m in pii_spans.EMAIL.finditer(text)]
        assert [m.span() for m in pii_spans._IP.finditer(text)] == [m.span() for m in pii_spans.IP.finditer(text)]
        spaced = "".join(source.choice("a [](){}<>@.at  dot ") for _ in range(source.randint(0, 24)))
        for fast in (pii_spans._AT, pii_spans._DOT, pii_spans._WORDED_DOT):
            slow = re.compile(fast.pattern.replace("(?<! )", "").replace("[ ]*+", "[ ]*"))
            assert [m.span() for m in fast.finditer(spaced)] == [m.span() for m in slow.finditer(spaced)]


def long_texts(n: int) -> list[str]:
    return ["a" * n + " x@y.example", "1" * n, "1." * (n // 2), "<img src=data:" + "A" * n, "a@" * (n // 2), " " * n + "[at]", "a.b-" * (n // 4) + "@", "!" + "x!" * (n // 2)]


def test_personal_data_in_long_words_takes_linear_time():
    start = time.perf_counter()
    found = [pii_spans.spans_of(t) for t in long_texts(5_000_000)]
    assert time.perf_counter() - start < 120
    assert [s["kind"] for s in found[0]] == ["email"] and found[0][0]["start"] == 5_000_001


def test_quality_of_long_words_takes_linear_time(spark):
    texts = long_texts(5_000_000) + [" ".join(["w&"] * 30) + "\n" + "plain words " * 30]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(9)
    start = time.perf_counter()
    got = {r.doc_id: r for r in line_quality.assess(table).select("doc_id", "quality.n_words", "quality.kept", F.length("quality.clean").alias("left")).collect()}
    assert time.perf_counter() - start < 120
    assert got[3].n_words == 2 and not got[3].kept and got[8].left == len("plain words " * 30)


def marked_words(line: str) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]*(?:[#*$%&<>]|!!)[^\x20\x09-\x0D]*", line))


def test_marked_words_are_counted_as_before(spark):
    source = random.Random(8)
    lines = ["".join(source.choice("ab!!#$ \t&é") for _ in range(source.randint(0, 20))) for _ in range(3000)]
    table = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, line string")
    limits = line_quality.QualityLimits()
    got = {r.n: r.fails for r in table.select("n", line_quality.line_fails(F.col("line"), limits, F.lit(False)).alias("fails")).collect()}
    for n, line in enumerate(lines):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", line))
        separators = len(re.findall(r"(?:^|[\x20\t])(?:\||»|·|>)(?=[\x20\t]|$)", line))
        assert got[n] == (marked_words(line) * 100 > words * limits.max_marked_pct or (separators >= 2 and words < (separators + 1) * limits.words_per_separator))


def test_shards_are_even_for_rows_that_repeat_an_id(spark):
    rows = [(7, "copy " * 60)] * 2000 + [(n, f"text {n} " * 20) for n in range(100, 400)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    placed = sharding.assign_shards(table)
    sizes = [r.bytes for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)
    slots = placed.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("top")).collect()
    assert all(r.n == r.d == r.top + 1 for r in slots) and sum(r.n for r in slots) == len(rows)
