"""Filter audit, periodic runs and SimHash near-dedup against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("silverlode.llm.registry")

from compare import connect, differences  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from silverlode.llm import filter_audit, periodic_runs, registry, simhash  # noqa: E402
from silverlode.llm.common import word_blocks  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string, part string, mask int, n bigint, fp string, periodic string"
LABELS = "doc_id bigint, quality int, toxic int"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts() -> list[tuple[int | None, str | None, str | None]]:
    source = random.Random(11)
    plain = [source.choice("abcdeé") + str(source.randint(0, 60)) for _ in range(80)]
    rows: list[tuple[int | None, str | None, str | None]] = []
    for n in range(60):
        text = " ".join(source.choice(plain) for _ in range(source.randint(5, 130)))
        text += source.choice(["", " $", " ABCDEFGHIJ KLMNOP", "\n|", "\tİ\x0b", "\x1c\x85x"])
        rows.append((n, text, f"s{n % 3}"))
    # A third of the table is one text; some ids repeat, some are missing.
    rows += [(100 + n, rows[4][1], "hot") for n in range(40)] + [(7, rows[7][1], "s1"), (7, rows[7][1], "other")]
    rows += [(None, rows[5][1], "s0"), (None, rows[5][1], None), (200, None, None), (201, "", ""), (202, " \n\t", "s2"), (199, "", None)]
    rows += [(203, "A B " * 9000, "s0"), (204, "X" * 50_000, "s0"), (205, "one two", "s0"), (206, "one", "s0")]
    rows += [(300 + n, rows[n][1].replace(" ", "  ", 3) + f" w{n}", "s1") for n in range(12)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, "p", 1, 2, "f", "q") for i, t, s in texts()], DOCS).repartition(5).cache()


# --- filter audit --------------------------------------------------------------------------------------


def audit_by_hand(rows, labels):
    def fails(i, text):
        words = words_of(text)
        out = set()
        if len(words) < 50:
            out.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            out.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            out.add("C")
        if re.search(r"[#$%&*|]", text):
            out.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            out.add("E")
        return out

    failed = [(s or "", i, fails(i, t or "")) for i, t, s in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    expected = []
    for part in {s for s, _, _ in failed}:
        mine = [(i, f) for s, i, f in failed if s == part]
        lines, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                redundant = sum(name in f for _, f in mine) - len(gone)
                alone = sum(f == {name} for _, f in mine)
                lines.append((part, "".join(order), step, len(left), len(gone), redundant, alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        expected += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return sorted(expected)


def test_audit_equals_a_plain_one(spark, docs):
    labels = [(n, n % 2, int(n % 5 == 0)) for n in range(0, 210, 3)] + [(3, 0, 1), (None, 1, 1), (9999, 1, 1), (6, None, None)]
    cells = filter_audit.mask_cells(docs, spark.createDataFrame(labels, LABELS))
    got = sorted(tuple(r) for r in filter_audit.audit(cells).collect())
    assert got == audit_by_hand(texts(), labels)


def test_audit_of_an_empty_table(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(filter_audit.mask_cells(docs.limit(0), labels)).count() == 0
    assert filter_audit.audit(filter_audit.mask_cells(docs, labels)).agg(F.sum("good_lost")).first()[0] == 0


def test_survivors_of_every_set():
    random_ = random.Random(2)
    cells = {m: np.array([random_.randint(0, 9)] * 3) for m in range(32) if random_.random() < 0.6}
    states = filter_audit.survivors(cells)
    assert len(states) == 32
    for chosen, state in enumerate(states):
        assert (state == sum((c for m, c in cells.items() if not m & chosen), np.zeros(3, int))).all()


@here
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert differences(registry.QUERIES[name](spark, SF), connect(SF), registry.ORACLES[name]) is None


# --- periodic runs -------------------------------------------------------------------------------------


def runs_by_hand(words):
    """Every maximal stretch of every period, longest-known first: the least period of an interval wins."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            start = x
            while x < n - q and words[x] == words[x + q]:
                x += 1
            if x + q - start >= max(24, 3 * q):
                found.setdefault((start, x + q - start), q)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts():
    source, out = random.Random(23), [[], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 300, ["a", "b"] * 200, ["a", "a", "b"] * 60]
    for n in range(160):
        letters = [chr(97 + k) for k in range(source.randint(1, 6))]
        words = []
        for _ in range(source.randint(1, 4)):
            words += [source.choice(letters) for _ in range(source.randint(0, 30))]
            block = [source.choice(letters) for _ in range(source.randint(1, 40))]
            times = source.randint(1, 6)
            words += (block * (times + 1))[: len(block) * times + source.randrange(len(block))]
        out.append(words)
    # Periods that hold a shorter near-period, and words of Fibonacci kind with very many runs.
    out += [list("aaaaab" * 8), list("abaab" * 12 + "abaababa" * 9), list("aabaabaa" * 7 + "aab" * 14)]
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    return [*out, list(b), list((b[:100]) * 4)]


def test_runs_equal_a_plain_search():
    every = periodic_texts()
    for words in every:
        numbers = np.array([ord(w[0]) for w in words], np.int64)
        expected = runs_by_hand(words)
        got = periodic_runs.runs_of(numbers, np.zeros(len(words), np.int64)) if words else []
        assert got == expected
    known, place, expected = {}, 0, []
    for words in every:
        expected += [(s + place, length, q) for s, length, q in runs_by_hand(words)]
        place += len(words)
    numbers = np.array([known.setdefault(w, len(known)) for words in every for w in words], np.int64)
    of = np.repeat(np.arange(len(every)), [len(w) for w in every])
    assert periodic_runs.runs_of(numbers, of) == expected


def test_runs_of_a_table(spark, docs):
    texts_ = [(n, " \n".join(w) if n % 2 else "\t" + "  ".join(w)) for n, w in enumerate(periodic_texts())]
    texts_ += [(5000, None), (5001, ""), (5002, " \x0b"), (5003, "é \U0001f600 " * 30), (5003, "é \U0001f600 " * 30), (None, "x\x85y " * 40)]
    table = spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts_], "doc_id bigint, text string, periodic string, runs string").repartition(4)
    done = periodic_runs.find_runs(table)
    assert sorted(done.columns) == sorted(table.columns) and done.count() == len(texts_)
    expected = []
    for i, text in texts_:
        words = words_of(text)
        runs = runs_by_hand(words)
        gone = {x for s, length, q in runs for x in range(s + q, s + length)}
        expected.append((str(i), runs, " ".join(w for x, w in enumerate(words) if x not in gone)))
    got = [(str(r.doc_id), [tuple(x) for x in r.periodic.runs], r.periodic.collapsed) for r in done.collect()]
    assert sorted(got) == sorted(expected)
    assert periodic_runs.find_runs(table.limit(0)).count() == 0
    assert periodic_runs.find_runs(docs).count() == len(texts())
    with pytest.raises(ValueError):
        periodic_runs.RunPlan(min_words=20)


def test_planted_cycles_follow_the_contract(spark, docs):
    got = sorted((str(r.doc_id), r.text or "") for r in registry.with_planted_cycles(docs).select("doc_id", "text").collect())
    expected = []
    for i, text, _ in texts():
        words, h = words_of(text), 1 if i is None else zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[x if x < a else a + (x - a) % p] for x in range(n))
        expected.append((str(i), text or ""))
    assert got == sorted(expected)


@here
def test_run_query_equals_a_plain_version(spark):
    table = registry.with_planted_cycles(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    expected = {}
    for row in table.collect():
        words = words_of(row.text)
        runs = runs_by_hand(words) if len(words) < 1500 else None
        if runs is None:
            continue
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        gone = {x for s, length, q in runs for x in range(s + q, s + length)}
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for x, w in enumerate(words) if x not in gone))]
        expected[row.doc_id] = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digest)
    got = {r[0]: tuple(r)[1:] for r in registry.op12_periodic_runs(spark, SF).collect()}
    assert len(expected) > 100 and {i: got[i] for i in expected} == expected


def test_word_blocks_end_between_words():
    text = (" ab\x0bcd\r\n" * 300 + "e" * 500 + "\x85\x1c f").encode()
    for size in (1, 7, 64, 1 << 20):
        assert [w for block in word_blocks(text, size) for w in block] == [w.encode() for w in words_of(text.decode())]


# --- SimHash -------------------------------------------------------------------------------------------


def fingerprint_by_hand(text):
    from xxhash import xxh64

    words = words_of("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxh64(" ".join(words[x : x + size]).encode(), seed=42).intdigest() for x in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows):
    """(id, fingerprint, least id) for rows of id and fingerprint."""
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if bin(rows[x][1] ^ rows[y][1]).count("1") <= 3:
                label[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return [(i, f, least.get(root(x))) for x, (i, f) in enumerate(rows)]


def test_fingerprints_equal_a_plain_version():
    plan = simhash.SimHashPlan()
    for _, text, _ in texts():
        assert simhash.fingerprint("".join(c.lower() if c.isascii() else c for c in text or "").encode(), plan) == fingerprint_by_hand(text)
    long = " ".join(str(n % 977) for n in range(400_000))
    whole = np.zeros(64, np.int64)
    from xxhash import xxh64_intdigest

    words = long.split()
    for x in range(len(words) - 2):
        h = xxh64_intdigest(" ".join(words[x : x + 3]), 42)
        whole += np.array([h >> b & 1 for b in range(64)])
    assert simhash.fingerprint(long.encode(), plan) == sum(1 << b for b in range(64) if 2 * whole[b] > len(words) - 2)


def test_simhash_equals_a_plain_version(spark, docs):
    expected = components_by_hand([(i, fingerprint_by_hand(t)) for i, t, _ in texts()])
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_anchors_are_all_words_within_two():
    source = np.random.default_rng(4)
    half = np.concatenate([source.integers(0, 1 << 32, 200, np.uint64), np.array([0, 1, (1 << 32) - 1], np.uint64)])
    row, anchor, home = simhash.anchors(half)
    syndromes = [0] * 32
    for a in anchor.tolist():
        assert np.bitwise_xor.reduce([p for p in range(1, 32) if a >> (p - 1) & 1] or [0]) == 0
    flips = [0, *(1 << a for a in range(32)), *(1 << a | 1 << b for a in range(32) for b in range(a))]
    for n, value in enumerate(half.tolist()):
        words = {value ^ f for f in flips if np.bitwise_xor.reduce([p for p in range(1, 32) if (value ^ f) >> (p - 1) & 1] or [0]) == 0}
        mine = anchor[row == n].tolist()
        assert len(mine) == len(set(mine)) and set(mine) == words
        (at_home,) = anchor[(row == n) & home].tolist()
        assert bin(at_home ^ value).count("1") <= 1
    assert len(syndromes) == 32


def links_by_hand(values):
    return {(a, b) for x, a in enumerate(values) for b in values[:x] if bin(a ^ b).count("1") <= 3}


def components_of(pairs):
    least = {}
    for a, b in pairs:
        group = {a, b}
        for known in [g for g in {id(v): v for v in least.values()}.values() if g & group]:
            group |= known
        least.update(dict.fromkeys(group, group))
    return {frozenset(g) for g in least.values()}


@pytest.mark.parametrize("block_rows", [1 << 16, 40])
def test_links_join_what_all_pairs_join(spark, block_rows):
    """Random points, chains of links, and a dense ball, whose anchors are cut in blocks in the second run."""
    source = random.Random(9)
    values = {source.getrandbits(64) for _ in range(150)}
    for start in list(values)[:12]:
        for _ in range(6):
            start ^= sum(1 << b for b in source.sample(range(64), source.randint(1, 4)))
            values.add(start)
    values |= {0, (1 << 64) - 1, 7, 1 << 63}
    center = source.getrandbits(64)
    values |= {center ^ 1 << a ^ (1 << b if a != b else 0) for a in range(0, 64, 2) for b in range(1, 64, 5)}
    values |= {center ^ sum(1 << b for b in source.sample(range(8), 6)) << 32 ^ source.getrandbits(20) for _ in range(60)}
    values = sorted(values)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint").repartition(3)
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(table, simhash.SimHashPlan(block_rows=block_rows)).collect()]
    assert components_of(found) == components_of(links_by_hand(values))
    # A chain, not all pairs: in each of its cells a fingerprint has two neighbours at most where cells are large.
    assert len(found) < 40 * len(values)
