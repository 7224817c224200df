"""The pipeline and the registered queries over the smallest test tables."""

from __future__ import annotations

import os
import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from silverlode.llm import decontaminate, line_dedup, near_dedup  # noqa: E402
from silverlode.llm.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_stages_keep_the_columns_and_run_gives_the_last(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def linked_by_hand(rows, size, percent):
    """Least id of each row's component over all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^ \t-\r]+", text or "")
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                one, other = root(a), root(b)
                parent[max(one, other)] = min(one, other)
    return {row[0]: min(rows[k][0] for k in range(len(rows)) if root(k) == root(n)) for n, row in enumerate(rows)}


def test_long_regions_lose_no_link(spark):
    """Copies of one text, most of them too far from each other: regions longer than the reach are compared whole."""
    source = random.Random(4)
    first = [f"w{source.randrange(4000)}" for _ in range(240)]
    rows = []
    for n in range(260):
        words = list(first)
        for _ in range(source.randint(2, 9)):
            words[source.randrange(len(words))] = f"x{n}y{source.randrange(10_000)}"
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    for size in (2, 5):
        found = near_dedup.near_duplicates(docs, near_dedup.NearDedupPlan(shingle=size, reach=8)).collect()
        assert {r.doc_id: r.component_id for r in found} == linked_by_hand(rows, size, 80)


def test_components_without_an_id_keep_one_text(spark):
    text = " ".join(f"w{n}" for n in range(60))
    rows = [(None, text), (None, text + " more"), (None, ""), (None, None), (4, "other words"), (None, "Other Words"), (None, "b " + text)]
    kept = near_dedup.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, len(r.text or "")) for r in kept if r.doc_id is not None) == [(4, 11)]
    assert len([r for r in kept if r.text and "w1" in r.text]) == 1
    assert sorted(r.text or "" for r in kept if r.doc_id is None and not r.text) == ["", ""]


def test_stages_keep_columns_of_any_name(spark):
    names = "doc_id bigint, _lines string, text string, _benchmark int, `row` string, id int, lines int, benchmark string, key int"
    item = " ".join(f"b{n}" for n in range(12))
    shared = "this line stands in more documents than five of them do"
    rows = [(n, "a", f"{shared}\nown words of number {n}" if n else f"{item} and more", n, "r", -n, 7, "b", 3) for n in range(8)]
    docs = spark.createDataFrame(rows, names)
    lines = line_dedup.clean_lines(docs)
    assert lines.schema == docs.schema
    assert sorted(r.doc_id for r in lines.collect() if shared in r.text) == [7]
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    left = decontaminate.drop_contaminated(lines, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == list(range(1, 8))
    assert {(r["_lines"], r["row"], r.id, r.lines, r.benchmark, r.key) for r in left.collect()} == {("a", "r", -n, 7, "b", 3) for n in range(1, 8)}
