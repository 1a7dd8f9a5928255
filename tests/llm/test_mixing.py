from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import mixing

DOCS = "doc_id long, text string, source string, size string, copies long"


def water(sizes: dict, share=1.5, most=2.0):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]} if free else set()
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left, free = left - sum(target[s] for s in over), free - over


def mixed(docs):
    return mixing.digests(mixing.mix(mixing.units_of(docs))).collect()


@pytest.fixture
def docs(frame):
    chance = random.Random(5)
    rows = [(k, "w " * chance.randint(0, 60), f"s{min(6, chance.randint(0, 13))}", "clash", 9) for k in range(1500)]
    rows += [(5000 + k, "x " * chance.randint(1, 50), None, "clash", 9) for k in range(300)]
    return frame(DOCS, *rows, (9000, "big " * 4000, "s1", "", 1), (9001, None, "s2", "", 1), (9002, "", "s3", "", 1))


def test_targets_and_taken_words(docs):
    rows = mixed(docs)
    sizes: dict = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = water(sizes)
    for source, size in sizes.items():
        own = [r for r in rows if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(want[source]) for r in own)
        taken = sum(r.taken for r in own)
        slack = max((r.size for r in own if r.size * mixing.BLOCK <= size), default=0)
        assert abs(taken - want[source]) <= slack + 1
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)
    assert {r.size for r in rows if r.doc_id in (9001, 9002)} == {0}


def test_reruns_agree(docs):
    assert sorted(map(str, mixed(docs))) == sorted(map(str, mixed(docs)))


def test_copies_are_fair_on_average(frame):
    """Two sources of equal documents: shares of the target, whatever the order of the rows."""
    rows = mixed(frame("doc_id long, text string, source string", *[(k, "a b c", "ab"[k % 2]) for k in range(900)]))
    for source, weight in (("a", 3), ("b", 1)):
        own = [r for r in rows if r.source == source]
        limit = min(2.0, 1.5 * 2 * weight / 4)
        assert sum(r.taken for r in own) / own[0].source_size == pytest.approx(limit if source == "a" else 1.0, abs=0.02)


def test_repeated_rows_one_row_and_no_rows(frame):
    schema = "doc_id long, text string, source string"
    rows = mixed(frame(schema, *[(1, "a b", "s")] * 10, (None, "c d", "s")))
    assert len(rows) == 11 and sum(r.taken for r in rows) in (32, 34)
    assert [r.taken for r in mixed(frame(schema, (1, "a b c", "s")))][0] in (3, 6)
    assert mixed(frame(schema, (1, None, None)))[0].taken == 0
    assert mixed(frame(schema).where("false")) == []


def test_words_are_split_at_ascii_white_space_only(frame):
    rows = mixed(frame("doc_id long, text string, source string", (1, " a b\tc\x0bd \n", "s")))
    assert rows[0].size == 3


def test_reruns_agree_however_the_input_is_split(spark, frame, tmp_path):
    chance = random.Random(11)
    rows = [(k, "w " * chance.randint(0, 40), "abc"[k % 3] if k % 5 else None) for k in range(700)] + [(3, "x y", "a")] * 4
    frame("doc_id long, text string, source string", *rows).repartition(6).write.parquet(str(tmp_path / "docs"))
    seen = []
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    for size, partitions in (("128m", "4"), ("700", "7")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            docs = spark.read.parquet(str(tmp_path / "docs"))
            docs = docs if size == "128m" else docs.orderBy(F.desc("doc_id"))
            seen.append(sorted((str(r.doc_id), r.size, r.source or "", r.copies) for r in mixed(docs)))
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
    assert seen[0] == seen[1]
