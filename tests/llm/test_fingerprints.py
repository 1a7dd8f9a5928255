from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import fingerprints as fp

DOCS = "doc_id long, text string, row string, hashes long"


def words(seed: int, n: int) -> str:
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefgh", k=5)) for _ in range(n))


def texts_with_edges() -> list[tuple]:
    rows = [(k, words(k, 50 + 13 * k)) for k in range(40)]
    return [*rows, (50, None), (51, ""), (52, "one"), (53, "☃ é 日本語 text here"), (54, words(1, 30_000)), (55, words(3, 89)), (56, words(3, 89))]


def test_order_edits_and_likeness(frame):
    rows = texts_with_edges()
    found = {r.doc_id: r for r in fp.edited_fingerprints(frame(DOCS, *[(*r, "x", 1) for r in rows])).collect()}
    texts = [t or "" for _, t in rows]
    for k, (doc, _) in enumerate(rows):
        own, after = texts[k], texts[(k + 1) % len(rows)]
        cut = len(own) // 4
        edited = own[: len(own) - cut] + after[:cut]
        got = found[doc]
        assert (got.n_chars, got.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got.near_edited <= 1 and 0 <= got.near_next <= 1
        if len(own) > 2000:
            assert abs(got.near_edited - 0.75) < 0.2 and got.near_next < 0.1
    assert found[55].fingerprint == found[56].fingerprint and found[55].near_next == 1
    assert found[50].fingerprint == found[51].fingerprint == "" and found[50].near_next == 1


def test_a_sketch_is_every_hash_below_the_limit_and_merges(spark, frame):
    a, b = words(1, 700), words(2, 300)
    both = f"{a} . . . . {b}"
    frames = frame("doc_id long, text string", (1, a), (2, b), (3, both))
    found = {r.doc_id: set(r.hashes) for r in fp.fingerprints(frames).collect()}
    assert found[1] | found[2] <= found[3]
    limit = -(1 << 63) + (1 << 64) // fp.SCALE
    assert all(h < limit for h in found[3])
    assert len(found[1]) == pytest.approx(696 / fp.SCALE, abs=30)
    row = spark.range(1).select(
        fp.containment(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3))).alias("x"),
        fp.containment(F.expr("array()").cast("array<int>"), F.array(F.lit(2))).alias("y"),
    ).first()
    assert (row.x, row.y) == (0.5, 0.0)


def test_repeated_and_null_ids_one_row_and_no_rows(frame):
    rows = fp.edited_fingerprints(frame("doc_id long, text string", (1, "aaaa"), (1, "bbbb"), (None, "cccc"), (2, "dddd"))).collect()
    assert len(rows) == 4 and {r.doc_id for r in rows} == {None, 1, 2}
    null = next(r for r in rows if r.doc_id is None)
    assert null.edited_sha256 in {hashlib.sha256(t).hexdigest() for t in (b"ccca", b"cccb")}
    alone = fp.edited_fingerprints(frame("doc_id long, text string", (7, "abcdefgh"))).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1
    assert fp.edited_fingerprints(frame("doc_id long, text string").where("false")).count() == 0


def test_no_python_on_the_main_path(frame):
    plan = fp.edited_fingerprints(frame("doc_id long, text string", (1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan
