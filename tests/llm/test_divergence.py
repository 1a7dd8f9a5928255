from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest

from skyledger.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, place string, rank string"


def brute(rows, least, most=50):
    """Plain restatement over ``(text, lang, source)``."""
    rows = [tuple(v or "" for v in r) for r in rows]
    terms = []
    for text, lang, source in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms.append((lang, source, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)))
    docs = defaultdict(Counter)
    counts, total = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in terms:
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        total[lang].update(found)
    out = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def p(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + int(Fraction(10**9 * (count[t] + 5), n + 5 * len(kept))) for t in kept}

        q = p(total[lang])
        ps = {s: p(counts[lang, s]) for s in {r[2] for r in rows if r[1] == lang}}
        for s, own in ps.items():
            pair = [(sum(abs(own[t] - other[t]) for t in kept), o) for o, other in ps.items() if o != s]
            excess = [(own[t] - q[t], t) for t in kept if counts[lang, s][t] and own[t] > q[t]]
            for part, values in (("pair", pair), ("term", excess)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(values, 1) if part == "pair" or k <= most]
    return sorted(out)


def report(frame, rows, least, most=50):
    df = frame(DOCS, *[(k, *r, "x", "y") for k, r in enumerate(rows)])
    return sorted(tuple(r) for r in divergence.report(df, least, most).collect())


def made_up(n, langs, sources, seed):
    chance = random.Random(seed)
    words = ["the", "The", "é", "naïve-té", "a1b", "zz", "Ω", "x_y", "日本", *(f"w{chr(97 + k)}" for k in range(20))]
    return [
        (" ".join(chance.choices(words, k=chance.randint(0, 12))), chance.choice(langs), chance.choice(sources)) for _ in range(n)
    ]


@pytest.mark.parametrize("block, bucket_rows, chunk", [(128, 100_000, 1024), (2, 7, 3), (3, 40, 1)])
def test_equals_the_plain_restatement(frame, monkeypatch, block, bucket_rows, chunk):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", chunk)
    rows = made_up(150, ["en", "fr", None], ["s1", "s2", "s3", "s4", "s5", "S6", "é", None], 1)
    rows += [(None, "en", "empty"), ("", "xx", "a"), ("12 34", "xx", "b"), ("lonely", "yy", "only"), *[rows[0]] * 20]
    assert report(frame, rows, 5) == brute(rows, 5)
    assert report(frame, rows, 1, most=3) == brute(rows, 1, most=3)


def test_few_groups_or_many_are_the_same(frame, monkeypatch):
    rows = made_up(60, ["en", "de"], ["a", "b", "c"], 2)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    assert report(frame, rows, 3) == brute(rows, 3)


def test_tasks_that_send_early(frame, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 10)
    rows = made_up(200, ["en"], ["a", "b"], 3)
    want = brute(rows, 2)
    assert report(frame, rows, 2) == want


def test_counts_beyond_a_long_are_exact(spark):
    from pyspark.sql import functions as F

    n, total, kept = 10**15 + 7, 3 * 10**15 + 11, 10**6
    got = spark.range(1).select(divergence.probability(F.lit(n), F.lit(total), F.lit(kept))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_no_documents(frame):
    assert report(frame, [], 1) == []


def test_sql_states_the_same(frame):
    rows = made_up(400, ["en", "fr"], ["a", "b", None], 4)
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert sorted(con.sql(divergence.SQL).fetchall()) == brute(rows, 30)
