from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from skyledger.llm import resampling

DOCS = "doc_id long, text string, weight string, position string"


def brute(rows, target, n=1, buckets=10_000, least=20, share=(10, 100)):
    """Plain restatement over ``(doc_id, text)`` and target texts."""

    def found(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
        runs = [" ".join(words[k : k + m]) for m in range(1, n + 1) for k in range(len(words) - m + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    docs = [(d, *found(t)) for d, t in rows]
    s, t = Counter(b for *_, f in docs for b in f), Counter(b for x in target for b in found(x)[1])
    all_s, all_t = s.total(), t.total()

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    scored = []
    for d, words, f in docs:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        scored.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    long = sorted((r for r in scored if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(long[: len(long) * share[0] // share[1]], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in scored), key=str)


def drawn(frame, rows, target, **kwargs):
    docs = frame(DOCS, *[(d, t, "x", "y") for d, t in rows])
    wanted = frame("item_id long, text string", *[(k, t) for k, t in enumerate(target)])
    return sorted((tuple(r) for r in resampling.resampled(docs, wanted, **kwargs).collect()), key=str)


def made_up(n, seed):
    chance = random.Random(seed)
    words = [*"abcdefgh", "The", "the", "É", "it's", "x9", "9", "日本 語", *(f"rare{k}" for k in range(300))]
    weights = [30] * 15 + [1] * 300
    return [(k, " ".join(chance.choices(words, weights, k=chance.randint(0, 60)))) for k in range(n)]


EDGES = [(None, "no id " * 10), (900, None), (901, ""), (902, "...!?"), (903, "long " * 50_000), (903, "long " * 50_000)]


@pytest.mark.parametrize("n, head, buckets", [(1, 65536, 10_000), (1, 5, 64), (2, 10, 500), (3, 8, 100_000), (2, 0, 50), (4, 300, 97)])
def test_equals_the_plain_restatement(frame, n, head, buckets):
    rows = made_up(120, n) + EDGES
    target = [t for _, t in made_up(25, 99)] + [None, ""]
    want = brute(rows, target, n, buckets)
    assert drawn(frame, rows, target, n=n, head_size=head, buckets=buckets) == want


def test_registered_parameters(frame):
    rows, target = made_up(300, 7), [t for _, t in made_up(30, 98)]
    got = drawn(frame, rows, target)
    assert got == brute(rows, target)
    assert sum(r[4] is not None for r in got) > 10


def test_ties_go_to_the_smaller_id(frame):
    rows = [(1, "same words " * 10)] * 30
    got = drawn(frame, rows, ["same"])
    assert got == brute(rows, ["same"])


def test_head_continues_states():
    head = resampling.Head([b"a", b"bc"]).with_pairs([(0 << 32) + 1, (1 << 32) + 1])
    words = [b"a", b"bc", b"bc", b"tail", b"a"]
    for length, states in enumerate(head.run_states(words, 4), 1):
        want = [zlib.crc32(b" ".join(words[k : k + length])) for k in range(len(words) - length + 1)]
        assert states.tolist() == want


def test_tables_without_rows(frame):
    assert drawn(frame, [], ["a b"]) == []
    rows = made_up(30, 5)
    assert drawn(frame, rows, []) == brute(rows, [])
    assert drawn(frame, [(1, None)], []) == brute([(1, None)], [])
