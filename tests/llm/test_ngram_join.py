from __future__ import annotations

import os
import random

import numpy as np
import pytest

from skyledger.llm import ngram_join
from skyledger.llm.components import components


def words(chance: random.Random, n: int, kinds: int = 4000) -> list[str]:
    return [f"w{chance.randint(1, kinds)}" for _ in range(n)]


def shingles(text: str | None, n: int) -> frozenset:
    own = (text or "").encode().lower().split()
    return frozenset(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) if len(own) >= n else frozenset([tuple(own)] if own else [])


def brute(texts: dict[int, str | None], n: int, part: int, whole: int) -> dict[int, int]:
    sets = {k: shingles(t, n) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both * whole >= part * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def corpus(seed: int) -> dict[int, str | None]:
    """Exact and near copies, chains of copies, a common passage, short, empty and long texts."""
    chance = random.Random(seed)
    passage = words(chance, 40)
    texts: list[str | None] = [None, "", " \t\n", "one", "One", "one two", "ONE  two", "a b c", "É b c", "é b c"]
    for _ in range(25):
        own = words(chance, chance.randint(9, 120))
        texts.append(" ".join(own))
        for _ in range(chance.randint(0, 6)):
            if chance.random() < 0.6:
                own = list(own)  # a chain: each copy is of the one before
            copy = list(own)
            for _ in range(chance.randint(0, 2)):
                copy[chance.randrange(len(copy))] = "new"
            own = copy if chance.random() < 0.5 else own
            texts.append(" ".join(copy).upper() if chance.random() < 0.2 else " ".join(copy))
    texts += [" ".join(passage + words(chance, k % 6)) for k in range(25)]
    texts += [" ".join(words(chance, 200) + passage) for _ in range(10)]
    base = words(chance, 150)
    for k in range(30):  # copies that are near the base and less near to each other
        copy = list(base)
        for i in chance.sample(range(150), 2 + k % 3):
            copy[i] = f"x{k}"
        texts.append(" ".join(copy))
    texts += [" ".join(base), " ".join(words(chance, 20_000))]
    chance.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(("seed", "n", "part", "whole"), [(1, 3, 90, 100), (2, 5, 8, 10), (3, 1, 7, 10)])
def test_components_against_all_pairs(frame, seed, n, part, whole):
    texts = corpus(seed)
    docs = frame("doc_id long, text string, size string, digest string", *[(k, t, "clash", "x") for k, t in texts.items()])
    rows = ngram_join.similar_groups(docs, (part, whole), n).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute(texts, n, part, whole)
    assert {r.doc_id: r.n_shingles for r in rows} == {k: len(shingles(t, n)) for k, t in texts.items()}


@pytest.mark.parametrize("level", [10, 100, 200])
def test_similar_sets_share_a_combination_in_every_class(level):
    """Whatever the class of their tokens, sets at the threshold meet."""
    chance = np.random.default_rng(level)
    levels = chance.choice([level, 10, 100, 200], 1 << ngram_join.BUCKET_BITS).astype(np.uint8)
    prefixes = ngram_join.Prefixes(levels, (8, 10))
    for size in (6, 7, 10, 31, 64, 90, 127, 128, 300, 700):
        for _ in range(15):
            tokens = np.unique(chance.integers(0, 1 << 64, size, dtype=np.uint64))
            lost = chance.integers(0, prefixes.missing(len(tokens)) + 1)
            some = chance.permutation(tokens)[lost:]
            room = len(some) * 10 // 8 - len(tokens)
            other = np.unique(np.concatenate([some, chance.integers(0, 1 << 64, max(0, chance.integers(0, room + 1)), dtype=np.uint64)]))
            both, union = len(some), len(tokens) + len(other) - len(some)
            if both * 10 >= 8 * union:
                assert np.intersect1d(prefixes.combinations_of(tokens)[0], prefixes.combinations_of(other)[0]).size


def test_frequent_tokens_take_few_combinations():
    tokens = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64))
    for level, factor in ((10, 2), (100, 12), (200, 40)):
        prefixes = ngram_join.Prefixes(np.full(1 << ngram_join.BUCKET_BITS, level, np.uint8), (90, 100))
        assert len(prefixes.combinations_of(tokens)[0]) <= factor * prefixes.missing(len(tokens))


def test_repeated_rows_null_ids_and_no_rows(frame):
    text = "a b c d e f g h i j k l"
    docs = frame("doc_id long, text string", (4, text), (4, text), (None, text), (7, text), (None, "lone text"), (9, None))
    rows = ngram_join.similar_groups(docs, (90, 100), 3).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 4), (4, 4), (4, 4), (7, 4), (9, 9)]
    assert ngram_join.similar_groups(docs.where("false"), (90, 100), 3).count() == 0


def test_components_of_chains_stars_and_loops(frame):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    edges = frame("a long, b long", *chain, *star, (5, 5), (160, 300), (300, 160), (-4, 260))
    found = {r.node: r.component for r in components(edges).collect()}
    want = dict.fromkeys([*range(100, 161), 300], 100) | dict.fromkeys([7, *range(200, 260), 260, -4], -4)
    want.update(dict.fromkeys([7, *range(200, 260)], 7) | {260: -4, -4: -4})
    assert found == want
    assert components(edges.where("false")).count() == 0


def around(base: list[str], members: int, edits: int, chance: random.Random) -> list[str]:
    """Copies of a text, each with edits of its own."""
    out = []
    for k in range(members):
        copy = list(base)
        for i in chance.sample(range(1, len(base) - 1), edits):
            copy[i] = f"x{k}y{i}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize(("seed", "n", "part", "whole"), [(4, 3, 90, 100), (5, 5, 8, 10)])
def test_components_where_no_list_is_short(frame, monkeypatch, seed, n, part, whole):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 0)
    chance, texts = random.Random(seed), list(corpus(seed).values())
    base = words(chance, 150)
    for text in around(base, 40, 5, chance):  # members beside the threshold, some of them with a copy of their own
        texts.append(text)
        if chance.random() < 0.5:
            texts += around(text.split(), 1, chance.randint(1, 3), chance)
    texts = dict(enumerate(texts))
    docs = frame("doc_id long, text string", *texts.items())
    rows = ngram_join.similar_groups(docs, (part, whole), n).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute(texts, n, part, whole)


def test_members_around_one_text_are_not_compared_with_each_other(frame, monkeypatch):
    """150 sets just beyond the threshold from one text, and farther from each other."""
    chance = random.Random(11)
    texts = around(words(chance, 200), 150, 4, chance)
    compared, real = [], ngram_join.stored

    def counted(df, label, *more):
        out = real(df, label, *more)
        if label == "ngram-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    docs = frame("doc_id long, text string", *enumerate(texts))
    rows = ngram_join.similar_groups(docs, (90, 100), 3).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute(dict(enumerate(texts)), 3, 90, 100)
    assert sum(compared) <= 4 * len(texts)


@pytest.mark.parametrize("share", [(90, 100), (8, 10), (1, 2)])
def test_similar_members_share_an_indexed_difference(share):
    chance = np.random.default_rng(share[1])
    levels = chance.choice([10, 100, 200], 1 << ngram_join.BUCKET_BITS).astype(np.uint8)
    differences, (part, whole), met = ngram_join.Differences(levels, share), share, 0
    for size in (10, 31, 64, 200):
        hub = np.unique(chance.integers(0, 1 << 64, size, dtype=np.uint64))
        spare = np.unique(chance.integers(0, 1 << 64, size // 2, dtype=np.uint64))
        apart = max(1, size * (whole - part) // whole)
        members = [
            np.unique(np.concatenate([
                chance.permutation(hub)[chance.integers(0, apart + 1) :], chance.permutation(spare)[: chance.integers(0, apart + 1)],
            ]))
            for _ in range(60)
        ]
        found = [differences.of(hub, m) for m in members]
        for i, a in enumerate(members):
            tokens, few, differ, linked = found[i]
            assert differ == len(np.setxor1d(hub, a)) and set(tokens.tolist()) <= set(np.setxor1d(hub, a).tolist())
            for j, b in enumerate(members):
                both = len(np.intersect1d(a, b))
                bits = ngram_join._signature(a) ^ ngram_join._signature(b)
                assert np.unpackbits(bits.view(np.uint8)).sum() <= len(a) + len(b) - 2 * both
                if len(np.setxor1d(a, b)) and both * whole >= part * (len(a) + len(b) - both) and not found[j][3]:
                    other = found[j][0] if linked else found[j][0][: found[j][1]]
                    assert np.intersect1d(tokens[:few], other).size
                    met += 1
    assert met > 20


def test_combinations_are_not_kept_after_the_lists_are_made(spark, frame):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    chance = random.Random(5)
    texts = around(words(chance, 200), 6, 1, chance)
    docs = frame("doc_id long, text string", *enumerate([*texts, texts[0], None]))
    rows = ngram_join.similar_groups(docs, (90, 100), 3).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute(dict(enumerate([*texts, texts[0], None])), 3, 90, 100)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert "ngram-lists" in left and not left & {"ngram-base", "ngram-reps", "temporary"}
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("temporary_")]
