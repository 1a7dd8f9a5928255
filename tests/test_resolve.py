from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.operators import resolve

CITIES = "city_id int, city_name string, is_active boolean"
ALIASES = "raw_alias string, canonical_city_id int"
NOW = datetime(2024, 6, 1)


@pytest.fixture
def cities(frame):
    return frame(
        CITIES,
        (1, "Mumbai", True),
        (2, "Hyderabad", True),
        (3, "Visakhapatnam", True),
        (4, "Nagar Haveli", True),
        (5, "Bengaluru", True),
        (6, "Ghost Town", False),
        (7, "Thiruvananthapuram Municipal", True),
    )


@pytest.fixture
def aliases(frame):
    return frame(ALIASES, ("Bombay", 1), (" Specter City ", 6), ("hyderabad", 99))


def resolved(frame, cities, aliases, *names):
    outcome = resolve.resolve_names(frame("raw_name string", *names), cities, aliases)
    return outcome, {r.raw_name: r for r in outcome.names.collect()}


def test_golden_names(frame, cities, aliases):
    _, got = resolved(
        frame, cities, aliases,
        "  MUMBAI ", "bombay", "Hyderabaad", "Vishakhapatnam", "Haveli Nagar", "Navi Mumbai", "Bangalore",
        "Thiruvananthapuram Munincipal", "specter city", "Ghost Town", "Hyderabad",
    )
    assert {n: (r.city_id, r.match_method) for n, r in got.items()} == {
        "  MUMBAI ": (1, "exact"),
        "bombay": (1, "exact"),
        "Hyderabaad": (2, "fuzzy"),
        "Vishakhapatnam": (3, "fuzzy"),
        "Haveli Nagar": (4, "fuzzy"),
        "Navi Mumbai": (None, None),
        "Bangalore": (None, None),
        "Thiruvananthapuram Munincipal": (7, "fuzzy"),
        "specter city": (6, "exact"),
        "Ghost Town": (None, None),
        "Hyderabad": (2, "exact"),
    }
    assert round(got["Hyderabaad"].score, 2) == 94.74
    assert round(got["Vishakhapatnam"].score, 2) == 96.3
    assert got["Haveli Nagar"].score == 100
    assert got["bombay"].score is None


def test_blank_names_are_not_quarantined(frame, cities, aliases):
    outcome, got = resolved(frame, cities, aliases, "  ", "", None, "Atlantis", "Atlantis", "\t")
    assert all(r.city_id is None for r in got.values())
    assert [(r.raw_name, r.occurrences) for r in outcome.unmatched.collect()] == [("Atlantis", 2)]


def test_case_matters_to_similarity_but_spellings_share_a_match(frame, cities, aliases):
    outcome, got = resolved(frame, cities, aliases, "HYDERABAAD", "Hyderabaad", "hyderabaad")
    assert {r.city_id for r in got.values()} == {2}
    assert [(r.raw_alias, r.canonical_city_id, r.match_method) for r in outcome.new_aliases.collect()] == [
        ("Hyderabaad", 2, "fuzzy")
    ]
    assert outcome.unmatched.count() == 0
    _, alone = resolved(frame, cities, aliases, "HYDERABAAD")
    assert alone["HYDERABAAD"].city_id is None


def test_lowest_city_wins_ties(frame, aliases):
    cities = frame(CITIES, (9, "Abcdefghij", True), (3, "Abcdefghik", True), (8, "Abcdefghij", True))
    _, got = resolved(frame, cities, aliases, "Abcdefghi", "Abcdefghijx")
    assert got["Abcdefghi"].city_id == 3
    assert got["Abcdefghijx"].city_id == 8


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(row[-1], before[j + 1]))
    return row[-1]


def brute_force(name, cities):
    best = None
    sort = lambda text: " ".join(sorted(text.split()))
    for city_id, city in cities:
        a, b = sort(name), sort(city)
        common = common_length(a, b)
        if 200 * common >= 90 * (len(a) + len(b)):
            rank = (200 * common / (len(a) + len(b)), -city_id)
            best = max(best or rank, rank)
    return best and (-best[1], best[0])


@pytest.mark.parametrize("lengths, alphabet", [((1, 12), "ab"), ((5, 16), "abc "), ((12, 24), "abcdef "), ((14, 45), "abcd")])
def test_best_matches_against_brute_force(spark, lengths, alphabet):
    rng = random.Random(7)

    def word():
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths)))
        return text if text.strip() else "a" * lengths[0]

    def damaged(text):
        chars = list(text)
        for _ in range(rng.randint(0, max(1, len(chars) // 5))):
            at = rng.randrange(len(chars) + 1)
            if rng.random() < 0.5 and len(chars) > 1:
                chars.pop(min(at, len(chars) - 1))
            else:
                chars.insert(at, rng.choice(alphabet))
        return "".join(chars) if "".join(chars).strip() else text

    cities = [(i, word()) for i in range(40)]
    names = sorted({damaged(rng.choice(cities)[1]) for _ in range(120)} | {word() for _ in range(40)})
    got = resolve.best_matches(
        spark.createDataFrame([(n,) for n in names], "raw_name string"),
        spark.createDataFrame(cities, "city_id int, city_name string"),
    )
    found = {r.raw_name: (r.city_id, r.score) for r in got.collect()}
    expected = {name: match for name in names if (match := brute_force(name, cities))}
    assert found == expected
    assert len(expected) > 40


@pytest.mark.parametrize("length, key", [(13, "form"), (40, "stretch")])
def test_forms_and_pieces_are_not_broadcast(spark, tmp_path, length, key):
    """A small file whose names become many times as many forms or pieces."""
    letters = F.translate(F.md5(F.col("id").cast("string")), "0123456789abcdef", "bcdfghjklmnprtvw")
    name = F.concat(F.left(letters, F.lit(5)), F.lit(" "), F.left(F.repeat(letters, 2), F.lit(length - 6)))
    spark.range(200).select(F.col("id").alias("city_id"), name.alias("city_name")).write.parquet(f"{tmp_path}/cities")
    cities = spark.read.parquet(f"{tmp_path}/cities")
    matches = resolve.best_matches(cities.select(F.col("city_name").alias("raw_name")), cities)
    assert matches.count() == 200
    plan = matches._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and f"{key}#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_matches_and_lookups_are_not_broadcast(spark, tmp_path):
    name = F.initcap(F.translate(F.md5(F.col("id").cast("string")), "0123456789abcdef", "bcdfghjklmnprtvw"))
    cities = spark.range(200).select(F.col("id").alias("city_id"), F.left(name, F.lit(12)).alias("city_name"), F.lit(True).alias("is_active"))
    cities.write.parquet(f"{tmp_path}/cities")
    cities = spark.read.parquet(f"{tmp_path}/cities")
    aliases = cities.select(F.concat(F.lit("Old "), "city_name").alias("raw_alias"), F.col("city_id").alias("canonical_city_id"))
    raw = cities.select(F.concat("city_name", F.lit("x")).alias("raw_name"))
    names = resolve.resolve_names(raw, cities, aliases).names
    assert names.filter("match_method = 'fuzzy'").count() == 200
    plan = names._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [key#" in line or "Join [text#" in line]
    assert len(joins) >= 3 and all("SortMergeJoin" in line for line in joins)


def rows_made(df, metric, node=""):
    """The sum of a metric of the operators that ran for ``df``, by the start of their names."""

    def below(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return below(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return below(plan.plan())
        own = plan.metrics().apply(metric).value() if plan.nodeName().startswith(node) and plan.metrics().contains(metric) else 0
        children = plan.children()
        return own + sum(below(children.apply(i)) for i in range(children.size()))

    df.collect()
    return below(df._jdf.queryExecution().executedPlan())


def test_every_row_is_read_and_spelled_once(spark, frame, cities, aliases, tmp_path):
    spark.range(50).select(F.concat(F.lit("Mumba"), F.col("id") % 10).alias("word")).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw").select(F.concat(F.col("word"), F.lit(" ")).alias("raw_name"))
    names = resolve.resolve_names(raw, cities, aliases).names
    assert names.count() == 10
    assert rows_made(names, "numOutputRows", "Scan parquet") == 50


def test_no_forms_that_no_length_can_use(spark, frame):
    cities = frame("city_id int, city_name string", *[(i, f"Abcdefgh{i:05d}") for i in range(20)])
    names = frame("raw_name string", *[f"Abcdefgh{i:05d}" for i in range(20)])
    matches = resolve.best_matches(names, cities)
    assert sorted((r.raw_name, r.city_id, r.score) for r in matches.collect()) == [(f"Abcdefgh{i:05d}", i, 100.0) for i in range(20)]
    # Of equal lengths one deletion on each side can be close enough: 14 forms a name, not 92.
    assert rows_made(matches, "numOutputRows", "Generate") < 2 * 20 * 25


def test_long_names_that_share_a_word(spark):
    """Few rows are moved for names that have a close city, and the others are found as well."""
    rng = random.Random(3)

    def word():
        return "".join(rng.choice("bcdfghjk") for _ in range(rng.randint(6, 28))).title()

    def edited(text, edits):
        chars = list(text)
        for _ in range(edits):
            at = rng.randrange(len(chars) - 1)
            chars[at : at + 1] = rng.choice([[], [chars[at], "x"]])
        return "".join(chars)

    cities = [(i, " ".join(["Municipality", *(word() for _ in range(rng.randint(1, 3)))])) for i in range(150)]
    # Two numbers of one name, and two names at one edit from a third.
    cities += [(900, cities[0][1]), (901, cities[1][1] + "x"), (902, cities[1][1] + "y")]
    edits = [0] * 100 + [1] * 100 + [2, 3, 4, 6, 9] * 4
    names = sorted({edited(rng.choice(cities)[1], n) for n in edits} | {cities[1][1] + "xy", cities[0][1]})
    matches = resolve.best_matches(
        spark.createDataFrame([(n,) for n in names], "raw_name string"),
        spark.createDataFrame(cities, "city_id int, city_name string"),
    )
    expected = {name: match for name in names if (match := brute_force(name, cities))}
    assert {r.raw_name: (r.city_id, r.score) for r in matches.collect()} == expected
    assert len(expected) > 150
    assert rows_made(matches, "shuffleRecordsWritten") < 60 * (len(names) + len(cities))


def test_quarantine_counts(frame):
    old = frame(
        "id bigint, raw_name string, source string, first_seen_at timestamp, last_seen_at timestamp, "
        "occurrence_count bigint, resolved boolean",
        (4, "Atlantis", "pipeline", datetime(2024, 1, 1), datetime(2024, 1, 2), 3, True),
        (2, "Utopia", "pipeline", datetime(2024, 1, 1), datetime(2024, 1, 2), 1, False),
    )
    merged = resolve.merge_quarantine(old, frame("raw_name string, occurrences bigint", ("Atlantis", 2), ("Eldorado", 5)), F.lit(NOW))
    got = {r.raw_name: r for r in merged.collect()}
    assert {n: (r.id, r.occurrence_count, r.resolved) for n, r in got.items()} == {
        "Atlantis": (4, 5, True), "Utopia": (2, 1, False), "Eldorado": (5, 5, False),
    }
    assert got["Atlantis"].first_seen_at == datetime(2024, 1, 1)
    assert got["Atlantis"].last_seen_at == NOW
    assert got["Utopia"].last_seen_at == datetime(2024, 1, 2)
    assert got["Eldorado"].source == "pipeline"
