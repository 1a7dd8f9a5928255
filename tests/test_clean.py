from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from skyledger.functions.text import na_to_null, sort_tokens, strip, title_case
from skyledger.operators import clean
from skyledger.schemas import CITY_CSV_COLUMNS
from skyledger.sources.city_csv import field_count, read_city_csv

HEADER = ",".join(CITY_CSV_COLUMNS)


@pytest.fixture
def raw(frame):
    """Rows of (city_name, state, latitude, longitude, tier, population), numbered in order."""

    def build(*rows):
        schema = "ingest_seq int, " + ", ".join(f"{c} string" for c in CITY_CSV_COLUMNS)
        return frame(schema, *[(i, *row) for i, row in enumerate(rows)])

    return build


def row(name="Alpha", state="North", lat="10.5", lon="20.5", tier="1", population="1000"):
    return (name, state, lat, lon, tier, population)


@pytest.mark.parametrize(
    "text, stripped",
    [("  Oslo ", "Oslo"), ("\tOslo\n", "Oslo"), (" Oslo ", "Oslo"), ("New  York", "New  York"), ("", "")],
)
def test_strip(evaluate, text, stripped):
    assert evaluate(strip(F.lit(text))) == stripped


@pytest.mark.parametrize(
    "text",
    ["DELHI", "bangalore", "new york", "jammu-kashmir", "o'neill", "3rd ward", "mcDonald", "são paulo", "", "a.b c"],
)
def test_title_case_is_pythons(evaluate, text):
    assert evaluate(title_case(F.lit(text))) == text.title()


@pytest.mark.parametrize("token", ["", "N/A", "null", "NaN", "None", "n/a", "#NA", "<NA>"])
def test_missing_value_tokens(evaluate, token):
    assert evaluate(na_to_null(F.lit(token))) is None


@pytest.mark.parametrize("text", ["N/a", "NONE", " N/A", "0", "none"])
def test_other_texts_are_values(evaluate, text):
    assert evaluate(na_to_null(F.lit(text))) == text


def test_tokens_are_sorted(evaluate):
    assert evaluate(sort_tokens(F.lit("  haveli\t Nagar  x "))) == "Nagar haveli x"


@pytest.mark.parametrize("line, fields", [("a,b,c", 3), ('a,"b,c",d', 3), ('"say ""hi, you""",b', 2), ("", 1)])
def test_field_count(evaluate, line, fields):
    assert evaluate(field_count(F.lit(line))) == fields


def test_strings_stripped_and_titled(raw):
    got = clean.title_names(clean.strip_all(raw(row(" berLIN ", "\tBRANDENBURG\n")))).first()
    assert (got.city_name, got.state) == ("Berlin", "Brandenburg")


@pytest.mark.parametrize("old, new", clean.HISTORICAL_NAMES.items())
def test_historical_names(raw, old, new):
    cleaned = clean.clean_cities(raw(row(old.upper())))
    assert cleaned.cities.first().city_name == new
    seed = cleaned.alias_seeds.first()
    assert (seed.raw_alias, seed.canonical, seed.match_method) == (old.title(), new, "exact")


def test_unknown_names_stay_and_give_no_seed(raw):
    cleaned = clean.clean_cities(raw(row("Springfield")))
    assert cleaned.cities.first().city_name == "Springfield"
    assert cleaned.alias_seeds.count() == 0


def test_one_seed_per_renamed_row_even_if_dropped(raw):
    cleaned = clean.clean_cities(raw(row("BOMBAY"), row("bombay"), row("Bombay", lat=None)))
    assert [s.raw_alias for s in cleaned.alias_seeds.collect()] == ["Bombay"] * 3
    assert cleaned.cities.count() == 1


@pytest.mark.parametrize(
    "text, number",
    [("2857.000", 2857), ("12", 12), ("1e3", 1000), ("9007199254740993", 9007199254740993), ("N/A", None),
     (None, None), ("many", None), ("1_000", None)],
)
def test_population(raw, text, number):
    assert clean.clean_cities(raw(row(population=text))).cities.first().population == number


def test_fractional_population_is_rejected(raw):
    cleaned = clean.clean_cities(raw(row(population="12.5")))
    assert cleaned.cities.count() == 0
    assert cleaned.rejects.first().reason == "fractional population"


@pytest.mark.parametrize(
    "text, tier", [("1", 1), ("2", 2), ("3", 3), ("3.0", 3), ("5", None), ("0", None), ("1.5", None), ("N/A", None)]
)
def test_tier(raw, text, tier):
    assert clean.clean_cities(raw(row(tier=text))).cities.first().tier == tier


@pytest.mark.parametrize(
    "bad, reason",
    [
        (row(name=None), "no city name"),
        (row(name="  "), "no city name"),
        (row(lat=None), "no coordinates"),
        (row(lon="null island"), "no coordinates"),
        (row(lat="90.0001"), "latitude out of range"),
        (row(lat="-90.0001"), "latitude out of range"),
        (row(lat="1e999"), "no coordinates"),
        (row(lon="180.0001"), "longitude out of range"),
        ((None,) * 6, "no city name"),
    ],
)
def test_invalid_rows(raw, bad, reason):
    cleaned = clean.clean_cities(raw(bad))
    assert cleaned.cities.count() == 0
    assert [r.reason for r in cleaned.rejects.collect()] == [reason]


@pytest.mark.parametrize("lat, lon", [("90", "180"), ("-90", "-180"), ("0", "0")])
def test_bounds_are_inclusive(raw, lat, lon):
    assert clean.clean_cities(raw(row(lat=lat, lon=lon))).cities.count() == 1


def test_last_duplicate_wins_after_renaming(raw):
    cleaned = clean.clean_cities(
        raw(row("Bengaluru", population="1"), row("BANGALORE", population="2"), row("Bangalore", "South", population="3"))
    )
    assert {(c.state, c.population) for c in cleaned.cities.collect()} == {("North", 2), ("South", 3)}


def test_missing_states_are_equal(raw):
    cleaned = clean.clean_cities(raw(row(state=None, population="1"), row(state=None, population="2")))
    assert [c.population for c in cleaned.cities.collect()] == [2]


@pytest.fixture
def csv_file(tmp_path):
    def write(text, name="cities.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_csv_scan(spark, csv_file):
    path = csv_file(
        f"{HEADER}\n"
        " Alpha ,North,1.0,2.0,1,10\n"
        "\n"
        ",,,,,\n"
        "Beta,South,3.0\n"
        '"Gamma, East",East,N/A,null,NA,None\n'
        "Delta,West,1,2,3,4,5\n"
        '"Say ""Hi""",North,1,2,3,4\n'
    )
    rows, too_wide = read_city_csv(spark, path)
    got = {r.city_name: r for r in rows.collect()}
    assert set(got) == {" Alpha ", None, "Beta", "Gamma, East", 'Say "Hi"'}
    assert got["Beta"].longitude is None and got["Beta"].latitude == "3.0"
    assert (got["Gamma, East"].latitude, got["Gamma, East"].longitude, got["Gamma, East"].tier) == (None,) * 3
    assert [r.raw_line for r in too_wide.collect()] == ["Delta,West,1,2,3,4,5"]


def test_csv_order_spans_files_and_splits(spark, tmp_path):
    for part in range(3):
        lines = [f"City{i},S,1,1,1,{part}{i:04d}" for i in range(500)]
        (tmp_path / f"part-{part}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows, _ = read_city_csv(spark, str(tmp_path), multiline=False)
        assert rows.rdd.getNumPartitions() > 3
        in_order = [r.population for r in rows.orderBy("ingest_seq").collect()]
        assert in_order == sorted(in_order)
        kept = clean.clean_cities(rows).cities
        assert {r.population // 10000 for r in kept.collect()} == {2}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_with_other_columns_is_refused(spark, csv_file):
    with pytest.raises(Exception, match="header|Header"):
        read_city_csv(spark, csv_file("a,b,c,d,e,f\n1,2,3,4,5,6\n"))[0].collect()


def test_csv_missing(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_city_csv(spark, str(tmp_path / "nowhere.csv"))


def test_quoted_line_breaks(spark, tmp_path):
    from skyledger.sources.city_csv import read_city_csv

    path = tmp_path / "cities.csv"
    path.write_text('city_name,state,latitude,longitude,tier,population\n"New\nYork",X,1,2,1,5\nRome,Y,3,4,1,6\n')
    rows, too_wide = read_city_csv(spark, str(path))
    assert [r.city_name for r in rows.orderBy("ingest_seq").collect()] == ["New\nYork", "Rome"]
    assert too_wide.count() == 0
    rows, too_wide = read_city_csv(spark, str(path), multiline=False)
    assert [r.city_name for r in rows.collect()] == ["Rome"]
    assert {r.reason for r in too_wide.collect()} == {"open quote"} and too_wide.count() == 2


MESSY = (
    f"{HEADER}\n"
    'Alpha,North,1,2,1,10\n'
    '"New\nYork",X,1,2,1,5\n'
    '"Say ""Hi""\n, twice ""\n""",Y,3,4,1,6\n'
    "\n"
    ",,,,,\n"
    '"","",1,1,1,7\n'
    '"a\n\n\nb","line, with\ncomma",1,2,3,8\n'
    'Wide,W,1,2,3,4,"x\ny"\n'
    "Short,S\n"
    '"last\none",Z,9,9,2,9'
)


def plain_records(text):
    import csv
    import io

    wide, rows = 0, []
    for fields in list(csv.reader(io.StringIO(text)))[1:]:
        if len(fields) > 6:
            wide += 1
        elif fields:
            rows.append(tuple(f or None for f in fields) + (None,) * (6 - len(fields)))
    return rows, wide


@pytest.mark.parametrize("size", ["1", "7", "13", "20", "33", "50", "77", "128m"])
def test_quoted_line_breaks_across_splits(spark, tmp_path, size):
    """Split sizes from one byte on cut the files at every place."""
    texts = {"a.csv": MESSY, "b.csv": MESSY.replace("Alpha", "Beta") + "\n", "c.csv": f"{HEADER}\nGamma,G,1,1,1,1\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows, too_wide = read_city_csv(spark, str(tmp_path))
        got, wide = rows.orderBy("ingest_seq").collect(), too_wide.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [plain_records(text) for text in texts.values()]
    columns = ["city_name", "state", "latitude", "longitude", "tier", "population"]
    assert [tuple(r[c] for c in columns) for r in got] == [r for rows, _ in want for r in rows]
    assert len(wide) == sum(n for _, n in want) and {r.reason for r in wide} == {"too many fields"}


def test_a_quote_left_open_takes_only_the_lines_after_it(spark, csv_file):
    path = csv_file(f'{HEADER}\n"A\nB",X,1,2,1,5\nRome,Y,3,4,1,6\n"lost,Z,1,1,1,1\nParis,Y,3,4,1,6\n')
    rows, too_wide = read_city_csv(spark, path)
    assert [r.city_name for r in rows.orderBy("ingest_seq").collect()] == ["A\nB", "Rome"]
    assert [(r.raw_line, r.reason) for r in too_wide.orderBy("ingest_seq").collect()] == [
        ('"lost,Z,1,1,1,1', "open quote"), ("Paris,Y,3,4,1,6", "open quote"),
    ]


def test_no_task_reads_a_whole_file(spark, tmp_path):
    (tmp_path / "big.csv").write_text(HEADER + "\n" + "City,S,1,1,1,1\n" * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows, _ = read_city_csv(spark, str(tmp_path))
        assert "SinglePartition" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
