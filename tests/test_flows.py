"""The flows over a stored warehouse: dimension, readings, gate, stream."""

from __future__ import annotations

import json
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators import gate
from skyledger.operators.checks import _recent
from skyledger.operators.constraints import ConstraintViolation, mark_orphans
from skyledger.operators.resolve import resolve_names
from skyledger.plans import dimension_load, readings_load
from skyledger.plans.analytics import rolling_24h_average
from skyledger.plans.name_load import resolve_and_store
from skyledger.schemas import BRONZE, CITY_CSV_COLUMNS, WEATHER_MEASURES
from skyledger.session import scratch_dir, spread
from skyledger.sources.landed import pair_batches, run_documents
from skyledger.sources.catalog import Catalog, LostTable
from skyledger.sources.tables import BUCKETS, RUNS, Warehouse
from skyledger.streaming.incremental import ingest_new_documents

FETCHED = datetime(2024, 9, 26, 8, 30)
CITY_FILE = (
    ",".join(CITY_CSV_COLUMNS)
    + """
 Mumbai ,Maharashtra,19.0760,72.8777,1,20667656
BOMBAY,maharashtra,19.0760,72.8777,1,20667657
Pune,Maharashtra,18.52,73.85,2,2857.000
poona,Maharashtra,18.53,73.85,2,7276000
,,,,,
Madras,Tamil Nadu,N/A,80.27,1,11235018
Agra,Uttar Pradesh,27.1767,78.0081,N/A,null
Agra,Uttar Pradesh,27.1767,778.0081,3,1
Surat,Gujarat,21.1702,72.8311,2,1,2
"""
)


@pytest.fixture
def warehouse(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text(CITY_FILE)
    house = Warehouse(spark, str(tmp_path / "warehouse"))
    dimension_load.load_calendar(house)
    house.loaded = dimension_load.load_dimension(house, str(path), F.lit(datetime(2024, 1, 1)))
    house.city_file = str(path)
    return house


def ids(warehouse):
    return {r.city_name: r.city_id for r in warehouse.read("dim_city").collect()}


def test_dimension_flow(warehouse):
    load = warehouse.loaded
    cities = {r.city_name: r for r in warehouse.read("dim_city").collect()}
    assert set(cities) == {"Mumbai", "Pune", "Agra"}
    assert cities["Mumbai"].population == 20667657 and cities["Mumbai"].state == "Maharashtra"
    assert (cities["Agra"].tier, cities["Agra"].population) == (None, None)
    assert sorted(r.city_id for r in cities.values()) == [1, 2, 3]
    aliases = {r.raw_alias: r for r in warehouse.read("dim_city_alias").collect()}
    assert {n: a.canonical_city_id for n, a in aliases.items()} == {
        "Bombay": cities["Mumbai"].city_id, "Poona": cities["Pune"].city_id,
    }
    assert (load.cities, load.aliases_seeded) == (3, 2)
    assert [r.raw_alias for r in load.unknown_seeds.collect()] == ["Madras"]
    assert sorted(r.reason for r in load.rejects.collect()) == [
        "longitude out of range", "no city name", "no coordinates",
    ]
    assert load.too_wide.count() == 1
    assert warehouse.read("dim_date").count() == 4018


def test_dimension_flow_twice(warehouse):
    before = [sorted(map(str, warehouse.read(t).drop("updated_at").collect())) for t in ("dim_city", "dim_city_alias")]
    dimension_load.load_dimension(warehouse, warehouse.city_file, F.lit(datetime(2024, 2, 1)))
    dimension_load.load_calendar(warehouse)
    after = [sorted(map(str, warehouse.read(t).drop("updated_at").collect())) for t in ("dim_city", "dim_city_alias")]
    assert before == after
    assert {r.updated_at for r in warehouse.read("dim_city").collect()} == {datetime(2024, 2, 1)}
    assert warehouse.read("dim_date").count() == 4018


def test_no_active_cities(spark, tmp_path):
    with pytest.raises(readings_load.NoActiveCities):
        readings_load.cities_to_fetch(Warehouse(spark, str(tmp_path)))


def weather_answer(time, temperature):
    return {"timezone": "Asia/Kolkata", "current": {"time": time, "temperature_2m": temperature, "relative_humidity_2m": 50}}


def air_answer(aqi, status="ok"):
    return {"status": status, "data": {"aqi": aqi, "iaqi": {}, "time": {"s": "2024-09-26 14:00:00", "tz": "+05:30"}}}


def land_weather(frame, warehouse, run_id, fetched, *batches):
    """Each batch: ([city, ...], answer)."""
    number = ids(warehouse)
    requests = [
        (str(b), i, number.get(city, 99), city) for b, (cities, _) in enumerate(batches) for i, city in enumerate(cities)
    ]
    answers = [(str(b), body if isinstance(body, str) else json.dumps(body), fetched, run_id) for b, (_, body) in enumerate(batches)]
    return readings_load.store_weather(
        warehouse,
        frame("batch_id string, pos int, city_id int, city_name string", *requests),
        frame("batch_id string, body string, fetched_at timestamp, run_id string", *answers),
    )


def land_air(frame, warehouse, run_id, *answers):
    number = ids(warehouse)
    rows = [
        (number[city], city, FETCHED, run_id, answer if answer is None else json.dumps(answer)) for city, answer in answers
    ]
    return readings_load.store_air_quality(
        warehouse, frame("city_id int, city_name string, fetched_at timestamp, run_id string, raw_response string", *rows)
    )


def test_readings_flow(warehouse, frame):
    number = ids(warehouse)
    rejected = land_weather(
        frame, warehouse, "run-1", FETCHED,
        (["Mumbai", "Pune"], [weather_answer("2024-09-26T14:00", 30.5), weather_answer("2024-09-26T14:00", 99999)]),
        (["Agra"], weather_answer("2024-09-27T01:00", "hot")),
        (["Mumbai", "Agra"], [weather_answer("2024-09-26T14:00", 1)]),
        (["Atlantis"], weather_answer("2024-09-26T14:00", 1)),
    )
    assert rejected.count() == 2
    load = readings_load.load_weather(warehouse, "run-1")
    assert (load.loaded, load.rejected) == (2, 2)
    assert sorted(r.violations for r in load.rejects.collect()) == [["city_id: unknown"], ["temperature_c: does not fit"]]
    facts = {r.city_id: r for r in warehouse.read("fact_weather_reading").collect()}
    assert set(facts) == {number["Mumbai"], number["Agra"]}
    agra = facts[number["Agra"]]
    assert (agra.temperature_c, agra.date_key) == (None, 20240927)
    assert (agra.reading_ts, agra.reading_day) == (datetime(2024, 9, 26, 19, 30), date(2024, 9, 26))

    classified = land_air(
        frame, warehouse, "run-1",
        ("Mumbai", air_answer(120)), ("Pune", air_answer("-")), ("Agra", air_answer("87.5")),
    )
    assert classified == {"ok": 2, "no_data": 1, "no_station": 0, "error": 0}
    air = readings_load.load_air_quality(warehouse, "run-1")
    assert (air.loaded, air.rejected) == (1, 1)
    assert air.rejects.first().violations == ["aqi_value: null"]
    assert readings_load.load_result(load, air) == {
        "weather_loaded": 2, "weather_rejected": 2, "aqi_loaded": 1, "aqi_rejected": 1,
    }

    run = gate.Run("readings", "gate", date(2024, 9, 26), FETCHED)
    results = {
        r.check_name: r.status
        for r in gate.run_gate(warehouse, readings_load.load_result(load, air), run, F.lit(datetime(2024, 9, 26, 12)))
    }
    assert results.pop("row_count_sanity") == results.pop("completeness") == "warn"
    assert set(results.values()) == {"pass"}


def test_a_rerun_takes_documents_over(warehouse, frame):
    number = ids(warehouse)
    land_weather(frame, warehouse, "run-1", FETCHED, (["Mumbai"], weather_answer("2024-09-26T14:00", 30)),
                 (["Pune"], weather_answer("2024-09-26T14:00", 20)))
    land_weather(frame, warehouse, "run-2", FETCHED + timedelta(minutes=10), (["Mumbai"], weather_answer("2024-09-26T14:00", 31)))
    bronze = warehouse.read("bronze")
    api = readings_load.WEATHER_API
    assert [r.city_name for r in run_documents(bronze, api, "run-1").collect()] == ["Pune"]
    assert [r.city_name for r in run_documents(bronze, api, "run-2").collect()] == ["Mumbai"]
    assert run_documents(bronze, api, "run-3").count() == 0
    for run_id in ("run-1", "run-2", "run-2"):
        readings_load.load_weather(warehouse, run_id)
    facts = {r.city_id: float(r.temperature_c) for r in warehouse.read("fact_weather_reading").collect()}
    assert facts == {number["Mumbai"]: 31.0, number["Pune"]: 20.0}


def stored_files(warehouse, table):
    """Files of a run table with the number of rows in each."""
    rows = warehouse.spark.table(warehouse.catalog.name(f"{table}__runs")).groupBy(F.input_file_name().alias("file"))
    return {r.file: r["count"] for r in rows.count().collect()}


def test_a_load_writes_its_own_rows_and_changes_no_file(warehouse, frame):
    fact = "fact_weather_reading"
    for day, value in ((26, 1), (27, 2)):
        land_weather(frame, warehouse, f"run-{day}", FETCHED.replace(day=day),
                     (["Mumbai", "Pune"], [weather_answer(f"2024-09-{day}T14:00", value)] * 2))
        readings_load.load_weather(warehouse, f"run-{day}")
    before = stored_files(warehouse, fact)
    land_weather(frame, warehouse, "run-x", FETCHED.replace(day=28),
                 (["Pune", "Agra"], [weather_answer("2024-09-27T14:00", 5), weather_answer("2024-09-27T15:00", 6)]))
    readings_load.load_weather(warehouse, "run-x")
    after = stored_files(warehouse, fact)
    assert before.items() <= after.items()
    assert sum(after.values()) - sum(before.values()) == 2  # of the five readings of those days
    facts = warehouse.read(fact)
    assert facts.count() == len({(r.city_id, r.reading_ts) for r in facts.collect()}) == 5
    assert {float(r.temperature_c) for r in facts.filter("city_id = %d" % ids(warehouse)["Pune"]).collect()} == {1.0, 5.0}


def test_a_load_of_many_days_is_written_by_more_tasks_than_buckets(spark, tmp_path):
    house, seconds = Warehouse(spark, str(tmp_path / "many_days")), F.lit(1_727_000_000) + F.col("id") * 3600
    rows = spark.range(24 * 12).select(
        (F.col("id") % 7).cast("int").alias("city_id"), F.timestamp_seconds(seconds).alias("reading_ts"), F.lit(20240922).alias("date_key"),
        *[F.lit(1).cast("decimal(5,2)").alias(m) for m in WEATHER_MEASURES if m != "fetched_at"], F.timestamp_seconds(seconds).alias("fetched_at"),
    )
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        house.merge_facts("fact_weather_reading", rows)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    files = stored_files(house, "fact_weather_reading")
    assert sum(files.values()) == 24 * 12
    tasks = {re.search(r"part-([0-9]+)", file)[1] for file in files}
    assert len(tasks) > BUCKETS
    # Still one file for each bucket of a day.
    assert len({re.sub(r"part-.*_([0-9]+)\.c000.*", r"\1", file) for file in files}) == len(files)


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    spark.range(20_000).coalesce(1).write.parquet(f"{tmp_path}/one")
    size = sum(f.stat().st_size for f in (tmp_path / "one").glob("*.parquet"))
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, str(size // 8))
    try:
        rows = spark.read.parquet(f"{tmp_path}/one")
        assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        shares = spread(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(name, old)
    assert sum(r["count"] for r in shares) == 20_000
    assert max(r["count"] for r in shares) < 20_000 // spark.sparkContext.defaultParallelism


def test_a_load_reads_no_stored_rows(warehouse, frame):
    land_weather(frame, warehouse, "run-1", FETCHED, (["Mumbai"], weather_answer("2024-09-26T14:00", 30)))
    readings_load.load_weather(warehouse, "run-1")
    rows = warehouse.read("fact_weather_reading").drop("reading_day", "reading_id").withColumn("temperature_c", F.lit(31).cast("decimal(5,2)"))
    given = warehouse.spark.createDataFrame(rows.collect(), rows.schema)
    plans = []
    real = warehouse.catalog._write
    warehouse.catalog._write = lambda stored, runs, df, load: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), real(stored, runs, df, load))
    warehouse.merge_facts("fact_weather_reading", given)
    assert len(plans) == 1 and "__runs" not in plans[0] and "parquet" not in plans[0]
    assert [float(r.temperature_c) for r in warehouse.read("fact_weather_reading").collect()] == [31.0]


def test_compaction_and_vacuum_change_no_row(warehouse, frame):
    fact = "fact_weather_reading"
    for hour in range(11):
        land_weather(frame, warehouse, f"run-{hour}", FETCHED + timedelta(hours=hour),
                     (["Mumbai", "Pune"], [weather_answer("2024-09-26T14:00", hour), weather_answer(f"2024-09-26T{hour:02}:00", hour)]))
        readings_load.load_weather(warehouse, f"run-{hour}")
    catalog, runs = warehouse.catalog, RUNS[fact]

    def shown():
        return sorted(map(str, warehouse.read(fact).collect()))

    before, frame_before = shown(), warehouse.read(fact)
    assert len(before) == 12
    assert max(map(len, catalog.loads(fact).values())) == 12  # ten loads and a compaction after the ninth ... and the eleventh
    assert catalog.state(fact).bases
    assert catalog.compact(fact, runs) > 0 and shown() == before
    assert sorted(map(str, frame_before.collect())) == before  # what a reader began with is still there
    catalog.vacuum(fact, runs)
    assert shown() == before
    assert all(len(numbers) == 1 for numbers in catalog.loads(fact).values())
    assert catalog.compact(fact, runs) == 0


def test_report_and_run_scan_prune_partitions(warehouse, frame):
    def pruned(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]

    land_weather(frame, warehouse, "run-1", FETCHED, (["Mumbai"], weather_answer("2024-09-26T14:00", 30)))
    readings_load.load_weather(warehouse, "run-1")
    facts = warehouse.read("fact_weather_reading")
    report = rolling_24h_average(facts, warehouse.read("dim_city"), F.lit(FETCHED - timedelta(days=7)))
    assert report.count() == 1
    assert any("reading_day" in filters for filters in pruned(report))
    documents = run_documents(warehouse.read("bronze"), readings_load.WEATHER_API, "run-1")
    assert any("source_api" in filters for filters in pruned(documents))


def test_an_empty_batch_changes_nothing(warehouse, frame):
    land_weather(frame, warehouse, "run-1", FETCHED, (["Mumbai"], weather_answer("2024-09-26T14:00", 30)))
    assert readings_load.load_weather(warehouse, "run-1").loaded == 1
    assert readings_load.load_weather(warehouse, "run-0").loaded == 0
    warehouse.merge_bronze(warehouse.read("bronze").limit(0))
    assert warehouse.read("bronze").count() == warehouse.read("fact_weather_reading").count() == 1


def test_pairing_reports_missing_answers(frame):
    requests = frame("batch_id string, pos int, city_id int", ("a", 0, 1), ("b", 0, 2), ("b", 1, 3), ("c", 0, 4))
    responses = frame("batch_id string, body string", ("a", '{"x": 1}'), ("b", '[{"x": 2}]'), ("d", "[]"))
    paired, rejected = pair_batches(requests, responses)
    assert [(r.city_id, r.raw_response) for r in paired.collect()] == [(1, '{"x":1}')]
    assert sorted((r.city_id, r.n_requests, r.n_responses) for r in rejected.collect()) == [(2, 2, 1), (3, 2, 1), (4, 1, 0)]


def test_learned_aliases_resolve_exactly_next_time(warehouse, frame):
    from skyledger.operators.dimension import merge_aliases

    names = frame("raw_name string", "Mumbaii", "Poona")
    first = resolve_names(names, warehouse.read("dim_city"), warehouse.read("dim_city_alias"))
    assert {r.raw_name: r.match_method for r in first.names.collect()} == {"Mumbaii": "fuzzy", "Poona": "exact"}
    warehouse.replace("dim_city_alias", merge_aliases(warehouse.read("dim_city_alias"), first.new_aliases, ["raw_alias"]))
    second = resolve_names(names, warehouse.read("dim_city"), warehouse.read("dim_city_alias"))
    assert {r.match_method for r in second.names.collect()} == {"exact"}


def test_stream_loads_each_file_once_and_replays_safely(spark, warehouse, frame):
    number = ids(warehouse)
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")

    def land(city, time, temperature, minute):
        row = (number[city], city, FETCHED.replace(minute=minute), FETCHED.replace(minute=0), "open_meteo", "run",
               json.dumps(weather_answer(time, temperature)))
        spark.createDataFrame([row], BRONZE).write.mode("append").parquet(landing)

    def run(into=checkpoint):
        ingest_new_documents(warehouse, landing, "fact_weather_reading", into, files_per_batch=1).awaitTermination()
        rows = warehouse.read("fact_weather_reading").collect()
        return {(r.city_id, r.reading_ts.hour): float(r.temperature_c) for r in rows}

    land("Mumbai", "2024-09-26T14:30", 30, 1)
    assert run() == {(number["Mumbai"], 9): 30.0}
    land("Mumbai", "2024-09-26T13:30", 28, 2)
    land("Pune", "2024-09-26T14:30", 25, 2)
    expected = {(number["Mumbai"], 9): 30.0, (number["Mumbai"], 8): 28.0, (number["Pune"], 9): 25.0}
    assert run() == expected
    assert run() == expected
    assert run(scratch_dir(spark, "replay")) == expected


def test_shared_folder_is_required_on_a_cluster(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class Broken(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["_swap", "_write", "_show"])
def test_a_write_that_fails_before_the_swap_leaves_the_old_table(warehouse, monkeypatch, frame, step):
    """Before anything is written, after the files are there, and right before readers would see them."""
    land_weather(frame, warehouse, "run-1", FETCHED, (["Mumbai"], weather_answer("2024-09-26T14:00", 30)))
    readings_load.load_weather(warehouse, "run-1")
    tables = ["dim_city", "fact_weather_reading", "bronze"]
    before = {t: sorted(map(str, warehouse.read(t).collect())) for t in tables}
    corrected = (["Mumbai", "Pune"], [weather_answer("2024-09-26T14:00", 31), weather_answer("2024-09-25T14:00", 7)])
    real = getattr(Catalog, step)

    def fail(self, *args, **kwargs):
        if step == "_write":
            real(self, *args, **kwargs)
        raise Broken

    monkeypatch.setattr(Catalog, step, fail)
    with pytest.raises(Broken):
        if step == "_swap":
            dimension_load.load_dimension(warehouse, warehouse.city_file, F.lit(datetime(2025, 1, 1)))
        else:
            land_weather(frame, warehouse, "run-2", FETCHED, corrected)
    assert {t: sorted(map(str, warehouse.read(t).collect())) for t in tables} == before
    monkeypatch.undo()
    assert {t: sorted(map(str, warehouse.read(t).collect())) for t in tables} == before
    dimension_load.load_dimension(warehouse, warehouse.city_file, F.lit(datetime(2025, 1, 1)))
    assert {r.updated_at for r in warehouse.read("dim_city").collect()} == {datetime(2025, 1, 1)}
    assert ids(warehouse) == {r.split("city_name='")[1].split("'")[0]: int(r.split("city_id=")[1].split(",")[0]) for r in before["dim_city"]}
    left = warehouse.spark.sql(f"SHOW TABLES IN {warehouse.catalog.database} LIKE 'dim_city__*'").collect()
    assert {r.tableName for r in left} == set(warehouse.catalog._properties("dim_city")["versions"].split(","))
    # The next load shows its own rows only, none of those that the failed one left.
    land_weather(frame, warehouse, "run-3", FETCHED, (["Agra"], weather_answer("2024-09-25T14:00", 8)))
    assert warehouse.read("bronze").count() == 2
    land_weather(frame, warehouse, "run-2", FETCHED, corrected)
    readings_load.load_weather(warehouse, "run-2")
    assert sorted(float(r.temperature_c) for r in warehouse.read("fact_weather_reading").collect()) == [7.0, 31.0]


def test_a_lost_table_is_not_an_empty_one(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.read("dim_city").count() == 0
    warehouse.replace("dim_city", warehouse.read("dim_city"))
    spark.sql(f"DROP DATABASE {warehouse.catalog.database} CASCADE")
    (tmp_path / "_warehouse").mkdir(parents=True, exist_ok=True)
    (tmp_path / "_warehouse" / "part-0.txt").write_text("x")
    for use in (lambda: warehouse.read("dim_city"), lambda: warehouse.catalog.replace("dim_city", spark.range(0))):
        with pytest.raises(LostTable):
            use()


def test_loads_leave_no_scratch_and_keep_rejects_once(spark, warehouse, frame):
    import os

    def left():
        return {t.tableName for t in spark.sql(f"SHOW TABLES IN {warehouse.catalog.database}").collect() if "scratch" in t.tableName}

    scratch = spark.conf.get("spark.checkpoint.dir")
    land_weather(
        frame, warehouse, "run/1 a", FETCHED,
        (["Mumbai"], weather_answer("2024-09-26T14:00", 99999)), (["Pune"], weather_answer("no time", 1)),
        (["Agra"], weather_answer("2024-09-26T14:00", 21)),
    )
    before = set(os.listdir(scratch))
    for _ in range(2):
        load = readings_load.load_weather(warehouse, "run/1 a")
        assert (load.loaded, load.rejected, load.spoilt) == (1, 1, 1)
        assert load.rejects.first().violations == ["temperature_c: does not fit"]
        assert load.spoilt_documents.first().violations == ["bad time"]
        assert '"city_id"' in load.spoilt_documents.first().document
    assert warehouse.read("load_rejects").count() == 2
    assert set(os.listdir(scratch)) == before and not left()
    with pytest.raises(ConstraintViolation):
        readings_load.load_weather(warehouse, "run/1 a", on_violation="fail")
    assert set(os.listdir(scratch)) == before and not left()


def test_scans_prune_by_run_and_by_day(warehouse, frame):
    for day in (25, 26, 27):
        land_weather(frame, warehouse, f"run-{day}", FETCHED.replace(day=day), (["Mumbai"], weather_answer(f"2024-09-{day}T14:00", day)))
    documents = warehouse.run_documents(readings_load.WEATHER_API, "run-26")
    assert documents.count() == 1
    plan = documents._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "fetched_day" in filters and "source_api" in filters
    readings_load.load_weather(warehouse, "run-26")
    recent = _recent(warehouse.read("fact_weather_reading"), F.lit(FETCHED))
    assert "reading_day" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_a_frequent_city_is_split_in_the_foreign_key_join(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).cast("int").alias("city_id"), F.array().cast("array<string>").alias("violations"))
    parent = spark.range(200_000).select(F.col("id").cast("int").alias("city_id"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        marked = mark_orphans(rows.repartition(8), "city_id", parent, "city_id")
        marked.write.format("noop").mode("overwrite").save()
        assert marked.filter(F.size("violations") > 0).count() == 0
        marked.collect()
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_names_are_resolved_and_stored(warehouse, frame):
    names = frame("raw_name string", "Mumbai", "Mumbaii", "Mumbaii", "Poona", "Atlantis", "Atlantis", " ", None, "\u00a0\u00a0")
    load = resolve_and_store(warehouse, names, F.lit(FETCHED))
    assert (load.exact, load.fuzzy, load.quarantined, load.blank) == (2, 1, 1, 3)
    learned = {r.raw_alias: r.match_method for r in warehouse.read("dim_city_alias").collect()}
    assert learned["Mumbaii"] == "fuzzy"
    again = resolve_and_store(warehouse, names, F.lit(FETCHED + timedelta(hours=1)))
    assert (again.exact, again.fuzzy, again.quarantined) == (3, 0, 1)
    open_names = warehouse.read("quarantine_unmatched_city_names").collect()
    assert [(r.raw_name, r.occurrence_count, r.first_seen_at, r.resolved) for r in open_names] == [("Atlantis", 4, FETCHED, False)]
    assert warehouse.read("quarantine_unmatched_city_names").filter(~F.col("resolved")).count() == 1
