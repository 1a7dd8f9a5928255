"""City cleaning and the city dimension, over customers turned into dirty rows.

A customer's nation, segment and balance decide how its row is damaged: former
names, upper case, padding, hyphens and apostrophes, missing or impossible
coordinates, odd tiers and populations.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import clean, dimension
from skyledger.schemas import CITY_CSV_COLUMNS
from skyledger.session import scratch_dir, spread
from skyledger.sources.city_csv import read_city_csv

from .standins import as_text, dim_city, table

_FORMER = list(clean.HISTORICAL_NAMES)
_CURRENT = list(clean.HISTORICAL_NAMES.values())
DAY_ONE, DAY_TWO = datetime(2024, 1, 1), datetime(2024, 2, 1)


def raw_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as an all-text city row, in the order of the customer number."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    former = F.element_at(F.array(*[F.lit(n) for n in _FORMER]), F.col("c_nationkey") + 1)
    renamed = (F.col("c_nationkey") < len(_FORMER)) & (F.col("c_mktsegment") == "BUILDING")
    segment, digit, cents = F.col("c_mktsegment"), F.col("digit"), F.col("cents")
    name = (
        F.when(renamed, F.initcap(former))
        .when(segment == "BUILDING", F.concat(F.lit("new town-"), F.lower("c_name")))
        .when(segment == "AUTOMOBILE", F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
        .when(segment == "FURNITURE", F.concat(F.lit("\t"), F.lit("o'neill "), "c_name", F.lit("\t ")))
        .when(segment == "HOUSEHOLD", F.when(digit == 0, F.lit("N/A")).when(digit == 1, F.lit("  ")).otherwise(F.col("c_name")))
        .otherwise(F.concat(F.lower("c_name"), F.lit(" 3rd ward")))
    )
    signed = F.when(F.col("c_acctbal") < 0, "-").otherwise("")
    latitude = F.concat(signed, F.floor(F.abs(cents) / 8000).cast("string"), F.lit("."), F.lpad((F.abs(cents) % 8000).cast("string"), 4, "0"))
    return (
        spread(customer)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("bigint"))
        .withColumn("digit", (F.abs("cents") % 10).cast("int"))
        .select(
            F.col("c_custkey").alias("ingest_seq"),
            name.alias("city_name"),
            F.concat(F.lit(" "), F.lower("n_name")).alias("state"),
            F.when(digit == 2, F.lit(None)).when((digit == 3) & (segment == "HOUSEHOLD"), "null").otherwise(latitude).alias("latitude"),
            F.when((digit == 4) & (segment == "MACHINERY"), "east").otherwise((F.abs(cents) % 400 - 200).cast("string")).alias("longitude"),
            F.when(digit < 4, digit.cast("string")).when(digit == 4, "N/A").when(digit == 5, "2.0").when(digit == 6, "1.5").otherwise("3").alias("tier"),
            F.when(digit == 7, "null").when(digit == 8, F.concat(cents.cast("string"), F.lit(".000"))).when(digit == 9, F.concat(cents.cast("string"), F.lit(".5"))).otherwise(cents.cast("string")).alias("population"),
        )
    )


_RAW = f"""
WITH digits AS (
  SELECT *, cast(round(c_acctbal * 100) AS bigint) AS cents,
         cast(abs(cast(round(c_acctbal * 100) AS bigint)) % 10 AS int) AS digit
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), raw AS (
  SELECT c_custkey AS seq,
    CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey < {len(_FORMER)}
           THEN ({_FORMER!r})[c_nationkey + 1]
         WHEN c_mktsegment = 'BUILDING' THEN 'new town-' || lower(c_name)
         WHEN c_mktsegment = 'AUTOMOBILE' THEN c_name
         WHEN c_mktsegment = 'FURNITURE' THEN 'o''neill ' || c_name
         WHEN c_mktsegment = 'HOUSEHOLD' AND digit = 0 THEN :na
         WHEN c_mktsegment = 'HOUSEHOLD' AND digit = 1 THEN ''
         WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name
         ELSE c_name || ' 3rd ward' END AS name,
    n_name AS state, c_mktsegment AS segment, c_nationkey, digit,
    CASE WHEN digit = 2 OR (digit = 3 AND c_mktsegment = 'HOUSEHOLD') THEN NULL
         ELSE cast((CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END) || cast(abs(cents) // 8000 AS varchar) || '.'
                   || lpad(cast(abs(cents) % 8000 AS varchar), 4, '0') AS double) END AS latitude,
    CASE WHEN digit = 4 AND c_mktsegment = 'MACHINERY' THEN NULL
         ELSE cast(abs(cents) % 400 - 200 AS double) END AS longitude,
    CASE WHEN digit BETWEEN 1 AND 3 THEN digit WHEN digit = 5 THEN 2 WHEN digit > 6 THEN 3 END AS tier,
    CASE WHEN digit NOT IN (7, 9) THEN cents END AS population
  FROM digits
), named AS (
  SELECT * REPLACE (array_to_string(list_transform(
    regexp_extract_all(name, '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS name,
    upper(state[1]) || lower(state[2:]) AS state)
  FROM raw
), renamed AS (
  SELECT *, map_extract_value(MAP {{{', '.join(f"'{a.title()}': '{b}'" for a, b in clean.HISTORICAL_NAMES.items())}}}, name)
            AS canonical FROM named
), judged AS (
  SELECT * EXCLUDE (name), coalesce(canonical, name) AS city_name,
    CASE WHEN name IS NULL OR name = '' THEN 'no city name'
         WHEN latitude IS NULL OR longitude IS NULL THEN 'no coordinates'
         WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude out of range'
         WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude out of range'
         WHEN digit = 9 THEN 'fractional population' END AS reason, name
  FROM renamed
), cities AS (
  SELECT * FROM judged WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY city_name, state ORDER BY seq DESC) = 1
)
"""
# A scan reads "N/A" as missing; rows that come from a table keep it as a name.
_TABLE_RAW, _SCANNED_RAW = _RAW.replace(":na", "'N/A'"), _RAW.replace(":na", "NULL")
_CLEAN = "SELECT city_name, state, latitude, longitude, cast(tier AS bigint) AS tier, population FROM cities"


def _shown(cities: DataFrame) -> DataFrame:
    return cities.select("city_name", "state", "latitude", "longitude", F.col("tier").cast("bigint").alias("tier"), "population")


def clean_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(clean.clean_cities(raw_cities(spark, sf_dir)).cities)


def clean_scanned_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows written as CSV files, scanned back and cleaned."""
    path = scratch_dir(spark, "city_csv")
    (
        raw_cities(spark, sf_dir)
        .orderBy("ingest_seq")
        .select(*CITY_CSV_COLUMNS)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return _shown(clean.clean_cities(read_city_csv(spark, path)[0]).cities)


def clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_cities(raw_cities(spark, sf_dir)).rejects.select("ingest_seq", "city_name", "reason")


def clean_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = clean.clean_cities(raw_cities(spark, sf_dir)).rejects
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def historical_alias_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_cities(raw_cities(spark, sf_dir)).alias_seeds


def _stored_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned cities as a numbered dimension."""
    cities = clean.clean_cities(raw_cities(spark, sf_dir)).cities
    return dimension.merge_cities(spark.createDataFrame([], dimension.DIM_CITY), cities, F.lit(DAY_ONE))


def alias_upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed the aliases of the cleaned cities next to some set by hand."""
    cities = _stored_cities(spark, sf_dir)
    seeds = clean.clean_cities(raw_cities(spark, sf_dir)).alias_seeds
    by_hand = (
        table(spark, sf_dir, "nation")
        .join(spark.createDataFrame(list(enumerate(n.title() for n in _FORMER)), "n_nationkey int, raw_alias string"), "n_nationkey")
        .filter(F.col("n_regionkey") == 1)
        .select(
            F.col("n_nationkey").alias("alias_id"),
            "raw_alias",
            F.lit(-1).alias("canonical_city_id"),
            F.lit("manual").alias("match_method"),
            F.lit(DAY_ONE).alias("created_at"),
        )
    )
    attempted, _unknown = dimension.seed_aliases(seeds, cities)
    merged = dimension.merge_aliases(by_hand, attempted, ["ingest_seq"], F.lit(DAY_TWO))
    return merged.select(
        F.col("alias_id").cast("bigint").alias("alias_id"),
        "raw_alias",
        F.col("canonical_city_id").cast("bigint").alias("canonical_city_id"),
        "match_method",
        as_text("created_at").alias("created_at"),
    )


def _numbered(name: str, state: str, start: str = "0") -> str:
    """The number a city gets: order of a hash prefix, then of its name."""
    return f"{start} + row_number() OVER (ORDER BY md5({name} || chr(31) || {state})[:3], {name}, {state})"


def alias_seeding_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per former name: seeds with a known city, and seeds without."""
    cities = _stored_cities(spark, sf_dir)
    seeds = clean.clean_cities(raw_cities(spark, sf_dir)).alias_seeds
    attempted, unknown = dimension.seed_aliases(seeds, cities)
    both = attempted.select("raw_alias", F.lit(1).alias("known")).unionByName(
        unknown.select("raw_alias", F.lit(0).alias("known"))
    )
    return both.groupBy("raw_alias").agg(
        F.sum("known").alias("attempted"), F.sum(1 - F.col("known")).alias("unknown")
    )


def _dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_city(spark, sf_dir).select(
        "city_id",
        "city_name",
        "state",
        F.lit(1.5).alias("latitude"),
        F.lit(2.5).alias("longitude"),
        (F.length("c_mktsegment") % 3 + 1).cast("smallint").alias("tier"),
        F.col("c_acctbal").cast("bigint").alias("population"),
        "is_active",
        F.lit(DAY_ONE).alias("created_at"),
        F.lit(DAY_ONE).alias("updated_at"),
        "c_mktsegment",
    )


def dim_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments up to HOUSEHOLD are stored; those from FURNITURE on arrive, with new attributes."""
    rows = _dimension_rows(spark, sf_dir)
    old = rows.filter(F.col("c_mktsegment") <= "HOUSEHOLD").drop("c_mktsegment")
    new = rows.filter(F.col("c_mktsegment") >= "FURNITURE").select(
        "city_name", "state", "latitude", F.lit(9.25).alias("longitude"), F.lit(3).alias("tier"), F.lit(7).alias("population")
    )
    merged = dimension.merge_cities(old, new, F.lit(DAY_TWO))
    return merged.select(
        F.col("city_id").cast("bigint").alias("city_id"),
        "city_name",
        "state",
        F.col("longitude").cast("double").alias("longitude"),
        F.col("tier").cast("bigint").alias("tier"),
        "population",
        "is_active",
        as_text("created_at").alias("created_at"),
        as_text("updated_at").alias("updated_at"),
    )


def ids_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names stand in for city names that several states share."""
    cities = dim_city(spark, sf_dir).withColumn("city_name", F.concat_ws("/", "state", "c_mktsegment"))
    return dimension.city_ids_by_name(cities)


def active_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.active_cities(dim_city(spark, sf_dir), ["city_id", "city_name", "state"])


QUERIES = {
    "clean_dimension": clean_dimension,
    "clean_scanned_csv": clean_scanned_csv,
    "clean_rejects": clean_rejects,
    "clean_reject_counts": clean_reject_counts,
    "historical_alias_seeds": historical_alias_seeds,
    "alias_upsert_ignore": alias_upsert_ignore,
    "alias_seeding_outcome": alias_seeding_outcome,
    "dim_merge": dim_merge,
    "ids_by_name": ids_by_name,
    "active_entities": active_entities,
}

_ALIAS_BASE = f"""{_TABLE_RAW}, stored AS (
  SELECT city_name, state, {_numbered("city_name", "state")} AS city_id FROM cities
), by_name AS (SELECT city_name, min(city_id) AS city_id FROM stored GROUP BY 1),
seeds AS (SELECT seq, name AS raw_alias, canonical FROM judged WHERE canonical IS NOT NULL),
matched AS (SELECT * FROM seeds LEFT JOIN by_name ON canonical = city_name)
"""

ORACLES = {
    "clean_dimension": _TABLE_RAW + _CLEAN,
    "clean_scanned_csv": _SCANNED_RAW + _CLEAN,
    "clean_rejects": _TABLE_RAW + "SELECT seq AS ingest_seq, city_name, reason FROM judged WHERE reason IS NOT NULL",
    "clean_reject_counts": _TABLE_RAW
    + "SELECT reason, count(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY reason",
    "historical_alias_seeds": _TABLE_RAW
    + "SELECT seq AS ingest_seq, name AS raw_alias, canonical, 'exact' AS match_method FROM judged "
    "WHERE canonical IS NOT NULL",
    "alias_upsert_ignore": f"""{_ALIAS_BASE}, by_hand AS (
  SELECT n_nationkey AS alias_id, ({[n.title() for n in _FORMER]!r})[n_nationkey + 1] AS raw_alias
  FROM nation WHERE n_regionkey = 1 AND n_nationkey < {len(_FORMER)}
), fresh AS (
  SELECT raw_alias, min(city_id) AS city_id FROM matched
  WHERE city_id IS NOT NULL AND raw_alias NOT IN (SELECT raw_alias FROM by_hand) GROUP BY 1
)
SELECT cast(alias_id AS bigint) AS alias_id, raw_alias, cast(-1 AS bigint) AS canonical_city_id,
       'manual' AS match_method, '2024-01-01 00:00:00.000000' AS created_at FROM by_hand
UNION ALL
SELECT (SELECT coalesce(max(alias_id), 0) FROM by_hand)
       + row_number() OVER (ORDER BY md5(raw_alias)[:3], raw_alias), raw_alias, city_id, 'exact',
       '2024-02-01 00:00:00.000000' FROM fresh
""",
    "alias_seeding_outcome": f"""{_ALIAS_BASE}
SELECT raw_alias, count(city_id) AS attempted, count(*) - count(city_id) AS unknown FROM matched GROUP BY 1
""",
    "dim_merge": f"""
WITH base AS (
  SELECT c_custkey AS city_id, c_name AS city_name, n_name AS state, length(c_mktsegment) % 3 + 1 AS tier,
         cast(trunc(c_acctbal) AS bigint) AS population, c_acctbal >= 0 AS is_active, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), fresh AS (
  SELECT city_name, state,
    {_numbered("city_name", "state", "(SELECT max(city_id) FROM base WHERE segment <= 'HOUSEHOLD')")} AS city_id
  FROM base WHERE segment > 'HOUSEHOLD'
)
SELECT city_id, city_name, state, CASE WHEN segment >= 'FURNITURE' THEN 9.25 ELSE 2.5 END AS longitude,
       cast(CASE WHEN segment >= 'FURNITURE' THEN 3 ELSE tier END AS bigint) AS tier,
       cast(CASE WHEN segment >= 'FURNITURE' THEN 7 ELSE population END AS bigint) AS population, is_active,
       '2024-01-01 00:00:00.000000' AS created_at,
       CASE WHEN segment >= 'FURNITURE' THEN '2024-02-01 00:00:00.000000'
            ELSE '2024-01-01 00:00:00.000000' END AS updated_at
FROM base WHERE segment <= 'HOUSEHOLD'
UNION ALL
SELECT city_id, city_name, state, 9.25, 3, 7, true, '2024-02-01 00:00:00.000000', '2024-02-01 00:00:00.000000'
FROM fresh
""",
    "ids_by_name": """
SELECT n_name || '/' || c_mktsegment AS city_name, min(c_custkey) AS city_id
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0 GROUP BY 1
""",
    "active_entities": """
SELECT c_custkey AS city_id, c_name AS city_name, n_name AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
""",
}
