"""Scan of the dirty city file: everything is text, damage is reported, not guessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import na_to_null
from ..schemas import CITY_CSV_COLUMNS

CORRUPT = "_corrupt_record"


def read_city_csv(spark: SparkSession, path: str, multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(rows, too_wide)`` of the CSV at ``path``, a file or a folder of files.

    Short rows are padded with null and blank lines skipped. A row with more
    fields than the header cannot be placed and goes to ``too_wide`` as its raw
    text. ``ingest_seq`` is the position of a row in the input: file, split
    within the file, order within the split. A missing path raises at once.

    With ``multiline`` a quoted field may hold line breaks, in files of any size: they are
    read in splits all the same, and lines are put together afterwards. A file that ends
    within a quoted field tells nothing about where that began; its lines from the last open
    quote on go to ``too_wide``. Without ``multiline`` all lines with an open quote do.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*CITY_CSV_COLUMNS, CORRUPT]])
    if multiline:
        scanned = _parsed(quoted_records(spark, path), schema)
    else:
        scanned = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("escape", '"')
            .csv(path)
            .withColumn("ingest_seq", ingest_position())
        )
        # Fields are unquoted by the scan, but for the second half of a torn line.
        scanned = scanned.withColumn("_torn", open_quote(F.coalesce(CORRUPT, F.concat_ws(",", *CITY_CSV_COLUMNS))))
    # The scan refuses queries on the raw line alone, so the fields take part in
    # the test: a line with more of them is longer than the ones kept.
    longer = F.length(F.col(CORRUPT)) > F.length(F.concat_ws("", *CITY_CSV_COLUMNS))
    wide = F.coalesce((field_count(F.col(CORRUPT)) > len(CITY_CSV_COLUMNS)) & longer, F.lit(False))
    scanned = scanned.withColumn("_wide", wide)
    rows = scanned.filter(~F.col("_wide") & ~F.col("_torn"))
    rows = rows.select("ingest_seq", *[na_to_null(F.col(c)).alias(c) for c in CITY_CSV_COLUMNS])
    too_wide = scanned.filter(F.col("_wide") | F.col("_torn")).select(
        "ingest_seq",
        F.coalesce(CORRUPT, F.concat_ws(",", *CITY_CSV_COLUMNS)).alias("raw_line"),
        F.when(F.col("_torn"), "open quote").otherwise("too many fields").alias("reason"),
    )
    return rows, too_wide


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of text files whose quoted fields may hold line breaks, by quote parity.

    A line begins a record if the quotes before it in the file are even in number. Every split
    counts its quotes and, for either parity that it may begin with, the records that begin in
    it; a running parity and a running sum over the splits of a file then number all
    records. Lines that are records by themselves go nowhere; only those of records
    with line breaks are shuffled to be joined. Rows: ``file``, ``record`` from 1, ``text``,
    and ``torn`` for lines of a quoted field that the file leaves open.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", "\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    lines = lines.withColumn("odd", (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2)
    split = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("odd").over(split), F.lit(0)) % 2
    lines = lines.withColumn("parity", parity).withColumns(
        {f"even{p}": F.coalesce(F.sum((F.col("parity") == p).cast("int")).over(split), F.lit(0)) for p in (0, 1)}
    )
    # As many rows as there are splits.
    sizes = lines.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"), *[F.count_if(F.col("parity") == p).alias(f"begin{p}") for p in (0, 1)]
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("carry", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("carry") == 0, F.col("begin0")).otherwise(F.col("begin1"))
    whole = Window.partitionBy("file")
    splits = sizes.select(
        "file", "block", "carry",
        F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("before"),
        (F.sum("odd").over(whole) % 2 == 1).alias("open"), F.sum(begun).over(whole).alias("records"),
    )
    placed = lines.join(splits, ["file", "block"])
    inside = (F.col("parity") + F.col("carry")) % 2 == 1
    number = F.col("before") + F.when(F.col("carry") == 0, F.col("even0")).otherwise(F.col("even1")) + F.when(inside, 0).otherwise(1)
    placed = placed.select("file", "block", "row", "line", "odd", inside.alias("inside"), number.alias("record"), ((number == F.col("records")) & F.col("open")).alias("torn"))
    alone = F.col("torn") | (~F.col("inside") & (F.col("odd") == 0))
    single = placed.filter(alone).select("file", "record", "block", "row", F.col("line").alias("text"), "torn")
    joined = placed.filter(~alone).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "row", "line"))).alias("parts")
    )
    several = joined.select(
        "file", "record", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"),
        F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("text"), F.lit(False).alias("torn"),
    )
    return single.unionByName(several)


def _parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of the records after the header, which every file must begin with."""
    expected = ",".join(CITY_CSV_COLUMNS)
    header = F.when(
        F.regexp_replace("text", r'^\uFEFF|[\s"]', "") != expected,
        F.raise_error(F.concat(F.lit("the header of "), F.col("file"), F.lit(" is "), F.col("text"))),
    ).otherwise(False)
    kept = F.when(F.col("record") == 1, header).otherwise(F.trim("text") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true"}
    fields = F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "), options)
    position = F.struct("file", "block", "row")
    # Lines left open are not parsed: they count as raw text.
    found = records.filter(kept).select(position.alias("ingest_seq"), "text", "torn", fields.alias("f"))
    raw = F.when(F.col("torn"), F.col("text")).otherwise(F.col(f"f.{CORRUPT}")).alias(CORRUPT)
    return found.select("ingest_seq", *[f"f.{c}" for c in CITY_CSV_COLUMNS], raw, F.col("torn").alias("_torn"))


def open_quote(line: Column) -> Column:
    return F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1


def ingest_position() -> Column:
    """Orders rows as they stand in the input; comparable across files and splits."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def field_count(line: Column) -> Column:
    """Comma-separated fields of a line, quoted commas not counted."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(F.regexp_replace(bare, "[^,]", "")) + 1
