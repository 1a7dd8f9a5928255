"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept, and its result is
written and read again. All stages but the last return the columns of the
documents they were given. Where a stage joins its findings to its rows, it
first stores the rows with a number, so repeated and null ids do no harm and no
number is computed twice. The stored rows are bucketed by chunks of successive
numbers, and findings are gathered by chunk: texts are not shuffled for the join.

Defined results: an empty table passes through all stages; a null text goes in
the first stage, as it has no language; a null source is a source of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import langid, mixing, ngram_join, packing, toxicity
from skyledger.llm.common import partitions_for, small_batches, stored, temporary
from skyledger.llm.queries import public_file, table
from skyledger.session import scratch_dir

#: A text whose likeliest language has less than this mean probability has none.
LEAST_LANGUAGE_SCORE = 0.4
ROW, CHUNK = "__row_of_input", "__chunk_of_input"
#: Numbers in a chunk, as a power of two; it is at most the 33 bits that number the rows of a partition.
CHUNK_BITS = 16

#: No stage can be stated in SQL: models are trained, and rounding and packing draw at random.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number and its chunk, stored together.

    A task writes a file for each of its chunks' buckets, about one for 65,536 rows, and shuffles nothing.
    """
    spark = docs.sparkSession
    rows = docs.withColumn(ROW, F.monotonically_increasing_id()).withColumn(CHUNK, F.shiftright(ROW, CHUNK_BITS))
    name, buckets = f"pipeline_rows_{uuid.uuid4().hex}", partitions_for(spark, docs.rdd.getNumPartitions())
    write = rows.write.format("parquet").option("path", scratch_dir(spark, "pipeline-rows"))
    write.bucketBy(min(buckets, 100_000), CHUNK).saveAsTable(name)  # Spark allows no more buckets
    numbered = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name: the files stay, as they are in a folder of their own
    return numbered


def _repeated(numbered: DataFrame, times: DataFrame, label: str) -> DataFrame:
    """Each row as often as ``times`` says, which has the number of every row once, and how often."""
    chunk = F.shiftright(ROW, CHUNK_BITS).alias("__chunk")
    # Numbers of a partition have no gaps, so a row's place in its chunk follows from its number.
    in_order = F.transform(F.sort_array(F.collect_list(F.struct(ROW, "__times"))), lambda x: x["__times"])
    chunks = stored(times.groupBy(chunk).agg(in_order.alias("__all")), label, 1)
    own = F.col("__all")[F.pmod(ROW, F.lit(1 << CHUNK_BITS)).cast("int")]
    rows = numbered.join(chunks.hint("shuffle_hash"), F.col(CHUNK) == F.col("__chunk")).withColumn("__times", own)
    rows = rows.where("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return rows.drop("__chunk", "__all", "__times", "__copy", ROW, CHUNK)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach."""
    small_batches(spark)
    found = docs.withColumn("__found", langid.prediction(langid.trained(docs), F.col("text")))
    known = (F.col("__found.lang_pred") != langid.UNKNOWN) & (F.col("__found.score") >= LEAST_LANGUAGE_SCORE)
    return found.where(known).drop("__found")


def without_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("__score", toxicity.score(model, F.col("text")))
    return scored.where(F.col("__score") < toxicity.CUT).drop("__score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, of several the first."""
    numbered = _numbered(docs)
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row")))
    with temporary(spark):  # what the join has stored is more than the documents
        groups = ngram_join.similar_groups(numbered.select(ROW, "text"), id_column=ROW)
        groups = groups.join(numbered.select(F.col(ROW).alias("__row"), F.col("doc_id").alias("__id")), F.col("doc_id") == F.col("__row"))
        kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias(ROW), F.lit(1).alias("__times"))
        every = numbered.select(ROW, F.lit(0).alias("__times"))
        times = every.unionByName(kept).groupBy(ROW).agg(F.max("__times").alias("__times"))
        return _repeated(numbered, times, "kept")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    numbered = _numbered(docs)
    mixed = mixing.mix(mixing.units_of(numbered, carried=[ROW]))
    return _repeated(numbered, mixed.select(ROW, F.col("copies").alias("__times")), "copies")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.digests(docs, public_file("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", without_toxicity),
    ("ngram_join", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
