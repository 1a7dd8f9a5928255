"""One query per operator over its whole table, with the columns its contract names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    divergence,
    fingerprints,
    html_crf,
    langid,
    lattice_lm,
    mixing,
    ngram_join,
    packed_ids,
    packing,
    resampling,
    toxicity,
    warc_zip,
)
from .common import remainder, small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), share=(90, 100), n=3)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def held_out(modulus: int, remains: int) -> Column:
    """Whether a row is kept from training; rows with a null id are not."""
    return F.coalesce(remainder("doc_id", modulus) == remains, F.lit(False))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.trained(docs.where(~held_out(4, 2)))
    return langid.classified(docs.select("doc_id", held_out(4, 2).alias("held_out"), "text"), net).drop("text")


def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.trained(docs, labels.where(~held_out(3, 1)))
    scored = toxicity.scored(docs.select("doc_id", held_out(3, 1).alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lattice_lm.score(docs, held_out(7, 2), public_file("piece_bpe_32k.model"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.round_trip(spark, table(spark, sf_dir, "pages"), least_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digests(mixing.mix(mixing.units_of(table(spark, sf_dir, "documents"))))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids.round_trip(table(spark, sf_dir, "documents"), public_file("word_bpe_49k.json"), end_id=2)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"), least_docs=30, most_terms=50)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_ngram_join, op2_fingerprints, op3_langid, op4_html_crf, op5_toxicity, op6_lattice_lm, op7_packing,
        op8_warc_zip, op9_mixing, op10_ann, op11_packed_ids, op12_divergence, op13_resampling,
    )
}
ORACLES: dict[str, str] = {"op12_divergence": divergence.SQL, "op13_resampling": resampling.SQL}
