"""Bronze files to facts as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import parse_air_quality, parse_weather
from ..plans.readings_load import load_rows
from ..schemas import BRONZE
from ..sources.tables import Warehouse

PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fact_weather_reading": parse_weather,
    "fact_air_quality_reading": parse_air_quality,
}


def stream_batch(checkpoint: str, batch_id: int) -> str:
    """The name under which a stream's batch keeps its rejects."""
    return f"{checkpoint.rstrip('/').rsplit('/', 1)[-1]}-{batch_id}"


def ingest_new_documents(
    warehouse: Warehouse,
    landing: str,
    table: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    check_foreign: bool = True,
) -> StreamingQuery:
    """Load the files that ``landing`` has gained since the last call, then stop.

    The files are Parquet documents in bronze form. Each batch is merged by key,
    so late and repeated documents need no watermark or state, and a batch that
    is replayed after a failure leaves the same rows. What a batch cannot load stays in the
    warehouse under the checkpoint's and the batch's name, once however often it is replayed.
    """
    stream = warehouse.spark.readStream.schema(BRONZE).format("parquet")
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        load_rows(warehouse, table, PARSERS[table](batch), stream_batch(checkpoint, batch_id), check_foreign)

    return (
        stream.load(landing)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
