"""Linkage of newly arriving left records, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from catalink.operators.blocking import weighed_index
from catalink.operators.linkage import Rules, logged, matches
from catalink.sources.catalogues import common_schema
from catalink.sources.tables import staging_scope


def new_records(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """The stream without records delivered again within ``late`` of event time."""
    return stream.withWatermark("crawled_at", late).dropDuplicatesWithinWatermark(["id"])


def link_stream(stream: DataFrame, right: DataFrame, target: str, checkpoint: str, rules: Rules = Rules(), late: str = "30 days") -> StreamingQuery:
    """Starts the query that links every micro-batch of left records to ``right``.

    ``right`` is on the common schema. The matches of batch n are written to
    ``target/batch=n``, overwriting what an earlier attempt at it left, so a
    restart repeats nothing. Runs over what is there and ends. The index of the
    right titles is built once; what a batch stages is deleted with it.
    """
    weighed = weighed_index(right, "original_id")

    def link(batch: DataFrame, n: int) -> None:
        with staging_scope(batch.sparkSession):
            found = logged(matches(common_schema(batch, True), right, rules, weighed), rules)
            found.write.mode("overwrite").parquet(f"{target}/batch={n}")

    return new_records(stream, late).writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
