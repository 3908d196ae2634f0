"""Incremental linkage: new catalog rows from a stream are linked against the static reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from catlink.operators.linkage import link


def link_stream(catalog: DataFrame, reference: DataFrame, alternates: DataFrame, credits: DataFrame, people: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes each micro-batch's linked rows to its own folder, so that a repeated batch replaces itself."""

    def each(rows: DataFrame, batch: int) -> None:
        link(rows, reference, alternates, credits, people).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return catalog.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
