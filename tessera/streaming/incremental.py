"""Resumable matching: in batches by key hash, or as a stream of arriving files.

Progress is a Parquet folder with one sub-folder for each batch, replaced as a whole, so a
batch that was interrupted leaves nothing behind and one that is repeated isn't counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.match import cascade
from ..schema import PROGRESS
from ..sinks.files import done

Match = Callable[[DataFrame, DataFrame], DataFrame]


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """All matches so far; none before the first batch."""
    from ..sources.tables import exists

    if not exists(spark, f"{folder}/batch=*"):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).option("basePath", folder).parquet(f"{folder}/batch=*").select(*PROGRESS.names).dropDuplicates(["cnpj"])


def todo(pois: DataFrame, folder: str, id: str = "cnpj") -> DataFrame:
    """Rows without a match so far; those that were tried in vain are tried again."""
    return pois.join(progress(pois.sparkSession, folder).select(F.col("cnpj").alias(id)), id, "left_anti")


def match_batches(pois: DataFrame, index: DataFrame, folder: str, *, batches: int = 16, match: Match = cascade, id: str = "cnpj", stop: Callable[[], bool] = lambda: False) -> DataFrame:
    """Match the rows batch by batch (a batch is a class of id hashes) and return all progress.
    Batches that are complete are skipped; `stop` is asked before each."""
    for b in range(batches):
        path = f"{folder}/batch={b}"
        if done(pois.sparkSession, path):
            continue
        if stop():
            break
        part = pois.where(F.pmod(F.xxhash64(id), F.lit(batches)) == b)
        found = match(part, index)
        found.select(F.col(id).alias("cnpj"), *PROGRESS.names[1:]).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return progress(pois.sparkSession, folder)


def match_stream(spark: SparkSession, source: str, schema, index: DataFrame, folder: str, checkpoint: str, *, normalise: Callable[[DataFrame], DataFrame] = lambda df: df, match: Match = cascade, id: str = "cnpj", files: int = 100, available_now: bool = True):
    """Match Parquet files as they arrive; each micro-batch is written under its own number, so
    one that runs again after a failure replaces itself. Ids that are done are skipped."""

    def one(batch: DataFrame, number: int) -> None:
        rows = normalise(batch).dropDuplicates([id])
        # What this batch itself wrote before a failure doesn't count as done.
        before = progress(spark, folder)
        path = f"{folder}/batch=s{number}"
        rest = rows if done(spark, path) else rows.join(before.select(F.col("cnpj").alias(id)), id, "left_anti")
        match(rest, index).select(F.col(id).alias("cnpj"), *PROGRESS.names[1:]).write.mode("overwrite").parquet(path)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def partial_output(pois: DataFrame, cache: DataFrame, path: str, categories: list[str] | None = None) -> str:
    """The output so far, while keys are still being looked up, under a name of its own, so that
    no later run takes it for the whole one."""
    from ..operators.geocode import three_state
    from ..sinks.files import write_parquet

    rows = pois.where(F.col("osm_category").isin(*categories)) if categories else pois
    return write_parquet(three_state(rows, cache), f"{path}.partial")
