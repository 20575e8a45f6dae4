"""Services asked in batches: what a batch was answered is kept at once, and a run can be stopped between batches."""

from __future__ import annotations

import logging
import signal
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import saved
from ..sources.tables import exists

log = logging.getLogger(__name__)


class Stop:
    """True once SIGINT came; a second one ends the process as usual. Use as a context."""

    def __init__(self) -> None:
        self.asked = False

    def __call__(self) -> bool:
        return self.asked

    def _ask(self, *_) -> None:
        log.warning("stopping after this batch; interrupt again to end at once")
        self.asked = True
        signal.signal(signal.SIGINT, self.before)

    def __enter__(self) -> Stop:
        self.before = signal.getsignal(signal.SIGINT)
        signal.signal(signal.SIGINT, self._ask)
        return self

    def __exit__(self, *_) -> None:
        signal.signal(signal.SIGINT, self.before)


def answers(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All answers kept under `folder`; none before the first batch."""
    if not exists(spark, f"{folder}/batch=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/batch=*").select(*schema.names)


def ask_in_batches(rows: DataFrame, ask: Callable[[DataFrame], DataFrame], folder: str, schema: T.StructType, key: str, *, size: int = 1_000, stop: Callable[[], bool] = lambda: False, after: Callable[[int], None] = lambda asked: None) -> DataFrame:
    """All answers of `ask` to the rows, by `key`. Rows with an answer under `folder` aren't asked
    again; the others are, in batches of about `size`, each committed as a whole. `stop` is asked
    before each batch, and `after` is told how many rows have been asked so far."""
    spark = rows.sparkSession
    todo = saved(rows.join(answers(spark, folder, schema).select(key), key, "left_anti"), "asked")
    n, run = todo.count(), uuid.uuid4().hex
    batches = -(-n // size)
    for b in range(batches):
        if stop():
            break
        part = todo.where(F.pmod(F.xxhash64(key), F.lit(batches)) == b)
        ask(part).select(*schema.names).write.parquet(f"{folder}/batch={run}-{b:06d}")
        after(min(n, (b + 1) * size))
    return answers(spark, folder, schema)
