"""Output shards of a bounded size, in record order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import stored


def rolled(df: DataFrame, order: str, size: Column, target: int) -> DataFrame:
    """Adds ``shard_index`` as one writer would: a record opens a new shard where it would overfill one that is not empty.

    Where a shard ends depends on where it began, so only (order, bytes) goes
    through one task, as a stream; it holds a batch at a time. For shards whose
    ends need not be those of one writer, ``balanced`` has no such task.
    """
    schema = f"`{order}` {dict(df.dtypes)[order]}, shard_index bigint"

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = filled = 0
        for pdf in frames:
            out = np.empty(len(pdf), np.int64)
            for i, n in enumerate(pdf["n"].to_numpy()):
                if filled > 0 and filled + n > target:
                    index, filled = index + 1, 0
                filled += n
                out[i] = index
            yield pd.DataFrame({order: pdf[order], "shard_index": out})

    folded = df.select(order, size.alias("n")).repartition(1).sortWithinPartitions(order).mapInPandas(run, schema)
    return df.join(folded, order)


def balanced(df: DataFrame, order: Sequence[str], size: Column, target: int, ranges: int = 256) -> DataFrame:
    """Adds ``shard_index`` by the bytes before a record: no shard exceeds the target by more than a record.

    Records are put in ranges of their order; only the ranges' sums are
    ordered in one place.
    """
    spread = stored(df.withColumn("__n", size).repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = spread.groupBy("__range").agg(F.sum("__n").alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))  # one row for each range
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    return spread.join(F.broadcast(starts), "__range").withColumn("shard_index", F.floor(at / target).cast("bigint")).drop("__n", "__range", "__before")
