"""Row numbers and tiles over a whole table without a single-partition window.

``numbered`` sorts by range partitions, writes the sorted table once, counts the rows of each partition and adds to a
row's place in its partition the rows of the partitions before it. The one window without a partition clause
runs over the counts (one row a shuffle partition). The order must be total for the numbers to be the same on
every run; rows equal in all order columns are interchangeable.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edustar.session import storage_root

_PART, _LOCAL, _BEFORE = "__part", "__local", "__before"


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """``df`` with a column ``name``: the row's place in ``order``, from 0 (long)."""
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        # both from one id, so that they speak of the same task
        _LOCAL: F.monotonically_increasing_id()})
    path = f"{storage_root(spark)}/numbered/{uuid.uuid4().hex}"
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path).withColumns({
        _PART: F.shiftright(F.col(_LOCAL), 33), _LOCAL: F.col(_LOCAL).bitwiseAND(F.lit((1 << 33) - 1))})
    counts = stored.groupBy(_PART).agg(F.count("*").alias("n"))
    before = counts.select(_PART, (F.sum("n").over(Window.orderBy(_PART)) - F.col("n")).alias(_BEFORE))
    # one row a shuffle partition
    return (stored.join(F.broadcast(before), _PART)
            .withColumn(name, (F.col(_BEFORE) + F.col(_LOCAL)).cast("long")).drop(_PART, _LOCAL, _BEFORE))


def ntile(df: DataFrame, tiles: int, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with a column ``name``: its tile from 1 to ``tiles`` by ``order``, as SQL's ``ntile``: sizes differ by one at
    most and the larger tiles come first."""
    if tiles < 1:
        raise ValueError("at least one tile")
    rows = numbered(df, order, "__number")
    total = rows.agg(F.count("*")).first()[0]
    small, larger = divmod(total, tiles)
    edge = larger * (small + 1)  # rows in the larger tiles
    number = F.col("__number")
    tile = F.when(number < edge, F.floor(number / F.lit(small + 1)))
    if small:
        tile = tile.otherwise(F.floor((number - edge) / F.lit(small)) + larger)
    return rows.withColumn(name, (tile + 1).cast("int")).drop("__number")
