"""How many parts a table's rows are dealt to, so that a task's share doesn't grow with the table."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Stored bytes of one part: some thousand documents, or some hundred thousand order lines.
PART_BYTES = 4 << 20


def parts(table: DataFrame, size: int = PART_BYTES) -> int:
    """Parts of `size` stored bytes, one for each core at least; a number given to `repartition` is not lowered by the planner."""
    spark = table.sparkSession
    stored = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if stored >= 1 << 50:  # not known: rows that are in no file
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, -(-stored // size))
