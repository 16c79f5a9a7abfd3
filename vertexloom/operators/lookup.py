"""Looking up a value per row when very many rows may ask for the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(
    rows: DataFrame, column: str, table: DataFrame, name: str, hot: DataFrame | None = None, missing=None
) -> DataFrame:
    """Add ``name``, the value that ``table`` (key, value; keys unique) has for ``column``.

    Rows without an answer get ``missing``, or go if it is None. ``hot`` is the
    part of the table whose keys very many rows have, small enough to broadcast.
    Rows it answers do not meet in one partition: they go through the shuffle
    join under a key of their own, whose answer is ignored.
    """
    key, value = table.columns
    if hot is None:
        answers = table.withColumnsRenamed({key: "_asked", value: "_answer"})
        how = "inner" if missing is None else "left"
        found = rows.join(answers, rows[column] == answers["_asked"], how)
    else:
        known = rows.join(F.broadcast(hot.toDF(column, "_known")), column, "left")
        own = F.xxhash64(F.spark_partition_id(), *rows.columns).cast(rows.schema[column].dataType)
        asked = known.withColumn("_asked", F.when(F.col("_known").isNull(), F.col(column)).otherwise(own))
        answered = asked.join(table.toDF("_asked", "_found"), "_asked", "left")
        found = answered.withColumn("_answer", F.coalesce("_known", "_found"))
        if missing is None:
            found = found.where(F.col("_answer").isNotNull())
    answer = F.col("_answer") if missing is None else F.coalesce("_answer", F.lit(missing))
    return found.select(*rows.columns, answer.alias(name))
