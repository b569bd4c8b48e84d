"""Tables bucketed by a key, for joins that need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, key: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Save ``df`` as catalog table ``table``, bucketed by ``key``, one file per bucket; the table, read back.

    ``buckets`` is by default the number of shuffle partitions, so that the table
    also meets shuffled sides without a shuffle of its own. Without ``path`` the
    table goes to the warehouse folder. Rows of a key, those without one included, are
    written by one task: the key should be unique or nearly so.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, F.col(key)).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
