"""Tables bucketed and sorted by a key, so that joins and grouping on it need no shuffle."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .fs import Folder

#: Names key, buckets and columns. Written last: a folder without it is not a whole table.
SPEC = "_bucketing"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write the rows to a new folder, ``buckets`` by a hash of ``key`` and sorted by it.

    Two tables join without a shuffle where they have the same number of buckets (the session's
    shuffle partitions by default; it belongs to the size of the larger table) and keys of one
    type. Rows are dealt out by bucket first, so that there is a file per bucket and not per
    task and bucket; adaptive execution cuts a heavy bucket into several tasks and files, which
    costs its order only. A key that owns much of a table is still one task of a join: list it by
    ``joins.hot_keys``.
    """
    spark = df.sparkSession
    if Folder(spark, path).exists():
        raise ValueError(f"{path} exists; a bucketed table gets a new folder")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spec = {"id": uuid.uuid4().hex, "key": key, "buckets": buckets,
            "schema": T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]).json()}
    (df.hint("rebalance", buckets, F.col(_quoted(key)))
     .write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(f"lakeline_{spec['id']}"))
    Folder(spark, f"{path}/{SPEC}").write(json.dumps(spec).encode())
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table with its buckets, in any session: the catalog entry is made where it lacks."""
    spec = json.loads(Folder(spark, f"{path}/{SPEC}").read())
    name, key = f"lakeline_{spec['id']}", _quoted(spec["key"])
    if not spark.catalog.tableExists(name):
        columns = T.StructType.fromJson(json.loads(spec["schema"])).toDDL()
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) "
                  f"SORTED BY ({key}) INTO {spec['buckets']} BUCKETS LOCATION '{location}'")
    return spark.table(name)


def forget_bucketed(spark: SparkSession, path: str) -> None:
    """Drop the table's catalog entry; its files stay."""
    spec = json.loads(Folder(spark, f"{path}/{SPEC}").read())
    spark.sql(f"DROP TABLE IF EXISTS lakeline_{spec['id']}")
