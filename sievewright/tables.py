"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session (tests) gets a folder of its own; a
    cluster without the setting is refused, as a machine's own folder can't be
    seen by the other machines.
    """
    conf = spark.sparkContext.getConf()
    if found := conf.get("spark.checkpoint.dir"):
        return found
    if not conf.get("spark.master", "local").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if not hasattr(spark, "_own_shared_folder"):
        spark._own_shared_folder = tempfile.mkdtemp(prefix="shared-")
    return spark._own_shared_folder


def new_table(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df, written as Parquet into the shared folder and read back: it is computed once,
    its lineage ends here, and a lost executor costs no recomputation."""
    path = new_table(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes written tables that no later result reads."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with the place of each row in the order of columns, from 0; ties in any order.

    Ranges of the order are dealt out, sorted and written; a row's place is its
    file's start and its index there, so no task holds all rows.
    """
    spark, path = df.sparkSession, new_table(df.sparkSession, "numbered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").count()
    place = Window.orderBy(F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("count").over(place), F.lit(0)).alias("_before"))
    return rows.join(files, "_file").select(*df.columns, (F.col("_before") + F.col("_row")).alias(name))
