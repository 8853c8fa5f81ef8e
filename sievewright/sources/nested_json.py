"""Nested JSON collections: files of documents, groups and items, flattened to ordered records.

A file holds a document or a list of documents, a document a group or a list of
groups, a group an item or a list of items. Scalars missing are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import numbered

SCHEMA = "seq long, instruction string, input string, output string, task string, task_category string, source string, consulting_category string, consulting_content string, file_origin string"


def json_files(spark: SparkSession, folder: str) -> list[str]:
    """All .json files at any depth, those that start with '_' too, hidden ones and those in hidden folders not; by path. A missing folder has none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    root, found = system.makeQualified(at).toString().rstrip("/"), []
    listed = system.listFiles(at, True)
    while listed.hasNext():
        path = listed.next().getPath().toString()
        inside = path[len(root) + 1 :].split("/")
        if path.endswith(".json") and not any(x.startswith(".") for x in inside):
            found.append(path)
    return sorted(found)


def _content(spark: SparkSession, file: str) -> bytes:
    at = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and j, the file's JSON value (null: not UTF-8, not JSON, or too large to parse)."""
    files = json_files(spark, folder)
    if not files:
        return spark.createDataFrame([], "path string, content binary").select("path", F.try_parse_json(F.col("content").cast("string")).alias("j"))
    # Python's reader takes the last of equal keys.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    plain = [f for f in files if not f.rsplit("/", 1)[1].startswith("_")]
    raw = spark.read.format("binaryFile").load(plain).select("path", "content") if plain else None
    # Spark's readers pass over names that start with '_'; the driver reads these, one by one.
    held = [(f, bytearray(_content(spark, f))) for f in files if f not in set(plain)]
    if held:
        other = spark.createDataFrame(held, "path string, content binary")
        raw = other if raw is None else raw.unionByName(other)
    raw = raw.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content")
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    return raw.select("path", F.try_parse_json(text).alias("j"))


def load_errors(files: DataFrame) -> DataFrame:
    """The paths of files that could not be read."""
    return files.where("j is null").select("path")


#: A JSON object as a list of one, a list as it is; anything else is null.
_LISTED = "coalesce(try_variant_get({0}, '$', 'array<variant>'), CASE WHEN try_variant_get({0}, '$', 'map<string,variant>') IS NOT NULL THEN array({0}) END)"


def flatten(files: DataFrame) -> DataFrame:
    """Records of all files in order: file, document, group, item. An item's task is its own, if the key is there at all, else its group's.

    files: path and j; with a column part, the documents of a file may stand in several rows, in its order, so that
    no row holds a large file.
    """
    text = lambda path: f"coalesce({path}::string, '')"
    files = files if "part" in files.columns else files.withColumn("part", F.lit(0))
    rows = files.sparkSession.sql(
        f"""
        SELECT path, part, d.pos AS d, g.pos AS g, i.pos AS i,
            {text("i.value:instruction")} AS instruction, {text("i.value:input")} AS input, {text("i.value:output")} AS output,
            CASE WHEN variant_get(i.value, '$.task') IS NULL THEN {text("g.value:tuning_type")} ELSE {text("i.value:task")} END AS task,
            {text("i.value:task_category")} AS task_category, {text("d.value:source")} AS source,
            {text("d.value:consulting_category")} AS consulting_category, {text("d.value:consulting_content")} AS consulting_content,
            element_at(split(path, '/'), -1) AS file_origin
        FROM {{files}},
            LATERAL posexplode({_LISTED.format("j")}) AS d(pos, value),
            LATERAL posexplode({_LISTED.format("d.value:instructions")}) AS g(pos, value),
            LATERAL posexplode({_LISTED.format("g.value:data")}) AS i(pos, value)
        """,
        files=files,
    )
    placed = numbered(rows, ["path", "part", "d", "g", "i"], "seq")
    return placed.select("seq", *(c.split()[0] for c in SCHEMA.split(", ")[1:]))


def load(spark: SparkSession, folder: str) -> tuple[DataFrame | None, DataFrame]:
    """Records of a folder (None if it has no files) and its unreadable files."""
    files = read_files(spark, folder)
    return (flatten(files) if json_files(spark, folder) else None), load_errors(files)
