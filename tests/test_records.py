from pyspark.sql import functions as F

from sievewright.plans import registry
from sievewright.plans.records import records


def tables(spark, tmp_path, texts):
    spark.createDataFrame([(i, t, "en", "web") for i, t in texts], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_outputs_are_whole_texts(spark, tmp_path):
    same = " ".join(f"w{i}" for i in range(200))
    at = tables(spark, tmp_path, [(1, f"{same} one end"), (2, f"{same} another end"), (31, "long " * 1200)])
    got = {r.seq: r.output for r in records(spark, at).collect()}
    assert got[1].endswith(" one end") and got[2].endswith(" another end") and len(got[31]) == 6000
    # Texts that differ late are no exact copies.
    keys = registry.QUERIES["dedup_key_output"](spark, at)
    assert keys.count() == 3 and keys.drop("seq").distinct().count() == 3


def test_long_outputs_are_judged(spark, tmp_path):
    at = tables(spark, tmp_path, [(31, "long words of a text " * 300)])
    assert "output_too_long" in {r.drop_reason for r in registry.QUERIES["filter_reasons"](spark, at).where(F.col("drop_reason").isNotNull()).collect()}
