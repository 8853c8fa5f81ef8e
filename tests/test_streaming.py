from sievewright.streaming import stream

SCHEMA = "seq long, instruction string, input string, output string, task string, consulting_content string, ts timestamp"


def test_stateless_stages_and_first_arrivals(spark, tmp_path):
    rows = [(i, "summarise it", "안녕하세요. a long enough input " * 2, "same output words" if i % 2 else f"output {i} words", "요약", "", None) for i in range(10)] + [(99, "x", "y", "z", "요약", "", None)]
    from pyspark.sql import functions as F

    spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq"))).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    kept = stream.first_arrivals(stream.prepared(source), "ts", "1 hour")
    query = kept.select("seq", "input").writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = spark.table("kept").collect()
    assert len(got) == 6 and sum(r.seq % 2 for r in got) == 1
    assert all(r.input.startswith("a long") for r in got)


def test_reason_counts_and_chat(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(i, "summarise it", "a long enough input " * 2, "" if i % 2 else "fine output", "요약", "", None) for i in range(6)]
    spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq"))).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    query = stream.reason_counts(source, "ts", "1 minute", "0 seconds").writeStream.format("memory").outputMode("complete").queryName("reasons").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r.drop_reason: r["count"] for r in spark.table("reasons").collect()} == {None: 3, "empty_field": 3}
    query = stream.chat_stream(source).writeStream.format("memory").queryName("chat").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("chat").count() == 3
