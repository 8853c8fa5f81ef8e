"""The queries of the instruction-corpus engine and the SQL that checks them."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Cleaning, Dedup, Output, PersonalData, Settings
from ..functions import quality, similarity, text
from ..operators import cleaning, dedup, filtering, personal_data, profiling, rows
from ..sources import nested_json
from ..tables import written
from . import oracles as o
from .pipeline import prepare
from .records import RECORDS, chat_pairs, records

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Documents of a nested file that load_flatten writes into one part.
DOCUMENTS = 16


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _text_query(name: str, build, sql: str) -> None:
    """seq and one text function of the raw input."""
    QUERIES[name] = lambda spark, sf_dir: records(spark, sf_dir).select("seq", build(F.col("input")).alias("value"))
    ORACLES[name] = f"SELECT seq, {sql} AS value FROM ({RECORDS})"


_text_query("clean_nfc", text.nfc, "nfc_normalize(input)")
_text_query("clean_control", text.drop_control, o.control("input"))
_text_query("clean_html", text.drop_tags, o.tags("input"))
_text_query("clean_greeting", lambda x: text.drop_courtesies(x, Cleaning().courtesies), o.courtesies("input"))
_text_query("clean_whitespace", text.squeeze_blanks, o.blanks("input"))
_text_query("clean_newlines", lambda x: text.squeeze_newlines(x, 2), o.newlines("input"))
_text_query("clean_numbering", text.drop_numbering, o.numbering("input"))
_text_query("clean_strip", text.strip, o.stripped("input"))
_text_query("clean_full", lambda x: text.clean(x, Cleaning()), o.cleaned("input"))


@_query("clean_records", o.CLEAN)
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_records(records(spark, sf_dir))


@_query("pages_without_tags", f"SELECT page_id, {o.tags('html')} AS value FROM pages")
def pages_without_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", text.drop_tags(F.col("html")).alias("value"))


def _found(spark: SparkSession, sf_dir: str, rules: PersonalData = PersonalData()) -> DataFrame:
    return personal_data.with_findings(clean_records(spark, sf_dir), rules)


def _finding_rows(spark: SparkSession, sf_dir: str, rules: PersonalData = PersonalData()) -> DataFrame:
    return personal_data.findings_report(_found(spark, sf_dir, rules)).withColumnRenamed("record_idx", "seq")


def _kind_query(kind: str) -> None:
    only = PersonalData(**{k: k == kind for k in ("mask_leak_name", "phone", "email", "rrn", "account", "address_detail")})
    QUERIES[f"pii_{kind}"] = lambda spark, sf_dir: _finding_rows(spark, sf_dir, only).select("seq", "field", "match")
    ORACLES[f"pii_{kind}"] = o.kind_rows(kind)


for _kind in o.KINDS:
    _kind_query(_kind)


@_query("pii_findings", o.FINDING_ROWS)
def pii_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finding_rows(spark, sf_dir).select("seq", "field", "type", "match")


@_query("pii_spans", f"SELECT seq, field, type, \"match\", true AS stands_there FROM ({o.FINDING_ROWS})")
def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finding's place holds its text."""
    found = _found(spark, sf_dir).select("*", F.explode_outer("_findings").alias("f")).where("f IS NOT NULL")
    own = F.when(F.col("f.field") == "instruction", F.col("instruction")).when(F.col("f.field") == "input", F.col("input")).otherwise(F.col("output"))
    ends = F.split("f.span", "-")
    there = F.substring(own, ends[0].cast("int") + 1, ends[1].cast("int") - ends[0].cast("int"))
    holds = F.when(F.col("f.type") == "mask_leak_name", there.rlike("^▲") & there.rlike("▲$") & F.contains(there, F.col("f.match"))).otherwise(there == F.col("f.match"))
    return found.select("seq", F.col("f.field").alias("field"), F.col("f.type").alias("type"), F.col("f.match").alias("match"), holds.alias("stands_there"))


@_query("pii_type_counts", f'SELECT type, count(*) AS "count" FROM ({o.FINDING_ROWS}) GROUP BY type')
def pii_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.type_counts(_found(spark, sf_dir))


@_query("pii_flag", f"SELECT seq, sum(len(f))::BIGINT AS findings FROM ({o.FINDINGS}) GROUP BY seq")
def pii_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = personal_data.act(_found(spark, sf_dir))
    return flagged.select("seq", F.coalesce(F.size(personal_data.FLAGS), F.lit(0)).cast("long").alias("findings"))


@_query("pii_flag_counts", f"SELECT count(*) AS records, count(*) FILTER (n > 0) AS flagged FROM (SELECT seq, sum(len(f)) AS n FROM ({o.FINDINGS}) GROUP BY seq)")
def pii_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.flagged_count(_found(spark, sf_dir))


@_query("pii_mask", f"SELECT seq, {', '.join(f'{o.masked(c)} AS {c}' for c in o.FIELDS)} FROM ({o.CLEAN})")
def pii_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.act(_found(spark, sf_dir), PersonalData(action="mask")).select("seq", *o.FIELDS)


@_query("pii_drop", f"SELECT seq FROM ({o.FINDINGS}) GROUP BY seq HAVING sum(len(f)) = 0")
def pii_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.act(_found(spark, sf_dir), PersonalData(action="drop")).select("seq")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.with_reason(clean_records(spark, sf_dir))


@_query("filter_reasons", f"SELECT seq, drop_reason FROM ({o.JUDGED})")
def filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("seq", "drop_reason")


@_query("filter_survivors", o.SURVIVORS)
def filter_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.survivors(_judged(spark, sf_dir))


@_query("filter_report", f"SELECT drop_reason, count(*) AS n FROM ({o.JUDGED}) GROUP BY drop_reason")
def filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.report(_judged(spark, sf_dir))


@_query("repetition_ratio", o.repetition_table(o.CLEAN))
def repetition_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_records(spark, sf_dir).select("seq", quality.repetition(F.col("output")).alias("ratio"))


def _histogram_query(name: str, column: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: records(spark, sf_dir).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    ORACLES[name] = o.histogram(column)


for _name, _column in {"eda_task": "task", "eda_task_category": "task_category", "eda_source": "source", "eda_category": "consulting_category"}.items():
    _histogram_query(_name, _column)


@_query("eda_histograms", " UNION ALL ".join(f"SELECT '{c}' AS field, * FROM ({o.histogram(c)})" for c in profiling.CATEGORIES))
def eda_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.histograms(records(spark, sf_dir))


def _stats(kind: str):
    names = {f"{kind}_min": "least", f"{kind}_max": "largest", f"{kind}_sum": "total", f"{kind}_median": "median"}
    return lambda spark, sf_dir: profiling.field_stats(records(spark, sf_dir)).select("field", *(F.col(a).cast("long").alias(b) for a, b in names.items()))


for _kind in ("char", "word"):
    QUERIES[f"eda_{_kind}_stats"] = _stats(_kind)
    ORACLES[f"eda_{_kind}_stats"] = o.sizes(_kind)


@_query("eda_empty", o.EMPTY)
def eda_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.field_stats(records(spark, sf_dir)).select("field", F.col("count").alias("n"), "empty_count")


def _key_query(mode: str) -> None:
    QUERIES[f"dedup_key_{mode}"] = lambda spark, sf_dir: records(spark, sf_dir).select("seq", F.sha2(dedup.key(mode), 256).alias("value"))
    ORACLES[f"dedup_key_{mode}"] = f"SELECT seq, sha256({o.KEYS[mode]}) AS value FROM ({RECORDS})"


for _mode in o.KEYS:
    _key_query(_mode)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    kept = filter_survivors(spark, sf_dir)
    skip = F.col("task").isin(*Dedup().exact_only_tasks)
    return kept.where(~skip), kept.where(skip)


@_query("dedup_exact", f"SELECT seq FROM ({o.EXACT_NORMAL})")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact(_split(spark, sf_dir)[0], "instruction_output").select("seq")


@_query("dedup_exact_skip_task", f"SELECT seq FROM ({o.EXACT_SKIP})")
def dedup_exact_skip_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact(_split(spark, sf_dir)[1], "input_output").select("seq")


@_query("ngrams", o.gram_rows(o.SURVIVORS))
def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_survivors(spark, sf_dir).select("seq", F.explode(similarity.ngrams(dedup.key("instruction_output"), 5)).alias("g"))


def _exact_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written before it is joined with itself, so texts are cleaned and judged once.
    kept = written(_split(spark, sf_dir)[0].select("seq", "instruction", "output"), "survivors")
    return written(dedup.exact(kept, "instruction_output"), "exact")


@_query("minhash_signature", f"SELECT seq, p, v FROM ({o.signature_rows(o.EXACT_NORMAL)})")
def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.signatures(_exact_normal(spark, sf_dir), Dedup()).select("seq", F.posexplode("signature").alias("p", "v"))


@_query("lsh_bands", f"WITH RECURSIVE {o.NEAR} SELECT seq, band, vals AS \"values\" FROM banded")
def lsh_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.band_rows(dedup.signatures(_exact_normal(spark, sf_dir), Dedup()), Dedup()).select("seq", "band", F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("values"))


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows_ = _exact_normal(spark, sf_dir)
    return rows_, written(dedup.candidates(dedup.band_rows(written(dedup.signatures(rows_, Dedup()), "signed"), Dedup())), "near-pairs")


@_query("lsh_candidates", f"WITH RECURSIVE {o.NEAR} SELECT i, j, place.first AS first, place.band AS band FROM cand")
def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)[1]


@_query("jaccard_pairs", f"WITH RECURSIVE {o.NEAR} SELECT i, j, first, band, jaccard FROM edges")
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_, pairs = _candidates(spark, sf_dir)
    return dedup.verified(rows_, pairs, Dedup())


@_query("near_dedup", o.NEAR_KEPT)
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near(_exact_normal(spark, sf_dir), Dedup()).select("seq")


@_query("dedup_routed", f"SELECT branch, seq FROM ({o.ROUTED})")
def dedup_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_survivors(spark, sf_dir).select("seq", "instruction", "input", "output", "task")
    return dedup.routed(written(kept, "survivors")).select(F.col("_branch").alias("branch"), "seq")


@_query("alpaca_rows", f"SELECT seq, instruction, input, output, task, task_category, source, consulting_category FROM ({o.SURVIVORS})")
def alpaca_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filter_survivors(spark, sf_dir)
    return kept.select("seq", *rows.instruction_rows(kept, Output().metadata).columns)


@_query("alpaca_rows_nometa", f"SELECT instruction, input, output FROM ({o.SURVIVORS})")
def alpaca_rows_nometa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.instruction_rows(filter_survivors(spark, sf_dir), False)


@_query("chat_messages", o.CHAT)
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = rows.chat_rows(chat_pairs(spark, sf_dir))
    return m.select(*(F.col("messages")[k]["content"].alias(name) for k, name in enumerate(("system", "user", "assistant"))))


@_query("chat_counts", o.CHAT_COUNTS)
def chat_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.chat_counts(chat_pairs(spark, sf_dir))



@_query("load_flatten", f"SELECT row_number() OVER (ORDER BY file, d, seq) - 1 AS seq, instruction, input, output, task, task_category, source, consulting_category, consulting_content, file_origin FROM (SELECT concat('/', lpad((seq % 7)::VARCHAR, 2, '0'), '/', lpad((seq % 3)::VARCHAR, 2, '0'), '.json') AS file, concat(lpad((seq % 3)::VARCHAR, 2, '0'), '.json') AS file_origin, seq % 5 AS d, * EXCLUDE (file_origin) FROM ({RECORDS}))")
def load_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, written as nested JSON files of several folders and loaded again. A file grows with the input, so it is written in parts of some DOCUMENTS."""
    step = 7 * 3 * 5  # the numbers of a file's documents of one d are as far apart
    rows_ = records(spark, sf_dir).withColumn("file", F.format_string("%02d/%02d", F.col("seq") % 7, F.col("seq") % 3)).withColumn("d", F.col("seq") % 5)
    item = F.struct("seq", "instruction", "input", "output", "task", "task_category", "source", "consulting_category", "consulting_content")
    part = F.struct("d", F.floor(F.col("seq") / (step * DOCUMENTS)).alias("block"))
    files = rows_.groupBy("file", part.alias("part")).agg(F.array_sort(F.collect_list(item)).alias("all"))
    one = F.transform("all", lambda x: F.struct(x["source"].alias("source"), x["consulting_category"].alias("consulting_category"), x["consulting_content"].alias("consulting_content"), F.struct(x["task"].alias("tuning_type"), F.array(F.struct(x["instruction"].alias("instruction"), x["input"].alias("input"), x["output"].alias("output"), x["task_category"].alias("task_category"))).alias("data")).alias("instructions")))
    text_ = files.select(F.concat(F.lit("/"), "file", F.lit(".json")).alias("path"), "part", F.to_json(one).alias("content"))
    # Readers hold a batch of rows, at most a row group: small ones, as a row is a long text.
    nested = written(text_, "nested", **{"parquet.block.size": str(8 << 20)})
    return nested_json.flatten(nested.select("path", "part", F.parse_json("content").alias("j")))


@_query("pipeline_end_to_end", f"SELECT branch, seq, instruction, input, output, task, task_category, source, consulting_category FROM ({o.ROUTED})")
def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prepare(records(spark, sf_dir), Settings()).kept
    return kept.select(F.col("_branch").alias("branch"), "seq", *rows.instruction_rows(kept).columns)


