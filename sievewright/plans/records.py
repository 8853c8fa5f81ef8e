"""Instruction records made from the driver's tables, by SQL that Spark and DuckDB read alike.

The tables' texts hold little of what the engine looks for, so records are
decorated by their number: courtesies, markup, blanks, control characters,
decomposed letters, personal data, short, empty, repeated and copied outputs.
Every fifth record has a near copy with an output of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPACE, _NBSP, _JAMO = "　", " ", "한"

_BASE = f"""
SELECT doc_id AS seq,
    CASE WHEN doc_id % 19 = 0 THEN 'Go' ELSE concat('Summarise item from ', coalesce(source, '')) END AS instruction,
    concat(
        CASE WHEN doc_id % 2 = 0 THEN '안녕하세요. ' ELSE '' END,
        CASE WHEN doc_id % 3 = 0 THEN '<b>' ELSE '' END, coalesce(text, ''), CASE WHEN doc_id % 3 = 0 THEN '</b>' ELSE '' END,
        CASE WHEN doc_id % 4 = 0 THEN concat(chr(9), chr(9), ' ', chr(13), chr(10), chr(10), chr(10), chr(10), 'x') ELSE '' END,
        CASE WHEN doc_id % 5 = 0 THEN '{_SPACE}y{_NBSP}{_SPACE}' ELSE '' END,
        CASE WHEN doc_id % 6 = 0 THEN concat('a', chr(7), 'b {_JAMO}') ELSE '' END,
        CASE WHEN doc_id % 7 = 0 THEN concat(' 010-1234-', lpad(cast(doc_id % 10000 AS varchar(9)), 4, '0')) ELSE '' END,
        CASE WHEN doc_id % 8 = 0 THEN ' 900101-1234567 ' ELSE '' END,
        CASE WHEN doc_id % 9 = 0 THEN ' ▲▲ 홍길동 ▲▲ 김철수 ▲' ELSE '' END,
        CASE WHEN doc_id % 10 = 0 THEN ' 서울특별시 강남구 테헤란로 123 ' ELSE '' END,
        CASE WHEN doc_id % 11 = 0 THEN concat(chr(10), '12. a.b', cast(doc_id AS varchar(19)), '@c.co') ELSE '' END,
        CASE WHEN doc_id % 4 = 1 THEN ' 감사합니다. ' ELSE '' END
    ) AS input,
    text, source, lang
FROM documents
"""

_FIRST = f"""
SELECT b.seq, b.instruction, b.input,
    CASE WHEN b.seq % 7 = 0 THEN concat(' ', b.input)
        WHEN b.seq % 11 = 0 THEN ''
        WHEN b.seq % 13 = 0 THEN 'Same again. Same again! Other. Same again.'
        WHEN b.seq % 17 = 0 THEN 'yes'
        WHEN b.seq % 23 = 0 THEN 'oneword'
        WHEN b.seq % 29 = 0 THEN b.text
        ELSE coalesce(b.text, '') END AS output,
    CASE b.seq % 3 WHEN 0 THEN '요약' WHEN 1 THEN '질의응답' ELSE '분류' END AS task,
    coalesce(b.lang, '') AS task_category, coalesce(b.source, '') AS source,
    CASE WHEN l.q IS NULL THEN '' ELSE concat('quality ', cast(l.q AS varchar(9))) END AS consulting_category,
    concat('  call ', cast(b.seq AS varchar(19)), '  ') AS consulting_content, 'documents' AS file_origin
FROM ({_BASE}) b LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) l ON b.seq = l.doc_id
"""

RECORDS = f"""
SELECT seq, instruction, input, coalesce(output, '') AS output, task, task_category, source, consulting_category, consulting_content, file_origin FROM ({_FIRST}) f
UNION ALL
SELECT seq + 1000000000, instruction, input, concat(coalesce(output, ''), CASE WHEN seq % 10 = 0 THEN ' etc' ELSE ' and so on it went' END), task, task_category, source, consulting_category, consulting_content, 'copies'
FROM ({_FIRST}) g WHERE seq % 5 = 0
"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")}
    text = RECORDS
    for t in tables:
        text = text.replace(f"FROM {t}\n", f"FROM {{{t}}}\n").replace(f"FROM {t} ", f"FROM {{{t}}} ")
    return spark.sql(text, **tables)


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows from conversations: what a user says and the assistant's next turn."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return spark.sql(PAIRS.replace("FROM conversations ", "FROM {conversations} ").replace("JOIN conversations ", "JOIN {conversations} "), conversations=turns)


PAIRS = """
SELECT u.conv_id, u.turn, concat('  turn ', cast(u.turn AS varchar(19)), ' ') AS instruction, u.text AS input, a.text AS output
FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND u.turn + 1 = a.turn AND u.role = 'user' AND a.role = 'assistant'
"""
