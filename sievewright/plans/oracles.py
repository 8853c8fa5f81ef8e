"""DuckDB SQL for the registered queries, written apart from the engine's expressions."""

from __future__ import annotations

from ..config import SYSTEM_PROMPT, Dedup, Quality
from ..functions.similarity import PRIME, TOP, bands, coefficients
from .records import PAIRS, RECORDS

#: Unicode blanks, with newline and without.
_WS = r"\s\p{Z}\x{85}\x{0b}"
_INLINE = r"\t\x{0b}\f\r\p{Z}\x{85}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(x: str, pattern: str, by: str = "''", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {by}, '{flags}')"


def stripped(x: str) -> str:
    return replaced(replaced(x, rf"\A[{_WS}]+"), rf"[{_WS}]+\z")


def word_list(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(f'[{_WS}]+')}), lambda w: w <> '')"


def control(x: str) -> str:
    return replaced(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def tags(x: str) -> str:
    return replaced(x, "<[^>]+>", "' '")


def courtesies(x: str) -> str:
    for p, end in (("안녕하세요", ""), ("업무에 고생이 많으십니다", ""), ("평소 시정에 관심을 갖고 건의하여 주심에 감사드립니다", ""), ("감사합니다", r"\z")):
        x = replaced(x, rf"{p}[.{_WS}]*{end}")
    return x


def blanks(x: str) -> str:
    return replaced(replaced(x, f"[{_INLINE}]+", "' '"), r" *\n *", "chr(10)")


def newlines(x: str) -> str:
    return replaced(x, r"\n{3,}", "concat(chr(10), chr(10))")


def numbering(x: str) -> str:
    return replaced(x, rf"(?m)^(\d+)\.[{_WS}]+")


def cleaned(x: str) -> str:
    return stripped(newlines(blanks(courtesies(tags(control(f"nfc_normalize({x})"))))))


FIELDS = ("instruction", "input", "output")
CLEAN = f"SELECT * REPLACE ({', '.join(f'{cleaned(c)} AS {c}' for c in (*FIELDS, 'consulting_content'))}) FROM ({RECORDS})"


# ---- personal data -------------------------------------------------------------------------------
# RE2 has no lookaround, so phone numbers are found between marks that are put around every run of digits.
def _phones(x: str) -> str:
    marked = replaced(x, r"([0-9]+)", r"'‹\1›'")
    hits = f"regexp_extract_all({marked}, {q(rf'‹0[0-9]{{1,2}}(?:›[-.{_WS}]‹)?[0-9]{{3,4}}(?:›[-.{_WS}]‹)?[0-9]{{4}}›')})"
    return f"list_transform({hits}, lambda h: {replaced('h', '[‹›]')})"


_PROVINCES = "서울|부산|대구|인천|광주|대전|울산|세종|경기|강원|충북|충남|전북|전남|경북|경남|제주"
_NS = rf"[^{_WS}]"
_RE = {
    "mask_leak_name": rf"▲+[{_WS}]+[가-힣]{{2,4}}[{_WS}]+▲+",
    "email": r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
    "rrn": rf"[0-9]{{6}}[-{_WS}]?[1-4][0-9]{{6}}",
    "account": rf"[0-9]{{3,6}}[-{_WS}]?[0-9]{{2,6}}[-{_WS}]?[0-9]{{2,6}}[-{_WS}]?[0-9]{{0,6}}",
    "address_detail": rf"(?:{_PROVINCES})(?:특별시|광역시|특별자치시|도|특별자치도)?[{_WS}]*(?:{_NS}+[시군구])[{_WS}]*(?:{_NS}+[동읍면리로길])[{_WS}]*[0-9]+",
}
KINDS = ("mask_leak_name", "phone", "email", "rrn", "account", "address_detail")


def hits(x: str, kind: str) -> str:
    if kind == "phone":
        return _phones(x)
    if kind == "mask_leak_name":
        whole = f"regexp_extract_all({x}, {q(_RE[kind])})"
        return f"list_transform({whole}, lambda h: regexp_extract(h, '[가-힣]+'))"
    return f"regexp_extract_all({x}, {q(_RE[kind])})"


def found(x: str) -> str:
    """A list of (kind, match) in the engine's order."""
    parts = [f"list_transform({hits(x, k)}, lambda m: {{'t': '{k}', 'm': m}})" for k in KINDS]
    return f"flatten([{', '.join(parts)}])"


FINDINGS = " UNION ALL ".join(f"SELECT seq, {i} AS fno, '{c}' AS field, {found(c)} AS f FROM ({CLEAN})" for i, c in enumerate(FIELDS))
FINDING_ROWS = f"SELECT seq, field, u.t AS type, u.m AS \"match\" FROM (SELECT seq, field, unnest(f) AS u FROM ({FINDINGS}))"


def kind_rows(kind: str) -> str:
    return f"SELECT seq, field, \"match\" FROM ({FINDING_ROWS}) WHERE type = '{kind}'"


def masked(x: str) -> str:
    return f"list_reduce(list_transform({found(x)}, lambda f: f.m), lambda acc, m: replace(acc, m, '[PII]'), {x})"


# ---- quality -------------------------------------------------------------------------------------
def repetition_table(table: str) -> str:
    """seq and ratio for every row of a table with seq and output."""
    cut = f"list_filter(list_transform(regexp_split_to_array(output, '[.!?\\n]'), lambda s: {stripped('s')}), lambda s: s <> '')"
    return f"""SELECT r.seq, coalesce(x.ratio, 0.0)::DOUBLE AS ratio FROM ({table}) r LEFT JOIN (
        SELECT seq, CASE WHEN sum(n) <= 1 THEN 0.0 ELSE max(n) / sum(n) END AS ratio FROM (
            SELECT seq, s, count(*) AS n FROM (SELECT seq, unnest({cut}) AS s FROM ({table})) GROUP BY seq, s) GROUP BY seq) x USING (seq)"""


_Q = Quality()
_SHORT = "task IN (" + ", ".join(q(t) for t in _Q.short_answer_tasks) + ")"
JUDGED = f"""
SELECT c.*, CASE
    WHEN instruction = '' OR input = '' OR output = '' THEN 'empty_field'
    WHEN length(instruction) < 5 THEN 'instruction_too_short'
    WHEN length(input) < 20 THEN 'input_too_short'
    WHEN length(output) < CASE WHEN {_SHORT} THEN 1 ELSE 5 END THEN concat('output_too_short(', CASE WHEN {_SHORT} THEN 'qa' ELSE 'default' END, ')')
    WHEN length(input) > 10000 THEN 'input_too_long'
    WHEN length(output) > 5000 THEN 'output_too_long'
    WHEN len({word_list("output")}) < CASE WHEN {_SHORT} THEN 1 ELSE 2 END THEN concat('output_too_few_words(', CASE WHEN {_SHORT} THEN 'qa' ELSE 'default' END, ')')
    WHEN {stripped("input")} = {stripped("output")} THEN 'input_equals_output'
    WHEN r.ratio > 0.5 THEN 'output_too_repetitive' END AS drop_reason
FROM ({CLEAN}) c JOIN ({repetition_table(CLEAN)}) r USING (seq)
"""
SURVIVORS = f"SELECT * EXCLUDE (drop_reason) FROM ({JUDGED}) WHERE drop_reason IS NULL"


# ---- profiles ------------------------------------------------------------------------------------
def sizes(kind: str) -> str:
    size = {"char": lambda c: f"length({c})", "word": lambda c: f"len({word_list(c)})"}[kind]
    union = " UNION ALL ".join(f"SELECT '{c}' AS field, {size(c)} AS n FROM ({RECORDS})" for c in FIELDS)
    return f"SELECT field, min(n) AS least, max(n) AS largest, sum(n)::BIGINT AS total, percentile_disc(0.5) WITHIN GROUP (ORDER BY n DESC) AS median FROM ({union}) GROUP BY field"


EMPTY = "SELECT field, count(*) AS n, count(*) FILTER (x = '') AS empty_count FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS x FROM ({RECORDS})" for c in FIELDS) + ") GROUP BY field"


def histogram(column: str) -> str:
    return f"SELECT {column} AS value, count(*) AS n, min(seq) AS first FROM ({RECORDS}) GROUP BY {column}"


# ---- de-duplication ------------------------------------------------------------------------------
KEYS = {"input": "input", "output": "output", "both": "concat(input, ' ||| ', output)", "instruction_output": "concat(instruction, ' ||| ', output)"}


def first_of(table: str, mode: str) -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sha256({KEYS[mode]}) ORDER BY seq) AS rn FROM ({table})) WHERE rn = 1"


_D = Dedup()
_NORMAL = f"SELECT * FROM ({SURVIVORS}) WHERE task <> '분류'"
_SKIP = f"SELECT * FROM ({SURVIVORS}) WHERE task = '분류'"
EXACT_NORMAL, EXACT_SKIP = first_of(_NORMAL, "instruction_output"), first_of(_SKIP, "both")


def gram_rows(table: str, text: str = KEYS["instruction_output"], n: int = _D.ngram) -> str:
    """seq and every distinct n-gram."""
    w = f"SELECT seq, {text} AS x, {word_list(text)} AS w FROM ({table})"
    return f"""SELECT DISTINCT seq, g FROM (
        SELECT seq, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS g FROM (SELECT seq, w, unnest(range(1, len(w) - {n - 2})) AS i FROM ({w}) WHERE len(w) >= {n})
        UNION ALL SELECT seq, x FROM ({w}) WHERE len(w) < {n})"""


def _hash(g: str) -> str:
    h = f"md5({g})"
    return f"('0x' || substr({h}, 7, 2) || substr({h}, 5, 2) || substr({h}, 3, 2) || substr({h}, 1, 2))::BIGINT"


def signature_rows(table: str, permutations: int = _D.permutations) -> str:
    """seq, p (the permutation, from 0) and its least value."""
    values = ", ".join(f"({p}, {a}::HUGEINT, {b}::HUGEINT)" for p, (a, b) in enumerate(zip(*coefficients(permutations), strict=True)))
    hashed = f"SELECT DISTINCT seq, {_hash('g')}::HUGEINT AS h FROM ({gram_rows(table)})"
    return f"SELECT seq, p, min(((a * h + b) % {PRIME}::HUGEINT) & {TOP}::HUGEINT)::BIGINT AS v FROM ({hashed}), (VALUES {values}) AS k(p, a, b) GROUP BY seq, p"


_BANDS, _ROWS = bands(_D.permutations, _D.threshold)
#: Common tables that lead from exact survivors to the records that near de-duplication removes.
NEAR = f"""
base AS MATERIALIZED ({EXACT_NORMAL}),
sigs AS MATERIALIZED ({signature_rows("SELECT * FROM base")}),
banded AS MATERIALIZED (SELECT seq, (p // {_ROWS})::INT AS band, string_agg(v::VARCHAR, ',' ORDER BY p) AS vals FROM sigs GROUP BY seq, p // {_ROWS}),
buckets AS (SELECT *, min(seq) OVER (PARTITION BY band, vals) AS first FROM banded),
cand AS MATERIALIZED (SELECT a.seq AS i, b.seq AS j, min({{'first': a.first, 'band': a.band}}) AS place FROM buckets a JOIN buckets b ON a.band = b.band AND a.vals = b.vals AND a.seq < b.seq GROUP BY 1, 2),
grams AS MATERIALIZED ({gram_rows("SELECT * FROM base")}),
sized AS (SELECT seq, count(*) AS n FROM grams GROUP BY seq),
shared AS (SELECT i, j, count(*) AS both FROM cand JOIN grams a ON a.seq = i JOIN grams b ON b.seq = j AND a.g = b.g GROUP BY i, j),
edges AS MATERIALIZED (
    SELECT c.i, c.j, c.place.first AS first, c.place.band AS band, s.both / (x.n + y.n - s.both) AS jaccard, row_number() OVER (ORDER BY c.place.first, c.place.band, c.i, c.j) AS k
    FROM cand c JOIN shared s USING (i, j) JOIN sized x ON x.seq = c.i JOIN sized y ON y.seq = c.j WHERE s.both / (x.n + y.n - s.both) >= {_D.threshold}),
visit(k, gone) AS (
    SELECT 0::BIGINT, []::BIGINT[]
    UNION ALL
    SELECT e.k, CASE WHEN list_contains(v.gone, e.i) OR list_contains(v.gone, e.j) THEN v.gone ELSE list_append(v.gone, e.j) END FROM visit v JOIN edges e ON e.k = v.k + 1),
gone AS (SELECT unnest(gone) AS seq FROM (SELECT gone FROM visit ORDER BY k DESC LIMIT 1))
"""
NEAR_KEPT = f"WITH RECURSIVE {NEAR} SELECT seq FROM base WHERE seq NOT IN (SELECT seq FROM gone)"
ROUTED = f"WITH RECURSIVE {NEAR} SELECT 0 AS branch, * FROM base WHERE seq NOT IN (SELECT seq FROM gone) UNION ALL SELECT 1, * FROM ({EXACT_SKIP})"

# ---- chat ----------------------------------------------------------------------------------------
_A, _B, _C = (stripped(c) for c in FIELDS)
_OK = f"coalesce({_A} <> '' AND {_B} <> '' AND {_C} <> '', false)"
CHAT = f"SELECT {q(SYSTEM_PROMPT)} AS system, concat('지시: ', {_A}, chr(10), chr(10), '입력:', chr(10), {_B}) AS \"user\", {_C} AS assistant FROM ({PAIRS}) WHERE {_OK}"
CHAT_COUNTS = f"SELECT count(*) AS total, count(*) FILTER ({_OK}) AS converted, count(*) FILTER (NOT {_OK}) AS skipped FROM ({PAIRS})"
