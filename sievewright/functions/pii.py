"""Personal data: findings with their places, as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PersonalData
from .text import bound

# The patterns by type, in the order of detection. (?U): digits and blanks are Unicode's.
PATTERNS = {
    "mask_leak_name": r"(?U)▲+\s+([가-힣]{2,4})\s+▲+",
    "phone": r"(?U)(?<!\d)(0\d{1,2})[-.\s]?(\d{3,4})[-.\s]?(\d{4})(?!\d)",
    "email": r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
    "rrn": r"(?U)\d{6}[-\s]?[1-4]\d{6}",
    "account": r"(?U)\d{3,6}[-\s]?\d{2,6}[-\s]?\d{2,6}[-\s]?\d{0,6}",
    "address_detail": r"(?U)(?:서울|부산|대구|인천|광주|대전|울산|세종|경기|강원|충북|충남|전북|전남|경북|경남|제주)(?:특별시|광역시|특별자치시|도|특별자치도)?\s*(?:\S+[시군구])\s*(?:\S+[동읍면리로길])\s*\d+",
}
#: The part of a match that is the finding, where it isn't the whole.
GROUPS = {"mask_leak_name": 1}
#: Characters of which every match holds one: texts without them are passed over at the cost of a plain search.
SIGNS = {"mask_leak_name": "▲", "email": "@", "address_detail": "시군구"}
#: Types whose every match holds three digits in a row: one search rules all of them out.
DIGITS = ("phone", "rrn", "account")
FINDING = "struct<type:string,match:string,span:string>"


def _none() -> Column:
    return F.array().cast(f"array<{FINDING}>")


def findings_of(x: Column, kind: str) -> Column:
    """Findings of one type, from left to right, none over another.

    What stands between the matches (split) and the matches themselves give every
    place: a match starts behind all pieces before it and all matches before it.
    """
    pattern = PATTERNS[kind]
    hits = F.regexp_extract_all(x, F.lit(pattern), F.lit(0))
    named = F.regexp_extract_all(x, F.lit(pattern), F.lit(GROUPS[kind])) if kind in GROUPS else hits
    gaps = F.split(x, pattern, -1)
    zipped = F.arrays_zip(hits.alias("hit"), named.alias("name"), F.slice(gaps, 1, F.greatest(F.size(hits), F.lit(1))).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), _none().alias("out"))

    def step(state: Column, z: Column) -> Column:
        begin = state["at"] + F.length(z["gap"])
        end = begin + F.length(z["hit"])
        found = F.struct(F.lit(kind).alias("type"), z["name"].alias("match"), F.concat_ws("-", begin.cast("string"), end.cast("string")).alias("span"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    there = x.rlike(pattern)
    if kind in SIGNS:
        there = reduce(or_, (F.contains(x, F.lit(sign)) for sign in SIGNS[kind])) & there
    return F.when(there, F.aggregate(zipped, start, step, lambda s: s["out"])).otherwise(_none())


def findings(x: Column, rules: PersonalData) -> Column:
    """All findings of a text, type after type; types may overlap. Null and empty texts have none."""
    kinds = [kind for kind in PATTERNS if getattr(rules, kind)]

    def of(digits: Column) -> Column:
        return F.concat(*(F.when(digits, findings_of(x, kind)).otherwise(_none()) if kind in DIGITS else findings_of(x, kind) for kind in kinds))

    return bound(x.rlike(r"(?U)\d{3}"), of) if kinds else _none()


def masked(x: Column, found: Column, token: str) -> Column:
    """x with the text of every finding, in turn, replaced wherever it stands."""
    return F.aggregate(found, x, lambda text, f: F.replace(text, f["match"], F.lit(token)))

