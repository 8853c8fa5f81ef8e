"""Text cleaning as Column expressions. Blanks are Unicode blanks, so patterns carry (?U)."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Cleaning


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, which is derived once however often f reads it."""
    return F.transform(F.array(x), f)[0]


#: What \s means with (?U).
BLANKS = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANKS))


def words(x: Column) -> Column:
    return F.filter(F.split(x, r"(?U)\s+"), lambda t: t != "")


def word_count(x: Column) -> Column:
    return F.size(words(x))


def has_words(x: Column, least: int) -> Column:
    """Whether word_count() is at least that; no text is read beyond."""
    return x.rlike(rf"(?U)\A\s*+(?:\S++\s++){{{least - 1}}}\S") if least > 0 else F.lit(True)


def nfc(x: Column) -> Column:
    """Canonical composition, by the ICU library that Spark brings along."""
    composed = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False))
    return F.when(x.isNotNull(), composed)


def drop_control(x: Column) -> Column:
    """Deletes control characters but TAB, LF and CR."""
    return F.regexp_replace(x, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def drop_tags(x: Column) -> Column:
    return bound(x, lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, r"<[^>]+>", " ")).otherwise(t))


def _where(sign: str, f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """f of the texts that hold sign; others stay."""
    return lambda t: F.when(F.contains(t, F.lit(sign)), f(t)).otherwise(t)


def drop_courtesies(x: Column, patterns: tuple[str, ...]) -> Column:
    """Deletes the patterns one after the other. Where a pattern is words before a class and an end, a plain search for the words goes first."""
    for pattern in patterns:
        literal = re.fullmatch(r"([^\\\[\](){}.*+?^$|]+)(?:\[[^\[\]^&]*\]\*)?\$?", pattern)

        without = partial(F.regexp_replace, pattern=f"(?U){pattern}", replacement="")
        x = bound(x, _where(literal[1], without)) if literal else without(x)
    return x


#: Without any of these, runs of blanks are single spaces.
_ODD = ("  ", *"\t\r\x0b\x0c")
_WIDE_ODD = tuple("\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(map(chr, range(0x2000, 0x200B)))


def _any_of(x: Column, signs: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(x, F.lit(sign)) for sign in signs))


def squeeze_blanks(x: Column) -> Column:
    """Runs of blanks but newlines become one space, none stays beside a newline. A plain search finds the texts to which that applies."""

    def runs(t: Column) -> Column:
        wide = (F.octet_length(t) != F.length(t)) & _any_of(t, _WIDE_ODD)
        every = F.when(wide, F.regexp_replace(t, r"(?U)[^\S\n]+", " "))
        # Without wide blanks a short class is enough, and a lone space is no match, so that most of a text is passed over.
        return every.when(_any_of(t, _ODD), F.regexp_replace(t, r"[\t\x0B\f\r][ \t\x0B\f\r]*| [ \t\x0B\f\r]+", " ")).otherwise(t)

    def beside(t: Column) -> Column:
        return F.when(_any_of(t, (" \n", "\n ")), F.regexp_replace(t, r" +\n *|\n +", "\n")).otherwise(t)

    return bound(bound(x, runs), beside)


def squeeze_newlines(x: Column, most: int) -> Column:
    if most <= 0:
        return x
    return bound(x, lambda t: F.when(F.contains(t, F.lit("\n" * (most + 1))), F.regexp_replace(t, rf"\n{{{most + 1},}}", "\n" * most)).otherwise(t))


def drop_numbering(x: Column) -> Column:
    """Deletes '12. ' where lines (ended by LF alone) start."""
    return F.regexp_replace(x, r"(?Umd)^(\d+)\.\s+", "")


def clean(x: Column, rules: Cleaning) -> Column:
    """All steps in their order; null stays null, the empty text empty."""
    if rules.normalize_unicode:
        x = nfc(x)
    if rules.remove_control_chars:
        x = drop_control(x)
    if rules.strip_html_tags:
        x = drop_tags(x)
    if rules.remove_courtesies:
        x = drop_courtesies(x, rules.courtesies)
    if rules.normalize_whitespace:
        x = squeeze_blanks(x)
    x = squeeze_newlines(x, rules.most_newlines)
    if rules.strip_leading_numbering:
        x = drop_numbering(x)
    return strip(x)
