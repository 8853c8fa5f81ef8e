import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.config import Cleaning
from sievewright.functions import text

VECTORS = [
    ("안녕하세요. <b>문의</b>\t드립니다.\r\n\r\n\r\n\r\n감사합니다. ", "문의 드립니다."),
    ("감사합니다. 확인했습니다.", "감사합니다. 확인했습니다."),
    ("5 < 6 그리고 7 > 3", "5 3"),
    ("가　 나", "가 나"),
    ("a\n\n\n\nb", "a\n\nb"),
    ("a\u0007b", "ab"),
    ("한", "한"),
    ("1. 첫째\n2. 둘째", "1. 첫째\n2. 둘째"),
    ("", ""),
    ("a\r\nb", "a\nb"),
    (None, None),
]


def values(spark, build, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.v for r in df.select("i", build(F.col("x")).alias("v")).orderBy("i").collect()]


def test_cleaning_vectors(spark):
    assert values(spark, lambda x: text.clean(x, Cleaning()), [a for a, _ in VECTORS]) == [b for _, b in VECTORS]


def test_numbering_when_asked_for(spark):
    rules = Cleaning(strip_leading_numbering=True)
    assert values(spark, lambda x: text.clean(x, rules), ["1. 첫째\n2. 둘째", "x 1. y", "12.y\n3.   z"]) == ["첫째\n둘째", "x 1. y", "12.y\nz"]


def test_steps_can_be_left_out(spark):
    none = Cleaning(False, False, False, False, (), False, 0, False)
    assert values(spark, lambda x: text.clean(x, none), [" a\u0007 <b>\n\n\n\n안녕하세요 "]) == ["a\u0007 <b>\n\n\n\n안녕하세요"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=30), min_size=20, max_size=40))
def test_unicode_steps_equal_pythons(spark, texts):
    texts = [t.replace("\x1c", "").replace("\x1d", "").replace("\x1e", "").replace("\x1f", "").replace("\x00", "") for t in texts]
    assert values(spark, text.nfc, texts) == [unicodedata.normalize("NFC", t) for t in texts]
    assert values(spark, text.strip, texts) == [t.strip() for t in texts]
    assert values(spark, text.words, texts) == [t.split() for t in texts]
    assert values(spark, text.word_count, texts) == [len(t.split()) for t in texts]


@pytest.mark.parametrize("most, given_, want", [(2, "a\n\n\nb", "a\n\nb"), (1, "a\n\nb", "a\nb"), (0, "a\n\n\n\nb", "a\n\n\n\nb")])
def test_newlines(spark, most, given_, want):
    assert values(spark, lambda x: text.squeeze_newlines(x, most), [given_]) == [want]


def test_searches_before_patterns_change_nothing(spark):
    """Every blank and many others, at an end, inside and beside newlines, against the bare patterns."""
    from sievewright.functions import quality

    chars = [chr(c) for c in (*range(1, 0x180), 0x1680, 0x180E, *range(0x1FF0, 0x2070), 0x3000, 0xAC00, 0x1F600)]
    texts = [t for c in chars for t in (c, c + "a b", "a b" + c, f"a{c}b", f"a {c}b\n {c}c.{c}c", f"a\n{c}b\n\n\n\nd < {c}e> f")] + ["", "a b c d e", "x " * 500]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    x = F.col("x")
    blanks = F.regexp_replace(F.regexp_replace(x, r"(?U)[^\S\n]+", " "), r" *\n *", "\n")
    pairs = [(text.strip(x), F.regexp_replace(x, r"(?U)\A\s+|\s+\z", "")), (text.squeeze_blanks(x), blanks), (text.squeeze_newlines(x, 2), F.regexp_replace(x, r"\n{3,}", "\n\n")), (text.drop_tags(x), F.regexp_replace(x, r"<[^>]+>", " "))]
    pairs += [(text.has_words(x, k), text.word_count(x) >= k) for k in range(5)]
    cut = F.filter(F.transform(F.split(x, r"[.!?\n]"), lambda s: F.regexp_replace(s, r"(?U)\A\s+|\s+\z", "")), lambda s: s != "")
    once = F.array_max(F.transform(cut, lambda s: F.size(F.filter(cut, lambda t: t == s)))) / F.size(cut)
    pairs.append((quality.repetition(x), F.when(F.size(cut) > 1, once).otherwise(0.0)))
    for k, (got, want) in enumerate(pairs):
        assert df.where(~got.eqNullSafe(want)).count() == 0, k


def test_courtesies_after_a_plain_search(spark):
    """The search for a pattern's words takes nothing from the pattern; patterns of other forms are used as they are."""
    from sievewright.config import COURTESIES

    patterns = (*COURTESIES, "ab?", "x|y", "q[.]", "end$", "a{2}", r"\d+", "w[^z]*")
    texts = ["", "안녕하세요", "a 안녕하세요. 　. b 안녕하세요!", "감사합니다. x", "x 감사합니다.\n", "감사합니다 감사합니다.", "a b ab", "only y", "q. q", "end end", "baab", "12 w34z", "업무에 고생이 많으십니다..안녕하세요"]
    for pattern in patterns:
        assert values(spark, lambda x, p=pattern: text.drop_courtesies(x, (p,)), texts) == values(spark, lambda x, p=pattern: F.regexp_replace(x, f"(?U){p}", ""), texts)


def test_blanks_that_are_single_spaces_are_no_matches(spark):
    """Runs of every mix of two and three blanks, against the bare pattern."""
    from itertools import product

    texts = [f"a b{''.join(run)}c d{''.join(run)}" for n in (1, 2, 3) for run in product(" \n\t\r\xa0　\x1c", repeat=n)]
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)[^\S\n]+", " "), r" *\n *", "\n")
    assert values(spark, text.squeeze_blanks, texts) == values(spark, bare, texts)
    assert values(spark, text.strip, texts) == values(spark, lambda x: F.regexp_replace(x, r"(?U)\A\s+|\s+\z", ""), texts)
    assert set(text.BLANKS) == {chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()} - set("\x1c\x1d\x1e\x1f")
