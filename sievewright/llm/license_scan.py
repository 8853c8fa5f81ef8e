"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block (WINDOW words on end of the whole text; line ends do not cut it) matches a
template if it holds at least THRESHOLD of the template's distinct tokens. Blocks
start at every word that templates know: any other block that matches holds no more
than the one from its first such word. Tokens are ordered by the
number of documents they occur in, rarest first. A match must share one of the
template's first tokens in that order (prefix filter), hold enough tokens
(length filter) and have enough tokens left behind the first shared one
(positional filter); what passes is counted exactly. Where the threshold alone
can't tell two templates apart (rivals), a match also holds a token that the rival lacks. The templates are a short
fixed list, so they travel as a literal and each text is joined where it is:
no text is dealt out, and a hot source or passage meets no single task. Only
DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER

THRESHOLD = 0.8
#: Words of a block.
WINDOW = 48

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Wording of licence notices (fewer than WINDOW words each) and their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc0": "To the extent possible under law, the author has waived all copyright and related rights",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

#: Bytes between words, for texts whose capitals are still there.
_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def _words(text: Column) -> Column:
    low = F.translate(text, UPPER, LOWER)
    return F.filter(F.split(low, rf"[{_GAP}]+"), lambda w: w != "")


def tokens(text: str) -> list[str]:
    """A template's distinct tokens."""
    import re

    return list(dict.fromkeys(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())))


def marks(label: str, templates: dict[str, str]) -> list[list[str]]:
    """For each rival of a template (one that holds enough of its tokens to be taken for it): the tokens that the rival lacks."""
    own = tokens(templates[label])
    other = [set(tokens(wording)) for name, wording in templates.items() if name != label]
    lacking = [[t for t in own if t not in x] for x in other if sum(t in x for t in own) >= _need(len(own))]
    return [x for x in lacking if x]


def _need(size: int) -> int:
    """The fewest of size tokens that reach the threshold."""
    return math.ceil(THRESHOLD * size - 1e-9)


def token_order(docs: DataFrame, templates: dict[str, str]) -> list[str]:
    """The templates' tokens, by the number of documents of docs that hold them, rarest first.

    All texts are counted; what comes to the driver is one number for each token of the templates.
    """
    vocabulary = sorted({t for text in templates.values() for t in tokens(text)})
    literal = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(F.split(F.lower("text"), rf"[{_GAP}]+"), literal)).alias("t")).groupBy("t").count()
    count = {r[0]: r[1] for r in found.collect()}
    return sorted(vocabulary, key=lambda t: (count.get(t, 0), t))


def _either(words: list[str]) -> str:
    return rf"(?i)(?<![^{_GAP}])(?:{'|'.join(words)})(?![^{_GAP}])"


def _phrase(words: str) -> str:
    return _either([rf"[{_GAP}]+".join(words.split())])


def template_matches(text: Column, order: list[str], templates: dict[str, str]) -> Column:
    """An array of (label, held) of all templates that some block of text matches; held: the share of its tokens."""
    rank = {t: i for i, t in enumerate(order)}
    rows, prefixes, least = [], set(), WINDOW
    for label, wording in templates.items():
        ordered = sorted(tokens(wording), key=rank.__getitem__)
        need = _need(len(ordered))
        prefix = ordered[: len(ordered) - need + 1]
        prefixes |= set(prefix)
        least = min(least, need)
        literal = (F.lit(label).alias("label"), F.array(*map(F.lit, ordered)).alias("tokens"), F.array(*map(F.lit, prefix)).alias("prefix"), F.lit(need).alias("need"))
        rivals = [F.array(*map(F.lit, m)) for m in marks(label, templates)]
        literal += ((F.array(*rivals) if rivals else F.array().cast("array<array<string>>")).alias("marks"),)
        rows.append(F.struct(*literal))
    index, vocabulary = F.array(*rows), F.array(*map(F.lit, order))
    rare = F.array(*map(F.lit, sorted(prefixes)))

    def known(words: Column) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda k: F.array_contains(vocabulary, k["w"]))

    def blocks(spots: Column, rares: Column) -> Column:
        # The known tokens of the block from each known word on, if one of them is in a prefix.
        def block(k: Column, j: Column) -> Column:
            held = F.filter(F.slice(spots, j + 1, WINDOW), lambda x: x["i"] < k["i"] + WINDOW)
            return F.when(F.exists(rares, lambda p: (p >= k["i"]) & (p < k["i"] + WINDOW)), F.array_distinct(F.transform(held, lambda x: x["w"])))

        return F.array_distinct(F.filter(F.transform(spots, block), lambda x: x.isNotNull() & (F.size(x) >= least)))

    def within(spots: Column) -> Column:
        rares = F.transform(F.filter(spots, lambda k: F.array_contains(rare, k["w"])), lambda k: k["i"])
        return F.transform(F.array(rares), lambda p: blocks(spots, p))[0]

    def joined(block: Column) -> Column:
        # The block's tokens in the global order.
        ordered = F.filter(vocabulary, lambda v: F.array_contains(block, v))
        pair = F.transform(F.array(ordered), lambda k: F.filter(index, lambda t: _may(k, F.size(block), t)))
        told = F.filter(pair[0], lambda t: F.forall(t["marks"], lambda m: F.arrays_overlap(m, block)))
        exact = F.transform(told, lambda t: F.struct(t["label"].alias("label"), F.size(F.array_intersect(block, t["tokens"])).alias("n"), F.size(t["tokens"]).alias("all"), t["need"].alias("need")))
        return F.transform(F.filter(exact, lambda t: t["n"] >= t["need"]), lambda t: F.struct(t["label"].alias("label"), (t["n"] / t["all"]).alias("held")))

    found = F.flatten(F.transform(F.transform(F.array(known(_words(text))), within)[0], joined))
    none = F.array().cast("array<struct<label:string,held:double>>")
    return F.when(text.rlike(_either(sorted(prefixes))), found).otherwise(none)


def _may(known: Column, length: Column, t: Column) -> Column:
    """Whether a block may match t, by its known tokens in order and their number."""
    first = F.get(F.array_intersect(t["prefix"], known), F.lit(0))
    behind = F.least(F.size(t["tokens"]) - F.array_position(t["tokens"], first), F.size(known) - F.array_position(known, first))
    return first.isNotNull() & (length >= t["need"]) & (behind + 1 >= t["need"])


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """For every row of docs (doc_id, text): n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null or empty text: no words, empty label strings, score 0, null places.
    Score is the largest share of a template held by one block, among matches, and
    1 where a phrase stands whole. Repeated rows give repeated results; other
    columns are left out.
    """
    templates = templates or TEMPLATES
    if long := [label for label, wording in templates.items() if len(tokens(wording)) > WINDOW]:
        raise ValueError(f"templates of more tokens than a block has words: {long}")
    order = token_order(docs, templates)
    text = F.coalesce("text", F.lit(""))
    count = lambda piece: F.regexp_count(piece, F.lit(rf"[^{_GAP}]+"))
    rows = docs.select("doc_id", text.alias("text"), count(text).cast("long").alias("n_words"))
    rows = rows.select("*", *(F.when(F.col("text").rlike(_phrase(p)), F.split("text", _phrase(p), -1)).alias(f"p{i}") for i, p in enumerate(PHRASES)), template_matches(F.col("text"), order, templates).alias("found"))
    n, first, last, base = F.lit(0), [], [], []
    for i, (phrase, label) in enumerate(PHRASES.items()):
        pieces = F.col(f"p{i}")
        there = pieces.isNotNull()
        n = n + F.when(there, F.size(pieces) - 1).otherwise(0)
        first.append(F.when(there, count(pieces[0])))
        last.append(F.when(there, F.col("n_words") - len(phrase.split()) - count(F.element_at(pieces, -1))))
        base.append(F.when(there, F.lit(label)))
    base_labels = F.array_sort(F.array_compact(F.array(*base)))
    labels = F.array_sort(F.array_union(base_labels, F.transform("found", lambda m: m["label"])))
    best = F.greatest(F.coalesce(F.array_max(F.transform("found", lambda m: m["held"])), F.lit(0.0)), F.when(n > 0, 1.0).otherwise(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        n.cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"),
        F.greatest(*last).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        best.alias("score"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license notices of all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """Every block of every text against every template, in DuckDB SQL."""
    values = ", ".join(f"('{label}', {tokens(wording)!r}, {_need(len(tokens(wording)))}, {marks(label, TEMPLATES)!r}::VARCHAR[][])" for label, wording in TEMPLATES.items())
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def at(phrase: str) -> str:
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split(), 1))
        return f"list_filter(range(len(w)), lambda i: {same})"

    vocabulary = sorted({t for wording in TEMPLATES.values() for t in tokens(wording)})
    split = lambda text: f"list_filter(regexp_split_to_array(translate({text}, '{UPPER}', '{LOWER}'), '{gap}'), lambda x: x <> '')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, doc_id, {split("t")} AS w FROM docs),
base AS (SELECT rid, doc_id, len(w) AS n_words, {", ".join(f"{at(p)} AS p{i}" for i, p in enumerate(PHRASES))} FROM words),
known AS (SELECT {vocabulary!r} AS k),
starts AS (SELECT rid, w, unnest(list_filter(range(len(w)), lambda i: list_contains(k, w[i + 1]))) AS i FROM words, known),
blocks AS (SELECT DISTINCT rid, list_intersect(list_slice(w, i + 1, i + {WINDOW}), k) AS b FROM starts, known),
templates(label, tokens, need, marks) AS (VALUES {values}),
held AS (SELECT rid, label, max(len(list_intersect(b, tokens)) / len(tokens)) AS held FROM blocks, templates WHERE len(list_intersect(b, tokens)) >= need AND len(list_filter(marks, lambda m: NOT list_has_any(b, m))) = 0 GROUP BY rid, label),
found AS (SELECT rid, list(label) AS labels, max(held) AS held FROM held GROUP BY rid),
named AS (
    SELECT base.*, list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(PHRASES.values()))}], lambda x: x IS NOT NULL) AS bl, flatten([{", ".join(f"p{i}" for i in range(len(PHRASES)))}]) AS places
    FROM base
)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
    array_to_string(list_sort(bl), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(bl, coalesce(found.labels, [])))), ',') AS labels,
    greatest(coalesce(found.held, 0.0), CASE WHEN len(places) > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM named LEFT JOIN found USING (rid)
"""
