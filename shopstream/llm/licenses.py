"""Licence scans by a positional rare-token index (operator 10, native).

Licence templates are short word sequences, each with a mandatory key phrase.
How rare a template word is in all documents is counted first; each template
is then indexed under the two rarest words of its key phrase, with their
relative positions.  A document's licence words give possible starts of a
template; starts on which both words agree are verified against the key
phrase and scored by the share of the template's rarity found there.

DataFrame functions only; every document is treated in its own row, so
nothing but the word counts of the templates is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_struct

#: Phrases and labels that every scan reports (fixed values of the contract).
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Label, template, mandatory key phrase within it: well-known licence wording.
TEMPLATES = (
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under cc by", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    ("epl", "eclipse public license version 2 0", "eclipse public license"),
    ("gpl", "licensed under the gnu general public license version 3", "general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     "permission to use copy modify"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mpl", "mozilla public license version 2 0", "mozilla public license"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"           # of lower-cased text
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lit(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _words_sql(text: str) -> str:
    pattern = WORD.replace("\\", "\\\\")
    return f"regexp_extract_all({text}, '({pattern})', 1)"


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, t, _ in templates for w in t.split()})


def word_rarity(docs: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each template word over all of ``docs``."""
    words = vocabulary(templates)
    found = (docs.select(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("low"))
             .select(F.expr(f"explode(concat(array(''), array_intersect({_lit(words)}, {_words_sql('low')})))").alias("word"))
             .groupBy("word").agg(F.count("*").alias("n")))
    n = {r.word: r.n for r in found.collect()}      # one row per template word at most
    return {w: math.log((1 + n.get("", 0)) / (1 + n.get(w, 0))) + 1 for w in words}


def _index(rarity: dict[str, float], templates) -> list[dict]:
    """Each template with the two rarest words of its key phrase."""
    out = []
    for label, template, key in templates:
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        rare = sorted(range(at, at + len(k)), key=lambda i: (-rarity[t[i]], t[i], i))
        first, second = rare[0], rare[min(1, len(rare) - 1)]
        total = sum(rarity[w] for w in t)
        out.append({"label": label, "words": t, "key": k, "key_at": at, "first": (t[first], first),
                    "second": (t[second], second), "weights": [rarity[w] / total for w in t]})
    return out


def _template_sql(t: dict) -> str:
    return ("named_struct('label', '{label}', 'w1', '{w1}', 'o1', {o1}, 'w2', '{w2}', 'o2', {o2}, 'key', {key}, "
            "'key_at', {key_at}, 'words', {words}, 'weights', array({weights}))").format(
        label=t["label"], w1=t["first"][0], o1=t["first"][1], w2=t["second"][0], o2=t["second"][1],
        key=_lit(t["key"]), key_at=t["key_at"], words=_lit(t["words"]),
        weights=", ".join(f"{w!r}D" for w in t["weights"]))


def scan(docs: DataFrame, rarity: dict[str, float] | None = None, templates=TEMPLATES) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, with n_words, base (the
    places of the BASE phrases: label, start), found (verified templates:
    label, start, score; a start may lie before the text if it begins inside a
    template), base_labels, labels and score (the largest of found, else 0).

    Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters.
    A null or empty text has no words and no labels.  Repeated rows are
    answered each; an empty table gives no rows.
    """
    if rarity is None:
        rarity = word_rarity(docs, templates)
    index = _index(rarity, templates)
    base = [(p.split(), label) for p, label in BASE]
    # a document is looked at word by word only if it holds one of these
    rare = sorted({t["first"][0] for t in index} | {max(p, key=len) for p, _ in base})
    wanted = sorted({w for t in index for w, _ in (t["first"], t["second"])} | {p[0] for p, _ in base})
    wanted_sql = ", ".join(f"'{w}'" for w in wanted)
    base_sql = "array(" + ", ".join(f"named_struct('label', '{label}', 'words', {_lit(p)})" for p, label in base) + ")"
    templates_sql = "array(" + ", ".join(_template_sql(t) for t in index) + ")"
    same = lambda at, key: f"if({at} >= 0, slice(words, {at} + 1, size({key})) = {key}, false)"
    starts = lambda w, o: f"transform(filter(hits, h -> h.w = {w}), h -> h.i - {o})"
    return (as_struct(docs)
            .withColumn("n_words", F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("long"))
            .withColumn("low", F.lower("text"))
            .withColumn("words", F.expr(f"if(low rlike '{'|'.join(rare)}', {_words_sql('low')}, cast(array() as array<string>))"))
            .drop("text", "low")
            .withColumn("hits", F.expr(f"filter(transform(words, (w, i) -> struct(w, i)), h -> h.w in ({wanted_sql}))"))
            .withColumn("base", F.expr(
                f"flatten(transform({base_sql}, p -> transform(filter(hits, h -> h.w = p.words[0] and "
                f"{same('h.i', 'p.words')}), h -> struct(p.label as label, h.i as start))))"))
            .withColumn("found", F.expr(
                f"flatten(transform({templates_sql}, t -> transform(filter(array_intersect({starts('t.w1', 't.o1')}, "
                f"{starts('t.w2', 't.o2')}), s -> {same('s + t.key_at', 't.key')}), s -> struct(t.label as label, "
                "s as start, least(1D, aggregate(sequence(0, size(t.words) - 1), 0D, (a, j) -> a + "
                "if(s + j >= 0 and coalesce(get(words, s + j) = t.words[j], false), t.weights[j], 0D))) as score))))"))
            .drop("words", "hits")
            .withColumn("base_labels", F.expr("array_join(array_sort(array_distinct(base.label)), ',')"))
            .withColumn("labels", F.expr("array_join(array_sort(array_union(base.label, found.label)), ',')"))
            .withColumn("score", F.expr("coalesce(array_max(found.score), 0D)")))


def scan_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
                        F.array_min("base.start").cast("long").alias("first_word"),
                        F.array_max("base.start").cast("long").alias("last_word"), "base_labels", "labels", "score")
