"""Licence scan: phrases, and an exact set-similarity join of blocks of text with licence templates.

Only DataFrame functions.  One pass over the texts finds the words, the phrase places, and for each block the
template words it holds.  A block is a line, or a *run* over lines for notices that are wrapped: the end of a line and the words that follow it up to
the next blank line.  Lines of punctuation alone (" *" or "#", as comments have them) are passed over.  A template of n words is looked for in a run in ceil(n / THRESHOLD) words in a row; a run reaches so many
words, of the longest template, to both sides that each such window over a line break lies in the run of the line it starts in.

Then the join: template words are ordered by the number of blocks of the whole corpus that hold them, rarest first (only blocks with as many template
words as the shortest template needs can match, and only they are counted).  The containment of a template of t different words in a block must
reach c = ceil(THRESHOLD t), so a block of h template words must have h >= c (length filter), and of the common words the first in this order lies among the
first t - c + 1 of the template and the first h - c + 1 of the block (prefix filter on both sides): at place p of the one and q of the other
it leaves min(t - p, h - q) words at most (positional filter).  Blocks that pass are compared exactly.
The template table is fixed and small, so it is broadcast.

Edge cases: null and empty texts have no words and no labels; rows that repeat an id give a row each, with the phrase places of
their own text and the template labels of all texts of that id; rows with a null id are left out; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.tables import cut

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"^[\x00-\x2F\x3A-\x60\x7B-\x7F]*$"
THRESHOLD = 0.8
# Phrases that are found wherever their words stand in a row, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# First sentences of public licence notices, one for each label and wording.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_sets() -> list[tuple[int, str, list[str]]]:
    return [(k, label, sorted(set(text.split()))) for k, (label, text) in enumerate(TEMPLATES)]


def _phrase_places(words: Column) -> Column:
    """(start, label) of every place of a phrase."""
    def place(parts: list[str], label: str) -> Callable[[Column, Column], Column]:
        def start(word: Column, i: Column) -> Column:
            fits = word == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                fits = fits & F.when(i >= back, F.get(words, i - back) == part).otherwise(False)
            return F.when(fits, F.struct((i - (len(parts) - 1)).cast("long").alias("start"), F.lit(label).alias("label")))

        return start

    found = [F.filter(F.transform(words, place(phrase.split(), label)), lambda x: x.isNotNull()) for phrase, label in PHRASES.items()]
    return F.concat(*found)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def _run(reach: int) -> Callable[[Column, Column], Column]:
    """The run that starts in a line of ``marked``, null where the next line has no words."""
    def run(line: Column, i: Column) -> Column:
        def until_blank(below: Column) -> Column:
            return _let(F.array_position(F.transform(below, F.size), F.lit(0)).cast("int"), lambda k: F.when(k > 0, F.slice(below, 1, k - 1)).otherwise(below))

        below = _let(F.slice("marked", i + 2, reach), until_blank)
        tail = F.slice(line, F.greatest(F.size(line) - (reach - 1), F.lit(1)), reach)
        follows = F.coalesce(F.size(F.get("marked", i + 1)) > 0, F.lit(False))
        return F.when((F.size(line) > 0) & follows, F.concat(tail, F.slice(F.flatten(below), 1, reach)))

    return run


def _csv(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Phrase places, labels and the best template containment of every document."""
    templates = template_sets()
    vocabulary = sorted({w for _, _, words in templates for w in words})
    endings = sorted({p.split()[-1] for p in PHRASES})
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    lines = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.split(low, "\n").alias("lines"))
    decoration = lambda x: x.rlike(NO_WORD) & x.rlike(r"[^ \t\r\f\x0B]")
    lines = lines.withColumn("lines", F.filter("lines", lambda x: ~decoration(x)))
    lines = lines.select("doc_id", F.transform("lines", lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("lines"))
    words = lines.select("doc_id", "lines", F.flatten("lines").alias("words"))
    words = words.withColumn("hits", F.when(F.arrays_overlap("words", F.array(*map(F.lit, endings))), _phrase_places(F.col("words"))).otherwise(F.array().cast("array<struct<start:long,label:string>>")))
    words = words.withColumn("marked", F.transform("lines", lambda x: F.transform(x, lambda w: F.when(w.isin(vocabulary), w)))).drop("lines")
    shortest = min(math.ceil(threshold * len(t)) for _, _, t in templates)
    widths = [math.ceil(len(text.split()) / threshold) for _, text in TEMPLATES]

    def block(x: Column, run: Column) -> Column:
        return F.struct(F.array_distinct(F.array_compact(x)).alias("held"), run.cast("array<string>").alias("run"))

    lines = F.transform("marked", lambda x: block(x, F.lit(None)))
    runs = F.transform(F.filter(F.transform("marked", _run(max(widths) - 1)), lambda x: x.isNotNull()), lambda x: block(x, x))
    docs_scanned = cut(words.select("doc_id", F.size("words").cast("long").alias("n_words"), "hits", F.filter(F.concat(lines, runs), lambda x: F.size(x["held"]) >= shortest).alias("blocks")))

    # frequency of the template words over all blocks that hold enough of them: one row for each template word
    counts = docs_scanned.select(F.explode("blocks").alias("b")).select(F.explode("b.held").alias("word")).groupBy("word").count()
    frequency = {r.word: r["count"] for r in counts.collect()}
    rows = []
    for k, label, t in templates:
        order = sorted(t, key=lambda w: (frequency.get(w, 0), w))
        need = math.ceil(threshold * len(t))
        rows += [(k, label, need, widths[k], order, word, place) for place, word in enumerate(order[: len(t) - need + 1])]
    table = F.broadcast(docs.sparkSession.createDataFrame(rows, "template int, label string, need int, width int, template_words array<string>, word string, place int"))
    blocks = docs_scanned.where(F.size("blocks") > 0).select("doc_id", F.explode("blocks").alias("b")).select("doc_id", "b.held", "b.run")
    # the held words in the same order, which makes the block's own prefix
    ranked = F.array(*[F.lit(w) for w in sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))])
    ordered = F.transform(F.array_sort(F.transform("held", lambda w: F.array_position(ranked, w))), lambda at: F.get(ranked, (at - 1).cast("int")))
    laid = blocks.withColumn("held", ordered).select("*", F.posexplode("held").alias("at", "word"))
    candidates = laid.join(table, "word").where("size(held) >= need and least(size(template_words) - place, size(held) - at) >= need")
    # the first common word of a block and a template stands for the pair
    first = F.array_position(F.transform("template_words", lambda w: F.array_contains("held", w)), True)
    overlap = F.size(F.array_intersect("held", "template_words"))
    matched = candidates.where(first == F.col("place") + 1).withColumn("common", overlap).where("common >= need")
    window = F.transform(F.sequence(F.lit(1), F.size("run")), lambda k: F.size(F.array_intersect(F.slice("run", k, F.col("width")), F.col("template_words"))))
    matched = matched.withColumn("common", F.when(F.col("run").isNull(), F.col("common")).otherwise(F.array_max(window))).where("common >= need")
    found = matched.groupBy("doc_id").agg(F.collect_set("label").alias("found"), F.max(F.col("common") / F.size("template_words")).alias("best"))
    starts = F.transform("hits", lambda x: x["start"])
    base = F.transform("hits", lambda x: x["label"])
    return docs_scanned.join(found, "doc_id", "left").select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _csv(base).alias("base_labels"), _csv(F.concat(base, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("hits") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def sql() -> str:
    """The same result for DuckDB."""
    values = ", ".join(f"('{label}', {t!r})" for _, label, t in template_sets())
    checks = {"mit license": "w[i] = 'mit' and w[i + 1] = 'license'", "apache license": "w[i] = 'apache' and w[i + 1] = 'license'", "general public license": "w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license'"}
    labels = " ".join(f"when {checks[p]} then '{label}'" for p, label in PHRASES.items())
    return f"""
with texts as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') t from documents where doc_id is not null),
docs as (select doc_id, regexp_extract_all(t, '{WORD}') w from texts),
hits as (select doc_id, i - 1 as start, label from (select doc_id, i, case {labels} end label from (select doc_id, w, unnest(range(1, len(w) + 1)) i from docs where list_contains(w, 'license'))) where label is not null),
base as (select doc_id, count(*) n, min(start) f, max(start) l, list(distinct label) labels from hits group by doc_id),
lines as (select doc_id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{WORD}')) ws from texts),
templates(label, words) as (values {values}),
found as (select doc_id, label, len(list_intersect(ws, words)) / len(words) c from lines, templates where len(ws) > 0 and len(list_intersect(ws, words)) >= ceil({THRESHOLD} * len(words))),
best as (select doc_id, list(distinct label) labels, max(c) c from found group by doc_id)
select d.doc_id, len(d.w)::bigint n_words, coalesce(b.n, 0)::bigint n_base, b.f::bigint first_word, b.l::bigint last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') labels,
  case when b.n > 0 then 1.0::double else coalesce(m.c, 0)::double end score
from docs d left join base b using (doc_id) left join best m using (doc_id)
"""
