"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, a quarter longer than the template, wherever lines break.
A template matches a block that holds at least ``threshold`` of the template's distinct words; from
``TOLERANT`` words on, one may be lacking in any case.  Words that name a license must stand.
Windows are searched in overlapping pieces of the text: only a piece that holds enough tokens can
have a window that does.
Tokens are ordered by their frequency over the whole corpus, rarest
first; a block and a template that match share a token of both prefixes (prefix filter), the block
must be long enough (length filter), and the places of the shared token in both orders bound what
else can be shared (positional filter).  What passes is compared in full.  Only tokens of some
template can be shared, so blocks are reduced to these; this changes no result.

The base phrases are found as words that stand consecutively, wherever they are.

Everything is DataFrame expressions.  Documents that hold no prefix token are skipped before pieces
are cut; the templates are parameters, so their side of the join is small.
"""

from pyspark.sql import functions as F

from ..sources.shared import materialise
from .common import lower_ascii

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, and the words of a notice that is usual for it.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a "
               "copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international "
              "license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 "
                 "international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 "
                 "international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related "
            "rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: Words that tell one license from another; a block must hold those of the template.
NAMES = frozenset("""affero apache attribution by cc commons creative eclipse gnu lesser mit mozilla
    nc nd noncommercial sa sharealike unencumbered""".split())

#: Notices may lack one word in twenty, and one in any case from so many distinct words on.
THRESHOLD = 0.95
TOLERANT = 8
#: Pieces of a text start every so many words; each reaches as far as the longest window.
PIECE = 256
_SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(lowered):
    return F.filter(F.split(lowered, _SIGNS), lambda w: w != "")


def _starts(phrase):
    """Places, from 0, where the phrase's words stand consecutively in the array ``words``."""
    here = " and ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
    return f"filter(sequence(0, greatest(size(words) - 1, 0)), i -> {here})"


def _strings(values):
    return F.array(*[F.lit(v) for v in values])


def template_table(templates, threshold):
    """[(template number, label, distinct tokens, tokens needed, names, words in a window)]."""
    out = []
    for number, (label, text) in enumerate(templates):
        words = text.split()
        tokens = sorted(set(words))
        need = -(-len(tokens) * round(threshold * 1000) // 1000)
        if len(tokens) >= TOLERANT:
            need = min(need, len(tokens) - 1)
        out.append((number, label, tokens, need, sorted(NAMES.intersection(tokens)),
                    -(-len(words) * 5 // 4)))
    return out


def license_scan(documents, phrases=None, templates=None, threshold=THRESHOLD):
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score.

    Words are lower-cased in A-Z and separated by ASCII signs; a null text is empty.  ``score`` is
    1 where a base phrase stands, else the largest share of a matching template's tokens, else 0.
    Without words or matches, counts are 0, places null and labels ''.  Repeated rows and null ids
    are rows like others.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    table = template_table(templates, threshold)
    reach = max(t[5] for t in table)
    vocabulary = sorted({word for t in table for word in t[2]})

    lowered = lower_ascii(F.coalesce(documents["text"].cast("string"), F.lit("")))
    docs = documents.select("doc_id", lowered.alias("lowered")).withColumn(
        "words", _words(F.col("lowered")))
    # How often each template token occurs decides the order; every occurrence counts.
    seen = docs.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("token"))
    counts = {r["token"]: r["count"] for r in seen.groupBy("token").count().collect()}
    order = sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    prefixes = []
    for number, label, tokens, need, names, span in table:
        ordered = sorted(tokens, key=rank.get)
        prefixes += [(number, label, len(tokens), need, place, token, tokens, names, span)
                     for place, token in enumerate(ordered[:len(tokens) - need + 1])]
    rare = sorted({p[5] for p in prefixes})

    any_phrase = "|".join(f"{_SIGNS}".join(p.split()) for p in phrases)
    places = F.when(F.col("lowered").rlike(any_phrase), F.array(*[
        F.struct(F.lit(label).alias("label"), F.expr(_starts(phrase)).alias("at"))
        for phrase, label in phrases.items()]))
    base = docs.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), places.alias("places"),
        F.when(F.arrays_overlap("words", _strings(rare)), F.col("lowered")).alias("lowered"))
    at = "flatten(transform(places, p -> p.at))"
    base = base.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "lowered",
        F.expr(f"coalesce(size({at}), 0)").cast("long").alias("n_base"),
        F.expr(f"array_min({at})").cast("long").alias("first_word"),
        F.expr(f"array_max({at})").cast("long").alias("last_word"),
        F.expr("transform(filter(places, p -> size(p.at) > 0), p -> p.label)").alias("found"))
    base = materialise(base, "scan")  # fixes the row numbers

    least = min(t[3] for t in table)
    pieces = base.where("lowered is not null").select(
        "row", _words(F.col("lowered")).alias("words")).select("row", "words", F.posexplode(F.expr(
            f"sequence(0, greatest(size(words) - 1, 0), {PIECE})")).alias("block", "begin"))
    pieces = pieces.select("row", "block", F.filter(F.transform(
        F.expr(f"slice(words, begin + 1, {PIECE + reach})"),
        lambda w, i: F.struct(i.alias("at"), w.alias("token"))),
        lambda s: s["token"].isin(vocabulary)).alias("near")).withColumn(
        "tokens", F.array_distinct(F.col("near.token")))
    ranks = F.create_map(*[x for t in order for x in (F.lit(t), F.lit(rank[t]))])
    blocks = pieces.where(
        F.size("tokens") >= least).withColumn("tokens", F.transform(F.array_sort(F.transform(
            "tokens", lambda t: F.struct(ranks[t].alias("rank"), t.alias("token")))),
            lambda s: s["token"]))
    spread = blocks.select(
        "row", "block", "tokens", "near", F.size("tokens").alias("size"),
        F.posexplode(F.expr(f"slice(tokens, 1, size(tokens) - {least} + 1)")).alias("at", "token"))
    spark = documents.sparkSession
    sides = spark.createDataFrame(
        prefixes, "template int, label string, all int, need int, place int, token string, "
                  "template_tokens array<string>, names array<string>, span int")
    pairs = spread.join(F.broadcast(sides), "token").where(
        "size >= need and least(at, place) + 1 + least(size - 1 - at, all - 1 - place) >= need")
    pairs = pairs.dropDuplicates(["row", "block", "template"]).withColumn(
        "both", F.size(F.array_intersect("tokens", "template_tokens"))).where("both >= need")
    # Of a piece, the best window that starts at a token of the template and holds the names.
    pairs = pairs.withColumn("near", F.filter("near", lambda s: F.array_contains(
        "template_tokens", s["token"]))).withColumn("windows", F.transform(
            "near", lambda s: F.array_distinct(F.transform(F.filter(
                "near", lambda o: (o["at"] >= s["at"]) & (o["at"] < s["at"] + F.col("span"))),
                lambda o: o["token"]))))
    pairs = pairs.withColumn("both", F.array_max(F.transform(F.filter(
        "windows", lambda w: F.size(F.array_except("names", w)) == 0), F.size))).where(
        "both >= need")
    method = pairs.groupBy("row").agg(F.collect_set("label").alias("matched"),
                                      F.max(F.col("both") / F.col("all")).alias("best"))
    none = F.array().cast("array<string>")
    return base.join(method, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", F.array_sort(F.array_distinct(F.coalesce("found", none)))).alias(
            "base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(F.coalesce("found", none),
                                                    F.coalesce("matched", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def sql(phrases=None, templates=None, threshold=THRESHOLD):
    """The same by comparing every window that starts at a word of a template with it."""
    phrases = PHRASES if phrases is None else phrases
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    starts = ", ".join(
        "list_transform(list_filter(range(1, len(w) + 1), lambda i: "
        + " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split()))
        + f"), lambda i: {{'label': '{label}', 'at': i - 1}})" for phrase, label in phrases.items())
    rows = ", ".join(
        f"({number}, '{label}', {len(tokens)}, {need}, {len(names)}, {span}, '{token}', "
        f"{token in names})" for number, label, tokens, need, names, span
        in template_table(TEMPLATES if templates is None else templates, threshold)
        for token in tokens)
    return f"""
with docs as materialized (
  select row_number() over () as r, doc_id, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
words as (select r, doc_id, {words.format('t')} as w from docs),
base as (select r, doc_id, len(w) as n_words, flatten([{starts}]) as p from words),
templates(number, label, n, need, names, span, token, is_name) as (values {rows}),
tokens as (select r, unnest(w) as token, generate_subscripts(w, 1) as i from words),
scored as (
  select r, label, n, need, names,
    count(distinct token) over here as common,
    count(distinct token) filter (is_name) over here as named
  from tokens join templates using (token)
  window here as (partition by r, number order by i
    range between current row and span - 1 following)),
method as (select r, list_distinct(list(label)) as found, max(common / n) as best from scored
  where common >= need and named = names group by r)
select doc_id, n_words, len(p) as n_base, list_min(list_transform(p, lambda x: x.at)) as first_word,
  list_max(list_transform(p, lambda x: x.at)) as last_word,
  array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',')
    as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label),
    coalesce(found, [])))), ',') as labels,
  case when len(p) > 0 then 1.0::double else coalesce(best, 0.0)::double end as score
from base left join method using (r)
"""


SQL = sql()
