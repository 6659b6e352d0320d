"""Licence scan with a positional rare-token index, in DataFrame functions only.

A first pass counts in how many documents each word of the templates stands.
Each template's rarest words (highest inverse document frequency) are its
postings, with their positions in the template. The scan looks up a document's
postings words, aligns each with its template (word position less template
position), keeps starts where enough of the template's rare words stand at their
relative positions, and verifies the mandatory key phrase word by word. Base
templates need all of it, so every place of a base phrase is found. Both passes
are narrow but for the counts of the template words; no Python runs in tasks.

Defined results: null and wordless texts have no words, places or labels (empty
strings, null first and last word, score 0); rows are scanned each on their own;
extra columns are carried along, columns of the output names are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Label, template, key phrase (mandatory, a part of the template).
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "hereby granted free of charge"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms with or without modification"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "distribute this software for any purpose"),
    ("gpl", "under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by", "licensed under a creative commons attribution", "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
]

#: Rare words of a template that are compared, how many of them must stand, and how many are looked up.
RARE, NEEDED, LEADS = 4, 3, 2

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Array of the column's words, A-Z lower-cased (null: empty)."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(WORD), 0)


def all_templates() -> list[dict]:
    base = [{"label": label, "words": p.split(), "key": p.split(), "at": 0, "base": True} for label, p in BASE]
    more = []
    for label, text, key in TEMPLATES:
        w, k = text.split(), key.split()
        at = next(i for i in range(len(w)) if w[i:i + len(k)] == k)
        more.append({"label": label, "words": w, "key": k, "at": at, "base": False})
    return base + more


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and for each template word that of the documents with it (one row per template word)."""
    vocabulary = sorted({w for t in all_templates() for w in t["words"]})
    found = F.array_intersect(words(text), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(F.array_append(found, F.lit(""))).alias("word")).groupBy("word").count().collect()
    df = {r["word"]: r["count"] for r in counts}
    return df.pop("", 0), {w: df.get(w, 0) for w in vocabulary}


def index_templates(n_docs: int, df: dict[str, int]) -> list[dict]:
    """Templates with ``rare``: (position, word, idf) of their rarest words, rarest first."""
    out = []
    for t in all_templates():
        first = {w: i for i, w in reversed(list(enumerate(t["words"])))}
        idf = {w: math.log((n_docs + 1) / (df[w] + 1)) + 1 for w in first}
        rare = sorted(first, key=lambda w: (-idf[w], first[w]))[:RARE]
        out.append(t | {"rare": [(first[w], w, idf[w]) for w in rare],
                        "needed": len(rare) if t["base"] else min(NEEDED, len(rare)), "leads": 1 if t["base"] else LEADS})
    return out


def _rows(rows: list[dict]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with n_words, n_base, first_word, last_word, base_labels, labels and score."""
    index = index_templates(*document_frequencies(docs, text))
    postings = _rows([{"t": i, "word": w, "pos": p} for i, t in enumerate(index) for p, w, _ in t["rare"][:t["leads"]]])
    looked_up = sorted({w for t in index for _, w, _ in t["rare"][:t["leads"]]})
    rare = F.array(*[_rows([{"pos": p, "word": w, "idf": x / sum(r[2] for r in t["rare"])} for p, w, x in t["rare"]]) for t in index])
    keys = F.array(*[_rows([{"pos": t["at"] + j, "word": w} for j, w in enumerate(t["key"])]) for t in index])
    needed = F.array(*[F.lit(t["needed"]) for t in index])
    is_base = F.array(*[F.lit(t["base"]) for t in index])
    label = F.array(*[F.lit(t["label"]) for t in index])

    def stands(c, x):
        return F.coalesce(F.get(F.col("_words"), c["start"] + x["pos"]) == x["word"], F.lit(False))

    hits = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(looked_up), F.struct(i.alias("i"), w.alias("w")))), lambda h: h.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.transform(
        F.filter(postings, lambda p: p["word"] == h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["pos"]).alias("start"))))))
    aligned = F.filter("_starts", lambda c: F.size(F.filter(F.get(rare, c["t"]), lambda x: stands(c, x))) >= F.get(needed, c["t"]))
    verified = F.filter("_aligned", lambda c: F.forall(F.get(keys, c["t"]), lambda x: stands(c, x)))
    places = F.transform("_places", lambda c: F.struct(
        c["t"].alias("t"), c["start"].cast("long").alias("start"), F.get(is_base, c["t"]).alias("base"), F.get(label, c["t"]).alias("label"),
        F.aggregate(F.get(rare, c["t"]), F.lit(0.0), lambda s, x: s + F.when(stands(c, x), x["idf"]).otherwise(0.0)).alias("score")))
    base_places = F.filter("_found", lambda p: p["base"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda p: p["label"]))), ",")

    out = docs.withColumn("_words", words(text))
    for name, column in (("_hits", hits), ("_starts", starts), ("_aligned", aligned), ("_places", verified), ("_found", places), ("_base", base_places)):
        out = out.withColumn(name, column)
    starts_of_base = F.transform("_base", lambda p: p["start"])
    return (out.withColumns({
        "n_words": F.size("_words").cast("long"), "n_base": F.size("_base").cast("long"), "first_word": F.array_min(starts_of_base),
        "last_word": F.array_max(starts_of_base), "base_labels": labels(F.col("_base")), "labels": labels(F.col("_found")),
        "score": F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("_found", lambda p: p["score"])), F.lit(0.0)))})
        .drop("_words", "_hits", "_starts", "_aligned", "_places", "_found", "_base"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``."""
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
