"""Licence scans: lines compared with licence notices by Dice coefficient over word bigrams.

Every line of a document, and the whole document, is normalised (lower case; a-z and 0-9, single
blanks) and turned into the set of its word bigrams. A notice with n_t bigrams can reach the
coefficient t with a piece of n only if n_t t / (2 - t) <= n <= n_t (2 - t) / t, so most pieces meet no
notice at all. One narrow pass of DataFrame functions: no shuffle, no Python.

Cases: null text has no lines and no licence; an empty text has one line; pieces of one word have
no bigrams and match nothing; ties go to the higher coefficient, then the smaller line number (-1
stands for the whole document), then the notice's name; repeated rows give equal results; no rows
give no rows; of extra columns nothing is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Notices by which texts state their licence.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License"),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law the author has waived all copyright and related rights to this work"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)


def bigrams_of(text: str) -> list[str]:
    """The distinct word bigrams of a notice, normalised as `bigrams` does."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words[:-1], words[1:], strict=True)))


def _words(piece: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(piece), "[^a-z0-9]+", " ")), " ")


def bigrams(words: Column) -> Column:
    """The distinct bigrams of an array of words (none for fewer than two)."""
    pair = lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))
    return F.when(F.size(words) > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - 1), pair)))


def scan(docs: DataFrame, notices=NOTICES, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_lines, licence, dice, line (the best match; null without one), matches (all)."""
    sets = [(name, bigrams_of(notice)) for name, notice in notices]
    low = min(len(s) for _, s in sets) * threshold / (2 - threshold)
    high = max(len(s) for _, s in sets) * (2 - threshold) / threshold
    known = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, s)).alias("set"), F.lit(len(s)).alias("n")) for name, s in sets])

    lines = F.split(F.col(text), "\n", -1)
    named = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("piece")))
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col(text).alias("piece")))).otherwise(F.array().cast("array<struct<line:int,piece:string>>"))
    worded = F.transform(F.concat(named, whole), lambda p: F.struct(p["line"].alias("line"), _words(p["piece"]).alias("words")))
    # Repeated bigrams count once, so more words than the bound may still do: only too few never can.
    short = F.filter(worded, lambda p: F.size(p["words"]) - 1 >= low)
    pieces = F.transform(short, lambda p: F.struct(p["line"].alias("line"), bigrams(p["words"]).alias("set")))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.size(lines), F.lit(0)).alias("_n"), pieces.alias("_p"))
    rows = rows.withColumn("n_lines", F.greatest("_n", F.lit(0)).cast("long"))
    rows = rows.withColumn("_p", F.filter("_p", lambda p: (F.size(p["set"]) >= low) & (F.size(p["set"]) <= high)))

    def against(p):
        n = F.size(p["set"])
        # Size bounds per notice, before any comparison.
        near = F.filter(known, lambda t: (n >= t["n"] * threshold / (2 - threshold)) & (n <= t["n"] * (2 - threshold) / threshold))
        return F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(p["set"], t["set"])) / (n + t["n"])).alias("dice"), p["line"].alias("line"), t["name"].alias("name")))

    found = F.filter(F.flatten(F.transform("_p", against)), lambda m: m["dice"] >= threshold)
    best_first = F.array_sort(found, lambda a, b: F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1)).when(
        a["line"] != b["line"], F.when(a["line"] < b["line"], -1).otherwise(1)).when(
        a["name"] != b["name"], F.when(a["name"] < b["name"], -1).otherwise(1)).otherwise(0))
    rows = rows.withColumn("matches", F.coalesce(best_first, F.array().cast("array<struct<dice:double,line:int,name:string>>")))
    top = F.try_element_at("matches", F.lit(1))
    return rows.select("doc_id", "n_lines", top["name"].alias("licence"), top["dice"].alias("dice"), top["line"].cast("long").alias("line"), "matches")


def op5_licence(spark, sf_dir):
    rows = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_lines", "licence", "dice", "line", F.size("matches").cast("long").alias("n_matches"))


def _sql() -> str:
    known = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{b}'" for b in bigrams_of(notice))) for name, notice in NOTICES)
    return f"""
WITH known(name, known_set) AS (VALUES {known}),
cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
pieces AS (
  SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS piece FROM cut
  UNION ALL SELECT doc_id, -1, text FROM cut WHERE len(lines) > 1),
words AS (SELECT doc_id, line, string_split(trim(regexp_replace(lower(piece), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM pieces),
sets AS (SELECT doc_id, line, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS s FROM words WHERE len(w) BETWEEN 2 AND 100000000),
scored AS (
  SELECT doc_id, line, name, 2.0::DOUBLE * len(list_intersect(s, known_set)) / (len(s) + len(known_set)) AS dice
  FROM sets JOIN known ON len(s) BETWEEN len(known_set) * {THRESHOLD / (2 - THRESHOLD)!r} AND len(known_set) * {(2 - THRESHOLD) / THRESHOLD!r}),
found AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, line, name) AS nth,
                 count(*) OVER (PARTITION BY doc_id) AS n_matches FROM scored WHERE dice >= {THRESHOLD})
SELECT c.doc_id, coalesce(len(c.lines), 0)::BIGINT AS n_lines, f.name AS licence, f.dice, f.line::BIGINT AS line,
       coalesce(f.n_matches, 0)::BIGINT AS n_matches
FROM cut c LEFT JOIN found f ON c.doc_id = f.doc_id AND f.nth = 1"""


SQL = _sql()
