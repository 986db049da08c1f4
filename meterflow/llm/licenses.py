"""Licence scan: TF-IDF cosine to templates, then inheritance by directory.

DataFrame and SQL functions only. A text is cut into blocks at line ends and
after sentence ends, wherever they stand in it; a block's terms are its runs
of a-z and 0-9, lower-cased. A term weighs tf * (ln((N + 1) / (df + 1)) + 1),
with df counted over all N texts for the templates' terms (a list of fixed
size) and 0 for any other term, which can only lengthen a block's vector. A
block is a notice of the template it is closest to if their cosine reaches
``min_cosine``.

Only blocks that can reach it are scored: a template's heaviest terms are its
anchors, as many as it takes for the others to weigh less than ``min_cosine``
of its length together. A block without an anchor stays below by
Cauchy-Schwarz, so the filter loses nothing.

A file with its own notice has that licence. Any other file inherits from the
licence file (LICENSE, COPYING and their like) in its own directory or the
nearest directory above that has one with a notice: each distinct directory is
exploded into its ancestors, joined by path with the licence files'
directories, and keeps the deepest.

Defined results: null and empty texts have no notice. Rows that share a path
are judged one by one by their texts and share the path's best notice. A null
path is in no directory: it has its own notice or none. Equal cosines go to
the first template by name; of a directory's licence files the one with the
highest cosine counts, then the first name. Other columns pass through;
added columns replace input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, same

MIN_COSINE = 0.6
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"

#: The wording by which texts name their licence.
TEMPLATES = {
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal",
    "EPL-2.0": "made available under the terms of the Eclipse Public License 2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "ISC": "Released under the ISC License",
    "LGPL-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "subject to the terms of the Mozilla Public License, version 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def _terms(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _tokens(text: Column) -> Column:
    return F.split(F.lower(text), "[^a-z0-9]+")


def _blocks(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?])[ \t]+", "$1\n"), "\n")


def _weights(df: dict[str, int], n: int) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """idf of the templates' terms, and the templates' unit vectors."""
    idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for text in TEMPLATES.values() for t in _terms(text)}
    units = {}
    for name, text in TEMPLATES.items():
        w: dict[str, float] = {}
        for t in _terms(text):
            w[t] = w.get(t, 0.0) + idf[t]
        length = math.sqrt(sum(x * x for x in w.values()))
        units[name] = {t: x / length for t, x in w.items()}
    return idf, units


def _anchors(units: dict[str, dict[str, float]], min_cosine: float) -> list[str]:
    found = set()
    for w in units.values():
        left = 1.0
        for t, x in sorted(w.items(), key=lambda p: (-p[1], p[0])):
            if left < (min_cosine - 1e-6) ** 2:
                break
            found.add(t)
            left -= x * x
    return sorted(found)


def notices(files: DataFrame, path_col: str, text_col: str, min_cosine: float) -> DataFrame:
    """path, license, cosine, n_notices of each path with a notice."""
    spark = files.sparkSession
    texts = files.select(F.col(path_col).alias("path"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    vocab = sorted({t for text in TEMPLATES.values() for t in _terms(text)})
    held = F.explode(F.array_intersect(_tokens(F.col("text")), F.array(*map(F.lit, vocab))))
    df = {r["t"]: r["n"] for r in texts.select(held.alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}  # the templates' terms
    n = texts.count()
    idf, units = _weights(df, n)
    names = sorted(units)
    rows = ", ".join(f"('{t}', {idf[t]!r}D, " + ", ".join(f"{units[k].get(t, 0.0)!r}D" for k in names) + ")" for t in vocab)
    weights = spark.sql(f"SELECT * FROM VALUES {rows} AS w(term, idf, {', '.join(f'u{i}' for i in range(len(names)))})")

    anchored = r"(?<![a-z0-9])(?:" + "|".join(_anchors(units, min_cosine)) + r")(?![a-z0-9])"
    blocks = (
        texts.filter(F.lower("text").rlike(anchored))
        .select("path", F.xxhash64("text").alias("h"), F.posexplode(_blocks(F.col("text"))).alias("nr", "block"))
        .filter(F.lower("block").rlike(anchored))
    )
    tf = (
        blocks.select("path", "h", "nr", F.explode(_tokens(F.col("block"))).alias("term")).filter("term <> ''")
        .groupBy("path", "h", "nr", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    w = F.col("tf") * F.coalesce("idf", F.lit(math.log(n + 1) + 1))
    scored = tf.join(weights, "term", "left").groupBy("path", "h", "nr").agg(
        F.sqrt(F.sum(w * w)).alias("length"), *[F.sum(w * F.coalesce(f"u{i}", F.lit(0.0))).alias(f"dot{i}") for i in range(len(names))]
    )
    cosines = F.array(*[F.struct(F.round(F.col(f"dot{i}") / F.col("length"), 9).alias("cosine"), F.lit(-i).alias("order"), F.lit(k).alias("license")) for i, k in enumerate(names)])
    best = scored.select("path", F.array_max(cosines).alias("b")).filter(F.col("b.cosine") >= min_cosine)
    return best.groupBy("path").agg(F.max("b").alias("b"), F.count(F.lit(1)).alias("n_notices")).select("path", "b.license", "b.cosine", "n_notices")


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", min_cosine: float = MIN_COSINE) -> DataFrame:
    """``files`` without the text, and own_license, cosine, n_notices,
    inherited_license, inherited_from (a directory), license (own, else inherited)."""
    made = ["own_license", "cosine", "n_notices", "inherited_license", "inherited_from", "license"]
    own = keep(notices(files, path_col, text_col, min_cosine), "notices")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    holders = (
        own.filter(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENSE_FILE))
        .groupBy(folder.alias("above")).agg(F.min_by("license", F.struct(-F.col("cosine"), "path")).alias("inherited_license"))
    )
    paths = files.select(F.col(path_col).alias("path")).filter("path IS NOT NULL")
    dirs = paths.select(folder.alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    nearest = (
        dirs.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "above"))
        .join(holders, "above").groupBy("dir")
        .agg(F.max_by(F.struct("inherited_license", "above"), "depth").alias("i"))
        .select("dir", "i.inherited_license", F.col("i.above").alias("inherited_from"))
    )
    kept = [c for c in files.columns if c != text_col and c not in made]
    base = files.select(*[F.col(f"`{c}`") for c in kept], F.col(path_col).alias("__path")).withColumn("__dir", F.regexp_replace("__path", "/?[^/]*$", ""))
    own = own.select(F.col("path").alias("__own"), F.col("license").alias("own_license"), "cosine", "n_notices")
    out = base.join(own, same(F.col("__path"), F.col("__own")), "left").join(nearest.withColumnRenamed("dir", "__of"), F.col("__dir") == F.col("__of"), "left")
    return out.select(
        *[F.col(f"`{c}`") for c in kept], "own_license", "cosine", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"),
        *[F.when(F.col("own_license").isNull(), F.col(c)).alias(c) for c in ("inherited_license", "inherited_from")],
        F.coalesce("own_license", "inherited_license").alias("license"),
    )


def document_path(doc_id: str) -> str:
    """SQL for the place of a document in a tree of folders of 50 in folders of
    1000, where the first of each folder is its licence file."""
    return (
        f"CASE WHEN {doc_id} % 1000 = 0 THEN concat(floor({doc_id} / 1000), '/LICENSE') "
        f"WHEN {doc_id} % 50 = 0 THEN concat(floor({doc_id} / 1000), '/', floor({doc_id} / 50), '/LICENSE') "
        f"ELSE concat(floor({doc_id} / 1000), '/', floor({doc_id} / 50), '/', {doc_id}, '.txt') END"
    )


def _oracle(min_cosine: float = MIN_COSINE) -> str:
    names = sorted(TEMPLATES)
    values = ", ".join(f"({i}, '{k}', '{t}')" for i, k in enumerate(names) for t in _terms(TEMPLATES[k]))
    path = document_path("doc_id").replace("floor(", "CAST(floor(").replace(" / 1000)", " / 1000) AS BIGINT)").replace(" / 50)", " / 50) AS BIGINT)")
    return f"""
WITH tt(nr, license, term) AS (VALUES {values}),
files AS (SELECT doc_id, {path} AS path, text FROM documents),
toks AS (SELECT doc_id, unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-z0-9]+'))) AS term FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL),
idf AS (
  SELECT v.term, ln((max(total.n) + 1) / (count(toks.term) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT term FROM tt) v CROSS JOIN total LEFT JOIN toks ON toks.term = v.term GROUP BY v.term),
tw AS (SELECT nr, license, tt.term, sum(idf) AS w FROM tt JOIN idf ON idf.term = tt.term GROUP BY ALL),
tu AS (SELECT nr, license, term, w / sqrt(sum(w * w) OVER (PARTITION BY nr)) AS u FROM tw),
blocks AS (
  SELECT path, doc_id, generate_subscripts(b, 1) AS nr, unnest(b) AS block
  FROM (SELECT path, doc_id, string_split(regexp_replace(text, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)) AS b FROM files WHERE text IS NOT NULL)),
tf AS (
  SELECT path, doc_id, nr, term, count(*) AS tf
  FROM (SELECT path, doc_id, nr, unnest(regexp_split_to_array(lower(block), '[^a-z0-9]+')) AS term FROM blocks) WHERE term <> '' GROUP BY ALL),
bw AS (SELECT tf.*, tf * coalesce(idf.idf, ln((SELECT n FROM total) + 1) + 1) AS w FROM tf LEFT JOIN idf ON idf.term = tf.term),
len AS (SELECT doc_id, nr, sqrt(sum(w * w)) AS l FROM bw GROUP BY ALL),
cosines AS (
  SELECT bw.path, bw.doc_id, bw.nr, tu.nr AS t, license, round(sum(bw.w * u) / max(l), 9) AS cosine
  FROM bw JOIN tu ON tu.term = bw.term JOIN len ON len.doc_id = bw.doc_id AND len.nr = bw.nr GROUP BY ALL),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, nr ORDER BY cosine DESC, t) AS k FROM cosines)
  WHERE k = 1 AND cosine >= {min_cosine}),
own AS (
  SELECT path, count(*) AS n_notices, max(cosine) AS cosine, first(license ORDER BY cosine DESC, t) AS own_license
  FROM best GROUP BY path),
holders AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS above, first(own_license ORDER BY cosine DESC, path) AS inherited_license
  FROM own WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{LICENSE_FILE}') GROUP BY 1),
near AS (
  SELECT doc_id, inherited_license, above
  FROM files JOIN holders ON starts_with(path, above || '/')
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(above) DESC) = 1)
SELECT files.doc_id, files.path, own_license, cosine, coalesce(n_notices, 0) AS n_notices,
       CASE WHEN own_license IS NULL THEN near.inherited_license END AS inherited_license,
       CASE WHEN own_license IS NULL THEN near.above END AS inherited_from,
       coalesce(own_license, near.inherited_license) AS license
FROM files LEFT JOIN own ON own.path = files.path LEFT JOIN near ON near.doc_id = files.doc_id
"""


ORACLE = _oracle()
