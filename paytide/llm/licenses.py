"""Licences of files: TF-IDF cosine of their lines to templates, then of their directories.

All of it is DataFrame and SQL functions. Each line of a text is compared with every
template, and so is the text as a whole: a line close to a template is a licence header, a
text close to one is a licence file. A file without a header takes the licence of the
nearest directory above it that holds a licence file.

Weights: a word's inverse document frequency is ln((1 + N) / (1 + n)) + 1 with n of the N
texts holding it. Only the words of the templates are counted; any other word weighs as one
that no text holds, so that foreign words always count fully against a match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide.llm.frames import narrowed, staged

# Licence names and the sentences that declare them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the MIT License"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software under the terms of the GNU General Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD license"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
SPLIT = "[^a-z0-9]+"
# Texts in lower case, letter by letter: `lower` alone makes two characters of a dotted capital
# I (the only one it lengthens), of which the second would split the word.
LOWER = "lower(replace(coalesce(text, ''), '\u0130', 'i'))"


def template_words(text: str) -> dict[str, int]:
    """Words of a template and how often each occurs."""
    out: dict[str, int] = {}
    for word in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split():
        out[word] = out.get(word, 0) + 1
    return out


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(values: dict[str, float]) -> str:
    pairs = ", ".join(f"{_quoted(k)}, double({v!r})" for k, v in values.items())
    return f"map({pairs})"


def _frequencies(texts: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Texts, and texts holding each word of the templates; one row per such word."""
    listed = "array(" + ", ".join(map(_quoted, vocabulary)) + ")"
    found = F.expr(f"array_union(array_intersect(split({LOWER}, '{SPLIT}'), {listed}), array(''))")
    rows = (
        texts.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("word").alias("n")).collect()
    )
    counts = {r["word"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


class _Scale:
    """Weights and templates as SQL text."""

    def __init__(self, templates, total: int, counts: dict[str, int]):
        self.templates = [(name, template_words(text)) for name, text in templates]
        vocabulary = sorted({w for _, words in self.templates for w in words})
        self.unknown = math.log(1 + total) + 1
        self.idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}
        self.lengths = [
            math.sqrt(sum((n * self.idf[w]) ** 2 for w, n in words.items())) for _, words in self.templates
        ]
        self.most = {
            w: max(
                (words[w] * self.idf[w] / length) ** 2
                for (_, words), length in zip(self.templates, self.lengths, strict=True)
                if w in words
            )
            for w in vocabulary
        }

    def may_match(self, words: str, least: float) -> str:
        """Whether words can reach the cosine `least` with any template: by Cauchy-Schwarz
        the cosine is at most the root of the template's weight in the shared words."""
        listed = "array(" + ", ".join(map(_quoted, self.most)) + ")"
        return (
            f"aggregate(array_intersect({words}, {listed}), double(0),"
            f" (a, w) -> a + element_at({_map(self.most)}, w)) >= {least * least!r}"
        )

    def length(self, words: str) -> str:
        """Length of the TF-IDF vector: runs of the sorted words, one pass."""
        weight = f"pow(coalesce(element_at({_map(self.idf)}, s.word), double({self.unknown!r})), 2)"
        closed = f"s.total + s.n * s.n * {weight}"
        start = "named_struct('word', '', 'n', 0L, 'total', double(0))"
        step = (
            "if(w = s.word, named_struct('word', w, 'n', s.n + 1, 'total', s.total),"
            f" named_struct('word', w, 'n', 1L, 'total', {closed}))"
        )
        return f"sqrt(aggregate(array_sort(filter({words}, w -> w <> '')), {start}, (s, w) -> {step}, s -> {closed}))"

    def best(self, words: str) -> str:
        """The best template as (score, name); of equal scores the last name."""
        options = []
        for (name, own), length in zip(self.templates, self.lengths, strict=True):
            weights = {w: n * self.idf[w] ** 2 / length for w, n in own.items()}
            dot = (
                f"aggregate(filter({words}, w -> map_contains_key({_map(weights)}, w)), double(0),"
                f" (a, w) -> a + element_at({_map(weights)}, w))"
            )
            options.append(f"named_struct('score', {dot}, 'name', {_quoted(name)})")
        return f"array_max(array({', '.join(options)}))"


def _scored(scale: _Scale, words: str, least: float) -> str:
    """(score, name) of words, or null where `least` is out of reach."""
    best = scale.best(words)
    score = (
        f"transform(array({words}), ws -> transform(array({best.replace(words, 'ws')}), b ->"
        f" named_struct('score', round(b.score / {scale.length('ws')}, 6), 'name', b.name))[0])[0]"
    )
    return f"if({scale.may_match(words, least)}, {score}, null)"


def license_scan(
    df: DataFrame,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    templates=TEMPLATES,
    header_cosine: float = 0.6,
    file_cosine: float = 0.3,
) -> DataFrame:
    """`(doc_id, path, header_license, header_score, file_license, file_score,
    inherited_license, inherited_from, license)`, one row per input row.

    `license` is the header's, or else that of the nearest directory above (the file's own
    included) with a licence file. Of several licence files in a directory the closest
    counts, then the last name. Directories are parted by `/`; a null path is a file in the
    root. Null or empty texts have no header but inherit; ties between templates go to the
    last name; repeated rows come back each. Other columns are not read.
    """
    rows = narrowed(df, doc_id=id_col, path=path_col, text=text_col)
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    scale = _Scale(templates, *_frequencies(rows.select("text"), vocabulary))

    line = f"split(l, '{SPLIT}')"
    per_line = f"transform(split({LOWER}, '\\n'), l -> {_in(line, _scored(scale, 'ws', header_cosine))})"
    header = F.expr(f"array_max(filter({per_line}, x -> x.score >= {header_cosine!r}))")
    whole = F.expr(_in(f"split({LOWER}, '{SPLIT}')", _scored(scale, "ws", file_cosine)))
    # The scores of a text are computed once: the table is written, without the texts.
    scored = staged(
        rows.select(
            "doc_id",
            "path",
            F.regexp_extract(F.coalesce("path", F.lit("")), "^(.*)/[^/]*$", 1).alias("dir"),
            header.alias("header"),
            F.when(whole["score"] >= file_cosine, whole).alias("file"),
        )
    )
    held = staged(
        scored.filter("file IS NOT NULL").groupBy("dir").agg(F.max("file").alias("best")).select(
            F.col("dir").alias("above"), F.col("best.name").alias("name")
        )
    )
    nearest = staged(_nearest(scored.select("dir").distinct(), held))
    return scored.join(nearest, "dir", "left").select(
        "doc_id",
        "path",
        F.col("header.name").alias("header_license"),
        F.col("header.score").alias("header_score"),
        F.col("file.name").alias("file_license"),
        F.col("file.score").alias("file_score"),
        "inherited_license",
        "inherited_from",
        F.coalesce("header.name", "inherited_license").alias("license"),
    )


def _in(words: str, body: str) -> str:
    """`body` with `ws` bound to `words`, so that they are split once."""
    return f"transform(array({words}), ws -> {body})[0]"


def _nearest(dirs: DataFrame, held: DataFrame) -> DataFrame:
    """The nearest directory with a licence file for each directory, itself included."""
    parts: Column = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(
            n.alias("depth"),
            F.when(n == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, n), "/")).alias("above"),
        ),
    )
    climbed = dirs.select("dir", F.explode(F.array_distinct(above)).alias("a")).select("dir", "a.depth", "a.above")
    return (
        climbed.join(held, "above")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "name")).alias("best"))
        .select("dir", F.col("best.name").alias("inherited_license"), F.col("best.above").alias("inherited_from"))
    )


def oracle(documents: str, templates=TEMPLATES, header_cosine: float = 0.6, file_cosine: float = 0.3) -> str:
    """The scan as DuckDB SQL; `documents` is SQL for rows (doc_id, path, text)."""
    values = ", ".join(
        f"({i}, '{name}', '{w}', {n})"
        for i, (name, text) in enumerate(templates)
        for w, n in template_words(text).items()
    )
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) AS k, doc_id, path, lower(coalesce(text, '')) AS text,
    regexp_extract(coalesce(path, ''), '^(.*)/[^/]*$', 1) AS dir FROM ({documents})),
t(i, name, w, n) AS (VALUES {values}),
lines AS (SELECT k, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS j FROM docs),
units AS (SELECT k, j, l FROM lines UNION ALL SELECT k, 0, text FROM docs),
tokens AS (SELECT k, j, unnest(string_split_regex(l, '{SPLIT}')) AS w FROM units),
tf AS MATERIALIZED (SELECT k, j, w, count(*) AS n FROM tokens WHERE w <> '' GROUP BY ALL),
total AS (SELECT count(*) AS d FROM docs),
idf AS (SELECT v.w, ln((1 + d) / (1 + count(tf.k))) + 1 AS x
  FROM (SELECT DISTINCT w FROM t) v CROSS JOIN total LEFT JOIN tf ON tf.w = v.w AND tf.j = 0 GROUP BY v.w, d),
size AS (SELECT k, j, sqrt(sum(pow(n * coalesce(x, ln(1 + d) + 1), 2))) AS len
  FROM tf CROSS JOIN total LEFT JOIN idf USING (w) GROUP BY k, j),
tsize AS (SELECT i, sqrt(sum(pow(n * x, 2))) AS len FROM t JOIN idf USING (w) GROUP BY i),
cosine AS (SELECT k, j, name, round(sum(tf.n * t.n * x * x) / any_value(tsize.len) / any_value(size.len), 6) AS score
  FROM tf JOIN t USING (w) JOIN idf USING (w) JOIN size USING (k, j) JOIN tsize USING (i) GROUP BY k, j, i, name),
header AS (SELECT k, max((score, name)) AS b FROM cosine WHERE j > 0 AND score >= {header_cosine} GROUP BY k),
file AS (SELECT k, max((score, name)) AS b FROM cosine WHERE j = 0 AND score >= {file_cosine} GROUP BY k),
held AS (SELECT dir AS above, max(b)[2] AS name FROM file JOIN docs USING (k) GROUP BY dir),
climbed AS (SELECT DISTINCT dir, array_to_string(string_split(dir, '/')[1:depth], '/') AS above, depth
  FROM (SELECT dir, unnest(range(0, len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM docs))),
nearest AS (SELECT dir, max((depth, above, name)) AS b FROM climbed JOIN held USING (above) GROUP BY dir)
SELECT doc_id, path, header.b[2] AS header_license, header.b[1] AS header_score, file.b[2] AS file_license,
  file.b[1] AS file_score, nearest.b[3] AS inherited_license, nearest.b[2] AS inherited_from,
  coalesce(header.b[2], nearest.b[3]) AS license
FROM docs LEFT JOIN header USING (k) LEFT JOIN file USING (k) LEFT JOIN nearest USING (dir)"""
