"""Licence texts in documents, by voting on offset diagonals.

1. All rolling word k-grams of every document are hashed, for each ``k`` that a
   template has, and joined with the templates' grams (a table as small as the
   templates, broadcast).
2. A hit of document position ``p`` and template position ``t`` votes for the
   diagonal ``p - t``.  Votes are counted by document, template and diagonal.
3. Neighbouring diagonals merge, as far as words were put in or left out: in order
   of the offset, each one at most ``slack`` from the one before it.
4. A merged span with enough different template grams is a candidate.  Its
   diagonals are read again in the text, word by word; only equal words count.

Texts are told apart by two 64-bit hashes, so copies of a text share their votes.
Only texts with candidates are read a second time.

Defined results: a null text is empty and has no words; every row has one result,
repeated rows and rows with null ids, too; other columns are not read; an empty
table gives no rows.  Results of equal texts are equal.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from texlode.llm.batches import Polynomial, Words, column_bytes, signed, text_chunks
from texlode.llm.licenses import Template, templates
from texlode.plans.physical import materialize

# All that separates words: ASCII but letters and digits.  The other bytes are parts of words.
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = False
SEPARATORS[128:] = False

# Candidates, and all their diagonals, up to which they are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_DIAGONALS = 1_000_000


def _polynomials() -> tuple[Polynomial, Polynomial]:
    return Polynomial(71), Polynomial(72)


def _words(texts: list[bytes], polynomial: Polynomial | None = None) -> Words:
    return Words(texts, polynomial, lower=True, spaces=SEPARATORS)


def _slice(found: Words, first: int, last: int) -> list[bytes]:
    ends = zip(found.start[first:last].tolist(), found.end[first:last].tolist(), strict=True)
    return [found.joined[s:e] for s, e in ends]


def template_words(template: Template) -> list[bytes]:
    found = _words([template.text.encode()])
    return _slice(found, 0, len(found))


def _grams(sizes: list[int]):
    """A row for each document (``pos`` = -1) and for each of its words, with the hashes of the grams from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_byte, by_word = _polynomials()
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for i, j in text_chunks(texts):
                found = _words(texts[i:j], by_byte)
                sums = by_word.prefix(found.hash)
                n = len(found)
                counts = np.diff(found.first)
                document = np.repeat(np.arange(j - i), counts)
                start = np.arange(n)
                last = found.first[1:][document]
                keys = [np.asarray(batch.column(name).slice(i, j - i)) for name in ("d1", "d2")]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        *map(pa.array, keys),
                        pa.array(np.full(j - i, -1)),
                        pa.array(counts),
                        *[pa.nulls(j - i, pa.int64()) for _ in sizes],
                    ],
                    names=["doc_id", "d1", "d2", "pos", "n_words", *[f"h{k}" for k in sizes]],
                )
                hashes = []
                for k in sizes:
                    whole = start + k <= last
                    values = signed(by_word.slices(sums, start, np.minimum(start + k, n)))
                    hashes.append(pa.array(values, mask=~whole))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(n, pa.int64()),
                        *[pa.array(key[document]) for key in keys],
                        pa.array(start - found.first[:-1][document]),
                        pa.nulls(n, pa.int64()),
                        *hashes,
                    ],
                    names=["doc_id", "d1", "d2", "pos", "n_words", *[f"h{k}" for k in sizes]],
                )

    return run


def _places(spark, known: list[Template], k: int) -> DataFrame:
    """Places of each gram of ``k`` words in the templates: ``(h<k>, p<k>)``, one row per gram."""
    by_byte, by_word = _polynomials()
    places = defaultdict(list)
    for number, template in enumerate(known):
        if template.k == k:
            found = _words([template.text.encode()], by_byte)
            sums = by_word.prefix(found.hash)
            start = np.arange(len(found) - k + 1)
            for t, h in enumerate(signed(by_word.slices(sums, start, start + k)).tolist()):
                places[h].append((number, t))
    return spark.createDataFrame(list(places.items()), f"h{k} bigint, p{k} array<struct<template:int,t:int>>")


def _spans(hits: DataFrame, known: list[Template]) -> DataFrame:
    """Merged diagonals with enough votes: ``(d1, d2, found)`` with arrays of ``(template, span, diagonal)``."""
    facts = F.array(*[F.lit(x.slack) for x in known])
    grams = F.array(*[F.lit(len(template_words(x)) - x.k + 1) for x in known])
    least = F.array(*[F.lit(x.least) for x in known])
    text = ("d1", "d2", "template")
    # A set of template positions is never larger than the template.
    votes = hits.groupBy(*text, "diagonal").agg(F.collect_set("t").alias("ts"))
    along = Window.partitionBy(*text).orderBy("diagonal")
    slack = F.get(facts, F.col("template"))
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > slack) | (slack == 0), F.lit(True))
    spans = votes.withColumn("new", new).withColumn(
        "span", F.sum(F.col("new").cast("bigint")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    spans = materialize(spans.select(*text, "span", "diagonal", "ts"))
    # Diagonals that stand alone need no merging.
    sizes = (
        spans.select(*text, "span", F.explode("ts").alias("t")).distinct()
        .groupBy(*text, "span").agg(F.count(F.lit(1)).alias("votes"))
    )
    enough = sizes.filter(F.col("votes") >= F.get(least, F.col("template")) * F.get(grams, F.col("template")))
    chosen = spans.join(enough.select(*text, "span"), [*text, "span"], "left_semi")
    return chosen.groupBy("d1", "d2").agg(F.collect_list(F.struct("template", "span", "diagonal")).alias("found"))


def _verify(known: list[Template]):
    """Result of each document with candidates, from its words."""
    words = [template_words(x) for x in known]

    def spans(found: Words, first: int, last: int, candidates: list[dict]) -> Iterator[tuple[int, int, float]]:
        """Spans that hold: template, first word, share of its grams."""
        grams: dict[tuple[int, int], set[int]] = defaultdict(set)
        start: dict[tuple[int, int], int] = {}
        n = last - first
        for c in candidates:
            number, diagonal = c["template"], c["diagonal"]
            template, k = words[number], known[number].k
            t0, t1 = max(0, -diagonal), min(len(template), n - diagonal)
            own = _slice(found, first + diagonal + t0, first + diagonal + t1)
            key = (number, c["span"])
            for t in range(t0, t1 - k + 1):
                if own[t - t0 : t - t0 + k] == template[t : t + k]:
                    grams[key].add(t)
                    start[key] = min(start.get(key, n), diagonal + t)
        for key, ts in grams.items():
            share = len(ts) / (len(words[key[0]]) - known[key[0]].k + 1)
            if share >= known[key[0]].least:
                yield key[0], start[key], share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for i, j in text_chunks(texts):
                found = _words(texts[i:j])
                candidates = batch.column("found").slice(i, j - i).to_pylist()
                out = []
                for row, own in enumerate(candidates):
                    first, last = int(found.first[row]), int(found.first[row + 1])
                    base, labels, base_labels, score = [], set(), set(), 0.0
                    for number, start, share in spans(found, first, last, own):
                        labels.add(known[number].label)
                        score = max(score, share)
                        if known[number].base:
                            base.append(start)
                            base_labels.add(known[number].label)
                    out.append(
                        (last - first, len(base), min(base, default=None), max(base, default=None),
                         ",".join(sorted(base_labels)), ",".join(sorted(labels)), score)
                    )
                kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *columns], names=RESULT)

    return run


RESULT = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
_RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)


def scan_licenses(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """One row per document: words, places of the base phrases, labels and score.

    ``score`` is the largest share of a template's grams that a span holds, 1 for
    a whole phrase, 0 for none.
    """
    known = templates() if known is None else known
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit("license scan"), text).alias("d2"),
    )
    sizes = sorted({x.k for x in known})
    schema = "doc_id bigint, d1 bigint, d2 bigint, pos bigint, n_words bigint, " + ", ".join(f"h{k} bigint" for k in sizes)
    marks = rows.mapInArrow(_grams(sizes), schema)
    for k in sizes:
        marks = marks.join(F.broadcast(_places(spark, known, k)), f"h{k}", "left")
    hit = F.concat(*[F.coalesce(f"p{k}", F.array()) for k in sizes]).alias("hit")
    any_hit = F.col("pos") < 0
    for k in sizes:
        any_hit = any_hit | F.col(f"p{k}").isNotNull()
    marks = materialize(marks.filter(any_hit).select("doc_id", "d1", "d2", "pos", "n_words", hit))
    hits = marks.filter("pos >= 0").select("d1", "d2", "pos", F.inline("hit"))
    hits = hits.select("d1", "d2", "template", (F.col("pos") - F.col("t")).alias("diagonal"), "t")
    candidates = materialize(_spans(hits, known))
    held = candidates.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("found")), F.lit(0)).alias("all")).first()
    if held["rows"] <= BROADCAST_ROWS and held["all"] <= BROADCAST_DIAGONALS:
        candidates = F.broadcast(candidates)
    verified = rows.join(candidates, ["d1", "d2"]).select("doc_id", "text", "found").mapInArrow(_verify(known), _RESULT)
    other = marks.filter("pos < 0").join(candidates.select("d1", "d2"), ["d1", "d2"], "left_anti")
    nothing = other.select(
        "doc_id",
        "n_words",
        F.lit(0).cast("bigint").alias("n_base"),
        F.lit(None).cast("bigint").alias("first_word"),
        F.lit(None).cast("bigint").alias("last_word"),
        F.lit("").alias("base_labels"),
        F.lit("").alias("labels"),
        F.lit(0.0).alias("score"),
    )
    return verified.unionByName(nothing)
