"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from texlode.llm.clustering import clustered_rows
from texlode.llm.exact_dedup import exact_groups
from texlode.llm.license_scan import scan_licenses
from texlode.llm.licenses import templates
from texlode.llm.near_dedup import near_groups
from texlode.llm.packing import pack_documents
from texlode.llm.quality_classifier import quality_scores
from texlode.llm.quality_rules import (
    COVERED_PERCENT,
    LEAST_WORDS,
    LONGEST_WORDS,
    REPEAT_PERCENT,
    REPEAT_WORDS,
    WINDOW_WORDS,
    repetition,
)
from texlode.llm.sharding import assign_shards
from texlode.llm.substring_dedup import remove_later
from texlode.llm.suffix_dedup import remove_repeats
from texlode.llm.tokens import length_histogram, round_trip_digests, token_counts
from texlode.llm.whitening import whitened_rows
from texlode.llm.workers import reach

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# One vocabulary in two forms: for the library, and as ranks.
PACK_TOKENIZER = "byte_bpe_50k.json"
PACK_RANKS = "byte_bpe_50k.tiktoken"
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
SHARDS, SLOTS = 64, 6553
CENTROIDS, ROUNDS = 16, 3
CONTEXT_LIMITS = [512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(reach(spark), folder)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


@query
def op1_suffix_array_dedup(spark, folder):
    """Bytes of each document without its repeated 400-byte strings, as digest."""
    return remove_repeats(documents(spark, folder), width=400).drop("kept")


@query
def op2_substring_dedup(spark, folder):
    """Words of each document without the windows of 20 that occurred earlier, as digest."""
    return remove_later(documents(spark, folder), width=20).drop("kept", "tag")


ORACLE["op2_substring_dedup"] = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
tokens AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
grams AS (
  SELECT *, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g
  FROM tokens),
flags AS (
  SELECT *, i + 19 <= n AND row_number() OVER (PARTITION BY i + 19 <= n, g ORDER BY doc_id, i) > 1 AS later FROM grams),
covered AS (
  SELECT *, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM flags),
rest AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN rest ON t.doc_id = rest.doc_id
"""


@query
def op3_sharding(spark, folder):
    """Slot and shard of each document among 64 shards."""
    shards = [f"shard-{i:04d}" for i in range(SHARDS)]
    return assign_shards(documents(spark, folder), shards, slots=SLOTS)


# One turn per step: the first free slot (-1) in the order of the shard whose turn it is.
ORACLE["op3_sharding"] = f"""
WITH RECURSIVE shards AS (
  SELECT i,
         ('0x' || substr(md5('offset shard-' || lpad(i::VARCHAR, 4, '0')), 1, 15))::BIGINT % {SLOTS} AS o,
         ('0x' || substr(md5('skip shard-' || lpad(i::VARCHAR, 4, '0')), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS s
  FROM range({SHARDS}) r(i)),
fill(turn, owners) AS (
  SELECT 0::BIGINT, list_resize([]::TINYINT[], {SLOTS}, -1::TINYINT)
  UNION ALL
  SELECT turn + 1, owners[:place] || [(turn % {SHARDS})::TINYINT] || owners[place + 2:]
  FROM (
    SELECT turn, owners, (o + (list_position(list_select(owners, orders), -1::TINYINT) - 1) * s) % {SLOTS} AS place
    FROM (
      SELECT turn, owners, o, s, list_transform(range({SLOTS}), lambda j: (o + j * s) % {SLOTS} + 1) AS orders
      FROM fill JOIN shards ON i = turn % {SHARDS} WHERE turn < {SLOTS}))),
full_table AS (SELECT unnest(owners)::BIGINT AS shard, generate_subscripts(owners, 1) - 1 AS slot FROM fill WHERE turn = {SLOTS}),
placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN full_table USING (slot)
"""


@query
def op4_quality_rules(spark, folder):
    """Base counts of each document and the verdict on its repetition."""
    return repetition(documents(spark, folder)).drop("covered_words", "longest_repeat")


# A repeat of at least n words is a window of n words that occurs twice.
ORACLE["op4_quality_rules"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split_texts AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts),
tokens AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split_texts),
grams AS (
  SELECT doc_id, n, i, word,
         string_agg(word, ' ') OVER (here ROWS BETWEEN CURRENT ROW AND {REPEAT_WORDS - 1} FOLLOWING) AS g_repeat,
         string_agg(word, ' ') OVER (here ROWS BETWEEN CURRENT ROW AND {WINDOW_WORDS - 1} FOLLOWING) AS g_window,
         string_agg(word, ' ') OVER (here ROWS BETWEEN CURRENT ROW AND {LONGEST_WORDS} FOLLOWING) AS g_long
  FROM tokens WINDOW here AS (PARTITION BY doc_id ORDER BY i)),
flags AS (
  SELECT doc_id, i, word,
         i + {REPEAT_WORDS - 1} <= n AND count(*) OVER (PARTITION BY doc_id, i + {REPEAT_WORDS - 1} <= n, g_repeat) > 1 AS f_repeat,
         i + {WINDOW_WORDS - 1} <= n AND count(*) OVER (PARTITION BY doc_id, i + {WINDOW_WORDS - 1} <= n, g_window) > 1 AS f_window,
         i + {LONGEST_WORDS} <= n AND count(*) OVER (PARTITION BY doc_id, i + {LONGEST_WORDS} <= n, g_long) > 1 AS f_long
  FROM grams),
covered AS (
  SELECT doc_id, word, f_long,
         bool_or(f_repeat) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {REPEAT_WORDS - 1} PRECEDING AND CURRENT ROW) AS c_repeat,
         bool_or(f_window) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW_WORDS - 1} PRECEDING AND CURRENT ROW) AS c_window
  FROM flags),
sums AS (
  SELECT doc_id, sum(length(word))::BIGINT AS chars, count(*) FILTER (c_repeat) AS repeat_words,
         count(*) FILTER (c_window) AS window_words, bool_or(f_long) AS long_repeat
  FROM covered GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(chars, 0) AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(window_words, 0) AS n_repeat_words,
         coalesce(repeat_words, 0) AS repeat_words, coalesce(long_repeat, false) AS long_repeat
  FROM split_texts d LEFT JOIN sums ON d.doc_id = sums.doc_id),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * repeat_words <= {COVERED_PERCENT} * n_words AND NOT long_repeat AS kept
FROM judged
"""


@query
def op5_quality_classifier(spark, folder):
    """Quality score of each document, learned from trusted positives and unlabelled text."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality_scores(documents(spark, folder), labels)


@query
def op6_packing(spark, folder):
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack_documents(
        documents(spark, folder),
        vocabulary=public_tokenizers.path(PACK_RANKS),
        tokenizer=public_tokenizers.path(PACK_TOKENIZER),
        end_id=0,
        capacity=1024,
    )


@query
def op7_exact_dedup(spark, folder):
    """Group of equal texts of each document; the largest id stays."""
    return exact_groups(documents(spark, folder), keep_smallest=False)


ORACLE["op7_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op8_minhash_near_dedup(spark, folder):
    """Component of near-duplicate documents, by 5-word shingles and a similarity of 0.85."""
    return near_groups(documents(spark, folder), percent=85)


ORACLE["op8_minhash_near_dedup"] = """
WITH RECURSIVE texts AS (
  SELECT doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
tokens AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
grams AS (
  SELECT doc_id, n, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g
  FROM tokens),
shingles AS (SELECT DISTINCT doc_id, g FROM grams WHERE i + 4 <= n OR (n < 5 AND i = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * m >= 85 * (x.n + y.n - m)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT a, b FROM both_ways UNION SELECT doc_id, b FROM reach JOIN both_ways ON a = other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, least(t.doc_id, coalesce(other, t.doc_id)) AS component_id,
       t.doc_id <= coalesce(other, t.doc_id) AS kept
FROM texts t LEFT JOIN sizes ON t.doc_id = sizes.doc_id LEFT JOIN least ON t.doc_id = least.doc_id
"""


@query
def op9_byte_bpe(spark, folder):
    """Token ids of each document and the bytes decoded from them, as digests."""
    return round_trip_digests(documents(spark, folder), public_tokenizers.path(MULTI_RANKS))


@query
def op10_token_counts(spark, folder):
    """Histogram of encoded lengths with the totals at each length and context limit."""
    counts = token_counts(documents(spark, folder), public_tokenizers.path(PACK_RANKS))
    return length_histogram(counts, CONTEXT_LIMITS)


@query
def op11_embedding_whitening(spark, folder):
    """Each embedding on the 32 leading components of the covariance, at unit variance."""
    return whitened_rows(embeddings(spark, folder), components=32)


@query
def op12_license_scan(spark, folder):
    """Licence phrases and notices in each document."""
    return scan_licenses(documents(spark, folder))


def _license_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + " ".join(text.split()).replace("'", "''") + "'"

    rows = ",\n    ".join(
        f"({i}, '{t.label}', {quoted(t.text)}, {t.k}, {t.least}, {t.slack}, {t.base})" for i, t in enumerate(templates())
    )
    sizes = sorted({t.k for t in templates()})

    def words(text: str) -> str:
        lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    grams = " UNION ALL ".join(
        f"""SELECT doc, i - 1 AS p, {k} AS k, g{k} AS g FROM windows WHERE i + {k} <= n + 1""" for k in sizes
    )
    windows = ", ".join(
        f"string_agg(word, ' ') OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING) AS g{k}"
        for k in sizes
    )
    return f"""
WITH known(template, label, body, k, least, slack, base) AS (VALUES
    {rows}),
template_words AS (SELECT *, {words("body")} AS ws FROM known),
places AS (
  SELECT template, k, t, array_to_string(ws[t + 1:t + k], ' ') AS g
  FROM (SELECT *, unnest(range(len(ws) - k + 1)) AS t FROM template_words)),
texts AS (SELECT row_number() OVER () AS doc, doc_id, {words("coalesce(text, '')")} AS ws FROM documents),
tokens AS (SELECT doc, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM texts),
windows AS (SELECT doc, n, i, {windows} FROM tokens),
grams AS ({grams}),
hits AS (SELECT doc, template, p - t AS diagonal, p, t FROM grams JOIN places USING (k, g)),
diagonals AS (SELECT DISTINCT doc, template, diagonal FROM hits),
steps AS (
  SELECT doc, template, diagonal,
         CASE WHEN slack > 0 AND diagonal - lag(diagonal) OVER (PARTITION BY doc, template ORDER BY diagonal) <= slack
              THEN 0 ELSE 1 END AS new
  FROM diagonals JOIN known USING (template)),
spans AS (
  SELECT doc, template, diagonal, sum(new) OVER (PARTITION BY doc, template ORDER BY diagonal) AS span FROM steps),
shares AS (
  SELECT doc, template, span, min(p) AS start, count(DISTINCT t) / (len(any_value(ws)) - any_value(k) + 1) AS share
  FROM hits JOIN spans USING (doc, template, diagonal) JOIN template_words USING (template)
  GROUP BY doc, template, span),
found AS (
  SELECT doc, start, share, base, label FROM shares JOIN known USING (template) WHERE share >= least),
results AS (
  SELECT doc, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY doc)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN results USING (doc)
"""


ORACLE["op12_license_scan"] = _license_sql()


@query
def op13_centroid_clustering(spark, folder):
    """Cluster of each embedding after three rounds over 16 centroids."""
    return clustered_rows(embeddings(spark, folder), k=CENTROIDS, rounds=ROUNDS)


def _clustering_sql(k: int, rounds: int, dims: int = 64, scale: int = 64) -> str:
    """Rounds written out one after another; vectors and centroids as lists of whole numbers."""
    distance = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = []
    for step in range(rounds + 1):
        steps.append(f"""
distance{step} AS (SELECT row, vec_id, x, cluster, {distance}::BIGINT AS distance FROM vectors CROSS JOIN centroids{step}),
nearest{step} AS (
  SELECT row, any_value(vec_id) AS vec_id, any_value(x) AS x, min(distance) AS distance,
         arg_min(cluster, (distance, cluster)) AS cluster
  FROM distance{step} GROUP BY row),""")
        if step < rounds:
            steps.append(f"""
entries{step} AS (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM nearest{step}),
means{step} AS (
  SELECT cluster, i, sum(v) AS s, count(*) AS n FROM entries{step} GROUP BY cluster, i),
moved{step} AS (
  SELECT cluster, list((CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END)::BIGINT ORDER BY i) AS c
  FROM means{step} GROUP BY cluster),
centroids{step + 1} AS (
  SELECT o.cluster, coalesce(m.c, o.c) AS c FROM centroids{step} o LEFT JOIN moved{step} m ON o.cluster = m.cluster),""")
    return f"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: isfinite(e))) = {dims}),
centroids0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x) - 1)::INTEGER AS cluster, x AS c
  FROM vectors QUALIFY row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x) <= {k}),
{"".join(steps)}
digests AS (
  SELECT cluster, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM centroids{rounds})
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM nearest{rounds} JOIN digests USING (cluster)
"""


ORACLE["op13_centroid_clustering"] = _clustering_sql(CENTROIDS, ROUNDS)
