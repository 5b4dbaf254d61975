"""Removal of word windows that occurred earlier in the corpus.

Super-k-mer partitioning (``superkmers``): windows that share a minimiser travel
as one packed string to its bucket, where their words are sorted and counted
exactly.  Of equal windows the first in corpus order (smaller ``doc_id``, then
earlier start) stays; the words that any other covers are removed.

Defined results: a null or empty text has no words; of repeated rows (equal id
and text) none is earlier, so both keep what one of them keeps; columns other
than ``doc_id`` and ``text`` are not read; an empty table gives no rows.  A null
``doc_id`` comes before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.llm.batches import column_bytes
from texlode.llm.superkmers import (
    Spec,
    candidates,
    covered,
    found_batch,
    pack,
    place,
    repeated,
    representatives,
    rows_of,
    runs,
    same_row,
    union_flags,
    whole_buckets,
)

# Bytes of packed strings that are sorted at once.
SORT_BYTES = 1 << 21
# Column added for the time of a join; no table has it.
TAG = "texlode substring dedup"


def sort_buckets(held: dict[str, list], width: int) -> pa.RecordBatch:
    """Windows of packed strings that an earlier window of their bucket equals."""
    words = [body.split(b" ") for body in held["body"]]
    lengths = np.fromiter((len(x) for x in words), dtype=np.int64, count=len(words))
    number: dict[bytes, int] = {}
    ids = np.fromiter(
        (number.setdefault(w, len(number)) for w in chain.from_iterable(words)), dtype=np.int32, count=lengths.sum()
    )
    start = np.cumsum(lengths) - lengths
    count = np.asarray(held["n"], dtype=np.int64)
    row = np.repeat(np.arange(len(words)), count)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = start[row] + inside
    windows = ids[at[:, None] + np.arange(width)]
    bucket = np.unique(np.asarray(held["bucket"], dtype=np.int64), return_inverse=True)[1]
    # Places in corpus order, as small numbers; repeated rows share theirs.
    places = np.asarray([int(p) for p in held["pos"]], dtype=object)[row] + inside
    place = np.unique(places, return_inverse=True)[1]
    order = np.lexsort((place, *windows.T[::-1], bucket[row]))
    same = (windows[order[1:]] == windows[order[:-1]]).all(axis=1)
    same &= bucket[row][order[1:]] == bucket[row][order[:-1]]
    head = np.append(True, ~same)
    first = place[order][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = np.zeros(len(order), dtype=bool)
    later[order] = place[order] > first
    flags = np.zeros(lengths.sum() + len(words), dtype=bool)
    # One unit apart, so that runs of two strings never touch.
    flags[at + row] = later
    return found_batch(held, start + np.arange(len(words)), flags)


def _compare(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_buckets(batches, SORT_BYTES):
            yield sort_buckets(held, width)

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, digests, kept = [], [], [], []
        for text, cuts in zip(
            column_bytes(batch.column("text")), batch.column("cuts").to_pylist(), strict=True
        ):
            words = text.split()
            n_words.append(len(words))
            removed = 0
            if cuts:
                flags = union_flags(cuts, len(words))
                removed = int(flags.sum())
                first, last = runs(~flags)
                words = [w for s, e in zip(first.tolist(), last.tolist(), strict=True) for w in words[s:e]]
            rest = b" ".join(words)
            n_removed.append(removed)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("tag"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "tag", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def _later(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, tag, cuts)`` of the documents that lose words."""
    # A shorter minimiser makes fewer and longer spans, but one that is too short repeats by chance.
    spec = Spec(width, width // 3 + 1, words=True)
    marked = candidates(docs, spec)
    pieces = pack(docs, representatives(marked), spec)
    found = repeated(pieces, spec, _compare(width), drop_first=True)
    return covered(marked, found, spec, place() > F.col("first"))


def remove_later(docs: DataFrame, width: int = 20) -> DataFrame:
    """One row per document: its words without those that an earlier equal window covers.

    ``kept`` holds the remaining words, joined by one space.
    """
    cuts = _later(docs, width)
    rows = rows_of(docs)
    joined = rows.join(cuts, same_row(rows, cuts), "left").select(
        rows["doc_id"], rows["tag"], rows["text"], cuts["cuts"]
    )
    return joined.mapInArrow(
        _remove,
        "doc_id bigint, tag bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string",
    )


def without_later(docs: DataFrame, width: int = 20) -> DataFrame:
    """All documents and columns; a text that loses words is the others, joined by one space.

    ``n_chars``, where there is one, follows the text.
    """
    cuts = _later(docs, width)
    tagged = docs.withColumn(TAG, F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    joined = tagged.join(
        cuts, tagged["doc_id"].cast("bigint").eqNullSafe(cuts["doc_id"]) & (tagged[TAG] == cuts["tag"]), "left"
    ).select(*[docs[name] for name in docs.columns], cuts["cuts"].alias(TAG))
    places = {name: i for i, name in enumerate(docs.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            cut = batch.column(len(columns) - 1).to_pylist()
            texts = batch.column(places["text"]).to_pylist()
            for row, spans in enumerate(cut):
                if spans:
                    words = texts[row].encode().split()
                    first, last = runs(~union_flags(spans, len(words)))
                    left = [w for s, e in zip(first.tolist(), last.tolist(), strict=True) for w in words[s:e]]
                    texts[row] = b" ".join(left).decode()
            columns[places["text"]] = pa.array(texts, batch.schema.field(places["text"]).type)
            if "n_chars" in places:
                kind = batch.schema.field(places["n_chars"]).type
                old = batch.column(places["n_chars"]).to_pylist()
                sizes = [len(t) if s else o for t, s, o in zip(texts, cut, old, strict=True)]
                columns[places["n_chars"]] = pa.array(sizes, kind)
            yield pa.RecordBatch.from_arrays(columns[:-1], names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
