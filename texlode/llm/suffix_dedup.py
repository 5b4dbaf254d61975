"""Removal of long byte strings that occur more than once in a corpus.

Candidates come from the super-k-mers of ``superkmers``; the strings of a bucket
are sorted by a suffix array built by linear grouping (``lyndon``), where equal
windows are neighbours, which are compared byte by byte.

Defined results: a null or empty text has no bytes and nothing removed; equal
texts, repeated rows too, remove each other; matches never cross documents;
columns other than ``doc_id`` and ``text`` are not read; an empty table gives no
rows.  A null ``doc_id`` is a document like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from texlode.llm.batches import column_bytes
from texlode.llm.lyndon import suffix_arrays
from texlode.llm.superkmers import (
    BUCKET_STRINGS,
    Spec,
    candidates,
    covered,
    found_batch,
    pack,
    repeated,
    representatives,
    rows_of,
    runs,
    same_row,
    union_flags,
    whole_buckets,
)

# Bytes of packed strings that are sorted in step.
SORT_BYTES = 1 << 22


def _equal_windows(data: bytes, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` have equal bytes, eight at a time."""
    equal = np.zeros(len(a), dtype=bool)
    raw = np.frombuffer(data, dtype=np.uint8)
    eights = np.lib.stride_tricks.as_strided(raw.view(np.uint64) if len(raw) == 8 else raw[:8].view(np.uint64), (len(raw) - 7,), (1,))
    alive = np.arange(len(a))
    for offset in [*range(0, width - 8, 8), width - 8]:
        same = eights[a[alive] + offset] == eights[b[alive] + offset]
        alive = alive[same]
        if not len(alive):
            return equal
    equal[alive] = True
    return equal


def sort_buckets(held: dict[str, list], width: int) -> pa.RecordBatch:
    """Windows of packed strings that another string of their bucket has too."""
    bodies = held["body"]
    bucket = np.asarray(held["bucket"], dtype=np.int64)
    lengths = np.fromiter((len(x) for x in bodies), dtype=np.int64, count=len(bodies))
    joined = b"\0".join(bodies) + b"\0"
    data = np.frombuffer(joined, dtype=np.uint8)
    start = np.cumsum(lengths + 1) - lengths - 1
    new = np.append(True, bucket[1:] != bucket[:-1])
    first = np.flatnonzero(new)
    # Ends of strings are symbols of their own, the last one of a bucket smallest.
    last_row = np.append(first[1:], len(bodies)) - 1
    mark = np.repeat(last_row, np.diff(np.append(first, len(bodies)))) - np.arange(len(bodies))
    symbols = data.astype(np.int64) + int(mark.max()) + 1
    symbols[start + lengths] = mark
    bounds = np.append(start[first], len(data))
    order = suffix_arrays(symbols, bounds)
    # Window starts in suffix order; equal ones are neighbours.
    count = np.asarray(held["n"], dtype=np.int64)
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + count, -1)
    is_window = np.cumsum(edge[:-1]) > 0
    order = order[is_window[order]]
    owner = np.searchsorted(bounds, order, side="right")
    a, b = order[:-1], order[1:]
    near = owner[:-1] == owner[1:]
    a, b = a[near], b[near]
    equal = _equal_windows(joined, a, b, width)
    flags = np.zeros(len(data), dtype=bool)
    flags[a[equal]] = True
    flags[b[equal]] = True
    return found_batch(held, start, flags)


def _compare(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_buckets(batches, SORT_BYTES):
            yield sort_buckets(held, width)

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column_bytes(batch.column("text"))
        n_bytes, n_removed, n_spans, digests, kept = [], [], [], [], []
        for text, cuts in zip(texts, batch.column("cuts").to_pylist(), strict=True):
            rest, removed, spans = text, 0, 0
            if cuts:
                flags = union_flags(cuts, len(text))
                first, last = runs(flags)
                removed, spans = int(flags.sum()), len(first)
                edges = [0, *np.column_stack((first, last)).ravel().tolist(), len(text)]
                rest = b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
            n_bytes.append(len(text))
            n_removed.append(removed)
            n_spans.append(spans)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, width: int = 400) -> DataFrame:
    """One row per document: its bytes without those that a repeated ``width``-byte string covers.

    ``kept`` holds the remaining bytes, which need not be whole UTF-8 characters.
    """
    spec = Spec(width, width // 2, words=False)
    assert spec.width >= 16 and BUCKET_STRINGS >= 2
    marked = candidates(docs, spec)
    pieces = pack(docs, representatives(marked), spec)
    found = repeated(pieces, spec, _compare(width), drop_first=False)
    cuts = covered(marked, found, spec, marked["copies"] > 1)
    rows = rows_of(docs)
    joined = rows.join(cuts, same_row(rows, cuts), "left").select(rows["doc_id"], rows["text"], cuts["cuts"])
    return joined.mapInArrow(
        _remove,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary",
    )
