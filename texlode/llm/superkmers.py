"""Windows that occur more than once, found through super-k-mers.

A window is ``width`` consecutive units (bytes or words) of one document.  Its
minimiser is the k-mer in it with the smallest hash, the leftmost of equals.
Consecutive windows with the same minimiser *position* form a span, which
travels as one packed string to the bucket of the minimiser's hash.  Equal
windows have equal minimisers at equal offsets, so they meet in one bucket.

Only spans whose bucket holds two or more spans are packed.  Equal spans are
merged before they move: one representative, the first in corpus order, stands
for all of them.  A bucket with more different spans than one task should sort
is split: the offset of the minimiser in the window is halved again and again,
and each half goes to the bucket of the units that all its windows share.  At an
offset range of one, that is the window itself, so splitting always ends, and
the number of strings that meet in one task is bounded whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texlode.llm.batches import CHUNK_BYTES, Polynomial, Words, column_bytes, signed, text_chunks
from texlode.plans.physical import materialize, release

# Different strings that one bucket may sort; larger buckets are split.
BUCKET_STRINGS = 16
# Bits of a position in a segment; a longer document is scanned in segments.
_POSITION_BITS = 24

ROW = "doc_id bigint, tag bigint"
SPAN = f"{ROW}, start bigint, n int, a int, key bigint, fp bigint"
PIECE = (
    "bucket bigint, key bigint, fp bigint, pos decimal(38,0), lo int, hi int, "
    "j int, n int, a int, same bigint, body binary"
)


@dataclass(frozen=True)
class Spec:
    """Window ``width`` and minimiser length ``k``, in units."""

    width: int
    k: int
    words: bool

    @property
    def offsets(self) -> int:
        size = 1
        while size < self.width - self.k + 1:
            size *= 2
        return size


def scan(symbols: np.ndarray, ends: np.ndarray, spec: Spec, poly: tuple[Polynomial, Polynomial]):
    """Spans ``(start, n, a, key, fp)`` of concatenated documents that end at ``ends``.

    ``symbols`` are bytes or word hashes.
    """
    width, k = spec.width, spec.k
    reach = width - k + 1
    n = len(symbols)
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if n < width:
        return empty
    first, second = poly
    hashes = first.windows(first.prefix(symbols), k)
    sums = second.prefix(symbols)
    position = np.uint64((1 << _POSITION_BITS) - 1)
    packed = (hashes & ~position) | np.arange(len(hashes), dtype=np.uint64)
    # Sliding minimum: running minima of blocks from both sides.
    blocks = -(-len(packed) // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(packed)] = packed
    square = padded.reshape(blocks, reach)
    left = np.minimum.accumulate(square, axis=1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    best = (np.minimum(right[:windows], left[reach - 1 : reach - 1 + windows]) & position).astype(np.int64)
    starts = np.append(0, ends[:-1])
    edge = np.zeros(windows + 1, dtype=np.int64)
    inside = ends - width >= starts
    np.add.at(edge, starts[inside], 1)
    np.add.at(edge, ends[inside] - width + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:windows]))
    if not len(at):
        return empty
    minimiser = best[at]
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (minimiser[1:] != minimiser[:-1]) | (at[1:] != at[:-1] + 1)
    index = np.flatnonzero(new)
    start = at[index]
    count = np.diff(np.append(index, len(at)))
    p = minimiser[index]
    fp = second.slices(sums, start, start + count - 1 + width)
    return start, count, p - start, hashes[p], fp


def _segments(n: int, width: int) -> Iterator[tuple[int, int]]:
    """Overlapping parts of a long sequence that together hold each window once."""
    size = (1 << _POSITION_BITS) - 1
    step = size - width + 1
    first = 0
    while True:
        yield first, min(n, first + size)
        first += step
        if first + width > n:
            return


def _span_rows(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(11), Polynomial(12)
        word_poly = Polynomial(13) if spec.words else None
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            doc_id = np.asarray(batch.column("doc_id").fill_null(0))
            known = np.asarray(batch.column("doc_id").is_valid())
            tag = np.asarray(batch.column("tag"))
            for i, j in text_chunks(texts, CHUNK_BYTES):
                if spec.words:
                    found = Words(texts[i:j], word_poly)
                    symbols, ends = found.hash, found.first[1:]
                else:
                    symbols = np.frombuffer(b"".join(texts[i:j]), dtype=np.uint8)
                    ends = np.cumsum([len(t) for t in texts[i:j]])
                starts = np.append(0, ends[:-1])
                for lo, hi in _segments(len(symbols), spec.width):
                    cut = np.clip(ends, lo, hi) - lo
                    start, n, a, key, fp = scan(symbols[lo:hi], cut, spec, poly)
                    if not len(start):
                        continue
                    start = start + lo
                    doc = np.searchsorted(ends, start, side="right")
                    row = doc + i
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_id[row], mask=~known[row]),
                            pa.array(tag[row]),
                            pa.array(start - starts[doc]),
                            pa.array(n.astype(np.int32)),
                            pa.array(a.astype(np.int32)),
                            pa.array(signed(key)),
                            pa.array(signed(fp)),
                        ],
                        names=["doc_id", "tag", "start", "n", "a", "key", "fp"],
                    )

    return run


def rows_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, tag, text)``: the tag tells rows with one id and several texts apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("tag"), text.alias("text"))


def spans(docs: DataFrame, spec: Spec) -> DataFrame:
    return rows_of(docs).mapInArrow(_span_rows(spec), SPAN)


def place(doc_id: str | Column = "doc_id", start: str | Column = "start") -> Column:
    """Order of occurrences as one number: document, then start; a null id is first."""
    doc = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("decimal(20,0)")
    return (doc * F.lit(1 << 33).cast("decimal(10,0)") + F.col("start")).cast("decimal(38,0)")


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["tag"] == right["tag"])


def candidates(docs: DataFrame, spec: Spec) -> DataFrame:
    """Spans whose bucket holds another span too, stored.

    ``copies`` is the number of equal spans and ``first`` the place of the first.
    """
    stored = materialize(spans(docs, spec))
    shared = stored.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key")
    # Stored, so that Spark can split the large partitions of hot keys in the joins.
    shared = materialize(shared)
    kept = materialize(stored.join(shared, "key", "left_semi"))
    release(stored, shared)
    merged = kept.groupBy("key", "fp").agg(F.count(F.lit(1)).alias("copies"), F.min(place()).alias("first"))
    merged = materialize(merged)
    marked = materialize(kept.join(merged, ["key", "fp"]))
    release(kept, merged)
    return marked


def representatives(marked: DataFrame) -> DataFrame:
    """First span of each set of equal ones, where its bucket holds different spans."""
    firsts = marked.filter(place() == F.col("first"))
    firsts = firsts.groupBy("key", "fp", "doc_id", "start", "n", "a").agg(F.min("tag").alias("tag"))
    mixed = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key")
    return firsts.join(mixed, "key", "left_semi").withColumn("pos", place())


def _cut(spec: Spec):
    """Packs the representative spans of each document."""
    width = spec.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for text, wanted, pos in zip(
                texts, batch.column("wanted").to_pylist(), batch.column("place").to_pylist(), strict=True
            ):
                units = text.split() if spec.words else text
                out = {name: [] for name in ("bucket", "key", "fp", "j", "n", "a", "same", "body", "pos")}
                for w, at in zip(wanted, pos, strict=True):
                    part = units[w["start"] : w["start"] + w["n"] - 1 + width]
                    out["bucket"].append(w["key"])
                    out["key"].append(w["key"])
                    out["fp"].append(w["fp"])
                    out["j"].append(0)
                    out["n"].append(w["n"])
                    out["a"].append(w["a"])
                    out["same"].append(w["fp"])
                    out["body"].append(b" ".join(part) if spec.words else part)
                    out["pos"].append(at)
                yield _piece_batch(out, [0] * len(wanted), [spec.offsets] * len(wanted))

    return run


def _piece_batch(out: dict[str, list], lo: list[int], hi: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(out["bucket"], pa.int64()),
            pa.array(out["key"], pa.int64()),
            pa.array(out["fp"], pa.int64()),
            pa.array(out["pos"], pa.decimal128(38, 0)),
            pa.array(lo, pa.int32()),
            pa.array(hi, pa.int32()),
            pa.array(out["j"], pa.int32()),
            pa.array(out["n"], pa.int32()),
            pa.array(out["a"], pa.int32()),
            pa.array(out["same"], pa.int64()),
            pa.array(out["body"], pa.binary()),
        ],
        names=["bucket", "key", "fp", "pos", "lo", "hi", "j", "n", "a", "same", "body"],
    )


def pack(docs: DataFrame, firsts: DataFrame, spec: Spec) -> DataFrame:
    """Packed strings of the representative spans; repeated rows pack theirs again."""
    at = firsts.select("doc_id", "tag", "pos", F.struct("start", "n", "a", "key", "fp").alias("w"))
    lists = at.groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("w", "pos")).alias("both")
    )
    lists = lists.select("doc_id", "tag", F.col("both.w").alias("wanted"), F.col("both.pos").alias("place"))
    rows = rows_of(docs)
    joined = rows.join(lists, same_row(rows, lists)).select("text", "wanted", "place")
    return joined.mapInArrow(_cut(spec), PIECE)


def _halves(spec: Spec):
    width = spec.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("bucket", "key", "fp", "j", "n", "a", "same", "body", "pos")}
            los, his = [], []
            for row in batch.to_pylist():
                units = row["body"].split(b" ") if spec.words else row["body"]
                middle = (row["lo"] + row["hi"]) // 2
                a, n = row["a"], row["n"]
                for lo, hi in ((middle, row["hi"]), (row["lo"], middle)):
                    # Windows j0 to j1 have their minimiser at an offset in [lo, hi).
                    j0, j1 = max(0, a - hi + 1), min(n, a - lo + 1)
                    if j0 >= j1:
                        continue
                    core = units[a - lo : a - hi + 1 + width]
                    part = units[j0 : j1 - 1 + width]
                    if spec.words:
                        core, part = b" ".join(core), b" ".join(part)
                    bucket = xxhash.xxh3_64_intdigest(core, (row["bucket"] + lo) & 0xFFFFFFFFFFFFFFFF)
                    same = xxhash.xxh3_64_intdigest(part, a - j0)
                    out["bucket"].append(bucket - (1 << 63))
                    out["same"].append(same - (1 << 63))
                    out["key"].append(row["key"])
                    out["fp"].append(row["fp"])
                    out["pos"].append(Decimal(int(row["pos"]) + j0))
                    out["j"].append(row["j"] + j0)
                    out["n"].append(j1 - j0)
                    out["a"].append(a - j0)
                    out["body"].append(part)
                    los.append(lo)
                    his.append(hi)
            yield _piece_batch(out, los, his)

    return run


FOUND = "key bigint, fp bigint, j int, n int"


def repeated(
    pieces: DataFrame, spec: Spec, compare: Callable, drop_first: bool
) -> DataFrame:
    """Windows ``(key, fp, j, n)`` of representative spans that repeat in their bucket.

    ``compare`` is the bucket's own sorting, a ``mapInArrow`` function over rows
    that are sorted by bucket.  With ``drop_first`` the first of equal windows in
    corpus order is not a repeat.
    """
    found = []
    while True:
        pieces = materialize(pieces)
        # Equal strings of a bucket are settled here; the first of them goes on.
        merged = materialize(
            pieces.groupBy("bucket", "same").agg(F.count(F.lit(1)).alias("_m"), F.min("pos").alias("_first"))
        )
        marked = pieces.join(merged, ["bucket", "same"])
        found.append(marked.filter("pos > _first" if drop_first else "_m > 1").select("key", "fp", "j", "n"))
        sizes = materialize(merged.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
        sized = marked.filter("pos = _first").join(sizes, "bucket")
        small = sized.filter(F.col("_n") <= BUCKET_STRINGS)
        found.append(
            small.select("bucket", "key", "fp", "pos", "j", "n", "a", "body")
            .repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(compare, FOUND)
        )
        large = sized.filter(F.col("_n") > BUCKET_STRINGS).select(*pieces.columns)
        split = materialize(large.mapInArrow(_halves(spec), PIECE))
        if split.isEmpty():
            break
        pieces = split
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


def whole_buckets(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[dict[str, list]]:
    """Rows of bucket-sorted batches as lists of whole buckets with about ``limit`` bytes."""
    held: dict[str, list] | None = None
    size = 0
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        if held is None:
            held = {name: [] for name in columns}
        for i, bucket in enumerate(columns["bucket"]):
            if size >= limit and bucket != held["bucket"][-1]:
                yield held
                held, size = {name: [] for name in columns}, 0
            for name, values in columns.items():
                held[name].append(values[i])
            size += len(columns["body"][i])
    if held and held["bucket"]:
        yield held


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def found_batch(held: dict[str, list], offsets: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    """Runs of flagged windows; those of row ``i`` are at ``offsets[i]`` on, apart from other rows'."""
    first, last = runs(flags)
    row = np.searchsorted(offsets, first, side="right") - 1
    key, fp, j = (np.asarray(held[name], dtype=np.int64) for name in ("key", "fp", "j"))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key[row]),
            pa.array(fp[row]),
            pa.array((j[row] + first - offsets[row]).astype(np.int32)),
            pa.array((last - first).astype(np.int32)),
        ],
        names=["key", "fp", "j", "n"],
    )


def covered(marked: DataFrame, found: DataFrame, spec: Spec, all_of: Column) -> DataFrame:
    """Units to remove of each document: ``cuts``, an array of ``(s, e)``.

    Spans for which ``all_of`` holds are removed whole, of the others the windows
    in ``found``.
    """
    whole = marked.filter(all_of).select(
        "doc_id", "tag", F.col("start").alias("s"), (F.col("start") + F.col("n") - 1 + spec.width).alias("e")
    )
    rest = marked.filter(~all_of).select("doc_id", "tag", "start", "key", "fp")
    part = rest.join(found, ["key", "fp"]).select(
        "doc_id",
        "tag",
        (F.col("start") + F.col("j")).alias("s"),
        (F.col("start") + F.col("j") + F.col("n") - 1 + spec.width).alias("e"),
    )
    return whole.unionByName(part).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))


def union_flags(cuts: list[dict], size: int) -> np.ndarray:
    """True at the units that any cut covers."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, [c["s"] for c in cuts], 1)
    np.add.at(edge, [c["e"] for c in cuts], -1)
    return np.cumsum(edge[:size]) > 0
