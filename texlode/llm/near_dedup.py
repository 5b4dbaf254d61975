"""Near duplicates by Jaccard similarity of word shingles, over bottom-k sketches.

One hash function serves all: a document's shingles are hashed, and the ``k``
smallest hashes are its sketch.

1. Documents with equal sets of shingles are one class; only one of each goes on.
2. Inverted lists: a linked pair shares nearly all of its sketches, so that it
   shares one of the rarest few values of each (the prefix filter; rare values
   first).  Values that only one sketch has make no list, but they count as
   rarest, so a document with many of its own has no lists at all.
3. Every list links its members to its first one.  The sketch of the union
   estimates the similarity of each pair; what passes is compared on whole sets.
4. Members of a list that are then still in different components are compared
   with each other: within short lists in pairs of sketches, within long ones in
   blocks of whole sets, bounded in rows and bytes, which pass on no more links
   than join components.  Pairs inside one component need no comparison, since
   only components count.
5. Components of all links found.

Classes have numbers of their own, so neither null nor repeated ids matter to the
comparison; ids come back at the end.

Of a linked pair's union sketch, the number of values that only one side has is
at most binomial.  Estimate and prefix allow as many of them as a pair at the
limit exceeds with a probability below ``MISS`` (``most_differing``), whether one
document contains the other or not; blocks hold whole sets.  So a linked pair is lost with a probability below one in a million;
short documents' sketches are their whole sets, and nothing is lost.

Defined results: a document without words is linked with nothing, not even with
its like; one with fewer words than a shingle has its whole sequence as its only
shingle; repeated rows are members of one class; rows that share an id but not a
text are compared like any others; a document with a null id is linked like any
other but names no component, unless all its members have none; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.llm.batches import Polynomial, Words, column_bytes, text_chunks
from texlode.llm.components import components
from texlode.plans.physical import materialize

K = 64
# Probability of losing a linked pair by its sketches, for the estimate and for the prefix.
MISS = 5e-7
# Lists up to this length are paired, longer ones compared in blocks of about so many rows and bytes.
SHORT_LIST = 64
BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 22
# Values that a block counts at once.
_COLUMNS = 2048
# So many ids are broadcast to find their documents; more are joined by shuffle.
BROADCAST_IDS = 500_000
# Columns of a join; no table has them.
GONE, GONE_TAG = "texlode near dedup", "texlode near dedup tag"
# Pairs that numpy estimates at once.
_PAIRS = 1 << 13
_NONE = np.iinfo(np.uint64).max


def shingle_sets(texts: list[bytes], size: int, polynomials) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after another, and their bounds."""
    by_byte, by_word = polynomials
    words = Words(texts, by_byte, lower=True)
    n = len(words)
    sums = by_word.prefix(words.hash)
    first, last = words.first[:-1], words.first[1:]
    count = last - first
    document = words.document()
    start = np.arange(n)
    inside = start + size <= last[document]
    short = np.flatnonzero((count > 0) & (count < size))
    start = np.append(start[inside], first[short])
    document = np.append(document[inside], short)
    hashes = by_word.slices(sums, start, np.minimum(start + size, last[document]))
    order = np.lexsort((hashes, document))
    hashes, document = hashes[order], document[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1]))[: len(hashes)]
    hashes, document = hashes[new], document[new]
    return hashes, np.searchsorted(document, np.arange(len(texts) + 1))


def _polynomials():
    return Polynomial(31), Polynomial(32)


def _digest(raw: bytes) -> int:
    return xxhash.xxh3_128_intdigest(raw)


def _halves(digests: list[int]) -> list[pa.Array]:
    """Digests as two columns of longs."""
    return [
        pa.array([(d >> 64) - (1 << 63) for d in digests], pa.int64()),
        pa.array([(d & (1 << 64) - 1) - (1 << 63) for d in digests], pa.int64()),
    ]


def _features(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials = _polynomials()
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for i, j in text_chunks(texts):
                hashes, bounds = shingle_sets(texts[i:j], size, polynomials)
                raw = memoryview(hashes.tobytes())
                edges = bounds.tolist()
                digests, sketches = [], []
                for a, b in zip(edges, edges[1:], strict=False):
                    digests.append(_digest(raw[8 * a : 8 * b]))
                    sketches.append(raw[8 * a : 8 * min(b, a + k)].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        batch.column("tag").slice(i, j - i),
                        pa.array(np.diff(bounds)),
                        *_halves(digests),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "tag", "n", "d1", "d2", "sketch"],
                )

    return run


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches = column_bytes(batch.column("sketch"))
        sizes = np.fromiter((len(s) // 8 for s in sketches), dtype=np.int64, count=len(sketches))
        ids = np.repeat(np.asarray(batch.column("id")), sizes)
        values = np.frombuffer(b"".join(sketches), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(values)], names=["id", "v"])


def _matrix(sketches: list[bytes], k: int) -> np.ndarray:
    out = np.full((len(sketches), k), _NONE, dtype=np.uint64)
    for row, sketch in enumerate(sketches):
        out[row, : len(sketch) // 8] = np.frombuffer(sketch, dtype=np.uint64)
    return out


def most_differing(percent: int, k: int) -> int:
    """Values of a union's sketch of ``k`` that one side may lack: more are rarer than ``MISS`` at the limit."""
    differ = 1 - percent / 100
    tail, most = 0.0, k
    while most > 0:
        tail += comb(k, most) * differ**most * (1 - differ) ** (k - most)
        if tail >= MISS:
            break
        most -= 1
    return most


def may_link(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether the union's sketch leaves it possible that pairs of sketches are linked."""
    k = a.shape[1]
    limit = percent / 100
    out = np.zeros(len(a), dtype=bool)
    for i in range(0, len(a), _PAIRS):
        part = slice(i, i + _PAIRS)
        both = np.sort(np.concatenate((a[part], b[part]), axis=1), axis=1)
        real = both != _NONE
        new = np.ones(both.shape, dtype=bool)
        new[:, 1:] = both[:, 1:] != both[:, :-1]
        place = np.cumsum(new & real, axis=1)
        shared = (~new & real & (place <= k)).sum(axis=1)
        union = np.minimum(place[:, -1], k)
        whole = (na[part] <= k) & (nb[part] <= k) & (place[:, -1] <= k)
        out[part] = shared + 1e-9 >= np.where(whole, limit * union, k - most_differing(percent, k))
    return out


def _estimate(percent: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_matrix(column_bytes(batch.column(name)), k) for name in ("sa", "sb"))
            keep = may_link(a, b, np.asarray(batch.column("na")), np.asarray(batch.column("nb")), percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).filter(pa.array(keep)) for name in ("a", "b")], names=["a", "b"]
            )

    return run


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sketches may belong to linked sets."""
    left = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
    return joined.mapInArrow(_estimate(percent, k), "a bigint, b bigint")


def _whole_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials = _polynomials()
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for i, j in text_chunks(texts):
                hashes, bounds = shingle_sets(texts[i:j], size, polynomials)
                raw = hashes.tobytes()
                sets = [raw[8 * a : 8 * b] for a, b in zip(bounds.tolist(), bounds.tolist()[1:], strict=False)]
                digests = [_digest(x) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [*_halves(digests), pa.array(sets, pa.binary())], names=["d1", "d2", "set"]
                )

    return run


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            # Read where they lie: copies of all sets would hold the batch once more.
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).filter(keep) for name in ("a", "b")], names=["a", "b"]
            )

    return run


def _sets_of(ids: DataFrame, corpus: tuple[DataFrame, DataFrame, int]) -> DataFrame:
    """Whole sets ``(id, set)`` of the classes named by ``ids``, stored."""
    docs, classes, size = corpus
    wanted = materialize(classes.join(ids, "id", "left_semi").select("id", "d1", "d2", "first"))
    first = wanted.select("first").distinct()
    if wanted.count() <= BROADCAST_IDS:
        first, wanted = F.broadcast(first), F.broadcast(wanted)
    rows = docs.join(first, docs["doc_id"].eqNullSafe(first["first"]), "left_semi").select("text")
    found = rows.mapInArrow(_whole_sets(size), "d1 bigint, d2 bigint, set binary").join(wanted, ["d1", "d2"])
    # Repeated rows have equal sets; any of them will do.
    return materialize(found.select("id", "set").dropDuplicates(["id"]))


def _linked(pairs: DataFrame, corpus: tuple[DataFrame, DataFrame, int], percent: int) -> DataFrame:
    """Pairs that are linked by their whole sets; ``pairs`` is stored, the result too."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _sets_of(ids, corpus)
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("xa"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("xb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "xa", "xb")
    return materialize(joined.mapInArrow(_exact(percent), "a bigint, b bigint"))


def prefix_length(n, percent: int, k: int = K):
    """Rarest sketch values that lists are made of, for a set of ``n`` shingles."""
    exact = n - F.ceil(n * F.lit(percent) / 100) + 1
    sampled = F.least(n, F.lit(k)) - (k - most_differing(percent, k)) + 1
    # Up to the first bound, every partner's sketch is its whole set, too.
    return F.when(100 * n <= percent * k, exact).when(n <= k, F.greatest(exact, sampled)).otherwise(sampled)


def _lists(reps: DataFrame, percent: int, k: int = K) -> DataFrame:
    """``(v, id, n)``: lists of two or more sketches that have ``v`` among their rarest values."""
    values = materialize(reps.select("id", "sketch").mapInArrow(_values, "id bigint, v bigint"))
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = values.join(counts, "v")
    own = shared.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("shared"))
    held = F.least("n", F.lit(k))
    room = prefix_length(F.col("n"), percent, k) - (held - F.size("shared"))
    rarest = (
        own.join(reps.select("id", "n"), "id")
        .withColumn("room", room)
        .filter("room > 0")
        .select("id", "n", F.explode(F.expr("slice(shared, 1, int(room))")).alias("s"))
        .select(F.col("s.v").alias("v"), "id", "n")
    )
    rarest = materialize(rarest)
    lists = rarest.groupBy("v").agg(
        F.count(F.lit(1)).alias("size"), F.min("id").alias("leader"), F.min(F.struct("id", "n"))["n"].alias("leader_n")
    )
    return materialize(rarest.join(lists.filter("size > 1"), "v"))


def _fit(na, nb, percent: int):
    """Whether sizes allow a link."""
    return (100 * na >= percent * nb) & (100 * nb >= percent * na)


def _shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common values of each left with each right row."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, number, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = df[number] > 1
    rows, number = rows[keep], (np.cumsum(df > 1) - 1)[number[keep]]
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(number, kind="stable")
    rows, number = rows[order], number[order]
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, _COLUMNS):
        i, j = np.searchsorted(number, [first, first + _COLUMNS])
        dense = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        dense[rows[i:j], number[i:j] - first] = 1
        counts += dense[left] @ dense[right].T
    return counts


def _cross(percent: int):
    """Compares the rows of each block pair: sides 0 and 1, or side 0 with itself.

    Of the links found, only those that join components of the block pair are passed on.
    """

    def compare(held):
        ids, comps, ns, sides = (np.asarray(held[name], dtype=np.int64) for name in ("id", "comp", "n", "side"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in held["set"]]
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        if not len(right):
            right = left
        if not len(left):
            return
        shared = _shared_counts(sets, left, right).astype(np.float64)
        na, nb = ns[left][:, None], ns[right][None, :]
        linked = comps[left][:, None] != comps[right][None, :]
        linked &= 100 * shared >= percent * (na + nb - shared)
        x, y = np.nonzero(linked)
        # One link of each row to each component, then a forest of components.
        one = np.unique(np.column_stack((x, comps[right[y]])), axis=0, return_index=True)[1]
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                c = parent[c]
            return c

        pairs = []
        for i, j in zip(left[x[one]].tolist(), right[y[one]].tolist(), strict=True):
            a, b = root(int(comps[i])), root(int(comps[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                pairs.append((int(ids[i]), int(ids[j])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for row in range(batch.num_rows):
                unit = tuple(columns[name][row] for name in ("v", "i", "j"))
                if held and held["unit"] != unit:
                    yield from compare(held)
                    held = {}
                if not held:
                    held = {"unit": unit, "id": [], "comp": [], "n": [], "side": [], "set": []}
                for name in ("id", "comp", "n", "side", "set"):
                    held[name].append(columns[name][row])
        if held:
            yield from compare(held)

    return run


def _in_blocks(long: DataFrame, corpus: tuple[DataFrame, DataFrame, int], percent: int) -> DataFrame:
    """Links in long lists, of members outside the leader's component with all others."""
    sets = _sets_of(long.select("id").distinct(), corpus)
    outside = (F.col("comp") != F.col("leader_comp")).alias("outside")
    marked = long.withColumn("outside", outside)
    # A block is bounded in rows and in bytes.
    weight = F.greatest(F.lit(1 / BLOCK_ROWS), 8 * F.col("n") / BLOCK_BYTES)
    sizes = marked.groupBy("v").agg(
        F.sum(F.when(F.col("outside"), weight).otherwise(0.0)).alias("out"),
        F.sum(F.when(F.col("outside"), 0.0).otherwise(weight)).alias("in"),
    )
    blocks = lambda name: F.ceil(F.col(name)).cast("int")
    sized = marked.join(sizes.filter("out > 0"), "v").select(
        "v", "id", "comp", "n", "outside", blocks("out").alias("ob"), blocks("in").alias("ib")
    )
    place = F.pmod(F.xxhash64("id"), F.when(F.col("outside"), F.col("ob")).otherwise(F.col("ib"))).cast("int")
    sized = sized.withColumn("p", place)
    # Outside blocks i <= j meet as (i, j); inside block m meets outside block i as (i, ob + m).
    rows = sized.filter("outside").select(
        "v", "id", "comp", "n", "p", F.explode(F.sequence(F.lit(0), F.col("ob") + F.col("ib") - 1)).alias("q"), "ob"
    )
    rows = rows.select(
        "v", "id", "comp", "n", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"),
        F.when((F.col("q") < F.col("ob")) & (F.col("p") > F.col("q")), 1).otherwise(0).alias("side"),
    )
    inner = sized.filter(~F.col("outside")).select(
        "v", "id", "comp", "n", F.explode(F.sequence(F.lit(0), F.col("ob") - 1)).alias("i"),
        (F.col("p") + F.col("ob")).alias("j"), F.lit(1).alias("side"),
    )
    units = rows.unionByName(inner).join(sets, "id")
    return (
        units.repartition("v", "i", "j")
        .sortWithinPartitions("v", "i", "j")
        .mapInArrow(_cross(percent), "a bigint, b bigint")
    )


def near_groups(docs: DataFrame, percent: int = 80, size: int = 5, k: int = K) -> DataFrame:
    """One row per document: ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked when ``100 * shared >= percent * union`` of their
    shingles; a component is named by its smallest id, which is the one kept.
    """
    return _groups(docs, percent, size, k).select("doc_id", "n_shingles", "component_id", "kept")


def _groups(docs: DataFrame, percent: int, size: int, k: int = K) -> DataFrame:
    """Rows of ``near_groups`` with the ``tag`` of their text and whether they are of the class that ``stays``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_tag("text").alias("tag"))
    features = materialize(
        rows.mapInArrow(
            _features(size, k), "doc_id bigint, tag bigint, n bigint, d1 bigint, d2 bigint, sketch binary"
        )
    )
    classes = features.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("first"))
    # Stored at once, so that the numbers stay.
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))
    corpus = (rows, classes, size)
    members = materialize(
        features.select("doc_id", "tag", "n", "d1", "d2").join(classes, ["d1", "d2"], "left").drop("d1", "d2")
    )
    reps = features.filter("n > 0").join(classes, ["d1", "d2"]).filter(F.col("doc_id").eqNullSafe(F.col("first")))
    reps = materialize(reps.select("id", "n", "sketch").dropDuplicates(["id"]))
    lists = _lists(reps, percent, k)
    stars = lists.filter((F.col("id") != F.col("leader")) & _fit(F.col("n"), F.col("leader_n"), percent))
    stars = stars.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links = _linked(materialize(_estimated(stars, reps, percent, k)), corpus, percent)
    first = components(links)
    named = first.select("id", F.col("component").alias("comp"))
    lead = first.select(F.col("id").alias("leader"), F.col("component").alias("leader_comp"))
    placed = lists.join(named, "id", "left").join(lead, "leader", "left").select(
        "v", "id", "n", "size",
        F.coalesce("comp", "id").alias("comp"), F.coalesce("leader_comp", "leader").alias("leader_comp"),
    )
    placed = materialize(placed)
    open_lists = placed.filter("comp <> leader_comp").select("v").distinct()
    placed = materialize(placed.join(open_lists, "v", "left_semi"))
    short = placed.filter(F.col("size") <= SHORT_LIST)
    other = short.select("v", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("other"))
    pairs = short.join(other, "v").filter(
        (F.col("id") < F.col("b")) & (F.col("comp") != F.col("other")) & _fit(F.col("n"), F.col("nb"), percent)
    )
    pairs = pairs.select(F.col("id").alias("a"), "b").distinct().join(stars, ["a", "b"], "left_anti")
    more = materialize(_estimated(pairs, reps, percent, k))
    blocks = materialize(_in_blocks(placed.filter(F.col("size") > SHORT_LIST), corpus, percent))
    found = components(links.unionByName(_linked(more, corpus, percent)).unionByName(blocks))
    # Names of the components that links make; a class without links is its own.
    roots = found.select(F.col("component").alias("id"), "component").distinct()
    linked = classes.select("id", "first").join(found.unionByName(roots), "id")
    known = F.when(F.col("first").isNotNull(), F.struct("first", "id"))
    names = linked.groupBy("component").agg(F.min(known).alias("named"), F.min("id").alias("least"))
    names = linked.select("id", "component").join(names, "component").select(
        "id", F.col("named.first").alias("name"), F.coalesce("named.id", "least").alias("keeper")
    )
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(names["id"].isNotNull(), F.col("name")).otherwise(F.col("first"))
    kept = F.col("doc_id").eqNullSafe(component)
    return members.join(names, members["id"] == names["id"], "left").select(
        "doc_id",
        "tag",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        kept.alias("kept"),
        (kept & (F.col("keeper").isNull() | (F.col("keeper") == members["id"]))).alias("stays"),
    )


def text_tag(text: str):
    """Tells rows with one id and several texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def drop_near(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The documents that stay, with all their columns: those with the id and the words that name their component.

    Of a component without ids, one set of words stays.
    """
    groups = materialize(_groups(docs, percent, size))
    gone = groups.filter(~F.col("stays")).select(F.col("doc_id").alias(GONE), F.col("tag").alias(GONE_TAG)).distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    same = docs["doc_id"].cast("bigint").eqNullSafe(gone[GONE]) & (text_tag("text") == gone[GONE_TAG])
    return docs.join(gone, same, "left_anti")
