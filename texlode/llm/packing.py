"""Packs documents into training sequences of balanced attention cost.

The cost of a piece of ``n`` tokens is ``LINEAR * n + QUADRATIC * n * n``.  Full
pieces of a long document are sequences of their own; what is left of each goes,
in descending order of cost, to the cheapest sequence that has room.  A piece
that no sequence has room for is cut: it fills the cheapest one, and the rest
stands in line again by its length.  A group of some thousand sequences is
packed by one task; the number of groups grows with the tokens.  Only the last
sequence of a group can be shorter than its capacity.

Defined results: a null or empty text is a document of the end token alone;
repeated rows are documents of their own; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texlode.llm.tokens import encoded
from texlode.plans.physical import materialize

# Estimated attention cost.
LINEAR = 1.0
QUADRATIC = 1.0 / 512
# Sequences of left-over pieces that one task packs together.
GROUP_SEQUENCES = 2048
# Bits of a sequence's number in its group.
_SEQUENCE_BITS = 36

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def cost(length):
    return LINEAR * length + QUADRATIC * length * length


def balance(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Assigns pieces ``(item, start, length, sequence, offset)``, filling all sequences but one."""
    total = int(lengths.sum())
    if not total:
        return []
    bins = -(-total // capacity)
    room = np.full(bins, capacity, dtype=np.int64)
    room[-1] = total - (bins - 1) * capacity
    spent = np.zeros(bins)
    used = np.zeros(bins, dtype=np.int64)
    line = [(-int(n), i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(line)
    out = []
    while line:
        n, item, start = heapq.heappop(line)
        n = -n
        target = int(np.where(room >= n, spent, np.inf).argmin())
        if room[target] < n:
            target = int(np.where(room > 0, spent, np.inf).argmin())
            rest = n - int(room[target])
            n -= rest
            heapq.heappush(line, (-rest, item, start + n))
        out.append((item, start, n, target, int(used[target])))
        room[target] -= n
        used[target] += n
        spent[target] += cost(n)
    return out


@lru_cache(maxsize=1)
def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, special


def token_rows(docs: DataFrame, vocabulary: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Per document: checksums of its full pieces, and the ids that are left over.

    Texts that spell a special token are encoded by the library, which knows it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, special = _library(tokenizer)
        number = 0
        task = TaskContext.get().partitionId()
        for batch, texts, ids, bounds in encoded(batches, vocabulary):
            tokens, full, rest, spread = [], [], [], []
            for row, text in enumerate(texts):
                if any(token in text for token in special):
                    own = np.asarray(library.encode(text, add_special_tokens=False).ids, dtype="<u4")
                else:
                    own = ids[bounds[row] : bounds[row + 1]]
                own = np.append(own, end_id).astype("<u4")
                cut = len(own) - len(own) % capacity
                tokens.append(len(own))
                full.append([zlib.crc32(own[i : i + capacity].tobytes()) for i in range(0, cut, capacity)])
                rest.append(own[cut:].astype("<u2" if end_id < 1 << 16 and own.max() < 1 << 16 else "<u4").tobytes())
                number += 1
                spread.append(task * 1_000_003 + number)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(tokens, pa.int64()),
                    pa.array(full, pa.list_(pa.int64())),
                    pa.array(rest, pa.binary()),
                    pa.array(spread, pa.int64()),
                ],
                names=["doc_id", "doc_tokens", "full", "rest", "spread"],
            )

    schema = "doc_id bigint, doc_tokens bigint, full array<bigint>, rest binary, spread bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _pack(capacity: int):
    def pack(rows: list[dict], group: int) -> pa.RecordBatch:
        out: dict[str, list] = {name.split()[0]: [] for name in PIECES.split(", ")}

        def add(row, start, length, crc, sequence, offset):
            values = (row["doc_id"], start, length, crc, row["doc_tokens"], (group << _SEQUENCE_BITS) + sequence, offset)
            for name, value in zip(out, values, strict=True):
                out[name].append(value)

        # Ids are two bytes wide unless a document has one that needs four.
        left = [row["doc_tokens"] % capacity for row in rows]
        ids = [
            np.frombuffer(row["rest"], dtype=f"<u{len(row['rest']) // n}") if n else None
            for row, n in zip(rows, left, strict=True)
        ]
        sequence = 0
        for item, start, n, target, offset in balance(np.asarray(left, dtype=np.int64), capacity):
            row = rows[item]
            crc = zlib.crc32(ids[item][start : start + n].astype("<u4").tobytes())
            add(row, len(row["full"]) * capacity + start, n, crc, target, offset)
            sequence = max(sequence, target + 1)
        for row in rows:
            for i, crc in enumerate(row["full"]):
                add(row, i * capacity, capacity, crc, sequence, 0)
                sequence += 1
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out.values()], names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["group"] != held[-1]["group"]:
                    yield pack(held, held[-1]["group"])
                    held = []
                held.append(row)
        if held:
            yield pack(held, held[-1]["group"])

    return run


def pack_documents(
    docs: DataFrame, vocabulary: str, tokenizer: str, end_id: int = 0, capacity: int = 1024
) -> DataFrame:
    """One row per piece of a document: its place there, its sequence and its place in it."""
    rows = materialize(token_rows(docs, vocabulary, tokenizer, end_id, capacity))
    size = rows.agg(
        F.sum(F.col("doc_tokens") % capacity).alias("left"), F.count(F.lit(1)).alias("n")
    ).first()
    # Short documents are many to a sequence, so documents count too.
    groups = max(1, (size["left"] or 0) // (capacity * GROUP_SEQUENCES), size["n"] // (8 * GROUP_SEQUENCES))
    group = F.pmod(F.xxhash64("spread"), F.lit(groups)).alias("group")
    return (
        rows.select("doc_id", "doc_tokens", "full", "rest", group)
        .repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(_pack(capacity), PIECES)
    )
