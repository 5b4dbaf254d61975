"""Quality rules on repetition inside a document, from suffix arrays over words.

The suffixes of all texts of a batch are sorted by prefix doubling, each text on
its own (a word of one text differs from the same word of another).  Only
suffixes that still share their rank go on to the next round.  Ranks of all
rounds give the longest common prefix of neighbours.  The neighbours' prefixes
are the intervals of the array: the deepest interval a suffix lies in is the
longest substring that starts there and occurs elsewhere in the text.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged alike; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from texlode.llm.batches import Polynomial, Words, column_bytes, mix, text_chunks

SYMBOLS = b"#*$%&|<>"
# Base rule.
LEAST_WORDS = 20
WINDOW_WORDS = 8
REPEAT_PERCENT = 30
# The method's verdict: repeats of so many words count as covered; the covered
# share of the words and the longest repeat are limited.
REPEAT_WORDS = 6
COVERED_PERCENT = 40
LONGEST_WORDS = 100

COLUMNS = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, covered_words bigint, longest_repeat bigint, kept boolean"
)


def repeats(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Longest repeat that starts at each word, and "starts a repeated window"."""
    n = len(words)
    longest = np.zeros(n, dtype=np.int64)
    window = np.zeros(n, dtype=bool)
    if n < 2:
        return longest, window
    document = words.document()
    salt = mix(np.arange(len(words.first) - 1, dtype=np.uint64) + np.uint64(1))
    rank = np.unique(mix(words.hash + salt[document]), return_inverse=True)[1].astype(np.int64)
    end = words.first[1:][document]
    order = np.argsort(rank, kind="stable")
    # Ranks are the places of groups in the order.
    new = np.append(True, rank[order][1:] != rank[order][:-1])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, h = [rank.astype(np.int32)], 1
    shared = ~(new & np.append(new[1:], True))
    while True:
        if h == WINDOW_WORDS:
            window[order[shared]] = True
        at = np.flatnonzero(shared)
        if not len(at):
            break
        suffix = order[at]
        behind = suffix + h
        second = np.where(behind < end[suffix], rank[np.minimum(behind, n - 1)] + 1, 0)
        first = rank[suffix]
        by = np.lexsort((second, first))
        suffix, first, second = suffix[by], first[by], second[by]
        order[at] = suffix
        fresh = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank = rank.copy()
        rank[suffix] = np.maximum.accumulate(np.where(fresh, at, 0))
        shared[at] = ~(fresh & np.append(fresh[1:], True))
        h *= 2
        ranks.append(rank.astype(np.int32))
    a, b = order[:-1].copy(), order[1:].copy()
    left, right = a.copy(), b.copy()
    common = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        # Equal ranks of a round: that many words in common.
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, dtype=bool)
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        step = same * (1 << level)
        common += step
        a += step
        b += step
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest, window


def cover(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """True at the places that the spans cover."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:n]) > 0


def _per_text(words: Words, values: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values))
    return sums[words.first[1:]] - sums[words.first[:-1]]


def _judge(batches: Iterator[pa.RecordBatch], covered_percent: int, longest_words: int) -> Iterator[pa.RecordBatch]:
    for _, judged in _verdicts(batches, covered_percent, longest_words):
        yield judged


def _verdicts(batches: Iterator[pa.RecordBatch], covered_percent: int, longest_words: int):
    """Parts of the batches and the result rows of each."""
    polynomial = Polynomial(21)
    for batch in batches:
        all_texts = column_bytes(batch.column("text"))
        for i, j in text_chunks(all_texts):
            texts = all_texts[i:j]
            words = Words(texts, polynomial)
            n = len(words)
            n_words = np.diff(words.first)
            data = np.frombuffer(words.joined, dtype=np.uint8)
            # Code points of words: bytes that do not continue one.
            heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            word_chars = _per_text(words, heads[words.end] - heads[words.start])
            symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
            dup_lines = []
            for text in texts:
                lines = [line for line in text.split(b"\n") if line.strip()]
                dup_lines.append(len(lines) - len(set(lines)))
            longest, window = repeats(words)
            at = np.flatnonzero(window)
            repeat_words = _per_text(words, cover(at, np.full(len(at), WINDOW_WORDS), n))
            at = np.flatnonzero(longest >= REPEAT_WORDS)
            covered = _per_text(words, cover(at, longest[at], n))
            most = np.zeros(len(texts), dtype=np.int64)
            np.maximum.at(most, words.document(), longest)
            failed = (n_words < LEAST_WORDS) | (100 * repeat_words > REPEAT_PERCENT * n_words)
            kept = ~failed & (100 * covered <= covered_percent * n_words) & (most <= longest_words)
            part = batch.slice(i, j - i)
            yield part, pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n_words),
                    pa.array(word_chars),
                    pa.array(symbols, pa.int64()),
                    pa.array(dup_lines, pa.int64()),
                    pa.array(repeat_words),
                    pa.array(failed),
                    pa.array(covered),
                    pa.array(most),
                    pa.array(kept),
                ],
                names=[part.split()[0] for part in COLUMNS.split(", ")],
            )


def repetition(
    docs: DataFrame, covered_percent: int = COVERED_PERCENT, longest_words: int = LONGEST_WORDS
) -> DataFrame:
    """One row per document: base counts, covered words, longest repeat, and the verdict."""
    return docs.select(docs["doc_id"].cast("bigint"), "text").mapInArrow(
        lambda batches: _judge(batches, covered_percent, longest_words), COLUMNS
    )


def keep_passing(
    docs: DataFrame, covered_percent: int = COVERED_PERCENT, longest_words: int = LONGEST_WORDS
) -> DataFrame:
    """The documents that pass, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, judged in _verdicts(batches, covered_percent, longest_words):
            yield part.filter(judged.column("kept"))

    return docs.mapInArrow(run, docs.schema)
