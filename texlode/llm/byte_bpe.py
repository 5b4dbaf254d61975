"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation is one pass of an automaton over classes of code points.  Every
code point is a transition function of the automaton's states; blocks of code
points compose theirs side by side, a scan over the blocks (composition is
associative) gives the state at the start of each, and a last pass over all
blocks at once marks the places where a slice starts.  The slices' bytes look up
their token ids in a cache of merged slices.  The byte offset of each token is
kept; decoding puts the tokens' bytes there.
"""

from __future__ import annotations

import base64
import heapq
import sys
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import tiktoken

# Code points that one pass handles; a longer text is a pass of its own.
PASS_CHARS = 1 << 20
# Code points that compose their transitions one after another.
BLOCK = 64
# Slices and their bytes that a task caches before it starts anew.
CACHE_SLICES = 1 << 18
CACHE_BYTES = 1 << 25

# Slices up to this length are merged together, longer ones each on its own.
TOGETHER_BYTES = 64
# No merge.
NO_RANK = 1 << 40

# --- Fixed values: the contractions that are slices ---------------------------
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

# Classes of code points.
LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, SPACE_ON, SPACE_LAST, WHITE_ON, WHITE_LAST = range(9)
# States: what kind of slice the last code point belongs to.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, PREFIX, TWO_LEFT, ONE_LEFT, CLOSED = range(9)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a slice starts here", by class (plus 9 at a text's start) and state."""
    step = np.zeros((18, 9), dtype=np.uint8)
    cut = np.ones((18, 9), dtype=bool)
    for kind, inside in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        step[kind] = inside
        cut[kind, [inside, PREFIX]] = False
    # Letters of a contraction belong to it.
    step[LETTER, TWO_LEFT], step[LETTER, ONE_LEFT] = ONE_LEFT, CLOSED
    cut[LETTER, [TWO_LEFT, ONE_LEFT]] = False
    for kind, opened in ((QUOTE1, ONE_LEFT), (QUOTE2, TWO_LEFT)):
        step[kind] = opened
        step[kind, [IN_OTHERS, PREFIX]] = IN_OTHERS
        cut[kind, [IN_OTHERS, PREFIX]] = False
    for kind in (SPACE_ON, WHITE_ON):
        step[kind] = IN_WHITE
        cut[kind, IN_WHITE] = False
    # The last of a run of white space: a blank joins what follows.
    step[SPACE_LAST] = PREFIX
    step[WHITE_LAST] = CLOSED
    for kind in range(9):
        step[9 + kind] = step[kind, START]
    return step, cut


STEP, CUT = _automaton()


def library_class(pattern: str) -> np.ndarray:
    """Code points that a class of the library's patterns holds.

    The library's version of Unicode decides, not Python's.  An encoding of single
    bytes that knows the class alone gives back just the characters in it.
    """
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, sys.maxunicode + 1))))
    encoding = tiktoken.Encoding(
        "class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}
    )
    found = bytes(encoding.encode_ordinary(every)).decode()
    return np.frombuffer(found.encode("utf-32-le"), dtype="<u4")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter, number, other, blank or white space, for every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    table[library_class(r"\p{L}")] = LETTER
    table[library_class(r"\p{N}")] = NUMBER
    table[library_class(r"\s")] = WHITE_ON
    table[0x20] = SPACE_ON
    return table


def _kinds(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of each code point, with what has to be known of those behind it."""
    kinds = _classes()[codes]
    n = len(codes)
    starts = np.zeros(n + 2, dtype=bool)
    starts[first] = True
    starts[n:] = True
    padded = np.zeros(n + 2, dtype=codes.dtype)
    padded[:n] = codes
    white = kinds >= SPACE_ON
    followed = np.zeros(n, dtype=bool)
    followed[:-1] = ~white[1:]
    followed &= ~starts[1 : n + 1]
    kinds[white & followed] += 1
    quotes = np.flatnonzero((codes == ord("'")) & ~starts[1 : n + 1])
    one, two = padded[quotes + 1], padded[quotes + 2]
    kinds[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = QUOTE1
    both = np.zeros(len(quotes), dtype=bool)
    for a, b in TWO_LETTERS:
        both |= (one == ord(a)) & (two == ord(b))
    kinds[quotes[both & ~starts[quotes + 2]]] = QUOTE2
    kinds[first] += 9
    return kinds


def slice_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where a slice starts in concatenated texts that start at ``first``."""
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kinds = _kinds(codes, first)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, LETTER, dtype=np.int16)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) * 9
    step, cut = STEP.ravel(), CUT.ravel()
    # Transition function of each block.
    function = np.tile(np.arange(9, dtype=np.uint8)[:, None], (1, blocks))
    for column in columns:
        function = step[column + function]
    # Scan: after a round, each block knows the function of twice as many.
    reach = 1
    while reach < blocks:
        later = np.take_along_axis(function[:, reach:], function[:, :-reach], axis=0)
        function = np.concatenate((function[:, :reach], later), axis=1)
        reach *= 2
    state = np.zeros(blocks, dtype=np.uint8)
    state[1:] = function[START, :-1]
    marks = np.empty((BLOCK, blocks), dtype=bool)
    for i, column in enumerate(columns):
        at = column + state
        marks[i] = cut[at]
        state = step[at]
    return np.flatnonzero(marks.T.ravel()[:n])


class Pairs:
    """Rank of every pair of tokens that merges, in an open-addressing table of numpy arrays."""

    BITS = 21

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        values = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))
        self.keys = np.full(1 << self.BITS, -1, dtype=np.int64)
        self.values = np.full(1 << self.BITS, NO_RANK, dtype=np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slot = (slot[~placed] + 1) & ((1 << self.BITS) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NO_RANK`` where it does not merge."""
        keys = left << 32 | right
        slot = self._slot(keys)
        out = np.full(len(keys), NO_RANK, dtype=np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            todo, keys = todo[on], keys[on]
            slot = (slot[on] + 1) & ((1 << self.BITS) - 1)
        return out


class Merges(dict):
    """Slice to the number of its entry; entries hold token ids.

    New slices are merged together: in each round, each slice merges its pair of
    lowest rank wherever it stands, from the left.  That is the order of single
    merges as long as a merge makes no pair of a lower rank than its own next to
    another place of the same pair; the tests compare random text with the library.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.pairs = Pairs(ranks)
        self.single = np.asarray([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.ids = array("I")
        self.begin = array("q")
        self.length = array("q")
        self.held = 0

    def learn(self, slices: list[bytes]) -> None:
        """Adds the entries of slices that are not known."""
        unknown = set(slices).difference(self)
        for long in [x for x in unknown if len(x) > TOGETHER_BYTES]:
            unknown.remove(long)
            self._enter([long], *self.merge_long(long))
        if unknown:
            new = list(unknown)
            self._enter(new, *self.merge(new))

    def _enter(self, new: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        begin = np.cumsum(counts) - counts + len(self.ids)
        self.update(zip(new, range(len(self.begin), len(self.begin) + len(new)), strict=True))
        self.ids.frombytes(ids.astype(np.uint32).tobytes())
        self.begin.frombytes(begin.astype(np.int64).tobytes())
        self.length.frombytes(counts.astype(np.int64).tobytes())
        self.held += sum(map(len, new))

    def merge(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the slices, one after another, and how many each has."""
        size = np.fromiter(map(len, slices), dtype=np.int64, count=len(slices))
        whole = np.fromiter((self.ranks.get(x, -1) for x in slices), dtype=np.int64, count=len(slices))
        done_ids = [whole[whole >= 0]]
        done_owner = [np.flatnonzero(whole >= 0)]
        open_ = np.flatnonzero(whole < 0)
        data = np.frombuffer(b"".join([slices[i] for i in open_]), dtype=np.uint8)
        ids = self.single[data]
        owner = np.repeat(open_, size[open_])
        rank = self._pair_ranks(ids, owner)
        while len(ids):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            length = np.diff(np.append(first, len(ids)))
            lowest = np.minimum.reduceat(rank, first)
            going = lowest < NO_RANK
            if not going.all():
                stay = np.repeat(going, length)
                done_ids.append(ids[~stay])
                done_owner.append(owner[~stay])
                ids, owner, rank = ids[stay], owner[stay], rank[stay]
                lowest, length = lowest[going], length[going]
                if not len(ids):
                    break
            hit = rank == np.repeat(lowest, length)
            # Of a run of overlapping pairs, every second merges.
            place = np.arange(len(ids))
            opens = hit & np.append(True, ~hit[:-1])
            opener = np.maximum.accumulate(np.where(opens, place, 0))
            hit &= (place - opener) % 2 == 0
            at = np.flatnonzero(hit)
            ids[at] = rank[at]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            changed = np.zeros(len(ids), dtype=bool)
            changed[at] = True
            ids, owner, rank, changed = ids[keep], owner[keep], rank[keep], changed[keep]
            changed[:-1] |= changed[1:]
            redo = np.flatnonzero(changed)
            rank[redo] = NO_RANK
            redo = redo[redo < len(ids) - 1]
            redo = redo[owner[redo] == owner[redo + 1]]
            rank[redo] = self.pairs.ranks(ids[redo], ids[redo + 1])
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        by = np.argsort(owner, kind="stable")
        return ids[by], np.bincount(owner, minlength=len(slices))

    def merge_long(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long slice, with a heap of its pairs."""
        ranks = self.ranks
        n = len(piece)
        # Parts are known by their first byte.
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        alive = bytearray(b"\1") * n
        pairs = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(pairs)
        while pairs:
            _, i, end = heapq.heappop(pairs)
            if not alive[i] or after[i] >= end or after[after[i]] != end:
                continue
            alive[after[i]] = 0
            after[i] = end
            before[end] = i
            if end < n and (rank := ranks.get(piece[i : after[end]])) is not None:
                heapq.heappush(pairs, (rank, i, after[end]))
            if i and (rank := ranks.get(piece[before[i] : end])) is not None:
                heapq.heappush(pairs, (rank, before[i], end))
        ids = [ranks[piece[i : after[i]]] for i in range(n) if alive[i]]
        return np.asarray(ids, dtype=np.int64), np.asarray([len(ids)])

    def _pair_ranks(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        rank = np.full(len(ids), NO_RANK, dtype=np.int64)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.pairs.ranks(ids[inner], ids[inner + 1])
        return rank


class Codec:
    """Encodes and decodes texts with the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        size = max(ranks.values()) + 1
        words = [b""] * size
        for word, rank in ranks.items():
            words[rank] = word
        self.word_length = np.fromiter(map(len, words), dtype=np.int64, count=size)
        self.word_start = np.cumsum(self.word_length) - self.word_length
        self.word_bytes = np.frombuffer(b"".join(words), dtype=np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after another, and the number of each text's."""
        merges = self.merges
        if len(merges) > CACHE_SLICES or merges.held > CACHE_BYTES:
            merges.reset()
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        counts = np.zeros(len(texts), dtype=np.int64)
        if not joined:
            return np.zeros(0, dtype=np.uint32), counts
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        text_start = np.cumsum(lengths) - lengths
        start = slice_starts(codes, text_start[lengths > 0])
        if joined.isascii():
            at = start
        else:
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            at = np.append(0, np.cumsum(width))[start]
        data = joined.encode()
        edges = at.tolist()
        edges.append(len(data))
        slices = [data[i:j] for i, j in zip(edges, edges[1:], strict=False)]
        merges.learn(slices)
        entry = np.fromiter(map(merges.__getitem__, slices), dtype=np.int64, count=len(at))
        begin = np.frombuffer(merges.begin, dtype=np.int64)[entry]
        number = np.frombuffer(merges.length, dtype=np.int64)[entry]
        ends = np.cumsum(number)
        places = np.repeat(begin - ends + number, number) + np.arange(ends[-1])
        ids = np.frombuffer(merges.ids, dtype=np.uint32)[places]
        bounds = np.searchsorted(start, np.append(text_start, len(codes)))
        tokens = np.append(0, ends)[bounds]
        return ids, np.diff(tokens)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token, and the length of all."""
        return np.append(0, np.cumsum(self.word_length[ids]))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """Bytes of tokens that stand at these offsets."""
        size = np.diff(offsets)
        source = np.repeat(self.word_start[ids] - offsets[:-1], size) + np.arange(offsets[-1])
        return self.word_bytes[source].tobytes()


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a line has the base64 form of a token and its rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(word): int(rank) for word, rank in pairs}


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each vocabulary in a worker."""
    return Codec(load_ranks(path))


def text_passes(texts: list[str], limit: int = PASS_CHARS):
    """Row ranges with at most ``limit`` code points, or a single row."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        if row > first and size + len(text) > limit:
            yield first, row
            first, size = row, 0
        size += len(text)
    if texts:
        yield first, len(texts)
