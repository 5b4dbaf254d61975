"""Dedup queries against plain versions of their contracts."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from texlode.llm.lyndon import suffix_arrays
from texlode.llm.queries import ORACLE, QUERIES


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=str)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def plain_suffix(docs, width=400):
    seen = Counter()
    for _, text in docs:
        data = (text or "").encode()
        seen.update(data[i : i + width] for i in range(len(data) - width + 1))
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if seen[data[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return out


def plain_windows(docs, width=20):
    first = {}
    split = [(doc, (text or "").encode().split()) for doc, text in docs]
    place = lambda doc, i: (doc is not None, doc or 0, i)
    for doc, words in split:
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            first[key] = min(first.get(key, place(doc, i)), place(doc, i))
    out = []
    for doc, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < place(doc, i):
                gone[i : i + width] = [True] * width
        out.append((doc, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def plain_near(docs, percent):
    sets = []
    for doc, text in docs:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        sets.append((doc, frozenset(grams)))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, a) in enumerate(sets):
        groups.setdefault(root(i), []).append(doc)
    out = []
    for i, (doc, a) in enumerate(sets):
        known = [d for d in groups[root(i)] if d is not None]
        name = (min(known) if known else None) if a else doc
        out.append((doc, len(a), name, doc == name))
    return out


def test_suffix_array_equals_plain_sorting():
    rnd = np.random.default_rng(1)
    strings = [np.append(rnd.integers(1, rnd.integers(2, 5), rnd.integers(0, 50)), 0) for _ in range(200)]
    bounds = np.append(0, np.cumsum([len(s) for s in strings]))
    order = suffix_arrays(np.concatenate(strings), bounds)
    for s, first, last in zip(strings, bounds, bounds[1:], strict=False):
        values = s.tolist()
        assert (order[first:last] - first).tolist() == sorted(range(len(values)), key=lambda i: values[i:])


def test_op1(spark, folder, docs_list):
    got = by_text(QUERIES["op1_suffix_array_dedup"](spark, folder).collect())
    assert got == by_text(plain_suffix(docs_list))


def test_op2(spark, folder, docs_list):
    got = by_text(QUERIES["op2_substring_dedup"](spark, folder).collect())
    assert got == by_text(plain_windows(docs_list))


@pytest.mark.parametrize("strings", [2, 3])
def test_split_buckets_change_nothing(as_frame, docs_list, monkeypatch, strings):
    from texlode.llm import superkmers
    from texlode.llm.substring_dedup import remove_later

    monkeypatch.setattr(superkmers, "BUCKET_STRINGS", strings)
    rows = remove_later(as_frame(docs_list)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert by_text(rows) == by_text(plain_windows(docs_list))


def test_op7(spark, folder, docs_list):
    got = QUERIES["op7_exact_dedup"](spark, folder)
    groups = {}
    for doc, text in docs_list:
        groups.setdefault(text or "", []).append(doc)
    want = []
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        kept = 0
        for doc in sorted(ids, key=lambda d: d != keep):
            want.append((doc, keep, len(ids), doc == keep and not kept, sha(text.encode())))
            kept = 1
    assert by_text(got.collect()) == by_text(want)


def test_op7_hot_contents_are_salted(as_frame, monkeypatch):
    from texlode.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "RANGE_ROWS", 7)
    docs = [(i, "hot" if i % 3 else f"t{i % 40}") for i in range(300)]
    rows = exact_dedup.exact_groups(as_frame(docs), keep_smallest=True).collect()
    first, size = {}, Counter(t for _, t in docs)
    for doc, text in docs:
        first.setdefault(text, doc)
    want = [(d, first[t], size[t], d == first[t], sha(t.encode())) for d, t in docs]
    assert by_text(rows) == by_text(want)
    kept = exact_dedup.drop_copies(as_frame(docs))
    assert kept.columns == as_frame(docs).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())


def test_op7_sql(spark):
    where = "/root/testdata/sf0.001"
    got = QUERIES["op7_exact_dedup"](spark, where)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{where}/documents.parquet'")
    assert by_text(got.collect()) == by_text(duck.execute(ORACLE["op7_exact_dedup"]).fetchall())


def test_op8(spark, folder, docs_list):
    got = by_text(QUERIES["op8_minhash_near_dedup"](spark, folder).collect())
    assert got == by_text(plain_near(docs_list, 85))


def test_op8_long_lists(as_frame, docs_list, monkeypatch):
    from texlode.llm import near_dedup

    monkeypatch.setattr(near_dedup, "SHORT_LIST", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 8)
    got = near_dedup.near_groups(as_frame(docs_list), percent=85).collect()
    assert by_text(got) == by_text(plain_near(docs_list, 85))


def test_op8_finds_long_contained_pairs_at_the_limit(as_frame):
    """Of 400 isolated pairs, one text is the other with a fifth cut off: none may be lost."""
    from texlode.llm.near_dedup import near_groups

    docs = []
    for i in range(400):
        words = [f"{i}w{j}" for j in range(1004)]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:804]))]
    rows = near_groups(as_frame(docs), percent=80).collect()
    assert len(rows) == 800
    assert [r["doc_id"] for r in rows if r["component_id"] != r["doc_id"] // 2 * 2] == []


def near_texts(rnd, groups, members, words, changes):
    """Groups of near copies that all share the start of one text."""
    start = [f"s{i}" for i in range(words // 12)]
    docs = []
    for g in range(groups):
        base = start + [f"g{g}w{i}" for i in range(words - len(start))]
        for _ in range(members):
            text = list(base)
            for _ in range(rnd.randint(0, changes)):
                text[rnd.randrange(len(start), words)] = f"x{rnd.random()}"
            docs.append((len(docs), " ".join(text)))
    return docs


@pytest.mark.parametrize("block_bytes", [1 << 22, 20_000])
def test_op8_long_lists_of_long_texts(as_frame, monkeypatch, block_bytes):
    """Sets of over 512 shingles, many of them in lists that stay open."""
    import random

    from texlode.llm import near_dedup

    monkeypatch.setattr(near_dedup, "SHORT_LIST", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", block_bytes)
    passed = []
    blocks = near_dedup._in_blocks
    monkeypatch.setattr(near_dedup, "_in_blocks", lambda *a: passed.append(blocks(*a)) or passed[-1])
    docs = near_texts(random.Random(1), 12, 20, 700, 40)
    got = near_dedup.near_groups(as_frame(docs), percent=80).collect()
    assert by_text(got) == by_text(plain_near(docs, 80))
    assert passed[0].count() <= 10 * len(docs)


def test_op8_ids_that_are_missing_or_repeated(as_frame):
    from texlode.llm.near_dedup import drop_near, near_groups

    text = [f"w{i}" for i in range(60)]
    other = [f"o{i}" for i in range(60)]
    only = [f"n{i}" for i in range(60)]
    docs = [
        (1, " ".join(text)), (1, " ".join(other)), (2, " ".join(text + ["end"])), (3, " ".join(other + ["end"])),
        (None, " ".join(text + ["none"])), (None, " ".join(only)), (None, " ".join(only + ["more"])), (4, "apart"),
    ]
    got = near_groups(as_frame(docs), percent=80).collect()
    assert sorted((r.component_id is None, r.component_id or 0, r.n_shingles, r.kept) for r in got) == [
        (False, 1, 56, True), (False, 1, 56, True), (False, 1, 57, False), (False, 1, 57, False), (False, 1, 57, False),
        (False, 4, 1, True), (True, 0, 56, True), (True, 0, 57, True),
    ]
    kept = drop_near(as_frame(docs), percent=80).collect()
    assert len(kept) == 4 and {r.doc_id for r in kept} == {1, 4, None}


def test_sketches_lose_less_than_one_in_a_million():
    from math import comb

    from texlode.llm.near_dedup import K, most_differing

    for percent in (50, 80, 85, 95):
        for k in (16, K, 512):
            most, differ = most_differing(percent, k), 1 - percent / 100
            lost = sum(comb(k, j) * differ**j * (1 - differ) ** (k - j) for j in range(most + 1, k + 1))
            assert lost < 5e-7


@pytest.mark.parametrize("name", ["op1_suffix_array_dedup", "op2_substring_dedup", "op7_exact_dedup", "op8_minhash_near_dedup"])
def test_empty_table(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []


def test_whole_sets_are_compared_without_copies_of_the_batch():
    """A batch of wide sets costs no second copy in the worker, and keeps the pairs at the limit."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from texlode.llm.near_dedup import _exact

    wide = np.arange(4000, dtype=np.uint64)
    sets = [wide.tobytes(), wide[:3200].tobytes(), wide[:3199].tobytes()] * 100
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(300)), pa.array(range(300)), pa.array([wide.tobytes()] * 300, pa.binary()), pa.array(sets, pa.binary())],
        names=["a", "b", "xa", "xb"],
    )
    tracemalloc.start()
    kept = [x for out in _exact(80)(iter([batch])) for x in out.column("a").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept == [i for i in range(300) if i % 3 < 2]
    assert peak < 2_000_000
