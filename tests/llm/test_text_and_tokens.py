"""Rules, classifier, tokens, packing and sharding against plain versions and libraries."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from texlode.llm import batches, quality_classifier, sharding
from texlode.llm.byte_bpe import codec, load_ranks
from texlode.llm.packing import balance
from texlode.llm.queries import CONTEXT_LIMITS, QUERIES
from texlode.llm.tokens import length_histogram, quantiles

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(MULTI), special_tokens={}
    )


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=str)


def sha(data):
    return hashlib.sha256(data).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("as'tredvlmAéß中1½ \n\t\r 　​!.#\U0001f600́"), max_size=40), max_size=6))
def test_encoder_equals_library(texts):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(MULTI), special_tokens={}
    )
    coder = codec(MULTI)
    ids, counts = coder.encode(texts)
    bounds = np.append(0, np.cumsum(counts))
    for text, i, j in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[i:j].tolist() == library.encode_ordinary(text)
        assert coder.decode(ids[i:j], coder.offsets(ids[i:j])) == text.encode()


def test_pattern_is_the_one_that_the_automaton_has():
    assert public_tokenizers.PATTERN == r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@pytest.mark.parametrize("before, after", [("", ""), ("a", "b "), ("1", "2 "), (" ", "  "), ("!", "'s")])
def test_every_code_point_as_the_libraries(library, tokenizer, before, after):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    coders = [(codec(MULTI), library.encode_ordinary), (codec(public_tokenizers.path("byte_bpe_50k.tiktoken")), None)]
    for first in range(0, len(chars), 1 << 16):
        part = chars[first : first + (1 << 16)]
        texts = ["".join(f"{before}{c}{after}" for c in part[i : i + 256]) for i in range(0, len(part), 256)]
        for coder, encode in coders:
            ids, counts = coder.encode(texts)
            bounds = np.append(0, np.cumsum(counts)).tolist()
            if encode:
                want = [encode(text) for text in texts]
            else:
                want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeiotnshrl"), max_size=60), min_size=1, max_size=40))
def test_merges_of_random_letters(texts):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(MULTI), special_tokens={}
    )
    ids, counts = codec(MULTI).encode(texts)
    bounds = np.append(0, np.cumsum(counts)).tolist()
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [library.encode_ordinary(t) for t in texts]


def test_op9(spark, folder, docs_list, library):
    want = []
    for doc, text in docs_list:
        ids = library.encode_ordinary(text or "")
        want.append((doc, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert by_text(QUERIES["op9_byte_bpe"](spark, folder).collect()) == by_text(want)


def test_op4(spark, folder, docs_list):
    want = []
    for doc, text in docs_list:
        text = text or ""
        words = [w for w in text.encode().split()]
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        flags = [False] * len(words)
        for i in range(len(words) - 7):
            if grams[tuple(words[i : i + 8])] > 1:
                flags[i : i + 8] = [True] * 8
        lines = [x for x in text.split("\n") if x.encode().strip()]
        # Longest repeat from each word, by definition.
        longest = [0] * len(words)
        if len(words) < 800:
            for i in range(len(words)):
                for j in range(i + 1, len(words)):
                    n = 0
                    while j + n < len(words) and words[i + n] == words[j + n]:
                        n += 1
                    longest[i], longest[j] = max(longest[i], n), max(longest[j], n)
        covered = [any(longest[k] >= 6 and k + longest[k] > i for k in range(i + 1)) for i in range(len(words))] if len(words) < 800 else []
        failed = len(words) < 20 or 100 * sum(flags) > 30 * len(words)
        kept = not failed and 100 * sum(covered) <= 40 * len(words) and max(longest, default=0) <= 100
        want.append(
            (doc, len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
             len(lines) - len(set(lines)), sum(flags), failed, kept)
        )
    assert by_text(QUERIES["op4_quality_rules"](spark, folder).collect()) == by_text(want)


def test_op6(spark, folder, docs_list, tokenizer):
    rows = QUERIES["op6_packing"](spark, folder).collect()
    sequences = defaultdict(list)
    pieces = Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        padding += 1024 - at if at & (at - 1) else 0
    assert padding < 1024
    for doc, copies in Counter(docs_list).items():
        ids = np.asarray(tokenizer.encode(doc[1] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        own = sorted((k[1], k[2], k[3], n) for k, n in pieces.items() if k[0] == doc[0] and k[4] == len(ids))
        covered = np.zeros(len(ids), dtype=int)
        for start, length, crc, n in own:
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            covered[start : start + length] += n
        assert (covered == copies).all()


def test_balance_evens_out_cost():
    lengths = np.random.default_rng(3).integers(0, 1024, 3000)
    rows = balance(lengths, 1024)
    filled = Counter()
    for _, _, length, sequence, _ in rows:
        filled[sequence] += length
    assert sorted(filled.values())[1:] == [1024] * (len(filled) - 1)
    assert sum(filled.values()) == lengths.sum()


def test_op10(spark, folder, docs_list, tokenizer):
    lengths = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in docs_list if d != 408]
    # The library knows the special token of one text; the histogram counts it as text.
    lengths.append(int(codec(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode(["x <|endoftext|> y"])[1][0]))
    want = []
    for n in {*lengths, *CONTEXT_LIMITS}:
        longer = [x for x in lengths if x >= n]
        want.append((n, lengths.count(n), len(longer), sum(longer), sum(min(x, n) for x in lengths), sum(x <= n for x in lengths)))
    assert by_text(QUERIES["op10_token_counts"](spark, folder).collect()) == by_text(want)


def test_histogram_over_several_parts_and_quantiles(spark):
    lengths = [1, 1, 5, 2000, 2000, 5000, 90000]
    counts = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id bigint, n_tokens bigint")
    rows = {r["length"]: r for r in length_histogram(counts, [1024]).collect()}
    assert rows[1024]["tokens_cut"] == 7 + 4 * 1024 and rows[1024]["docs_from"] == 4
    assert rows[2000]["tokens_from"] == 99000 and rows[90000]["rank_to"] == 7
    assert tuple(quantiles(length_histogram(counts), [0.1, 0.5, 1.0]).first()) == (1, 2000, 90000)


def test_sharding_table_is_fair_and_stable():
    names = [f"shard-{i:04d}" for i in range(64)]
    table = lookup = sharding.lookup_table(names, 6553)
    sizes = Counter(table)
    assert len(sizes) == 64 and max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 6553)
    moved = sum(a != b for a, b in zip(lookup, fewer, strict=True) if a != 63)
    assert moved < 6553 // 10
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 6554)


def test_op3(spark, folder, docs_list):
    table = sharding.lookup_table([f"shard-{i:04d}" for i in range(64)], 6553)
    want = []
    for doc, _ in docs_list:
        key = "" if doc is None else str(doc)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 6553
        want.append((doc, slot, table[slot]))
    assert by_text(QUERIES["op3_sharding"](spark, folder).collect()) == by_text(want)


def test_op5_held_out(spark):
    where = "/root/testdata/sf0.01"
    scored = QUERIES["op5_quality_classifier"](spark, where).toPandas()
    labels = spark.read.parquet(f"{where}/labels.parquet").toPandas()
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert (scored.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in scored.doc_id]).all()
    assert (scored.predicted == (scored.score >= 0.3)).all()
    held = scored[scored.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.9


def test_op5_edge_cases(spark, folder, docs_list):
    rows = QUERIES["op5_quality_classifier"](spark, folder).collect()
    assert len(rows) == len(docs_list)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[400] == scores[401] and all(0 <= s <= 1 for s in scores.values())


def _plain_scores(rows, labels, positives=10**6, unlabelled=10**6):
    """The scores by a plain loop over texts: sample, prior and fit without Spark."""
    texts, polynomial = {}, batches.Polynomial(41)
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append((text or "").encode())
    learnable = [d for d in texts if d is not None and zlib.crc32(str(d).encode()) % 5]
    x_of = {d: [quality_classifier.features([t], polynomial)[0] for t in texts[d]] for d in learnable}
    smallest = {d: x_of[d][texts[d].index(min(texts[d]))] for d in learnable}
    by = sorted(learnable, key=lambda d: (int(batches.mix(np.array([d], dtype=np.uint64))[0]), d))
    good = {d for d, quality, _ in labels if quality == 1}
    p_ids = [d for d in by if d in good][:positives]
    u_ids = by[:unlabelled]
    seen = {*p_ids[::2], *u_ids[::2]}

    def count(first, cuts):
        margins = [first.margin(x[None])[0] for d in learnable if d not in seen for x in x_of[d]]
        return np.array([sum((cuts <= m).sum() == n for m in margins) for n in range(len(cuts) + 1)])

    model = quality_classifier.fit(
        np.array([smallest[d] for d in p_ids]), np.array([smallest[d] for d in u_ids]), count=count
    )
    scores = [float(model.score(quality_classifier.features([(t or "").encode()], polynomial))[0]) for _, t in rows]
    return scores, model.prior


def test_op5_against_plain_version(spark, as_frame, docs_list):
    labels = [(d, int((d or 0) % 4 > 0), 0) for d, _ in docs_list]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want, prior = _plain_scores(docs_list, labels)
    docs = as_frame(docs_list).repartition(3)
    model = quality_classifier.train(docs, frame)
    assert abs(model.prior - prior) < 1e-6
    got = sorted((r.doc_id or -1, r.score) for r in quality_classifier.quality_scores(docs, frame).collect())
    expected = sorted((d or -1, s) for (d, _), s in zip(docs_list, want))
    assert [d for d, _ in got] == [d for d, _ in expected]
    assert np.allclose([s for _, s in got], [s for _, s in expected], atol=1e-3)


def test_op5_prior_counts_documents_beyond_the_sample(spark, as_frame):
    rnd = np.random.default_rng(2)
    word = ["".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(300)]
    good = [(i, " ".join(rnd.choice(word, 60))) for i in range(0, 900, 3)]
    bad = [(i, "$$ ## !! " * 20 + " ".join(rnd.choice(word, 20))) for i in range(900) if i % 3]
    frame = spark.createDataFrame([(d, 1, 0) for d, _ in good[::2]], "doc_id bigint, quality int, toxic int")
    model = quality_classifier.train(as_frame(good + bad).repartition(4), frame, positives=80, unlabelled=40)
    assert abs(model.prior - 1 / 3) < 0.08


def test_fit_warns_of_nothing_when_scores_saturate():
    import warnings

    rnd = np.random.default_rng(1)
    positive = rnd.normal(50, 1, (300, 3)).astype(np.float32)
    mixed = np.concatenate((positive[:20], rnd.normal(-50, 1, (300, 3)))).astype(np.float32)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        model = quality_classifier.fit(positive, mixed)
    assert np.isfinite(model.weights).all() and (model.score(positive) > 0.5).all()


def test_prior_of_mixture():
    rnd = np.random.default_rng(0)
    positive = rnd.normal(2, 1, (4000, 4))
    mixed = np.concatenate((rnd.normal(2, 1, (2800, 4)), rnd.normal(-2, 1, (1200, 4))))
    model = quality_classifier.fit(positive.astype(np.float32), mixed.astype(np.float32))
    assert abs(model.prior - 0.7) < 0.08
    assert (model.score(mixed[:2800]) > 0.5).mean() > 0.95 and (model.score(mixed[2800:]) < 0.5).mean() > 0.95


@pytest.mark.parametrize(
    "name",
    ["op3_sharding", "op4_quality_rules", "op5_quality_classifier", "op6_packing", "op9_byte_bpe", "op10_token_counts"],
)
def test_empty_table(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []


def test_chunks_hold_a_megabyte_at_most():
    """What a worker holds at once is a multiple of a chunk; a longer text is a chunk of its own."""
    texts = [b"x" * 300_000] * 10 + [b"y" * 3_000_000] + [b"z"] * 3
    chunks = list(batches.text_chunks(texts))
    assert [i for i, _ in chunks] == [0, *[j for _, j in chunks[:-1]]] and chunks[-1][1] == len(texts)
    assert all(j - i == 1 or sum(map(len, texts[i:j])) <= 1 << 20 for i, j in chunks)
