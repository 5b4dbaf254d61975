"""Licence scan against a plain version and its SQL."""

import random
import re

import duckdb
import pytest

from texlode.llm.license_scan import scan_licenses, template_words
from texlode.llm.licenses import APACHE_NOTICE, GPL_NOTICE, MIT_NOTICE, Template, templates
from texlode.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, known):
    out = []
    for doc, text in docs:
        words = words_of(text)
        base, labels, base_labels, score = [], set(), set(), 0.0
        for t in known:
            own = words_of(t.text)
            grams = {}
            for i in range(len(own) - t.k + 1):
                grams.setdefault(tuple(own[i : i + t.k]), []).append(i)
            diagonals = {}
            for p in range(len(words) - t.k + 1):
                for i in grams.get(tuple(words[p : p + t.k]), []):
                    diagonals.setdefault(p - i, []).append((p, i))
            spans, last = [], None
            for diagonal in sorted(diagonals):
                if last is None or not t.slack or diagonal - last > t.slack:
                    spans.append([])
                spans[-1] += diagonals[diagonal]
                last = diagonal
            for span in spans:
                share = len({i for _, i in span}) / (len(own) - t.k + 1)
                if share >= t.least:
                    labels.add(t.label)
                    score = max(score, share)
                    if t.base:
                        base.append(min(p for p, _ in span))
                        base_labels.add(t.label)
        out.append(
            (doc, len(words), len(base), min(base, default=None), max(base, default=None),
             ",".join(sorted(base_labels)), ",".join(sorted(labels)), score)
        )
    return out


def licensed(seed=4):
    rnd = random.Random(seed)

    def prose(n):
        return " ".join(rnd.choice(["this", "program", "of", "the", "license", "mit", "public", "zebra", "cc", "by"]) for _ in range(n))

    def changed(text, every):
        words = text.split()
        for i in range(0, len(words), every):
            words[i] = rnd.choice(["", "extra word", words[i] + " more", "x"])
        return " ".join(words)

    docs = [
        (1, None), (2, ""), (3, "mit"), (4, "MIT LICENSE"), (5, "Mit-license; the mit License. mit   license"),
        (6, "GNU General Public License, Apache License and CC BY-NC 4.0"), (7, prose(3000)),
        (8, prose(40) + MIT_NOTICE + prose(50)), (9, changed(MIT_NOTICE, 15)), (10, changed(APACHE_NOTICE, 7) + prose(9) + APACHE_NOTICE),
        (11, changed(GPL_NOTICE, 4)), (12, changed(GPL_NOTICE, 3)), (13, MIT_NOTICE[: len(MIT_NOTICE) // 3]),
        (14, "mit license " * 2500), (15, "Permission is hereby granted, " * 900), (16, "mité license mit Élicense ümit license"),
        (17, "apache\x00license general_public_license mit/license"), (None, "mit license"), (None, "apache license"),
        (18, GPL_NOTICE + MIT_NOTICE), (18, GPL_NOTICE + MIT_NOTICE), (18, "bsd license"),
    ]
    docs += [(100 + i, "Copied. " + MIT_NOTICE) for i in range(30)]
    docs += [(200 + i, prose(rnd.randint(0, 60))) for i in range(40)]
    return docs


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_op12(spark, as_frame, tmp_path):
    docs = licensed()
    as_frame(docs).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_license_scan"](spark, str(tmp_path))
    want = plain(docs, templates())
    assert ordered(got.collect()) == ordered(want)
    labels = {d: x for d, *_, x, _ in want}
    assert "mit" in labels[8].split(",") and labels[9] == "mit" and "apache" in labels[10].split(",")
    assert labels[6] == "apache,cc,cc-nc,gpl" and labels[13] == ""
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = db.sql(ORACLE["op12_license_scan"])
    assert ordered(got.select(sql.columns).collect()) == ordered(sql.fetchall())


def test_op12_on_the_other_corpus(spark, folder, docs_list):
    assert ordered(QUERIES["op12_license_scan"](spark, folder).collect()) == ordered(plain(docs_list, templates()))


def test_more_candidates_than_are_broadcast(spark, as_frame, monkeypatch):
    monkeypatch.setattr("texlode.llm.license_scan.BROADCAST_ROWS", 1)
    docs = licensed()
    assert ordered(scan_licenses(as_frame(docs)).collect()) == ordered(plain(docs, templates()))


def test_own_templates(spark, as_frame):
    known = [Template("one", "a b c d", 3, 0.5, 1), Template("two", "q", 1, 1.0, 0, True)]
    docs = [(1, "a b c x"), (2, "b c d"), (3, "Q q a b"), (4, "a b c q b c d")]
    assert ordered(scan_licenses(as_frame(docs), known).collect()) == ordered(plain(docs, known))
    assert template_words(known[0]) == [b"a", b"b", b"c", b"d"]


@pytest.mark.parametrize("name", ["op12_license_scan"])
def test_empty_table(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []
