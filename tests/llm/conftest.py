import random

import pytest

# Names that the operators use inside; tables may have them too.
CLASHING = ("tag", "key", "fp", "n", "id", "cuts", "kept", "slot", "shard", "v", "digest", "content", "row", "text_sha256")


def make_documents(seed=5):
    """Small corpus with nulls, empty and long texts, ties, copies, near copies and shared passages."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    passage = prose(90)
    base = prose(140)
    docs = []
    for i in range(60):
        words = prose(rnd.randint(0, 150))
        if i % 3 == 0:
            words = words + passage[rnd.randint(0, 20) :] + prose(5)
        docs.append((i, rnd.choice([" ", "  ", "\n"]).join(words)))
    for i in range(100, 190):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 5, 9])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        docs.append((i, " ".join(words)))
    docs += [(300 + i, docs[7][1]) for i in range(5)]
    docs += [
        (400, None), (401, ""), (402, " \n\t "), (403, "a" * 3000), (404, "ab" * 1500), (405, "a " * 700),
        (406, "é" * 900), (407, "Word, word! It's we'll 'sample   12½ \U0001f600\r\n" * 40), (408, "x <|endoftext|> y"),
        (409, "a b"), (410, "A  B"), (411, " ".join(prose(6000))), (None, "no id " * 12), (412, docs[3][1].upper()),
        (413, docs[3][1]),
    ]
    # Repeated rows.
    docs += [(20, docs[20][1]), (403, "a" * 3000)]
    return docs


@pytest.fixture(scope="session")
def docs_list():
    return make_documents()


@pytest.fixture(scope="session")
def as_frame(spark):
    """Frame of ``(doc_id, text)`` with clashing other columns."""
    from texlode.llm.workers import reach

    reach(spark)

    def make(rows):
        schema = "doc_id bigint, text string, " + ", ".join(f"{name} string" for name in CLASHING)
        return spark.createDataFrame([(*row, *(["x"] * len(CLASHING))) for row in rows], schema)

    return make


@pytest.fixture(scope="session")
def folder(as_frame, docs_list, spark, tmp_path_factory):
    """Tables with the corpus, as a query reads them."""
    path = tmp_path_factory.mktemp("tables")
    as_frame(docs_list).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(d, int((d or 0) % 4 > 0), 0) for d, _ in docs_list]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="session")
def empty_folder(as_frame, spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    as_frame([]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)
