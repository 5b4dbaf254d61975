import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from texlode.session import local_session

    session = local_session(memory="6g", app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def docs_of(spark):
    """Frame of documents from texts; files are named in order."""

    def make(*texts):
        rows = [("d", f"d/{i:03d}.tex", f"{i:03d}", text) for i, text in enumerate(texts)]
        return spark.createDataFrame(rows, "dir string, file string, doc_name string, text string")

    return make


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one text."""

    def evaluate(build, text):
        frame = spark.createDataFrame([(text,)], "text string")
        return frame.select(build("text").alias("out")).first()["out"]

    return evaluate


def body(text):
    return "\\begin{document}" + text + "\\end{document}"
