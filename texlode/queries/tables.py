"""Loads the given tables and the corpus derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from texlode.plans.physical import materialize, spread
from texlode.queries import corpus


class Corpus:
    """Frames derived from the tables of one folder; nothing is read until a frame is used."""

    def __init__(self, spark: SparkSession, folder: str, stored: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.folder = folder
        self.stored = dict(stored or {})

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derive(self, sql: str) -> DataFrame:
        for name in ("documents", "labels"):
            view = f"texlode_{name}"
            frame = self.table(name)
            if name == "documents":
                frame = spread(frame.select("doc_id", "text", "lang", "source"), "doc_id")
            frame.createOrReplaceTempView(view)
            sql = sql.replace(f"FROM {name}", f"FROM {view}").replace(f"JOIN {name}", f"JOIN {view}")
        return self.spark.sql(sql)

    def store(self, name: str) -> DataFrame:
        """Writes a derived corpus once, for queries that read it more than once."""
        if name not in self.stored:
            self.stored[name] = materialize(getattr(self, name))
        return self.stored[name]

    @property
    def documents(self) -> DataFrame:
        return spread(self.table("documents"), "doc_id")

    @property
    def tex(self) -> DataFrame:
        if "tex" in self.stored:
            return self.stored["tex"]
        return _text_once(self._derive(corpus.tex_sql(corpus.SPARK)), "text")

    @property
    def names(self) -> DataFrame:
        """Documents of ``tex`` without their text, which is not derived."""
        if "tex" in self.stored:
            return self.stored["tex"].drop("text")
        return self._derive(f"SELECT {corpus.document_columns(corpus.SPARK)} FROM documents")

    @property
    def xhtml(self) -> DataFrame:
        if "xhtml" in self.stored:
            return self.stored["xhtml"]
        return _text_once(self._derive(corpus.xhtml_sql(corpus.SPARK)), "xhtml")

    @property
    def log_lines(self) -> DataFrame:
        return self._derive(corpus.log_sql(corpus.SPARK))

    @property
    def category_lines(self) -> DataFrame:
        return self._derive(corpus.categories_sql(corpus.SPARK))

    @property
    def bibcode_lines(self) -> DataFrame:
        return self._derive(corpus.bibcodes_sql(corpus.SPARK))

    @property
    def atom(self) -> DataFrame:
        return self._derive(corpus.atom_sql(corpus.SPARK))

    @property
    def sql_dump(self) -> DataFrame:
        return self._derive(corpus.sql_dump_sql(corpus.SPARK))

    @property
    def eqid_list(self) -> DataFrame:
        return self._derive(corpus.eqid_list_sql(corpus.SPARK))

    @property
    def submissions(self) -> DataFrame:
        if "submissions" in self.stored:
            return self.stored["submissions"]
        return _text_once(self._derive(corpus.submissions_sql(corpus.SPARK)), "text")


def _text_once(df: DataFrame, column: str) -> DataFrame:
    """A derived text stands like a stored one: later filters do not derive it again."""
    others = [name for name in df.columns if name != column]
    return df.select(*others, F.explode_outer(F.array(column)).alias(column))


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, so that both engines give one schema."""
    narrow = (T.IntegerType, T.ShortType, T.ByteType)
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, narrow) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
