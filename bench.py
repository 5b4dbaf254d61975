"""Times the headline queries; prints one JSON line.

The LaTeX corpus is derived from the tables and stored first (``prepare``), so
that each query starts from stored documents, as on a real corpus.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from texlode.plans.physical import drop_materialized
from texlode.queries.library import QUERIES
from texlode.queries.tables import Corpus
from texlode.session import local_session

HEADLINE = (
    "display_equations",
    "doc_segments",
    "inline_equations",
    "eq_env_counts",
    "eq_dict",
    "meq_dict",
    "inline_dict",
    "resume_ids",
    "enumerated_docs",
    "enumerated_inline_docs",
    "equation_objects",
    "equations_json",
    "eq_docs",
    "coverage",
    "mse_status",
    "label_refs",
    "package_top50",
    "corpus_eq_stats",
    "sanitized_docs",
    "strip_latex",
    "brace_groups",
    "expand_inputs",
    "macro_deps",
    "expand_macros",
)


def timed(frame) -> float:
    start = time.perf_counter()
    frame().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, memory=os.environ.get("BENCH_MEMORY", "12g"), app="bench")
    start = time.perf_counter()
    corpus = Corpus(spark, folder)
    for name in ("tex", "xhtml", "submissions"):
        corpus.store(name)
    prepare = time.perf_counter() - start
    stored = dict(corpus.stored)
    n_cores = spark.sparkContext.defaultParallelism
    n_docs = stored["tex"].count()
    megabytes = stored["submissions"].agg(F.sum(F.length("text"))).first()[0] / 1e6
    seconds = {}
    for name in HEADLINE:
        # Each query gets the stored corpus, but no result of another query.
        seconds[name] = round(timed(lambda: QUERIES[name].build(Corpus(spark, folder, stored))), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "prepare": round(prepare, 3),
                "documents": n_docs,
                "equation_objects_docs_per_sec": round(n_docs / seconds["equation_objects"], 1),
                "expand_macros_docs_per_sec": round(n_docs / seconds["expand_macros"], 1),
                "expand_macros_mb": round(megabytes, 1),
                "expand_macros_mb_per_sec": round(megabytes / seconds["expand_macros"], 3),
                "expand_macros_mb_per_sec_and_core": round(megabytes / seconds["expand_macros"] / n_cores, 3),
            }
        )
    )
    drop_materialized()
    spark.stop()


if __name__ == "__main__":
    main()
