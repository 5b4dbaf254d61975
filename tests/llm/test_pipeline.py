"""Stages of the pipeline, each against a plain version on its own input."""

import corpus_pipeline
from .test_dedup import plain_near, plain_windows, sha

from texlode.llm.quality_rules import repetition


def run_stage(spark, docs, number, path):
    corpus_pipeline.STAGES[number][1](spark, docs, "").write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "substring_dedup", "packing",
    ]

    ruled = run_stage(spark, docs, 0, tmp_path / "0")
    want = repetition(docs).filter("kept").select("doc_id").collect()
    assert ruled.columns == columns and sorted(map(str, ruled.select("doc_id").collect())) == sorted(map(str, want))

    exact = run_stage(spark, ruled, 1, tmp_path / "1")
    first = {}
    for r in sorted(ruled.collect(), key=lambda r: (r.doc_id is None, r.doc_id)):
        first.setdefault(r.text, r.doc_id)
    assert exact.columns == columns and {r.text: r.doc_id for r in exact.collect()} == first
    assert exact.count() == len(first)

    near = run_stage(spark, exact, 2, tmp_path / "2")
    rows = [(r.doc_id, r.text) for r in exact.collect()]
    kept = {d for d, _, _, stays in plain_near(rows, 80) if stays}
    assert near.columns == columns and {r.doc_id for r in near.collect()} == kept

    cut = run_stage(spark, near, 3, tmp_path / "3")
    rows = [(r.doc_id, r.text) for r in near.collect()]
    want = {d: (n, digest) for d, _, n, digest in plain_windows(rows)}
    before = dict(rows)
    assert cut.columns == columns and cut.count() == len(rows)
    for r in cut.collect():
        if want[r.doc_id][0]:
            assert sha(r.text.encode()) == want[r.doc_id][1]
        else:
            assert r.text == before[r.doc_id]

    packed = run_stage(spark, cut, 4, tmp_path / "4")
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in cut.collect()}


def test_pipeline_runs_on_tables_and_on_none(spark, folder, empty_folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
    assert corpus_pipeline.run(spark, empty_folder).count() == 0
