import json

from pyspark.sql import functions as F

from conftest import body
from texlode.operators import dictionary as D
from texlode.operators import extract as X
from texlode.operators import profile as R
from texlode.sources import readers, writers
from texlode.streaming import incremental as I


def table(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def test_tex_scans(spark, tmp_path):
    put(tmp_path / "src/one/a.tex", b"x\r\ny\xe9\x85z\r")
    put(tmp_path / "src/one/b.txt", "other")
    put(tmp_path / "src/two/c.v1.tex", "c")
    put(tmp_path / "src/.git/d.tex", "hidden")
    one = readers.read_tex(spark, f"{tmp_path}/src/one")
    assert table(one, "dir", "file", "doc_name", "text") == [("one", "one/a.tex", "a", "x\ny\xe9\x85z\n")]
    assert readers.read_tex(spark, f"{tmp_path}/src/one", glob=None).count() == 2
    both = readers.read_tex_parent(spark, f"{tmp_path}/src")
    assert table(both, "dir", "doc_name") == [("one", "a"), ("two", "c.v1")]


def test_names_of_files_stay_out_of_the_driver(spark, tmp_path):
    for n in range(60):
        put(tmp_path / f"src/{n % 3}/{n}.tex", f"text {n}")
    rows = readers.read_tex_parent(spark, f"{tmp_path}/src")
    assert rows.count() == 60
    # What the plan reads is known to the driver: tables of names, not the files.
    assert rows.inputFiles() and not [name for name in rows.inputFiles() if name.endswith(".tex")]
    few, many = spark.sparkContext.defaultParallelism, readers.read_submissions(spark, f"{tmp_path}/src")
    assert many.count() == 60 and many.rdd.getNumPartitions() == few
    assert not [name for name in many.inputFiles() if name.endswith(".tex")]


def test_files_are_found_as_by_spark(spark, tmp_path):
    for name in (
        "r.tex", "_r.tex", ".r.tex", "one/a.tex", "one/_a.tex", "one/b b \xe9%20#.tex", "one/{a,b}.tex", "one/c.txt",
        "one/z.tex.gz", "one/d.tex._COPYING_", "_two/a.tex", "_two/deep/x.TEX", ".git/a.tex", "three/deep/er/y.TeX",
        "three/_h/y.tex", "sp ace/m.tex",
    ):
        put(tmp_path / "src" / name, f"text of {name}")
    put(tmp_path / "src/one/empty.tex", "")
    (tmp_path / "src/nothing").mkdir()
    root = f"{tmp_path}/src"
    for path, glob, recursive in (
        (root, None, True), (root, "*.[tT][eE][xX]", True), (f"{root}/", "{a,r}.tex", True), (f"{root}/one", None, False),
        ([f"{root}/one", f"{root}/sp ace"], "*.tex", False), (f"{root}/one/a.tex", "*.tex", False),
        (f"{root}/o*", "*.tex", False), (f"{root}/nothing", None, True),
    ):
        found = readers.read_files(spark, path, glob, None if recursive else 0)
        assert table(found, "path", "content") == table(readers._files_by_spark(spark, path, glob, recursive), "path", "content")
    below = readers.parse_tex(readers._files_by_spark(spark, f"{root}/[!.]*", "*.tex", False))
    assert table(readers.read_tex_parent(spark, root), "file", "text") == table(below, "file", "text")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{root}")
    assert table(readers.read_tex_parent(spark, "viewfs://store/in"), "doc_name", "text") == table(below, "doc_name", "text")


def test_submission_scan(spark, tmp_path):
    put(tmp_path / "papers/p1/main.tex", "m")
    put(tmp_path / "papers/p1/sub/x.tex", "x")
    rows = readers.read_submissions(spark, f"{tmp_path}/papers")
    assert table(rows, "folder", "rel_path", "text") == [("p1", "main.tex", "m"), ("p1", "sub/x.tex", "x")]


def test_xhtml_scan(spark, tmp_path):
    put(tmp_path / "out/astro_converted/p.xhtml", "<math>é</math>")
    put(tmp_path / "out/astro_converted/p.txt", "no")
    rows = readers.read_xhtml(spark, f"{tmp_path}/out")
    assert table(rows, "dir", "doc_name", "xhtml") == [("astro", "p", "<math>é</math>")]


def test_line_readers(spark, tmp_path):
    put(tmp_path / "cats", "a.tex math.AG extra\nb.tex cs\n\n")
    put(tmp_path / "codes", "a,2015x\nb,2016y\n")
    put(tmp_path / "log", "a.tex: Conversion failed\nTIME (hh:mm:ss): 0:00:01\nplain\n")
    put(tmp_path / "ids", "eqds1q\n\nEQDS2Q\n")
    put(tmp_path / "dump", "one ###x\ny### two ###z###\nthree ###w###\n")
    assert table(readers.read_categories(spark, f"{tmp_path}/cats"), "file", "category") == [
        ("a.tex", "math"), ("b.tex", "cs"),
    ]
    assert table(readers.read_bibcodes(spark, f"{tmp_path}/codes"), "doc_name", "bibcode") == [
        ("a", "2015x"), ("b", "2016y"),
    ]
    assert table(readers.read_log(spark, f"{tmp_path}/log"), "file", "message") == [("a.tex", " Conversion failed")]
    assert table(readers.read_eqid_list(spark, f"{tmp_path}/ids"), "eqid") == [("EQDS2Q",), ("eqds1q",)]
    assert table(readers.read_sql_dump(spark, f"{tmp_path}/dump"), "name", "equation") == [
        ("one", "x\ny"), ("three", "w"), ("two", "z"),
    ]


def test_equation_table_round_trip(spark, docs_of, tmp_path):
    docs = docs_of(body("$$a\tb$$ \\begin{align}x\\\\y \n z\\end{align} $$\\\"o \\n'é'$$"))
    classified = X.classified_equations(docs)
    eqs = D.equation_dictionary(classified)
    meqs = D.multiline_dictionary(classified, eqs)
    writers.write_lines(writers.equation_lines(eqs, meqs), f"{tmp_path}/eqs")
    back = readers.read_equation_table(spark, f"{tmp_path}/eqs")
    both = eqs.select("eqid", F.lit(None).cast("array<string>").alias("sub_ids"), "eq_text").unionByName(
        meqs.select("eqid", "sub_ids", "eq_text")
    )
    key = lambda rows: sorted(rows, key=lambda r: r[0])
    assert key(map(tuple, back.collect())) == key(map(tuple, both.collect()))


def test_equation_json(spark, tmp_path):
    item = {"text": "$$x$$", "type": "latex", "itemtype": "equation", "prevtext": "a", "nexttext": "",
            "file": "p.tex", "index": 1, "pos": 7, "mathml": "<math/>"}
    put(tmp_path / "json/a/p.json", json.dumps([item, item]))
    put(tmp_path / "json/b/q.json", json.dumps([item]))
    assert readers.read_equation_json(spark, f"{tmp_path}/json").filter("pos = 7").count() == 3


def test_equation_json_is_found_in_tasks_and_parsed_as_by_spark(spark, tmp_path):
    item = {"text": "$$x$$é", "type": "latex", "itemtype": "equation", "prevtext": "a\n", "nexttext": "",
            "file": "p.tex", "index": 1, "pos": 7, "mathml": "<math/>"}
    texts = [
        json.dumps([item, item]), json.dumps(item), "[]", "  \n", "{broken", json.dumps([item]) + " more",
        json.dumps([item, None]), "null", json.dumps([item | {"pos": "x"}]), b"\xef\xbb\xbf" + json.dumps([item]).encode(),
        b'[{"text":"\xff"}]', json.dumps([item], indent=2, ensure_ascii=False), '[{"text":"a"},{"text":', "5", "{}",
        json.dumps([{"text": 5, "index": 1.5, "pos": 2**40}]), "[[1]]", json.dumps(item) + "\n" + json.dumps(item), '"x"',
    ]
    for n, text in enumerate(texts):
        put(tmp_path / f"json/{n}/{n}.json", text)
        reader = spark.read.schema(readers.EQUATION_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true")
        want, got = reader.json(f"{tmp_path}/json/{n}"), readers.read_equation_json(spark, f"{tmp_path}/json/{n}")
        assert got.schema == want.schema
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), text
    whole = readers.read_equation_json(spark, f"{tmp_path}/json")
    assert whole.inputFiles() and not [name for name in whole.inputFiles() if name.endswith(".json")]


def test_writers(spark, docs_of, tmp_path):
    docs = docs_of("one", "two")
    writers.write_texts(docs, f"{tmp_path}/texts")
    assert spark.read.parquet(f"{tmp_path}/texts").count() == 2
    rejects = R.bodyless(docs)
    for run in ("a", "b", "a"):
        writers.write_rejects(rejects, f"{tmp_path}/rejects", run)
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 4
    cats = spark.createDataFrame([("a.tex", "math")], "file string, category string")
    writers.write_categories(cats, f"{tmp_path}/cats")
    assert table(readers.read_categories(spark, f"{tmp_path}/cats"), "file") == [("a.tex",)]


STREAM = [body(f"$$x_{i % 5}$$ \\begin{{align}}y_{i}\\\\z\\end{{align}}") + "\\usepackage{p,q}" for i in range(12)]


def test_stream_dictionary_in_two_batches(spark, docs_of, tmp_path):
    docs = docs_of(*STREAM)
    docs.filter("file < 'd/006'").coalesce(1).write.parquet(f"{tmp_path}/in/one")
    path, progress = f"{tmp_path}/dict", f"{tmp_path}/progress"

    def run():
        I.stream_dictionary(
            I.stream_documents(spark, f"{tmp_path}/in/*", 1), path, progress
        ).awaitTermination()
        return table(I.read_dictionary(spark, path), "eqid", "eq_key")

    first = run()
    docs.filter("file >= 'd/006'").coalesce(1).write.parquet(f"{tmp_path}/in/two")
    second = run()
    assert set(first) < set(second)
    whole = D.equation_dictionary(X.classified_equations(docs))
    assert [k for _, k in sorted((k, k) for _, k in second)] == [k for (k,) in table(whole, "eq_key")]
    assert sorted(int(e[4:-1]) for e, _ in second) == list(range(len(second)))
    # A repeated batch leaves the table as it is.
    last = I.read_dictionary(spark, path).agg(F.max("batch")).first()[0]
    I.append_batch(docs.filter("file >= 'd/006'"), last, path)
    assert table(I.read_dictionary(spark, path), "eqid", "eq_key") == second


def test_stream_counts(spark, docs_of, tmp_path):
    docs = docs_of(*STREAM)
    docs.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = I.stream_documents(spark, f"{tmp_path}/in", 1)
    I.stream_counts(stream, I.running_packages, f"{tmp_path}/p", f"{tmp_path}/cp").awaitTermination()
    assert table(I.latest_counts(spark, f"{tmp_path}/p"), "package", "n") == table(
        R.package_frequency(docs), "package", "n"
    )
    I.stream_counts(stream, I.running_environments, f"{tmp_path}/e", f"{tmp_path}/ce").awaitTermination()
    assert table(I.latest_counts(spark, f"{tmp_path}/e"), "env", "n") == [("align", 12), ("dollarsign", 12)]


def test_replayed_counts_change_nothing(spark, docs_of, tmp_path):
    docs = docs_of(*STREAM)
    docs.repartition(3).write.parquet(f"{tmp_path}/in")
    for progress in ("one", "two"):
        stream = I.stream_documents(spark, f"{tmp_path}/in", 1)
        I.stream_counts(stream, I.running_packages, f"{tmp_path}/p", f"{tmp_path}/{progress}").awaitTermination()
    assert table(I.latest_counts(spark, f"{tmp_path}/p"), "package", "n") == [("p", 12), ("q", 12)]


INLINE_STREAM = [body(f"a $x_{i % 4}$ b $y_{i}$ \\begin{{align}}p_{i % 3}\\\\q_{i}\\end{{align}} c") for i in range(12)]


def test_streams_of_inline_and_multiline_dictionaries(spark, docs_of, tmp_path):
    docs = docs_of(*INLINE_STREAM)
    inline, single, multi = (f"{tmp_path}/{kind}" for kind in ("inline", "single", "multi"))
    halves = [docs.filter("file < 'd/006'"), docs.filter("file >= 'd/006'")]

    def grow(batch):
        I.append_inline_batch(halves[batch], batch, inline)
        I.append_multiline_batch(halves[batch], batch, multi, single)
        return (
            table(I.read_dictionary(spark, inline, schema=I.INLINE_SCHEMA), "eqid", "eq_text"),
            table(I.read_dictionary(spark, multi, schema=I.MULTILINE_SCHEMA), "eqid", "sub_ids", "eq_text"),
        )

    first = grow(0)
    second = grow(1)
    assert set(first[0]) < set(second[0]) and len(second[0]) == 16
    assert sorted(int(e[4:-1]) for e, _ in second[0]) == list(range(16))
    # In this order of arrival, ids are those of the dictionaries of the whole corpus.
    classified = X.classified_equations(docs)
    eqs = D.equation_dictionary(classified)
    assert second[0] == table(D.inline_dictionary(X.inline_equations(docs)), "eqid", "eq_text")
    assert second[1] == table(D.multiline_dictionary(classified, eqs), "eqid", "sub_ids", "eq_text")
    # A repeated batch leaves the tables as they are.
    assert grow(1) == second


def test_batches_read_only_the_buckets_of_their_keys(spark, docs_of, tmp_path):
    I.append_inline_batch(docs_of(*INLINE_STREAM), 0, f"{tmp_path}/inline")
    keys = spark.createDataFrame([("$x_1$",), ("$new$",)], "text string")
    whole = I.read_dictionary(spark, f"{tmp_path}/inline", 1, I.INLINE_SCHEMA)
    part = I.touched_buckets(whole, keys, "text")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "$x_1$" in {r.eq_text for r in part.collect()} and part.count() < whole.count()
    I.compact_dictionary(spark, f"{tmp_path}/inline", f"{tmp_path}/compact", I.INLINE_SCHEMA)
    again = I.read_dictionary(spark, f"{tmp_path}/compact", 0, I.INLINE_SCHEMA)
    assert table(again, "eqid", "eq_text") == table(whole, "eqid", "eq_text")


def test_files_are_written_whole_and_again(spark, tmp_path):
    files = spark.createDataFrame(
        [("a/x.tex", bytearray(b"one\r\ntwo")), ("a/b/y.TEX", bytearray(b"\xe9")), ("a/z.txt", bytearray(b""))],
        "path string, content binary",
    )
    for _ in range(2):
        writers.write_files(files, f"file:{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.endswith(".crc")) == [
        "x.tex", "y.TEX", "z.txt",
    ]
    assert table(readers.read_submissions(spark, f"{tmp_path}/out"), "folder", "rel_path", "text") == [
        ("a", "b/y.TEX", "\u00e9"), ("a", "x.tex", "one\ntwo"),
    ]


def test_batches_of_a_stream_do_not_multiply_with_its_files(spark, docs_of, tmp_path):
    docs_of(*STREAM).repartition(3).write.parquet(f"{tmp_path}/few")
    assert I.batch_files(spark, f"{tmp_path}/few") == 4
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 24 * cores, 1, 24 * cores).selectExpr(
        "'d' AS dir", "concat('d/', id, '.tex') AS file", "string(id) AS doc_name", "'' AS text"
    ).write.parquet(f"{tmp_path}/many")
    size = I.batch_files(spark, f"{tmp_path}/many")
    assert size == max(4, 6 * cores)
    seen = []
    I._each_batch(
        I.stream_documents(spark, f"{tmp_path}/many", size), lambda rows, batch: seen.append(rows.count()), f"{tmp_path}/cp"
    ).awaitTermination()
    assert len(seen) == 24 * cores // size and sum(seen) == 24 * cores
    assert I.batch_files(spark, f"{tmp_path}/many", batches=1) == 16 * cores


def test_a_batch_leaves_no_tables_of_its_own(spark, docs_of, tmp_path):
    from texlode.plans import physical

    before = len(physical._written)
    docs = docs_of(*INLINE_STREAM)
    I.append_batch(docs, 0, f"{tmp_path}/single")
    I.append_inline_batch(docs, 0, f"{tmp_path}/inline")
    assert len(physical._written) == before
