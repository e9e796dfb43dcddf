from __future__ import annotations

import io
import lzma
import tarfile

import pytest
from pyspark.sql import functions as F

from conftest import column
from lexmill.functions import patterns as P
from lexmill.operators import stats, tokens
from lexmill.session import checkpoint_root, scratch_path, written
from lexmill.sources import readers, writers
from lexmill.streaming import jobs


def tar(members):
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w") as archive:
        for name, body in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(body)
            archive.addfile(entry, io.BytesIO(body))
    return packed.getvalue()


def test_archives(spark, tmp_path):
    inner = tar([("d/one.txt", b"\n\na\n\n\n\nb\n"), ("two.md", b"no")])
    (tmp_path / "x.tar").write_bytes(tar([("p.xz", lzma.compress(inner)), ("q.txt", b"no")]))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert [tuple(r) for r in readers.expand_archives(files).collect()] == [
        ("p.xz/d/one.txt", "a\n\nb")
    ]


def test_whole_text_and_listing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.xz").write_text("three")
    files = readers.list_files(spark, str(tmp_path))
    assert readers.with_extension(files, ".txt").count() == 1
    assert readers.with_extension(files, ".txt", ".xz").count() == 2
    assert readers.matching_path(files, "*/a.*").count() == 1
    picks = [readers.sample_files(files.repartition(n), 1).first().path for n in (1, 3)]
    assert picks[0] == picks[1]
    whole = readers.read_whole_text(spark, str(tmp_path / "a.txt")).first()
    assert whole.text == "one\ntwo\n" and whole.path.endswith("a.txt")


def test_path_patterns_take_marks_literally(spark):
    df = spark.createDataFrame([("a_b/c",), ("axb/c",), ("a%b/c",)], "path string")
    assert readers.matching_path(df, "a_b/*").count() == 1
    assert readers.matching_path(df, "a%b/?").count() == 1


def test_text_and_token_files(spark, tmp_path):
    df = spark.createDataFrame([("web", "raw", "a"), ("pdf", "clean", "b")],
                               "source string, stage string, text string")
    writers.write_text(df, str(tmp_path / "t"))
    back = spark.read.text(str(tmp_path / "t")).select("source", "stage", "value")
    assert sorted(back.collect()) == sorted(df.collect())
    made = tokens.encode(df, tokens.byte_ranks()).withColumn("src_file", F.col("source"))
    for by_file in (True, False):
        path = str(tmp_path / f"tok{by_file}")
        writers.write_tokens(made, path, by_file)
        back = spark.read.parquet(path).select("source", "tokens")
        assert sorted(back.collect()) == sorted(made.select("source", "tokens").collect())
    files = readers.with_file_name(readers.read_corpus(spark, str(tmp_path / "tokFalse")))
    assert all(r.src_file.endswith(".parquet") for r in files.select("src_file").collect())


def test_columns_are_pruned(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(5).withColumn("text", F.lit("x")).write.parquet(path)
    plan = readers.read_corpus(spark, path, ["id"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_batches_do_not_change_the_result(spark):
    df = spark.range(100)
    double = lambda frame: frame * 2
    found = [
        sorted(r.id for r in readers.in_batches(df, double, "id long", n).collect())
        for n in (1, 7, None)
    ]
    assert found[0] == found[1] == found[2] == list(range(0, 200, 2))


def test_missing_sources(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "source string")
    found = spark.createDataFrame([("a", "text")], "source string, text string")
    filled = readers.fill_missing(expected, found, "source")
    assert column(filled, "text", "source") == ["text", P.MISSING_TEXT]


def test_sql_and_discovery(spark):
    assert readers.discover_text_table(spark, "none_such_*").count() == 0
    spark.range(2).createOrReplaceTempView("seek_a")
    spark.sql("SELECT 'x' AS text, 1 AS n").createOrReplaceTempView("seek_b")
    assert readers.discover_text_table(spark, "seek_*").collect()[0].text == "x"
    assert readers.read_sql(spark, "SELECT text, n FROM seek_b").columns == ["text"]


def test_profile_and_samples(spark):
    df = spark.createDataFrame([(i, "t") for i in range(9)], "id long, t string")
    rows = stats.table_profile(df).orderBy("ordinal").collect()
    assert [(r.column, r.type, r.n_rows) for r in rows] == [("id", "bigint", 9), ("t", "string", 9)]
    described = stats.describe_numeric(df, "id").first()
    assert (described.n, described["mean"], described.q25, described["max"]) == (5, 2.0, 1.0, 4.0)
    assert [r.id for r in stats.first_rows(df, "id", n=2).collect()] == [0, 1]
    assert stats.optional_column(df, "none") is not None
    assert df.select(stats.optional_column(df, "none")).first()[0] is None


def test_scratch_folder(spark):
    root = checkpoint_root(spark)
    assert root == checkpoint_root(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert sorted(r.id for r in written(spark.range(3)).collect()) == [0, 1, 2]


@pytest.fixture
def folder(spark, tmp_path):
    """Documents in three files."""
    path = str(tmp_path / "in")
    rows = [(i, f"Text {i} page {i}. And more", "en" if i % 3 else "de", f"s{i % 2}", i)
            for i in range(30)]
    df = spark.createDataFrame(rows, jobs.SCHEMAS["documents"]).repartition(3)
    df.write.parquet(path)
    return path


def paths(spark):
    return jobs.fresh_paths(spark, "test-stream")


def test_stream_equals_batch(spark, folder):
    def stream():
        return jobs.read_stream(spark, folder, jobs.SCHEMAS["documents"], files_per_trigger=1)

    batch = spark.read.parquet(folder)
    running = jobs.stream_token_stats(stream(), "lang", count="n_chars")
    final = jobs.run_state(running, *paths(spark))
    assert sorted(final.collect()) == sorted(
        stats.token_stats(batch, "lang", count="n_chars").collect()
    )
    made = jobs.run_to_table(
        jobs.stream_clean_tokenize(stream(), tokens.byte_ranks()), *paths(spark)
    )
    expected = jobs.stream_clean_tokenize(batch, tokens.byte_ranks())
    assert sorted(made.collect()) == sorted(expected.collect())
    encoded = tokens.encode(stream(), tokens.byte_ranks())
    cut = jobs.run_to_table(jobs.stream_windows(encoded, 8), *paths(spark))
    assert cut.count() == 30 and all(len(r.x) == 8 for r in cut.collect())


def test_stream_resumes(spark, folder, tmp_path):
    out, checkpoint = paths(spark)

    def run():
        stream = jobs.read_stream(spark, folder, jobs.SCHEMAS["documents"])
        return jobs.run_to_table(stream.select("doc_id"), out, checkpoint)

    assert run().count() == 30
    more = [(99, "new", "en", "s0", 3)]
    spark.createDataFrame(more, jobs.SCHEMAS["documents"]).write.mode("append").parquet(folder)
    assert run().count() == 31


def test_stream_progress(spark, folder):
    stream = jobs.read_stream(spark, folder, jobs.SCHEMAS["documents"], files_per_trigger=1)
    named = stream.select(F.col("source").alias("src_file"), F.col("n_chars").alias("token_count"))
    log = jobs.stream_progress(named, *paths(spark))
    assert log.agg(F.sum("n_rows"), F.sum("n_tokens")).first() == (30, sum(range(30)))
    assert log.select("batch_id").distinct().count() == 3


def test_text_files_hold_every_row(spark, tmp_path):
    texts = ["", None, "a\nb", "a\\nb", "\r\n", "\\", "\\\\n", "\\N", "\\E", " x ", "é" * 50, "same", "same"]
    groups = [("web", "raw"), ("web", "clean"), (None, ""), ("", None), ("\\N", "a/b=c"), ("\\E", "0")]
    rows = [(*g, t, i) for g in groups for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "source string, stage string, text string, file int")
    path = str(tmp_path / "t")
    manifest = writers.write_text(df, path)
    back = writers.read_text(spark, path)
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, back.drop("file").collect()), key=key) == sorted((r[:3] for r in rows), key=key)
    assert len(list((tmp_path / "t").rglob("*.txt"))) == len(groups)
    assert {r.n_texts for r in manifest.collect()} == {len(texts)}
    empty = str(tmp_path / "empty")
    assert writers.write_text(df.limit(0), empty).count() == 0


def test_text_files_are_cut_by_size(spark, tmp_path):
    hot = [("web", "raw", f"{i:05d}" + "x" * 95) for i in range(300)] + [("web", "raw", "y" * 100)] * 200
    df = spark.createDataFrame(hot + [("pdf", "raw", "z")], "source string, stage string, text string")
    manifest = writers.write_text(df, str(tmp_path / "t"), file_chars=4000)
    files = manifest.orderBy("source", "file").collect()
    assert [(f.source, f.file) for f in files] == [("pdf", 0)] + [("web", i) for i in range(len(files) - 1)]
    assert 13 <= len(files) - 1 <= 40 and max(f.n_chars for f in files) <= 4100
    assert len(list((tmp_path / "t").rglob("*.txt"))) == len(files)
    back = writers.read_text(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, back.select("source", "stage", "text").collect())) == sorted(map(tuple, df.collect()))


def test_jdbc_options():
    made = readers.jdbc_options("jdbc:x", "SELECT text, id FROM data; ", "id", 1, 900, 12, user="u")
    assert made == {
        "url": "jdbc:x", "fetchsize": "10000", "dbtable": "(SELECT text, id FROM data) lexmill_query",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "12", "user": "u",
    }
    plain = readers.jdbc_options("jdbc:x", "SELECT text FROM data", fetchsize="5")
    assert plain == {"url": "jdbc:x", "fetchsize": "5", "query": "SELECT text FROM data"}
    assert readers.bounds_query("SELECT * FROM d;", "id") == (
        "SELECT MIN(id) AS least, MAX(id) AS most FROM (SELECT * FROM d) lexmill_query"
    )
    for wrong in ({"lower": 1}, {"column": "id"}, {"column": "id", "lower": 1, "upper": 2, "parts": 0}):
        with pytest.raises(ValueError):
            readers.jdbc_options("jdbc:x", "SELECT 1", **wrong)


def test_sql_column_by_name(spark):
    spark.sql("SELECT 1 AS id, 'x' AS body").createOrReplaceTempView("named_text")
    assert readers.read_sql(spark, "SELECT id, body FROM named_text", text="body").first().text == "x"


def test_running_state_outlives_a_restart(spark, folder):
    out, checkpoint = paths(spark)

    def run():
        stream = jobs.read_stream(spark, folder, jobs.SCHEMAS["documents"], files_per_trigger=1)
        running = jobs.stream_token_stats(stream, "lang", count="n_chars")
        return sorted(map(tuple, jobs.run_state(running, out, checkpoint).collect()))

    first = run()
    assert len(first) == 2 and run() == first == run()
    more = [(99, "new", "fr", "s0", 3)]
    spark.createDataFrame(more, jobs.SCHEMAS["documents"]).write.mode("append").parquet(folder)
    after = run()
    assert len(after) == 3 and set(first) < set(after) and run() == after


def test_running_state_survives_a_torn_snapshot(spark, folder):
    """A snapshot that was begun and not finished is never read."""
    out, checkpoint = paths(spark)
    stream = jobs.read_stream(spark, folder, jobs.SCHEMAS["documents"])
    running = jobs.stream_token_stats(stream, "lang", count="n_chars")
    whole = sorted(map(tuple, jobs.run_state(running, out, checkpoint).collect()))
    last, slot = jobs.committed(spark, out)
    spark.createDataFrame([], running.schema).write.mode("overwrite").parquet(f"{out}/slot={1 - slot}")
    assert sorted(map(tuple, jobs.read_state(spark, out, running.schema).collect())) == whole
    assert jobs.committed(spark, out) == (last, slot)


def test_state_without_input(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = jobs.read_stream(spark, str(tmp_path / "none"), jobs.SCHEMAS["documents"])
    running = jobs.stream_token_stats(stream, "lang", count="n_chars")
    assert jobs.run_state(running, *paths(spark)).count() == 0
    assert jobs.run_spread(stream, lambda b: b.select("doc_id"), *paths(spark)).count() == 0


def test_spread_stream_resumes(spark, folder):
    out, checkpoint = paths(spark)

    def run():
        stream = jobs.read_stream(spark, folder, jobs.SCHEMAS["documents"])
        return jobs.run_spread(stream, lambda b: b.select("doc_id", F.upper("text").alias("t")), out, checkpoint)

    assert run().count() == 30 and run().columns == ["doc_id", "t"]
    more = [(99, "new", "en", "s0", 3)]
    spark.createDataFrame(more, jobs.SCHEMAS["documents"]).write.mode("append").parquet(folder)
    assert run().where("t = 'NEW'").count() == 1 and run().count() == 31


def test_texts_that_fit_in_a_file_are_not_ordered(spark, tmp_path, monkeypatch):
    """Lines are shuffled to their files only; a running sum is for parts larger than a file."""
    plans, real = {}, writers.written

    def spy(df, name="table"):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(writers, "written", spy)
    rows = [("web", "raw", f"{i}") for i in range(50)] + [(None, "raw", None)]
    df = spark.createDataFrame(rows, "source string, stage string, text string")
    manifest = writers.write_text(df, str(tmp_path / "t"))
    assert "Window" not in plans["text"] and "Exchange hashpartitioning" not in plans["text"]
    assert sorted((r.source or "", r.file, r.n_texts) for r in manifest.collect()) == [("", 0, 1), ("web", 0, 50)]
