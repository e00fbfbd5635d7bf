"""Sinks, uploads, versions, SQL scopes, streams and profiles."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import profile as prof
from tablewright.operators import sinks
from tablewright.plans import sql
from tablewright.session import path_exists, shared_dir
from tablewright.sources import uploads
from tablewright.sources.delimited import read_delimited
from tablewright.sources.log import SNAPSHOT_EVERY, RecordLog
from tablewright.sources.uploads import UploadTable
from tablewright.sources.versions import Dataset, normalize_tag, parse_reference
from tablewright.streaming.inserts import insert_rows_stream, insert_uploads_stream
from tablewright.types import schema as declare
from tests.conftest import rows

AB = declare({"a": "integer", "b": "string"})


def frame(spark, *data):
    return spark.createDataFrame(list(data), "a bigint, b string")


# --- uploads


def test_upload_conflicts(spark):
    t = UploadTable(spark, shared_dir(spark, "t"), AB)
    assert t.read().isEmpty() and t.read().columns == ["a", "b"]
    t.upload(frame(spark, (1, "x")), "one")
    with pytest.raises(ValueError, match="is taken"):
        t.upload(frame(spark, (2, "y")), "one")
    with pytest.raises(ValueError, match="excludes"):
        t.upload(frame(spark, (2, "y")), "one", rename_on_conflict=True, replace_on_conflict=True)
    assert t.upload(frame(spark, (2, "y")), "one", if_not_exists=True) == "one"
    assert rows(t.read()) == [(1, "x")]
    assert t.upload(frame(spark, (2, "y")), "one", rename_on_conflict=True) == "one_1"
    t.upload(frame(spark, (3, "z")), "one", replace_on_conflict=True)
    t.upload(frame(spark, (4, "w")), "añ 07%/=.csv")
    assert (4, "w", "añ 07%/=.csv") in rows(t.read(tagged=True))
    t.remove("añ 07%/=.csv")
    assert rows(t.read(tagged=True)) == [(2, "y", "one_1"), (3, "z", "one")]
    t.remove("one_1")
    assert rows(t.read()) == [(3, "z")]
    with pytest.raises(LookupError):
        t.read_upload("one_1")


def test_failed_upload_is_invisible(spark):
    t = UploadTable(spark, shared_dir(spark, "t"), AB)
    broken = frame(spark, (1, "x")).withColumn("a", F.raise_error("no").cast("bigint"))
    with pytest.raises(Exception):
        t.upload(broken, "bad")
    assert t.upload(broken, "bad", raise_on_fail=False, remove_on_fail=True) is None
    assert t.uploads() == []
    t.upload(frame(spark, (1, "x")), "bad")
    assert rows(t.read()) == [(1, "x")]


def test_uploads_of_one_schema_are_one_scan(spark):
    t = UploadTable(spark, shared_dir(spark, "t"), AB)
    for i in range(4):
        t.upload(frame(spark, (i, "x")), f"u{i}")
    assert t.read()._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError):
        UploadTable(spark, "x", merge_strategy="mix")


def test_a_read_takes_one_snapshot_and_few_records(spark):
    log = RecordLog(spark, shared_dir(spark, "log"), lambda state, r: state.update(n=state.get("n", 0) + r["by"]))
    assert log.read() == (0, {})
    for _ in range(100):
        log.commit(lambda state: {"by": 2})
    log.read()
    assert log.read() == (100, {"n": 200}) and log.files_read <= 2
    for k in range(SNAPSHOT_EVERY - 1):
        log.commit(lambda state: {"by": 1})
    assert log.read() == (100 + k + 1, {"n": 200 + k + 1}) and log.files_read == 2 + k + 1
    assert log.commit(lambda state: None) is None and log.read()[0] == 100 + k + 1


def test_a_number_is_taken_once(spark):
    path = shared_dir(spark, "log")

    def add(_):
        for _ in range(15):
            RecordLog(spark, path, lambda state, r: state.update(n=r["n"])).commit(lambda state: {"n": state.get("n", 0) + 1})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(4)))
    assert RecordLog(spark, path, lambda state, r: state.update(n=r["n"])).read() == (60, {"n": 60})


def test_two_writers_of_one_name(spark):
    def go(options, names):
        t = UploadTable(spark, shared_dir(spark, "t"), AB)

        def one(k):
            # the other one comes between this one's question and its commit
            slow = frame(spark, (k, "x")).withColumn("b", F.udf(lambda x: time.sleep(1) or x)("b"))
            try:
                return t.upload(slow, "same", **options)
            except ValueError:
                return "conflict"

        with ThreadPoolExecutor(2) as pool:
            assert sorted(pool.map(one, range(2))) == names
        return t

    t = go({}, ["conflict", "same"])
    assert t.read().count() == 1 and len(t.parts()) == 1
    t = go({"rename_on_conflict": True}, ["same", "same_1"])
    assert sorted(r[2] for r in t.read(tagged=True).collect()) == ["same", "same_1"]
    assert go({"if_not_exists": True}, ["same", "same"]).read().count() == 1
    assert go({"replace_on_conflict": True}, ["same", "same"]).read().count() == 1


def test_small_uploads_are_merged(spark):
    t = UploadTable(spark, shared_dir(spark, "t"), AB)
    for k in range(6):
        t.upload(frame(spark, *[(10 * k + j, f"{j}") for j in range(4)]).coalesce(1), f"u{k}")
    t.upload(spark.createDataFrame([(99, 1.5)], "a bigint, c double"), "other")
    tagged, plain = rows(t.read(tagged=True)), rows(t.read())
    assert t.compact() == 2
    assert rows(t.read(tagged=True)) == tagged and rows(t.read()) == plain
    merged = spark.read.parquet(t.parts()[0]["folder"])
    assert [r["a"] for r in merged.collect()] == [10 * k + j for k in range(6) for j in range(4)]
    assert rows(t.read_upload("u3")) == [(30 + j, f"{j}") for j in range(4)]
    t.upload(frame(spark, (7, "new")), "u2", replace_on_conflict=True)
    t.remove("u5")
    want = sorted([*[r for r in tagged if r[2] not in ("u2", "u5")], (7, "new", "u2")], key=repr)
    assert rows(t.read(tagged=True)) == want
    t.upload(frame(spark, (8, "w")), "last")
    assert t.compact() == 3 and rows(t.read(tagged=True)) == sorted([*want, (8, "w", "last")], key=repr)


def test_a_merge_gives_way_to_a_replaced_upload(spark, monkeypatch):
    t = UploadTable(spark, shared_dir(spark, "t"), AB)
    for k in range(3):
        t.upload(frame(spark, (k, "x")), f"u{k}")
    plain = uploads._in_order

    def replaced(*args):
        t.upload(frame(spark, (9, "y")), "u1", replace_on_conflict=True)
        return plain(*args)

    monkeypatch.setattr(uploads, "_in_order", replaced)
    assert t.compact() == 3 and rows(t.read()) == [(0, "x"), (2, "x"), (9, "y")]


def test_many_batches_leave_few_folders(spark):
    source, state = shared_dir(spark, "s"), shared_dir(spark, "c")
    texts = spark.range(24).select(F.to_json(F.struct(F.col("id").alias("a"), F.lit("x").alias("b"))).alias("value"))
    texts.repartition(24, "value").write.option("maxRecordsPerFile", 1).text(source)
    table = UploadTable(spark, shared_dir(spark, "t"), AB)
    insert_uploads_stream(source, table, "in", state, AB, max_files_per_trigger=1, compact_every=5).awaitTermination()
    assert rows(table.read()) == sorted([(k, "x") for k in range(24)], key=repr)
    assert len(table.uploads()) == 24 and len(table.parts()) <= 5


# --- versions


def test_versions(spark):
    ds = Dataset(spark, shared_dir(spark, "ds"))
    with pytest.raises(LookupError):
        ds.stage("t")
    ds.create_next_version()
    with pytest.raises(ValueError):
        ds.create_next_version()
    ds.create_next_version(if_not_exists=True)
    ds.stage("t").upload(frame(spark, (1, "x")), "u")
    assert rows(ds.read("t", "next")) == [(1, "x")]
    assert ds.release("1.0", ["t"]) == "v1.0"
    ds.create_next_version()
    ds.stage("t").upload(spark.createDataFrame([(2,)], "A int"), "u")
    ds.release("v1_1", ["t"])
    assert ds.versions() == ["v1.0", "v1.1"]
    assert rows(ds.read("t", "v1.0")) == [(1, "x")]
    assert rows(ds.read("t")) == rows(ds.read("t", "1_1")) == [(1, "x"), (2, None)]
    with pytest.raises(LookupError):
        ds.read("t", "next")
    assert ds.unrelease() == "v1.1"
    assert rows(ds.read("t")) == [(1, "x")]
    assert rows(ds.read("t", "next")) == [(1, "x"), (2, None)]
    ds.release("1.1", ["t"])
    with pytest.raises(LookupError):
        ds.read("other")
    ds.create_next_version()
    with pytest.raises(ValueError):
        ds.release("1.1", ["t"])
    with pytest.raises(ValueError):
        ds.unrelease()
    ds.stage("t").upload(frame(spark, (9, "n")), "u")
    ds.release("2.0", ["t"], replace=True)
    assert rows(ds.read("t")) == [(9, "n")] and ds.read("t", "1.1").count() == 2
    assert ds.read("t", "1.1", sample_keys=["a"], sample_percent=100).count() == 2


def test_references():
    assert normalize_tag("2.0") == "v2.0" and normalize_tag("next") == "next" and normalize_tag("V1") == "V1"
    assert parse_reference("data:ab12:v1_0:sample") == {
        "name": "data", "version": "v1_0", "sample": True, "reference_id": "ab12",
    }
    assert parse_reference("data")["version"] is None


# --- sinks


def test_verified_writes(spark):
    path = shared_dir(spark, "v")
    assert sinks.write_verified(frame(spark, (1, "x"), (2, "y")), path) == 2
    assert sinks.write_verified(frame(spark, (3, "z")), path, mode="append") == 1
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        sinks.write_verified(frame(spark, (1, "x")), path)


def test_an_append_reads_no_older_file(spark):
    path = shared_dir(spark, "v")
    sinks.write_verified(frame(spark, (1, "x")), path)
    for file in Path(path.removeprefix("file:")).glob("*.parquet"):
        file.write_bytes(b"no parquet at all")
    assert sinks.write_verified(frame(spark, (2, "y"), (3, "z")), path, mode="append") == 2
    assert not list(Path(path.removeprefix("file:")).glob("_writing*"))


def test_writers_append_side_by_side(spark):
    path = shared_dir(spark, "v")
    with ThreadPoolExecutor(3) as pool:
        written = list(pool.map(lambda k: sinks.write_verified(spark.range(k * 100 + 1), path, mode="append"), range(6)))
    assert written == [k * 100 + 1 for k in range(6)] and spark.read.parquet(path).count() == sum(written)


def test_exports(spark):
    df = frame(spark, (1, ' a "q",\nb '), (2, None), (3, "")).coalesce(1)
    path = shared_dir(spark, "e")
    sinks.export(df, path)
    with pytest.raises(Exception):
        sinks.export(df, path)
    sinks.export(df, path, overwrite=True)
    manifest = sinks.export_manifest(spark, path, "My Table!", "csv").collect()
    assert [m["target"] for m in manifest] == ["my_table_.csv"]
    back = read_delimited(spark, path, AB, has_quoted_newlines=True)
    assert {r["a"]: r["b"] for r in back.collect()} == {1: ' a "q",\nb ', 2: None, 3: ""}
    with pytest.raises(ValueError):
        sinks.export(df, path, "xlsx")
    times = spark.range(1).select(F.lit("10:00:00").cast("time(6)").alias("t"))
    sinks.export(times, shared_dir(spark, "e"))


def test_export_under_names(spark):
    path = shared_dir(spark, "e")
    many = spark.range(30).repartition(4).filter("id <> 3")
    got = sinks.export_files(many, path, "Of All!", "parquet").collect()
    assert [r["target"] for r in sorted(got, key=lambda r: r["part"])] == [f"of_all_/{k:06d}.parquet" for k in range(len(got))]
    assert spark.read.parquet(f"{path}/of_all_").count() == 29
    one = sinks.export_files(spark.range(3).coalesce(1), path, "one", "csv").collect()
    assert [r["path"] for r in one] == [f"{path}/one.csv"] and spark.read.csv(one[0]["path"], header=True).count() == 3
    with pytest.raises(FileExistsError):
        sinks.export_files(spark.range(3), path, "one", "csv")


def test_append_to_a_path_under_another_name(spark):
    path = shared_dir(spark, "o")
    one, two = ("t_" + path[-12:] + x for x in "ab")
    sinks.output_table(frame(spark, (1, "x"), (2, "y")), one, path)
    sinks.output_table(frame(spark, (3, "z")), two, path, append=True)
    assert spark.table(two).count() == 3


def test_layout_keeps_statistics(spark):
    import glob

    import pyarrow.parquet as pq

    path = shared_dir(spark, "l")
    sinks.write_layout(spark.range(10_000), path)
    meta = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata
    assert meta.row_group(0).column(0).statistics.has_min_max


def test_output_table(spark):
    path = shared_dir(spark, "o")
    name = "t_" + path[-8:]
    out = sinks.output_table(frame(spark, (1, "POINT(0 0)")), name, path, ["b"])
    assert out.schema["b"].metadata["logical"] == "geography"
    sinks.output_table(frame(spark, (2, "POINT(1 1)")), name, path, append=True)
    assert spark.table(name).count() == 2
    sinks.output_table(frame(spark, (3, "x")), name, path)
    assert spark.table(name).count() == 1
    with pytest.raises(LookupError):
        sinks.output_table(frame(spark, (3, "x")), name, path, ["nope"])


def test_insert_rows(spark):
    path = shared_dir(spark, "i")
    assert sinks.insert_rows('[{"a": 1, "b": "x"}, {"a": 2}]', path, AB, spark) == 2
    assert sinks.insert_rows(frame(spark, (3, "z")), path, AB) == 1
    assert rows(spark.read.parquet(path)) == [(1, "x"), (2, None), (3, "z")]
    timed = declare({"t": "time", "d": "dateTime"})
    later = shared_dir(spark, "i")
    sinks.insert_rows('[{"t": "10:30:04.123", "d": "2020-01-01T00:00:00.123456"}]', later, timed, spark)
    kept = spark.read.parquet(later).select(F.col("t").cast("string"), F.col("d").cast("string"))
    assert rows(kept) == [("10:30:04.123", "2020-01-01 00:00:00.123456")]
    bad = spark.createDataFrame([('{"a": "word"}',)], "value string")
    with pytest.raises(Exception):
        sinks.insert_rows(bad, path, AB)
    with pytest.raises(ValueError):
        sinks.insert_rows([1], path, AB)


def test_stream_takes_each_file_once(spark):
    source, target, state = (shared_dir(spark, n) for n in ("s", "t", "c"))
    for i in range(2):
        spark.createDataFrame([(f'{{"a": {i}, "b": "x"}}',)], "value string").write.mode("append").text(source)
        insert_rows_stream(spark, source, target, state, AB).awaitTermination()
    assert rows(spark.read.parquet(target)) == [(0, "x"), (1, "x")]


def test_stream_into_uploads_repeats_nothing(spark):
    source, state = shared_dir(spark, "s"), shared_dir(spark, "c")
    table = UploadTable(spark, shared_dir(spark, "t"), AB)
    frame_text = spark.createDataFrame([('{"a": 1, "b": "x"}',)], "value string")
    frame_text.write.text(source)
    insert_uploads_stream(source, table, "in", state, AB).awaitTermination()
    # another checkpoint starts the batches again, as a restart before the commit would
    insert_uploads_stream(source, table, "in", shared_dir(spark, "c"), AB).awaitTermination()
    assert rows(table.read()) == [(1, "x")]
    frame_text.write.mode("append").text(source)
    insert_uploads_stream(source, table, "in", state, AB).awaitTermination()
    assert rows(table.read(tagged=True)) == [(1, "x", "in_0"), (1, "x", "in_1")]


# --- SQL


def test_scope_hides_and_restores(spark):
    frame(spark, (1, "outer")).createOrReplaceTempView("thing")
    inner = sql.query(spark, "SELECT b FROM thing", {"thing": frame(spark, (1, "inner"))})
    assert rows(inner) == [("inner",)]
    assert rows(spark.sql("SELECT b FROM thing")) == [("outer",)]
    spark.catalog.dropTempView("thing")
    sql.query(spark, "SELECT * FROM gone", {"gone": frame(spark, (1, "x"))})
    with pytest.raises(Exception):
        spark.table("gone")
    with pytest.raises(ValueError):
        sql.query(spark, "SELECT 1", {}, {})
    with pytest.raises(Exception):
        sql.query(spark, "SELECT nope FROM t", {"t": frame(spark, (1, "x"))})


def test_scopes_side_by_side(spark):
    """Two threads bind one name, and a third reads the caller's view of that name."""
    frame(spark, (0, "outer")).createOrReplaceTempView("shared_name")
    frame(spark, (7, "other")).createOrReplaceTempView("other_name")
    stop, seen = threading.Event(), []

    def watch():
        while not stop.is_set():
            seen.append(tuple(spark.sql("SELECT b FROM shared_name").first()))

    def ask(k):
        t = {"shared_name": frame(spark, (k, f"v{k}"))}
        return [rows(sql.query(spark, "SELECT s.b, o.b FROM shared_name s JOIN other_name o ON o.a = 7", t)) for _ in range(5)]

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        with ThreadPoolExecutor(2) as pool:
            found = list(pool.map(ask, range(2)))
    finally:
        stop.set()
        watcher.join()
    assert found == [[[(f"v{k}", "other")]] * 5 for k in range(2)]
    assert seen and set(seen) == {("outer",)}
    got = sql.query(spark, "SELECT b FROM shared_name", {"shared_name": frame(spark, (1, "x"))})
    got.createOrReplaceTempView("shared_name")  # a result is the caller's
    assert rows(spark.sql("SELECT b FROM shared_name")) == [("x",)]
    for name in ("shared_name", "other_name"):
        spark.catalog.dropTempView(name)


def test_parameters_and_fetch(spark):
    t = {"t": frame(spark, (1, "x"), (2, "y"), (3, "z"))}
    got = sql.query(spark, "SELECT a FROM t WHERE array_contains(:bs, b) AND a > :n", t, parameters={"bs": ["x", "y"], "n": 1})
    assert rows(got) == [(2,)]
    all_rows = sql.query(spark, "SELECT a FROM t ORDER BY a", t)
    assert rows(sql.fetch(all_rows, 2)) == rows(sql.fetch(all_rows, 2)) == [(1,), (2,)]
    assert len(rows(sql.fetch(all_rows))) == 3


def test_datasource(spark):
    t = {"a": spark.range(1), "b": spark.range(2)}
    assert set(sql.datasource(t, {"a": "x"})) == {"x", "b"}
    with pytest.raises(LookupError):
        sql.datasource(t, {"q": "x"})
    with pytest.raises(ValueError):
        sql.datasource(t, version="v1.0")
    with pytest.raises(ValueError):
        sql.datasource(t, sample_keys={"a": ["id"]})


# --- profiles and labels


def test_profile(spark):
    df = spark.createDataFrame([(1, "x", [1]), (3, None, None), (None, "x", [2])], "n int, s string, l array<int>")
    got = {r["variable"]: r for r in prof.profile(df).collect()}
    assert (got["n"]["rows"], got["n"]["nulls"], got["n"]["mean"], got["n"]["median"], got["n"]["max"]) == (3, 1, 2.0, 1.0, "3")
    assert (got["s"]["approx_distinct"], got["s"]["min"], got["s"]["mean"]) == (1, "x", None)
    assert got["l"]["nulls"] == 1 and got["l"]["min"] is None
    assert rows(prof.top_values(df, 1)) == [("n", "1", 1), ("s", "x", 2)]


def _close(got, want):
    for g, w in zip(got, want, strict=True):
        assert g == w or isinstance(w, float) and g == pytest.approx(w, rel=1e-9), (got, want)


def test_statistics_are_kept_by_upload(spark, monkeypatch):
    stored = UploadTable(spark, shared_dir(spark, "profiled"))
    seen = []
    plain = uploads.read_merged
    monkeypatch.setattr(uploads, "read_merged", lambda s, parts, *more: (seen.append([n for p in parts for n in p["names"]]), plain(s, parts, *more))[1])
    exact = lambda: {r["variable"]: r for r in prof.profile(plain(spark, stored.parts())).collect()}
    names = ["variable", "type", "rows", "nulls", "min", "max", "mean", "sd"]

    def check(*read):
        seen.clear()
        got = {r["variable"]: r for r in stored.profile().collect()}
        assert seen == ([list(read)] if read else [])
        want = exact()
        assert got.keys() == want.keys()
        for v in want:
            _close([got[v][n] for n in names], [want[v][n] for n in names])
            a, b = got[v]["approx_distinct"], want[v]["approx_distinct"]
            assert a == b or a == pytest.approx(b, rel=0.1, abs=1)
        return got

    # far from zero, where sums of squares would cancel; as text, 10 is before 9
    stored.upload(frame(spark, *[(10**9 + k, str(k)) for k in range(50)]), "x")
    check("x")
    stored.upload(frame(spark, (9, "9"), (10, None), (None, "10")), "y")
    got = check("y")
    assert (got["a"]["min"], got["a"]["max"]) == ("9", str(10**9 + 49)) and got["a"]["median"] >= 10**9
    stored.upload(frame(spark), "empty")
    check("empty")
    check()
    stored.upload(frame(spark, (1, "z")), "y", replace_on_conflict=True)
    check("y")
    stored.compact()
    assert len(stored.parts()) == 1
    check()  # a merge of uploads keeps theirs
    stored.remove("x")
    check()
    # another column changes the table's schema, so all are made anew
    stored.upload(spark.createDataFrame([(2, "b", [1.0], True)], "a bigint, b string, c array<double>, d boolean"), "wide")
    check("empty", "y", "wide")


def test_statistics_of_no_upload_and_of_the_last_one(spark):
    empty = UploadTable(spark, shared_dir(spark, "profiled"), AB).profile()
    assert rows(empty.select("variable", "rows", "approx_distinct", "median")) == [("a", 0, 0, None), ("b", 0, 0, None)]
    last = UploadTable(spark, shared_dir(spark, "profiled"), AB, "replace")
    for k in (1, 2):
        last.upload(frame(spark, *[(k, "v")] * k), f"u{k}")
    assert rows(last.profile().select("variable", "rows", "max")) == [("a", 2, "2"), ("b", 2, "v")]


def test_labels(spark):
    df = prof.describe_columns(
        frame(spark, (1, "m"), (2, "q")), labels={"b": "Kind"}, descriptions={"a": "Key"}, value_labels={"b": {"m": "male"}}
    )
    assert df.schema["b"].metadata["label"] == "Kind" and df.schema["a"].metadata["description"] == "Key"
    assert rows(prof.decode_values(df, "b", "label").select("label")) == [("male",), (None,)]
    with pytest.raises(LookupError):
        prof.decode_values(df, "a", "label")


def test_shared_dir(spark):
    path = shared_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and not path_exists(spark, path)
    assert isinstance(AB, T.StructType)
