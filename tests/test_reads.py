import csv
import datetime as dt
import gzip
import io
import random
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import batch, schema
from tablewright.sources import delimited, ingest, quoted, reader, splits
from tablewright.sources.delimited import from_frame, read_delimited
from tablewright.sources.uploads import UploadTable
from tablewright.types import field, logical_type
from tablewright.types import schema as declare
from tests.conftest import rows

LOGICAL = declare(
    {
        "i": "integer",
        "f": "float",
        "b": "boolean",
        "d": "date",
        "ts": "dateTime",
        "t": "time",
        "g": "geography",
        "s": "string",
        "u": "unknown",
    }
)


@pytest.fixture
def stored(spark):
    """Every logical type stored as text, in two rows."""
    data = [
        ("7", "1.5", "true", "2020-01-02", "2020-01-02 03:04:05", "10:30:04.123", "POINT(1 2)", "x", "?"),
        (None,) * 9,
    ]
    return spark.createDataFrame(data, T.StructType([T.StructField(n, T.StringType()) for n in LOGICAL.names]))


def test_coerce_all_types(stored):
    df = schema.conform(stored, LOGICAL)
    assert df.schema.names == LOGICAL.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in LOGICAL]
    assert [logical_type(f) for f in df.schema][:8] == ["integer", "float", "boolean", "date", "dateTime", "time", "geography", "string"]
    r = df.withColumn("t", F.col("t").cast("string")).where("i is not null").first()
    assert r["t"] == "10:30:04.123" and r["d"] == dt.date(2020, 1, 2) and r["f"] == 1.5
    assert rows(schema.conform(df, LOGICAL).drop("t")) == rows(df.drop("t"))


def test_strict_and_lenient_casts(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    declared = declare({"a": "integer"})
    with pytest.raises(Exception):
        schema.conform(df, declared).collect()
    assert rows(schema.conform(df, declared, lenient=True)) == [(1,), (None,)]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "A int")
    declared = declare({"b": "time", "a": "integer", "c": "date"})
    out = schema.conform(df, declared)
    assert out.columns == ["b", "a", "c"] and out.schema["a"].dataType == T.LongType()
    assert rows(out.drop("b")) == [(1, None)]
    with pytest.raises(ValueError):
        schema.conform(df, declared, strict=True)


def test_merge_casts_before_the_union(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    b = spark.createDataFrame([("y2", 2)], "V string, extra int").withColumn("ID", F.lit("2"))
    merged = schema.merge_uploads([a, b], declare({"id": "string", "v": "string"}))
    assert rows(merged) == [("1", "x"), ("2", "y2")]
    free = schema.merge_uploads([a, b])
    assert free.columns == ["id", "v", "extra"] and free.schema["id"].dataType == T.StringType()


def test_variables(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Id int, dAte int, other int")
    assert reader.read_frame(df, ["DATE", "nope", "ID"]).columns == ["dAte", "Id"]
    assert reader.read_frame(df, max_results=0).isEmpty()


def test_geography(spark):
    df = spark.createDataFrame([("x", "POINT(1 1)", "POINT(2 2)")], "a string, g string, h string")
    df = df.withMetadata("g", field("g", "geography").metadata).withMetadata("h", field("h", "geography").metadata)
    assert reader.read_geography(df)[1] == "g"
    assert reader.read_geography(df, ["h", "g"])[1] == "h"
    assert reader.read_geography(df, geography="H")[1] == "h"
    assert df.schema["g"].metadata["crs"] == 4326
    with pytest.raises(LookupError):
        reader.read_geography(df, ["a"])


def test_streams_are_disjoint_and_complete(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    streams = reader.read_streams(df, 6, ["id"], ["V"])
    assert streams.columns == ["v", "stream_id"]
    tagged = reader.read_streams(df, 6, ["id"])
    parts = [reader.read_stream(tagged, i) for i in range(6)]
    ids = [r["id"] for p in parts for r in p.collect()]
    assert sorted(ids) == list(range(1000))
    assert len(reader.read_stream(tagged, 0, max_results=3).collect()) == 3
    with pytest.raises(ValueError):
        reader.read_streams(tagged, 2, ["id"])


def test_sample_is_repeatable_and_nested(spark):
    df = spark.range(5000)
    small, large = (set(r["id"] for r in reader.sample_rows(df, ["id"], p).collect()) for p in (5, 20))
    assert small < large and 150 < len(small) < 350
    assert reader.sample_rows(df, ["id"], 100).count() == 5000


def test_empty_table(spark):
    assert reader.empty_table(spark, LOGICAL).schema.names == LOGICAL.names


def test_batches(spark):
    df = spark.range(100)

    def odd_batches(b: pa.RecordBatch):
        t = pa.Table.from_batches([b]).append_column("twice", pa.array([2 * v for v in b["id"].to_pylist()]))
        return None if b["id"][0].as_py() == 0 else t

    out = batch.preprocess_batches(df.repartition(4), odd_batches, "id bigint, twice bigint")
    assert all(r["twice"] == 2 * r["id"] for r in out.collect())
    assert batch.preprocess_batches(df, lambda b: None).isEmpty()


def test_file_chunks(spark):
    content = bytes(i % 256 for i in range(1000))
    df = spark.createDataFrame([("a", content), ("b", b"")], "name string, content binary")
    got = batch.file_chunks(df, 300).orderBy("chunk_no").collect()
    assert b"".join(bytes(r["chunk"]) for r in got) == content
    assert [(r["start_byte"], r["end_byte"]) for r in got] == [(0, 299), (300, 599), (600, 899), (900, 999)]
    part = batch.file_chunks(df, 100, start_byte=50, end_byte=250).orderBy("chunk_no").collect()
    assert b"".join(bytes(r["chunk"]) for r in part) == content[50:251]


# --- delimited text

COLUMNS = declare({"a": "integer", "b": "string", "c": "float"})


def write(tmp_path, text, name="x.csv"):
    (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path / name)


def test_bad_records(spark, tmp_path):
    path = write(tmp_path, 'a,b,c\n1,x,2.5\n2,y\n3,"z,z",3.5,extra\n4,w,oops\n5,,\n6,"q\n')
    good = [(1, "x", 2.5), (5, None, None)]
    assert rows(read_delimited(spark, path, COLUMNS, skip_bad_records=True)) == good
    jagged = read_delimited(spark, path, COLUMNS, skip_bad_records=True, allow_jagged_rows=True)
    assert (2, "y", None) in rows(jagged) and len([r for r in rows(jagged) if r[0] in (3, 4)]) == 0
    for jag in (False, True):
        bad = read_delimited(spark, path, COLUMNS, allow_jagged_rows=jag)
        with pytest.raises(Exception, match="bad record"):
            bad.collect()
        with pytest.raises(Exception, match="bad record"):
            bad.select("b").count()


def test_jagged_rows_alone_are_fine(spark, tmp_path):
    path = write(tmp_path, "1,x,2.5\n2,y\n3\n")
    got = read_delimited(spark, path, COLUMNS, has_header_row=False, allow_jagged_rows=True)
    assert rows(got) == [(1, "x", 2.5), (2, "y", None), (3, None, None)]
    assert got.count() == 3


def test_dialect(spark, tmp_path):
    path = write(tmp_path, "a;b;c\n1;'x;\ny''s';NA\n-;NA;2\n")
    got = read_delimited(
        spark, path, COLUMNS, delimiter=";", quote_character="'", escape_character="'",
        null_markers=["NA", "-"], has_quoted_newlines=True,
    )
    assert rows(got) == [(1, "x;\ny's", None), (None, None, 2.0)]
    text = read_delimited(spark, path, delimiter=";", quote_character="'", escape_character="'", has_quoted_newlines=True)
    assert text.columns == ["a", "b", "c"] and rows(text)[0] == ("-", "NA", "2")


def test_frames(spark):
    assert rows(from_frame(spark, pa.table({"x": [1, 2]}))) == [(1,), (2,)]
    df = spark.range(2)
    assert from_frame(spark, df) is df


def test_headers_in_another_order(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,one\n2,two\n")
    (tmp_path / "y.csv").write_text('"b","A"\r\nthree,3\r\n')
    (tmp_path / "z.csv").write_text("b,a\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = read_delimited(spark, str(tmp_path), schema)
    assert got.columns == ["a", "b"] and rows(got) == [(1, "one"), (2, "two"), (3, "three")]
    (tmp_path / "y.csv").write_text("p,q\n3,three\n")
    assert rows(read_delimited(spark, str(tmp_path), schema)) == [(1, "one"), (2, "two"), (3, "three")]


# --- quoted line breaks by ranges


def reference(text, **dialect):
    return [tuple(r) for r in csv.reader(io.StringIO(text, newline=""), **dialect) if r]


@pytest.mark.parametrize("size", [4, 5, 6, 7, 64, 1 << 20])
def test_records_are_the_same_for_ranges_of_any_size(tmp_path, size):
    rng = random.Random(size)
    for trial in range(60):
        pieces = ["a", "", "x y", 'q"uote', "line\nbreak", "\r\n", '""', ",", "é日", '"', "\n\n", 'end"']
        rows = [[rng.choice(pieces) for _ in range(3)] for _ in range(rng.randint(0, 25))]
        out = io.StringIO()
        ending = rng.choice(["\n", "\r\n"])
        csv.writer(out, lineterminator=ending, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows(rows)
        text = out.getvalue()
        if rng.random() < 0.3:
            text += f'5" pipe,b"c,d{ending}'  # quotes inside of fields are text
        if rng.random() < 0.3:
            text = text.removesuffix(ending)
        data = (b"\xef\xbb\xbf" if rng.random() < 0.2 else b"") + text.encode()
        quotes = quoted.Quotes(",", '"', '"')
        f, found, inside = io.BytesIO(data), [], False
        for k in range(len(data) // size + 1):
            begin, end = (quoted._begin(f, (k + j) * size, len(data), quotes) for j in (0, 1))
            piece, start = quoted._piece(f, begin, end, quotes)
            found += quoted._records(f, {"begin": begin, "end": end, "inside": inside}, quotes, False)
            inside = quotes.spans(piece, start, inside)[1]
        got = [tuple(next(csv.reader(io.StringIO(r.decode(), newline="")))) for r in found]
        assert got == reference(text)
        head = quoted.first_record(io.BytesIO(data), quotes)
        assert not text.strip("\r\n") or text.startswith(("\r", "\n")) or next(csv.reader(io.StringIO(head, newline=""))) == list(reference(text)[0])


def test_many_short_quoted_fields_need_little_memory():
    data = b'"a","b"\n' * 200_000
    quotes = quoted.Quotes(",", '"', '"')
    tracemalloc.start()
    try:
        assert not quotes.open_after(b"\n" + data, 1, False)
        scanned = tracemalloc.get_traced_memory()[1]
        ends, inside = quotes.breaks(b"\n" + data, 1, False)
        assert len(ends) == 200_000 and not inside
        assert scanned < 5 * len(data) and tracemalloc.get_traced_memory()[1] < 16 * len(data)
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("size", [16, 1000])
def test_one_file_with_line_breaks_is_many_tasks(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(delimited, "RANGE_BYTES", size)
    want = [(k, f'text {k}, "said"\nand\r\n\nwent' if k % 3 else None if k % 2 else "", k / 2) for k in range(200)]
    with open(tmp_path / "x.csv", "w", newline="") as f:
        f.write("a,b,c\n")
        for a, b, c in want:
            cell = "" if b is None else '"' + b.replace('"', '""') + '"'
            f.write(f"{a},{cell},{c}\r\n")
    got = read_delimited(spark, str(tmp_path / "x.csv"), COLUMNS, has_quoted_newlines=True)
    assert rows(got) == sorted(want, key=repr)
    slashed = tmp_path / "y"
    slashed.mkdir()
    for n in range(3):
        (slashed / f"{n}.csv").write_text("".join(f"{k};'it\\'s\n{k}';1\n" for k in range(n * 40)))
    got = read_delimited(spark, str(slashed), COLUMNS, delimiter=";", has_header_row=False, quote_character="'", escape_character="\\", has_quoted_newlines=True)
    assert rows(got) == sorted([(k, f"it's\n{k}", 1.0) for n in range(3) for k in range(n * 40)], key=repr)


def test_ranges_know_their_state(spark, tmp_path):
    path = write(tmp_path, 'a,"' + "long\n" * 500 + '",1\n' * 1 + "b,x,2\n" * 50)
    found = quoted.ranges(spark, path, quoted.Quotes(",", '"', '"'), 100).orderBy("range").collect()
    assert len(found) > 20 and found[0]["inside"] is False and found[10]["inside"] is True and found[-1]["inside"] is False
    assert quoted.records(spark.createDataFrame(found), quoted.Quotes(",", '"', '"'), False).count() == 51


def test_bad_records_with_line_breaks(spark, tmp_path):
    path = write(tmp_path, 'a,b,c\n1,"x\ny",2.5\n2,y\n3,"z,z",3.5,extra\n4,w,oops\n5,,\n')
    good = [(1, "x\ny", 2.5), (5, None, None)]
    assert rows(read_delimited(spark, path, COLUMNS, skip_bad_records=True, has_quoted_newlines=True)) == good
    with pytest.raises(Exception, match="bad record"):
        read_delimited(spark, path, COLUMNS, has_quoted_newlines=True).select("b").count()


def test_compressed_files_stay_whole(spark, tmp_path):
    (tmp_path / "x.csv.gz").write_bytes(gzip.compress(b'b,a,c\n"x\ny",1,2.5\n'))
    assert rows(read_delimited(spark, str(tmp_path), COLUMNS, has_quoted_newlines=True)) == [(1, "x\ny", 2.5)]


def test_headers_of_any_length(spark, tmp_path):
    names = [f"column_number_{k:06d}" for k in range(4000)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    path = write(tmp_path, ",".join(reversed(names)) + "\n" + ",".join(str(k) for k in reversed(range(4000))) + "\n")
    row = read_delimited(spark, path, schema).first()
    assert row["column_number_000000"] == "0" and row["column_number_003999"] == "3999"
    path = write(tmp_path, '"two\nlines",a\nx,1\n', "y.csv")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("two\nlines", T.StringType())])
    assert rows(read_delimited(spark, path, schema, has_quoted_newlines=True)) == [(1, "x")]
    path = write(tmp_path, "b,a,d\nx,1,2\n", "z.csv")
    with pytest.raises(ValueError, match="other places"):
        read_delimited(spark, path, COLUMNS)


# --- splits and files


def test_splits_read_each_row_group_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        df = spark.range(k * 1000, k * 1000 + 1000).withColumn("t", F.lit(dt.datetime(2020, 1, 1))).withColumn("x", F.when(F.col("id") % 3 > 0, F.lit("é")))
        if k < 2:
            df = df.withColumn("later", F.lit(k))
        df.coalesce(1).write.mode("append").option("parquet.block.size", 2000).option("parquet.page.row.count.limit", 100).parquet(path)
    spark.range(0).withColumn("x", F.lit("")).coalesce(1).write.mode("append").parquet(path)
    pq.write_table(pa.table({"id": [5000]}), f"{path}/single.parquet")
    whole = spark.read.option("mergeSchema", "true").parquet(path)
    found = splits.plan_splits(spark, path, 4)
    plan = found.plan().collect()
    assert len(plan) > 6 and len({(r["file"], r["row_group"]) for r in plan}) == len(plan) and sum(r["rows"] for r in plan) == 3001
    found = splits.Splits(spark, found.path, whole.schema, 4)
    parts = [found.read(k) for k in range(4)]
    assert all(p.count() for p in parts)
    got = [r for p in parts for r in rows(p)]
    assert sorted(got, key=repr) == rows(whole)
    assert parts[1].rdd.getNumPartitions() == sum(r["split"] == 1 for r in plan)
    assert found.read(0, ["X", "nope"]).columns == ["x"] and found.read(0, max_results=2).count() == 2
    many = splits.plan_splits(spark, path, 60)
    assert sum(many.read(k, ["id"]).count() for k in range(60)) == 3001
    with pytest.raises(ValueError):
        splits.plan_splits(spark, many, 2)
    with pytest.raises(LookupError):
        many.read(60)


def test_uploads_from_files(spark, tmp_path):
    t = UploadTable(spark, str(tmp_path / "t"))
    text = 'n;f;code;day;at;yes;mixed;none\n1;1.5;007;2020-01-02;2020-01-02T03:04:05;true;1;\n-2;3;010;2021-12-31;2020-01-02 03:04;FALSE;"a\nb";\n'
    assert ingest.upload_file(t, write(tmp_path, text, "semi.txt")) == "semi.txt"
    df = t.read_upload("semi.txt")
    assert [d for _, d in df.dtypes] == ["bigint", "double", "string", "date", "timestamp_ntz", "boolean", "string", "string"]
    assert rows(df.select("n", "code", "mixed")) == [(-2, "010", "a\nb"), (1, "007", "1")]
    assert ingest.upload_file(t, write(tmp_path, "a\tb\n1\tx,y\n", "x.tsv"), "tabs") == "tabs"
    assert rows(t.read_upload("tabs")) == [(1, "x,y")]
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    assert ingest.upload_file(t, str(tmp_path / "z.csv.gz"), schema=declare({"b": "string", "a": "integer"})) == "z.csv.gz"
    assert rows(t.read_upload("z.csv.gz")) == [("2", 1)]
    ingest.upload_file(t, write(tmp_path, '{"a": 1}\n{"a": 2}\n', "j.ndjson"))
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    assert ingest.upload_file(t, str(tmp_path / "p.parquet"), conflicts={"rename_on_conflict": True}) == "p.parquet"
    assert t.read_upload("j.ndjson").count() == 2 and t.read_upload("p.parquet").count() == 3
    assert ingest.upload_file(t, str(tmp_path / "p.parquet"), conflicts={"rename_on_conflict": True}) == "p.parquet_1"
    assert ingest.sniffed_delimiter(spark, write(tmp_path, '"a,b,c"|d|e\n', "s.txt")) == "|"
    for name, kind in (("x.unknown", None), ("x.unknown", "xlsx")):
        with pytest.raises(ValueError):
            ingest.upload_file(t, write(tmp_path, "a\n", name), type=kind)
    with pytest.raises(FileNotFoundError):
        ingest.upload_file(t, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError):
        ingest.upload_file(t, str(tmp_path / "p.parquet"), delimiter=";")
