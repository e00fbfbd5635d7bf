"""File-index operators against a walk over a dictionary tree."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import copies
from tablewright.operators import files as fo
from tablewright.sources import files as raw
from tests.conftest import rows

PATHS = ["a/b/one.txt", "a/b/two.txt", "/a/three.txt", "c//four.txt/", "top.txt", "d/e/f/g/deep.bin"]


def day():
    return F.lit("2024-01-01").cast("timestamp_ntz")


def manifest(spark, paths):
    data = [(f"id{i}", p, 10 + i, f"h{i}") for i, p in enumerate(paths)]
    df = spark.createDataFrame(data, "file_id string, file_name string, size bigint, md5_hash string")
    return df.withColumn("added_at", day())


def build(paths):
    root = {}
    for i, p in enumerate(paths):
        parts = [x for x in p.split("/") if x]
        node = root
        for x in parts[:-1]:
            node = node.setdefault(x, {})
        node[parts[-1]] = f"id{i}"
    return root


def walk(root, path):
    """The lookup, one step at a time."""
    stack = [root]
    parts = [p for p in path.split("/") if p]
    for i, part in enumerate(parts):
        if part == ".":
            continue
        if part == "..":
            if len(stack) == 1:
                return "error", None
            stack.pop()
            continue
        child = stack[-1].get(part)
        if child is None:
            return "missing", None
        if isinstance(child, dict):
            stack.append(child)
        elif i == len(parts) - 1 and not path.endswith("/"):
            return "file", child
        else:
            return "missing", None
    return "directory", None


def test_resolve_against_walk(spark):
    rng = random.Random(1)
    names = ["a", "b", "c", "d", "e", "f", "g", "one.txt", "two.txt", "three.txt", "four.txt", "top.txt", ".", "..", "x"]
    asked = {"/", "", "a", "/a/b/", "../x", "a/..", "a/b/one.txt/", "a/b/one.txt/.", "x/../../y", "top.txt/.."}
    while len(asked) < 400:
        asked.add(rng.choice(["", "/"]) + "/".join(rng.choice(names) for _ in range(rng.randint(1, 5))) + rng.choice(["", "/"]))
    tree = build(PATHS)
    got = fo.resolve_paths(spark.createDataFrame([(p,) for p in asked], "path string"), manifest(spark, PATHS))
    for r in got.collect():
        assert (r["status"], r["file_id"]) == walk(tree, r["path"]), r


def test_listing_order_and_modes(spark):
    m = manifest(spark, PATHS)

    def listed(**kw):
        return [r["path"] for r in fo.list_nodes(m, **kw).collect()]

    assert listed() == ["a", "c", "d", "top.txt"]
    assert listed(mode="files") == ["top.txt"]
    assert listed(directory="/a/", mode="directories") == ["a/b"]
    assert listed(directory="a", recursive=True) == ["a/b", "a/b/one.txt", "a/b/two.txt", "a/three.txt"]
    assert listed(recursive=True, max_results=4) == ["a", "a/b", "a/b/one.txt", "a/b/two.txt"]
    assert [r["path"] for r in fo.list_files(m, 2).collect()] == ["a/b/one.txt", "a/b/two.txt"]
    with pytest.raises(ValueError):
        fo.list_nodes(m, mode="links")


def test_last_file_of_a_path_wins(spark):
    m = manifest(spark, ["a/x", "/a//x", "b"])
    later = m.withColumn("added_at", F.when(F.col("file_id") == "id0", F.lit("2025-01-01").cast("timestamp_ntz")).otherwise(day()))
    assert {r["path"]: r["file_id"] for r in fo.latest_files(later).collect()} == {"a/x": "id0", "b": "id2"}


def test_a_name_can_be_file_and_directory(spark):
    m = manifest(spark, ["a", "a/b"])
    assert rows(fo.dir_tree(m).select("path", "is_dir")) == [("a", False), ("a", True), ("a/b", False)]
    asked = spark.createDataFrame([("a",), ("a/",)], "path string")
    assert rows(fo.resolve_paths(asked, m).select("path", "status")) == [("a", "file"), ("a/", "directory")]


def test_sizes_count_missing_as_zero(spark):
    m = manifest(spark, ["a/x", "a/y"]).withColumn("size", F.when(F.col("file_id") == "id0", F.col("size")))
    assert rows(fo.dir_sizes(m)) == [("", 2, 10), ("a", 2, 10)]


def test_sync_plan(spark):
    m = manifest(spark, PATHS)
    assert {r["action"] for r in fo.sync_plan(m, m).collect()} == {"skip"}
    assert fo.files_to_copy(m, m).isEmpty()
    other = m.where("file_id <> 'id0'").withColumn("md5_hash", F.when(F.col("file_id") == "id1", "zz").otherwise(F.col("md5_hash")))
    plan = {r["file_id"]: r["action"] for r in fo.sync_plan(m, other).collect()}
    assert plan["id0"] == "copy" and plan["id1"] == "error" and plan["id2"] == "skip"
    again = {r["file_id"]: r["action"] for r in fo.sync_plan(m, other, overwrite=True).collect()}
    assert again["id1"] == "overwrite"
    unhashed = m.withColumn("md5_hash", F.lit(None).cast("string"))
    assert {r["action"] for r in fo.sync_plan(unhashed, m).collect()} == {"error"}


def test_paths_of_downloads(spark):
    got = fo.download_paths(manifest(spark, PATHS), "/out/", "a")
    assert {r["target"] for r in got.collect()} == {"/out/b/one.txt", "/out/b/two.txt", "/out/three.txt"}
    one = spark.createDataFrame([("x/y.txt",)], "n string")
    assert one.select(fo.file_target("n", "/d", True)).first()[0] == "/d/x/y.txt"
    assert one.select(fo.file_target("n", "/d/z.txt", False)).first()[0] == "/d/z.txt"


def test_scan_hash_and_ranges(spark, tmp_path):
    data = {"a/b c.bin": bytes(range(256)), "é+%.txt": "héllo".encode(), "empty": b""}
    for name, content in data.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    found = raw.scan_files(spark, str(tmp_path))
    hashed = {r["name"]: (r["size"], r["md5_hash"]) for r in fo.file_hashes(found).collect()}
    assert hashed == {n: (len(c), base64.b64encode(hashlib.md5(c).digest()).decode()) for n, c in data.items()}
    parts = found.where("name = 'a/b c.bin'").select(
        fo.read_range("content", 0, 9), fo.read_range("content", 250), fo.read_range("content", 10, 10), fo.read_range("content")
    ).first()
    assert [bytes(p) for p in parts] == [bytes(range(10)), bytes(range(250, 256)), b"\x0a", bytes(range(256))]
    text = found.where("size = 6").select(fo.read_range("content", as_text=True)).first()[0]
    assert text == "héllo"


def test_scan_names_spark_ignores(spark, tmp_path):
    for name in ("_a=1/x", ".hidden/y", "_done", "z"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "_done" else b"1")
    assert rows(raw.scan_files(spark, f"file:{tmp_path}").select("name")) == [("_a=1/x",), ("_done",), ("z",)]
    (tmp_path / "_b").mkdir()
    (tmp_path / "_b" / "w").write_bytes(b"1")
    assert ("_b/w",) in rows(raw.list_files(spark, str(tmp_path)).select("name"))


def test_globs(spark, tmp_path):
    for name in ("a.txt", "b.csv", "c.txt.gz", "d/e.csv", "d/f1.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "b.csv" else b"12")
    names = lambda glob: [r[0] for r in rows(raw.list_files(spark, str(tmp_path), glob).select("name"))]
    assert names("*.{txt,csv}") == ["a.txt", "b.csv", "d/e.csv", "d/f1.txt"]
    assert names("[^a]?.txt") == ["d/f1.txt"]
    assert names("nothing") == []


def test_streams_have_no_size_limit(spark, tmp_path):
    data = bytes(range(256)) * 5000
    (tmp_path / "big").write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        there = raw.list_files(spark, str(tmp_path))
        hashed = {r["name"]: r["md5_hash"] for r in raw.stream_hashes(there, str(tmp_path)).collect()}
        assert hashed == {n: base64.b64encode(hashlib.md5(d).digest()).decode() for n, d in (("big", data), ("empty", b""))}
        part = {r["name"]: bytes(r["content"]) for r in raw.stream_range(there, str(tmp_path), 1_000_000, 1_000_009).collect()}
        assert part == {"big": data[1_000_000:1_000_010], "empty": b""}
        chunks = raw.stream_chunks(there, str(tmp_path), 300_000, 10, 999_999).collect()
        assert b"".join(bytes(c["chunk"]) for c in sorted(chunks, key=lambda c: c["chunk_no"])) == data[10:1_000_000]
        added = fo.add_files(spark, str(tmp_path / "m"), F.lit("2024-01-01").cast("timestamp_ntz"), directory=str(tmp_path), glob="b*")
        assert rows(added.select("file_name", "size")) == [("big", len(data))]
        m = copies.manifest_of(spark, str(tmp_path), "big")
        target = tmp_path / "to"
        assert [r["action"] for r in copies.copy_files(m, str(tmp_path), str(target)).collect()] == ["copy"]
        (target / "unrelated").write_bytes(b"x" * 2000)
        assert [r["action"] for r in copies.copy_files(m, str(tmp_path), str(target)).collect()] == ["skip"]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    with pytest.raises(ValueError):
        fo.add_files(spark, "x", F.lit(None))


def test_copy_files(spark, tmp_path):
    source, target = tmp_path / "from", tmp_path / "to"
    for name, content in {"a/b/c.bin": b"\x00\x01" * 5000, "é.txt": b"hi", "empty": b""}.items():
        (source / name).parent.mkdir(parents=True, exist_ok=True)
        (source / name).write_bytes(content)
    m = copies.manifest_of(spark, str(source))

    def run(**kw):
        return {r["path"]: r["action"] for r in copies.copy_files(m, str(source), str(target), **kw).collect()}

    assert set(run().values()) == {"copy"}
    assert {str(p.relative_to(target)) for p in target.rglob("*") if p.is_file()} == {"a/b/c.bin", "é.txt", "empty"}
    assert (target / "a/b/c.bin").read_bytes() == b"\x00\x01" * 5000
    assert set(run().values()) == {"skip"}
    (target / "é.txt").write_bytes(b"ho")
    with pytest.raises(FileExistsError):
        run()
    assert run(overwrite=True)["é.txt"] == "overwrite" and (target / "é.txt").read_bytes() == b"hi"
    wrong = m.withColumn("md5_hash", F.lit("AAAA"))
    with pytest.raises(Exception, match="hash"):
        copies.copy_files(wrong, str(source), str(target), overwrite=True)
    assert (target / "é.txt").read_bytes() == b"hi"


def test_file_specs(spark, tmp_path):
    specs = raw.file_specs(spark, [{"name": "a", "data": "é"}, {"name": "b", "data": b"\x00\x01\x02"}])
    assert rows(specs.select("name", "size")) == [("a", 2), ("b", 3)]
    with pytest.raises(ValueError):
        raw.file_specs(spark, [{"data": b""}])
    (tmp_path / "x.txt").write_text("hi")
    assert rows(raw.file_paths(spark, [str(tmp_path / "x.txt")]).select("name", "size")) == [("x.txt", 2)]


def test_digest_of_an_open_range_larger_than_a_cell(spark, tmp_path, monkeypatch):
    import hashlib

    from tablewright.plans import indexes

    folder = tmp_path / "source=a" / "lang=b"
    folder.mkdir(parents=True)
    size = (1 << 31) + 100  # sparse
    with open(folder / "large.txt", "wb") as f:
        f.write(b"0123456789" * 3)
        f.truncate(size)
    monkeypatch.setattr(indexes, "_written", lambda spark, sf_dir: str(tmp_path))
    (row,) = indexes.file_read_range(spark, "").collect()
    want, left, zeros = hashlib.md5(b"0123456789"), size - 30, bytes(1 << 22)
    while left:
        want.update(zeros[:left])
        left -= min(left, len(zeros))
    assert row["rest"] == want.hexdigest() and bytes(row["head"][:10]) == b"0123456789"
    assert (row["source"], row["lang"], bytes(row["inner_part"])) == ("a", "b", bytes(20))


def test_parts_of_a_file_are_hashed_apart(spark, tmp_path):
    rng = random.Random(2)
    contents = {"a/b.bin": rng.randbytes(10_000), "a/empty": b"", "c": rng.randbytes(4096), "d é%20": b"x"}
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    files = raw.list_files(spark, str(tmp_path))
    parts = raw.part_hashes(files, str(tmp_path), 1000)
    got = {(r["name"], r["part"]): (r["part_bytes"], r["part_md5"]) for r in parts.collect()}
    want = {}
    for name, data in contents.items():
        for k in range(max(1, -(-len(data) // 1000))):
            piece = data[k * 1000 : k * 1000 + 1000]
            want[name, k] = (len(piece), hashlib.md5(piece).hexdigest())
    assert got == want
    trees = {r["name"]: r["tree_md5"] for r in raw.tree_hashes(files, str(tmp_path), 1000).collect()}
    assert trees == {n: hashlib.md5("".join(want[n, k][1] for m, k in sorted(want) if m == n).encode()).hexdigest() for n in contents}
    with pytest.raises(ValueError):
        raw.part_hashes(files, str(tmp_path), 0)
