"""Files listed, read and written by tasks."""

import pytest

from strata.sources import files, manifest


def test_paths_and_their_stores():
    assert files.opened("/a:b/c")[1:] == ("/a:b/c", "") and files.opened("file:///a/b")[1:] == ("/a/b", "file:")
    assert files.reachable("file:/a") and not files.reachable("nosuch://a/b")


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_listing_and_reading_any_name(spark, tmp_path, scheme):
    names = ["a/b/c/d/deep.json", "a/_one", "a/.two", "a/empty", "x y+%41é.json", "a/b/link"]
    for name in names[:-1]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name == "a/empty" else name.encode())
    (tmp_path / "a/b/link").symlink_to(tmp_path / "a")  # a folder again: not entered, not readable
    (tmp_path / "none").mkdir()
    listing = files.listed(spark, f"{scheme}{tmp_path}")
    before = "file:" if scheme else ""
    found = {r["path"].removeprefix(f"{before}{tmp_path}/"): r for r in files.read(listing).collect()}
    assert sorted(found) == sorted(names) and listing.count() == len(names)
    assert all(bytes(found[n]["content"]) == (b"" if n == "a/empty" else n.encode()) and found[n]["reason"] is None for n in names[:-1])
    assert found["a/b/link"]["content"] is None and found["a/b/link"]["reason"]
    assert found["a/empty"]["length"] == 0 and found["a/_one"]["length"] == 6


def test_files_are_written_in_place(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 3}/f{i}", None if i == 4 else b"x" * i) for i in range(20)], "path string, content binary")
    for _ in range(2):
        assert files.written(rows, str(tmp_path)).count() == 20
    found = {r["path"].removeprefix(f"{tmp_path}/"): bytes(r["content"]) for r in files.read(files.listed(spark, str(tmp_path))).collect()}
    assert found == {f"d{i % 3}/f{i}": b"" if i == 4 else b"x" * i for i in range(20)}


def test_missing_folder(spark, tmp_path):
    with pytest.raises(manifest.PathMissing):
        manifest.file_manifest(spark, f"{tmp_path}/none")
    (tmp_path / "some").mkdir()
    assert manifest.file_manifest(spark, f"{tmp_path}/some").count() == 0


def test_long_contents_and_many_names_come_in_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", 100)
    monkeypatch.setattr(files, "BATCH_ROWS", 7)
    rows = spark.range(50).selectExpr("concat('f', id) AS path", "cast(repeat('y', cast(id as int)) as binary) AS content")
    assert files.written(rows, str(tmp_path)).count() == 50
    assert sum(len(r["content"]) for r in files.read(files.listed(spark, str(tmp_path))).collect()) == sum(range(50))


def test_scan_of_stores_that_only_spark_opens(spark, tmp_path):
    (tmp_path / "a b+%41.json").write_text("x")
    (tmp_path / "empty.json").write_text("")
    found = {r["path"].rpartition("/")[2]: r["length"] for r in manifest.scanned_manifest(spark, str(tmp_path)).collect()}
    assert found == {"a b+%41.json": 1, "empty.json": 0}


def test_rows_of_one_partition_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 400, 1, 1).selectExpr("concat('d', id % 3, '/f', id) AS path", "cast('z' as binary) AS content")
    tasks = files.written(rows, str(tmp_path)).rdd.glom().map(len).collect()
    assert sum(tasks) == 400 and sum(n > 0 for n in tasks) >= 8 and max(tasks) < 100


def test_rows_of_one_path_leave_the_last(spark, tmp_path):
    rows = spark.range(0, 40, 1, 1).selectExpr("concat('f', id % 4) AS path", "cast(cast(id as string) as binary) AS content")
    assert files.written(rows, str(tmp_path)).count() == 40
    assert {p.name: p.read_text() for p in tmp_path.iterdir()} == {"f0": "36", "f1": "37", "f2": "38", "f3": "39"}


def test_few_folders_are_listed_by_a_task_each_and_files_read_in_their_place(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"d{i}").mkdir()
        for j in range(5):
            (tmp_path / f"d{i}" / f"f{j}").write_text(f"{i}{j}")
    listing = files.listed(spark, str(tmp_path))
    assert max(listing.rdd.glom().map(len).collect()) <= 5  # one folder
    assert {r["path"]: r["place"] for r in listing.collect()} == {str(p): p.stat().st_ino for p in tmp_path.glob("*/*")}
    read = files.read(listing)
    inodes = [[(tmp_path / p).stat().st_ino for p in part] for part in read.select("path").rdd.map(lambda r: r[0]).glom().collect()]
    assert [i for part in inodes for i in part] == sorted(i for part in inodes for i in part)
    assert {bytes(r["content"]).decode() for r in read.collect()} == {f"{i}{j}" for i in range(6) for j in range(5)}
    assert files.read(listing.drop("place")).count() == 30
