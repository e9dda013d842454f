"""The landing data source: flat files, pushed keys, other extensions, reruns."""

import glob
import os

from lectern.sources import landing
from lectern.sources.corpus import land_text, save_clean, scan_text


def test_round_trip_in_folders(spark, tmp_dir, monkeypatch):
    from lectern.sources import corpus
    monkeypatch.setattr(corpus, "FOLDER_FILES", 20)
    rows = [(i, f"text {i}\nwith é") for i in range(100)] + [(-3, ""), (7000, None), (None, "no key")]
    land_text(spark.createDataFrame(rows, "book_id long, text string").repartition(5), f"{tmp_dir}/l")
    folders = glob.glob(f"{tmp_dir}/l/shard=*")
    assert len(folders) == 6 and len(glob.glob(f"{tmp_dir}/l/*/book_id_*.txt")) == 102
    with open(f"{folders[0]}/notes.json", "w") as f:
        f.write("{}")
    os.makedirs(f"{tmp_dir}/l/loose/deep")
    with open(f"{tmp_dir}/l/loose/deep/book_id_500.txt", "w") as f:
        f.write("moved by hand")
    with open(f"{tmp_dir}/l/readme.txt", "w") as f:
        f.write("not a book")
    got = {(r.book_id, r.text) for r in scan_text(spark, f"{tmp_dir}/l").collect()}
    want = {(i, (t or "") + "\n") for i, t in rows if i is not None} | {(500, "moved by hand"), (None, "not a book")}
    assert got == want
    assert {r.file_name for r in scan_text(spark, f"{tmp_dir}/l", ".json").collect()} == {"notes.json"}


def test_keys_are_pushed_down(spark, tmp_dir, monkeypatch):
    from lectern.sources import corpus
    monkeypatch.setattr(corpus, "FOLDER_FILES", 5)
    land_text(spark.range(60).selectExpr("id AS book_id", "'t' AS text"), f"{tmp_dir}/l")
    s = scan_text(spark, f"{tmp_dir}/l")
    assert sorted(r.book_id for r in s.filter("book_id IN (3, 59, 99)").collect()) == [3, 59]
    assert s.filter("book_id = 11").count() == 1
    # only the folders of the asked books become partitions, and only their files are opened
    reader = landing.LandedBooksReader({"path": f"{tmp_dir}/l"})
    assert len(reader.partitions()) == 12
    reader.books = {3}
    assert len(reader.partitions()) == 1 and [r[0] for p in reader.partitions() for r in reader.read(p)] == [3]


def test_landing_again_replaces(spark, tmp_dir):
    land_text(spark.createDataFrame([(1, "a"), (2, "b")], "book_id long, text string"), f"{tmp_dir}/l")
    land_text(spark.createDataFrame([(2, "c")], "book_id long, text string"), f"{tmp_dir}/l")
    assert [(r.book_id, r.text) for r in scan_text(spark, f"{tmp_dir}/l").collect()] == [(2, "c\n")]
    land_text(spark.createDataFrame([], "book_id long, text string"), f"{tmp_dir}/none")
    assert scan_text(spark, f"{tmp_dir}/none").count() == 0


def test_saved_clean_text(spark, tmp_dir):
    df = spark.createDataFrame([(1, "Clean text.")], "book_id long, clean_text string")
    assert [tuple(r) for r in save_clean(df, f"{tmp_dir}/clean").collect()] == [(1, "Clean text.")]
