"""The document store: typed documents, order of insertion, changes that touch what they must, two writers."""
import json
import os

import pytest
from pyspark.sql import functions as F

from barframe.sources import documents as D
from barframe.sources import store as S


@pytest.fixture
def store(spark, tmp_path):
    return S.DocumentStore(spark, str(tmp_path / "store"))


def texts(spark, rows, parts=4):
    return spark.createDataFrame(rows, "k int, text string").repartition(parts)


def docs(store, version=None):
    return [json.loads(r[0]) for r in store.read(version).orderBy("seq").select(F.to_json("doc")).collect()]


def test_objects_come_back_as_they_were(spark, store):
    rows = ['{"a":1,"b":{"c":true}}', '{"x y":[1,"2",null],"é":2.5}', "{}", "{bad", "[1]", "7", '"s"', None, "null"]
    assert store.insert_json(texts(spark, list(enumerate(rows))), order="k") == 1
    assert docs(store) == [json.loads(t) for t in rows[:3]]
    assert [r[0] for r in store.rejects().orderBy("seq").select("raw").collect()] == ["{bad", "[1]", "7", '"s"', "", "null"]
    got = store.read().orderBy("seq").select(S.field("b.c", "boolean"), S.field("a", "bigint"), S.field("x y[1]")).first()
    assert got[:2] == (True, 1)


def test_an_empty_collection(spark, store):
    assert (store.version(), store.files(), docs(store)) == (0, [], [])
    assert store.update("a", "1", "2") == store.remove_by("a", None) == 0


def test_changes_by_type_and_order(spark, store):
    rows = [(i, json.dumps({"id": i, "open": ["1", 1, True, None, "x"][i % 5], "keep": {"n": i}})) for i in range(20)]
    store.insert_json(texts(spark, rows), order="k")
    store.insert(S.records(spark.createDataFrame([(["2018-02-23", "1", "3", "4", "5", "6", "0"],)], "record array<string>")))
    store.update("open", "1", "first")
    store.update("open", 1, 2.5, multi=True)
    store.remove_by("open", True)
    assert store.update("open", "no such", "z") == 5
    store.remove_by("keep.n", 19)
    want = []
    for i, t in rows:
        d = json.loads(t)
        if d["open"] is True or i == 19:
            continue
        d["open"] = "first" if i == 0 else 2.5 if d["open"] == 1 and not isinstance(d["open"], bool) else d["open"]
        want.append(d)
    want.append({"date": "2018-02-23", "open": "1", "high": "3", "low": "4", "close": "5", "volume": "6", "id": "0"})
    assert docs(store) == want
    assert docs(store, 1) == [json.loads(t) for _, t in rows]  # an older version is as it was
    assert store.remove_by("open", None) == 7 and len(docs(store)) == len(want) - 4
    store.remove("1")
    assert all(d.get("open") != "1" for d in docs(store))


def test_only_files_with_a_match_are_rewritten(spark, store):
    store.insert_json(texts(spark, [(i, json.dumps({"id": i, "open": str(i)})) for i in range(400)]), order="k")
    before = set(store.files())
    store.update("open", "7", "x")
    after = set(store.files())
    assert len(before - after) == len(after - before) == 1
    kept = {f: os.stat(f"{store.path}/data/{f}").st_mtime_ns for f in before & after}
    store.remove_by("open", "399")
    assert all(os.stat(f"{store.path}/data/{f}").st_mtime_ns == t for f, t in kept.items())


def test_an_append_goes_in_behind_another(spark, store, monkeypatch):
    other = S.DocumentStore(spark, store.path)
    write, calls = S.DocumentStore._write, []

    def late(self, rows, base):
        files = write(self, rows, base)
        if self is store and not calls:
            calls.append(other.insert_json(texts(spark, [(1, '{"id":"other"}')])))
        return files

    monkeypatch.setattr(S.DocumentStore, "_write", late)
    assert store.insert_json(texts(spark, [(1, '{"id":"mine"}')])) == 2 and calls == [1]
    assert sorted(d["id"] for d in docs(store)) == ["mine", "other"]


def test_a_change_of_the_same_file_is_made_anew(spark, store, monkeypatch):
    store.insert_json(texts(spark, [(i, json.dumps({"id": i, "open": "a"})) for i in range(4)], 1), order="k")
    other = S.DocumentStore(spark, store.path)
    write, calls = S.DocumentStore._write, []

    def late(self, rows, base):
        files = write(self, rows, base)
        if self is store and not calls:
            calls.append(other.update("open", "a", "other"))
        return files

    monkeypatch.setattr(S.DocumentStore, "_write", late)
    assert store.update("open", "a", "mine") == 3
    assert [d["open"] for d in docs(store)] == ["other", "mine", "a", "a"]


def test_a_version_is_put_in_place_once(store):
    store._put(1, [], [], "one")
    with pytest.raises(S.Conflict):
        store._put(1, [], [], "two")
    assert store._entry(1)["what"] == "one"


def test_the_log_is_read_from_the_last_whole_list(spark, store, monkeypatch):
    monkeypatch.setattr(S, "FULL_EVERY", 3)
    for i in range(7):
        store.insert_json(texts(spark, [(0, json.dumps({"id": i}))], 1))
    store.remove_by("id", 2)
    read = []
    entry = S.DocumentStore._entry
    monkeypatch.setattr(S.DocumentStore, "_entry", lambda self, v: read.append(v) or entry(self, v))
    assert [d["id"] for d in docs(store)] == [0, 1, 3, 4, 5, 6] and read == [8, 7, 6]


def test_the_first_match_is_the_same_for_every_split_size(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.json").write_text("".join(json.dumps({"id": f"a{i}", "open": "x" if i > 2 else "y"}) + "\n" for i in range(5)))
    (folder / "b.json").write_text("".join(json.dumps({"id": f"b{i}", "open": "x"}) + "\n" for i in range(20_000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    firsts, seconds = set(), set()
    try:
        for k, size in enumerate(("64k", "200k", "128m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            firsts.add(D.read_sequenced(spark, str(folder)).where("open = 'x'").select(F.min(F.struct("seq", "id"))).first()[0]["id"])
            store = S.DocumentStore(spark, str(tmp_path / f"s{k}"))
            store.insert_json(S.lines(spark, str(folder)), order="at")
            store.update("open", "x", "hit")
            seconds.add(store.read().where(S.matches("open", "hit")).select(S.field("id")).first()[0])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert firsts == seconds == {"a3"}
