"""Suffix-array deduplication against brute force over all 50-byte strings."""
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from barframe.llm import suffix_dedup as S


def slow(rows, length=50):
    """rows: (id or None, bytes)."""
    rank = {i: float("inf") if i is None else i for i, _ in rows}
    first = {}
    for i, t in sorted(rows, key=lambda r: rank[r[0]]):
        for p in range(len(t) - length + 1):
            first.setdefault(t[p:p + length], rank[i])
    out = []
    for i, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < rank[i]:
                gone[p:p + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                   for r in S.digests(S.remove_repeats(df)).collect()], key=str)


def random_rows(seed, letters):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(letters) for _ in range(rng.randrange(30, 160))) for _ in range(12)]
    hot = "".join(rng.choice("abcdefgh") for _ in range(120))
    rows = []
    for i in range(120):
        t = ""
        for _ in range(rng.randrange(6)):
            r = rng.random()
            if r < .5:
                x = rng.choice(pool)
                t += x[rng.randrange(len(x)):]
            elif r < .7:
                t += hot[rng.randrange(40):rng.randrange(60, 120)]
            elif r < .8:
                t += "a" * rng.randrange(10, 200)
            else:
                t += "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(100)))
        rows.append((rng.randrange(1000) if i % 10 else i, t))
    return rows + rows[:3] + [(None, rows[0][1]), (None, hot), (5000, None), (5001, "")]


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abé日 \0"), (3, "abcd \n")])
def test_random_texts(spark, seed, letters):
    rows = random_rows(seed, letters)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert run(df) == slow([(i, (t or "").encode()) for i, t in rows])


def test_frequent_pieces_are_dealt_string_by_string(spark, monkeypatch):
    rng = random.Random(5)
    hot = "".join(rng.choice("abcdefgh ") for _ in range(70))
    rows = [(i, f"{rng.random()}{hot[rng.randrange(15):]}{rng.random()}") for i in range(200)]
    seen = []
    whole = S._sample
    monkeypatch.setattr(S, "_sample", lambda *a: seen.append(whole(*a)) or seen[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df) == slow([(i, t.encode()) for i, t in rows])
    assert seen[0][1]  # some piece was frequent


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in odd_docs.collect()]
    assert run(odd_docs) == slow(rows)
    assert run(no_docs) == []


def test_spans_and_bytes_of_a_shared_passage(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs away from it"
    df = spark.createDataFrame([(7, f"xx {passage} yy"), (3, f"{passage}!")], "doc_id int, text string")
    got = {r["doc_id"]: r for r in S.remove_repeats(df).collect()}
    assert bytes(got[3]["kept"]).decode() == f"{passage}!" and got[3]["spans"] == []
    assert bytes(got[7]["kept"]).decode() == "xx  yy"
    assert [tuple(s) for s in got[7]["spans"]] == [(3, 3 + len(passage))]


def test_long_text_over_several_strips(spark, monkeypatch):
    geo = S.Geometry()
    rng = random.Random(9)
    raw = np.frombuffer(bytes(rng.choice(b"abcd") for _ in range(5_000)), np.uint8)
    starts = np.array([0, 700, 700, 2_100, 2_149, 5_000])
    whole = geo.anchors(raw, starts)
    monkeypatch.setattr(S, "_STRIP", 333)
    assert all((a == b).all() for a, b in zip(whole, geo.anchors(raw, starts)))


def test_hashes_of_anchors_are_dealt_evenly():
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(50, 900))) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    ranges = 16
    sizes = np.zeros(ranges, int)
    for out in S._suspects([batch], S.Geometry(), 4, ranges):
        for part, kind, blob in zip(*(out.column(i).to_pylist() for i in range(3))):
            if kind < 0:
                sizes[part] += len(S._unpack(blob)[0])
    assert sizes.sum() > 10_000
    assert sizes.max() < 1.25 * sizes.mean() and sizes.min() > 0.75 * sizes.mean()


def test_multikey_quicksort_equals_sorted():
    rng = random.Random(4)
    rows = [bytes(rng.choice(b"ab\0") for _ in range(4)) * 6 if rng.random() < .5 else bytes(rng.choice(b"ab") for _ in range(24))
            for _ in range(500)]
    order, group = S.ranks(np.array([list(r) for r in rows], np.uint8))
    assert [rows[i] for i in order] == sorted(rows)
    assert all((group[i] == group[j]) == (rows[i] == rows[j]) for i in range(0, 500, 7) for j in range(500))


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError):
        S.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
