"""SimHash groups, components and embedding groups against brute force."""
import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from barframe.llm import components as C
from barframe.llm import nn_descent as N
from barframe.llm import simhash as S


def labels_of(n, links):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def slow_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hs = [xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_components_of_random_and_worst_graphs(spark):
    rng = random.Random(3)
    n = 400
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(260)]
    links += [(400 + i, 401 + i) for i in range(60)] + [(500, 501 + i) for i in range(50)] + [(599 - i, 600) for i in range(40)]
    want = labels_of(601, links)
    got = {r["node"]: r["root"] for r in C.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert C.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_is_the_majority_of_shingle_hashes(spark):
    from pyspark.sql import functions as F

    for t in ["", None, "a", "A b", "a b c", "The cat sat on the mat the cat sat", "x\x0by\x0cz\tw", "Ä é 日本 b c d a"]:
        assert S.fingerprint(t) == slow_fingerprint(t)
    one = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t")).first()[0]
    assert one % (1 << 64) == S.fingerprint("a b c")


@pytest.mark.parametrize("block", [4, 1024])
def test_links_equal_brute_force_in_dense_clusters(spark, block):
    rng = random.Random(7)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 30)):
            x = base
            for _ in range(rng.randrange(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    links = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2]
    want = labels_of(len(fps), links)
    where = {x: i for i, x in enumerate(fps)}
    got = labels_of(len(fps), [(where[r["a"] % (1 << 64)], where[r["b"] % (1 << 64)])
                               for r in S.fingerprint_links(df, 2, block).collect()])
    assert got == want


def test_thresholds_sum_and_cost():
    cost, picks = S.allot([{-1: 0, 0: 9, 1: 20}, {-1: 0, 0: 1, 1: 2}, {-1: 0, 0: 1, 1: 5}], 0)
    assert sum(picks) == 0 and cost == 3 and picks == [-1, 1, 0]


def test_documents_and_representatives(spark, make_docs, odd_docs, no_docs):
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    near = base[:]
    near[200] = "changed"
    rows = [(9, " ".join(base), "a"), (3, " ".join(near), "b"), (5, " ".join(base), "a"), (4, None, "a"), (8, "", "b"),
            (6, " ".join(f"v{i}" for i in range(300)), "c")]
    docs = make_docs(rows)
    fps = {r[0]: slow_fingerprint(r[1]) for r in rows}
    ids = sorted(fps)
    lab = labels_of(len(ids), [(i, j) for i, j in itertools.combinations(range(len(ids)), 2)
                               if (fps[ids[i]] ^ fps[ids[j]]).bit_count() <= 2])
    out = {r["doc_id"]: r for r in S.document_groups(docs).collect()}
    assert {i: out[i]["component_id"] for i in ids} == {i: ids[l] for i, l in zip(ids, lab)}
    assert all(out[i]["fingerprint"] == f"{fps[i]:016x}" for i in ids)
    assert sorted(r["doc_id"] for r in S.keep_one(docs).collect()) == sorted({ids[x] for x in lab})
    odd = S.document_groups(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    clash = odd_docs.selectExpr("*", "1 as keep_id", "2 as KEEP_HASH", "3 as kept_id")
    assert S.keep_one(clash).columns == clash.columns and S.keep_one(clash).count() == S.keep_one(odd_docs).count()
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert len({slow_fingerprint(r["text"]) for r in odd_docs.collect()}) >= kept.count() >= 5
    assert S.document_groups(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0


def test_embedding_groups_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for size in [1] * 60 + [2] * 20 + [3, 7, 40, 90]:
        centre = rng.standard_normal(24)
        for _ in range(size):
            rows.append((k, [float(x) for x in (centre + rng.standard_normal(24) * 0.12).astype(np.float32)]))
            k += 1
    rows += [(k, rows[5][1]), (k + 1, [2 * x for x in rows[7][1]]), (k + 2, [0.0] * 24), (k + 3, None),
             (k + 4, [float("nan")] * 24), (k + 5, [None] * 24), (k + 6, []), (k + 7, [1.0] * 12), (k + 8, [1.0] * 12 + [0.0] * 12),
             (None, rows[0][1]), (k + 9, rows[5][1]), (k + 9, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for a, b in itertools.combinations(range(len(good)), 2) if len(good[a][1]) == len(good[b][1])
             and good[a][1] @ good[b][1] / np.linalg.norm(good[a][1]) / np.linalg.norm(good[b][1]) >= 0.9]
    lab = labels_of(len(good), links)
    want = []
    for i, (v, _) in enumerate(good):
        n = sum(i in p for p in links)
        comp = min(good[j][0] for j in range(len(good)) if lab[j] == lab[i])
        want.append((v, n, comp, v == comp))
    want += [(v, 0, v, True) for v, _ in rows if v is None or v in range(k + 2, k + 7)]
    got = [tuple(r) for r in N.near_duplicates(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert N.near_duplicates(df.where("false")).count() == 0


def test_block_counts_are_whole(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + rng.standard_normal(16) * 0.1]) for i in range(100)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T >= 0.9).sum(1) - 1).tolist()
    got = {r["vec_id"]: r["n_links"] for r in N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[i] for i in range(100)] == want


def two_dense_groups(size=40, dim=32, border=1):
    """Two groups of close vectors whose only links to each other are between ``border`` vectors of each."""
    rng = np.random.default_rng(11)

    def at(degrees):
        noise = np.append([0.0, 0.0], rng.standard_normal(dim - 2)) * 0.002
        return np.append([np.cos(np.radians(degrees)), np.sin(np.radians(degrees))], np.zeros(dim - 2)) + noise

    angles = [0.0] * (size - border) + [1.0] * border + [27.5] * (size - border) + [26.5] * border
    x = np.array([at(a) for a in angles])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cross = x[:size] @ x[size:].T >= 0.9
    assert cross.sum() == border * border and cross[size - border:, size - border:].all()
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_border_links_join_dense_groups(spark, monkeypatch):
    monkeypatch.setattr(N, "audit", lambda *a: N.Audit(1.0, [], 0.0))  # the search alone
    df = spark.createDataFrame(two_dense_groups(), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in N.near_duplicates(df).collect()}
    assert {r["component_id"] for r in got.values()} == {0} and sum(r["kept"] for r in got.values()) == 1
    assert got[39]["n_links"] == 40 and got[79]["n_links"] == 40 and got[0]["n_links"] == 39


def test_a_failed_audit_ends_in_a_whole_comparison(spark, monkeypatch):
    monkeypatch.setattr(N, "REACH", 0)  # a search that meets nobody
    monkeypatch.setattr(N, "ROUNDS", 1)
    monkeypatch.setattr(N, "AUDITED", 4)
    monkeypatch.setattr(N, "LINKED", 3)
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(60)]
    rows += [(60 + i, (np.array(rows[2 * i][1]) + rng.standard_normal(24) * 0.01).tolist()) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in N.near_duplicates(df).collect()}
    assert all(got[2 * i] == (1, 2 * i) == got[60 + i] for i in range(10))
    assert sum(n for n, _ in got.values()) == 20


def test_audit_judges_nodes_and_samples_until_some_have_links(spark, monkeypatch):
    monkeypatch.setattr(N, "AUDITED", 8)
    rng = np.random.default_rng(9)
    hot = rng.standard_normal(24)
    rows = [(i, (hot + rng.standard_normal(24) * 0.01).tolist(), 24, 0) for i in range(60)]
    for i in range(60, 100, 2):
        x = rng.standard_normal(24)
        rows += [(i, x.tolist(), 24, i), (i + 1, (x + rng.standard_normal(24) * 0.01).tolist(), 24, i + 1)]
    rows += [(i, rng.standard_normal(24).tolist(), 24, i) for i in range(100, 300)]
    nodes = spark.createDataFrame(rows, "id long, vec array<double>, dims int, root long")
    recall, missed, missing = N.audit(nodes, 24, 0.9)
    assert missing == 0.0  # all 300 were sampled
    assert recall == 0.6  # of 100 nodes with links the 40 outside the hot group miss theirs, by links it is 0.989
    assert {(r["u"], r["v"]) for m in missed for r in m.collect()} == {
        p for i in range(60, 100, 2) for p in ((i, i + 1), (i + 1, i))}


def test_audit_ends_by_a_bound_where_links_are_rare(spark, monkeypatch):
    monkeypatch.setattr(N, "AUDITED", 16)
    monkeypatch.setattr(N, "AUDIT_LEAST", 40)
    rng = np.random.default_rng(12)
    rows = [(i, rng.standard_normal(24).tolist(), 24, i) for i in range(400)]
    nodes = spark.createDataFrame(rows, "id long, vec array<double>, dims int, root long")
    seen = []
    compared = N._compared
    monkeypatch.setattr(N, "_compared", lambda n, sample, *a: seen.append(sample["id"].to_pylist()) or compared(n, sample, *a))
    found = N.audit(nodes, 24, 0.9)
    assert found.recall == 1.0 and [len(s) for s in seen] == [16, 24]
    assert abs(found.missing_at_most - (1 - N.ERROR ** (1 / 40))) < 1e-9
    assert all(m.count() == 0 for m in found.missed)
    first = set(seen[0] + seen[1])
    seen.clear()
    N.audit(nodes, 24, 0.9, 1)
    assert set(seen[0] + seen[1]) != first  # another round judges other nodes


@pytest.mark.parametrize("missing,sampled", [(0, 1), (0, 300), (3, 50), (50, 50), (49, 50), (12, 6_144)])
def test_bound_on_missing_nodes_is_exact(missing, sampled):
    p = N.missing_at_most(missing, sampled)
    if missing == sampled:
        assert p == 1.0
        return
    exact = sum(Fraction(math.comb(sampled, k)) * Fraction(p) ** k * (1 - Fraction(p)) ** (sampled - k)
                for k in range(missing + 1)) if sampled < 400 else None
    if exact is not None:
        assert abs(float(exact) - N.ERROR) < 1e-9
    assert missing / sampled < p


def test_a_hub_meets_in_runs_over_many_keys(spark):
    rows = [(i, 0, True) for i in range(1, 1_500)] + [(i, i + 1, False) for i in range(2_000, 2_050)]
    lists = spark.createDataFrame(rows, "u long, v long, fresh boolean")
    got = N.meetings(lists, 5).collect()
    runs = {}
    for r in got:
        runs.setdefault(r["meeting"], set()).add(r["member"])
    hub = [m for m in runs.values() if len(m) > 2 and max(m) < 2_000]
    assert set().union(*hub) | {0} == set(range(1_500)) and max(map(len, hub)) <= 2 * N.MEETING and len(hub) == 24
    assert {frozenset(m) for m in runs.values() if max(m) >= 2_000 and len(m) == 2} == {
        frozenset((i, i + 2)) for i in range(2_000, 2_049)}
    again = N.meetings(lists.repartition(7), 5).collect()
    assert sorted(got) == sorted(again)


def test_blocks_grow_with_their_component(spark):
    sizes = spark.range(1).selectExpr("explode(array(1, 128, 2048, 20000, 1000000)) as size")
    assert [r[0] for r in sizes.selectExpr(N.block_sql(64)).collect()] == [128, 128, 128, 1_250, 2_048]
    assert [r[0] for r in sizes.selectExpr(N.block_sql(4_096)).collect()] == [128, 128, 128, 512, 512]


def test_embedding_groups_do_not_depend_on_the_run(spark):
    rng = np.random.default_rng(21)
    rows = [(i, (c + rng.standard_normal(16) * 0.11).tolist())
            for i, c in enumerate(np.repeat(rng.standard_normal((40, 16)), 30, axis=0))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = N.near_duplicates(df, with_audit=True).collect()
    two = N.near_duplicates(df.repartition(5).orderBy(F.desc("vec_id")), with_audit=True).collect()
    assert sorted(one) == sorted(two)
    assert one[0]["audit_recall"] >= N.RECALL and 0.0 <= one[0]["missing_at_most"] < 0.1
