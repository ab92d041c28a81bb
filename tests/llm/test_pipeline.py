"""The pipeline's stages on their own inputs, against plain Python and the operators' own results."""
import hashlib
import itertools

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from barframe.llm import bpe_trie, common, gam, queries, quality_rules, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Documents before each stage, and the last stage's result."""
    out = [common.read_table(spark, SF, "documents")]
    for k, (_, stage) in enumerate(P.STAGES):
        out.append(common.materialise(stage(spark, out[-1], SF), f"test-stage-{k}"))
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_columns_are_kept_until_the_last_stage(kept):
    assert [len(P.STAGES), *(d.columns for d in kept[1:-1])] == [5, *[kept[0].columns] * 4]


def test_rejected_documents_go(spark, kept):
    labels = common.read_table(spark, SF, "labels")
    good = {r["doc_id"] for r in quality_rules.quality_verdicts(kept[0], labels).collect() if r["kept"]}
    assert texts(kept[1]) == [x for x in texts(kept[0]) if x[0] in good] and len(good) < kept[0].count()
    good = {r["doc_id"] for r in gam.quality_scores(kept[1], labels).collect() if r["predicted"]}
    assert texts(kept[2]) == [x for x in texts(kept[1]) if x[0] in good]


def test_one_document_of_each_group_stays(kept):
    docs = texts(kept[2])
    fp = [simhash.fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(docs)), 2):
            if group[i] != group[j] and (fp[i] ^ fp[j]).bit_count() <= 2:
                low = min(group[i], group[j])
                group[i] = group[j] = low
                changed = True
    assert texts(kept[3]) == [docs[i] for i in sorted(set(group))]


def test_sources_meet_their_budgets(kept):
    size, taken, largest = {}, {}, {}
    for r in kept[3].collect():
        n = len(r["text"].split())
        size[r["source"]] = size.get(r["source"], 0) + n
        largest[r["source"]] = max(largest.get(r["source"], 0), n)
    for r in kept[4].collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= sum(largest.values()) / 2 + len(size)
    assert set(texts(kept[4])) <= set(texts(kept[3]))  # whole texts only
    assert all(taken.get(s, 0) <= 2 * n for s, n in size.items())
    assert {r["doc_id"] for r in kept[4].collect()} <= {r["doc_id"] for r in kept[3].collect()}


def test_every_row_of_the_mix_is_encoded(kept):
    lib = Tokenizer.from_file(bpe_trie.default_path())
    want = []
    for i, t in texts(kept[4]):
        ids = lib.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r) for r in kept[5].collect()) == sorted(want)


def test_run_is_the_stages(spark, kept):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, kept[5].collect()))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    from oracle_util import compare, duck

    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.SQL[name])
    assert r["cols_match"] and r["values_match"], r


def test_native_plans_have_no_python(spark):
    for name in ("op2_mix_sources", "op5_quality_rules", "op10_quote_links"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "Cartesian", "NestedLoop")), name


def test_empty_pipeline(spark):
    docs = common.read_table(spark, SF, "documents").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


CLASHES = ("kept_id", "keep_id", "keep_hash", "kept_hash", "source_size", "target", "taken", "copy", "predicted", "rep",
           "component_id", "epochs", "band", "words", "label", "Node", "root", "budget")


def test_stages_on_odd_rows_with_clashing_columns(spark, odd_docs):
    docs = odd_docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        rows = out.collect()
        assert all(r[c] == "clash" for r in rows for c in CLASHES)
        given = {(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()}
        assert {(r["doc_id"], r["text"], r["source"]) for r in rows} <= given
        again = stage(spark, docs.repartition(3), SF).select("doc_id", "text", "source").collect()
        assert sorted(map(str, again)) == sorted(str(r) for r in out.select("doc_id", "text", "source").collect())
    assert P.quality_filter(spark, docs, SF).count() == 0  # fifty words or more that do not repeat: none has them
    ids = [r["doc_id"] for r in P.near_dedup(spark, docs, SF).select("doc_id").collect()]
    assert sorted(map(str, ids)) == ["1", "1", "2", "5", "7", "None"]  # id 1 has two texts; 2, 3 and 4 have no words
    mixed = [str(r["doc_id"]) for r in P.mix_sources(spark, docs, SF).collect()]
    assert [mixed.count(i) for i in "234"] == [1, 1, 1]
    digests = P.encode(spark, docs, SF).collect()
    assert len(digests) == docs.count()
    nothing = [r["ids_sha256"] for r in digests if r["doc_id"] in (2, 3)]
    assert nothing == [hashlib.sha256(b"").hexdigest()] * 2
