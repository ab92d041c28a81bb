"""Quality rules, classifier, toxicity and mixing against plain Python and planted cases."""
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barframe.llm import gam as G
from barframe.llm import mixing as M
from barframe.llm import quality_rules as Q
from barframe.llm import toxicity as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    w = WORD.findall(text or "")
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {p for ps in at.values() if len(ps) > 1 for i in ps for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def odd_texts():
    rng = random.Random(2)
    out = [None, "", " ", "a", "a a a", "a a a a", "a b c a b c", "a b c d a b c", "x\x0by \x0c z", " lead", "trail \n",
           "é日 #*$%&|<> |", "a\n\n a\na\nb \nb ", "\x85 \xa0 b"]
    for _ in range(60):
        out.append("".join(rng.choice(["a", "b", "c", " ", " ", "\n", "é", "#", "\t"]) for _ in range(rng.randrange(200))))
    return out


def test_counts_equal_plain_python(spark, make_docs, odd_docs, no_docs, no_labels):
    texts = odd_texts()
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in Q.text_counts(docs).collect()}
    assert got == {i: slow_counts(t) for i, t in enumerate(texts)}
    sizes = {r["doc_id"]: r["size"] for r in M.mix(docs).collect()}
    assert sizes == {i: slow_counts(t)[0] for i, t in enumerate(texts)}
    out = Q.quality_verdicts(odd_docs, no_labels).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])
    assert Q.quality_verdicts(no_docs, no_labels).count() == 0
    assert Q.keep_good(odd_docs, no_labels).columns == odd_docs.columns


def test_binomial_tail_is_exact(spark):
    for n, k, p in [(10, 0, 0.1), (500, 3, 0.02), (2000, 5, 0.004), (100000, 350, 0.004), (50, 30, 0.1)]:
        got = spark.range(1).selectExpr(f"{n}L as n", f"{k}L as k").select(F.expr(Q.binomial_tail_sql("n", "k", p))).first()[0]
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p)
                            + (n - j) * math.log(1 - p)) for j in range(k + 1)) if k <= n * p else 1.0
        assert got == pytest.approx(want, rel=1e-9)


def test_proven_cutoffs_reject_bad_and_keep_good(spark, make_docs):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(3600):
        good = i % 9 != 0
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
        text = " ".join(words if good else [w + "$$$" for w in words])
        rows.append((i, text, "s"))
        labels.append((i, int(good)))
    docs, lab = make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int")
    out = {r["doc_id"]: r["kept"] for r in Q.quality_verdicts(docs, lab).collect()}
    assert all(out[i] == bool(q) for i, q in labels)
    few = {r["doc_id"]: r["kept"] for r in Q.quality_verdicts(docs, lab.where("doc_id < 90")).collect()}
    assert all(few.values())  # too few labels prove nothing
    cuts = Q.proven_cutoffs(Q.with_base_rules(Q.text_counts(docs)), lab.selectExpr("doc_id", "quality = 1 as good")).collect()
    assert {r["rule"] for r in cuts} >= {"symbols"} and all(r["band"] == 0 for r in cuts)


def test_mix_meets_budgets_exactly(spark, make_docs, odd_docs, no_docs):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["a"] * 6 + ["b", "c", "d", None])) for i in range(3000)]
    docs = make_docs(rows)
    out = M.mix(docs).collect()
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    order = sorted((s for s in size if s is not None)) + [None]
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, total = {}, set(order), 1.5 * sum(size.values())
    while True:
        level = (total - sum(target.values())) / sum(w[s] for s in left)
        over = [s for s in left if level * w[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left.remove(s)
    target.update({s: level * w[s] for s in left})
    taken = {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert taken == {s: round(target[s]) for s in order}
    again = M.mix(docs.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    mixed = M.mixed_documents(docs)
    words, largest, whole = {}, {}, {i: t for i, t, _ in rows}
    for i, t, s in rows:
        largest[s] = max(largest.get(s, 0), len(t.split()))
    for r in mixed.collect():
        assert r["text"] == whole[r["doc_id"]]
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    assert all(abs(words[s] - taken[s]) <= largest[s] / 2 for s in order) and mixed.columns == docs.columns
    assert {r["doc_id"] for r in out if r["size"] == 0} <= {r["doc_id"] for r in mixed.collect()}
    assert M.mix(odd_docs).count() == odd_docs.count() and M.mix(no_docs).count() == 0
    assert M.mixed_documents(odd_docs).columns == odd_docs.columns and M.mixed_documents(no_docs).count() == 0


def test_gam_learns_single_and_paired_effects():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    model = G.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95 and (0, 1) in model.pairs
    assert (G.fit(x[:0], y[:0]).score(x[:2]) == 0.5).all()
    assert (G.fit(x[:50], np.ones(50)).score(x[:9]) > 0.9).all()


def test_quality_scores(spark, make_docs, odd_docs, no_docs, no_labels):
    rng = random.Random(8)
    rows = [(i, " ".join((f"w{rng.randrange(900)}" + ("" if i % 4 else "%%%")) for _ in range(80)), "s") for i in range(600)]
    lab = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(600)] + [(3, None), (None, 0)], "doc_id long, quality int")
    out = G.quality_scores(make_docs(rows), lab).collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 80 and all(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held)
    odd = G.quality_scores(odd_docs, lab).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in G.quality_scores(odd_docs, no_labels).collect()} == {0.5}
    assert G.quality_scores(no_docs, lab).count() == 0
    assert G.keep_good(odd_docs, lab).columns == odd_docs.columns


def test_folding_and_exceptions():
    m = X.Matcher({"idiot": 2.0, "trash": 1.0, "lout": 3.0, "gnar*": 4.0})
    found = lambda t: sum(m.matches(t).values())
    assert found("What an IDIOT!") == 2 and found("1d10t") == 2 and found("іdіоt") == 2 and found("ｉｄｉｏｔ") == 2
    assert found("idi­ot") == 2 and found("ídïót") == 2 and found("l0ut") == 3 and found("1out") == 3
    assert found("idiotic") == 0 and found("xidiot") == 0 and found("idiot$$$") == 2 and found("") == 0
    assert found("gnarly gnarish") == 8 and found("ungnarly") == 0
    assert found("take out the trash") == 1 and found("the trash\ncan") == 0 and found("trash trash can") == 1
    assert m.strength("idiot") > m.strength("idiot " + "word " * 4000) > 0


def test_signs_are_letters_and_word_ends():
    m = X.Matcher({"moron": 2.0, "idiot": 3.0, "imbecile": 5.0, "loser": 7.0})
    found = lambda t: sum(m.matches(t).values())
    assert found("m0ron!") == 2 and found("you m0r0n!!") == 2 and found("1d10t!") == 3 and found("+m0ron+") == 2
    assert found("1mbec1le!!") == 5 and found("!mbec1le") == 5 and found("1mbec!le") == 5 and found("|0ser|") == 7
    assert found("moron!") == 2 and found("m0rons") == 0 and found("xm0ron!") == 0 and found("m0ron1") == 0


def test_toxicity_scores(spark, make_docs, odd_docs, no_docs, no_labels):
    rng = random.Random(3)
    bad = ["blarg", "snurf", "quonk"]
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(800)}" for _ in range(rng.randrange(5, 200))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(toxic)))
    # Copies of one toxic text: its other words must not become toxic.
    rows += [(1000 + i, rows[6][1] + " aa bb cc", "s") for i in range(300)]
    labels += [(1000 + i, 1, 1) for i in range(300)]
    rows += [(2000, "an un-labelled Snуrf... bl4rg", "s"), (2001, "aa bb cc and nothing else", "s")]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in X.toxicity_scores(make_docs(rows), lab).collect()}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i]["held_out"] for i in held)
    assert all(out[i]["predicted"] == t for i, _, t in labels if i in set(held))
    assert out[2000]["predicted"] == 1 and out[2001]["predicted"] == 0
    odd = X.toxicity_scores(odd_docs, lab).collect()
    assert len(odd) == odd_docs.count() and all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in odd)
    assert len({r["score"] for r in X.toxicity_scores(odd_docs, no_labels).collect()}) == 1
    assert X.toxicity_scores(no_docs, lab).count() == 0
