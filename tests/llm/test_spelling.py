"""Spelling variants against brute force over all pairs of words."""
import random
import re
import string
import zlib
from collections import Counter

import pytest

from barframe.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow(rows, slip_every=199, min_length=6, min_count=5, times=5):
    seen = Counter()
    for i, t in rows:
        for w in RUN.findall(t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slip_every and h % slip_every == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            seen[w] += 1
    words = {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}
    out, form = {}, {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= times * n:
            form[w] = best
        out[w] = (n, len(close))
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, n, k, form.get(w), words.get(form.get(w)), root(w)) for w, (n, k) in out.items())


def run(df, **kw):
    return sorted(tuple(r) for r in S.spelling_variants(df, **kw).select("word", "n", "n_near", "form", "form_n", "root").collect())


def misspelt(seed, letters, lengths):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(30)]
    words = []
    for w in base:
        n = rng.choice([5, 30, 200])
        words += [w] * n
        for _ in range(6):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
            words += [v] * rng.randrange(1, 9)
            words += [(v + rng.choice(letters))] * rng.randrange(1, 7)
    rng.shuffle(words)
    rows = []
    while words:
        part, words = words[:40], words[40:]
        rows.append((len(rows), " ".join(x.title() if rng.random() < .2 else x for x in part) + rng.choice(["", ".", "1x"])))
    return rows


@pytest.mark.parametrize("seed, letters, lengths", [
    (1, "abcdefgh", [6, 7, 8]), (2, "abcdéÉÿ×", [6, 9]), (3, "ab", [6, 7, 8, 9]), (4, "abc", [30, 31, 32, 33, 34, 35, 60])])
def test_random_words(spark, seed, letters, lengths):
    rows = misspelt(seed, letters, lengths)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df) == slow(rows)
    assert run(df, slip_every=None, min_count=2, times=3) == slow(rows, None, min_count=2, times=3)


def test_chains_lead_to_the_last_form(spark):
    rows = [(1, "abcdefgh " * 700 + "abcdefgx " * 130 + "abcdefyx " * 25 + "abcdezyx " * 5)]
    got = {r[0]: r for r in run(spark.createDataFrame(rows, "doc_id long, text string"), slip_every=None)}
    assert got["abcdezyx"][3:] == ("abcdefyx", 25, "abcdefgh") and got["abcdefgh"][3:] == (None, None, "abcdefgh")


def test_ties_take_the_smallest_form(spark):
    rows = [(1, "aaaaaa " * 5 + "aaaaac " * 50 + "aaaaab " * 50)]
    got = {r[0]: r for r in run(spark.createDataFrame(rows, "doc_id long, text string"), slip_every=None)}
    assert got["aaaaaa"] == ("aaaaaa", 5, 2, "aaaaab", 50, "aaaaab")


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert run(odd_docs, min_count=1, min_length=2) == slow(rows, min_count=1, min_length=2)
    assert run(no_docs) == []


def test_very_long_words(spark):
    w = "ab" * 1_000
    rows = [(i, f"{w} {w[1:]} {w}c") for i in range(6)] + [(9, w + "c")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(len(r[0]), r[0][-1]): r[1:4] for r in run(df, slip_every=None)}
    assert got[2_000, "b"][:2] == (6, 2) and got[2_000, "b"][2] == w + "c" and got[2_001, "c"][:2] == (36, 1)


def test_symbols_grow_with_the_vocabulary():
    assert S.symbols_for(0) == S.symbols_for(400_000) == 4 < S.symbols_for(10 ** 7) < S.symbols_for(10 ** 10) <= 36
