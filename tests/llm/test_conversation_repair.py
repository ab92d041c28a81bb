"""Conversation repair against a search over all edits."""
import hashlib
import heapq
import random
import zlib

import pytest

from barframe.llm import conversation_repair as R

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit, repaired lines) by uniform-cost search over (rows done, last role); ties ASCII-least."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        for r in "ua":
            if r in NEXT[last]:
                name = {"u": "user", "a": "assistant"}[r]
                heapq.heappush(heap, (cost + 3, audit + "I", i, r, (*lines, f"{name}:")))
                if i < len(rows) and rows[i][3] not in ("blank", "duplicate"):
                    extra = 3 if rows[i][3] == "truncated" else 0
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, r, (*lines, f"{name}:{rows[i][2]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, lines))
            role = rows[i][1]
            if rows[i][3] not in ("blank", "duplicate") and role[:1] and role[:1] in NEXT[last]:
                extra = 3 if rows[i][3] == "truncated" else 0
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[:1], (*lines, f"{role}:{rows[i][2]}")))


def slow(table):
    convs = {}
    for c, t, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        out = convs.setdefault(c, [])
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else "".join(x for x in text if x not in ".!?") if h == 2 else text
        out += [(t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    result = []
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32]))
        seen, full = set(), []
        for t, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            full.append((t, role, text, fault))
        turns = [t for t, *_ in full if t is not None]
        cost, audit, lines = cheapest(full)
        result.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                       *(sum(r[3] == f for r in full) for f in ("blank", "duplicate", "truncated")),
                       sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(full, full[1:])),
                       cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=str)


def run(spark, table, partitions=None):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(3)
    return sorted([tuple(r) for r in R.repair_conversations(R.damaged(df), partitions).collect()], key=str)


def random_table(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "sage"]
    texts = ["Yes.", "no", "What?", "", " \n", None, "é!", "go on\x0b", "ok. "]
    return _rows(rng, roles, texts, convs, longest)


def _rows(rng, roles, texts, convs, longest):
    out = []
    for c in range(convs):
        for k in range(rng.randrange(1, longest)):
            text = rng.choice(texts)
            if text is not None and rng.random() < .5:
                text = f"{text} {rng.randrange(50)}{rng.choice(['', '.', '!'])}"
            turn = None if rng.random() < .05 else k + rng.randrange(2)
            out.append((None if c == 0 else c, turn, rng.choice(roles), text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    table = random_table(seed, 60, 14)
    assert run(spark, table) == slow(table)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_a_hot_conversation_over_many_ranges(spark, partitions):
    table = random_table(5, 6, 9) + [(77, t, r, x) for _, t, r, x in random_table(6, 25, 12)]
    assert run(spark, table, partitions) == slow(table)


def test_runs_and_powers_equal_single_steps():
    rng = random.Random(3)
    for _ in range(200):
        symbols = [s for _ in range(rng.randrange(6)) for s in rng.choice("suaSUA-+x") * rng.randrange(1, 40)]
        v = R.END
        for s in reversed(symbols):
            v = R._apply(R.power(s, 1), v)
        assert R.costs_behind(R.runs_of(symbols), R.END)[1] == v


def test_long_runs_are_unrolled_in_parts(monkeypatch):
    rows = [(k, "user", f"{k}.") for k in range(200)]
    whole = R.repair(rows)
    monkeypatch.setattr(R, "UNROLL", 7)
    assert R.repair(rows) == whole and whole["illegal"] == 199


def test_empty_table_dropped_rows_and_other_columns(spark):
    from pyspark.sql import functions as F

    assert run(spark, []) == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    df = spark.createDataFrame([(1, 0, "user", "Hi " * 50_000)], "conv_id long, turn long, role string, text string")
    names = ("conv", "piece", "pos", "seen", "row", "hash", "cost", "audit", "fault")
    wide = R.repair_conversations(R.damaged(df.select("*", *[F.lit("x").alias(n) for n in names])))
    assert [tuple(r) for r in wide.collect()] == slow([(1, 0, "user", "Hi " * 50_000)])
