"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``d`` bits of each other must, for any cut of the bits into parts with thresholds that sum to
``d - parts + 1``, lie within its threshold on at least one part (a threshold of -1 leaves a part out). The parts hold
bits that go together: correlated bits say the same thing twice, and apart they would make two parts worse. Thresholds
are given out by dynamic programming over the parts, minimising what probing costs: the probes (all values within the
threshold of a fingerprint's own) and the candidate pairs, estimated from how often values of a part are shared. All
bits are counted over all distinct fingerprints.

A probe meets, under its part and value, all fingerprints that have that value, and their whole distance is verified.
Candidates never become rows: a task goes through the sorted keys, links each key's fingerprints, and returns only
what ties them together (one row per fingerprint and key at most). A key with more fingerprints than ``BLOCK`` is not
gone through: the bits it does not fix are cut in ``d + 1`` parts, one of which must agree, and its fingerprints go to
a next round under the finer keys, until all keys are small. Distinct fingerprints differ, so the rounds end.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import fresh, materialise
from barframe.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BITS = 64
# Fingerprints of one key that a task compares with each other.
BLOCK = 1_024
# What moving a probe costs, in comparisons of two fingerprints.
PROBE_COST = 300.0
# Numbers of parts that are weighed against each other.
PARTS = (2, 3, 4)

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_OFFSET = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one whole text as an unsigned 64-bit integer.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles keep their repeats. A text of
    fewer words than a shingle is one shingle; a text without words has the fingerprint 0.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        hashes = np.array([xxh64_intdigest(joined, seed)], np.uint64)
    else:
        ends = list(itertools.accumulate([len(w) + 1 for w in words]))
        starts = [0, *ends[:n - shingle_words]]
        hashes = np.fromiter([xxh64_intdigest(joined[s:e - 1], seed) for s, e in zip(starts, ends[shingle_words - 1:])],
                             np.uint64, n - shingle_words + 1)
    per_byte = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE_OFFSET).ravel(), minlength=2048)
    counts = (per_byte.reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                 seed: int = SEED) -> DataFrame:
    """``keys`` columns and ``fp`` (the fingerprint's 64 bits as a signed long), one row per input row."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle_words, seed) for t in b.column(b.num_columns - 1).to_pylist()],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names[:-1], "fp"])

    rows = docs.select(*[docs[k].alias(f"k{i}") for i, k in enumerate(keys)], docs[text_col].alias("text"))
    kinds = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys)))
    out = rows.mapInArrow(run, f"{kinds}, fp bigint")
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "fp")


def _bits(x: np.ndarray) -> np.ndarray:
    return np.unpackbits(x.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each pair of bits how many have both set (64 x 64). Each task sums
    its own; 4,097 sums reach the driver whatever the input."""

    def run(batches):
        total, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            x = _bits(np.asarray(b.column(0))).astype(np.float32)
            total += len(x)
            both += x.T @ x
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(both.ravel(), total))], names=["at", "n"])

    sums = (fps.select("fp").mapInArrow(run, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BITS * BITS + 1)
    for r in sums:
        out[r["at"]] = r["n"]
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` parts of nearly equal size, correlated bits together: a part starts with the two
    free bits that are correlated most and takes, one by one, the free bit closest to those it has."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.outer(np.diag(cov), np.diag(cov)), 1e-12))
    near = np.abs(cov) / spread
    np.fill_diagonal(near, 0.0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        if k == parts - 1:
            part = free[:]
        else:
            sub = near[np.ix_(free, free)]
            i, j = np.unravel_index(np.argmax(sub), sub.shape)
            part = [free[i], free[j]] if i != j else free[:2]
            while len(part) < size:
                left = [f for f in free if f not in part]
                part.append(left[int(np.argmax(near[np.ix_(left, part)].sum(1)))])
        out.append(sorted(part))
        free = [f for f in free if f not in part]
    return out


def mask_of(bits: list[int]) -> int:
    """A mask of these bits as a signed 64-bit integer."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def shared_pairs(fps: DataFrame, masks: list[int]) -> list[float]:
    """For each mask: how many pairs of fingerprints agree on all its bits."""
    each = ", ".join(f"named_struct('part', {i}, 'v', fp & {m}L)" if m != -(1 << 63) else
                     f"named_struct('part', {i}, 'v', fp & cast('-9223372036854775808' as bigint))"
                     for i, m in enumerate(masks))
    sums = (fps.select(F.explode(F.expr(f"array({each})")).alias("x")).groupBy("x.part", "x.v")
            .agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy("part")
            .agg(F.sum(F.expr("n * (n - 1) / 2")).alias("pairs")).collect())
    out = [0.0] * len(masks)
    for r in sums:
        out[r["part"]] = r["pairs"]
    return out


def allot(costs: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds for the parts, of least cost, that sum to ``budget``; ``costs[part][threshold]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for of in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, picks) in best.items():
            for t, c in of.items():
                if total + t not in step or cost + c < step[total + t][0]:
                    step[total + t] = (cost + c, [*picks, t])
        best = step
    return best[budget]


def plan_parts(fps: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """The parts to probe, as (bits, threshold), for the fingerprints at hand."""
    n, both = bit_moments(fps)
    if n < 2:
        return []
    cuts = [correlated_parts(n, both, m) for m in PARTS]
    flat = [part for cut in cuts for part in cut]
    pairs = shared_pairs(fps, [mask_of(p) for p in flat])
    p = np.clip(np.diag(both) / n, 0.0, 1.0)
    differ = 2 * p * (1 - p)
    plans, at = [], 0
    for cut in cuts:
        costs = []
        for part in cut:
            odds = differ[part] / (1 - differ[part])
            ways, probes, of = np.array([1.0] + [0.0] * max_bits), 0.0, {-1: 0.0}
            for o in odds:  # elementary symmetric sums: how much more pairs a threshold lets in
                ways[1:] = ways[1:] + ways[:-1] * o
            for t in range(max_bits + 1):
                probes += _choose(len(part), t)
                of[t] = PROBE_COST * n * probes + pairs[at] * ways[:t + 1].sum()
            costs.append(of)
            at += 1
        plans.append((*allot(costs, max_bits - len(cut) + 1), cut))
    _, picks, cut = min(plans, key=lambda x: x[0])
    return [(part, t) for part, t in zip(cut, picks) if t >= 0]


def _choose(n: int, k: int) -> float:
    out = 1.0
    for i in range(k):
        out = out * (n - i) / (i + 1)
    return out


def _tie(x: np.ndarray, own: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Fingerprints of one key -> those linked to a smaller one here, and the smallest they are tied to."""
    g = len(x)
    adj = np.bitwise_count(x[:, None] ^ x[None, :]) <= max_bits
    adj &= own[:, None] | own[None, :]
    np.fill_diagonal(adj, False)
    if not adj.any():
        return None
    np.fill_diagonal(adj, True)
    label = np.arange(g)
    while True:
        low = np.where(adj, label[None, :], g).min(1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    tied = label != np.arange(g)
    return (x[tied], x[label[tied]]) if tied.any() else None


def _submasks(fixed: int, parts: int) -> list[int]:
    """The bits not in ``fixed`` (unsigned), dealt to ``parts`` masks."""
    free = [b for b in range(BITS) if not fixed >> b & 1]
    return [sum(1 << b for b in free[k::parts]) for k in range(parts) if free[k::parts]]


def _mixed(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash two 64-bit integers to one. Keys that fall together only make candidates, which are verified."""
    h = (key ^ (more + np.uint64(0x9E3779B97F4A7C15) + (key << np.uint64(6)) + (key >> np.uint64(2))))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _probe_keys(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(key, fixed, fp, own): each fingerprint under its own value of every part, and as a probe under the values
    within the part's threshold."""
    jobs = []
    for k, (part, t) in enumerate(plan):
        mask = sum(1 << b for b in part)
        flips = [sum(1 << b for b in c) for d in range(t + 1) for c in itertools.combinations(part, d)]
        jobs.append((k, mask, flips))

    def run(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                x = np.asarray(b.column(0)).view(np.uint64)
                for k, mask, flips in jobs:
                    for f in flips:
                        key = _mixed(np.full(len(x), k + 1, np.uint64), (x & np.uint64(mask)) ^ np.uint64(f))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)),
                             pa.array(np.full(len(x), mask, np.uint64).view(np.int64)),
                             pa.array(x.view(np.int64)), pa.array(np.full(len(x), f == 0))],
                            names=["key", "fixed", "fp", "own"])

    return fps.select("fp").mapInArrow(run, "key bigint, fixed bigint, fp bigint, own boolean")


def _link_round(keyed: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(a, b, key, fixed, own) from keyed fingerprints: ties (a, b) of small keys; of large keys the fingerprints
    under finer keys (b null)."""

    def finer(key, fixed, x, own):
        made = [[], [], [], []]
        for f in np.unique(fixed):
            at = fixed == f
            for k, m in enumerate(_submasks(int(f), max_bits + 1)):
                sub = x[at] & np.uint64(m)
                made[0].append(_mixed(key[at] + np.uint64(k), sub))
                made[1].append(np.full(at.sum(), int(f) | m, np.uint64))
                made[2].append(x[at])
                made[3].append(own[at])
        return [np.concatenate(c) for c in made]

    def divisible(fixed) -> bool:
        return BITS - int(fixed).bit_count() > max_bits

    def run(batches):
        def out(a, b, key=None, fixed=None, own=None):
            n = len(a)
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), none if b is None else pa.array(b.view(np.int64)),
                 none if key is None else pa.array(key.view(np.int64)),
                 none if fixed is None else pa.array(fixed.view(np.int64)),
                 pa.nulls(n, pa.bool_()) if own is None else pa.array(own)],
                names=["a", "b", "key", "fixed", "own"])

        held, passing = None, None  # rows of the key that the batch before ended in; the large key being passed on
        with np.errstate(over="ignore"):
            for b in itertools.chain(batches, [None]):
                if b is not None:
                    rows = [np.asarray(b.column(i)).view(np.uint64) for i in range(3)] + [
                        b.column(3).to_numpy(zero_copy_only=False)]
                    if held is not None:
                        rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
                elif held is None:
                    return
                else:
                    rows = held
                key = rows[0]
                if not len(key):
                    continue
                cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
                starts, ends = np.append(0, cuts), np.append(cuts, len(key))
                last = len(starts) if b is None else len(starts) - 1
                left, right, large = [], [], []
                for s, e in zip(starts[:last], ends[:last]):
                    if key[s] == passing or (e - s > block and divisible(rows[1][s])):
                        passing = key[s]
                        large.append((s, e))
                    elif e - s > 1:
                        x, at = np.unique(rows[2][s:e], return_index=True)
                        own = np.zeros(len(x), bool)
                        own[np.searchsorted(x, rows[2][s:e][rows[3][s:e]])] = True
                        if len(x) > 1 and (tie := _tie(x, own, max_bits)) is not None:
                            left.append(tie[0])
                            right.append(tie[1])
                if b is None:
                    held = None
                else:
                    s = starts[-1]
                    if key[s] == passing or (len(key) - s > block and divisible(rows[1][s])):
                        passing = key[s]
                        large.append((s, len(key)))
                        s = len(key)
                    held = [r[s:] for r in rows]
                if left:
                    yield out(np.concatenate(left), np.concatenate(right))
                for s, e in large:
                    k, f, x, own = finer(*[r[s:e] for r in rows])
                    yield out(x, None, k, f, own)

    # Own rows and probes of a key meet in one task, in the order of the key.
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (keyed.repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(run, "a bigint, b bigint, key bigint, fixed bigint, own boolean"))


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that tie together all distinct fingerprints (column ``fp``) reachable from each other in steps of
    ``max_bits`` bits at most; every link returned joins fingerprints that are so reachable."""
    spark = fps.sparkSession
    plan = plan_parts(fps, max_bits)
    if not plan:
        return spark.createDataFrame([], "a bigint, b bigint")
    keyed, links = _probe_keys(fps, plan), None
    while True:
        done = materialise(_link_round(keyed, max_bits, block), "simhash-round")
        found = done.where("b is not null").select("a", "b")
        links = found if links is None else links.union(found)
        rest = done.where("b is null").select("key", "fixed", F.col("a").alias("fp"), "own")
        if rest.isEmpty():
            return links
        keyed = rest


def near_duplicate_groups(docs: DataFrame, keys: list[str], text_col: str = "text",
                          shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                          seed: int = SEED) -> DataFrame:
    """``keys`` columns, ``fp`` and ``rep`` for every row: the smallest key struct of the row's group.

    Two rows are in one group if a chain of fingerprints, each within ``max_bits`` bits of the next, leads from one to
    the other. Equal fingerprints are one node, so copies (however many) cost one aggregate. Null and empty texts have
    the fingerprint 0, linked like any other. Null keys sort last within a group, so that a representative is null only
    if all its group is. Repeated rows share their group; an empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, keys, text_col, shingle_words, seed), "simhash-fps")
    order = F.struct(*[x for k in keys for x in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`"))])
    rep = F.struct(*[F.col(f"`{k}`") for k in keys])
    low = F.min(F.struct(order.alias("o"), rep.alias("r")))
    classes = materialise(rows.groupBy("fp").agg(low.alias("low")), "simhash-classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("group_fp"), "low")
    lowest = rooted.groupBy("group_fp").agg(F.min("low").alias("low"))
    named = materialise(rooted.select("fp", "group_fp").join(lowest, "group_fp").select(
        F.col("fp").alias("of_fp"), F.col("low.r").alias("rep")), "simhash-groups")
    return rows.join(named, rows["fp"] == named["of_fp"]).drop("of_fp")


def document_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id: smallest doc_id of the group)."""
    out = near_duplicate_groups(docs, ["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("rep.doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one of the smallest id, with the columns of ``docs``. Of rows with that id the
    one with the smallest hash of its whole content stays; of equal rows, one."""
    content = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(docs.columns)])
    key, tie = fresh(docs, "keep_id"), fresh(docs, "keep_hash")
    keyed = docs.withColumns({key: F.col("doc_id"), tie: content})
    groups = near_duplicate_groups(keyed, [key, tie])
    kept = groups.where(f"`{key}` <=> rep.`{key}` and `{tie}` <=> rep.`{tie}`").select(
        F.col(key).alias(fresh(keyed, "kept_id")), F.col(tie).alias(fresh(keyed, "kept_hash"))).distinct()
    same = [F.col(key).eqNullSafe(F.col(kept.columns[0])), F.col(tie) == F.col(kept.columns[1])]
    return keyed.join(kept, same, "left_semi").dropDuplicates([key, tie]).drop(key, tie)
