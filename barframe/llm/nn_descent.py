"""Embedding near-duplicates by NN-descent.

Equal vectors are one node with a count. Nodes get first neighbours from sorted random projections (the sign code of a
few random hyperplanes; rows next to each other in code order), and then lists of ``NEIGHBOURS`` best are refined: the
neighbours of a node, in either direction, are introduced to each other, and who is better than the worst of a list
enters it. A round compares only pairs of which one is new. Pairs of cosine ``MIN_COSINE`` and more are links, whether
or not they enter a list: lists are cut, links are not. Of the links met in one place a spanning forest is passed on,
which joins the same nodes in fewer rows than there are nodes.

A list that holds nothing but links is saturated: the node may have more. Saturated lists are enlarged to all they can
hold. Inside their component that is every node, by block products, which return counts and never pairs; a block grows
with its component, up to what a task can hold. Outside it, saturated nodes search again with lists in which nodes of
their own component take no place, until none of them gains a link.

The search is audited: sampled nodes, other ones each round, are compared with all nodes, in samples that grow until
``LINKED`` nodes that have links are among them, or until so many nodes were sampled (a sixteenth of all, within
``AUDIT_LEAST`` and ``AUDIT_MOST``) that the exact binomial bound on the share of nodes that miss a link says enough. What
is judged is the mean over the sampled nodes that have links of the share of a node's links that lie inside its
component; links that the audit finds join the rest. As long as the mean is under ``RECALL``, another round with new
projections follows, and after ``ROUNDS`` of them all nodes are compared with all in blocks.

The members of a hub's neighbourhood meet in runs dealt by hash over many tasks, so none reads them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barframe.llm.common import discard, materialise
from barframe.llm.components import connected_components

MIN_COSINE = 0.9
NEIGHBOURS = 10
# Projections per round, bits of a code, and rows after a row in code order that it meets.
TABLES, CODE_BITS, REACH = 4, 48, 6
# Refinements per round at most; they end when under this share of list entries is new.
REFINEMENTS, QUIET = 2, 0.05
# Members of a node's neighbourhood compared at once, candidates each of them takes from there, and keys that a hub's
# rows are spread over while its members are counted out into runs.
MEETING, TAKEN, SALTS = 64, 4, 16
# Vectors in a block at least and at most, blocks of a component between these bounds, and numbers in a block at most.
BLOCK, BLOCK_MOST, BLOCKS, CELLS = 128, 2_048, 16, 1 << 21
# Audit: nodes of the first sample and of the largest, sampled nodes that must have links, share of a node's links that
# must be found on average, and rounds before all nodes are compared with all.
AUDITED, AUDITED_MOST, LINKED, RECALL, ROUNDS = 256, 4_096, 128, 0.98, 4
# Nodes that are sampled at least and at most where few have links, and the chance that the bound is too low.
AUDIT_LEAST, AUDIT_MOST, ERROR = 1_024, 6_144, 0.01
# Rows compared with a sample at once.
SLICE = 1_024


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors in double precision from a list column; shorter vectors are filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        x = flat.reshape(-1, dim)
    else:
        x = np.zeros((len(sizes), dim))
        x[np.arange(dim)[None, :] < sizes[:, None]] = flat
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def groups_of(batches, limit: int) -> Iterator[list[pa.Array]]:
    """Runs of rows equal in the first column, as lists of columns; runs longer than ``limit`` come in pieces."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        t = t.combine_chunks()
        if not t.num_rows:
            continue
        key = t.column(0).chunk(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        for s, e in zip(cuts, cuts[1:]):
            for k in range(s, e, limit):
                yield [c.chunk(0).slice(k, min(limit, e - k)) for c in t.columns]
        s = cuts[-1]
        while t.num_rows - s > limit:
            yield [c.chunk(0).slice(s, limit) for c in t.columns]
            s += limit
        held = t.slice(s)
    if held is not None and held.num_rows:
        yield [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in held.combine_chunks().columns]


def _edges(a, b, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())],
                                      names=["u", "v", "sim"])


def forest(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs of a spanning forest of the graph of a symmetric truth table."""
    left, right = [], []
    open_ = near.any(1)
    while open_.any():
        stack = [int(np.argmax(open_))]
        open_[stack[0]] = False
        while stack:
            i = stack.pop()
            new = np.flatnonzero(near[i] & open_)
            open_[new] = False
            left.extend([i] * len(new))
            right.extend(new.tolist())
            stack.extend(new.tolist())
    return left, right


def projected_neighbours(nodes: DataFrame, dim: int, seed: int) -> DataFrame:
    """First candidates (u, v, sim), both ways."""

    def coded(batches):
        planes = np.random.default_rng(seed).standard_normal((TABLES, CODE_BITS, dim))
        place = (1 << np.arange(CODE_BITS, dtype=np.int64))[::-1]
        for b in batches:
            x = matrix(b.column(1), dim)
            for t in range(TABLES):
                code = ((x @ planes[t].T) > 0) @ place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(code), b.column(0), b.column(1)],
                    names=["tab", "code", "id", "vec"])

    def met(batches):
        tab = ids = vec = None
        for b in batches:
            x = matrix(b.column(3), dim)
            t, i = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            if ids is not None:
                t, i, x = np.append(tab, t), np.append(ids, i), np.vstack([vec, x])
            done = 0 if ids is None else len(ids)
            for d in range(1, REACH + 1):
                # Pairs of rows d apart of which the later is new in this batch.
                s = max(done - d, 0)
                p, q = np.arange(s, len(i) - d), np.arange(s + d, len(i))
                ok = t[p] == t[q]
                p, q = p[ok], q[ok]
                sim = np.einsum("ij,ij->i", x[p], x[q])
                yield _edges(np.append(i[p], i[q]), np.append(i[q], i[p]), np.append(sim, sim))
            tab, ids, vec = t[-REACH:], i[-REACH:], x[-REACH:]

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = nodes.schema["vec"].dataType.simpleString()
    return (nodes.select("id", "vec").mapInArrow(coded, f"tab int, code bigint, id bigint, vec {kind}")
            .repartitionByRange(n, "tab", "code", "id").sortWithinPartitions("tab", "code", "id")
            .mapInArrow(met, "u bigint, v bigint, sim double"))


def outside_neighbours(nodes: DataFrame, dim: int, seed: int) -> DataFrame:
    """First candidates (u, v, sim), both ways, among nodes of different components: each node (id, vec, root) meets the
    ``REACH`` rows in code order that lie before the run of its own component. Runs may end where a range of codes does,
    where nobody meets, so the order is cut into ranges in two ways."""

    def coded(batches):
        planes = np.random.default_rng(seed).standard_normal((TABLES, CODE_BITS, dim))
        place = (1 << np.arange(CODE_BITS, dtype=np.int64))[::-1]
        for b in batches:
            x = matrix(b.column(1), dim)
            for t in range(TABLES):
                code = ((x @ planes[t].T) > 0) @ place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(code), b.column(0), b.column(1), b.column(2)],
                    names=["tab", "code", "id", "vec", "root"])

    def met(batches):
        before = None  # tab, id, root and vector of the last rows of the run that is open, and of those before it
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(3), dim)
            t, i, r = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 4))
            done = 0
            if before is not None:
                done = len(before[0])
                t, i, r, x = np.append(before[0], t), np.append(before[1], i), np.append(before[2], r), np.vstack([before[3], x])
            starts = np.append(True, (t[1:] != t[:-1]) | (r[1:] != r[:-1]))
            start = np.maximum.accumulate(np.where(starts, np.arange(len(t)), 0))
            for d in range(1, REACH + 1):
                q = np.arange(done, len(t))
                p = start[q] - d
                q, p = q[p >= 0], p[p >= 0]
                ok = (t[p] == t[q]) & (r[p] != r[q])
                p, q = p[ok], q[ok]
                sim = np.einsum("ij,ij->i", x[p], x[q])
                yield _edges(np.append(i[p], i[q]), np.append(i[q], i[p]), np.append(sim, sim))
            keep = np.unique(np.concatenate([np.arange(max(start[-1] - REACH, 0), start[-1]),
                                             np.arange(max(len(t) - REACH, start[-1]), len(t))]))
            before = (t[keep], i[keep], r[keep], x[keep])

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = nodes.schema["vec"].dataType.simpleString()
    rows = nodes.select("id", "vec", "root").mapInArrow(coded, f"tab int, code bigint, id bigint, vec {kind}, root bigint")
    one, two = (rows.repartitionByRange(k, "tab", "code", "id").sortWithinPartitions("tab", "code", "id")
                .mapInArrow(met, "u bigint, v bigint, sim double") for k in (n, n + 1))
    return one.union(two)


def best_lists(candidates: DataFrame, size: int, min_cosine: float) -> DataFrame:
    """Each node's candidates (u, v, sim, fresh) with their place, cut to the best ``size`` and all links; a pair seen
    before is not fresh."""
    each = candidates.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    best = Window.partitionBy("u").orderBy(F.col("sim").desc(), "v")
    return each.withColumn("place", F.row_number().over(best)).where(
        (F.col("place") <= size) | (F.col("sim") >= min_cosine))


def meetings(lists: DataFrame, seed: int) -> DataFrame:
    """Rows (meeting, turn, member, fresh): the neighbours of a node (lists u, v, fresh; either direction) meet at one
    meeting, those of a hub at several of about half of ``MEETING`` to ``MEETING`` members, dealt by hash anew for every
    seed. ``turn`` orders a meeting's members whatever the order of the input."""
    members = (lists.select(F.col("u").alias("centre"), F.col("v").alias("member"), "fresh")
               .union(lists.select("v", "u", "fresh")).groupBy("centre", "member")
               .agg(F.max("fresh").alias("fresh")))
    hubs = (lists.select(F.col("u").alias("hub")).union(lists.select("v")).groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > MEETING).select("hub", F.expr(f"cast(ceil(n / {MEETING}D) as bigint)").alias("runs"),
                                                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("hub_salt")))
    salt = F.pmod(F.xxhash64("member"), F.lit(SALTS)).cast("int")
    return (members.withColumn("salt", salt)
            .join(hubs, (F.col("centre") == F.col("hub")) & (F.col("salt") == F.col("hub_salt")), "left")
            .withColumn("turn", F.xxhash64("member", F.lit(seed)))
            .withColumn("meeting", F.expr("xxhash64(centre, pmod(turn, coalesce(runs, 1L)))"))
            .select("meeting", "turn", "member", "fresh"))


def introduced(lists: DataFrame, nodes: DataFrame, dim: int, size: int, min_cosine: float, seed: int,
               apart: DataFrame | None = None) -> DataFrame:
    """Candidates (u, v, sim) from letting the neighbours of every node (id, vec, root) meet; nodes of one root do not.
    They are those better than the worst of a list, and a spanning forest of the links. The worst are those of the
    lists ``apart``, if given."""
    worst = (lists if apart is None else apart).groupBy(F.col("u").alias("of")).agg(
        F.when(F.count(F.lit(1)) >= size, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"))
    known = nodes.join(worst, F.col("id") == F.col("of"), "left").select(
        "id", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"), "root")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(batches):
        for _, _, ids, fresh, vec, worst, root in groups_of(batches, 2 * MEETING):
            fresh = fresh.to_numpy(zero_copy_only=False)
            if len(ids) < 2 or not fresh.any():
                continue
            ids, worst, root = ids.to_numpy(), worst.to_numpy(), root.to_numpy()
            dims = vec.value_lengths().to_numpy()
            x = matrix(vec, dim)
            sim = x @ x.T
            sim[~(fresh[:, None] | fresh[None, :])] = -2.0
            sim[root[:, None] == root[None, :]] = -2.0
            linked = (sim >= min_cosine) & (dims[:, None] == dims[None, :])
            if linked.any():
                i, j = forest(linked)
                yield _edges(ids[i], ids[j], sim[i, j])
            k = min(TAKEN, len(ids) - 1)
            top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(sim, top, 1)
            row, col = np.nonzero(value > worst[:, None])
            yield _edges(ids[row], ids[top[row, col]], value[row, col])

    rows = (meetings(lists, seed).join(known, F.col("member") == F.col("id"))
            .select("meeting", "turn", "member", "fresh", "vec", "worst", "root"))
    return (rows.repartition(n, "meeting").sortWithinPartitions("meeting", "turn", "member")
            .mapInArrow(meet, "u bigint, v bigint, sim double"))


def link_counts(members: DataFrame, dim: int, min_cosine: float) -> DataFrame:
    """(id, links): for each member (id, vec, dims, weight, root, size) of a component the weights of the others it
    links to, summed. Components are compared whole, in pairs of blocks."""

    def count(batches):
        for g in _whole_groups(batches):
            ids, side, dims, weight = (g.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 4, 5))
            x = matrix(g.column(3), dim)
            one, two = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
            near = (x[one] @ x[two].T >= min_cosine) & (dims[one][:, None] == dims[two][None, :])
            near &= ids[one][:, None] != ids[two][None, :]
            yield _count(ids[one], near @ weight[two])
            if not (side == 0).any():  # two blocks, not a block with itself
                yield _count(ids[two], near.T @ weight[one])

    def _count(ids, n):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n.astype(np.int64))], names=["id", "links"])

    return (_block_pairs(members, dim).mapInArrow(count, "id bigint, links bigint")
            .groupBy("id").agg(F.sum("links").alias("links")))


def _whole_groups(batches):
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = (t if held is None else pa.concat_tables([held, t])).combine_chunks()
        if not t.num_rows:
            continue
        key = t.column(0).chunk(0).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        for s, e in zip(cuts, cuts[1:]):
            yield t.slice(s, e - s).combine_chunks().to_batches()[0]
        held = t.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held.combine_chunks().to_batches()[0]


def block_sql(dim: int) -> str:
    """SQL text: the vectors in a block of a component of ``size`` nodes. A row is moved once per block, so blocks grow
    with the component once it has ``BLOCKS`` of the least, as far as a task holds two of them and their products."""
    most = max(BLOCK, min(BLOCK_MOST, CELLS // dim))
    return f"least({most}D, greatest({BLOCK}D, size / {BLOCKS}D))"


def _block_pairs(members: DataFrame, dim: int) -> DataFrame:
    """Rows (pair, id, side, vec, dims, weight), those of a pair of blocks together."""
    # Each member goes to every pair of its own block with a block of its component; side 0: the pair is the block
    # with itself, 1 and 2: the first and the second of two blocks.
    blocks = f"cast(ceil(size / {block_sql(dim)}) as int)"
    dealt = (members.withColumn("blocks", F.expr(blocks))
             .withColumn("mine", F.expr("pmod(xxhash64(id), blocks)"))
             .select("id", "vec", "dims", "weight", "root", "mine", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
             .withColumn("pair", F.expr("xxhash64(root, least(mine, other), greatest(mine, other))"))
             .withColumn("side", F.expr("if(mine = other, 0, if(mine < other, 1, 2))")))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.select("pair", "id", "side", "vec", "dims", "weight").repartition(n, "pair")
            .sortWithinPartitions("pair"))


def _between(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a truth table, one for each two different components (``left`` of its rows, ``right`` of its columns)
    that it joins."""
    i, j = np.nonzero(near & (left[:, None] != right[None, :]))
    if not len(i):
        return i, j
    _, first = np.unique(np.stack([left[i], right[j]]), axis=1, return_index=True)
    return i[first], j[first]


def all_links(nodes: DataFrame, dim: int, min_cosine: float) -> DataFrame:
    """Links (u, v) between the components of all nodes (id, vec, dims, root), each compared with each in blocks: one
    link at most for two components and a pair of blocks."""

    def links(batches):
        for g in _whole_groups(batches):
            ids, side, dims, root = (g.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 4, 5))
            x = matrix(g.column(3), dim)
            one, two = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
            near = (x[one] @ x[two].T >= min_cosine) & (dims[one][:, None] == dims[two][None, :])
            i, j = _between(near, root[one], root[two])
            yield pa.RecordBatch.from_arrays([pa.array(ids[one][i], pa.int64()), pa.array(ids[two][j], pa.int64())],
                                             names=["u", "v"])

    members = nodes.select("id", "vec", "dims", F.col("root").alias("weight"), F.lit(0).cast("bigint").alias("root"),
                           F.lit(nodes.count()).alias("size"))
    return _block_pairs(members, dim).mapInArrow(links, "u bigint, v bigint")


def links_outside(lists: DataFrame, nodes: DataFrame, roots: DataFrame, dim: int, size: int, min_cosine: float,
                  seed: int) -> DataFrame | None:
    """Links (u, v) that saturated nodes gain outside their components, found with lists of nodes of other components;
    None where all saturated nodes are of one component. ``lists`` are the nodes' own, cut to ``size``."""
    full = lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("least")).where(
        (F.col("n") >= size) & (F.col("least") >= min_cosine))
    known = (nodes.select("id", "vec", "dims").join(full.select("u"), F.col("id") == F.col("u"))
             .join(roots, F.col("id") == F.col("node")).select("id", "vec", "dims", "root"))
    if known.select("root").distinct().limit(2).count() < 2:
        return None
    known = materialise(known, "saturated")
    own = lists.select("u", "v").withColumn("fresh", F.lit(False))
    first = outside_neighbours(known, dim, seed).withColumn("fresh", F.lit(True))
    apart = materialise(best_lists(first, size, min_cosine), "outside")
    while True:
        cut = apart.where(F.col("place") <= size)
        met = own.union(cut.select("u", "v", "fresh"))
        seed += 1
        new = introduced(met, known, dim, size, min_cosine, seed, cut).withColumn("fresh", F.lit(True))
        last, apart = apart, materialise(best_lists(
            new.union(apart.select("u", "v", "sim").withColumn("fresh", F.lit(False))), size, min_cosine), "outside")
        discard(last)
        state = apart.where(F.col("place") <= size).agg(F.avg(F.col("fresh").cast("double")).alias("new")).first()
        if (state["new"] or 0.0) < QUIET:
            break
    ends = known.select(F.col("id").alias("of"), F.col("dims").alias("of_dims"))
    gained = materialise(
        apart.where(F.col("sim") >= min_cosine).select("u", "v").join(ends, F.col("u") == F.col("of"))
        .withColumnRenamed("of_dims", "u_dims").drop("of").join(ends, F.col("v") == F.col("of"))
        .where("u_dims = of_dims").select("u", "v"), "gained")
    discard(apart, known)
    return gained


class Audit(NamedTuple):
    """What an audit found: the mean share of a node's links that lie inside its component, over sampled nodes that have
    links (1 if none has); tables of links (u, v) that lie outside; and the share of nodes that had such a link at most,
    with a chance of ``ERROR`` to be wrong (0 if every node was sampled, as what they miss is then known)."""

    recall: float
    missed: list[DataFrame]
    missing_at_most: float


def missing_at_most(missing: int, sampled: int, error: float = ERROR) -> float:
    """Exact upper confidence bound on a share of which a sample of ``sampled`` nodes holds ``missing``."""
    if missing >= sampled:
        return 1.0
    ways = [math.lgamma(sampled + 1) - math.lgamma(k + 1) - math.lgamma(sampled - k + 1) for k in range(missing + 1)]
    low, high = 0.0, 1.0
    for _ in range(50):
        p = (low + high) / 2
        so_few = sum(math.exp(w + k * math.log(p) + (sampled - k) * math.log1p(-p)) for k, w in enumerate(ways))
        low, high = (p, high) if so_few > error else (low, p)
    return high


def audit(nodes: DataFrame, dim: int, min_cosine: float, seed: int = 0) -> Audit:
    """Compares sampled nodes (id, vec, dims, root) with all nodes. They are taken in the order of their hash, other nodes
    for every seed: links that an audit finds are joined, so a later one must not judge the same nodes. The work grows
    with the table and a sample of bounded size, whether or not links are rare."""
    place = nodes.withColumn("h", F.xxhash64("id", F.lit(seed)))
    count = nodes.count()
    most = min(AUDIT_MOST, max(AUDIT_LEAST, count // 16))
    size, last, sampled, judged, recall, missing, missed = AUDITED, None, 0, 0, 0.0, 0, []
    while judged < LINKED and sampled < most:
        left = place if last is None else place.where(
            (F.col("h") > last[0]) | ((F.col("h") == last[0]) & (F.col("id") > last[1])))
        sample = (left.orderBy("h", "id").limit(min(size, most - sampled))
                  .select("id", "vec", "dims", "root", "h").toArrow())
        if not sample.num_rows:
            break
        sampled += sample.num_rows
        last = sample.column("h")[-1].as_py(), sample.column("id")[-1].as_py()
        found = materialise(_compared(nodes, sample, dim, min_cosine), "audit")
        state = (found.groupBy("u").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).where("n > 0")
                 .agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.col("k") / F.col("n")).alias("share"),
                      F.count_if(F.col("k") < F.col("n")).alias("missing")).first())
        judged, recall, missing = judged + state["nodes"], recall + (state["share"] or 0.0), missing + state["missing"]
        missed.append(found.where("v is not null").select("u", "v"))
        size = min(2 * size, AUDITED_MOST)
    return Audit(recall / judged if judged else 1.0, missed,
                 0.0 if sampled == count else missing_at_most(missing, sampled))


def _compared(nodes: DataFrame, sample: pa.Table, dim: int, min_cosine: float) -> DataFrame:
    """Rows (u, v, n, k) of the sampled nodes u: so many links were met, so many of them inside the component; or v is
    the other end of a link outside."""
    ids, dims, roots = (sample.column(k).to_numpy() for k in ("id", "dims", "root"))
    x = matrix(sample.column("vec").combine_chunks(), dim)

    def compared(batches):
        for whole in batches:
            total, inside = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            u, v = [], []
            for k in range(0, whole.num_rows, SLICE):
                b = whole.slice(k, SLICE)
                own, size, root = (b.column(c).to_numpy() for c in (0, 2, 3))
                near = (matrix(b.column(1), dim) @ x.T >= min_cosine) & (size[:, None] == dims[None, :])
                near &= own[:, None] != ids[None, :]
                total += near.sum(0)
                same = near & (root[:, None] == roots[None, :])
                inside += same.sum(0)
                i, j = _between(near, root, roots)
                u.extend(ids[j].tolist())
                v.extend(own[i].tolist())
            some = np.flatnonzero(total)
            none = [0] * len(u)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some].tolist() + u, pa.int64()), pa.array([None] * len(some) + v, pa.int64()),
                 pa.array(total[some].tolist() + none, pa.int64()), pa.array(inside[some].tolist() + none, pa.int64())],
                names=["u", "v", "n", "k"])

    return nodes.select("id", "vec", "dims", "root").mapInArrow(compared, "u bigint, v bigint, n bigint, k bigint")


def _old(lists: DataFrame) -> DataFrame:
    return lists.select("u", "v", "sim").withColumn("fresh", F.lit(False))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    min_cosine: float = MIN_COSINE, neighbours: int = NEIGHBOURS,
                    with_audit: bool = False) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row; with ``with_audit`` also audit_recall and
    missing_at_most, the same in all rows: what the last audit measured before the links it found were joined (1 and 0
    where there was nothing to search, and 0 after a comparison of all nodes with all).

    Vectors that are null, empty, zero, or hold null or non-finite parts, and rows without an id, link with nothing.
    Vectors of different lengths never link. Equal vectors (repeated rows too) link with each other as with all their
    links. Other columns are not read; an empty table gives an empty result.
    """
    v = F.col("v")
    usable = (F.col("id").isNotNull() & v.isNotNull() & F.expr(
        "forall(coalesce(v, array()), x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(coalesce(v, array()), x -> x <> 0)"))
    rows = materialise(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
                       .withColumn("ok", F.coalesce(usable, F.lit(False))), "vectors")
    good = rows.where("ok")
    classes = materialise(good.groupBy(F.col("v").alias("vec")).agg(F.min("id").cast("bigint").alias("id"),
                                                                    F.count(F.lit(1)).alias("weight"))
                          .withColumn("dims", F.size("vec")), "vector-classes")
    dim = classes.agg(F.max("dims")).first()[0]
    out_id = F.col("id").alias(id_col)

    def audited(out: DataFrame, recall: float, missing: float) -> DataFrame:
        if not with_audit:
            return out
        return out.withColumns({"audit_recall": F.lit(float(recall)), "missing_at_most": F.lit(float(missing))})

    if dim is None:
        return audited(rows.select(out_id, F.lit(0).cast("bigint").alias("n_links"), F.col("id").cast("bigint").alias("component_id"),
                                   F.lit(True).alias("kept")), 1.0, 0.0)
    lists, roots, gained = None, None, []
    each = classes.select("id", "vec", F.col("id").alias("root"))

    def with_roots(roots: DataFrame) -> DataFrame:
        return (classes.join(roots, F.col("id") == F.col("node"), "left")
                .select("id", "vec", "dims", F.coalesce("root", "id").alias("root")))

    for k in range(ROUNDS):
        first = projected_neighbours(classes, dim, 1 + k).withColumn("fresh", F.lit(True))
        seen = first if lists is None else first.union(_old(lists))
        last, lists = lists, materialise(best_lists(seen, neighbours, min_cosine), "lists")
        if last is not None:
            discard(last)
        for r in range(REFINEMENTS):
            cut = lists.where(F.col("place") <= neighbours)
            new = introduced(cut, each, dim, neighbours, min_cosine, 1 + k * REFINEMENTS + r).withColumn("fresh", F.lit(True))
            last, lists = lists, materialise(best_lists(new.union(_old(lists)), neighbours, min_cosine), "lists")
            discard(last)
            state = lists.where(F.col("place") <= neighbours).agg(F.avg(F.col("fresh").cast("double")).alias("new")).first()
            if (state["new"] or 0.0) < QUIET:
                break
        same = classes.select(F.col("id").alias("of"), F.col("dims").alias("of_dims"))
        close = lists.where(F.col("sim") >= min_cosine).select("u", "v")
        if classes.select("dims").distinct().count() > 1:
            close = (close.join(same, F.col("u") == F.col("of")).withColumnRenamed("of_dims", "u_dims").drop("of")
                     .join(same, F.col("v") == F.col("of")).where("u_dims = of_dims").select("u", "v"))
        for g in gained:
            close = close.union(g)
        roots = connected_components(close, "u", "v")
        cut = lists.where(F.col("place") <= neighbours)
        while True:
            new = links_outside(cut, classes, roots, dim, neighbours, min_cosine, ROUNDS + 1 + k + ROUNDS * len(gained))
            if new is None or new.isEmpty():
                break
            gained.append(new)
            close = close.union(new)
            roots = connected_components(close, "u", "v")
        recall, missed, missing = audit(with_roots(roots), dim, min_cosine, k)
        if recall < RECALL and k == ROUNDS - 1:
            missing = 0.0
            missed.append(materialise(all_links(with_roots(roots), dim, min_cosine), "all-links"))
        missed = [m for m in missed if not m.isEmpty()]
        if missed:
            gained += missed
            for m in missed:
                close = close.union(m)
            roots = connected_components(close, "u", "v")
        if recall >= RECALL:
            break
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = (classes.join(roots.join(sizes, "root"), F.col("id") == F.col("node"))
               .select("id", "vec", "dims", "weight", "root", "size"))
    counts = link_counts(members, dim, min_cosine)
    nodes = (classes.select("vec", "id", "weight")
             .join(roots, F.col("id") == F.col("node"), "left")
             .join(counts.withColumnRenamed("id", "counted"), F.col("id") == F.col("counted"), "left")
             .select(F.col("vec"), F.coalesce("root", "id").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    linked = (good.select("id", "v").join(nodes, F.col("v") == F.col("vec"))
              .select("id", F.col("links").alias("n_links"), F.col("root").alias("component_id")))
    rest = rows.where("not ok").select("id", F.lit(0).cast("bigint").alias("n_links"),
                                       F.col("id").cast("bigint").alias("component_id"))
    out = linked.union(rest).select(out_id, "n_links", "component_id",
                                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
    return audited(out, recall, missing)
