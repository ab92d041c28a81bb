"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of numbers (shape of words, lines, letters and repetition; never its label, language, source
or id). Each number is cut into bins, and the model is a lookup table per number and per chosen pair of numbers.
Tables are learned by cyclic boosting: round after round, each number in turn gets a tree of a few leaves on its own
bins, fitted to what the sum of all tables still gets wrong, and adds a small part of it. The pairs come after the
single tables, those of the largest gain first. A score is a sum of looked-up values.

The numbers of all documents are computed once, by Spark, and written; the fit takes a bounded sample of the labelled
rows (``MAX_ROWS``, the rows with the smallest hash of their id), whose numbers alone reach the driver, and the tables
(a few thousand values) go back with the scoring tasks.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import materialise

# Labelled rows that a fit reads.
MAX_ROWS = 20_000
# Predicted 1 from this score on.
CUT = 0.3
BINS, PAIR_BINS = 48, 10
ROUNDS, PAIR_ROUNDS, PAIRS = 160, 60, 8
RATE = 0.15
LEAVES = 4
# Weight added to each leaf's curvature: a leaf of few documents moves little.
RIDGE = 2.0

NUMBERS = ("log_words", "word_length", "word_length_sd", "longest_word", "distinct_words", "repeated_pairs",
           "repeated_triples", "same_neighbours", "distinct_lines", "words_per_line", "capitals", "digits", "symbols",
           "exclamations", "stops", "commas", "bars", "other_marks", "non_ascii", "short_words")

_CLASSES = np.zeros((256, 9), np.int64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"!", b".", b",", b"|",
                             b"\"'()-+=/@:;?[]_{}~^`\\")):
    _CLASSES[list(_chars), _k] = 1
_CLASSES[128:, 8] = 1


def numbers(text: str | None) -> list[float]:
    """The numbers of one whole text (null: as an empty one; an empty text is all zeros)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(NUMBERS)
    marks = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
    sizes = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = float(sizes.sum())
    pairs = len(set(zip(words, words[1:])))
    triples = len(set(zip(words, words[1:], words[2:])))
    same = sum(a == b for a, b in zip(words, words[1:]))
    per_letter = marks / letters
    return [float(np.log1p(n)), letters / n, float(sizes.std()), float(min(sizes.max(), 200.0)), len(set(words)) / n,
            1 - pairs / max(n - 1, 1), 1 - triples / max(n - 2, 1) if n > 2 else 0.0, same / n,
            len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), *map(float, per_letter[[0, 1, 2, 3]]),
            float(marks[4] / n), float(marks[5] / n), float(marks[6] / n), float(per_letter[7]), float(per_letter[8]),
            float((sizes <= 3).mean())]


def text_numbers(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, x array<double>), one row per input row."""

    def run(batches):
        for b in batches:
            x = np.array([numbers(t) for t in b.column(1).to_pylist()], np.float64).reshape(-1, len(NUMBERS))
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NUMBERS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, pa.array(x.ravel()))],
                                             names=["doc_id", "x"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, x array<double>")


@dataclass
class Gam:
    """Lookup tables over binned numbers; ``score`` is the probability of label 1."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, f], "right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.pair_edges)]
            for (f, g), table in zip(self.pairs, self.pair_tables):
                total += table[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf_values(grad: np.ndarray, curve: np.ndarray, leaves: int) -> np.ndarray:
    """A tree on one number's bins, grown leaf by leaf where the gain is largest: its value in each bin."""
    cuts = [0, len(grad)]
    g, h = np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(curve))

    def worth(s, e):
        return (g[e] - g[s]) ** 2 / (h[e] - h[s] + RIDGE)

    while len(cuts) <= leaves:
        best = (1e-9, None)
        for s, e in zip(cuts, cuts[1:]):
            if e - s > 1:
                m = np.arange(s + 1, e)
                gain = worth(s, m) + worth(m, e) - worth(s, e)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], int(m[k]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for s, e in zip(cuts, cuts[1:]):
        out[s:e] = (g[e] - g[s]) / (h[e] - h[s] + RIDGE)
    return out


def _quadrants(grad: np.ndarray, curve: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of one cut on each of two numbers: its gain and its value in each cell."""
    g, h = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (grad, curve))
    i, j = np.meshgrid(np.arange(1, grad.shape[0]), np.arange(1, grad.shape[1]), indexing="ij")
    if not i.size:
        return 0.0, np.zeros_like(grad)

    def cells(a):
        return a[i, j], a[i, -1] - a[i, j], a[-1, j] - a[i, j], a[-1, -1] - a[i, -1] - a[-1, j] + a[i, j]

    gs, hs = cells(g), cells(h)
    gain = sum(x ** 2 / (y + RIDGE) for x, y in zip(gs, hs))
    k = int(np.argmax(gain))
    a, b = int(i.ravel()[k]), int(j.ravel()[k])
    out = np.zeros_like(grad)
    for (r, c), x, y in zip(((slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)), (slice(a, None), slice(0, b)),
                             (slice(a, None), slice(b, None))), gs, hs):
        out[r, c] = x.ravel()[k] / (y.ravel()[k] + RIDGE)
    return float(gain.ravel()[k] - g[-1, -1] ** 2 / (h[-1, -1] + RIDGE)), out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Learn the tables from numbers and 0/1 labels. Without rows every score is 0.5; with one class alone, near it."""
    if not len(y):
        return Gam()
    model = Gam(base=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    total = np.full(len(y), model.base)
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]

    def pull():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, at in enumerate(bins):
            grad, curve = pull()
            size = len(model.tables[f])
            step = RATE * _leaf_values(np.bincount(at, grad, size), np.bincount(at, curve, size), LEAVES)
            model.tables[f] += step
            total += step[at]
    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.pair_edges)]
    sides = [len(e) + 1 for e in model.pair_edges]

    def tree(f, g):
        grad, curve = pull()
        cell, n = coarse[f] * sides[g] + coarse[g], sides[f] * sides[g]
        shape = (sides[f], sides[g])
        return _quadrants(np.bincount(cell, grad, n).reshape(shape), np.bincount(cell, curve, n).reshape(shape))

    gains = {(f, g): tree(f, g)[0] for f, g in itertools.combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS])
    model.pair_tables = [np.zeros((sides[f], sides[g])) for f, g in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(model.pairs):
            step = RATE * tree(f, g)[1]
            model.pair_tables[k] += step
            total += step[coarse[f], coarse[g]]
    return model


def labelled_sample(rows: DataFrame, labels: DataFrame, label: str, held_out_of: int, held_out: int,
                    max_rows: int) -> DataFrame:
    """Rows with their label ``y``, without the held-out ones: at most ``max_rows``, by the hash of their id. A
    document with several labels has its smallest; null labels and ids are left out."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min(label).alias("y")).where(~is_held_out(held_out_of, held_out))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # ``max_rows`` ids and labels at most, so this side is broadcast and no text moves.
    known = F.broadcast(known.withColumnRenamed("doc_id", "known_id"))
    return rows.join(known, F.col("doc_id") == F.col("known_id")).drop("known_id")


def is_held_out(of: int, remainder: int, id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves this remainder (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == remainder, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    Learns from labelled documents whose id's crc32 leaves a remainder other than 0 by 5. Null and empty texts are
    scored as all-zero numbers. Repeated rows get equal scores; other columns are not read; without labels all scores
    are 0.5; an empty table gives an empty result.
    """
    rows = materialise(text_numbers(docs), "gam-numbers")
    sample = labelled_sample(rows, labels, "quality", 5, 0, max_rows).select("doc_id", "x", "y").toPandas()
    sample = sample.sort_values(["doc_id"], kind="stable")
    x = np.array(sample["x"].tolist(), np.float64).reshape(-1, len(NUMBERS))
    model = fit(x, sample["y"].to_numpy(np.float64))

    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NUMBERS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", is_held_out(5, 0).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted 1, with the columns they came with. Rows that share an id stay or go together (they
    stay if any of them is predicted 1); a null id is an id of its own."""
    good = quality_scores(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good["kept_id"]), "left_semi")
