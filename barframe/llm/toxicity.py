"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, with exception phrases.

Folding lower-cases a text, maps look-alike letters of other scripts and styles to Latin ones, and white space to
blanks, one character for one. A digit or sign may be itself or any letter it stands for, each by itself: the automaton
runs over a text in which all these are one letter, and what it finds is compared sign by sign. The automaton holds the
lexicon and the exception phrases; a match counts if no letter or digit touches it and no exception phrase covers it. The weights found are summed, divided by a
function that grows with the square root of the text's length, and turned into a probability.

The lexicon is learned: of the labelled rows (at most ``MAX_ROWS``, by the hash of their id) words that are surely
over-represented in the texts of toxic documents are entries. A short base lexicon of common insults stands in where
the sample is too small to know them. Beginnings that words share stand for all words that begin so ("stem*"), so that
inflected forms the sample lacks are found; they are judged by the distinct neighbourhoods their words stand in, so that
a text copied a thousand times counts once and a language of few documents is not drowned, and must hold in either half
of the sample. What an entry weighs is the logarithm of how much more often it stands in toxic text than in clean text:
an entry that clean texts hold now and then weighs little, and a text must hold several of it for its length.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import materialise
from barframe.llm.gam import CUT, is_held_out, labelled_sample

MAX_ROWS = 20_000
# A word must weigh this much, and chance alone must make as strong a word with a probability under this, all words
# tested taken together.
MIN_WEIGHT = 2.0
CHANCE = 0.01
# Letters of the beginnings that may stand for a family of words; how many words of toxic texts must share one, and
# how many toxic texts of either half must hold such words.
STEM_SIZES, STEM_WORDS, STEM_TEXTS = (4, 5, 6, 7), 5, 3
# A beginning must weigh this much in either half.
MIN_STEM_WEIGHT = 2.0
# Words per unit of length in the normalisation.
LENGTH_UNIT = 200.0

# Common insults, listed from the start with this weight; a sample that knows a word gives it the sample's weight, and
# takes it off the list where it is not over-represented in toxic documents.
BASE_WEIGHT = 4.0
BASE_KNOWN = 5
BASE_LEXICON = ("asshole", "bastard", "bitch", "bullshit", "clown", "coward", "creep", "cretin", "crap", "degenerate",
                "dickhead", "disgusting", "dumb", "dumbass", "fool", "freak", "fuck", "fucking", "idiot", "idiotic", "imbecile",
                "jerk", "liar", "loser", "lunatic", "moron", "moronic", "parasite", "pathetic", "pig", "prick", "retard",
                "scum", "scumbag", "shit", "shut up", "slut", "stupid", "subhuman", "trash", "twat", "vermin", "whore",
                "worthless")

# Phrases in which a listed word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "class clown", "circus clown", "clown fish",
              "scum line", "pond scum")

# Letters that look like Latin ones, and signs read as letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x",
    "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "σ": "o", "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o", "đ": "d",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
         "!": "i", "+": "t", "|": "l"}
SIGNS_2 = SIGNS | {"1": "l", "!": "l"}
# Texts and entries are compared with all that a sign may stand for made one letter; then each sign is looked at by itself.
_AS_ONE = str.maketrans(SIGNS | {"|": "i", "l": "i"})
_STANDS_FOR = {c: {SIGNS[c], SIGNS_2[c]} for c in SIGNS}
_SIGNED = re.compile(r"[a-z][013457894@$!+|]|[013457894@$!+|][a-z]")
_WORD = re.compile(r"[^\W_]+")


class _Fold(dict):
    """Character -> folded character, found by rule when first met: look-alike, else the one character that its
    compatibility decomposition starts with (full-width, styled and accented letters), else itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c.isspace():
            out = " "
        else:
            base = unicodedata.normalize("NFKD", c)[:1].lower()[:1] or c
            out = LOOK_ALIKES.get(base, base)
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """The text in lower case with look-alikes mapped to Latin letters, one character for one. Combining marks and
    invisible characters that only part letters are taken off first."""
    if not text.isascii():
        text = "".join([c for c in text if unicodedata.category(c) not in ("Mn", "Cf")]) if _HIDDEN.search(text) else text
        return text.translate(_FOLD)
    return text.lower().translate(_SPACE)


_SPACE = str.maketrans("\t\n\r\x0b\x0c", "     ")
_HIDDEN = re.compile("[̀-ͯ­​-‏⁠﻿]")


def reads_as(folded: str, entry: str, signed: bool) -> bool:
    """Whether a folded text of the entry's length is the entry, each sign being itself or (``signed``) a letter."""
    return folded == entry or signed and all(a == b or b in _STANDS_FOR.get(a, ()) for a, b in zip(folded, entry))


class Matcher:
    """Aho-Corasick automaton over a lexicon {word or "stem*": weight} and exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        import ahocorasick

        entries: dict[str, tuple[float | None, bool]] = {fold(phrase): (None, True) for phrase in exceptions}
        # A word goes before a stem of the same letters.
        for word, weight in sorted(lexicon.items(), key=lambda x: x[0].endswith("*")):
            text = fold(word.rstrip("*"))
            if text and text not in entries:
                entries[text] = (weight, not word.endswith("*"))
        alike: dict[str, list[tuple[str, float | None, bool]]] = {}
        for text, (weight, whole) in entries.items():
            alike.setdefault(text.translate(_AS_ONE), []).append((text, weight, whole))
        self.auto = ahocorasick.Automaton()
        for text, same in alike.items():
            self.auto.add_word(text, (len(text), same))
        self.any = len(self.auto) > 0
        if self.any:
            self.auto.make_automaton()

    def matches(self, text: str) -> dict[int, float]:
        """{start in the folded text: weight} of the matches that count."""
        out: dict[int, float] = {}
        if not self.any:
            return out
        folded = fold(text)
        signed = bool(_SIGNED.search(folded))
        found, harmless = [], []
        for end, (size, same) in self.auto.iter(folded.translate(_AS_ONE)):
            start = end + 1 - size
            # A sign beside a word ends it, whatever letter it may stand for elsewhere.
            if start and folded[start - 1].isalnum():
                continue
            for entry, weight, whole in same:
                if (whole and folded[end + 1:end + 2].isalnum()) or not reads_as(folded[start:end + 1], entry, signed):
                    continue
                (harmless if weight is None else found).append((start, end + 1, weight))
        for s, e, weight in found:
            if not any(a <= s and e <= b for a, b, _ in harmless):
                # A word and the stems it begins with are one match, of the largest weight.
                out[s] = max(weight, out.get(s, 0.0))
        return out

    def strength(self, text: str | None) -> float:
        """Sum of the weights found, normalised by length."""
        found = self.matches(text or "")
        return sum(found.values()) / math.sqrt(1 + len(text.split()) / LENGTH_UNIT) if found else 0.0


def _contexts(text: str | None) -> list[tuple[str, int]]:
    """Words of a folded text with a hash of the words around them."""
    words = _WORD.findall(fold(text or ""))
    import xxhash

    around = zip(words, ["", *words], [*words[1:], ""])
    return [(w, xxhash.xxh64_intdigest(f"{a} {b}".encode("utf-8", "surrogatepass")) >> 1) for w, a, b in around]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Lexicon of a labelled sample (text, y 0/1), on top of the base lexicon.

    Spark counts, per word, half of the sample and label, the texts that hold it and the distinct neighbourhoods it
    stands in; beginnings are sums over the words that begin so. Only entries that pass reach the driver.
    """
    base = dict.fromkeys(BASE_LEXICON, BASE_WEIGHT)
    totals = sample.groupBy("y").count().collect()
    toxic, clean = (sum(r["count"] for r in totals if r["y"] == v) for v in (1, 0))
    if not toxic or not clean:
        return base
    # Equal texts are in one half.
    halved = sample.select("text", F.col("y").cast("bigint").alias("y"),
                           (F.xxhash64(F.coalesce("text", F.lit(""))) % 2 == 0).cast("bigint").alias("half"))

    def words(batches):
        for b in batches:
            w, y, half, h = [], [], [], []
            for text, label, side in zip(*(b.column(k).to_pylist() for k in range(3))):
                found = _contexts(text)
                new = {x for x, _ in found}
                # A row of no neighbourhood stands for the text itself.
                w += [x for x, _ in found] + list(new)
                h += [a for _, a in found] + [None] * len(new)
                y += [label] * (len(found) + len(new))
                half += [side] * (len(found) + len(new))
            yield pa.RecordBatch.from_arrays(
                [pa.array(w, pa.string()), pa.array(y, pa.int64()), pa.array(half, pa.int64()), pa.array(h, pa.int64())],
                names=["w", "y", "half", "h"])

    places = (halved.mapInArrow(words, "w string, y bigint, half bigint, h bigint")
              .groupBy("w", "y", "half", "h").agg(F.count(F.lit(1)).alias("n")))
    told = {f"{what}{y}{half}": F.sum(F.expr(f"if(y = {y} and half = {half}, {value}, 0L)"))
            for what, value in (("texts", "if(h is null, n, 0L)"), ("places", "if(h is null, 0L, 1L)"))
            for y in (0, 1) for half in (0, 1)}
    counts = materialise(places.groupBy("w").agg(*[v.alias(k) for k, v in told.items()]), "toxic-words")
    all_places = counts.agg(*[F.sum(k).alias(k) for k in told]).first()
    tested = math.log(max(sum(r["count"] for r in totals), 1) * 250 / CHANCE)

    def strength(t: str, c: str, of_t: int, of_c: int) -> tuple[str, str]:
        """SQL: logarithm of the rates' ratio, and of the probability that chance makes so strong a one (Chernoff)."""
        p0 = of_t / (of_t + of_c)
        share = f"(({t}) / (({t}) + ({c})))"
        weight = f"ln((({t}) + 0.5D) / {of_t + 1}D) - ln((({c}) + 0.5D) / {of_c + 1}D)"
        evidence = (f"if(({t}) = 0, 0D, ({t}) * ln({share} / {p0!r}D)"
                    f" + if(({c}) = 0, 0D, ({c}) * ln((1 - {share}) / {1 - p0!r}D)))")
        return weight, evidence

    both = {k: all_places[f"places{k}0"] + all_places[f"places{k}1"] for k in (0, 1)}
    if not both[0] or not both[1]:
        return base
    by_place, place_evidence = strength("places10 + places11", "places00 + places01", both[1], both[0])
    by_text, text_evidence = strength("texts10 + texts11", "texts00 + texts01", toxic, clean)
    whole = (counts.withColumn("weight", F.expr(by_place)).withColumn("by_text", F.expr(by_text))
             .withColumn("evidence", F.expr(f"least({text_evidence}, {place_evidence})")))
    for r in (whole.where(F.col("w").isin(list(base)))
              .select("w", "weight", "by_text", F.expr("texts10 + texts11 + texts00 + texts01").alias("n")).collect()):
        if r["n"] >= BASE_KNOWN:
            if r["by_text"] < MIN_WEIGHT:
                del base[r["w"]]
            else:
                base[r["w"]] = max(r["weight"], MIN_WEIGHT)
    strong = whole.where(f"weight >= {MIN_WEIGHT!r}D and by_text >= {MIN_WEIGHT!r}D and evidence >= {tested!r}D")
    entries = {r["w"]: r["weight"] for r in strong.select("w", "weight").collect()}

    # A beginning must hold in either half by itself: it also stands for words that were never seen.
    sizes = ", ".join(f"if(char_length(w) > {k}, substr(w, 1, {k}), null)" for k in STEM_SIZES)
    stems = (counts.withColumn("stem", F.explode(F.expr(f"array({sizes})"))).where("stem is not null")
             .groupBy("stem").agg(*[F.sum(k).alias(k) for k in told], F.sum(F.expr(
                 "if(places10 + places11 > 0, 1L, 0L)")).alias("toxic_words")))
    holds = [f"toxic_words >= {STEM_WORDS}"]
    for half in (0, 1):
        of_t, of_c = all_places[f"places1{half}"], all_places[f"places0{half}"]
        if not of_t or not of_c:
            return base | entries
        weight, evidence = strength(f"places1{half}", f"places0{half}", of_t, of_c)
        holds += [f"texts1{half} >= {STEM_TEXTS}", f"({weight}) >= {MIN_STEM_WEIGHT!r}D", f"({evidence}) >= {tested!r}D"]
    found = (stems.where(" and ".join(holds))
             .select("stem", F.expr(by_place).alias("weight"), F.expr("places10 + places11").alias("t"),
                     F.expr("places00 + places01").alias("c")).collect())
    kept = {r["stem"]: (r["t"], r["c"], r["weight"]) for r in found}
    longest = {f"{s}*": v[2] for s, v in kept.items()
               if not any(o != s and o.startswith(s) and x[:2] == v[:2] for o, x in kept.items())}
    return base | longest | entries


def calibrate(strength: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the strength, lightly pulled to (1, -3) so that it exists for any sample."""
    theta, prior, pull = np.array([1.0, -3.0]), np.array([1.0, -3.0]), np.diag([0.5, 0.5])
    x = np.column_stack([strength, np.ones(len(strength))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(hess, x.T @ (y - p) - pull @ (theta - prior))
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 0.0), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS,
        max_rows: int = MAX_ROWS) -> tuple[dict[str, float], float, float]:
    """Lexicon, slope and offset from labelled documents that are not held out."""
    rows = docs.select("doc_id", "text")
    sample = materialise(labelled_sample(rows, labels, "toxic", 4, 2, max_rows).select("text", "y"), "toxic-sample")
    lexicon = learn_lexicon(sample)

    def strengths(batches):
        matcher = Matcher(lexicon, exceptions)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(matcher.strength(t)) for t in b.column(0).to_pylist()], pa.float64()),
                 b.column(1).cast(pa.float64())], names=["s", "y"])

    # Two numbers per sampled row.
    known = sample.mapInArrow(strengths, "s double, y double").toPandas()
    return lexicon, *calibrate(known["s"].to_numpy(), known["y"].to_numpy())


def toxicity_scores(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS,
                    max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    Learns from labelled documents whose id's crc32 leaves a remainder other than 2 by 4. Null and empty texts have no
    match and the lowest score. Repeated rows get equal scores; columns other than id and text are not read; without
    labels the base lexicon alone decides; an empty table gives an empty result.
    """
    lexicon, slope, offset = fit(docs, labels, exceptions, max_rows)

    def run(batches):
        matcher = Matcher(lexicon, exceptions)
        for b in batches:
            s = np.array([matcher.strength(t) for t in b.column(1).to_pylist()], np.float64)
            score = 1 / (1 + np.exp(-np.clip(slope * s + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], names=["doc_id", "score"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", is_held_out(4, 2).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted")))
