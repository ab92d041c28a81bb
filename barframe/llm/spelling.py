"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols. One edit of a word is at most one edit of its reduced word, so the words near a
word are among those whose reduced word lies in the full one-edit neighbourhood of its own: the word itself, each symbol
replaced or deleted, each symbol inserted anywhere. A reduced neighbourhood has some sixty members where that over the
letters has a thousand. It is generated per word, hashed, joined with the reduced vocabulary as an equi-join, and every
pair that meets is verified on the original strings inside the join. The number of symbols follows from the size of the
vocabulary, so that a reduced word stands for a handful of words at any size.

A word's neighbourhood is quadratic in its length, so words over ``LONG`` code points meet otherwise: one edit leaves the
first or the second half of the shorter word as it is, and the halves are the keys.

All counting, generating, joining and verifying is built-in Spark SQL; nothing but two counts reaches the driver.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import discard, materialise

LETTERS = r"[A-Za-z\\u00C0-\\u00FF]+"  # as written inside a Spark SQL string literal
MIN_LENGTH = 6
MIN_COUNT = 5
TIMES = 5
# Words with more code points meet by halves.
LONG = 32
# Words that should share a reduced word of this length.
TYPICAL_LENGTH = 8
WORDS_PER_KEY = 8
LEAST_SYMBOLS = 4

_SYMBOLS = string.digits + string.ascii_lowercase
_ALPHABET = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]


def lower_ascii_sql(col: str) -> str:
    """SQL text: ``col`` with A-Z, and nothing else, in lower case."""
    return (f"if(octet_length({col}) = char_length({col}), lower({col}),"
            f" translate({col}, '{string.ascii_uppercase}', '{string.ascii_lowercase}'))")


def typed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip_every: int | None = 199) -> DataFrame:
    """(word): every maximal run of letters of every whole text, A-Z in lower case, one row per occurrence.

    With ``slip_every``, a run whose crc32 over ``<id>:<run>`` it divides has lost the code point at crc32 modulo its
    length, as a slip of the keyboard would; None leaves runs as they are. Null text has no runs; a null id is written
    as an empty string.
    """
    runs = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text_col].alias("text")).selectExpr(
        "id", f"explode(regexp_extract_all(coalesce(text, ''), '{LETTERS}', 0)) as run")
    runs = runs.selectExpr("id", f"{lower_ascii_sql('run')} as word")
    if slip_every is None:
        return runs.select("word")
    runs = runs.selectExpr("word", "crc32(cast(concat(id, ':', word) as binary)) as h")
    place = "cast(h % char_length(word) as int)"
    return runs.selectExpr(
        f"if(h % {int(slip_every)} = 0, concat(substr(word, 1, {place}), substr(word, {place} + 2)), word) as word")


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): distinct words that are long and frequent enough. Counted in each task before the only shuffle."""
    return (words.where(f"char_length(word) >= {int(min_length)}").groupBy("word").agg(F.count("*").alias("n"))
            .where(f"n >= {int(min_count)}"))


def symbols_for(size: int) -> int:
    """How many symbols a vocabulary of ``size`` words is reduced to."""
    k = LEAST_SYMBOLS
    while k < len(_SYMBOLS) and WORDS_PER_KEY * k ** TYPICAL_LENGTH < size:
        k += 1
    return k


def reduced_sql(col: str, symbols: int) -> str:
    """SQL text: ``col`` with each letter as its symbol, by a multiplicative hash of the code point."""
    to = "".join(_SYMBOLS[(ord(c) * 2654435761 >> 13) % symbols] for c in _ALPHABET)
    return f"translate({col}, '{''.join(_ALPHABET)}', '{to}')"


def neighbourhood_sql(col: str, symbols: int) -> str:
    """SQL text: hashes of the full one-edit neighbourhood of a reduced word, the word included, each once."""
    given = "array(" + ", ".join(f"'{s}'" for s in _SYMBOLS[:symbols]) + ")"
    head, size = f"substr({col}, 1, i - 1)", f"char_length({col})"
    replaced = f"flatten(transform(sequence(1, {size}), i -> transform({given}, s -> xxhash64(concat({head}, s, substr({col}, i + 1))))))"
    deleted = f"transform(sequence(1, {size}), i -> xxhash64(concat({head}, substr({col}, i + 1))))"
    inserted = f"flatten(transform(sequence(1, {size} + 1), i -> transform({given}, s -> xxhash64(concat({head}, s, substr({col}, i))))))"
    return f"array_distinct(concat({replaced}, {deleted}, {inserted}))"


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(word, near, near_n): every ordered pair of words at edit distance one, once. ``words`` has (word, n) with
    distinct words of letters."""
    short, long_ = f"char_length(word) <= {LONG + 1}", f"char_length(word) >= {LONG}"
    own = words.where(short).withColumn("reduced", F.expr(reduced_sql("word", symbols)))
    probes = own.selectExpr("word", f"explode({neighbourhood_sql('reduced', symbols)}) as key")
    homes = own.selectExpr("word as near", "n as near_n", "xxhash64(reduced) as home").hint("shuffle_hash")
    # Of two words on either side of the limit both are long enough for halves and short enough for neighbourhoods;
    # the neighbourhoods have the pair if the shorter is not over the limit.
    met = (probes.join(homes, (probes["key"] == homes["home"])
                       & F.expr(f"least(char_length(word), char_length(near)) <= {LONG} and levenshtein(word, near, 1) = 1"))
           .select("word", "near", "near_n"))
    # Halves of the shorter word of a pair: of this length, or one less where this word is the longer one.
    keys = "array(char_length(word), char_length(word) - 1)"
    half = words.where(long_).selectExpr("word", "n", f"explode({keys}) as least")
    sides = half.selectExpr("word", "n", "least", "explode(array(concat('<', left(word, cast(least div 2 as int))),"
                            " concat('>', right(word, cast(least div 2 as int))))) as part")
    sides = sides.selectExpr("word", "n", "least", "xxhash64(part, least) as key")
    others = sides.selectExpr("word as near", "n as near_n", "least as near_least", "key as home")
    halves = (sides.join(others, (sides["key"] == others["home"])
                         & F.expr(f"least(char_length(word), char_length(near)) > {LONG} and levenshtein(word, near, 1) = 1"))
              .select("word", "near", "near_n").distinct())
    return met.unionByName(halves)


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's near words counted, and the most frequent of them (the smallest in
    code-point order of several) where it occurs at least ``times`` as often as the word."""
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) as n_near", f"if(-best.less >= {int(times)} * n, best, null) as best")
    return out.selectExpr("word", "n", "n_near", "best.near as form", "-best.less as form_n")


def with_roots(table: DataFrame) -> DataFrame:
    """``table`` (word, form, ...) with ``root``, where the forms lead from a word in the end: the word itself without
    one. Paths are followed by doubling; each form is several times as frequent as the word before, so there are few
    rounds at any size."""
    up = materialise(table.where("form is not null").selectExpr("word", "form as root", "true as moved"), "spelling-roots")
    while not up.where("moved").isEmpty():
        over = up.selectExpr("word as via", "root as top")
        last, up = up, materialise(up.join(over, up["root"] == over["via"], "left")
                                   .selectExpr("word", "coalesce(top, root) as root", "top is not null as moved"), "spelling-roots")
        discard(last)
    ends = up.selectExpr("word as via", "root as top")
    return table.join(ends, table["word"] == ends["via"], "left").drop("via").selectExpr("*", "coalesce(top, word) as root").drop("top")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip_every: int | None = 199,
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root): the vocabulary of whole texts with each word's variants.

    A word is a run of letters (``typed_words``) with at least ``min_length`` code points and ``min_count``
    occurrences. Near words differ by exactly one inserted, deleted or replaced code point; a word's form is its most
    frequent near word (ties: the smallest in code-point order), if that is at least ``times`` as frequent; ``root`` is
    where forms lead. Null and empty texts have no words, repeated rows count each time, very long words and texts are
    treated like others, an empty table gives an empty result; other columns are not read.
    """
    words = materialise(vocabulary(typed_words(docs, id_col, text_col, slip_every), min_length, min_count), "spelling-words")
    table = materialise(forms(words, near_pairs(words, symbols_for(words.count())), times), "spelling-forms")
    return with_roots(table).select("word", "n", "n_near", "form", "form_n", "root")
