"""Quality rules with risk-controlled cutoffs.

Only DataFrame operations. One pass over the texts makes a narrow table of counts; everything after reads that table.
A rule (a ratio that is high in bad documents) has a ladder of cutoffs, and a stratum (a band of document lengths) its
own plan: per rule the cutoff that pays best, a good document lost costing as much as ``LOSS`` bad ones caught, and the
rules in the order of what they pay. Plans are made from the labelled bad documents and one in ``PLAN_SHARE`` of the good
ones. The other good ones, the holdout, have no say in the plan and test it as a fixed sequence: rule after rule is put in
force, and an exact binomial test tells whether the share of good documents that all rules so far reject *together* is
proven to stay under the whole risk. The sequence ends at the first test that fails, so its tests need no correction
among themselves; the strata share the error probability by Bonferroni. About 204 good documents of the holdout, none
of them rejected, prove a rule. Of the proven steps the best paying one is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import materialise, words_sql

# Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Share of the good documents of a stratum that all rules together may reject, and the probability of being wrong.
RISK = 0.02
ERROR = 0.05
LOSS = 20
# One in so many labelled good documents plans, by the hash of its id (below these leading digits); the others test.
PLAN_SHARE, PLAN_BELOW = 8, "2"
# Lower ends of the length bands that are the strata.
BANDS = (50, 200, 1000)
# Rule -> its ratio in SQL, its ladder of cutoffs in ascending order (a document above the cutoff is rejected).
RULES = {
    "symbols": ("n_symbols / n_words", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9)),
    "repeats": ("n_repeat_words / n_words", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4)),
    "shouting": ("n_capitals / greatest(word_chars, 1)", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7)),
    "word_length": ("word_chars / n_words", (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),
}


def _let(name: str, value: str, body: str) -> str:
    """SQL text: ``body`` with ``name`` bound to ``value``, which is computed once (a column that is only read inside a
    lambda could be inlined there and computed for each element)."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeat_words_sql() -> str:
    """SQL text: words of the array ``w`` that lie in a 3-word window found twice or more, the first one included.

    The windows are sorted (by hash, then by their words, so that equal ones are neighbours), those with an equal
    neighbour give their places, and the sum of the steps between places, three at most, is the number of words.
    """
    windows = ("sort_array(transform(sequence(0, size(w) - 3), i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) as h,"
               " w[i] as a, w[i + 1] as b, w[i + 2] as c, i as p)))")

    def same(other: str) -> str:
        return f"(x.h = {other}.h and x.a = {other}.a and x.b = {other}.b and x.c = {other}.c)"

    twice = f"filter(s, (x, k) -> coalesce({same('get(s, k - 1)')}, false) or coalesce({same('get(s, k + 1)')}, false))"
    covered = (f"aggregate(sort_array(transform({twice}, x -> x.p)), named_struct('at', -3, 'n', 0),"
               " (a, p) -> named_struct('at', p, 'n', a.n + least(3, p - a.at)), a -> a.n)")
    return f"if(size(w) < 4, 0, {_let('s', windows, covered)})"


def text_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The counts that the rules read, one row per document (null text: as an empty one)."""
    text = f"coalesce(`{text_col}`, '')"
    lines = f"filter(split({text}, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.expr(_let("w", words_sql(f"`{text_col}`"), "named_struct('n_words', cast(size(w) as bigint),"
                    " 'word_chars', cast(char_length(array_join(w, '')) as bigint),"
                    f" 'n_repeat_words', cast({repeat_words_sql()} as bigint))")).alias("by_word"),
        F.expr(_let("l", lines, "named_struct('n_lines', cast(size(l) as bigint),"
                    " 'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint))")).alias("by_line"),
        F.expr(f"cast(size(split({text}, '[#*$%&|<>]', -1)) - 1 as bigint)").alias("n_symbols"),
        F.expr(f"cast(size(split({text}, '[A-Z]', -1)) - 1 as bigint)").alias("n_capitals"))
    return counted.select("doc_id", "by_word.n_words", "by_word.word_chars", "n_symbols", "by_line.n_dup_lines",
                          "by_word.n_repeat_words", "by_line.n_lines", "n_capitals")


def with_base_rules(counts: DataFrame) -> DataFrame:
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    return counts.withColumn("base_failed", F.expr(failed))


def _band() -> str:
    cases = " ".join(f"when n_words >= {b} then {k}" for k, b in reversed(list(enumerate(BANDS))))
    return f"case {cases} end"


def binomial_tail_sql(n: str, k: str, p: float) -> str:
    """SQL text: P(Bin(n, p) <= k), exact up to rounding. Above the mean it is set to 1 (no test passes there), which
    bounds the terms to be summed by n * p."""
    from math import log

    odds = log(p / (1 - p))
    first = f"{n} * {log(1 - p)!r}D"
    step = f"ln(({n} - j + 1) / j) + {odds!r}D"
    total = (f"aggregate(sequence(1L, {k}), named_struct('t', {first}, 's', exp({first})),"
             f" (a, j) -> named_struct('t', a.t + {step}, 's', a.s + exp(a.t + {step})), a -> a.s)")
    return f"case when {k} > {n} * {p!r}D then 1.0D when {k} = 0 then exp({first}) else {total} end"


def _planning() -> str:
    """SQL text: whether a labelled document serves to plan the rules and not to test them."""
    return f"md5(cast(doc_id as string)) < '{PLAN_BELOW}'"


def proven_cutoffs(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, rule, cutoff) of each rule that is in force; at most one row per band and rule.

    ``labels`` has (doc_id, good boolean), one row per document. Only labelled documents that the base rules pass
    count. The labelled rows are counted per band, rule and rung, and per band and place in the plan, with partial
    aggregation; what is left are tables of bands x rules x rungs, whatever the number of documents.
    """
    from pyspark.sql import Window

    known = (counts.where("not base_failed").join(labels, "doc_id").withColumn("band", F.expr(_band()))
             .withColumn("planning", F.expr(_planning())))
    rungs = ", ".join(f"named_struct('rule', '{r}', 'rung', size(filter(array({', '.join(f'{c!r}D' for c in cuts)}),"
                      f" c -> cast({ratio} as double) > c)))" for r, (ratio, cuts) in RULES.items())
    seen = (known.where("planning or not good").select("band", "good", F.explode(F.expr(f"array({rungs})")).alias("r"))
            .groupBy("band", "r.rule", "r.rung").agg(
                F.sum(F.expr("cast(good as bigint)")).alias("good"),
                F.sum(F.expr("cast(not good as bigint)")).alias("bad")))
    ladder = ", ".join(f"named_struct('at_rule', '{r}', 'at_rung', {k}, 'cutoff', {c!r}D)"
                       for r, (_, cuts) in RULES.items() for k, c in enumerate(cuts))
    # A document on rung g stands above the cutoffs 0 .. g - 1.
    best = Window.partitionBy("band", "rule").orderBy(F.col("pays").desc(), F.col("at_rung").desc())
    plan = materialise(
        seen.select("*", F.explode(F.expr(f"array({ladder})")).alias("c")).select("*", "c.*").where("rule = at_rule")
        .groupBy("band", "rule", "at_rung", "cutoff").agg(
            F.sum(F.expr(f"if(rung > at_rung, bad - {LOSS * PLAN_SHARE} * good, 0L)")).alias("pays"))
        .where("pays > 0").withColumn("rank", F.row_number().over(best)).where("rank = 1")
        .withColumn("place", F.row_number().over(Window.partitionBy("band").orderBy(F.col("pays").desc(), "rule")))
        .select("band", "rule", "cutoff", "place"), "quality-plan")
    # A row per band at most, so this side is broadcast.
    wide = plan.groupBy(F.col("band").alias("of_band")).pivot("rule", list(RULES)).agg(
        F.first(F.struct("cutoff", "place")))
    first = ", ".join(f"if(cast({ratio} as double) > `{r}`.cutoff, `{r}`.place, null)" for r, (ratio, _) in RULES.items())
    # The first rule of the plan that rejects a document; 99 if none does.
    hit = (known.join(F.broadcast(wide), F.col("band") == F.col("of_band"))
           .select("band", "good", "planning", F.expr(f"coalesce(array_min(array({first})), 99)").alias("by"))
           .groupBy(F.col("band").alias("h_band"), "by").agg(
               F.sum(F.expr("cast(good and not planning as bigint)")).alias("tested"),
               F.sum(F.expr("cast(good as bigint)")).alias("good"), F.sum(F.expr("cast(not good as bigint)")).alias("bad")))
    upto = Window.partitionBy("band").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = (plan.join(hit, F.col("band") == F.col("h_band")).groupBy("band", "rule", "cutoff", "place").agg(
        F.sum("tested").alias("n"), F.sum(F.expr("if(by <= place, tested, 0L)")).alias("k"),
        F.sum(F.expr(f"if(by <= place, bad - {LOSS} * good, 0L)")).alias("pays"))
        .withColumn("tail", F.expr(binomial_tail_sql("n", "k", RISK)))
        .where("n > 0").withColumn("proven", F.max(F.expr(f"tail > {ERROR / len(BANDS)!r}D")).over(upto) == F.lit(False)))
    # The best paying of the proven steps, the first of equals, and the rules up to it.
    top = Window.partitionBy("band")
    paying = steps.where("proven").withColumn("most", F.max("pays").over(top)).where("most > 0")
    return (paying.withColumn("last", F.min(F.expr("if(pays = most, place, null)")).over(top)).where("place <= last")
            .select("band", "rule", "cutoff"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), a row per input row.

    ``labels`` has (doc_id, quality 0/1); a document with several labels counts as its worst, null labels not at all.
    Null and empty texts have no words and fail the base rules. Repeated rows get equal verdicts. Other columns are
    not read. Without labels, or with too few to prove anything, only the base rules reject.
    """
    counts = materialise(with_base_rules(text_counts(docs, text_col, id_col)), "quality-counts")
    known = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
             .agg((F.min("quality") == 1).alias("good")))
    cutoffs = proven_cutoffs(counts, known)
    # A row per band at most (three), so this side is broadcast.
    per_band = (cutoffs.groupBy("band").pivot("rule", list(RULES)).agg(F.first("cutoff"))
                .withColumnRenamed("band", "of_band"))
    above = " or ".join(f"coalesce(cast({ratio} as double) > `{r}`, false)" for r, (ratio, _) in RULES.items())
    return (counts.join(F.broadcast(per_band), F.expr(_band()) == F.col("of_band"), "left")
            .withColumn("kept", F.expr(f"not base_failed and not ({above})"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns they came with.

    The verdict is joined back by id. Rows that share an id are kept or dropped together (kept if any of them passes),
    so none is lost through a row beside it; a null id is an id of its own.
    """
    verdicts = quality_verdicts(docs, labels).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(verdicts, docs["doc_id"].eqNullSafe(verdicts["kept_id"]), "left_semi")


def oracle_sql() -> str:
    error = ERROR / len(BANDS)
    ladder = ", ".join(f"('{r}', {k}, {c!r}::DOUBLE)" for r, (_, cuts) in RULES.items() for k, c in enumerate(cuts))
    ratios = " UNION ALL ".join(f"SELECT rid, doc_id, {_band()} AS band, '{r}' AS rule, ({ratio})::DOUBLE AS v"
                                " FROM counts WHERE NOT base_failed" for r, (ratio, _) in RULES.items())
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT rid, unnest(list_transform(range(1, len(w) - 1),
                     lambda i: {{'i': i, 'g': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}}), recursive := true) FROM d),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
counts AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM (
    SELECT d.rid, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
           len(l)::BIGINT AS n_lines, len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_capitals
    FROM d LEFT JOIN rep ON d.rid = rep.rid)),
ratio AS ({ratios}),
known AS (SELECT doc_id, min(quality) = 1 AS good FROM labels
          WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
ladder(rule, rung, cutoff) AS (VALUES {ladder}),
labelled AS (SELECT r.*, good, md5(doc_id::VARCHAR) < '{PLAN_BELOW}' AS planning FROM ratio r JOIN known USING (doc_id)),
picks AS (
  SELECT r.band, r.rule, rung, cutoff,
         coalesce(sum(CASE WHEN v <= cutoff THEN 0 WHEN NOT good THEN 1 WHEN planning THEN {-LOSS * PLAN_SHARE} ELSE 0 END), 0) AS pays
  FROM labelled r JOIN ladder c ON c.rule = r.rule GROUP BY ALL),
chosen AS (
  SELECT * FROM picks WHERE pays > 0 QUALIFY row_number() OVER (PARTITION BY band, rule ORDER BY pays DESC, rung DESC) = 1),
plan AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY pays DESC, rule) AS place FROM chosen),
firsts AS (
  SELECT r.rid, r.band, good, planning, coalesce(min(place) FILTER (v > cutoff), 99) AS by_place
  FROM labelled r LEFT JOIN plan p ON p.band = r.band AND p.rule = r.rule GROUP BY ALL),
steps AS (
  SELECT p.band, p.rule, p.cutoff, place, count(*) FILTER (good AND NOT planning) AS n,
         count(*) FILTER (good AND NOT planning AND by_place <= place) AS k,
         count(*) FILTER (NOT good AND by_place <= place) - {LOSS} * count(*) FILTER (good AND by_place <= place) AS gain
  FROM plan p JOIN firsts f ON f.band = p.band GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k > n * {RISK!r}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
         exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK!r}::DOUBLE)
             + (n - j) * ln(1 - {RISK!r}::DOUBLE)))) END AS tail FROM steps WHERE n > 0),
proven AS (SELECT * FROM tails QUALIFY max(tail) OVER (PARTITION BY band ORDER BY place) <= {error!r}::DOUBLE),
paying AS (SELECT *, max(gain) OVER (PARTITION BY band) AS most FROM proven),
cutoffs AS (
  SELECT band, rule, cutoff FROM paying WHERE most > 0
  QUALIFY place <= min(place) FILTER (gain = most) OVER (PARTITION BY band)),
hit AS (SELECT DISTINCT rid FROM ratio r JOIN cutoffs c ON r.band = c.band AND r.rule = c.rule AND r.v > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM hit) AS kept
FROM counts
"""
