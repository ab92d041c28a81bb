"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets, repeated epochs.

Only DataFrame operations. Every document gets a random key from its id; within a source documents are taken in key
order. The key's leading hexadecimal digits cut each source into key ranges, as many as its size asks for, so a source
with a third of all rows is many ranges and no task holds a source. Sums per range are a small table whose running
sums give each range its start, and a window inside each range gives each document its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import materialise, word_count_sql

# Source weights by rank, repeating.
WEIGHTS = (5, 2, 1)
# Words of the mix for each word of the sources, and how often a source may be repeated.
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
# Mean rows of a key range; ranges per source are powers of 16.
RANGE_ROWS = 1_024
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, n_docs) -> with weight and target.

    Sources are ranked by code point, null last; weights repeat by rank. Targets fill up in proportion to the weights
    until a source meets ``max_epochs`` times its size; what it leaves over goes to the others by weight, until none
    is above. All others then stand at one level (target / weight), and the sources that stopped are those of lowest
    cap / weight: taken in that order, the level they leave to the rest rises as long as the next one must stop too
    and falls after, so the level is the greatest of these values. One row per source here, not per document.
    """
    from pyspark.sql import Window

    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("src_rank") % len(weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src_rank")).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("src_rank")
    ranked = (sizes.withColumn("src_rank", F.row_number().over(by_name) - 1)
              .withColumn("weight", w).withColumn("cap", F.col("source_size") * max_epochs)
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_cap), F.lit(0)))
              .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
              .withColumn("all_size", F.sum("source_size").over(everything))
              .withColumn("all_weight", F.sum("weight").over(everything)))
    level = (F.col("all_size") * F.lit(total_share) - F.col("cap_before")) / (
        F.col("all_weight") - F.col("weight_before"))
    return (ranked.withColumn("level", F.max(level).over(everything))
            .select("source", "source_size", "n_docs", "weight",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
        weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, carry: bool = False) -> DataFrame:
    """One row per document: id, source, size, source_size, target, epochs, part, taken; with ``carry`` also the whole
    input row as the struct ``row``. ``taken = epochs * size + part`` is the words the mix takes, repeats counted.

    A source's budget is its target rounded to a whole word. It is met by whole epochs and then, in key order, by
    documents until it is used up; the document at the cut gives the words that are left, so the words taken from a
    source sum to its budget exactly. Null text has no words; a null source is a source of its own. Documents without
    words take none. Rows with the same id are ordered by their text, and equal rows are interchangeable, so reruns
    agree. Extra columns are ignored (or carried); an empty table gives an empty result.
    """
    from pyspark.sql import Window

    picked = [F.col(id_col).alias("id"), F.col(source_col).alias("source"),
              F.expr(word_count_sql(f"`{text_col}`")).alias("size"),
              F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))).alias("rand"),
              F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("tie")]
    if carry:
        picked.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = materialise(docs.select(*picked), "mix-rows")
    light = rows.drop("row")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # Leading digits of the key that make up a range of this source.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n_docs") / float(RANGE_ROWS)))).cast("int")
    targets = materialise(
        source_targets(sizes, weights, total_share, max_epochs).withColumn("digits", digits)
        .withColumnRenamed("source", "t_source"), "mix-targets")

    # The sources' table has a row per source. It is joined by name: adaptive execution broadcasts it by its
    # measured size, or else splits a hot source's rows.
    def keyed(df: DataFrame) -> DataFrame:
        return (df.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
                .withColumn("key_range", F.expr("substr(rand, 1, digits)")))

    in_order = (Window.partitionBy("source", "key_range").orderBy("rand", "id", "tie")
                .rowsBetween(Window.unboundedPreceding, -1))
    by_range = (Window.partitionBy("source").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = (keyed(light).groupBy("source", "key_range").agg(F.sum("size").alias("range_size"))
              .select(F.col("source").alias("r_source"), F.col("key_range").alias("r_range"),
                      F.coalesce(F.sum("range_size").over(by_range), F.lit(0)).alias("range_start")))
    out = (keyed(rows).withColumn("range_before", F.coalesce(F.sum("size").over(in_order), F.lit(0)))
           .join(starts, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("key_range") == F.col("r_range")))
           .withColumn("budget", F.round("target").cast("bigint"))
           .withColumn("epochs", F.expr("if(source_size > 0, budget div source_size, 0L)"))
           .withColumn("rest", F.expr("budget - epochs * source_size - range_start - range_before"))
           .withColumn("part", F.expr("greatest(0L, least(rest, size))"))
           .withColumn("taken", F.expr("epochs * size + part")))
    keep = ["size", "source_size", "target", "epochs", "part", "taken"]
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), *keep,
                      *(["row"] if carry else []))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each epoch that takes a document. The one document at a
    source's cut is taken whole if half of its words or more fit the budget, else not at all, so no text is cut and a
    source ends as near its budget as whole documents allow. Documents without words are kept once: they weigh nothing
    in any budget. Null ids, texts and sources are kept like others, equal rows each for itself; an empty table gives an
    empty result."""
    times = "if(size = 0, 1, epochs + if(part > 0 and 2 * part >= size, 1, 0))"
    out = mix(docs, carry=True).withColumn("copy", F.explode(F.expr(f"array_repeat(0, cast({times} as int))")))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS size,
         md5(concat_ws(':', '{SEED}', CAST(doc_id AS VARCHAR))) AS rand, md5(coalesce(text, '')) AS tie
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src_rank
  FROM d GROUP BY source),
w AS (SELECT *, CASE src_rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap::DOUBLE / weight, src_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.rand, d.doc_id, d.tie
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(budget - epochs * source_size - before, size)) AS BIGINT) AS taken
FROM e
"""
