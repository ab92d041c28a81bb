"""Quotation linking for chat formatting.

Only DataFrame operations. A message's lines carry a quote level (the '>' signs before them). Lines at level 0 are its
own, what it says without quotes; a run of lines at one level, up to an empty line, is a passage. Passages are normalised
to their words and hashed, as a whole and, from ``WINDOW`` words on, window by window, so that a quote that was folded
anew or is a part only has hashes in common with its original; lines of one's own are hashed too, for short quotes of one
line. Every hash of a quoted passage meets the latest earlier message of the conversation that says it itself: the
quoted hashes and those own ones that are quoted at all are put in order of turns, in ranges, and no pair of messages is
formed, however often a line is said or quoted. The message that most of what a message quotes at its lowest level
comes from is the one it answers; a message that quotes nothing known answers the message before it. Answers to the message before form chains, other answers start a chain of their own under the
message they answer, and the way down the chains is the message's place: in the order of these places every message
follows the one it answers and branches stay together.

Neither a conversation nor a line is gathered: the message before is found, and chains are numbered, by windows over
ranges of turns with a small table of what comes over from the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.llm.common import discard, materialise

# Turns in a range.
RANGE_TURNS = 4_096
# Words of a window.
WINDOW = 5

# Quote signs at the start of a line, blanks between them allowed.
_SIGNS = "^[ \\\\t]*(?:>[ \\\\t]*)*"
_BODY = f"regexp_replace(l, '{_SIGNS}', '')"


def normal_line_sql(body: str) -> str:
    """SQL text: a line without case, and with its white space made single and cut off at the ends."""
    return f"trim(regexp_replace(lower({body}), '\\\\s+', ' '))"


def message_lines(messages: DataFrame) -> DataFrame:
    """messages(msg, conv_id, turn, text) -> (msg, conv_id, turn, place, level, body) of lines that say something."""
    lines = (f"transform(split(coalesce(text, ''), '\\r?\\n'), (l, i) -> named_struct('place', i,"
             f" 'level', length(regexp_replace(regexp_extract(l, '{_SIGNS}', 0), '[^>]', '')), 'body', {_BODY}))")
    said = f"filter({lines}, x -> trim(x.body) <> '')"
    return (messages.select("msg", "conv_id", "turn", F.explode(F.expr(said)).alias("x"))
            .select("msg", "conv_id", "turn", "x.place", "x.level", F.expr(normal_line_sql("x.body")).alias("body")))


def message_passages(lines: DataFrame) -> DataFrame:
    """(msg, conv_id, turn, level, passage, n_lines, lines, words): runs of lines of one level that follow each other.
    The work of one message is that of one text."""
    here = Window.partitionBy("msg").orderBy("place")
    new = (F.col("place") != F.lag("place", 1, -2).over(here) + 1) | (F.col("level") != F.lag("level", 1, -1).over(here))
    runs = (lines.withColumn("new", new.cast("int"))
            .withColumn("passage", F.sum("new").over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return (runs.groupBy("msg", "conv_id", "turn", "level", "passage")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.array_sort(F.collect_list(F.struct("place", "body"))).alias("l"))
            .withColumn("lines", F.col("l.body")).drop("l")
            .withColumn("words", F.expr("split(array_join(lines, ' '), ' ')")))


_WHOLE = "xxhash64('passage', array_join(words, ' '))"
_WINDOWS = (f"if(size(words) < {WINDOW}, array(), transform(sequence(0, size(words) - {WINDOW}),"
            f" i -> xxhash64({', '.join(f'words[i + {k}]' for k in range(WINDOW))})))")


def passage_sources(passages: DataFrame) -> DataFrame:
    """(msg, level, passage, from_turn, hits): which earlier messages the hashes of each quoted passage lead to
    (null: none), a row per passage and message. A whole passage counts as its windows taken together."""
    quoted = passages.where("level > 0 and turn is not null").select(
        "msg", "conv_id", "turn", "level", "passage", F.explode(F.expr(
            f"concat(array(named_struct('hash', {_WHOLE}, 'weight', greatest(1, size(words) - {WINDOW - 1}))),"
            f" transform({_WINDOWS}, h -> named_struct('hash', h, 'weight', 1)))")).alias("x")).select(
        "msg", "conv_id", "turn", "level", "passage", "x.hash", "x.weight")
    wanted = quoted.select(F.col("conv_id").alias("c"), F.col("hash").alias("h")).distinct()
    own = (passages.where("level = 0 and turn is not null")
           .select("conv_id", "turn", F.explode(F.expr(
               f"concat(array({_WHOLE}), transform(lines, l -> xxhash64('passage', l)), {_WINDOWS})")).alias("hash"))
           .join(wanted, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")), "left_semi").distinct())
    nobody = {c: F.lit(None).cast(quoted.schema[c].dataType) for c in ("msg", "level", "passage", "weight")}
    both = quoted.unionByName(own.withColumns(nobody))
    found = _latest_before(both, F.when(F.col("msg").isNull(), F.col("turn")), "from_turn", ("conv_id", "hash"))
    return (found.where("msg is not null").groupBy("msg", "level", "passage", "from_turn")
            .agg(F.sum("weight").alias("hits")))


def own_text_sql(text: str = "text") -> str:
    """SQL text: a message without its quoted lines; runs of empty lines that this leaves become one."""
    kept = f"filter(split(coalesce({text}, ''), '\\r?\\n'), l -> not (l rlike '^[ \\\\t]*>'))"
    return (f"trim(BOTH ' \\n\\r\\t' FROM regexp_replace(array_join({kept}, '\\n'), "
            "'\\\\n([ \\\\t]*\\\\n){2,}', '\\n\\n'))")


def _latest_before(messages: DataFrame, value: Column, name: str, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """The largest ``value`` of the rows with an earlier turn and the same ``keys``, as column ``name``: the range's own
    by a window, and what comes over from the ranges before by a table of one row per range."""
    rows = messages.withColumn("v", value).withColumn("of_range", F.expr(f"floor(turn / {RANGE_TURNS})"))
    here = Window.partitionBy(*keys, "of_range").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    names = [f"r_{k}" for k in keys]
    over = Window.partitionBy(*names).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("of_range").alias("r"))
              .agg(F.max("v").alias("v")).select(*names, "r", F.max("v").over(over).alias("carried")))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip((*keys, "of_range"), (*names, "r"))]
    return (rows.withColumn("here", F.max("v").over(here)).join(ranges, same)
            .withColumn(name, F.greatest("here", "carried")).drop("v", "here", *names, "r", "carried", "of_range"))


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, reply, parent_turn, quoted_lines, linked_lines, chain, reply_path, chat), a row per row.

    ``reply`` is the message without quotes, ``chat`` the same as a role-marked turn. ``parent_turn`` is the turn it
    answers (null: the first). ``quoted_lines`` are its quoted lines that say something, ``linked_lines`` those in passages
    that an earlier message says, in whole or part. Sorting a conversation by ``reply_path`` gives the reply order. Null text is an empty
    message. Null conversation ids are one conversation; a null turn comes first and is nobody's original. Rows with
    the same turn are told apart by role and text, and equal rows are one message that all of them stand for. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                           F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.withColumn("msg", F.xxhash64("conv_id", "turn", "role", "text"))
    unique = rows.dropDuplicates(["msg"])
    # Only conversations that quote at all are cut to passages.
    quoting = (unique.where("text rlike '(?m)^[ \\\\t]*>'").select(F.col("conv_id").alias("c")).distinct())
    passages = materialise(message_passages(message_lines(
        unique.join(quoting, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi"))), "quote-passages")
    # The message that most of a passage comes from, the latest of equals.
    source = F.max(F.when(F.col("from_turn").isNotNull(), F.struct("hits", "from_turn")))
    origin = passage_sources(passages).groupBy(F.col("msg").alias("m"), F.col("passage").alias("p")).agg(
        source.alias("source"))
    quoted = passages.where("level > 0").select("msg", "level", "passage", "n_lines").join(
        origin, (F.col("msg") == F.col("m")) & (F.col("passage") == F.col("p")), "left").select(
        "msg", "level", "n_lines", F.col("source.from_turn").alias("from_turn"), F.col("source.hits").alias("hits"))
    votes = quoted.groupBy("msg", "level", "from_turn").agg(F.sum("n_lines").alias("n"), F.sum("hits").alias("size"))
    # Lowest level that is linked at all, then most text, then the latest turn.
    best = F.min(F.when(F.col("from_turn").isNotNull(), F.struct(
        F.col("level"), (-F.col("size")).alias("less"), (-F.col("from_turn")).alias("late"))))
    answers = votes.groupBy(F.col("msg").alias("m")).agg(
        best.alias("best"), F.sum("n").alias("quoted_lines"),
        F.sum(F.when(F.col("from_turn").isNotNull(), F.col("n"))).alias("linked_lines"))
    light = unique.select("msg", "conv_id", "turn")
    placed = (_latest_before(light, F.col("turn"), "turn_before")
              .join(answers, F.col("msg") == F.col("m"), "left")
              .withColumn("quoted_turn", -F.col("best.late"))
              .withColumn("parent_turn", F.coalesce("quoted_turn", "turn_before"))
              .withColumn("jump", F.expr("quoted_turn is not null and not (quoted_turn <=> turn_before)"))
              .select("msg", "conv_id", "turn", "parent_turn", "jump",
                      F.coalesce("quoted_lines", F.lit(0)).alias("quoted_lines"),
                      F.coalesce("linked_lines", F.lit(0)).alias("linked_lines")))
    placed = materialise(placed, "quote-links")
    # A message that does not jump is in the chain of the message before it: the chain that the last jump started.
    start = F.when(F.col("jump"), F.col("turn"))
    chained = (_latest_before(placed, start, "started")
               .withColumn("chain", F.coalesce(F.when(F.col("jump"), F.col("turn")), "started")))
    chained = materialise(chained.drop("started"), "quote-chains")
    # Chains are few beside messages: one row each, with the chain of the message that its first message answers.
    owners = chained.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("chain").alias("under")).distinct()
    owners = owners.groupBy("c", "t").agg(F.max("under").alias("under"))
    chains = (chained.where("jump").groupBy("conv_id", "chain").agg(F.min("parent_turn").alias("at"))
              .join(owners, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("t")), "left")
              .select("conv_id", "chain", "under",
                      F.expr("array(1L, -at, chain)").alias("way")))
    chains = materialise(chains, "quote-ways")
    while not chains.where("under is not null").isEmpty():
        # Each way takes on the way of the chain it hangs under, which doubles in reach every time.
        over = chains.select(F.col("conv_id").alias("c"), F.col("chain").alias("k"), F.col("under").alias("next"),
                             F.col("way").alias("head"))
        last, chains = chains, materialise(
            chains.join(over, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("under") == F.col("k")), "left")
            .select("conv_id", "chain", F.col("next").alias("under"),
                    F.expr("if(head is null, way, concat(head, way))").alias("way")), "quote-ways")
        discard(last)
    ways = chains.select(F.col("conv_id").alias("c"), F.col("chain").alias("k"), "way")
    found = (chained.join(ways, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chain") == F.col("k")), "left")
             .select(F.col("msg").alias("m"), "parent_turn", "quoted_lines", "linked_lines", "chain",
                     F.expr("concat(coalesce(way, array()), array(0L, coalesce(turn, -1L)))").alias("reply_path")))
    return (rows.join(found, F.col("msg") == F.col("m"))
            .withColumn("reply", F.expr(own_text_sql()))
            .withColumn("chat", F.expr("concat('<|', coalesce(role, 'user'), '|>\\n', reply, '\\n<|end|>\\n')"))
            .select(F.col("conv_id").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                    "reply", "parent_turn", "quoted_lines", "linked_lines", "chain", "reply_path", "chat"))
