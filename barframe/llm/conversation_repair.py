"""Conversation structure repair at least cost, by dynamic programming over run lengths.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Every row is kept, given the role that fits,
or deleted, and messages may be inserted; the cheapest edits are found over four states (nothing yet, after system,
after user, after assistant). What a row may become depends on one of nine symbols: its initial and whether it is cut
off, or that it has to go. Equal consecutive symbols are a run, a run of n rows is the n-th min-plus power of its
symbol's 4 x 4 transition, and powers come from cached squarings, so costs are known at the ends of runs without looking
at rows. Then the choices are unrolled from the front: of the edits that keep the cost, the first in ASCII order.

Rows are dealt by range of (conversation, turn), so a conversation with a third of all rows is many pieces. A task
repairs at once every conversation that certainly lies within its range. The first and the last of a range may go on in
another: their pieces are one matrix each, which are multiplied from the back for the costs behind every piece; each
piece then says which state it leads to from each state, these are followed from the front, and the pieces unroll. Only
the digest of a whole conversation is sequential by nature: its rows go in order through one task, which holds none.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import materialise, ship_package

INF = 1 << 40
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STATES = range(4)
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_FITTING = [2, 2, 3, 2]  # where the only user or assistant message that fits leads to
_ROLE = {2: "user", 3: "assistant"}
# Symbols: the initial, in capitals where the text is cut off, "-" for any other initial, "x" for rows that have to go.
GONE = "x"
# Rows of a run that are unrolled at once.
UNROLL = 4_096


def _times(a, b):
    return [[min(a[i][k] + b[k][j] for k in STATES) for j in STATES] for i in STATES]


def _apply(m, v):
    return [min(m[i][k] + v[k] for k in STATES) for i in STATES]


def _identity(cost=0):
    return [[cost if i == j else INF for j in STATES] for i in STATES]


def _insertions():
    one = _identity()
    for q in STATES:
        one[q][_FITTING[q]] = min(one[q][_FITTING[q]], INSERT)
    return _times(_times(one, one), _times(one, one))


_INSERT = _insertions()
# What is left to pay in each state when no row is left.
END = [min(_INSERT[q][0], _INSERT[q][3]) for q in STATES]


def choices(symbol: str, state: int):
    """(edit, cost, next state) of the edits of one row, in ASCII order without insertion."""
    yield "D", DELETE, state
    if symbol != GONE:
        extra = CUT_OFF if symbol.isupper() or symbol == "+" else 0
        to = _AFTER.get((state, symbol.lower()))
        if to is not None:
            yield "K", extra, to
        yield "R", REROLE + extra, _FITTING[state]


_POWERS: dict[str, list] = {}


def power(symbol: str, n: int):
    """The min-plus transition of ``n`` rows of a symbol, from cached squarings."""
    cached = _POWERS.get(symbol)
    if cached is None:
        row = [[INF] * 4 for _ in STATES]
        for q in STATES:
            for _, cost, to in choices(symbol, q):
                row[q][to] = min(row[q][to], cost)
        cached = _POWERS[symbol] = [_times(_INSERT, row)]
    out, k = None, 0
    while n:
        if k == len(cached):
            cached.append(_times(cached[-1], cached[-1]))
        if n & 1:
            out = cached[k] if out is None else _times(out, cached[k])
        n, k = n >> 1, k + 1
    return out or _identity()


def symbol_of(role: str, text: str, again: bool) -> tuple[str, str]:
    """(fault, symbol) of a row; ``again``: its role and text were seen before."""
    body = text.rstrip(SPACE)
    if not body:
        return "blank", GONE
    if again:
        return "duplicate", GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
    if body[-1] in ".!?":
        return "", initial
    return "truncated", "+" if initial == "-" else initial.upper()


def runs_of(symbols) -> list[tuple[str, int]]:
    """Runs of equal symbols, long ones in parts."""
    out = []
    for s, group in itertools.groupby(symbols):
        n = sum(1 for _ in group)
        out += [(s, UNROLL)] * (n // UNROLL) + ([(s, n % UNROLL)] if n % UNROLL else [])
    return out


def costs_behind(runs, end):
    """For each run the least cost in each state after it, and the cost before the first."""
    out, v = [], end
    for s, n in reversed(runs):
        out.append(v)
        v = _apply(power(s, n), v)
    return out[::-1], v


def unroll(runs, end, state: int):
    """Edits of each row (insertions before it included) and the state after the last. ``end``: the least costs of what
    follows. Of the edits that keep the cost the first in ASCII order is taken: D, I, K, R."""
    behind, _ = costs_behind(runs, end)
    edits = []
    for (s, n), after in zip(runs, behind):
        one, ahead = power(s, 1), [after]
        for _ in range(n):
            ahead.append(_apply(one, ahead[-1]))
        for k in range(n, 0, -1):
            now, then, taken = ahead[k], ahead[k - 1], ""
            while True:
                options = list(choices(s, state))
                edit, cost, to = options[0]
                if cost + then[to] == now[state]:
                    break
                if INSERT + now[_FITTING[state]] == now[state]:
                    taken, state = taken + "I", _FITTING[state]
                    continue
                edit, cost, to = next(o for o in options[1:] if o[1] + then[o[2]] == now[state])
                break
            edits.append(taken + edit)
            state = to
    return edits, state


def closing(state: int) -> tuple[str, int]:
    """Insertions after the last row."""
    taken = ""
    while state in (1, 2):
        taken, state = taken + "I", _FITTING[state]
    return taken, state


class Repaired:
    """Collects one conversation's rows in order; holds counts and a running digest, no texts."""

    def __init__(self):
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.state, self.audit, self.digest, self.lines = 0, [], hashlib.sha256(), 0
        self.low = self.high = self.last = self.initial = None
        self.turns = 0

    def _line(self, role: str, text: str):
        self.digest.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def insert(self, n: int):
        for _ in range(n):
            self.state = _FITTING[self.state]
            self._line(_ROLE[self.state], "")
        self.audit.append("I" * n)
        self.counts["cost"] += INSERT * n

    def row(self, turn, role: str, text: str, fault: str, edits: str):
        if turn is not None:
            self.turns += turn != self.last
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = role[:1]
        self.insert(len(edits) - 1)
        edit = edits[-1]
        self.audit.append(edit)
        if edit == "D":
            self.counts["cost"] += DELETE
            return
        self.counts["cost"] += (REROLE if edit == "R" else 0) + (CUT_OFF if fault == "truncated" else 0)
        if edit == "K":
            self.state = _AFTER[self.state, role[:1]]
            self._line(role, text)
        else:
            self.state = _FITTING[self.state]
            self._line(_ROLE[self.state], text)

    def result(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, **self.counts, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def repair(rows: list[tuple]) -> dict:
    """Counts, cost, audit and digest of one conversation's (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append(symbol_of(role, text, (role, text) in seen))
        seen.add((role, text))
    edits, state = unroll(runs_of(s for _, s in faults), END, 0)
    out = Repaired()
    for (turn, role, text), (fault, _), e in zip(rows, faults, edits):
        out.row(turn, role, text, fault, e)
    out.insert(len(closing(state)[0]))
    return out.result()


_RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
           " repaired_sha256 string")
_OPEN = "piece int, pos bigint, turn bigint, role string, text string, seen binary"
_RESULT_NAMES = [f.split()[0] for f in _RESULT.split(", ")]
_OPEN_NAMES = [f.split()[0] for f in _OPEN.split(", ")]


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _in_batches(rows, schema: pa.Schema, size: int = 2_000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield _table(held, schema)
            held = []
    if held:
        yield _table(held, schema)


def _rows(batches):
    for b in batches:
        yield from b.to_pylist()


def _first_pass(batches):
    """Results of the conversations inside a range, and the rows of its first and last, in order."""
    from pyspark import TaskContext

    piece, pos = TaskContext.get().partitionId(), itertools.count()

    def opened(conv, r):
        if r["text"] is None:  # dropped: only says that the conversation is there
            return {"conv": conv, "piece": piece, "pos": next(pos)}
        mark = f"{len(r['role'])}:{r['role']}{r['text']}".encode("utf-8", "surrogatepass")
        return {"conv": conv, "piece": piece, "pos": next(pos), "turn": r["turn"], "role": r["role"], "text": r["text"],
                "seen": hashlib.sha256(mark).digest()}

    def out():
        first, conv, held = True, None, []
        for conv, group in itertools.groupby(_rows(batches), lambda r: r["conv"]):
            if first:
                yield from (opened(conv, r) for r in group)
                first = False
                continue
            if held:
                yield {"conv": before, **repair([(r["turn"], r["role"], r["text"]) for r in held if r["text"] is not None])}
            before, held = conv, list(group)
        yield from (opened(before, r) for r in held)

    yield from _in_batches(out(), _arrow(f"conv string, {_OPEN}, {_RESULT}"))


def _piece_runs(batches):
    """The symbol runs of each piece and the matrix of the whole."""
    for (conv, piece), group in itertools.groupby(_rows(batches), lambda r: (r["conv"], r["piece"])):
        runs = runs_of(r["symbol"] for r in group)
        m = _identity()
        for s, n in runs:
            m = _times(m, power(s, n))
        yield {"conv": conv, "piece": piece, "symbols": [s for s, _ in runs], "sizes": [n for _, n in runs],
               "matrix": [x for row in m for x in row]}


def _costs(batches):
    """Costs behind each piece; pieces come last first."""
    for conv, group in itertools.groupby(_rows(batches), lambda r: r["conv"]):
        v = END
        for r in group:
            yield {"conv": conv, "piece": r["piece"], "behind": v}
            v = _apply([r["matrix"][4 * q:4 * q + 4] for q in STATES], v)


def _exits(batches):
    for r in _rows(batches):
        runs = list(zip(r["symbols"], r["sizes"]))
        yield {**r, "exits": [unroll(runs, r["behind"], q)[1] for q in STATES]}


def _entries(batches):
    for conv, group in itertools.groupby(_rows(batches), lambda r: r["conv"]):
        q = 0
        for r in group:
            yield {"conv": conv, "piece": r["piece"], "entry": q}
            q = r["exits"][q]


def _edits(batches):
    for r in _rows(batches):
        yield {"conv": r["conv"], "piece": r["piece"],
               "edits": unroll(list(zip(r["symbols"], r["sizes"])), r["behind"], r["entry"])[0]}


def _whole(batches):
    """Results of conversations whose rows come in order with their edits."""
    for conv, group in itertools.groupby(_rows(batches), lambda r: r["conv"]):
        out = Repaired()
        for r in group:
            if r["text"] is not None:
                out.row(r["turn"], r["role"], r["text"], r["fault"], r["edits"])
        out.insert(len(closing(out.state)[0]))
        yield {"conv": conv, **out.result()}


def _mapped(df: DataFrame, f, ddl: str) -> DataFrame:
    schema = _arrow(ddl)
    return df.mapInArrow(lambda batches: _in_batches(f(batches), schema), ddl)


_PIECE = "conv string, piece int, symbols array<string>, sizes array<bigint>, matrix array<bigint>"


def _repair_pieces(open_rows: DataFrame) -> DataFrame:
    """Results of conversations that may lie in several ranges."""
    body = open_rows.where("text is not null")
    # A row is a duplicate unless it is the first of its role and text; the first is a partial aggregate.
    firsts = body.groupBy("conv", "seen").agg(F.min(F.struct("piece", "pos")).alias("first")).withColumnsRenamed(
        {"conv": "first_conv", "seen": "first_seen"})
    blank = "rtrim('\\u0020\\t\\n\\u000b\\f\\r', text) = ''"
    marked = (body.join(firsts, (body["conv"] == firsts["first_conv"]) & (body["seen"] == firsts["first_seen"]))
              .selectExpr("conv", "piece", "pos", "role",
                          f"{blank} as blank", "struct(piece, pos) <> first as again",
                          "right(rtrim('\\u0020\\t\\n\\u000b\\f\\r', text), 1) not in ('.', '!', '?') as cut"))
    initial = "if(left(role, 1) in ('s', 'u', 'a'), left(role, 1), '-')"
    marked = marked.selectExpr(
        "conv", "piece", "pos", "case when blank then 'blank' when again then 'duplicate' when cut then 'truncated' else '' end as fault",
        f"case when blank or again then '{GONE}' when cut then if({initial} = '-', '+', upper({initial})) else {initial} end as symbol")
    marked = materialise(marked, "repair-symbols")
    pieces = materialise(_mapped(marked.repartition("conv", "piece").sortWithinPartitions("conv", "piece", "pos"),
                                 _piece_runs, _PIECE), "repair-pieces")
    by_conv = pieces.select("conv", "piece", "matrix").repartition("conv")
    behind = _mapped(by_conv.sortWithinPartitions("conv", F.col("piece").desc()), _costs,
                     "conv string, piece int, behind array<bigint>")
    costed = materialise(_mapped(pieces.drop("matrix").join(behind, ["conv", "piece"]), _exits,
                                 "conv string, piece int, symbols array<string>, sizes array<bigint>, behind array<bigint>,"
                                 " exits array<bigint>"), "repair-costs")
    entry = _mapped(costed.select("conv", "piece", "exits").repartition("conv").sortWithinPartitions("conv", "piece"),
                    _entries, "conv string, piece int, entry bigint")
    edits = _mapped(costed.drop("exits").join(entry, ["conv", "piece"]), _edits,
                    "conv string, piece int, edits array<string>")
    # The n-th row of a piece has the n-th edits.
    ranked = marked.groupBy("conv", "piece").agg(F.array_sort(F.collect_list(F.struct("pos", "fault"))).alias("rows"))
    ranked = ranked.join(edits, ["conv", "piece"]).selectExpr("conv", "piece", "explode(arrays_zip(rows, edits)) as x")
    ranked = ranked.selectExpr("conv", "piece", "x.rows.pos as pos", "x.rows.fault as fault", "x.edits as edits")
    return _mapped(open_rows.join(ranked, ["conv", "piece", "pos"], "left").drop("seen")
                   .repartition("conv").sortWithinPartitions("conv", "piece", "pos"), _whole, f"conv string, {_RESULT}")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with damage by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): 0 dropped (text null
    here, so that the conversation is not lost), 1 emptied, 2 without ``.!?``, 3 twice, 4 said by the user."""
    key = "concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' '))"
    rows = rows.selectExpr("conv_id", "turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text",
                           f"crc32(cast({key} as binary)) % 20 as harm")
    return rows.selectExpr(
        "conv_id", "turn", "if(harm = 4, 'user', role) as role",
        "case harm when 0 then null when 1 then '' when 2 then translate(text, '.!?', '') else text end as text",
        "explode(if(harm = 3, array(0, 1), array(0))) as copy").drop("copy")


def repair_conversations(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row per conversation.

    ``rows`` has conv_id, turn, role and text, a null text standing for a row that is not there; other columns are not
    read. Rows are in order of turn (nulls first); rows of one turn in order of role, the first 32 characters and a hash of
    their text, so that equal rows are neighbours. A null role is one space, null ids are one conversation, repeated rows
    are duplicates, an empty table gives an empty result. A conversation without rows has zeros, an empty audit and the
    digest of an empty string. gaps: turns missing between the smallest and the largest.
    """
    spark = rows.sparkSession
    ship_package(spark)
    kind = rows.schema["conv_id"].dataType.simpleString()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = rows.selectExpr("if(conv_id is null, 'n', concat('v', cast(conv_id as string))) as conv",
                            "cast(turn as bigint) as turn", "coalesce(role, ' ') as role", "text",
                            "left(coalesce(text, ''), 32) as head", "xxhash64(text) as hash",
                            "monotonically_increasing_id() as row")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("hash"), F.col("row")]
    found = materialise(
        ready.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv", "turn", "role", "text")
        .mapInArrow(_first_pass, f"conv string, {_OPEN}, {_RESULT}"), "repair-first")
    inside = found.where("piece is null").select("conv", *_RESULT_NAMES)
    across = _repair_pieces(found.where("piece is not null").select("conv", *_OPEN_NAMES))
    return inside.unionByName(across).selectExpr(f"cast(if(conv = 'n', null, substr(conv, 2)) as {kind}) as conv_id",
                                                 *_RESULT_NAMES)
