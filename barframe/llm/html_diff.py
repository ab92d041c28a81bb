"""Main text of web pages by differencing each page with its nearest by URL.

Pages of a host are ordered by URL path; neighbours in that order are pages made from one template. The text lines
(blocks) of a page are aligned with those of the page before and the page after by their longest common subsequence,
and lines that align are the template's: they are deleted. Two kinds of line are settled by their markup, because
differencing must get them wrong: prose inside the article element is kept though it aligns (copies, quotations and
shared passages are content, not template), and what stands in menus, footers, forms, adverts and the like is deleted
though it does not align (their wording may differ from page to page). Differencing decides about every other line: all
that is not page furniture where a page has no article or main element, and beside one where it has.

Pages of a host with the same lines are one page in the order, the first of them, and all get its verdict: copies have
the same neighbours, and never delete each other. The order is found on keys alone: a range partition of (host, path)
numbers the pages, and every page sends its line hashes to the numbers beside it, so that any host, however large, is
spread and no group has more than three members.
Only hashes travel for the alignment; the lines move once, packed, to meet the numbers of those kept.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barframe.llm.common import materialise

NEUTRAL, CONTENT, FURNITURE = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|object|head|title|textarea|select|button)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PARTS = re.compile(r"[a-z]+")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img picture source input "
                   "math semantics mrow mi mo mn mtext msup msub msubsup mfrac msqrt mroot mover munder".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HOLDERS = frozenset("div section nav header footer aside form article main ul ol dl table body details dialog fieldset "
                    "figure menu center".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAGS = frozenset(("article", "main"))
# Words that name page furniture in class, id and role; inside an article only in class and role of a block.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo cookie cookies consent notice "
    "notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar "
    "toolbar comment comments disqus respond share sharing social related recommended newsletter subscribe subscription "
    "signup login search widget pagination pager contentinfo complementary".split())


# How surely an element is page furniture. An article or main element inside a SOFT one (a wrapper "with-sidebar", a form
# around the whole page) is content all the same; inside a HARD one (a navigation, reader comments) it is not.
SOFT, HARD = 1, 2
HARD_TAGS = FURNITURE_TAGS - {"form"}
COMMENT_WORDS = frozenset("comment comments disqus respond".split())


def _furniture(tag: str, attrs: str, in_content: bool) -> int:
    if tag in ("html", "body"):
        return 0
    if in_content and (tag in INLINE or tag in HEADINGS):
        return 0
    named = {w for m in _NAMED.finditer(attrs) if not (in_content and m[0][:2].lower() == "id")
             for w in _PARTS.findall(m[1].lower())} if attrs else frozenset()
    if tag in CONTENT_TAGS:
        return HARD if named & COMMENT_WORDS and named <= COMMENT_WORDS | {"list", "item", "reply", "body"} else 0
    if tag in HARD_TAGS or (tag == "header" and not in_content) or named & COMMENT_WORDS:
        return HARD
    return SOFT if tag in FURNITURE_TAGS or named & FURNITURE_WORDS else 0


def page_lines(html: str | None) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order (references decoded, white space single), and what their markup makes them:
    furniture, article content, or neither."""
    lines: list[str] = []
    kinds: list[int] = []
    stack: list[tuple[str, int, bool]] = []  # open holders: tag, furniture, content
    piece: list[str] = []
    kind = NEUTRAL

    def close():
        text = "".join(piece)
        piece.clear()
        text = " ".join((unescape(text) if "&" in text else text).split())
        if text:
            lines.append(text)
            kinds.append(kind)

    at = 0
    html = html or ""
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            piece.append(html[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1]:
                if m[1].lower() in ("head", "title"):
                    close()
                elif m[1].lower() in ("textarea", "select", "button"):
                    piece.append(" ")
            continue
        tag = tag.lower()
        if m[2]:
            if tag in INLINE and not any(t == tag for t, _, _ in stack):
                continue
            if tag not in INLINE:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            top = stack[-1] if stack else ("", 0, False)
            furniture = _furniture(tag, m[4], top[2])
            if tag not in INLINE:
                close()
                if stack and stack[-1][0] == tag and tag in ("p", "li", "td", "tr", "dd", "dt"):
                    stack.pop()
                    top = stack[-1] if stack else ("", 0, False)
            if tag not in VOID and (tag in HOLDERS or furniture) and not m[4].rstrip().endswith("/"):
                around = 0 if tag in CONTENT_TAGS and top[1] == SOFT else top[1]
                stack.append((tag, max(around, furniture), top[2] or tag in CONTENT_TAGS))
        top = stack[-1] if stack else ("", 0, False)
        if tag in INLINE and (FURNITURE if top[1] else CONTENT if top[2] else NEUTRAL) != kind:
            close()
        kind = FURNITURE if top[1] else CONTENT if top[2] else NEUTRAL
    if at < len(html):
        piece.append(html[at:])
    close()
    return lines, kinds


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Indices in ``a`` of a longest common subsequence of two line sequences.

    Bit-parallel: one row of the length table is one integer, in which a zero bit marks a step up; the rows are kept
    and walked back.
    """
    shared = set(a) & set(b)
    if not shared:
        return set()
    left = [i for i, x in enumerate(a) if x in shared]
    right = [x for x in b if x in shared]
    where: dict[int, int] = {}
    for j, x in enumerate(right):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(right)) - 1
    rows, row = [full], full
    for i in left:
        step = row & where[a[i]]
        row = ((row + step) | (row - step)) & full
        rows.append(row)
    out, i, j = set(), len(left), len(right) - 1
    while i and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.add(left[i - 1])
            i -= 1
            j -= 1
    return out


def kept_lines(lines: list[int], kinds: list[int], partners: list[list[int]]) -> list[int]:
    """Indices of the lines of the main text: the article's, and the neutral ones that no partner shares. On a page with
    an article and without a partner nothing speaks for the neutral ones."""
    shared: set[int] = set()
    for p in partners:
        shared |= common_lines(lines, p)
    has_article = CONTENT in kinds
    judged = bool(partners) or not has_article
    return [i for i, k in enumerate(kinds) if k == CONTENT or (k == NEUTRAL and judged and i not in shared)]


def line_hashes(lines: list[str], kinds: list[int]) -> tuple[list[int], int]:
    """A hash of each line, and one of all lines and kinds in order."""
    from xxhash import xxh64_intdigest

    each = [xxh64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines]
    return each, xxh64_intdigest(np.array([*each, *kinds], "<i8").tobytes(), len(each)) - (1 << 63)


def _keys(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Pages with host and path of their URL (scheme, query, fragment and letter case of the host set aside)."""
    return pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        F.expr(f"lower(regexp_extract(coalesce(`{url_col}`, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))").alias("host"),
        F.expr(f"regexp_extract(coalesce(`{url_col}`, ''), '^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)', 1)").alias("path"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Null html is an empty page with an empty text. A null URL, or one without a host, has no neighbours, and a host's
    only page none either: their lines are settled by markup. Pages of a host with equal lines are one page in the
    order, that of the first path and id, and all get its text; ties in the path are ordered by id and content. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    keyed = _keys(pages, id_col, url_col, html_col)
    id_kind = keyed.schema["id"].dataType.simpleString()

    def hashes(batches):
        for b in batches:
            lines, kinds, keys = [], [], []
            for html in b.column(2).to_pylist():
                found, of = page_lines(html)
                each, key = line_hashes(found, of)
                lines.append(each)
                kinds.append(of)
                keys.append(key)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(3), b.column(4), pa.array(keys, pa.int64()), pa.array(lines, pa.list_(pa.int64())),
                 pa.array(kinds, pa.list_(pa.int32()))], names=["id", "host", "path", "hash", "lines", "kinds"])

    lines = materialise(
        keyed.mapInArrow(hashes, f"id {id_kind}, host string, path string, hash bigint, lines array<bigint>,"
                                 " kinds array<int>"), "page-lines")

    def numbered(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)),
                 pa.array(np.arange(n, n + b.num_rows))], names=[*b.schema.names, "part", "pos"])
            n += b.num_rows

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "id", "hash"]
    firsts = (lines.where("host <> ''").groupBy("host", "hash").agg(F.min(F.struct("path", "id")).alias("first"))
              .select("host", "first.path", "first.id", "hash"))
    ordered = materialise(
        firsts.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .mapInArrow(numbered, f"host string, path string, id {id_kind}, hash bigint, part int, pos bigint"), "page-order")
    # A row per range partition: their running sum is one small window, and that side is broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ordered.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    placed = ordered.join(F.broadcast(bases), "part").select(
        F.col("host").alias("of_host"), F.col("hash").alias("of_hash"), (F.col("base") + F.col("pos")).alias("at"))
    once = lines.select("host", "hash", "lines", "kinds").dropDuplicates(["host", "hash"])
    sent = (once.join(placed.hint("merge"), (F.col("host") == F.col("of_host")) & (F.col("hash") == F.col("of_hash")))
            .select(F.explode(F.expr("array(at - 1, at, at + 1)")).alias("to"), "at", "host", "hash", "lines", "kinds"))
    met = sent.select("to", F.expr("if(at = to, struct(hash, host, lines, kinds), null)").alias("own"),
                      F.expr("if(at <> to, struct(host, lines), null)").alias("other")).groupBy("to").agg(
        F.max("own").alias("own"), F.collect_list("other").alias("near")).where("own is not null")
    alone = once.where("host = ''").select(
        "host", "hash", "lines", "kinds", F.expr("cast(array() as array<array<bigint>>)").alias("near"))
    cases = met.select("own.host", "own.hash", "own.lines", "own.kinds",
                       F.expr("transform(filter(near, x -> x.host = own.host), x -> x.lines)").alias("near")).union(alone)

    def settle(batches):
        for b in batches:
            kept = [kept_lines(x, k, p) for x, k, p in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kept, pa.list_(pa.int32()))],
                                             names=["host", "hash", "kept"])

    verdicts = materialise(cases.mapInArrow(settle, "host string, hash bigint, kept array<int>"), "page-verdicts")
    verdicts = verdicts.select(F.col("host").alias("of_host"), F.col("hash").alias("of_hash"), "kept")

    def packed(batches):
        for b in batches:
            lines, keys = [], []
            for h in b.column(2).to_pylist():
                found, of = page_lines(h)
                keys.append(line_hashes(found, of)[1])
                lines.append(zlib.compress("\n".join(found).encode("utf-8", "surrogatepass"), 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(keys, pa.int64()),
                                              pa.array(lines, pa.binary())], names=["id", "url", "host", "hash", "packed"])

    def texts(batches):
        for b in batches:
            out = []
            for lines, kept in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                found = zlib.decompress(lines).decode("utf-8", "surrogatepass").split("\n")
                out.append(" ".join([found[i] for i in kept]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                names=["id", "url", "text", "n_chars"])

    # The plan is the same at every size: the pages' lines are dealt out once, packed, whether or not the verdicts are
    # few. A line holds no line break (its white space is single blanks), so line breaks part them.
    # The lines of a page with very many copies meet one verdict; adaptive execution splits such a key.
    bodies = keyed.mapInArrow(packed, f"id {id_kind}, url string, host string, hash bigint, packed binary")
    whole = bodies.join(verdicts.hint("merge"), (F.col("host") == F.col("of_host")) & (F.col("hash") == F.col("of_hash")))
    return (whole.select("id", "url", "packed", "kept")
            .mapInArrow(texts, f"id {id_kind}, url string, text string, n_chars bigint")
            .withColumnsRenamed({"id": id_col, "url": url_col}))
