"""Page differencing and quotation linking on made-up pages and threads."""
import random

from barframe.llm import html_diff as H
from barframe.llm import quotes as K


def slow_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines_are_longest():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(30))]
        b = [rng.randrange(6) for _ in range(rng.randrange(30))]
        got = sorted(H.common_lines(a, b))
        assert len(got) == slow_common(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in got))
    assert H.common_lines([], [1]) == set() and len(H.common_lines([5] * 5000, [5] * 4000)) == 4000


ARTICLE = ("<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t='</p>';</script></head><body>"
           "<nav><ul><li><a href='/x'>Menu {n}</a></li></ul></nav><!-- <p>ad</p> --><div class=\"ad\">Buy {n}</div>"
           "<aside>Side {n}</aside><div id='cookie-notice'>We use cookies</div><form><p>Name</p></form>"
           "<article><header><h1>Head &amp; tail {n}</h1></header><p><b>Bold</b>ly  one\n two<br><p>R&eacute;sum&#233; &lt;p&gt;{n}"
           "<div class='share-links'>Share</div><p>Last {n}</article><section class=comments><p>First!</p></section>"
           "<footer>&copy; {n}</footer></body></html>")


def test_article_pages():
    lines, kinds = H.page_lines(ARTICLE.replace("{n}", "7"))
    kept = H.kept_lines(list(range(len(lines))), kinds, [])
    assert " ".join(lines[i] for i in kept) == "Head & tail 7 Boldly one two Résumé <p>7 Last 7"
    assert H.page_lines(None) == ([], []) and H.page_lines("plain &lt; text")[0] == ["plain < text"]
    assert H.page_lines("<p>cut off <b")[0] == ["cut off"] and H.page_lines("<script>never closed <p>x")[0] == []
    assert H.page_lines('<p title="a > b">x</p>y')[0] == ["x", "y"]
    text = "word " * 200_000
    assert H.page_lines(f"<article><p>{text}</article>")[0] == [text.strip()]


def test_wrappers_named_after_furniture():
    def kept(html):
        lines, kinds = H.page_lines(html)
        return [lines[i] for i in H.kept_lines(list(range(len(lines))), kinds, [])]

    assert kept('<body class="has-sidebar"><div id="page-with-sidebar"><form><article class="post comments-open"><p>Text'
                '</article></form></div><div class="sidebar">Side</div>') == ["Text"]
    assert kept('<article>Story</article><div class="comments"><article>One</article></div><article class="comment">Two'
                '</article><nav><main>Three</main></nav>') == ["Story"]
    assert kept('<body class="ad-free"><div>No article here</div><div class="cookie">Cookies</div>') == ["No article here"]


def test_words_of_furniture_inside_an_article():
    def kept(html):
        lines, kinds = H.page_lines(html)
        return " ".join(lines[i] for i in H.kept_lines(list(range(len(lines))), kinds, []))

    assert kept('<article><h2 id="related-work">Related work</h2><section id="notice-period"><p>Three months</p></section>'
                '<p>See <span class="share">my share</span>, <em class="alert">now</em>: <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p>'
                '<div class="ad">Buy</div><ul class="share-links"><li>Share</li></ul></article>'
                ) == "Related work Three months See my share, now: x=1."


def slow_main(pages):
    """Neighbours and verdicts page by page: the nearest pages of the host in URL order with other lines."""
    import re

    out, hosts = {}, {}
    for i, url, html in pages:
        m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        hosts.setdefault(host, []).append((path, i, H.page_lines(html)))
    for host, of in hosts.items():
        of.sort(key=lambda x: x[:2])
        order = []
        for _, _, found in of:
            if found not in order:
                order.append(found)
        for _, i, (lines, kinds) in of:
            at = order.index((lines, kinds))
            near = [order[k][0] for k in (at - 1, at + 1) if host and 0 <= k < len(order)]
            shared = set()
            for p in near:
                want = slow_common(lines, p)
                found = H.common_lines([hash(x) for x in lines], [hash(x) for x in p])
                assert len(found) == want
                shared |= found
            article = H.CONTENT in kinds
            out[i] = " ".join(x for k, x in enumerate(lines) if kinds[k] == H.CONTENT or (
                kinds[k] == H.NEUTRAL and (near or not article) and k not in shared))
    return out


def test_neighbours_and_verdicts_equal_a_page_by_page_run(spark):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        body = "".join(f"<div>{rng.choice(['Top', 'Home', 'Legal', f'own {rng.randrange(60)}', f'words {i}'])}</div>"
                       for _ in range(rng.randrange(6)))
        teaser = f"<article><p>Teaser {rng.randrange(40)}</p></article>" if rng.random() < .4 else ""
        html = rng.choice([rows[-1][2] if rows else None, f"<body><nav>Menu</nav>{teaser}{body}</body>", f"<body>{body}</body>"])
        url = rng.choice([f"http://{rng.choice('ab')}.example/{rng.randrange(50):02d}", f"https://B.example/x/{i}?q", None])
        rows.append((i, url, html))
    got = {r["page_id"]: r["text"] for r in H.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == slow_main(rows)


def test_copies_do_not_delete_each_other_and_a_story_beside_a_teaser_stays(spark):
    rows = [(1, "http://h.example/a", "<div>Top</div><div>One story</div>"), (2, "http://h.example/b", "<div>Top</div><div>One story</div>"),
            (3, "http://h.example/c", "<div>Top</div><article>Teaser</article><div>Long story</div>")]
    got = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "One story", 2: "One story", 3: "Teaser Long story"}


def test_pages_without_an_article_are_differenced(spark):
    page = "<body><div>Top story list</div><div>Own words of {n}</div><div>More of {n}</div><div>All rights {h}</div></body>"
    rows = [(i, f"http://{h}.example/a/{i:03d}?x=1#y", page.replace("{n}", f"{h}{i}").replace("{h}", h))
            for h in ("one", "two") for i in range(40)]
    rows += [(100, "http://alone.example/", page.replace("{n}", "alone").replace("{h}", "x")), (101, None, page), (102, "no host", None),
             (103, "http://one.example/zz", None), (104, "http://copy.example/a", ARTICLE), (105, "http://copy.example/b", ARTICLE),
             (105, "http://copy.example/b", ARTICLE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'c' as host", "'c' as path", "'c' as kept", "'c' as text", "'c' as part", "'c' as id")
    out = {}
    for r in H.main_text(df).collect():
        out.setdefault(r["page_id"], []).append(r)
        assert r["n_chars"] == len(r["text"])
    assert sum(map(len, out.values())) == len(rows)
    for h in ("one", "two"):
        for r in (x for v in out.values() for x in v if x["url"] and f"{h}.ex" in x["url"] and x["page_id"] < 100):
            assert r["text"] == f"Own words of {h}{r['page_id']} More of {h}{r['page_id']}"
    assert out[100][0]["text"].startswith("Top story list Own words of alone")
    assert out[101][0]["text"].startswith("Top story") and out[102][0]["text"] == "" and out[103][0]["text"] == ""
    assert len(out[105]) == 2 and {r["text"] for i in (104, 105) for r in out[i]} == {
        "Head & tail {n} Boldly one two Résumé <p>{n} Last {n}"}
    assert H.main_text(df.where("false")).count() == 0


SCHEMA = "conv_id long, turn long, role string, text string"


def by_turn(spark, rows):
    out = K.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    return {(r["conv_id"], r["turn"]): r for r in out}


def test_thread_is_rebuilt(spark):
    rows = [(1, 0, "user", "How do I sort?\nAnd how do I group?"),
            (1, 1, "assistant", "> How do I sort?\nUse orderBy."),
            (1, 2, "assistant", "> And how do I GROUP?  \nUse groupBy."),
            (1, 3, "user", ">> How do I sort?\n> Use orderBy.\nThanks for that."),
            (1, 4, "user", "> Use groupBy.\nGreat."),
            (1, 5, "assistant", "> unknown words\nSure."),
            (1, 6, "user", ">> Use groupBy.\n> Great.\n\nBye."),
            (2, 0, "user", "> Use groupBy.\nquotes another conversation")]
    out = by_turn(spark, rows)
    assert {k[1]: out[k]["parent_turn"] for k in out if k[0] == 1} == {0: None, 1: 0, 2: 0, 3: 1, 4: 2, 5: 4, 6: 4}
    assert out[1, 3]["reply"] == "Thanks for that." and out[1, 6]["reply"] == "Bye." and out[2, 0]["parent_turn"] is None
    assert (out[1, 3]["quoted_lines"], out[1, 3]["linked_lines"], out[1, 5]["linked_lines"]) == (2, 2, 0)
    assert out[1, 1]["chat"] == "<|assistant|>\nUse orderBy.\n<|end|>\n"
    order = [k[1] for k in sorted((k for k in out if k[0] == 1), key=lambda k: out[k]["reply_path"])]
    place = {t: i for i, t in enumerate(order)}
    assert all(place[out[1, t]["parent_turn"]] < place[t] for t in place if out[1, t]["parent_turn"] is not None)
    assert order.index(3) < order.index(2) or order.index(3) == order.index(1) + 1


def test_odd_messages(spark, monkeypatch):
    monkeypatch.setattr(K, "RANGE_TURNS", 4)
    rows = [(1, i, "user", f"line {i}") for i in range(23)] + [(1, 23, "user", "> line 2\nyes"), (1, 24, "user", "next"),
            (1, 3, "user", "line 3"), (1, 3, "user", "line 3"), (1, None, "user", "no turn"), (None, 0, None, "> > deep\n>\n"),
            (5, 0, "user", None), (5, 1, "user", ""), (5, 2, "user", "> \n>\n"), (5, 3, "user", "x " * 100_000 + "\n> x"),
            (6, 0, "user", "same"), (6, 1, "user", "same"), (6, 2, "user", "> same\nreply")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as msg", "1 as chain", "1 as v", "1 as level")
    out = K.link_quotations(df).collect()
    assert len(out) == len(rows)
    got = {(r["conv_id"], r["turn"]): r for r in out}
    assert all(got[1, i]["parent_turn"] == i - 1 for i in range(1, 23))
    assert got[1, 23]["parent_turn"] == 2 and got[1, 24]["parent_turn"] == 23 and got[1, 24]["chain"] == 23
    assert got[5, 0]["reply"] == "" and got[5, 2]["quoted_lines"] == 0 and got[6, 2]["parent_turn"] == 1
    assert got[None, 0]["reply"] == "" and got[None, 0]["quoted_lines"] == 1
    assert K.link_quotations(df.where("false")).count() == 0


def test_nested_branches_keep_their_order(spark):
    rows = [(1, 0, "u", "q0")] + [(1, t, "u", f"> q{p}\nq{t}") for t, p in
                                 [(1, 0), (2, 0), (3, 1), (4, 0), (5, 3), (6, 2), (7, 3), (8, 7), (9, 1)]]
    out = {k[1]: r for k, r in by_turn(spark, rows).items()}
    parents = {t: p for t, p in [(1, 0), (2, 0), (3, 1), (4, 0), (5, 3), (6, 2), (7, 3), (8, 7), (9, 1)]}
    assert {t: out[t]["parent_turn"] for t in parents} == parents
    order = sorted(out, key=lambda t: out[t]["reply_path"])
    place = {t: i for i, t in enumerate(order)}
    below = {t: {t} for t in out}
    for t in sorted(parents, reverse=True):
        below[parents[t]] |= below[t]
    for t, s in below.items():  # every subtree is one run that starts with its root
        assert sorted(place[x] for x in s) == list(range(place[t], place[t] + len(s)))


def test_passages_refolded_partial_and_said_again(spark):
    said = "The quick brown fox jumps over the lazy dog while the old cat sleeps in the warm sun all day"
    w = said.split()
    rows = [(1, 0, "u", f"Hello.\n{said}\nBye."), (1, 1, "a", "something else entirely is said in this one"),
            (1, 2, "u", "> " + " ".join(w[:7]) + "\n> " + " ".join(w[7:]) + "\nrefolded"),
            (1, 3, "u", "> " + " ".join(w[3:11]).upper() + "\npartial"),
            (1, 4, "a", f"{said}"), (1, 5, "u", "> " + " ".join(w[:9]) + "\n>  " + " ".join(w[9:]) + "\nlatest wins"),
            (2, 0, "u", "Thanks."), (2, 1, "a", "x"), (2, 2, "u", "Thanks."), (2, 3, "a", "y"), (2, 4, "u", "> Thanks.\nz"),
            (2, 5, "a", ">> Thanks.\n> z\n>\n> nobody said it\nlast")]
    out = by_turn(spark, rows)
    assert [out[1, t]["parent_turn"] for t in (2, 3, 5)] == [0, 0, 4]
    assert [(out[1, t]["quoted_lines"], out[1, t]["linked_lines"]) for t in (2, 3, 5)] == [(2, 2), (1, 1), (2, 2)]
    assert out[2, 4]["parent_turn"] == 2 and out[2, 5]["parent_turn"] == 4
    assert (out[2, 5]["quoted_lines"], out[2, 5]["linked_lines"]) == (3, 2)


def parents_by_hand(rows):
    """Parent turn and linked lines of each (conv, turn), message by message."""
    import itertools
    import re

    def passages(text):
        out = []
        for i, line in enumerate(re.split("\\r?\\n", text)):
            signs = re.match(r"[ \t]*(?:>[ \t]*)*", line).group()
            body = " ".join(line[len(signs):].lower().split())
            out.append((signs.count(">"), body))
        runs = [(k, list(g)) for k, g in itertools.groupby(out, key=lambda x: (x[0], x[1] != ""))]
        return [(level, [b for _, b in g]) for (level, full), g in runs if full]

    def keys(lines):
        words = " ".join(lines).split(" ")
        return [(" ".join(words), max(1, len(words) - 4))] + [
            (tuple(words[i:i + 5]), 1) for i in range(len(words) - 4)]

    want, by_conv = {}, {}
    for conv, turn, _, text in rows:
        by_conv.setdefault(conv, []).append((turn, passages(text)))
    for conv, messages in by_conv.items():
        own, before = {}, None
        for turn, parts in sorted(messages):
            votes, linked = {}, 0
            for level, lines in parts:
                if level:
                    hits = {}
                    for key, weight in keys(lines):
                        if key in own:
                            hits[own[key]] = hits.get(own[key], 0) + weight
                    if hits:
                        n, source = max((n, t) for t, n in hits.items())
                        votes[level, source] = votes.get((level, source), 0) + n
                        linked += len(lines)
            best = min(((level, -n, -t) for (level, t), n in votes.items()), default=None)
            want[conv, turn] = (-best[2] if best else before, linked)
            for level, lines in parts:
                if not level:
                    own.update({k: turn for k, _ in keys(lines)} | {x: turn for x in lines})
            before = turn
    return want


def test_random_threads_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(K, "RANGE_TURNS", 8)
    rng = random.Random(12)
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(rng.randrange(1, 40)):
            parts = []
            for _ in range(rng.randrange(0, 3)):
                if texts:
                    words = rng.choice(texts[-8:]).replace(">", " ").split()
                    a = rng.randrange(len(words) + 1)
                    part = words[a:a + rng.randrange(1, 15)] or ["none"]
                    cut, depth = rng.randrange(1, 9), "> " * rng.randrange(1, 4)
                    parts += [depth + " ".join(part[i:i + cut]) for i in range(0, len(part), cut)] + [""] * rng.randrange(2)
            parts += [" ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 4))]
            texts.append("\n".join(parts))
            rows.append((conv, turn, "user", texts[-1]))
    want = parents_by_hand(rows)
    got = {k: (r["parent_turn"], r["linked_lines"]) for k, r in by_turn(spark, rows).items()}
    assert got == want and sum(n > 0 for _, n in got.values()) > 50
