"""Page extraction, hard negatives and conversation repair against brute force, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import types as T

from loanloom.llm import hard_negatives, html_extract, repair
from loanloom.llm.queries import QUERIES

from helpers import SF

# ---------------------------------------------------------------- pages

PAGES = T.StructType([T.StructField(n, t()) for n, t in [
    ("page_id", T.LongType), ("url", T.StringType), ("html", T.StringType), ("host", T.StringType), ("text", T.StringType),
    ("key", T.StringType), ("part", T.DoubleType)]])


class _Slow(HTMLParser):
    """Text of the blocks of article elements outside nav, aside, footer, form, div.ad and the like; a plain reading of the test pages."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.depth, self.skip, self.out, self.now = 0, 0, [], ""

    def _cut(self):
        if self.now.split():
            self.out.append(" ".join(self.now.split()))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "h2", "article", "nav", "div", "footer", "ul", "li", "body"):
            self._cut()
        if tag == "br":
            self.now += " "
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "article", "nav", "div", "footer", "ul", "li", "body"):
            self._cut()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            import html
            self.now += html.unescape(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def _slow(page: str) -> str:
    p = _Slow()
    p.feed(page)
    p.close()
    p._cut()
    return "\n\n".join(p.out)


def test_pages_of_the_query(spark):
    got = {r.page_id: r for r in QUERIES["op11_html_extract"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].url == r.url and got[r.page_id].n_chars == len(got[r.page_id].text)
        # entity references without a semicolon at the end of a page are read alike by both
        assert got[r.page_id].text == _slow(r.html or ""), r.page_id


RICH = """<!doctype html><html><head><title>T</title><meta charset=utf-8><style>p{}</style><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-banner">We use cookies</div>
<main><article class=post><header><h1>Big&nbsp;title</h1></header><p>First  <b>para</b>graph &amp; more&hellip;
<p>Second <a href="x>y">link</a><br>line<script>var a = "<p>no</p>";</script></p>
<aside>Related</aside><div class="ad-slot">Buy</div><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>
<form><input><label>mail</label></form><!-- <p>gone</p> --><blockquote>Quote &lt;b&gt;</blockquote>
<section id="comments"><article class=comment><p>Nice post</p></article></section><footer>By me</footer></article></main>
<div id=sidebar>Side</div><footer>&copy; all</footer></body></html>"""


def test_page_structure():
    main, _, marked = html_extract.split_page(RICH)
    assert main == ["Big title", "First paragraph & more…", "Second link line", "one", "two", "c1", "c2", "Quote <b>"]
    assert marked == []
    # an element that is never closed must not swallow the article; comments and scripts may run to the end
    assert html_extract.split_page("<nav><a>x</a><article><p>text</p></article>")[0] == ["text"]
    assert html_extract.split_page("<head><title>t</title><article>a<p>b<!-- c")[0] == ["a", "b"]
    assert html_extract.split_page("<article>a < b <p>c<scr")[0] == ["a < b", "c"]
    assert html_extract.split_page("<div class='main-content'>x<p class=share>y</p></div>z")[0] == ["x"]
    assert html_extract.split_page("plain &lt;text&gt; &#x41;&#66; &am")[1] == ["plain <text> AB &am"]


def test_pages_without_landmark(spark):
    """Runs that pages of a host share go, unique ones stay; blocks of any size give the same; copies keep their text."""
    rng = random.Random(5)

    def words(n):
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(n))

    shared, legal = words(12), words(30)
    bodies = [[words(rng.randrange(5, 40)) for _ in range(4)] for _ in range(30)]
    rows = []
    for i, body in enumerate(bodies):
        ps = "".join(f"<p>{b}</p>" for b in body)
        rows.append((i, f"http://a.example/{i}", f"<body><div>{shared}</div>{ps}<div>{legal}</div>"))
    twin = "".join(f"<p>{words(20)}</p>" for _ in range(3))
    rows += [(100, "http://b.example/1", twin), (101, "http://b.example/2", twin), (102, "http://c.example/", f"<p>{shared}</p>"),
             (103, None, None), (None, "not a url", "<p>alone</p>"), (104, "http://b.example/3", twin + "<p>more words</p>")]
    docs = spark.createDataFrame([(*r, "h", "t", "k", 0.5) for r in rows], PAGES).repartition(5)
    want = {i: "\n\n".join(b) for i, b in enumerate(bodies)}
    for block in (1 << 15, 40):
        got = {r.page_id: r.text for r in html_extract.extract(docs, block=block).collect()}
        assert {i: got[i] for i in want} == want
        assert got[100] == got[101] == "\n\n".join(re.findall("<p>(.*?)</p>", twin))
        assert got[102] == shared and got[103] == "" and got[None] == "alone"
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_runs(seed):
    rng = np.random.default_rng(seed)
    streams = [rng.integers(1, 4, rng.integers(0, 40)).astype(np.uint64) for _ in range(12)]
    h, least, most = html_extract.repeated_runs(streams, np.arange(12))
    slow = {}
    for i, s in enumerate(streams):
        for p in range(len(s) - 7):
            slow.setdefault(tuple(s[p:p + 8]), set()).add(i)
    assert sorted(zip(least.tolist(), most.tolist(), strict=True)) == sorted((min(v), max(v)) for v in slow.values())
    assert len(set(h.tolist())) == len(slow)
    hot = np.sort(h[least < most])
    for i, s in enumerate(streams):
        want = np.zeros(len(s), bool)
        for p in range(len(s) - 7):
            if len(slow[tuple(s[p:p + 8])]) > 1:
                want[p:p + 8] = True
        assert (html_extract.covered(s, hot) == want).all(), i


# ---------------------------------------------------------------- hard negatives

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("block", T.StringType()), T.StructField("v", T.StringType()), T.StructField("key", T.StringType())])


def _mined(rows):
    use = []
    for i, x, label, *_ in rows:
        if i is None or x is None or label is None or not x or any(e is None or not np.isfinite(e) for e in x):
            continue
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * np.float64(np.float32(e)))) for e in x]))
    out = []
    for i, label, a in use:
        if i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, c, strict=True)), j, lab) for j, lab, c in use if j != i and len(c) == len(a))
        for pos, j, _ in [s for s in scored if s[2] == label][:5]:
            found = [s for s in scored if s[2] != label and 80 * -pos <= 100 * -s[0] <= 100 * -pos][:5]
            out += [(i, j, r + 1, n[1], -pos, -n[0]) for r, n in enumerate(found)]
    return sorted(out)


def _vectors(seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.2, (4, 12))
    rows = [(int(i), [float(e) for e in np.float32(centre[rng.integers(4)] + rng.normal(0, 0.1, 12))], int(rng.integers(3)))
            for i in range(450)]
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 1), (501, rows[0][1], 1), (600, rows[3][1], None), (None, rows[3][1], 1), (700, None, 1),
             (800, [float("nan")] * 12, 1), (900, [], 1), (1000, [None] * 12, 2), (1100, [0.0] * 12, 2), (1200, [1.0, -1.0], 1), (1201, [1.0, -1.0], 1),
             (1202, [1.0, -0.9], 2), (1300, [5000.0] * 12, 2), (1301, [-4000.25] * 12, 2), (1302, [4500.0] * 12, 1)]
    return rows


def test_hard_negatives(spark, monkeypatch):
    rows = _vectors()
    docs = spark.createDataFrame([(*r, "b", "v", "k") for r in rows], VECTORS).repartition(4)
    want = _mined(rows)
    assert len(want) > 60
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(docs).collect()) == want
    # small blocks and tiles, and one label with nearly all rows
    for name, value in (("CANDIDATES", (16, 64)), ("ANCHORS", 2), ("TABLES", 1), ("ROWS", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(docs).collect()) == want
    one = [(i, x, 1 if i is None or i % 9 else 2) for i, x, _ in rows]
    docs = spark.createDataFrame([(*r, "b", "v", "k") for r in one], VECTORS)
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives(docs).collect()) == _mined(one)
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0


def test_four_russians():
    rng = np.random.default_rng(3)
    for dims, top in ((1, 3), (8, 200), (13, 1), (64, 5000), (20, (1 << 31) - 1)):
        a, c = rng.integers(-top - 1, top + 1, (5, dims)), rng.integers(-top - 1, top + 1, (9, dims))
        planes = hard_negatives.bit_planes(c)
        assert (hard_negatives.scores(hard_negatives.subset_sums(hard_negatives._narrow(a, len(planes))), planes) == c @ a.T).all()


# ---------------------------------------------------------------- conversations

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("fate", T.StringType()), T.StructField("n", T.StringType()),
    T.StructField("mark", T.StringType())])
SPACE = " \t\n\v\f\r"


def _damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def _fixed(rows):
    """Plain search: the least (cost, audit, repaired lines) of a list of (role, text, must_go, cut)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "", ())}

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for s, (c, au, lines) in list(out.items()):
                for x, name in (("u", "user:"), ("a", "assistant:")):
                    t = step.get((s, x))
                    if t is not None and (t not in out or (c + 5, au + "I", lines + (name,)) < out[t]):
                        out[t] = (c + 5, au + "I", lines + (name,))
        return out

    for role, text, must_go, cut in rows:
        new = {}
        for s, (c, au, lines) in inserted(best).items():
            options = [(s, c + 2, au + "D", lines)]
            if not must_go:
                extra = 5 if cut else 0
                if (s, role[:1]) in step:
                    options.append((step[s, role[:1]], c + extra, au + "K", (*lines, f"{role}:{text}")))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (s, x) in step:
                        options.append((step[s, x], c + 1 + extra, au + "R", (*lines, f"{name}:{text}")))
            for t, *value in options:
                if t not in new or tuple(value) < new[t]:
                    new[t] = tuple(value)
        best = new
    return min(v for s, v in inserted(best).items() if s in (0, 3))


def _conversations(rows):
    out = {r[0]: [] for r in rows}
    for r in _damage(rows):
        out[r[0]].append(r[1:])
    result = {}
    for conv, turns in out.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, shaped = set(), []
        counts = [0, 0, 0]
        for _, role, text in turns:
            blank, again = not text.strip(SPACE), (role, text) in seen
            seen.add((role, text))
            cut = not blank and text.rstrip(SPACE)[-1] not in ".!?"
            fault = 0 if blank else 1 if again else 2 if cut else None
            if fault is not None:
                counts[fault] += 1
            shaped.append((role, text, blank or again, fault == 2))
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(shaped))
        cost, audit, lines = _fixed(shaped)
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def _got(df):
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_repair_of_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _got(QUERIES["op13_repair"](spark, SF)) == _conversations(rows)


def test_repair_of_odd_rows(spark):
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut", "", " ", None, "a\tb ?\n", "Long " * 300 + ".", "ünï. 😀", "x" * 3]
    roles = ["user", "assistant", "system", None, "", "usher", "tool", "USER"]
    rows = []
    for conv in [*range(150), None]:
        n = rng.choice([1, 1, 2, 3, 4, 6, 9, 15])
        for i in range(n):
            turn = None if rng.random() < 0.05 else i * rng.choice([1, 1, 1, 3]) if rng.random() < 0.9 else 2
            role = ("user", "assistant")[i % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"turn {i} of {conv}." if rng.random() < 0.6 else rng.choice(texts)
            rows.append((conv, turn, role, text))
    # one long conversation, of which no ending settles soon, and one of deletions only
    rows += [(1000, i, rng.choice(["user", "assistant"]), f"t{i}" + rng.choice([".", ""])) for i in range(1200)]
    rows += [(1001, i, "user", None) for i in range(300)]
    docs = spark.createDataFrame([(*r, "f", "n", "m") for r in rows], TURNS).repartition(6)
    assert _got(repair.repair(repair.damaged(docs))) == _conversations(rows)
    none = repair.repair(repair.damaged(spark.createDataFrame([], TURNS)))
    assert none.count() == 0


def test_repair_of_all_short_conversations():
    """Every sequence of up to five rows, and random long ones, against the plain search."""
    kinds = [("user", False, False), ("assistant", False, False), ("system", False, False), ("tool", False, True), ("assistant", True, False),
             ("user", False, True)]
    cases = [c for n in range(5) for c in itertools.product(kinds, repeat=n)]
    rng = random.Random(2)
    cases += [[rng.choice(kinds) for _ in range(rng.randrange(60, 200))] for _ in range(25)]
    cases += [[("user", False, False)] * 150, [("assistant", False, False)] * 150, [("system", False, False)] * 150, [kinds[4]] * 150]
    for case in cases:
        rows = [(role, f"{i}", gone, cut) for i, (role, gone, cut) in enumerate(case)]
        path = repair._Path()
        for row in rows:
            path.step(*row)
        cost, audit, lines = _fixed(rows)
        assert path.finish() == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), case


def test_window_stays_small():
    path = repair._Path()
    for i in range(5000):
        path.step(("user", "assistant", "user")[i % 3], f"{i}.", i % 7 == 0, i % 5 == 0)
        assert len(path.rows) <= 4 * repair.LOOK
