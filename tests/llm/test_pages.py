"""URL rules and main text of pages."""
import collections
import html
import random
import re

import pytest

from keelson.llm import html_template, url_rules
from keelson.llm import queries as Q

from .conftest import CLASHING, SF


def brute_rule(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host, path = raw.encode().lower().decode(), re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, key=lambda r: (-len(r[0]), r[1] != "block", r[0]), default=(None, "allow"))
    return host, path, *best


URLS = [None, "", "no scheme", "://", "http://", "http://NET", "http://a.NET/", "https://x.example.net/en/1?q#f", "http://example.net/en", "http://xexample.net/en/", "http://example.org/fr/",
        "http://example.org/fr", "ftp://example.com/de/x", "http://example.com:80/de/", "http://.net/", "http://a..net/en/", "http://net?x", "x://y://net/", "http://exa_mple.net/en/é", "http://net/"]


def test_rules_edge_cases(spark):
    pages = spark.createDataFrame([(i, u, *["x"] * len(CLASHING)) for i, u in enumerate(URLS + URLS[-3:])], "page_id long, url string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    got = url_rules.apply_rules(pages, rules)
    assert {"row", "key", "size"} <= set(got.columns)
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(r["url"], url_rules.RULES), r["url"]
    assert got.count() == pages.count()
    assert url_rules.apply_rules(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.apply_rules(pages, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("seed", [0, 1])
def test_nested_rules(spark, seed):
    """Rules nested in host and path, ties, void rules; many buckets."""
    rnd = random.Random(seed)
    host = lambda: ".".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4)))
    path = lambda: "".join(rnd.choice(["/", "x", "y"]) for _ in range(rnd.randint(0, 4)))
    rules = list({(h, "/" + p): v for h, p, v in ((host(), path(), rnd.choice(["block", "allow"])) for _ in range(60))}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{host()}/{path()}" for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("a", None, "block"), ("", "/", "block")], "host string, path string, verdict string")
    for r in url_rules.apply_rules(pages, table).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_rule(r["url"], rules), r["url"]


def naive(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


def test_extraction_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.QUERIES["op1_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    assert all(r["text"] == naive(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)


PARSED = [
    ("<html><body><p>a <b>b</b>c</p><div>d<br>e</div></body></html>", "a bc d e"),
    ("plain &lt;text&gt; &amp;amp; &#233;&nbsp;x", "plain <text> &amp; é x"),
    ("a < b and c > d", "a < b and c > d"),
    ("<p>one<p>two<li>three", "one two three"),
    ("<script>var a='<p>x</p>'</script><style>p{}</style>ok<script>unclosed", "ok"),
    ("<!-- <p>no</p> -->yes<!-- open", "yes"),
    ("<div class='comments'><p>no</p></div><p>yes</p>", "yes"),
    ("<nav><ul><li>no</ul></nav><main><h1>T</h1><p>yes</p><aside>no</aside></main><footer>no</footer>", "T yes"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>text</p><form><label>no</label></form></article>", "Title text"),
    ("<article><p>yes</p></article><section><article class='comment'>no</article></section>", "yes"),
    ("<div class='content'><div id='content-sidebar'>no</div><p>yes</p></div>", "yes"),
    ("<div class='page-header article'>yes</div>", "yes"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("<p title='a > b'>yes</p><p title='open>also", "yes also"),
    ("<a href=x>in</a>line<span> w</span>ord", "inline word"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("", ""), ("<", "<"), ("<p>", ""), ("</p></div>x", "x"), ("<b>" * 3000 + "deep", "deep"), ("<div>" * 400 + "deep", "deep"),
    ("<div role=navigation>no</div>yes<div class=ad>no</div>", "yes"),
]


@pytest.mark.parametrize(("source", "text"), PARSED)
def test_parser(source, text):
    assert html_template.main_text(source, frozenset(), None) == text


def test_template_of_a_host(spark):
    """Unnamed boilerplate goes because all pages of the host share it; a
    passage that half of them share stays."""
    rnd = random.Random(1)
    rows, want = [], {}
    for i in range(30):
        own = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40))
        shared = "a passage that half of the pages share" if i % 2 else "another one"
        rows.append((i, "http://Same.example/x", f"<body><div class='q1'>Home | News | About us</div><div class='q2'><p>{own}</p><p>{shared}</p></div><div class='q3'>All rights</div></body>"))
        want[i] = f"{own} {shared}"
    rows += [(100, "http://other.example/", "<body><div class='q1'>Home | News | About us</div><p>x</p></body>"), (101, None, None), (102, "", ""), (103, "no host", "<p>t</p>"), (0, *rows[0][1:])]
    want |= {100: "Home | News | About us x", 101: "", 102: "", 103: "t"}
    pages = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    got = html_template.extract(pages)
    assert {"row", "host", "path"} <= set(got.columns)
    assert collections.Counter((r["page_id"], r["text"], r["n_chars"]) for r in got.collect()) == collections.Counter((r[0], want[r[0]], len(want[r[0]])) for r in rows)
    assert html_template.extract(pages.limit(0)).count() == 0
