"""Pages without an article element, and hosts of copies."""
import time

import pytest

from keelson.llm import html_template


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_nothing_but_the_template_is_dropped(spark):
    """Headings, lists, quotes and cells stay where paragraphs hold most of the text."""
    body = "<div class='q2'><h1>Title {0}</h1><p>{1}</p><ul><li>item {0}</li></ul><blockquote>quote {0}</blockquote><p>{1}</p><table><tr><td>cell {0}</td></tr></table></div>"
    want = "Title {0} {1} item {0} quote {0} {1} cell {0}"
    own = {i: " ".join(f"w{i}x{k}" for k in range(60)) for i in range(12)}
    rows = [(i, "http://many.example/", f"<body><div class='q1'>Home | News</div>{body.format(i, own[i])}</body>") for i in range(11)]
    rows.append((11, "http://one.example/", f"<body>{body.format(11, own[11])}</body>"))
    assert texts(spark, rows) == {i: want.format(i, own[i]) for i in own}


def test_hosts_of_copies_keep_their_articles(spark):
    """Copies, alike to the byte or but for their links or a line of their own."""
    article = "<article><h1>Title</h1><p>First paragraph of it.</p><p>Second paragraph of it.</p>{}</article>"
    line = "<article><h1>Title</h1><p>The one paragraph of it.</p><h2>printed at {}</h2></article>"
    plain = "<section><h1>Title</h1><p>First paragraph of it.</p></section>"
    rows = [(i, "http://same.example/", f"<body><div>Home</div>{article.format('')}</body>") for i in range(20)]
    rows += [(100 + i, "http://links.example/", f"<body><div><a href='?v={i}'>Home</a></div>{plain}</body>") for i in range(20)]
    rows += [(200 + i, "http://line.example/", f"<body><div>Home</div>{line.format(i)}</body>") for i in range(20)]
    text = "Title First paragraph of it. Second paragraph of it."
    want = dict.fromkeys(range(20), text) | dict.fromkeys(range(100, 120), "Home Title First paragraph of it.")
    assert texts(spark, rows) == want | {200 + i: f"Title The one paragraph of it. printed at {i}" for i in range(20)}


@pytest.mark.parametrize("hostile", [
    lambda k: "<b>" * k + "</i>" * k, lambda k: "<i><p>" + "<b>" * k + "</i>" * k, lambda k: "<div>" * k + "<li></li>" * k,
    lambda k: "<b>" * k + "<hr>" * k, lambda k: "<div>" * k + "</p>" * k])
def test_hostile_markup_takes_linear_time(hostile):
    """Tags that close nothing, deep in open ones: 200 KB and more in seconds
    (a walk of the stack for each would take minutes)."""
    start = time.process_time()
    html_template.parse(hostile(30_000) + "text")
    assert time.process_time() - start < 5


def test_end_tags_close_what_they_closed():
    """An inline end does not reach beyond its block; blocks close what they hold."""
    blocks = lambda h: [b.text for b in html_template.parse(h)[0]]
    assert blocks("<div><i>a<p>b</i>c</p>d</div>e") == ["a", "bc", "d", "e"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert blocks("<p>a<b>b<p>c</b>d") == ["ab", "cd"]

