"""Rules by longest match, blocks handed along links, allow first."""

from __future__ import annotations

from poseval.llm.queries import URL_RULES
from poseval.llm.url_filter import RULES, judge_pages
from pyspark.sql import functions as F

KIND = "page_id long, url string, html string"


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path


def own(url, rules):
    host, path = place(url)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(pages, links, rules):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = []
    for i, url, _ in pages:
        node = None if url is None else url.split("#")[0]
        seen, todo = {node}, [node]
        while todo:
            for n in near.get(todo.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        rule, verdict = own(url, rules)
        if verdict is None:
            verdict = "block" if any(own(n, rules)[1] == "block" for n in seen) else "allow"
        out.append((i, *place(url), rule, verdict))
    return sorted(out, key=str)


def canonical(href):
    return f"<html><head><LINK href='{href}' rel=\"canonical\"></head>"


def test_verdicts(spark):
    pages = [
        (1, "http://a.example.org/es/1", ""),
        (2, "http://x.test/one", canonical("http://a.example.org/es/1")),
        (3, "http://y.test/two?q=1#f", '<meta http-equiv="Refresh" content="0; URL=http://x.test/one">'),
        (4, "http://y.test/three", canonical("/two?q=1")),
        (5, "http://z.org/ok", canonical("http://x.test/one")),
        (6, "http://clean.test/", canonical("//clean.test/other#top")),
        (7, "HTTP://WWW.Example.ORG/en/12?x", None),
        (8, "http://example.org", "<meta name=refresh content='url=http://x.test/one'>"),
        (9, None, canonical("http://x.test/one")),
        (10, "no scheme /es/", ""),
        (11, "http://notexample.org/es/", ""),
        (12, "http://b.com/de/x", ""),
        (13, "http://b.com/fr/x", ""),
        (14, "http://deep.test/a/b.html", canonical("c.html?x&amp;y")),
        (15, "http://deep.test/a/c.html?x&y", "<link rel=stylesheet href=http://x.test/one>"),
        (2, "http://x.test/one", canonical("http://a.example.org/es/1")),
        (None, "http://y.test/three", ""),
        (16, "x" * 50_000 + "://" + "a." * 200 + "com/de/" + "y" * 50_000, ""),
        (17, "http://a.example.org/es/1#frag", ""),
        (18, "http://end.test/", ""),
    ]
    links = [
        ("http://x.test/one", "http://a.example.org/es/1"),
        ("http://y.test/two?q=1", "http://x.test/one"),
        ("http://y.test/three", "http://y.test/two?q=1"),
        ("http://z.org/ok", "http://x.test/one"),
        ("http://clean.test/", "http://clean.test/other"),
        ("http://deep.test/a/b.html", "http://deep.test/a/c.html?x&y"),
        ("http://end.test/", "http://deep.test/a/c.html?x&y"),
        ("http://deep.test/a/c.html?x&y", "http://b.com/de/x"),
    ]
    more = spark.createDataFrame([*links[6:], (None, "http://x.test/one")], "source string, target string")
    table = spark.createDataFrame(pages, KIND).repartition(3).withColumn("host", F.lit("clash")).withColumn("verdict", F.lit(1))
    got = judge_pages(table, spark.createDataFrame(URL_RULES, RULES), more)
    assert sorted(map(tuple, got.collect()), key=str) == brute(pages, links, URL_RULES)


def test_empty_tables(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    assert judge_pages(spark.createDataFrame([], KIND), rules).collect() == []
    (row,) = judge_pages(spark.createDataFrame([(1, "http://a.org/x", None)], KIND), rules.where("false")).collect()
    assert tuple(row) == (1, "a.org", "/x", None, "allow")
