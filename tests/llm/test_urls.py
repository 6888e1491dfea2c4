"""URL verdicts against plain code, and block decisions along chains of aliases."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from shelfmark.llm import urls
from shelfmark.llm.queries import QUERIES


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def slow_rule(host, path, rules=urls.RULES):
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://Sub.Example.ORG/es/x?y#z", "http://org", "http://org/", "http://example.org?x", "http://aorg/en/1",
    "http://a.example.org/en/12", "http://x.com/fr/a", "http://com/de/", "http://xcom/de/", "http://É.Com/fr/\nb", "a://b://c.org/es/", "http://example.org/es",
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "k") for i, u in enumerate(ODD)], "page_id long, url string, html string, host string")
    for r in urls.judge(pages).collect():
        host, path = slow_parts(ODD[r.page_id])
        verdict, rule = slow_rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), ODD[r.page_id]


def page(link, kind):
    if kind == "canonical":
        return f"<HEAD><link href='{link}' rel=canonical>"
    return f'<meta content="0; URL={link}" http-equiv="Refresh">'


@pytest.mark.parametrize("n", [3, 24])
def test_chain_of_aliases(spark, n):
    """The block at one end reaches all but pages with a rule; an allow in the component comes first."""
    rules = [("block", "bad.net", "/x"), ("allow", "good.net", "/"), ("allow", "own.net", "/")]
    chain = [f"http://p{i}.net/{i}" for i in range(n)]
    rows = [(i, chain[i], page(chain[i + 1], "canonical" if i % 2 else "refresh")) for i in range(n - 1)]
    rows += [(n, chain[-1] + "#top", page("//bad.net/x?a&amp;b", "canonical")), (n + 1, "http://own.net/", page(chain[0], "refresh"))]
    rows += [(n + 2, "HTTP://bad.net/y", None), (n + 2, "HTTP://bad.net/y", None), (None, None, page(chain[0], "canonical"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r.page_id: r.verdict for r in urls.judge(pages, rules[:2]).collect()}
    assert {found[i] for i in range(n - 1)} | {found[n], found[n + 1]} == {"block"} and found[n + 2] == found[None] == "allow"
    found = {r.page_id: r.verdict for r in urls.judge(pages, rules).collect()}
    assert set(found.values()) == {"allow"}
    more = spark.createDataFrame([("http://p0.net/0", "http://good.net/"), (None, "x")], "a string, b string")
    rows = urls.judge(pages, rules[:2], more).collect()
    assert {r.verdict for r in rows} == {"allow"} and len(rows) == n + 4
    assert urls.judge(pages.filter(F.lit(False)), rules).count() == 0


RESOLVED = {
    # The examples of RFC 3986, 5.4, without their fragments, and some of our own.
    "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y",
    "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g", ";x": "http://a/b/c/;x", ".": "http://a/b/c/", "./": "http://a/b/c/",
    "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g",
    "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "g;x=1/../y": "http://a/b/c/y",
    "g?y/../x": "http://a/b/c/g?y/../x", "/out?u=http://x.com/de/": "http://a/out?u=http://x.com/de/", "HTTPS://X.y/../z": "https://x.y/z",
    "mailto:a@b.c?u=http://d.e/": None, "javascript:location='http://d.e'": None, "a//../b": "http://a/b/c/a/b", " ../g ": "http://a/b/g", "": None,
}


def test_links_are_resolved_as_the_standard_says(spark):
    rows = spark.createDataFrame([(link,) for link in RESOLVED] + [(None,)], "link string")
    found = rows.select("link", urls.node_of(urls.resolve(F.lit("http://a/b/c/d;p?q"), F.col("link"))).alias("node")).collect()
    assert {r.link: r.node for r in found} == RESOLVED | {None: None}
    long = "http://a" + "/x/.." * 3000 + "/y"
    assert spark.range(1).select(urls.node_of(F.lit(long)).alias("n")).first().n == "http://a/y"


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None)], "page_id long, url string, html string")
    assert [tuple(r) for r in urls.judge(pages, []).collect()] == [(1, "a.org", "/", None, "allow", None)]


def test_sql_agrees_where_aliases_are(spark, tmp_path):
    """The registered SQL on pages with relative links, chains and conflicts."""
    from compare import compare, connect

    rows = [
        (1, "http://a.example.net/x/y", page("../z", "canonical")), (2, "http://a.example.net/x/../z", page("/en/1", "refresh")),
        (3, "http://www.example.org/en/1", None), (4, "http://b.net/", page("http://A.example.net/x/y#f", "canonical")),
        (5, "http://c.net", page("q", "canonical")), (6, "http://c.net/q", page("http://com/de/1", "canonical")), (7, None, None),
        (8, "http://d.net/", page("http://com/de/1", "refresh") + page("http://com/fr/", "canonical")), (9, "http://e.net/", page("http://x.example.org/en/1?q", "canonical")),
    ]
    rows += [(10 + i, f"http://h{i}.net/b/c/d;p?q", page(link, "refresh" if i % 2 else "canonical")) for i, link in enumerate(RESOLVED) if "'" not in link]
    rows += [(50, "http://i.net/a/./b/..", page("/de/../fr/../de/x", "canonical"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").toPandas().to_parquet(tmp_path / "pages.parquet")
    result = QUERIES["op1_url_aliases"](spark, str(tmp_path))
    verdicts = {r.page_id: r.verdict for r in result.collect()}
    assert verdicts[9] == "block" and verdicts[6] == verdicts[8] == "allow" and verdicts[4] == verdicts[1]
    assert compare(connect(str(tmp_path)), "op1_url_aliases", result) == ""
    assert "op1_url_aliases" in spark_entry.oracle_sql()
