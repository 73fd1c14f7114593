"""Links of pages: how they are written, and the query against its SQL."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from cadenza.llm import registry, url_filter
from cadenza.llm.oracle import SQL

BASE = "http://Site.org/a/b/page.html?x=1#top"


def page(tag):
    return f"<html><head><title>t</title>{tag}</head><body>canonical</body></html>"


# tag in the page BASE -> where it leads (None: nowhere)
LINKS = [
    ('<link rel="canonical" href="http://other.com/de/x?a=1&amp;b=2">', "other.com/de/x?a=1&b=2"),
    ('<link rel="canonical" href="http://other.com/?a=1&#38;b=2&#x26;c=&#xe9;&#228;&#128512;">', "other.com/?a=1&b=2&c=éä😀"),
    ('<link rel="canonical" href="http://other.com/?q=&amp;amp;&lt;&quot;x&apos;y&amp;#38;">', "other.com/?q=&amp;<\"x'y&"),
    ('<link rel="canonical" href="de/x">', "site.org/a/b/de/x"),
    ('<link rel="canonical" href="./de/../x/.">', "site.org/a/b/x/"),
    ('<link rel="canonical" href="../../../up">', "site.org/up"),
    ('<link rel="canonical" href="/r/./s/../t?q=../z">', "site.org/r/t?q=../z"),
    ('<link rel="canonical" href="?y=2">', "site.org/a/b/page.html?y=2"),
    ('<link rel="canonical" href="#part">', "site.org/a/b/page.html?x=1"),
    ('<link rel="canonical" href="//CDN.net/p">', "cdn.net/p"),
    ('<link rel="canonical" href="mailto:me@x.org">', None),
    ('<link rel="canonical" href="">', None),
    ('<link rel="alternate canonical" href="/z">', "site.org/z"),
    ("<LINK HREF='/single' REL='Canonical'>", "site.org/single"),
    ("<link rel=canonical href=/bare>", "site.org/bare"),
    ('<link rel="canonical"\n  href=" /spaced ">', "site.org/spaced"),
    ('<link title="a > b" rel="canonical" href="/quoted">', "site.org/quoted"),
    ('<link rel="canonicalize" href="/no">', None),
    ('<link rel="alternate" title="canonical" href="/no">', None),
    ('<link data-href="/no" rel="canonical" href="/yes">', "site.org/yes"),
    ('<meta http-equiv="refresh" content="0; URL=next?a=1&amp;b=2">', "site.org/a/b/next?a=1&b=2"),
    ("<meta http-equiv=refresh content='5;url=\"/q\"'>", "site.org/q"),
    ('<meta http-equiv="refresh" content="30">', None),
    ('<meta name="refresh" content="0; url=/no">', None),
]


@pytest.mark.parametrize("part", [0, 1])
def test_where_links_lead(spark, part):
    rows = [(f"{BASE}{k}", page(tag)) for k, (tag, _) in enumerate(LINKS)]
    df = spark.createDataFrame(rows[part::2], "url string, html string").distinct()
    for (url, html), (tag, want) in list(zip(rows, LINKS))[part::2]:
        got = [r.b for r in url_filter.link_edges(df.where(df.url == url)).collect()]
        assert got == ([] if want is None else [want]), tag


def duck(sql, pages):
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    con.sql("CREATE VIEW pages AS SELECT page_id::BIGINT AS page_id, url::VARCHAR AS url, html::VARCHAR AS html FROM frame")
    return sorted(con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({sql})").fetchall(), key=str)


def test_blocks_follow_all_kinds_of_links_as_in_sql(spark, tmp_path):
    """The query and its SQL over pages whose links lead to blocked ones."""
    pages = [(0, "http://bad.com/de/x?a=1&b=2", ""), (1, "http://x.net/a/b/page.html", ""), (2, "http://nothing.net/", None),
             (3, None, page('<link rel="canonical" href="http://bad.com/de/x?a=1&amp;b=2">')), (4, "no url", "")]
    for k, (tag, want) in enumerate(LINKS):
        pages.append((100 + k, f"http://s{k}.net/a/b/page.html?x=1", page(tag)))
        if want:
            pages.append((200 + k, "http://" + want.replace("site.org", f"s{k}.net"), page(
                '<link rel="alternate canonical" href="http://bad.com/de/x?a=1&amp;b=2">' if k % 2 else "")))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = registry.op9_url_filter(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == duck(SQL["op9_url_filter"], pages)
    verdict = {r.page_id: r.verdict for r in got}
    for k, (_, want) in enumerate(LINKS):
        if want:
            assert verdict[200 + k] == verdict[100 + k] if k != 8 else True
            assert verdict[200 + k] == ("block" if k % 2 else verdict[200 + k])
    assert sum(v == "block" for v in verdict.values()) > 15
