"""URL filtering with redirect equivalence, by DataFrame operations only.

Explicit rules (host, path, verdict) fit a host and its subdomains where the
path begins with the rule's; the longest rule wins, an allow before a block
of the same length.  Pages that redirect to each other or name the same
canonical link are aliases: the connected components over those edges carry a
block to every alias without a rule of its own; a page's own rule, an allow
above all, comes first.

Edges are the canonical links and refresh redirects in the pages' HTML, and
any given table of redirects.  A node is an URL without scheme and fragment,
its host in lower case (A-Z).

Defined cases: a null URL or one without ``://`` has an empty host and path,
fits no rule and has no aliases; links of schemes without ``//`` are ignored;
rows that repeat a page or URL stay rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import settled
from cadenza.llm.graph import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Groups: host, path, query; the lazy start stops at the first "://".
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def node_of(url: Column) -> Column:
    """Host, path and query; empty for what is no absolute URL."""
    return F.concat(host_of(url), _part(url, 2), _part(url, 3))


def _suffixes(host: Column) -> Column:
    """The host and all domains above it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def _rules_applied(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, rule, verdict of the URLs that a rule fits."""
    own = rules.select(F.col("host").alias("domain"), F.col("path").alias("prefix"),
                       F.col("verdict").alias("says"))
    fits = (urls.withColumn("domain", F.explode(_suffixes(F.col("host"))))
            .join(own, "domain").where(F.startswith("path", "prefix")))
    first = F.max_by(F.struct(F.concat("domain", "prefix").alias("rule"), F.col("says").alias("verdict")),
                     F.struct(F.length("domain") + F.length("prefix"), F.col("says") == "allow",
                              F.length("domain")))
    return fits.groupBy("url").agg(first.alias("won")).select("url", "won.rule", "won.verdict")


# An attribute's value: in double or single quotes, or bare.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, rf"(?is)[\s\"']{name}{_VALUE}", k) for k in (1, 2, 3)]
    return F.trim(F.concat(*found))


def decoded(text: Column) -> Column:
    """Character references as characters: numbers, and the five names of XML."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit("(&#(?:[0-9]{1,6}|[xX][0-9a-fA-F]{1,5});)"), F.lit(1)))

    def char(ref: Column) -> Column:
        digits = F.regexp_replace(F.lower(ref), "[&#;]", "")
        code = F.when(digits.startswith("x"), F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).cast("int")
        # an ampersand is decoded with the last step, once
        return F.when(code == 38, "&amp;").otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.replace(F.aggregate(refs, text, lambda acc, r: F.replace(acc, r, char(r))), F.lit("&amp;"), F.lit("&"))


def _without_dots(path: Column) -> Column:
    """A path without its . and .. segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    parts = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda acc, p: (
        F.when(p == ".", acc).when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p)))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def _target(link: Column, host: Column, path: Column, query: Column) -> Column:
    """The node that a link on a page leads to; null if it leads to no page."""
    link = F.regexp_replace(link, r"(?s)#.*$", "")
    own_path, own_query = F.regexp_extract(link, r"(?s)^([^?]*)", 1), F.regexp_extract(link, r"(?s)(\?.*)$", 1)
    near = F.concat(F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1), own_path)
    near = F.when(near.startswith("/"), near).otherwise(F.concat(F.lit("/"), near))
    return (F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), node_of(link))
            .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))   # mailto: and the like
            .when(link.startswith("//"), node_of(F.concat(F.lit("http:"), link)))
            .when(link == "", F.concat(host, path, query))
            .when(link.startswith("?"), F.concat(host, path, link))
            .when(link.startswith("/"), F.concat(host, _without_dots(own_path), own_query))
            .otherwise(F.concat(host, _without_dots(near), own_query)))


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b): nodes tied by a canonical link or a refresh redirect.

    ``rel`` is a list of words; links may hold character references and may be
    relative to the page (to its URL: a ``base`` element is not read).
    """
    some = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv\s*=\s*[\"']?refresh"))
    tags = some.select("url", F.explode(F.regexp_extract_all(
        "html", F.lit(r"""(?is)(<(?:link|meta)\b(?:"[^"]*"|'[^']*'|[^>"'])*>)"""), F.lit(1))).alias("tag"))
    tag = F.col("tag")
    canonical = F.when(F.array_contains(F.split(F.lower(decoded(_attribute(tag, "rel"))), r"\s+"), "canonical"),
                       _attribute(tag, "href"))
    refresh = F.when(tag.rlike(r"(?i)http-equiv\s*=\s*[\"']?\s*refresh"),
                     F.regexp_extract(_attribute(tag, "content"), r"(?is)\burl\s*=\s*(.*)$", 1))
    raw = tags.select("url", F.explode(F.array(canonical, refresh)).alias("raw")).where(F.col("raw") != "")
    # cut here: nested in one another the expressions below grow too long to compile
    to = settled(raw.select("url", F.regexp_replace(F.trim(decoded(F.col("raw"))), "^['\"]+|['\"]+$", "").alias("link")))
    own = to.select("link", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                    _part(F.col("url"), 3).alias("query"))
    return (own.where(F.col("host") != "")
            .select(F.concat("host", "path", "query").alias("a"),
                    _target(F.col("link"), F.col("host"), F.col("path"), F.col("query")).alias("b"))
            .where(F.col("b").isNotNull()))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    ``rules`` has host, path, verdict (allow or block); ``redirects``, if
    given, has the URLs ``source`` and ``target``.
    """
    url = F.col("url").cast("string")
    urls = (pages.select(url.alias("url")).where(F.col("url").isNotNull()).distinct()
            .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                    node_of(F.col("url")).alias("node")))
    ruled = settled(_rules_applied(urls, rules))

    edges = link_edges(pages.select(url.alias("url"), F.col("html").cast("string").alias("html")))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(
            node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b")))
    tied = settled(components(edges.where((F.col("a") != "") & (F.col("b") != ""))))
    blocked_nodes = (ruled.where(F.col("verdict") == "block")
                     .select(node_of(F.col("url")).alias("node")).distinct())
    blocked_roots = tied.join(blocked_nodes, "node").select("root").distinct()
    # the empty node ties nothing: it is in no edge
    carried = (tied.join(blocked_roots, "root").select("node").distinct()
               .withColumn("carried", F.lit("block")))
    verdicts = (urls.join(ruled, "url", "left").join(carried, "node", "left")
                .select("url", "rule", F.coalesce("verdict", "carried").alias("verdict"))
                .where(F.col("verdict").isNotNull()))
    return (pages.select("page_id", url.alias("url")).join(verdicts, "url", "left")
            .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                    "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")))
