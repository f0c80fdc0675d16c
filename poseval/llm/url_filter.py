"""URL verdicts from rules, handed on along redirects and canonical links.

A rule (host, path) fits its host and all subdomains when the path of a URL
starts with its own; of several the longest holds. URLs that redirect to each
other or name each other as canonical are one page under several names:
connected components over those links make them one group, and a block on any
of its URLs blocks those that have no rule of their own. A URL's own rule,
an explicit allow in particular, always comes first.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import staged
from poseval.llm.components import connected_components
from poseval.schema import require_columns

RULES = "host string, path string, verdict string"
#: Names have at most so many labels (255 bytes on the wire).
MOST_LABELS = 127


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, with A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """After the host up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def _without_fragment(url: Column) -> Column:
    return F.split_part(url, F.lit("#"), F.lit(1))


def _resolved(links: DataFrame) -> DataFrame:
    """``source, target`` of links ``url, href`` as seen from the page ``url``."""
    parts = links.where("href != ''").select(
        "url",
        "href",
        F.regexp_extract("url", r"(?s)^(.*?)://", 1).alias("scheme"),
        F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0).alias("root"),
        url_path(F.col("url")).alias("path"),
    )
    folder = F.concat(F.regexp_replace("path", r"[^/]*$", ""), F.when(F.col("path").contains("/"), "").otherwise("/"))
    target = (
        F.when(F.col("href").contains("://"), F.col("href"))
        .when(F.col("href").startswith("//"), F.concat("scheme", F.lit(":"), "href"))
        .when(F.col("href").startswith("/"), F.concat("root", "href"))
        .when(F.col("href").startswith("?"), F.concat("root", "path", "href"))
        .otherwise(F.concat(F.col("root"), folder, F.col("href")))
    )
    return parts.select(_without_fragment(F.col("url")).alias("source"), _without_fragment(target).alias("target"))


def _attribute(name: str) -> Column:
    """Value of an attribute of ``tag``: in double, single or no quotes."""
    value = F.regexp_extract("tag", rf"""(?is)\b{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.btrim(F.btrim(value, F.lit("\"'"))).alias(name.replace("-", "_"))


def alias_links(pages: DataFrame) -> DataFrame:
    """``source, target``: canonical links and refresh redirects in the pages' markup."""
    tags = pages.where(F.col("html").rlike(r"(?i)canonical|refresh")).select(
        "url", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag")
    )
    named = tags.select("url", *[_attribute(n) for n in ("rel", "href", "http-equiv", "content")])
    moved = F.regexp_extract("content", r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1)
    href = F.when(F.lower("rel").rlike(r"(^|\s)canonical(\s|$)"), F.col("href")).when(F.lower("http_equiv") == "refresh", moved)
    return _resolved(named.select("url", F.trim(F.replace(href, F.lit("&amp;"), F.lit("&"))).alias("href")).where("url IS NOT NULL"))


def matching_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, own`` of the distinct places that a rule fits: the longest, then the smallest text.

    Each host is looked up by its endings; rules with more labels than a host don't fit.
    """
    require_columns(rules, ["host", "path", "verdict"])
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    if depth > MOST_LABELS:
        raise ValueError(f"a rule's host has more than {MOST_LABELS} labels")
    ends = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in range(1, depth + 1)]))
    named = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        F.col("host").alias("end"), F.col("path").alias("start"), F.col("verdict").alias("own")
    )
    places = urls.select("host", "path").distinct().select("*", F.explode(ends).alias("end"))
    rule = F.concat("end", "start")
    fits = places.join(named, "end").where(F.startswith("path", "start"))
    best = F.max_by(F.struct(rule.alias("rule"), "own"), F.struct(F.length(rule), rule)).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.own")


def judge_pages(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages``.

    ``redirects`` (``source, target``) adds known redirects to those found in
    the markup. Fragments don't tell URLs apart. A null URL, or one without
    ``://``, has an empty host and path. Where neither a rule nor a blocked
    alias decides, the verdict is allow. Repeated rows are judged alike; an
    empty table gives no rows; other columns are ignored.
    """
    require_columns(pages, ["page_id", "url", "html"])
    links = alias_links(pages)
    if redirects is not None:
        more = redirects.select(_without_fragment(F.col("source")).alias("source"), _without_fragment(F.col("target")).alias("target"))
        links = links.union(more.where("source IS NOT NULL AND target IS NOT NULL"))
    links = staged(links.where("source != target").distinct(), "alias-links")
    place = lambda url: [url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")]
    joined = pages.select("page_id", _without_fragment(F.col("url")).alias("node"), *place("url"))
    groups = staged(connected_components(links, "source", "target").select("*", *place("node")), "alias-groups")
    places = reduce(DataFrame.union, [joined.select("host", "path"), groups.select("host", "path")])
    found = staged(matching_rule(places, rules), "rules")
    blocked = groups.join(found.where("own = 'block'"), ["host", "path"], "left_semi").select("component").distinct()
    handed = groups.join(blocked, "component", "left_semi").select("node", F.lit("block").alias("handed"))
    judged = joined.join(found, ["host", "path"], "left").join(handed, "node", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("own", "handed", F.lit("allow")).alias("verdict"))
