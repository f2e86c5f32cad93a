"""URL filters with redirect equivalence, in DataFrame operations.

A url is judged by the longest rule that fits its host and path.  Urls without a
rule take the verdict of their aliases: canonical links and redirects (meta
refresh, or any edge table) join urls, the connected components of those edges
are alias groups, and a group with a blocked member is blocked, unless a member
is explicitly allowed.  A url's own rule always comes first.

A url's identity among aliases is its lower-cased host, path and query; scheme
and fragment are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import fresh, staged
from cartwheel.llm.components import connected_components

MAX_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
_REFRESH = r"""(?is)\bcontent\s*=\s*["']?[\s\d.]*[;,]?\s*url\s*=\s*["']?([^"'>\s]+)"""


def url_host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_node(url: Column) -> Column:
    """Identity among aliases: host, path and query; null if the url has no ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(url_host(url), rest))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    A rule is "host/path"; it fits the host and its subdomains where the path
    starts with the rule's.  Among equally long rules allow comes first, then
    the least text.  The rules are a literal of the plan: at most MAX_RULES.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    ranked = sorted({(r, v) for v, r in rules}, key=lambda x: (-len(x[0]), x[1] != "allow", x[0]))
    table = F.array(*[F.struct(F.lit(r.partition("/")[0]).alias("host"), F.lit("." + r.partition("/")[0]).alias("sub"),
                               F.lit(r[len(r.partition("/")[0]):]).alias("path"), F.lit(r).alias("rule"),
                               F.lit(v).alias("verdict")) for r, v in ranked])
    if not ranked:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.get(F.filter(table, lambda r: ((host == r["host"]) | F.endswith(host, r["sub"]))
                          & F.startswith(path, r["path"])), F.lit(0))


def _present(value: Column) -> Column:
    """Generator of the value if it is not null or empty: evaluated once, unlike a filter on it."""
    return F.explode(F.filter(F.array(value), lambda x: x != ""))


def _resolved(base: Column, href: Column) -> Column:
    """Absolute form of a link found on a page with url ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href) \
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)) \
            .when(href.startswith("/"), F.concat(origin, href)) \
            .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), href)) \
            .when((href == "") | href.startswith("#"), F.lit(None)) \
            .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None)) \
            .otherwise(F.concat(origin, folder, href))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src_url, dst_url) of canonical links and meta refreshes, outside comments and scripts."""
    marked = pages.select(F.col(url_col).alias("src_url"), F.col(html_col).alias("html")) \
                  .filter(F.col("src_url").contains("://") & F.col("html").rlike("(?i)canonical|http-equiv"))
    tags = marked.select("src_url", F.explode(F.regexp_extract_all(
        F.regexp_replace("html", _HIDDEN, ""), F.lit(_TAGS), F.lit(0))).alias("tag"))
    href = F.concat(*[F.regexp_extract("tag", _HREF, k) for k in (1, 2, 3)])
    canonical = F.col("tag").rlike(r"""(?is)^<link\b.*\brel\s*=\s*(?:"[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)""")
    refresh = F.col("tag").rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b""")
    target = F.when(canonical, href).when(refresh, F.regexp_extract("tag", _REFRESH, 1))
    links = tags.select("src_url", _present(F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))).alias("href"))
    return links.select("src_url", _present(_resolved(F.col("src_url"), F.col("href"))).alias("dst_url"))


def alias_verdicts(edges: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(src_url, dst_url) -> (node, alias_verdict) of the nodes whose group has a rule."""
    nodes = staged(edges.select(url_node(F.col("src_url")).alias("src"), url_node(F.col("dst_url")).alias("dst"))
                   .dropna().distinct())
    groups = connected_components(nodes)
    url = F.concat(F.lit("x://"), F.col("node"))
    known = groups.withColumn("host", url_host(url)).withColumn("path", url_path(url)) \
                  .withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules)["verdict"])
    by_group = known.groupBy("root").agg(F.bool_or(F.col("rule") == "allow").alias("allowed"),
                                         F.bool_or(F.col("rule") == "block").alias("blocked"))
    verdict = F.when(F.col("allowed"), F.lit("allow")).when(F.col("blocked"), F.lit("block"))
    return groups.join(by_group.select("root", verdict.alias("alias_verdict")).dropna(), "root") \
                 .select("node", "alias_verdict")


def judge_urls(urls: DataFrame, rules: Sequence[tuple[str, str]], edges: DataFrame,
               url_col: str = "url", default: str = "allow", out: str = "filter") -> DataFrame:
    """Rows of ``urls`` with a struct ``out``: host, path, rule, verdict.

    ``rules`` are (verdict, "host/path"); ``edges`` (src_url, dst_url) may name
    urls that are not in ``urls``.  The verdict is that of the url's own rule,
    else of its alias group (allow before block), else ``default``.  A null url
    or one without :// has empty host and path, no alias, and the default.
    Repeated urls are judged alike; other columns are kept whatever their names
    (``out`` replaces one of that name).  Empty tables are fine.
    """
    host, path, own, node, key, alias = fresh(urls.columns, "host", "path", "own", "node", "key", "alias")
    parts = urls.withColumn(host, url_host(F.col(url_col))).withColumn(path, url_path(F.col(url_col))) \
                .withColumn(own, fitting_rule(F.col(host), F.col(path), rules)) \
                .withColumn(node, url_node(F.col(url_col)))
    aliases = alias_verdicts(edges, rules).select(F.col("node").alias(key), F.col("alias_verdict").alias(alias))
    return parts.join(aliases, F.col(node) == F.col(key), "left").select(
        *[F.col(f"`{c}`") for c in urls.columns if c != out],
        F.struct(F.col(host).alias("host"), F.col(path).alias("path"), F.col(f"{own}.rule").alias("rule"),
                 F.coalesce(f"{own}.verdict", alias, F.lit(default)).alias("verdict")).alias(out))
