"""URL filters by rules, carried over to the aliases that redirects and canonical links declare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.plans.scratch import written

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAG = r"(?is)<(?:link|meta)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
CANONICAL = r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'>\s]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (verdict, rule); null if none does. Rules are settings, not data."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))).otherwise(best)
    return best


def without_dots(path: Column) -> Column:
    """A path from the root with its "." and ".." segments taken out; one that ends in either ends in "/"."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    last = F.element_at(parts, -1)
    parts = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda kept, s: F.when(s == ".", kept).when(s == "..", up(kept)).otherwise(F.concat(kept, F.array(s))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def node_of(url: Column) -> Column:
    """What makes two spellings one address: scheme and host in lower case, no dot segments, "/" for no path, no
    fragment. What has no host stays as it is."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)", 1)
    rest = F.substr(bare, F.length(head) + 1)
    path, query = F.regexp_extract(rest, r"(?s)^([^?]*)", 1), F.regexp_extract(rest, r"(?s)^[^?]*(.*)$", 1)
    path = F.when(path.startswith("/"), without_dots(path)).otherwise("/")
    return F.when(head == "", bare).otherwise(F.concat(F.translate(head, UPPER, LOWER), path, query))


def resolved(base: Column, link: Column) -> Column:
    """A link as an absolute address: absolute, from the scheme, from the root, a query or fragment of ``base`` itself, or
    from its folder. Dot segments are left to `node_of`."""
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    path = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"(?s)^((?:[^/]*/)*)", 1)
    return (
        F.when(link.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, F.when(path == "", "/").otherwise(path), link))
        .when(link.startswith("#"), base)
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def declared_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a page and the address its canonical link or its refresh redirect names. Pages without url or html
    declare none; other attributes, their order and their quotes do not matter."""
    tags = pages.where(F.col(url).isNotNull()).select(
        F.col(url).alias("u"), F.explode(F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0))).alias("tag")
    )
    href = F.concat(*[F.regexp_extract("tag", HREF, i) for i in (1, 2, 3)])
    link = F.when(F.col("tag").rlike(CANONICAL) & F.lower("tag").startswith("<link"), href).when(
        F.col("tag").rlike(REFRESH), F.regexp_extract("tag", TARGET, 1)
    )
    found = tags.select("u", F.trim(F.replace(link, F.lit("&amp;"), F.lit("&"))).alias("link")).where("link <> ''")
    return found.select(node_of(F.col("u")).alias("a"), node_of(resolved(F.col("u"), F.col("link"))).alias("b"))


def verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    A rule that fits the page's own url decides, the longest first: an explicit allow holds even among blocked aliases.
    A page without a rule is blocked if any address it is equivalent to is blocked by a rule, whether that address is a
    page here or only the target of a link; else it is allowed. Equivalent are addresses joined by canonical links,
    refresh redirects and the rows (a, b) of ``redirects``. Only addresses that occur in a link reach the component
    search and the join behind it, so a site with a third of all pages but no links moves nothing.

    A null url, or one without ``://``, has empty host and path, no rule and no aliases: allowed. Pages with the same
    url are judged alike; repeated rows stay repeated.
    """
    judged = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("__url"))
    judged = judged.withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    judged = judged.withColumn("__best", rule_of(F.col("host"), F.col("path"), rules))
    edges = declared_links(pages, url, html)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("a")), node_of(F.col("b"))))
    groups = written(components(edges), "aliases")
    own = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
    blocked = groups.where(own == "block").select("component").distinct()
    aliases = written(groups.join(blocked, "component", "left_semi").select(F.col("node").alias("__alias")), "blocked")
    judged = judged.withColumn("__node", F.when(F.col("__best").isNull(), node_of(F.col("__url"))))
    found = judged.join(aliases, judged["__node"] == aliases["__alias"], "left")
    verdict = F.coalesce(
        F.col("__best.verdict"), F.when(F.col("__alias").isNotNull(), "block").otherwise("allow")
    )
    return found.select("page_id", "host", "path", F.col("__best.rule").alias("rule"), verdict.alias("verdict"))
