"""URL rules whose decisions also reach the aliases of a page.

Pages that redirect to each other or name each other as canonical are one class of aliases,
found as connected components over those links alone: other addresses are never joined,
unless the caller asks for a normalisation of addresses. A page with a rule of its own follows that rule. A page
without one is allowed if a member of its class has an allow rule (allow takes precedence),
blocked if one has a block rule, and else allowed.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldwatch.llm.columns import free_name, without
from yieldwatch.llm.components import connected_components
from yieldwatch.sources.scratch import settle

Rule = tuple[str, str, str]  # verdict, host, path prefix

# Query parameters that only say where a visitor came from.
TRACKING = r"(?i)^(?:utm_[a-z]+|ref|fbclid|gclid)(?:=|$)"
CANONICAL = r"(?is)<link\b[^>]*\brel=(?:[\"'](?:[^\"'>]*\s)?canonical\b|canonical\b)[^>]*>"


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    place = F.locate("://", url)
    return F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?` or `#`, with A-Z lower-cased; else empty."""
    return _lower(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to `?` or `#`."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def alias_key(url: Column) -> Column:
    """Equal for addresses that servers answer alike: without scheme, www., fragment, closing
    slash and tracking parameters. Null for an address without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    key = F.concat(host, F.lit("/"), F.regexp_replace(path_of(url), "^/+|/+$", ""), F.lit("?"), kept)
    return F.when(host != "", key)


def address_key(url: Column) -> Column:
    """The address as it is written; null for one without a host."""
    return F.when(host_of(url) != "", url)


def _without_dots(path: Column) -> Column:
    """A path that starts with `/`, with its `.` and `..` segments followed."""
    segments = F.split(path, "/")

    def step(done: Column, segment: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment == ".", done).when(segment == "..", up).otherwise(F.concat(done, F.array(segment)))

    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"), step)
    closing = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closing)


def resolve(target: Column, url: Column) -> Column:
    """The address that `target` means on the page `url`, also where it is relative."""
    start = F.regexp_extract(url, r"(?s)^[^/?#]*://[^/?#]*", 0)
    path = F.regexp_extract(target, r"(?s)^[^?#]*", 0)
    rest = F.substr(target, F.length(path) + 1)
    folder = F.regexp_extract(path_of(url), r"(?s)^.*/", 0)
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    whole = F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
    whole = whole.when(target.startswith("//"), F.concat(F.regexp_extract(start, "^[^:]*:", 0), target))
    whole = whole.when(target.startswith("#"), F.concat(F.regexp_extract(url, r"(?s)^[^#]*", 0), target))
    whole = whole.when(target.startswith("?"), F.concat(start, path_of(url), target))
    return whole.otherwise(F.concat(start, _without_dots(rooted), rest))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target): the canonical link and the refresh redirect that a page's head names.

    Relative targets are completed by the page's address. canonical may be any word of rel.
    """
    head = F.get(F.split(F.col(html), r"(?i)</head>|<body\b", 2), F.lit(0))
    canonical = F.regexp_extract(F.regexp_extract(head, CANONICAL, 0), r"(?is)\bhref=[\"']?([^\"'\s>]+)", 1)
    refresh = F.regexp_extract(F.regexp_extract(head, r"(?is)<meta\b[^>]*\bhttp-equiv=[\"']?refresh\b[^>]*>", 0), r"(?is)\burl=[\"']?([^\"'\s>]+)", 1)
    links = pages.select(F.col(url).alias("source"), F.explode(F.array(canonical, refresh)).alias("target"))
    target = F.replace("target", F.lit("&amp;"), F.lit("&"))
    return links.filter(F.col("target") != "").select("source", resolve(target, F.col("source")).alias("target"))


def rules_frame(spark, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, rule_host string, prefix string")


def match_rules(df: DataFrame, rules: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """`df` with the longest fitting `rule` and its `rule_verdict`, or nulls.

    A rule fits its host, all subdomains, and paths that start with its prefix. Equally long:
    the longer host, then allow. No host's rules are gathered: a host has the lengths that
    prefixes of its rules have, an address looks up its beginnings of these lengths by an equality join,
    and distinct addresses are looked up once, however many rows have them.
    """
    known = rules.filter(F.col("prefix").isNotNull() & F.col("rule_host").isNotNull())
    known = known.groupBy("rule_host", "prefix").agg(F.max(F.col("verdict") == "allow").alias("allows"))
    lengths = known.select("rule_host", F.length("prefix").alias("long")).distinct()
    addresses = df.select(F.col(host).alias("_host"), F.col(path).alias("_path")).filter(F.col(host) != "").distinct()
    labels = F.split("_host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = addresses.select("_host").distinct().withColumn("rule_host", F.explode(tails)).join(lengths, "rule_host")
    beginnings = addresses.join(hosts, "_host").filter(F.col("long") <= F.length("_path"))
    beginnings = beginnings.withColumn("prefix", F.substring(F.col("_path"), F.lit(1), F.col("long")))
    fitting = beginnings.join(known, ["rule_host", "prefix"])
    candidate = F.struct(
        (F.length("rule_host") + F.col("long")).alias("size"),
        F.length("rule_host").alias("host_long"),
        "allows",
        F.concat("rule_host", "prefix").alias("rule"),
    )
    best = fitting.groupBy("_host", "_path").agg(F.max(candidate).alias("_best"))
    own_host, own_path, found = (free_name(df, n) for n in ("_host", "_path", "_best"))
    best = best.select(F.col("_host").alias(own_host), F.col("_path").alias(own_path), F.col("_best").alias(found))
    joined = df.join(best, (F.col(host) == F.col(own_host)) & (F.col(path) == F.col(own_path)), "left")
    verdict = F.when(F.col(found)["allows"], "allow").when(~F.col(found)["allows"], "block")
    return joined.select(*without(df, ["rule", "rule_verdict"]), F.col(found)["rule"].alias("rule"), verdict.alias("rule_verdict"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, url: str = "url", normalise: bool = False
) -> DataFrame:
    """`pages` with host, path, rule, rule_verdict and verdict; columns of these names are replaced.

    links: (source, target) addresses of redirects and canonical links, of pages given here
    or not. Only these join addresses, which are told apart as they are written; with
    `normalise`, those with one `alias_key` count as one. An address that is null or has no `://` has an empty host and path, fits no rule
    and is allowed. Repeated pages are judged alike. Runs jobs while components are found.
    """
    kept = without(pages, ["host", "path", "rule", "rule_verdict", "verdict"])
    # The caller's columns stand aside in one struct, so that none can clash.
    key = alias_key if normalise else address_key
    rows = pages.select(
        F.struct(*[F.col(c) for c in kept]).alias("_page"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        key(F.col(url)).alias("_key"),
    )
    judged = match_rules(rows, rules)
    known = judged.select("_key", "rule_verdict")
    if links is None:
        roots = None
    else:
        edges = settle(links.select(key(F.col("source")).alias("a"), key(F.col("target")).alias("b"), "source", "target"))
        roots = settle(connected_components(edges, "a", "b"))
        ends = edges.select(F.explode(F.array("source", "target")).alias("u"))
        ends = ends.select(host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"), key(F.col("u")).alias("_key"))
        known = known.unionByName(match_rules(ends, rules).select("_key", "rule_verdict"))
    if roots is not None:
        named = roots.select(F.col("node").alias("_key"), F.col("root").alias("_root"))
        known = known.join(named, "_key", "left").withColumn("_root", F.coalesce("_root", "_key"))
        judged = judged.join(named, "_key", "left").withColumn("_root", F.coalesce("_root", "_key"))
    else:
        known, judged = known.withColumn("_root", F.col("_key")), judged.withColumn("_root", F.col("_key"))
    classes = (
        known.filter(F.col("rule_verdict").isNotNull())
        .groupBy("_root")
        .agg(F.max(F.col("rule_verdict") == "allow").alias("_allowed"), F.max(F.col("rule_verdict") == "block").alias("_blocked"))
    )
    verdict = F.coalesce(
        F.col("rule_verdict"),
        F.when(F.coalesce("_allowed", F.lit(False)), "allow").when(F.coalesce("_blocked", F.lit(False)), "block"),
        F.lit("allow"),
    )
    return judged.join(classes, "_root", "left").select("_page.*", "host", "path", "rule", "rule_verdict", verdict.alias("verdict"))
