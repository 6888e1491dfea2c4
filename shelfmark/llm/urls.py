"""URL filter with redirect equivalence: a page linked to a blocked alias is blocked, explicit allow rules first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import components
from shelfmark.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""
REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
TARGET = r"""(?is)\bcontent\s*=\s*["']?[^"'>;]*;\s*url\s*=\s*["']?([^"'>]*)"""


def rest_of(url: Column) -> Column:
    """What follows the first "://"; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path without `.` and `..` segments (RFC 3986, 5.2.4)."""
    step = lambda done, part: (
        F.when(part == "..", F.regexp_replace(done, r"/[^/]*\z", "")).when(part == ".", done).otherwise(F.concat(done, F.lit("/"), part))
    )
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.lit(""), step)
    ends_open = F.when(path.rlike(r"/\.\.?\z"), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), F.concat(kept, ends_open)).otherwise(path)


def node_of(url: Column) -> Column:
    """A URL as a node: scheme and host lower-cased, without dot segments and fragment; null without "://"."""
    scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
    query = F.regexp_extract(rest_of(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(rest_of(url).isNotNull(), F.concat(scheme, F.lit("://"), host_of(url), without_dots(path_of(url)), query))


def resolve(base: Column, link: Column) -> Column:
    """An absolute URL for a link found on the page `base`; null for one of another kind, as `mailto:`. Dot segments are left to `node_of`."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*\z", "")
    return (
        F.when(link.rlike(SCHEME + "//"), link)
        .when(rest_of(base).isNull() | (link == "") | link.rlike(SCHEME), F.lit(None))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path_of(base), link))
        .when(link.startswith("#"), base)
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def alias_links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes: canonical links and immediate refreshes found in `html`."""
    tags = F.expr(f"regexp_extract_all(html, r'{TAG}', 0)")
    tag = F.col("tag")
    href = F.coalesce(*[F.nullif(F.regexp_extract(tag, HREF, i), F.lit("")) for i in (1, 2, 3)])
    link = F.when(tag.rlike(CANONICAL), href).when(tag.rlike(REFRESH), F.regexp_extract(tag, TARGET, 1))
    found = pages.select("url", F.explode(tags).alias("tag")).select("url", link.alias("link")).filter("link IS NOT NULL")
    ends = found.select(node_of(F.col("url")).alias("a"), node_of(resolve(F.col("url"), F.col("link"))).alias("b"))
    return ends.filter("a IS NOT NULL AND b IS NOT NULL")


def ruled(rows: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add `rule` and `ruling` to rows with host and path: the longest rule that fits, null if none does.

    One join per number of host labels that rules have, on that many last labels of the host; Spark broadcasts the rules
    only while they are small. Of equally long rules the one with the longer host wins, then allow.
    """
    spark = rows.sparkSession
    listed = spark.createDataFrame(list(rules) or [("allow", "", "")], "ruling string, of string, path string").filter("of != ''")
    listed = listed.withColumn("labels", F.size(F.split("of", r"\.")))
    one = F.struct(F.lower("path").alias("x"), F.col("path").alias("begins"), F.concat("of", "path").alias("rule"), "ruling")
    sizes = sorted({host.count(".") + 1 for _, host, _ in rules if host})
    fits = []
    for n in sizes:
        groups = listed.filter(F.col("labels") == n).groupBy(F.col("of").alias(f"_of{n}")).agg(F.collect_list(one).alias(f"_rules{n}"))
        last = F.substring_index("host", ".", -n)
        rows = rows.join(groups, last == F.col(f"_of{n}"), "left").drop(f"_of{n}")
        fits.append((n, f"_rules{n}"))
    if not fits:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "ruling": F.lit(None).cast("string")})
    every = F.concat(*[F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType)) for _, c in fits])
    fitting = F.filter(every, lambda r: F.col("path").startswith(r["begins"]))
    ranked = F.transform(
        fitting,
        lambda r: F.struct(
            F.length(r["rule"]).alias("n"), (-F.length(r["begins"])).alias("m"), (r["ruling"] == "allow").alias("allow"), r["rule"].alias("rule"), r["ruling"].alias("ruling")
        ),
    )
    return (
        rows.withColumn("_best", F.array_max(ranked))
        .withColumns({"rule": F.col("_best.rule"), "ruling": F.col("_best.ruling")})
        .drop("_best", *[c for _, c in fits])
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, links: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, alias) of every input row of (page_id, url, html).

    A fitting rule decides. Otherwise the page's component over redirect and canonical-link edges does: an explicit allow of
    any alias allows it, else a block of any alias blocks it, else it is allowed. Aliases count if they are only linked to,
    and `links` (a, b), a table of redirects between URLs, adds edges. `alias` is the least URL of the component, or
    null. A null URL or one without "://" has an empty host and path and no alias; a null html has no links; repeated
    rows are judged each.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    edges = alias_links(rows)
    if links is not None:
        added = links.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"))
        edges = edges.unionByName(added.filter("a IS NOT NULL AND b IS NOT NULL"))
    stars = components(edges)
    members = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
    parts = members.select("node", "root", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    decided = ruled(parts, rules)
    named = decided.groupBy("root").agg(
        F.max(F.col("ruling") == "allow").alias("allowed"), F.max(F.col("ruling") == "block").alias("blocked")
    )
    aliases = settle(members.join(named, "root").select("node", F.col("root").alias("alias"), "allowed", "blocked"))
    own = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("at"))
    inherited = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow")
    return (
        ruled(own, rules)
        .join(aliases, F.col("at") == F.col("node"), "left")
        .select("page_id", "host", "path", "rule", F.coalesce("ruling", inherited).alias("verdict"), "alias")
    )
