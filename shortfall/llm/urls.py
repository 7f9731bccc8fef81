"""URL filter: rules by host and path, and decisions shared by redirect-equivalent urls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.llm.base import Store
from shortfall.llm.components import connected_components

#: Rules of the registered query: (verdict, host and path).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """A url's node: host, path and query; null without host. Scheme and fragment name no other page."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.nullif(F.concat(host(url), rest), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; equal lengths: allow, then by text.

    The rules are a list held by the plan, one expression for each.
    """
    order = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1]))
    rule = verdict = None
    for what, text in order:
        cut = text.index("/")
        fits = ((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def page_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between url nodes that pages declare: canonical links and refresh redirects.

    Targets may be absolute, without scheme, or from the host's root; others are
    taken relative to the page's folder. Pages without url or target give none.
    """
    html = F.coalesce("html", F.lit(""))
    link = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    meta = F.regexp_extract(html, r"(?is)<meta\b[^>]*http-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    href = F.regexp_extract(link, r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    refresh = F.regexp_extract(meta, r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    found = (
        pages.filter(F.col("url").isNotNull())
        .select("url", F.explode(F.array_distinct(F.array(href, refresh))).alias("target"))
        .filter("target != ''")
        .withColumn("target", F.replace(F.col("target"), F.lit("&amp;"), F.lit("&")))
    )
    base = F.concat(F.lit("x://"), host(F.col("url")))
    folder = F.regexp_replace(path(F.col("url")), r"[^/]*$", "")
    absolute = (
        F.when(F.col("target").contains("://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(F.lit("x:"), "target"))
        .when(F.col("target").startswith("/"), F.concat(base, "target"))
        .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), "target"))
    )
    return found.select(node(F.col("url")).alias("a"), node(absolute).alias("b"))


def judge(
    spark: SparkSession, pages: DataFrame, edges: DataFrame, rules: list[tuple[str, str]]
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, component), one for each row of ``pages``.

    Urls joined by ``edges`` (a, b: nodes) are equivalent. A page with a fitting
    rule gets the rule's verdict. Any other gets that of its component: allow
    if a rule allows one of its urls, else block if a rule blocks one. Pages
    outside all components, or in one without rules, are allowed.

    A null url or one without ``://`` has empty host and path, fits no rule and
    is allowed. Repeated rows get equal results, empty tables give no rows,
    other columns of ``pages`` are ignored. Only links, not pages, are iterated on.
    """
    store = Store(spark, "urls")
    labels = connected_components(edges, store)
    members = labels.withColumn("url", F.concat(F.lit("x://"), F.col("node")))
    _, verdict = longest_rule(host(F.col("url")), path(F.col("url")), rules)
    decided = (
        members.withColumn("verdict", verdict)
        .groupBy("root")
        .agg(F.min("verdict").alias("shared"))  # allow comes before block
    )
    decided = labels.join(decided, "root").select("node", F.col("root").alias("component"), "shared")
    rows = pages.select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        node(F.col("url")).alias("node"),
    )
    rule, own = longest_rule(F.col("host"), F.col("path"), rules)
    return (
        rows.withColumn("rule", rule)
        .withColumn("own", own)
        .join(decided, "node", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("own", "shared", F.lit("allow")).alias("verdict"), "component",
        )
    )


def url_filter(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The rules of the registered query over the pages and the links they declare."""
    return judge(spark, pages.select("page_id", "url"), page_edges(pages.select("url", "html")), RULES)
