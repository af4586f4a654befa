"""URL filters whose decisions reach aliases.

Explicit rules (host, path, action) fit a host and all its subdomains if the URL's path starts with
the rule's; the longest wins, allow before block, then the smaller string. Pages that redirect to
each other or name each other canonical are one component. A URL without a rule of its own is
blocked if its component holds a blocked URL and no allowed one.

Edge cases: a null URL, or one without ``://``, has an empty host and path and fits no rule; null
html has no links; pages that repeat a URL share a verdict; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooflight.llm.shared import connected_components, written

#: The rules of query op4.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Up to so many rules are matched inside the row; longer lists are joined by host suffix.
INLINE_RULES = 200
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s/>]))[^>]*>"""
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _node(url):
    return F.concat(host_of(url), path_of(url))


def match_rules(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Add ``rule`` and ``action`` (null where none fits) to rows with host and path."""
    if len(rules) <= INLINE_RULES:
        best = F.lit(None).cast("struct<rule:string,action:string>")
        for h, p, a in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "allow", [-ord(x) for x in r[0] + r[1]])):
            fits = ((F.col("host") == h) | F.endswith("host", F.lit("." + h))) & F.startswith("path", F.lit(p))
            best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(a).alias("action"))).otherwise(best)
        return urls.withColumn("best", best).select(*[f"`{c}`" for c in urls.columns], "best.rule", "best.action")
    spark = urls.sparkSession
    rows = [(h, p, h + p, a, -len(h + p), a != "allow") for h, p, a in rules]
    table = spark.createDataFrame(rows, "r_host string, r_path string, rule string, action string, r_len int, r_block boolean")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = urls.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    found = (
        pairs.join(table, (F.col("suffix") == F.col("r_host")) & F.startswith("path", F.col("r_path")))
        .groupBy("host", "path")
        .agg(F.min(F.struct("r_len", "r_block", "rule", "action")).alias("b"))
        .select(F.col("host").alias("h_"), F.col("path").alias("p_"), "b.rule", "b.action")
    )
    return urls.join(found, (F.col("host") == F.col("h_")) & (F.col("path") == F.col("p_")), "left").drop("h_", "p_")


def _resolved(found: DataFrame) -> DataFrame:
    """(src, there) of rows src, url, link: links resolved against the page's URL (RFC 3986)."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = []
            for url, link in zip(batch["url"].to_pylist(), batch["link"].to_pylist(), strict=True):
                try:
                    there.append(urljoin(url, link.replace("&amp;", "&")))
                except ValueError:
                    there.append(None)
            yield pa.RecordBatch.from_arrays([batch["src"], pa.array(there, pa.string())], ["src", "there"])

    return found.select("src", "url", "link").mapInArrow(resolve, "src string, there string")


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) of all canonical links and refresh redirects in the pages' html, as host and path."""
    html, none = F.col("html"), F.array().cast("array<string>")

    def targets(word: str, tag: str, link: str):
        tags = F.regexp_extract_all(html, F.lit(tag), F.lit(0))
        return F.when(F.contains(F.lower("html"), F.lit(word)), F.transform(tags, lambda t: F.regexp_extract(t, link, 1))).otherwise(none)

    links = F.concat(
        targets("canonical", _CANONICAL, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"),
        targets("http-equiv", _REFRESH, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"),
    )
    found = pages.select(_node("url").alias("src"), "url", F.explode(F.filter(links, lambda x: x > "")).alias("link")).where("src <> ''")
    return _resolved(found).select("src", _node("there").alias("dst")).where("dst <> '' and src <> dst")


def judge_urls(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict. ``redirects`` has more (src, dst) URLs that are the same page."""
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(_node("src").alias("src"), _node("dst").alias("dst")))
    alias = written(connected_components(edges), "aliases")
    parts = F.split("node", "/", 2)
    ruled = alias.withColumn("host", parts[0]).withColumn("path", F.substring("node", F.length(parts[0]) + 1, 1 << 30))
    spoken = (
        match_rules(ruled, rules)
        .groupBy("component")
        .agg(F.max(F.col("action") == "allow").alias("allows"), F.max(F.col("action") == "block").alias("blocks"))
        .where("blocks and not coalesce(allows, false)")
    )
    blocked = alias.join(spoken, "component").select("node").distinct()
    own = match_rules(pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path")), rules)
    joined = own.join(blocked, F.concat("host", "path") == F.col("node"), "left")
    verdict = F.coalesce("action", F.when(F.col("node").isNotNull(), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
