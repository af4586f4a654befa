"""Query op4 and its SQL."""

from __future__ import annotations

from rooflight.llm import url_filter


def op4_url_filter(spark, sf_dir):
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op4_url_filter": op4_url_filter}
_RULES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in url_filter.RULES)
_HOST, _PATH = r"'^.*?://([^/?#]*)'", r"'^.*?://[^/?#]*([^?#]*)'"


def _parts(url: str) -> str:
    return f"coalesce(regexp_extract({url}, {_HOST}, 1, 's'), '')", f"coalesce(regexp_extract({url}, {_PATH}, 1, 's'), '')"


def _lowered(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_h, _p = _parts("url")
_lh, _lp = _parts("target")
SQL = {
    "op4_url_filter": rf"""
        WITH RECURSIVE rules(rh, rp, action) AS (VALUES {_RULES}),
        p AS (SELECT page_id, html, {_lowered(_h)} AS host, {_p} AS path FROM pages),
        tags AS (
          SELECT host, path,
                 unnest([regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is'),
                                        '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'i'),
                         regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is'),
                                        '\burl\s*=\s*["'']?([^"''\s>]+)', 1, 'i')]) AS link
          FROM p),
        links AS (
          SELECT host || path AS a,
                 CASE WHEN contains(link, '://') THEN replace(link, '&amp;', '&')
                      WHEN starts_with(link, '//') THEN 'http:' || replace(link, '&amp;', '&')
                      WHEN starts_with(link, '/') THEN 'http://' || host || replace(link, '&amp;', '&') END AS target
          FROM tags WHERE link <> ''),
        edges AS (
          SELECT a, {_lowered(_lh)} || {_lp} AS b FROM links WHERE target IS NOT NULL AND a <> ''),
        sym AS (SELECT a, b FROM edges WHERE b <> '' UNION SELECT b, a FROM edges WHERE b <> ''),
        reach(a, b) AS (SELECT a, a FROM sym UNION SELECT r.a, s.b FROM reach r JOIN sym s ON r.b = s.a),
        nodes AS (SELECT DISTINCT b AS node, split_part(b, '/', 1) AS host, substr(b, length(split_part(b, '/', 1)) + 1) AS path FROM reach),
        spoken AS (
          SELECT node, (SELECT action FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
                        ORDER BY length(rh || rp) DESC LIMIT 1) AS action
          FROM nodes),
        verdicts AS (
          SELECT r.a, bool_or(s.action = 'block') AND NOT coalesce(bool_or(s.action = 'allow'), false) AS blocked
          FROM reach r JOIN spoken s ON r.b = s.node GROUP BY r.a),
        own AS (
          SELECT page_id, host, path,
                 (SELECT rh || rp FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
                  ORDER BY length(rh || rp) DESC LIMIT 1) AS rule
          FROM p)
        SELECT page_id, host, path, rule,
               coalesce((SELECT action FROM rules WHERE rh || rp = rule),
                        CASE WHEN v.blocked THEN 'block' ELSE 'allow' END) AS verdict
        FROM own LEFT JOIN verdicts v ON host || path = v.a
    """,
}
