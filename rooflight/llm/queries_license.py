"""Query op8 and its SQL."""

from __future__ import annotations

from rooflight.llm import license_scan as ls
from rooflight.llm.shared import documents


def op8_license_scan(spark, sf_dir):
    return ls.scan_documents(documents(spark, sf_dir))


def _sql() -> str:
    templates = ", ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(ls.TEMPLATES))
    licence_file = "lower(regexp_extract(path, '[^/]*$')), '^(licen[sc]e|copying|notice)(\\.[a-z]+)?$'"
    return rf"""
        WITH t(k, licence, body) AS (VALUES {templates}),
        f AS (
          SELECT doc_id, text,
                 coalesce(source, '_') || '/' || coalesce(CAST(CAST(floor(doc_id / 100) AS BIGINT) AS VARCHAR), '_') || '/' ||
                 CASE WHEN doc_id % 100 = 0 THEN 'LICENSE' ELSE coalesce(doc_id || '.txt', '_.txt') END AS path
          FROM documents),
        tt AS (SELECT k, licence, unnest(string_split_regex(lower(body), '[^a-z0-9]+')) AS term FROM t),
        tc AS (SELECT k, licence, term, 1 + ln(count(*)) AS tf FROM tt WHERE term <> '' GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM f),
        df AS (
          SELECT term, count(*) AS df
          FROM (SELECT unnest(list_distinct(string_split_regex(lower(text), '[^a-z0-9]+'))) AS term FROM f)
          WHERE term IN (SELECT term FROM tc) GROUP BY term),
        idf AS (SELECT DISTINCT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM tc LEFT JOIN df USING (term), n),
        tw AS (
          SELECT k, licence, term, tf * idf / sqrt(sum(tf * tf * idf * idf) OVER (PARTITION BY k)) AS w
          FROM tc JOIN idf USING (term)),
        lines AS (SELECT path, string_split(text, chr(10)) AS l FROM f WHERE text IS NOT NULL),
        starts AS (SELECT path, l, unnest(generate_series(1, len(l))) AS s FROM lines),
        runs AS (SELECT path, s, k, l[s:s + k - 1] AS run FROM starts, generate_series(1, {ls.WRAPPED}) g(k) WHERE s + k - 1 <= len(l)),
        seg AS (
          SELECT path, s * {ls.WRAPPED} + k AS i, array_to_string(run, chr(10)) AS part FROM runs
          WHERE k = 1 OR list_max([length(x) FOR x IN run]) <= {ls.MAX_LINE}
          UNION ALL SELECT path, 0, text FROM f WHERE regexp_matches({licence_file})),
        tok AS (SELECT path, i, unnest(string_split_regex(lower(part), '[^a-z0-9]+')) AS term FROM seg),
        c AS (SELECT path, i, term, 1 + ln(count(*)) AS tf FROM tok WHERE term <> '' GROUP BY ALL),
        x AS (SELECT path, i, c.term, tf * coalesce(idf, ln(n + 1) + 1) AS x FROM c LEFT JOIN idf USING (term), n),
        len AS (SELECT path, i, sqrt(sum(x * x)) AS len FROM x GROUP BY ALL),
        s AS (
          SELECT path, licence, least(1.0, round(sum(x * w) / any_value(len), 9)) AS score
          FROM x JOIN tw USING (term) JOIN len USING (path, i) GROUP BY path, i, k, licence),
        own AS (
          SELECT path, licence, score FROM s WHERE score >= {ls.THRESHOLD}
          QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, licence) = 1),
        held AS (
          SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS above, min(licence) AS granted
          FROM own WHERE regexp_matches({licence_file}) GROUP BY 1),
        d AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM f),
        near AS (
          SELECT dir, above, granted FROM d JOIN held ON dir = above OR starts_with(dir, above || '/')
          QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC) = 1)
        SELECT doc_id, f.path, coalesce(licence, granted) AS licence, score,
               CASE WHEN licence IS NOT NULL THEN f.path ELSE above END AS licence_from
        FROM f LEFT JOIN own USING (path) LEFT JOIN near ON dir = regexp_extract(f.path, '^(.*)/[^/]*$', 1)
    """


QUERIES = {"op8_license_scan": op8_license_scan}
SQL = {"op8_license_scan": _sql()}
