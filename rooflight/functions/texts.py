"""Texts and small numbers as expressions that Spark and other SQL engines read alike, unless said otherwise."""

from __future__ import annotations

#: Bulk sources of elevation tiles as (name, cell size in metres, year, zipped, resolutions).
BULK_SOURCES = [
    ("ENGLAND", 5000, 2017, True, ["50CM", "1M", "2M"]),
    ("WALES", 10000, 2015, True, ["50CM", "1M", "2M"]),
    ("SCOTLAND_1", 10000, 2012, False, ["1M"]),
    ("SCOTLAND_2", 10000, 2014, False, ["1M"]),
    ("SCOTLAND_3", 5000, 2016, False, ["50CM"]),
    ("SCOTLAND_4", 5000, 2019, False, ["50CM"]),
    ("SCOTLAND_5", 5000, 2021, False, ["50CM"]),
]


def bulk_path(base: str, source: str, ref: str, res: str) -> str:
    """Where a bulk source keeps the tile of a grid reference; null for an unknown source."""
    # The sources' own folder and file names.
    england = f"concat({base}, '/206817_LIDAR_Comp_DSM/LIDAR-DSM-', {res}, '-ENGLAND-EA/LIDAR-DSM-', {res}, '-', {ref}, '.zip')"
    wales = f"concat({base}, '/wales/', lower({res}), '_res_', {ref}, '_dsm.zip')"
    scotland = f"concat({base}, '/scotland/', upper({ref}), '_', {res}, '_DSM_PHASE', substr({source}, 10), '.tif')"
    return f"CASE WHEN {source} = 'ENGLAND' THEN {england} WHEN {source} = 'WALES' THEN {wales} WHEN {source} LIKE 'SCOTLAND%' THEN {scotland} END"


def round_down_to(x: str, divisor: str) -> str:
    """The multiple of ``divisor`` at or below x, as a whole number."""
    return f"CAST(floor(({x}) / ({divisor})) * ({divisor}) AS BIGINT)"


def round_up_to(x: str, divisor: str) -> str:
    """The multiple of ``divisor`` above x; one that is a multiple already gets a whole divisor more."""
    return f"CAST((floor(({x}) / ({divisor})) + 1) * ({divisor}) AS BIGINT)"


def composite_key(*parts: str) -> str:
    return "concat_ws(':', " + ", ".join(parts) + ")"


def escaped(text: str) -> str:
    """Double quotes escaped by a backslash (Spark's literal of it)."""
    return f"replace({text}, '\"', concat(chr(92), '\"'))"


def tiff_name(path: str) -> str:
    """The file name of a path with its last ending replaced by tiff."""
    return f"concat(regexp_replace(regexp_replace({path}, '^.*/', ''), '[.][^.]*$', ''), '.tiff')"


def wkt_points(wkt: str) -> str:
    """Spark: the points of a polygon's text as array<array<double>>, empty for other kinds."""
    inner = f"regexp_replace(regexp_replace({wkt}, '^POLYGON', ''), '[()]', '')"
    point = "transform(split(trim(p), ' +'), v -> CAST(v AS DOUBLE))"
    return f"CASE WHEN startswith({wkt}, 'POLYGON') THEN transform(split({inner}, ','), p -> {point}) ELSE CAST(array() AS ARRAY<ARRAY<DOUBLE>>) END"


def with_query(uri: str, key: str, value: str) -> str:
    """A URI with one more parameter in its query."""
    return f"concat({uri}, CASE WHEN {uri} LIKE '%?%' THEN '&' ELSE '?' END, {key}, '=', {value})"
