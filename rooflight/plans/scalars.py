"""Scalar functions: grid references, names, angles, and the solar model."""

from __future__ import annotations

from rooflight.functions import angles as a
from rooflight.functions import grid_reference as g
from rooflight.functions import projection
from rooflight.plans.common import CLOCK, CLOCK_SQL, SITE_SQL, chain, chain_sql, clock, site, table

QUERIES, SQL = {}, {}


def _register(name, source, source_sql, steps, columns):
    QUERIES[name] = lambda spark, sf_dir: chain(source(spark, sf_dir), steps).selectExpr(*columns)
    SQL[name] = chain_sql("(SELECT " + ", ".join(columns) + " FROM " + chain_sql(source_sql, steps) + ")", []).replace("(SELECT", "SELECT", 1)[:-1]


def _rounded(names, digits=6):
    return [f"round({c}, {digits}) AS {c}" for c in names]


_register("grid_ref", site, SITE_SQL, [(f"ref_{s}", g.reference("e", "n", s)) for s in (100_000, 10_000, 5_000, 1_000)], ["c_custkey", "ref_100000", "ref_10000", "ref_5000", "ref_1000"])
_airy = [("lat_airy", "degrees(lat0)"), ("lon_airy", "degrees(lon0)")]
_register("tm_project", site, SITE_SQL, [*projection.inverse_mercator("e", "n"), *_airy, *projection.to_wgs84("lat0", "lon0")], ["c_custkey", *_rounded(["lat_airy", "lon_airy", "lat", "lon"])])
_parsed = g.parsed("ref")
_register("grid_ref_parse", site, SITE_SQL, [("ref", g.reference("e", "n", 5_000)), *_parsed.items()], ["c_custkey", "ref", *_parsed])
_box = "concat('POLYGON((', e0, ' ', n0, ',', e0, ' ', n1, ',', e1, ' ', n1, ',', e1, ' ', n0, ',', e0, ' ', n0, '))')"
_text = [(c, f"CAST({x} AS STRING)") for c, x in (("e0", "easting"), ("n0", "northing"), ("e1", "easting + size"), ("n1", "northing + size"))]
_register("grid_ref_wkt", site, SITE_SQL, [("ref", g.reference("e", "n", 1_000)), *_parsed.items(), *_text, ("wkt", f"CASE WHEN size IS NOT NULL THEN {_box} END")], ["c_custkey", "ref", "wkt"])

_name = "concat('LIDAR-DSM-', CASE o_orderkey % 3 WHEN 0 THEN '50CM' WHEN 1 THEN '1M' ELSE '2M' END, '-', CAST(2000 + o_orderkey % 22 AS STRING), '-TQ', lpad(CAST(o_custkey % 10000 AS STRING), 4, '0'), '.zip')"
_orders = lambda spark, sf_dir: table(spark, sf_dir, "orders")
_register(
    "filename_parse", _orders, "orders",
    [("name", _name), ("resolution", "lower(regexp_extract(name, '-(50CM|1M|2M)-', 1))"), ("year", "CAST(regexp_extract(name, '-([0-9]{4})-', 1) AS INT)"), ("tile", "regexp_extract(name, '([A-Z]{2}[0-9]{4})[.]zip$', 1)"), ("metres", "CASE resolution WHEN '50cm' THEN 0.5e0 WHEN '1m' THEN 1e0 WHEN '2m' THEN 2e0 END")],
    ["o_orderkey", "name", "resolution", "year", "tile", "metres"],
)
_register(
    "angle_differences", clock, CLOCK_SQL,
    [("az", "hr * 15e0"), ("turned", a.wrapped("az + 180e0")), ("grass", a.to_grass_aspect("az")), ("gap", a.difference_deg("az", "value")), ("clamped", "least(greatest(value / 100e0 - 1e0, 0e0), pi() / 2)"), ("closest", "CASE WHEN {0} < 15.5 THEN 180e0 WHEN {1} < 15.5 THEN 90e0 WHEN {2} < 15.5 THEN 0e0 WHEN {3} < 15.5 THEN 270e0 END".format(*[a.difference_deg("az", str(x)) for x in ("180e0", "90e0", "0e0", "270e0")]))],
    ["event_id", *_rounded(["turned", "grass", "gap", "clamped", "closest"])],
)

_LAT = ("lat", "radians(51e0 + user_id % 5)")
_SUN = [_LAT, ("decl", a.declination("day")), ("t", a.hour_angle("hr")), ("sin_h", a.sin_altitude("lat", "decl", "t")), ("rise", a.sunrise("lat", "decl")), ("az", a.sun_azimuth("lat", "decl", "t"))]
_register("sun_position", clock, CLOCK_SQL, _SUN, ["event_id", *_rounded(["decl", "sin_h", "rise"]), "round(24e0 - 2 * rise, 6) AS day_length", "round(degrees(az), 4) AS azimuth"])
_PLANE = [("s", "radians(event_id % 4 * 30e0)"), ("asp", "radians(event_id % 8 * 45e0)")]
_INC = [*_SUN, *_PLANE, ("sh", a.sin_incidence("lat", "decl", "t", "s", "asp"))]
_register("incidence", clock, CLOCK_SQL, _INC, ["event_id", *_rounded(["s", "asp", "sh"])])

_turn = "(2e0 * pi())"
_HORIZON = [*_SUN, ("look", a.wrapped("pi() / 2 - az", _turn)), ("sector", "look / (2e0 * pi()) * 8e0"), ("i0", "CAST(floor(sector) AS BIGINT) % 8"), ("i1", "(i0 + 1) % 8"), ("f", "sector - floor(sector)")]
_height = lambda i: f"floor(abs(sin({i} * 1.7e0 + user_id)) * 0.4e0 * 150e0 + 0.5e0) / 150e0"
_HORIZON += [("edge", f"(1e0 - f) * {_height('i0')} + f * {_height('i1')}"), ("h", "asin(least(1e0, greatest(-1e0, sin_h)))"), ("lit", "CASE WHEN h > edge AND h > 0 THEN 1 ELSE 0 END")]
_register("shadow_test", clock, CLOCK_SQL, _HORIZON, ["event_id", *_rounded(["look", "edge", "h"]), "lit"])

_AIR = "greatest(h, 0.001e0)"
IRRADIANCE = [
    ("i0n", a.extraterrestrial("day")),
    ("m", a.air_mass(_AIR)),
    ("ray", a.rayleigh("m")),
    ("beam_h", "CASE WHEN h <= 0 THEN 0e0 ELSE i0n * sin(h) * exp(-ray * m * 0.8662e0 * linke) END"),
    ("diffuse_h", f"CASE WHEN h <= 0 THEN 0e0 ELSE i0n * {a.diffuse_altitude('sin(h)', 'linke')} END"),
    ("beam", f"CASE WHEN lit = 0 OR sh <= 0 OR h <= 0 THEN 0e0 ELSE beam_h * sh / sin(h) * {a.angular_loss('sh')} END"),
    ("kb", "CASE WHEN h <= 0 THEN 0e0 ELSE beam_h / (i0n * sin(h)) END"),
    ("fg", "sin(s) - s * cos(s) - pi() * sin(s / 2) * sin(s / 2)"),
    ("r_sky", "(1e0 + cos(s)) / 2"),
    ("aniso", "(0.00263e0 - 0.712e0 * kb - 0.6883e0 * kb * kb) * fg + r_sky"),
    ("fx", "CASE WHEN s = 0 THEN 1e0 WHEN lit = 0 OR sh <= 0 THEN r_sky + 0.252271e0 * fg WHEN h >= 0.1 THEN aniso * (1e0 - kb) + kb * sh / sin(h) ELSE aniso * (1e0 - kb) + kb * sin(s) * cos(az - asp) / (0.1e0 - 0.008e0 * h) END"),
    ("u", "CASE WHEN s = 0 THEN pi() / 2 ELSE sin(s) + (pi() - s - sin(s)) / (1e0 + cos(s)) END"),
    ("diffuse", "diffuse_h * fx * (1e0 - exp(-(4e0 / (3e0 * pi()) * u - 0.074e0 * u * u) / 0.155e0))"),
    ("v", "CASE WHEN s = 0 THEN 0e0 ELSE sin(s) + (s - sin(s)) / (1e0 - cos(s)) END"),
    ("reflected", "CASE WHEN s = 0 THEN 0e0 ELSE 0.2e0 * (beam_h + diffuse_h) * (1e0 - cos(s)) / 2 * (1e0 - exp(-(4e0 / (3e0 * pi()) * v - 0.074e0 * v * v) / 0.155e0)) END"),
    ("irr", "beam + diffuse + reflected"),
]
_LIT = [*_HORIZON, *_PLANE, ("sh", a.sin_incidence("lat", "decl", "t", "s", "asp")), ("linke", "3e0"), *IRRADIANCE]
_register("beam_diffuse", clock, CLOCK_SQL, _LIT, ["event_id", *_rounded(["beam", "diffuse", "reflected", "irr"], 4)])
_temps = [f"(5e0 + 8e0 * sin({i} * 0.785e0 - 1.5e0))" for i in range(8)]
_pick = lambda i: "CASE " + i + " " + " ".join(f"WHEN {k} THEN {t}" for k, t in enumerate(_temps)) + " END"
_TEMP = [("lon", "user_id % 5 - 3e0"), ("local", a.wrapped("hr - lon / 15e0", "24e0")), ("slot", "CAST(floor(local / 3e0) AS BIGINT) % 8"), ("temp", f"{_pick('slot')} + ({_pick('((slot + 1) % 8)')} - {_pick('slot')}) * (local / 3e0 - floor(local / 3e0))")]
_register("temperature_interpolation", clock, CLOCK_SQL, _TEMP, ["event_id", *_rounded(["local", "temp"])])
_register("module_efficiency", clock, CLOCK_SQL, [*_TEMP, ("eta", a.efficiency("value", "temp", a.SILICON))], ["event_id", *_rounded(["eta"])])


# Energy of a day: 96 steps of a quarter of an hour on 12 days, 32 orientations and 5 latitudes.
_DAY_STEPS = [("hr", "k * 0.25e0 + 0.125e0"), ("decl", a.declination("day")), ("t", a.hour_angle("hr")), ("sin_h", a.sin_altitude("lat", "decl", "t")), ("az", a.sun_azimuth("lat", "decl", "t")), ("h", "asin(least(1e0, greatest(-1e0, sin_h)))"), ("lit", "CASE WHEN h > 0 THEN 1 ELSE 0 END"), ("sh", a.sin_incidence("lat", "decl", "t", "s", "asp")), ("linke", "3e0"), *IRRADIANCE, ("eta", a.efficiency("irr", "10e0", a.SILICON)), ("wh", "CASE WHEN h > 0 THEN irr * eta * 0.25e0 ELSE 0e0 END")]
_DAYS = "CASE month " + " ".join(f"WHEN {m} THEN {d}" for m, d in enumerate(a.REPRESENTATIVE_DAYS, 1)) + " END"
_LENGTHS = "CASE month " + " ".join(f"WHEN {m} THEN {d}" for m, d in enumerate(a.MONTH_DAYS, 1)) + " END"


def _orientations(spark, sf_dir):
    """Sites' latitudes (by region) times orientations times days times steps; a fixed small number per region."""
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey", "radians(50e0 + 2e0 * r_regionkey) AS lat")
    return (
        region.selectExpr("*", "explode(sequence(0, 31)) AS o")
        .selectExpr("*", "explode(sequence(1, 12)) AS month")
        .selectExpr("*", "explode(sequence(0, 95)) AS k", "radians(floor(o / 8e0) * 30e0) AS s", "radians(o % 8 * 45e0) AS asp", f"{_DAYS} AS day")
    )


_ORIENTATIONS_SQL = f"""
    (SELECT r_regionkey, radians(50e0 + 2e0 * r_regionkey) AS lat, o, month, k, radians(floor(o / 8e0) * 30e0) AS s, radians(o % 8 * 45e0) AS asp, {_DAYS} AS day
     FROM region, range(0, 32) t1(o), range(1, 13) t2(month), range(0, 96) t3(k))
"""


def daily_energy(spark, sf_dir):
    steps = chain(_orientations(spark, sf_dir), _DAY_STEPS)
    return steps.groupBy("r_regionkey", "o", "month").agg({"wh": "sum"}).selectExpr("r_regionkey", "CAST(o AS BIGINT) AS orientation", "CAST(month AS BIGINT) AS month", "round(`sum(wh)`, 3) AS wh_day")


def annual_energy(spark, sf_dir):
    steps = chain(_orientations(spark, sf_dir), [*_DAY_STEPS, ("kwh", f"wh * {_LENGTHS} * 0.001e0")])
    return steps.groupBy("r_regionkey", "o").agg({"kwh": "sum"}).selectExpr("r_regionkey", "CAST(o AS BIGINT) AS orientation", "round(`sum(kwh)`, 3) AS kwh_year")


QUERIES |= {"daily_energy": daily_energy, "annual_energy": annual_energy}
SQL["daily_energy"] = f"SELECT r_regionkey, CAST(o AS BIGINT) AS orientation, CAST(month AS BIGINT) AS month, round(sum(wh), 3) AS wh_day FROM {chain_sql(_ORIENTATIONS_SQL, _DAY_STEPS)} GROUP BY r_regionkey, o, month"
SQL["annual_energy"] = f"SELECT r_regionkey, CAST(o AS BIGINT) AS orientation, round(sum(wh * {_LENGTHS} * 0.001e0), 3) AS kwh_year FROM {chain_sql(_ORIENTATIONS_SQL, _DAY_STEPS)} GROUP BY r_regionkey, o"
