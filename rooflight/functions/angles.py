"""Angles, slopes and the sun, as SQL expressions that whole-stage codegen compiles.

Every function takes and returns expression text, for ``selectExpr`` and ``expr``. Angles are radians
unless the name says degrees. Aspect is clockwise from north; horizons are counter-clockwise from east.
"""

from __future__ import annotations

#: Representative day of year of each month, and days of the month.
REPRESENTATIVE_DAYS = [17, 46, 75, 103, 135, 162, 198, 228, 259, 289, 319, 345]
MONTH_DAYS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
SYSTEM_LOSS = 0.14


def wrapped(x: str, turn: str = "360e0") -> str:
    """x modulo a turn, never negative."""
    return f"(({x}) - {turn} * floor(({x}) / {turn}))"


def slope_deg(a: str, b: str) -> str:
    return f"degrees(atan(sqrt(({a}) * ({a}) + ({b}) * ({b}))))"


def aspect_deg(a: str, b: str) -> str:
    return wrapped(f"degrees(atan2({b}, -({a})) + pi() / 2)")


def difference_deg(x: str, y: str) -> str:
    return f"least(abs(({x}) - ({y})), 360e0 - abs(({x}) - ({y})))"


def to_grass_aspect(compass: str) -> str:
    """Compass degrees to counter-clockwise from east, 0 (undefined) staying 0."""
    return f"CASE WHEN ({compass}) = 0 THEN 0e0 WHEN ({compass}) < 90 THEN 90e0 - ({compass}) ELSE 450e0 - ({compass}) END"


def declination(day: str) -> str:
    d = f"(2e0 * pi() * ({day}) / 365.25e0)"
    return f"asin(0.3978e0 * sin({d} - 1.4e0 + 0.0355e0 * sin({d} - 0.0489e0)))"


def extraterrestrial(day: str) -> str:
    return f"(1367e0 * (1e0 + 0.03344e0 * cos(2e0 * pi() * ({day}) / 365.25e0 - 0.048869e0)))"


def hour_angle(hour: str) -> str:
    return f"radians((({hour}) - 12e0) * 15e0)"


def sin_altitude(lat: str, decl: str, t: str) -> str:
    return f"(cos({lat}) * cos({decl}) * cos({t}) + sin({lat}) * sin({decl}))"


def sunrise(lat: str, decl: str) -> str:
    """Hour of sunrise, 0 on a polar day and 12 in a polar night."""
    p = f"(-(sin({lat}) * sin({decl})) / (cos({lat}) * cos({decl})))"
    return f"CASE WHEN {p} < -1 THEN 0e0 WHEN {p} > 1 THEN 12e0 ELSE (90e0 - degrees(acos(least(1e0, greatest(-1e0, {p}))))) / 15e0 + 6e0 END"


def sun_azimuth(lat: str, decl: str, t: str) -> str:
    """Clockwise from north; the eastern component x is negative after noon."""
    x = f"(-cos({decl}) * sin({t}))"
    y = f"(sin({lat}) * cos({decl}) * cos({t}) - cos({lat}) * sin({decl}))"
    a = f"acos(least(1e0, greatest(-1e0, -({y}) / sqrt(greatest(1e-18, {x} * {x} + {y} * {y})))))"
    return f"CASE WHEN {x} < 0 THEN 2e0 * pi() - {a} ELSE {a} END"


def sin_incidence(lat: str, decl: str, t: str, slope: str, aspect: str) -> str:
    """Sine of the sun's height over a plane with a compass aspect; negative is cut to 0."""
    body = (
        f"cos({slope}) * {sin_altitude(lat, decl, t)} + sin({slope}) * "
        f"(cos({aspect}) * (cos({lat}) * sin({decl}) - sin({lat}) * cos({decl}) * cos({t}))"
        f" - sin({aspect}) * cos({decl}) * sin({t}))"
    )
    return f"greatest(0e0, {body})"


def air_mass(h: str, z: str = "0e0") -> str:
    """Relative optical air mass at altitude h > 0, with refraction."""
    up = f"({h} + 0.061359e0 * (0.1594e0 + {h} * (1.123e0 + 0.065656e0 * {h})) / (1e0 + {h} * (28.9344e0 + 277.3971e0 * {h})))"
    return f"(exp(-({z}) / 8434.5e0) / (sin({up}) + 0.50572e0 * power(degrees({up}) + 6.07995e0, -1.6364e0)))"


def rayleigh(m: str) -> str:
    near = f"6.6296e0 + {m} * (1.7513e0 + {m} * (-0.1202e0 + {m} * (0.0065e0 - 0.00013e0 * {m})))"
    return f"CASE WHEN {m} <= 20 THEN 1e0 / ({near}) ELSE 1e0 / (10.4e0 + 0.718e0 * {m}) END"


def diffuse_altitude(sin_h: str, linke: str) -> str:
    """Diffuse share of the extraterrestrial irradiance: transmission at zenith times a function of altitude."""
    tn = f"(-0.015843e0 + {linke} * (0.030543e0 + 0.0003797e0 * {linke}))"
    a1 = f"(0.26463e0 - 0.061581e0 * {linke} + 0.0031408e0 * {linke} * {linke})"
    a1 = f"CASE WHEN {a1} * {tn} < 0.0022 THEN 0.0022e0 / {tn} ELSE {a1} END"
    a2 = f"(2.04020e0 + 0.018945e0 * {linke} - 0.011161e0 * {linke} * {linke})"
    a3 = f"(-1.3025e0 + 0.039231e0 * {linke} + 0.0085079e0 * {linke} * {linke})"
    return f"{tn} * (({a1}) + {a2} * {sin_h} + {a3} * {sin_h} * {sin_h})"


def angular_loss(s: str, a: str = "0.155e0") -> str:
    """Share of beam irradiance that enters a module at sine s over its plane."""
    return f"((1e0 - exp(-({s}) / {a})) / (1e0 - exp(-1e0 / {a})))"


def efficiency(g: str, temp: str, k: list[float]) -> str:
    """Relative efficiency of a module with eight coefficients at irradiance g and air temperature."""
    r, t = f"(({g}) / 1000e0)", f"(({g}) / 1000e0 * {k[7]!r} + ({temp}) - 25e0)"
    ln = f"ln({r})"
    body = f"({k[0]!r} + {ln} * ({k[1]!r} + {ln} * {k[2]!r}) + {t} * ({k[3]!r} + {ln} * ({k[4]!r} + {ln} * {k[5]!r}) + {k[6]!r} * {t})) / {k[0]!r}"
    return f"CASE WHEN ({g}) <= 0 THEN 0e0 ELSE {body} END"


#: Coefficients of crystalline silicon modules (Huld et al. 2011), the last the heating by irradiance.
SILICON = [1.0, -0.017162, -0.040289, -0.004681, 0.000148, 0.000169, 5e-06, 25.0]
#: Coefficients of the reference's two kinds of module, the last the heating by irradiance (degrees per W/m2).
CSI_TABLE = [1.000436, -0.017237, -0.040465, -0.004702, 0.000149, 0.000170, 0.000005, 0.035]
CDTE_TABLE = [0.999680, -0.103218, -0.040433, -0.001666, -0.002074, -0.001445, -0.000023, 0.035]
#: As ``efficiency`` takes them: heating per kW/m2.
CSI, CDTE = ([*t[:7], t[7] * 1000] for t in (CSI_TABLE, CDTE_TABLE))
