"""National grid coordinates to longitude and latitude, as SQL expressions.

The inverse transverse Mercator series on the Airy ellipsoid, then the seven-parameter shift to WGS84.
The shift is a few metres off where the national grid's correction tables would be exact.
"""

from __future__ import annotations

import math

# Airy 1830 and WGS84 half axes (m); the grid's scale, true origin (degrees) and false origin (m).
AIRY = (6377563.396, 6356256.909)
WGS84 = (6378137.0, 6356752.314245)
SCALE, LATITUDE_0, LONGITUDE_0, EASTING_0, NORTHING_0 = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0
# Shift from the Airy datum to WGS84, in metres, seconds of arc, and parts per million.
SHIFT, TURN, STRETCH = (446.448, -125.157, 542.060), (0.1502, 0.2470, 0.8421), -20.4894
_ROUNDS = 5


def _n(x: float) -> str:
    return f"{x:.17e}"


def _eccentricity(axes: tuple[float, float]) -> float:
    return 1 - (axes[1] / axes[0]) ** 2


def inverse_mercator(easting: str, northing: str) -> list[tuple[str, str]]:
    """Steps whose last two, ``lat0`` and ``lon0``, are in radians on the Airy ellipsoid."""
    a, b = (x * SCALE for x in AIRY)
    n, e2, start = (a - b) / (a + b), _eccentricity(AIRY), math.radians(LATITUDE_0)
    terms = (1 + n + 1.25 * n**2 + 1.25 * n**3, 3 * n + 3 * n**2 + 2.625 * n**3, 1.875 * (n**2 + n**3), 35 / 24 * n**3)
    steps = [("north", f"{northing} - {_n(NORTHING_0)}"), ("east", f"{easting} - {_n(EASTING_0)}"), ("phi0", f"{_n(start)} + north / {_n(a)}")]
    for i in range(_ROUNDS):
        less, more = f"(phi{i} - {_n(start)})", f"(phi{i} + {_n(start)})"
        waves = "".join(f" {'-' if k % 2 else '+'} {_n(terms[k])} * sin({k} * {less}) * cos({k} * {more})" for k in (1, 2, 3))
        steps += [(f"arc{i}", f"{_n(b)} * ({_n(terms[0])} * {less}{waves})"), (f"phi{i + 1}", f"phi{i} + (north - arc{i}) / {_n(a)}")]
    phi = f"phi{_ROUNDS}"
    steps += [
        ("bend", f"1 - {_n(e2)} * power(sin({phi}), 2)"),
        ("nu", f"{_n(a)} / sqrt(bend)"),
        ("ratio", f"bend / {_n(1 - e2)}"),  # of the two radii of curvature
        ("t", f"tan({phi})"),
        ("d", "east / nu"),
        ("lat0", f"{phi} - t * ratio * (power(d, 2) / 2 - power(d, 4) / 24 * (5 + 3 * t * t + (ratio - 1) * (1 - 9 * t * t)) + power(d, 6) / 720 * (61 + 90 * t * t + 45 * power(t, 4)))"),
        ("lon0", f"{_n(math.radians(LONGITUDE_0))} + (d - power(d, 3) / 6 * (ratio + 2 * t * t) + power(d, 5) / 120 * (5 + 28 * t * t + 24 * power(t, 4)) - power(d, 7) / 5040 * (61 + 662 * t * t + 1320 * power(t, 4) + 720 * power(t, 6))) / cos({phi})"),
    ]
    return steps


def to_wgs84(lat: str, lon: str) -> list[tuple[str, str]]:
    """Steps from radians on the Airy ellipsoid to ``lat`` and ``lon``, degrees on WGS84."""
    rx, ry, rz = (math.radians(x / 3600) for x in TURN)
    k, e2, e2_new = 1 + STRETCH * 1e-6, _eccentricity(AIRY), _eccentricity(WGS84)
    steps = [
        ("r", f"{_n(AIRY[0])} / sqrt(1 - {_n(e2)} * power(sin({lat}), 2))"),
        ("x0", f"r * cos({lat}) * cos({lon})"),
        ("y0", f"r * cos({lat}) * sin({lon})"),
        ("z0", f"r * {_n(1 - e2)} * sin({lat})"),
        ("x1", f"{_n(SHIFT[0])} + {_n(k)} * x0 - {_n(rz)} * y0 + {_n(ry)} * z0"),
        ("y1", f"{_n(SHIFT[1])} + {_n(rz)} * x0 + {_n(k)} * y0 - {_n(rx)} * z0"),
        ("z1", f"{_n(SHIFT[2])} - {_n(ry)} * x0 + {_n(rx)} * y0 + {_n(k)} * z0"),
        ("p", "sqrt(x1 * x1 + y1 * y1)"),
        ("turn0", f"atan2(z1, p * {_n(1 - e2_new)})"),
    ]
    for i in range(_ROUNDS):
        steps.append((f"turn{i + 1}", f"atan2(z1 + {_n(e2_new * WGS84[0])} * sin(turn{i}) / sqrt(1 - {_n(e2_new)} * power(sin(turn{i}), 2)), p)"))
    return [*steps, ("lat", f"degrees(turn{_ROUNDS})"), ("lon", "degrees(atan2(y1, x1))")]
