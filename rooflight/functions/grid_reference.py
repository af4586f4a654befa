"""National grid references as column expressions: letters for 500 km and 100 km squares, then digits."""

from __future__ import annotations

#: First letters by (500 km east, 500 km north), and the letters of a 5 x 5 square by rows from the north.
FIRST_LETTERS = {(0, 0): "S", (1, 0): "T", (0, 1): "N", (1, 1): "O", (0, 2): "H"}
SQUARE = "ABCDEFGHJKLMNOPQRSTUVWXYZ"


def first_letter(e: str, n: str) -> str:
    cases = " ".join(f"WHEN floor(({e}) / 500000e0) = {x} AND floor(({n}) / 500000e0) = {y} THEN '{c}'" for (x, y), c in FIRST_LETTERS.items())
    return f"CASE {cases} END"


def second_letter(e: str, n: str) -> str:
    row = f"(4 - CAST(floor(({n}) / 100000e0) AS BIGINT) % 5)"
    col = f"(CAST(floor(({e}) / 100000e0) AS BIGINT) % 5)"
    return f"substr('{SQUARE}', CAST({row} * 5 + {col} + 1 AS INT), 1)"


def _digits(x: str, unit: int, width: int) -> str:
    return f"lpad(CAST(CAST(floor(({x}) / {unit}e0) AS BIGINT) % {10**width} AS STRING), {width}, '0')"


def reference(e: str, n: str, size: int) -> str:
    """Reference of the square of ``size`` metres (100000, 10000, 5000 or 1000) that holds a point; null outside."""
    letters = f"({first_letter(e, n)} || {second_letter(e, n)}"
    if size == 100_000:
        return letters + ")"
    width = 2 if size == 1000 else 1
    unit = 1000 if size == 1000 else 10_000
    out = f"{letters} || {_digits(e, unit, width)} || {_digits(n, unit, width)}"
    if size == 5000:
        north = f"CASE WHEN CAST(floor(({n}) / 5000e0) AS BIGINT) % 2 = 1 THEN 'N' ELSE 'S' END"
        east = f"CASE WHEN CAST(floor(({e}) / 5000e0) AS BIGINT) % 2 = 1 THEN 'E' ELSE 'W' END"
        out += f" || {north} || {east}"
    return out + ")"


def parsed(ref: str) -> dict[str, str]:
    """Columns easting, northing and size of a reference of two letters, 2 or 4 digits and perhaps a quadrant; null if malformed."""
    ok = "regexp_like({0}, '^[STNOH][A-HJ-Z]([0-9]{{2}}|[0-9]{{4}})(SE|SW|NE|NW)?$')".format(ref)
    at = " ".join(f"WHEN '{c}' THEN {{{i}}}" for i, c in enumerate("STNOH"))
    east = f"CASE substr({ref}, 1, 1) " + at.format(*[x * 500_000 for (x, _), c in FIRST_LETTERS.items()]) + " END"
    north = f"CASE substr({ref}, 1, 1) " + at.format(*[y * 500_000 for (_, y), c in FIRST_LETTERS.items()]) + " END"
    k = f"(instr('{SQUARE}', substr({ref}, 2, 1)) - 1)"
    digits = f"regexp_extract(substr({ref}, 3), '^[0-9]+', 0)"
    half = f"CAST(length({digits}) / 2 AS INT)"
    unit = f"CASE {half} WHEN 1 THEN 10000 ELSE 1000 END"
    quad = f"substr({ref}, 3 + 2 * {half})"
    step = f"CAST(({unit}) / 2 AS INT)"
    e = f"{east} + {k} % 5 * 100000 + CAST(substr({digits}, 1, {half}) AS INT) * ({unit}) + CASE WHEN {quad} IN ('SE', 'NE') THEN {step} ELSE 0 END"
    n = f"{north} + (4 - CAST(floor({k} / 5e0) AS INT)) * 100000 + CAST(substr({digits}, 1 + {half}, {half}) AS INT) * ({unit}) + CASE WHEN {quad} IN ('NE', 'NW') THEN {step} ELSE 0 END"
    size = f"CASE WHEN {quad} = '' THEN ({unit}) ELSE {step} END"
    return {c: f"CASE WHEN {ok} THEN CAST({x} AS BIGINT) END" for c, x in (("easting", e), ("northing", n), ("size", size))}
