"""Hexagonal cells of the sphere: a hierarchy of aperture 7 on the faces of an icosahedron, with
64-bit cell ids as used by public geospatial tools (16 resolutions, 122 base cells).

A point is projected from the sphere's centre onto the plane of its nearest face and rounded to the
hexagon lattice of the wanted resolution.  Going up one resolution at a time gives a digit per level
(the child's direction from its parent's centre) and finally a base cell.  Neighbouring faces see a
base cell from other sides; its digits are turned into the orientation of the face it is filed under.

All of it is Column arithmetic over constants that this module derives: no Python runs per row.
Lattice coordinates (a, b) count steps along the first two of three axes 120 degrees apart.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published grid: latitude and longitude of each face's centre, and the azimuth
# of its first axis there, in radians.
FACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882),
    (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055),
    (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400),
    (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874),
    (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154),
    (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562),
    (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361),
    (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535),
    (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316),
    (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436),
    (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)

# The face and lattice coordinates (i, j, k) under which each base cell is filed, in
# the order of their numbers.
BASE_CELLS = """
1 100, 2 110, 1 000, 2 100, 0 200, 1 110, 1 001, 2 000, 0 100, 2 010,
1 010, 1 011, 3 100, 3 110, 11 200, 4 100, 0 000, 6 010, 0 001, 2 011,
7 001, 2 001, 0 110, 6 001, 10 200, 6 000, 3 000, 11 100, 4 110, 3 010,
0 011, 4 000, 5 010, 0 010, 7 010, 11 110, 7 000, 10 100, 12 200, 6 101,
7 101, 4 001, 3 001, 3 011, 4 010, 6 100, 11 000, 8 001, 5 001, 14 200,
5 000, 12 100, 10 110, 4 011, 12 110, 7 100, 11 010, 10 000, 13 200, 10 001,
11 001, 9 010, 8 010, 6 200, 8 000, 9 001, 14 100, 5 101, 16 011, 8 101,
5 100, 12 000, 7 200, 12 010, 10 010, 9 000, 13 100, 16 001, 15 011, 15 010,
16 010, 14 110, 13 110, 5 200, 8 100, 14 000, 9 101, 14 001, 17 001, 12 001,
16 000, 17 011, 15 001, 16 101, 9 100, 15 000, 13 000, 8 200, 13 010, 17 101,
19 010, 14 010, 19 011, 17 010, 13 001, 17 000, 16 100, 9 200, 15 101, 15 100,
18 011, 18 001, 19 001, 17 100, 19 000, 18 010, 18 101, 19 200, 19 100, 18 000,
19 101, 18 100
"""

# Pentagons, and the two faces (if any) at which their missing direction is closed
# clockwise.
PENTAGONS = {
    4: (), 14: (2, 6), 24: (1, 5), 38: (3, 7), 49: (0, 9), 58: (4, 8),
    63: (11, 15), 72: (12, 16), 83: (10, 19), 97: (13, 17), 107: (14, 18), 117: (),
}

Vector = tuple[float, float, float]

_UNIT = (3 - math.sqrt(5)) / 2  # lattice step of resolution 0 on a face's plane
_TURN = math.asin(math.sqrt(3 / 28))  # between the lattices of neighbouring resolutions
_SIN60 = math.sqrt(3) / 2
MAX_RESOLUTION = 15


def _dot(a: Vector, b: Vector) -> float:
    return sum(x * y for x, y in zip(a, b, strict=True))


def _point(lat: float, lon: float) -> Vector:
    return (math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat))


@cache
def face_frame(face: int) -> tuple[Vector, Vector, Vector]:
    """Centre of a face and the directions of its plane's x axis (the first lattice axis) and y axis."""
    lat, lon, azimuth = FACES[face]
    north = (-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat))
    east = (-math.sin(lon), math.cos(lon), 0.0)
    sine, cosine = math.sin(azimuth), math.cos(azimuth)
    x = tuple(cosine * n + sine * e for n, e in zip(north, east, strict=True))
    y = tuple(sine * n - cosine * e for n, e in zip(north, east, strict=True))
    return _point(lat, lon), x, y


def _on_plane(a: int, b: int) -> complex:
    return complex(a - b / 2, b * _SIN60)


def _on_sphere(face: int, place: complex) -> Vector:
    centre, x, y = face_frame(face)
    v = [c + _UNIT * (place.real * p + place.imag * q) for c, p, q in zip(centre, x, y, strict=True)]
    size = math.sqrt(_dot(v, v))
    return tuple(c / size for c in v)


#: Corners of every face, two lattice steps along each axis, in counter-clockwise order.
_CORNERS = (_on_plane(2, 0), _on_plane(0, 2), _on_plane(-2, -2))


@cache
def _neighbours(face: int) -> list[tuple[int, complex, complex]]:
    """Over each edge (from corner n to corner n + 1): the next face, and the motion of the plane
    (turn, shift) that continues this face's lattice on that one's."""
    out = []
    points = [_on_sphere(face, c) for c in _CORNERS]
    for n in range(3):
        ends = (points[n], points[(n + 1) % 3])
        for other in range(20):
            at = [_on_sphere(other, c) for c in _CORNERS]
            match = [[m for m in range(3) if _dot(e, at[m]) > 1 - 1e-9] for e in ends]
            if other != face and all(match):
                start, end = _CORNERS[match[0][0]], _CORNERS[match[1][0]]
                turn = (end - start) / (_CORNERS[(n + 1) % 3] - _CORNERS[n])
                out.append((other, turn, start - turn * _CORNERS[n]))
    return out


def _axial(place: complex) -> tuple[int, int]:
    b = round(place.imag / _SIN60)
    return round(place.real + b / 2), b


def _inside(place: complex) -> bool:
    """Whether a place lies in a face's triangle or on its edge."""
    return all(
        ((end - start).conjugate() * (place - start)).imag > -1e-9
        for start, end in zip(_CORNERS, (*_CORNERS[1:], _CORNERS[0]), strict=True)
    )


def _turns(turn: complex) -> int:
    return round(math.degrees(math.atan2(turn.imag, turn.real)) / 60)


@cache
def filed() -> list[tuple[int, int, int]]:
    """Face and lattice coordinates of every base cell."""
    out = []
    for entry in BASE_CELLS.replace("\n", " ").split(","):
        face, ijk = entry.split()
        i, j, k = map(int, ijk)
        out.append((int(face), i - k, j - k))
    return out


def _corner_turns(cell: int, face: int, place: complex) -> int:
    """Turns inside of a pentagon from a face whose corner it is to the face it is filed under.

    Five faces meet, and five of the six directions exist there.  Counter-clockwise from the filing
    face, the directions to the faces' middles are 3, 5, 4, 6 and 2.  As the face itself sees it, its
    middle lies at 3, 5 or 6 from its three corners: places 0, 1 and 3 of that list."""
    home, a, b = filed()[cell]
    centre = _on_sphere(home, _on_plane(a, b))
    first = face_frame(home)[0]
    x = tuple(p - _dot(first, centre) * q for p, q in zip(first, centre, strict=True))
    y = (
        centre[1] * x[2] - centre[2] * x[1],
        centre[2] * x[0] - centre[0] * x[2],
        centre[0] * x[1] - centre[1] * x[0],
    )
    to = face_frame(face)[0]
    step = round(math.degrees(math.atan2(_dot(to, y), _dot(to, x))) / 72)
    corner = min(range(3), key=lambda n: abs(_CORNERS[n] - place))
    return (step - (0, 1, 3)[corner]) % 5


@cache
def base_cell(face: int, i: int, j: int, k: int) -> tuple[int, int] | None:
    """(base cell, turns of 60 degrees) that a face's lattice place stands for, or None if it is too
    far outside.  A place beyond an edge is first continued on the next face; then the cell is
    looked up among those filed under the faces around it.  The motions on the way add up to the
    turns, except at a pentagon (see ``_corner_turns``)."""
    place, turned, here = _on_plane(i - k, j - k), 0, face
    if not _inside(place):
        for other, turn, shift in _neighbours(face):
            there = turn * place + shift
            if _inside(there):
                place, turned, here = there, _turns(turn), other
                break
        else:
            return None
    known = {cell: n for n, cell in enumerate(filed())}
    # Walk around the cell's corner or over its edge, both ways, to the face that it is filed under.
    seen, queue = {here}, [(here, place, turned)]
    for where, at, turns in queue:
        number = known.get((where, *_axial(at)))
        if number in PENTAGONS:
            return number, (turned + _corner_turns(number, here, place)) % 5
        if number is not None:
            return number, turns % 6
        for other, turn, shift in _neighbours(where):
            there = turn * at + shift
            if _inside(there) and other not in seen:
                seen.add(other)
                queue.append((other, there, turns + _turns(turn)))
    raise ValueError("a base cell is missing")


# ---- Columns -------------------------------------------------------------------------------------

#: Directions counter-clockwise; a digit is 4, 2 and 1 for a step along the three axes.
_AROUND = (1, 5, 4, 6, 2, 3)


def turned(digit: int, turns: int) -> int:
    return _AROUND[(_AROUND.index(digit) + turns) % 6] if digit else 0


def pentagon_turns(turns: int, lead: int, clockwise: bool) -> int:
    """Turns of all digits in a pentagon, where direction 1 is missing: whenever the leading digit
    comes to point there, the digits are turned once more."""
    total = 0
    if lead == 1:
        total = -1 if clockwise else 1
    for _ in range(turns):
        total += 2 if turned(lead, total + 1) == 1 else 1
    return total % 6


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def _pair(a: Column, b: Column, **more: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"), *[c.alias(n) for n, c in more.items()])


def _third(x: Column) -> Column:
    """The third coordinate of a lattice step without negative coordinates."""
    return F.greatest(F.lit(0).cast("long"), -x["a"], -x["b"])


def _constants(values, kind: str) -> Column:
    """An array of constants as one short expression, which the optimizer folds; plans stay small."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _face(v: Column) -> Column:
    """Nearest face (n) and its centre's closeness (d) to a unit vector."""
    centres = _constants([x for n in range(20) for x in face_frame(n)[0]], "double")

    def closeness(n: Column) -> Column:
        along = sum(F.get(centres, n * 3 + m) * v[c] for m, c in enumerate("xyz"))
        return F.struct(along.alias("d"), (-n).alias("n"))

    nearest = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(19)), closeness))
    return _let(nearest, lambda f: F.struct(f["d"].alias("d"), (-f["n"]).alias("n")))


def _projected(v: Column, face: Column, resolution: int) -> Column:
    """Real lattice coordinates on the face's plane."""
    axes = _constants([x for n in range(20) for axis in face_frame(n)[1:] for x in axis], "double")

    def along(first: int) -> Column:
        return sum(F.get(axes, face["n"] * 6 + first + m) * v[c] for m, c in enumerate("xyz")) / face["d"]

    size = math.sqrt(7) ** resolution / _UNIT
    turn = _TURN if resolution % 2 else 0.0
    sine, cosine = math.sin(turn) * size, math.cos(turn) * size
    plane = F.struct(along(0).alias("x"), along(3).alias("y"))
    turned_plane = _let(plane, lambda p: F.struct((p["x"] * cosine + p["y"] * sine).alias("x"), ((p["y"] * cosine - p["x"] * sine) / _SIN60).alias("b")))
    return _let(turned_plane, lambda p: _pair(p["x"] + p["b"] / 2, p["b"]))


def _rounded(p: Column) -> Column:
    """The nearest lattice point: round all three differences, and correct the one that is worst."""
    near = F.struct(F.rint(p["a"]).alias("a"), F.rint(p["b"]).alias("b"), F.rint(p["a"] - p["b"]).alias("c"))

    def corrected(n: Column) -> Column:
        off_a, off_b = F.abs(n["a"] - p["a"]), F.abs(n["b"] - p["b"])
        off_c = F.abs(n["c"] - (p["a"] - p["b"]))
        worst_a = (off_a > off_b) & (off_a > off_c)
        worst_b = ~worst_a & (off_b > off_c)
        a = F.when(worst_a, n["b"] + n["c"]).otherwise(n["a"])
        b = F.when(worst_b, n["a"] - n["c"]).otherwise(n["b"])
        return _pair(a.cast("long"), b.cast("long"))

    return _let(near, corrected)


def _seventh(x: Column) -> Column:
    return F.floor(x / 7.0 + 0.5)


def _eights() -> Column:
    return _constants([8**n for n in range(MAX_RESOLUTION)], "bigint")


def _up(s: Column, level: Column) -> Column:
    """One level up: the parent's place, and the child's direction from it as this level's digit."""
    odd = level % 2
    parent = _pair(
        _seventh(s["a"] * (2 + odd) + s["b"] * (1 - 2 * odd)),
        _seventh(s["a"] * (2 * odd - 1) + s["b"] * (3 - odd)),
    )

    def told(p: Column) -> Column:
        away = _pair(
            s["a"] - (p["a"] * (3 - odd) + p["b"] * (2 * odd - 1)),
            s["b"] - (p["a"] * (1 - 2 * odd) + p["b"] * (2 + odd)),
        )
        digit = _let(away, lambda d: d["a"] * 4 + d["b"] * 2 + _third(d) * 7)
        place = F.get(_eights(), F.lit(MAX_RESOLUTION) - level)
        return _let(
            digit,
            lambda n: _pair(
                p["a"], p["b"], digits=s["digits"] + n * place, lead=F.when(n != 0, n).otherwise(s["lead"])
            ),
        )

    return _let(parent, told)


@cache
def _tables() -> dict[str, list[int]]:
    """Base cells and turns by face and place, pentagons, and total turns inside pentagons."""
    places = [base_cell(f, i, j, k) for f in range(20) for i in range(3) for j in range(3) for k in range(3)]
    closed = [[*PENTAGONS.get(n, ()), -1, -1][:2] for n in range(122)]
    inside = [
        pentagon_turns(turns, lead, clockwise) for turns in range(6) for lead in range(7) for clockwise in (False, True)
    ]
    return {
        "cell": [p[0] for p in places],
        "turns": [p[1] for p in places],
        "pentagon": [int(n in PENTAGONS) for n in range(122)],
        "closed": [x for pair in closed for x in pair],
        "inside": inside,
        "digit": [turned(d, t) for t in range(6) for d in range(7)],
    }


def hex_id(lat: Column, lon: Column, resolution: int = 7) -> Column:
    """64-bit id of the cell that holds a point in degrees; NULL for a missing or infinite point."""
    if not 0 <= resolution <= MAX_RESOLUTION:
        raise ValueError(f"resolutions are 0 to {MAX_RESOLUTION}")
    table = {name: _constants(values, "int") for name, values in _tables().items()}

    def located(p: Column) -> Column:
        flat = F.cos(p["lat"])
        v = F.struct((flat * F.cos(p["lon"])).alias("x"), (flat * F.sin(p["lon"])).alias("y"), F.sin(p["lat"]).alias("z"))
        return _let(v, lambda v: _let(_face(v), lambda f: cell_of(v, f)))

    def cell_of(v: Column, face: Column) -> Column:
        zero = F.lit(0).cast("long")
        place = _let(_projected(v, face, resolution), _rounded)
        state = _let(place, lambda p: _pair(p["a"], p["b"], digits=zero, lead=zero))
        if resolution:
            state = F.reduce(F.sequence(F.lit(resolution), F.lit(1)), state, _up)
        return _let(state, lambda s: named(s, face))

    def named(s: Column, face: Column) -> Column:
        at = (face["n"] * 27 + s["a"] * 9 + s["b"] * 3 + _third(s) * 13).cast("int")
        found = F.struct(F.get(table["cell"], at).alias("cell"), F.get(table["turns"], at).alias("turns"))
        return _let(found, lambda c: written(s, face, c))

    def written(s: Column, face: Column, c: Column) -> Column:
        closed = F.array_contains(F.slice(table["closed"], c["cell"] * 2 + 1, 2), face["n"])
        inside = F.get(table["inside"], ((c["turns"] * 7 + s["lead"]) * 2 + closed.cast("int")).cast("int"))
        turns = F.when(F.get(table["pentagon"], c["cell"]) == 1, inside).otherwise(c["turns"])
        head = (1 << 59) | (resolution << 52)
        head += sum(7 << 3 * (MAX_RESOLUTION - level) for level in range(resolution + 1, MAX_RESOLUTION + 1))

        def whole(t: Column) -> Column:
            def with_digit(out: Column, level: Column) -> Column:
                place = F.get(_eights(), F.lit(MAX_RESOLUTION) - level)
                digit = F.floor(s["digits"] / place) % 8
                return out + F.get(table["digit"], (t * 7 + digit).cast("int")) * place

            out = F.lit(head) + F.shiftleft(c["cell"].cast("long"), 45)
            return F.reduce(F.sequence(F.lit(1), F.lit(resolution)), out, with_digit) if resolution else out

        return _let(turns, whole)

    finite = F.abs(lat) + F.abs(lon) < float("inf")
    point = F.struct(F.radians(lat).alias("lat"), F.radians(lon).alias("lon"))
    return F.when(finite, _let(point, located))


def with_hex_id(rows: DataFrame, name: str, lat: str, lon: str, resolution: int = 7) -> DataFrame:
    """``rows`` with ``hex_id`` of their points as a column, for tables of many rows.

    The same steps as plain columns that build on each other: Spark compiles them, while it interprets
    the functions that let ``hex_id`` be one expression.  The last step is a generator of one row, so no
    condition on the id is moved below the steps, which would repeat them inside of it."""
    if not 0 <= resolution <= MAX_RESOLUTION:
        raise ValueError(f"resolutions are 0 to {MAX_RESOLUTION}")
    table = {n: _constants(values, "int") for n, values in _tables().items()}
    own, made, steps = rows.columns, rows, []
    prefix = "_hex"
    while any(c.lower().startswith(prefix) for c in own):
        prefix += "_"

    def col(n: str) -> Column:
        return F.col(prefix + n)

    def add(**columns: Column) -> None:
        nonlocal made
        steps.append([c.alias(prefix + n) for n, c in columns.items()])
        # Columns of one select may name each other; Spark resolves so many such steps at once.
        if len(steps) == 16:
            made = made.select("*", *sum(steps, []))
            steps.clear()

    def dot(first, columns: str = "xyz") -> Column:
        return sum(first(m) * col(c) for m, c in enumerate(columns))

    finite = F.abs(F.col(lat)) + F.abs(F.col(lon)) < float("inf")
    add(lat=F.when(finite, F.radians(F.col(lat))), lon=F.when(finite, F.radians(F.col(lon))))
    add(flat=F.cos(col("lat")), z=F.sin(col("lat")))
    add(x=col("flat") * F.cos(col("lon")), y=col("flat") * F.sin(col("lon")))

    # The nearest face, the first of equally near ones.
    add(**{f"d{n}": dot(lambda m, n=n: F.lit(face_frame(n)[0][m])) for n in range(20)})
    add(d=F.greatest(*[col(f"d{n}") for n in range(20)]))
    add(face=F.coalesce(*[F.when(col(f"d{n}") == col("d"), F.lit(n)) for n in range(20)]))

    # Real lattice coordinates on its plane, and the nearest lattice point.
    axes = _constants([x for n in range(20) for axis in face_frame(n)[1:] for x in axis], "double")
    size = math.sqrt(7) ** resolution / _UNIT
    turn = _TURN if resolution % 2 else 0.0
    sine, cosine = math.sin(turn) * size, math.cos(turn) * size
    add(**{c: dot(lambda m, k=k: F.get(axes, col("face") * 6 + k + m)) / col("d") for c, k in (("px", 0), ("py", 3))})
    add(tx=col("px") * cosine + col("py") * sine, tb=(col("py") * cosine - col("px") * sine) / _SIN60)
    add(ta=col("tx") + col("tb") / 2)
    add(ra=F.rint(col("ta")), rb=F.rint(col("tb")), rc=F.rint(col("ta") - col("tb")))
    off = {"oa": F.abs(col("ra") - col("ta")), "ob": F.abs(col("rb") - col("tb"))}
    add(**off, oc=F.abs(col("rc") - (col("ta") - col("tb"))))
    worst_a = (col("oa") > col("ob")) & (col("oa") > col("oc"))
    worst_b = ~worst_a & (col("ob") > col("oc"))
    a = F.when(worst_a, col("rb") + col("rc")).otherwise(col("ra")).cast("long")
    b = F.when(worst_b, col("ra") - col("rc")).otherwise(col("rb")).cast("long")
    at = f"{resolution}"
    add(**{f"a{at}": a, f"b{at}": b})

    # Up to resolution 0: a digit per level, as ``_up`` has them.
    for level in range(resolution, 0, -1):
        odd, up = level % 2, level - 1
        a, b = col(f"a{level}"), col(f"b{level}")
        add(
            **{
                f"a{up}": _seventh(a * (2 + odd) + b * (1 - 2 * odd)),
                f"b{up}": _seventh(a * (2 * odd - 1) + b * (3 - odd)),
            }
        )
        p, q = col(f"a{up}"), col(f"b{up}")
        add(
            **{
                f"i{level}": a - (p * (3 - odd) + q * (2 * odd - 1)),
                f"j{level}": b - (p * (1 - 2 * odd) + q * (2 + odd)),
            }
        )
        i, j = col(f"i{level}"), col(f"j{level}")
        add(**{f"n{level}": i * 4 + j * 2 + F.greatest(F.lit(0).cast("long"), -i, -j) * 7})

    # The base cell, the turns of its digits and the id.
    levels = range(1, resolution + 1)
    third = F.greatest(F.lit(0).cast("long"), -col("a0"), -col("b0"))
    lead = [F.when(col(f"n{n}") != 0, col(f"n{n}")) for n in levels]
    add(
        place=(col("face") * 27 + col("a0") * 9 + col("b0") * 3 + third * 13).cast("int"),
        lead=F.coalesce(*lead, F.lit(0).cast("long")),
    )
    add(cell=F.get(table["cell"], col("place")), turns=F.get(table["turns"], col("place")))
    closed = [F.get(table["closed"], col("cell") * 2 + n) == col("face") for n in (0, 1)]
    add(closed=(closed[0] | closed[1]).cast("int"))
    inside = F.get(table["inside"], ((col("turns") * 7 + col("lead")) * 2 + col("closed")).cast("int"))
    add(turned=F.when(F.get(table["pentagon"], col("cell")) == 1, inside).otherwise(col("turns")))
    head = (1 << 59) | (resolution << 52)
    head += sum(7 << 3 * (MAX_RESOLUTION - level) for level in range(resolution + 1, MAX_RESOLUTION + 1))
    out = F.lit(head) + F.shiftleft(col("cell").cast("long"), 45)
    for level in levels:
        digit = F.get(table["digit"], (col("turned") * 7 + col(f"n{level}")).cast("int"))
        out = out + digit.cast("long") * F.lit(8 ** (MAX_RESOLUTION - level))
    kept = [c for c in own if c != name]
    made = made.select("*", *sum(steps, []))
    return made.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(F.struct(out.alias(name)))))


def with_hex_cell(rows: DataFrame, name: str, lat: str, lon: str, resolution: int = 7) -> DataFrame:
    """``rows`` with ``hex_cell`` of their points as a column."""
    return with_hex_id(rows, name, lat, lon, resolution).withColumn(name, F.lower(F.hex(F.col(name))))


def hex_cell(lat: Column, lon: Column, resolution: int = 7) -> Column:
    """Text form of ``hex_id``: 15 hexadecimal digits."""
    return F.lower(F.hex(hex_id(lat, lon, resolution)))


def hex_parent(cell: Column, resolution: int) -> Column:
    """The cell of a coarser resolution that a 64-bit id is filed under."""
    unused = sum(7 << 3 * (MAX_RESOLUTION - level) for level in range(resolution + 1, MAX_RESOLUTION + 1))
    kept = cell.bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(F.lit(resolution << 52))
    return F.when(F.shiftright(cell, 52).bitwiseAND(F.lit(15)) >= resolution, kept.bitwiseOR(F.lit(unused)))
