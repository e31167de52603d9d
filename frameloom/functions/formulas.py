"""Formulas that read the same in Spark SQL and in DuckDB, as text; F.expr turns one into a column."""

from __future__ import annotations


def angular_separation(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Great-circle distance in degrees (haversine)."""
    h = f"power(sin(radians(({dec2}) - ({dec1})) / 2), 2) + cos(radians({dec1})) * cos(radians({dec2})) * power(sin(radians(({ra2}) - ({ra1})) / 2), 2)"
    return f"(2 * degrees(asin(sqrt(least(1.0, {h})))))"


def wrap(angle: str) -> str:
    return f"(({angle}) - 360 * floor(({angle}) / 360))"


def galactic(ra: str, dec: str) -> tuple[str, str]:
    """l, b; pole at 192.85948, 27.12825 and node at 122.93192 (J2000)."""
    ap, dp, node = "radians(192.85948)", "radians(27.12825)", "122.93192"
    a, d = f"radians({ra})", f"radians({dec})"
    b = f"degrees(asin(least(1.0, greatest(-1.0, sin({dp}) * sin({d}) + cos({dp}) * cos({d}) * cos({a} - {ap})))))"
    lon = f"{node} - degrees(atan2(cos({d}) * sin({a} - {ap}), cos({dp}) * sin({d}) - sin({dp}) * cos({d}) * cos({a} - {ap})))"
    return wrap(lon), b


def ecliptic(ra: str, dec: str, jd: str) -> tuple[str, str]:
    """Longitude (with general precession from J2000) and latitude, by the mean obliquity of the date."""
    t = f"((({jd}) - 2451545.0) / 36525)"
    eps = f"radians(23.4392911 - 0.0130042 * {t})"
    a, d = f"radians({ra})", f"radians({dec})"
    lon = f"degrees(atan2(sin({a}) * cos({eps}) + sin({d}) / greatest(cos({d}), 1e-12) * sin({eps}), cos({a}))) + 1.396971 * {t}"
    lat = f"degrees(asin(least(1.0, greatest(-1.0, sin({d}) * cos({eps}) - cos({d}) * sin({eps}) * sin({a})))))"
    return wrap(lon), lat


def sun(jd: str) -> tuple[str, str]:
    """Right ascension and declination, low precision."""
    n = f"(({jd}) - 2451545.0)"
    g = f"radians(357.529 + 0.98560028 * {n})"
    lon = f"radians(280.459 + 0.98564736 * {n} + 1.915 * sin({g}) + 0.020 * sin(2 * {g}))"
    eps = f"radians(23.439 - 0.00000036 * {n})"
    return wrap(f"degrees(atan2(cos({eps}) * sin({lon}), cos({lon})))"), f"degrees(asin(sin({eps}) * sin({lon})))"


def moon(jd: str) -> tuple[str, str]:
    """Right ascension and declination from the largest terms of the lunar series, geocentric."""
    t = f"((({jd}) - 2451545.0) / 36525)"
    s = lambda a, b: f"sin(radians({a} + {b} * {t}))"
    lon = f"radians(218.32 + 481267.883 * {t} + 6.29 * {s(134.9, 477198.85)} - 1.27 * {s(259.2, -413335.38)} + 0.66 * {s(235.7, 890534.23)} + 0.21 * {s(269.9, 954397.70)} - 0.19 * {s(357.5, 35999.05)} - 0.11 * {s(186.6, 966404.05)})"
    lat = f"radians(5.13 * {s(93.3, 483202.03)} + 0.28 * {s(228.2, 960400.87)} - 0.28 * {s(318.3, 6003.18)} - 0.17 * {s(217.6, -407332.20)})"
    eps = "radians(23.4393)"
    y = f"(cos({eps}) * cos({lat}) * sin({lon}) - sin({eps}) * sin({lat}))"
    z = f"(sin({eps}) * cos({lat}) * sin({lon}) + cos({eps}) * sin({lat}))"
    return wrap(f"degrees(atan2({y}, cos({lat}) * cos({lon})))"), f"degrees(asin(least(1.0, greatest(-1.0, {z}))))"


def alt_az(ra: str, dec: str, lat: str, lon: str, jd: str) -> tuple[str, str]:
    """Altitude and azimuth (from north through east), without refraction."""
    gmst = f"(280.46061837 + 360.98564736629 * (({jd}) - 2451545.0))"
    h = f"radians({wrap(f'{gmst} + ({lon}) - ({ra})')})"
    d, p = f"radians({dec})", f"radians({lat})"
    alt = f"degrees(asin(least(1.0, greatest(-1.0, sin({p}) * sin({d}) + cos({p}) * cos({d}) * cos({h})))))"
    az = wrap(f"degrees(atan2(-cos({d}) * sin({h}), sin({d}) * cos({p}) - cos({d}) * cos({h}) * sin({p})))")
    return alt, az


def sky_to_pixel(ra: str, dec: str, ra0: str, dec0: str, scale: str, x0: str, y0: str) -> tuple[str, str]:
    """Tangent plane about (ra0, dec0); scale in degrees per pixel, x against right ascension."""
    d, d0, da = f"radians({dec})", f"radians({dec0})", f"radians(({ra}) - ({ra0}))"
    c = f"(sin({d0}) * sin({d}) + cos({d0}) * cos({d}) * cos({da}))"
    xi = f"degrees(cos({d}) * sin({da}) / {c})"
    eta = f"degrees((cos({d0}) * sin({d}) - sin({d0}) * cos({d}) * cos({da})) / {c})"
    return f"(({x0}) - {xi} / ({scale}))", f"(({y0}) + {eta} / ({scale}))"


def pixel_to_sky(x: str, y: str, ra0: str, dec0: str, scale: str, x0: str, y0: str) -> tuple[str, str]:
    xi, eta, d0 = f"radians((({x0}) - ({x})) * ({scale}))", f"radians((({y}) - ({y0})) * ({scale}))", f"radians({dec0})"
    den = f"(cos({d0}) - {eta} * sin({d0}))"
    ra = wrap(f"({ra0}) + degrees(atan2({xi}, {den}))")
    dec = f"degrees(atan2(sin({d0}) + {eta} * cos({d0}), sqrt({xi} * {xi} + {den} * {den})))"
    return ra, dec


def tile_index(at: str, size: int, tile: int = 500) -> str:
    """The tile of a coordinate; the last tile takes what is left over."""
    return f"cast(least(floor(({at}) / {tile}), {max(size // tile, 1) - 1}) AS int)"


def tile_bounds(i: str, size: int, tile: int = 500) -> tuple[str, str]:
    """First and past-the-last coordinate of a tile."""
    n = max(size // tile, 1)
    return f"(({i}) * {tile})", f"(CASE WHEN ({i}) = {n - 1} THEN {size} ELSE (({i}) + 1) * {tile} END)"


def pixel_error(v: str, gain: float = 18.69, noise: float = 3.7) -> str:
    return f"sqrt(greatest({v}, 0) / {gain}e0 + power({noise}e0 / {gain}e0, 2))"


def julian_date(us: str) -> str:
    return f"(cast({us} AS double) / 86400000000 + 2440587.5e0)"


def disc_corner(x: str, y: str, r: float | str) -> str:
    """Signed area of the disc of radius r (a number, or SQL) about 0 between 0 and x and between 0 and y."""
    rr = f"({r} * {r})" if isinstance(r, str) else f"{r * r}e0"
    r = r if isinstance(r, str) else f"{r}e0"
    a, b = f"least(abs({x}), {r})", f"least(abs({y}), {r})"
    start = f"sqrt(greatest({rr} - {b} * {b}, 0e0))"
    under = lambda u: f"(0.5e0 * ({u} * sqrt(greatest({rr} - {u} * {u}, 0e0)) + {rr} * asin(least({u} / {r}, 1e0))))"
    return f"(sign({x}) * sign({y}) * CASE WHEN {a} * {a} + {b} * {b} <= {rr} THEN {a} * {b} ELSE {start} * {b} + {under(a)} - {under(start)} END)"


def disc_share(dx: str, dy: str, r: float | str) -> str:
    """Area of the unit pixel at dx, dy from the centre that the disc covers."""
    lo, hi = (lambda v: f"({v} - 0.5e0)"), (lambda v: f"({v} + 0.5e0)")
    c = lambda x, y: disc_corner(x, y, r)
    return f"({c(hi(dx), hi(dy))} - {c(lo(dx), hi(dy))} - {c(hi(dx), lo(dy))} + {c(lo(dx), lo(dy))})"
