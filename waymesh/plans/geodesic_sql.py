"""Geodesics on the WGS-84 ellipsoid as SQL, by the classical series in the spherical longitude (Vincenty 1975), to
hold the numeric functions against: another method than theirs. For lines that are far from antipodal.
"""

from __future__ import annotations

# WGS-84.
_A, _F = "6378137.0::DOUBLE", "(1.0::DOUBLE / 298.257223563::DOUBLE)"
_B = f"({_A} * (1.0 - {_F}))"


def inverse(name: str, source: str, rounds: int = 8) -> str:
    """Table expressions that end in <name>: the rows of source (lon1, lat1, lon2, lat2, ...) with metres, azimuth1 and
    azimuth2 in radians, the angles sin0 (sine of the azimuth at the equator) and sigma1, and series_a, series_b."""
    out = f""",
{name}_0 AS MATERIALIZED (SELECT *, atan((1 - {_F}) * tan(radians(lat1))) AS u1, atan((1 - {_F}) * tan(radians(lat2))) AS u2, radians(lon2 - lon1) AS span, radians(lon2 - lon1) AS lam FROM {source}),
{name}_s0 AS MATERIALIZED (SELECT *, cos(u1) AS c1, sin(u1) AS s1, cos(u2) AS c2, sin(u2) AS s2 FROM {name}_0)"""
    for k in range(1, rounds + 2):
        out += f""",
{name}_a{k} AS MATERIALIZED (SELECT * EXCLUDE (lam), lam, sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss, s1 * s2 + c1 * c2 * cos(lam) AS cs FROM {name}_s{k - 1}),
{name}_b{k} AS MATERIALIZED (SELECT *, atan2(ss, cs) AS sg, c1 * c2 * sin(lam) / ss AS sa FROM {name}_a{k}),
{name}_c{k} AS MATERIALIZED (SELECT *, 1 - sa * sa AS ca2, CASE WHEN 1 - sa * sa < 1e-30 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS cm FROM {name}_b{k})"""
        if k <= rounds:
            out += f""",
{name}_d{k} AS MATERIALIZED (SELECT *, {_F} / 16 * ca2 * (4 + {_F} * (4 - 3 * ca2)) AS cc FROM {name}_c{k}),
{name}_s{k} AS MATERIALIZED (SELECT * EXCLUDE (lam, ss, cs, sg, sa, ca2, cm, cc), span + (1 - cc) * {_F} * sa * (sg + cc * ss * (cm + cc * cs * (2 * cm * cm - 1))) AS lam FROM {name}_d{k})"""
    last = f"{name}_c{rounds + 1}"
    return out + f""",
{name}_u AS MATERIALIZED (SELECT *, ca2 * (1 / pow(1 - {_F}, 2) - 1) AS uu FROM {last}),
{name}_e AS MATERIALIZED (SELECT *, 1 + uu / 16384 * (4096 + uu * (uu * (320 - 175 * uu) - 768)) AS series_a, uu / 1024 * (256 + uu * (uu * (74 - 47 * uu) - 128)) AS series_b FROM {name}_u),
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (u1, u2, span, lam, c1, s1, c2, s2, ss, cs, sg, sa, ca2, cm, uu),
    {_B} * series_a * (sg - series_b * ss * (cm + series_b / 4 * (cs * (2 * cm * cm - 1) - series_b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) AS metres,
    atan2(c2 * sin(lam), c1 * s2 - s1 * c2 * cos(lam)) AS azimuth1, atan2(c1 * sin(lam), c1 * s2 * cos(lam) - s1 * c2) AS azimuth2,
    sa AS sin0, atan2(s1, c1 * cos(atan2(c2 * sin(lam), c1 * s2 - s1 * c2 * cos(lam)))) AS sigma1
  FROM {name}_e)"""


def along(metres: str) -> str:
    """The arc on the auxiliary sphere that far along a row of ``inverse``; for short ways."""
    first = f"({metres} / ({_B} * series_a))"
    return f"({first} + series_b * sin({first}) * cos(2 * sigma1 + {first}))"


def azimuth_along(metres: str) -> str:
    """The azimuth in degrees, 0 to 360, that far along a row of ``inverse``; for short ways."""
    return degrees(f"atan2(sin0, sqrt(1 - sin0 * sin0) * cos(sigma1 + {along(metres)}))")


def degrees(radians: str) -> str:
    return f"(CASE WHEN {radians} < 0 THEN degrees({radians}) + 360 ELSE degrees({radians}) END)"


def direct(name: str, source: str, rounds: int = 8) -> str:
    """Table expressions that end in <name>: the rows of source (lon, lat, azimuth in degrees, metres, ...) with lon2,
    lat2 and azimuth2 (radians)."""
    out = f""",
{name}_0 AS MATERIALIZED (SELECT *, atan((1 - {_F}) * tan(radians(lat))) AS u1, sin(radians(azimuth)) AS sn, cos(radians(azimuth)) AS cn FROM {source}),
{name}_1 AS MATERIALIZED (SELECT *, cos(u1) AS c1, sin(u1) AS s1, cos(u1) * sn AS sa, atan2(tan(u1), cn) AS sigma1 FROM {name}_0),
{name}_2 AS MATERIALIZED (SELECT *, 1 - sa * sa AS ca2, (1 - sa * sa) * (1 / pow(1 - {_F}, 2) - 1) AS uu FROM {name}_1),
{name}_3 AS MATERIALIZED (SELECT *, 1 + uu / 16384 * (4096 + uu * (uu * (320 - 175 * uu) - 768)) AS aa, uu / 1024 * (256 + uu * (uu * (74 - 47 * uu) - 128)) AS bb FROM {name}_2),
{name}_s0 AS MATERIALIZED (SELECT *, metres / ({_B} * aa) AS sg FROM {name}_3)"""
    for k in range(1, rounds + 1):
        out += f""",
{name}_c{k} AS MATERIALIZED (SELECT *, cos(2 * sigma1 + sg) AS cm, sin(sg) AS ss, cos(sg) AS cs FROM {name}_s{k - 1}),
{name}_s{k} AS MATERIALIZED (SELECT * EXCLUDE (cm, ss, cs, sg), metres / ({_B} * aa) + bb * ss * (cm + bb / 4 * (cs * (2 * cm * cm - 1) - bb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))) AS sg FROM {name}_c{k})"""
    return out + f""",
{name}_f AS MATERIALIZED (SELECT *, cos(2 * sigma1 + sg) AS cm, sin(sg) AS ss, cos(sg) AS cs, {_F} / 16 * ca2 * (4 + {_F} * (4 - 3 * ca2)) AS cc FROM {name}_s{rounds}),
{name}_g AS MATERIALIZED (SELECT *, atan2(ss * sn, c1 * cs - s1 * ss * cn) AS lam FROM {name}_f),
{name} AS MATERIALIZED (
  SELECT * EXCLUDE (u1, sn, cn, c1, s1, sa, sigma1, ca2, uu, aa, bb, sg, cm, ss, cs, cc, lam),
    degrees(atan2(s1 * cs + c1 * ss * cn, (1 - {_F}) * sqrt(sa * sa + pow(s1 * ss - c1 * cs * cn, 2)))) AS lat2,
    lon + degrees(lam - (1 - cc) * {_F} * sa * (sg + cc * ss * (cm + cc * cs * (2 * cm * cm - 1)))) AS lon2,
    atan2(sa, c1 * cs * cn - s1 * ss) AS azimuth2
  FROM {name}_g)"""
