"""Road attributes as column expressions over a tag map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of road classes; a lower code is a more important road.
ROAD_CLASSES = {"Motorway": 0, "Trunk": 1, "Primary": 2, "Secondary": 3, "Tertiary": 4, "Residential": 5, "Unclassified": 6, "Service": 7, "Other": 8}
# Codes of forms of way.
FORMS_OF_WAY = {"Undefined": 0, "Motorway": 1, "MultipleCarriageway": 2, "SingleCarriageway": 3, "Roundabout": 4, "TrafficSquare": 5, "SlipRoad": 6, "Other": 7}
# Levels that are exported, each with all classes up to it.
LEVELS = (6, 4, 2, 0)
# Prefixes of the highway tag, tested in this order.
_PREFIXES = (("motorway", "Motorway"), ("trunk", "Trunk"), ("primary", "Primary"), ("secondary", "Secondary"), ("tertiary", "Tertiary"), ("unclassified", "Unclassified"), ("residential", "Residential"))
# Service tags whose roads are not service roads.
_MINOR_SERVICE = ("parking", "driveway", "drive-through")
_BLANKS = "".join(map(chr, range(0x21)))


def stripped(text: Column) -> Column:
    """Without leading and trailing blanks and control characters (all up to U+0020)."""
    return F.trim(text, F.lit(_BLANKS))


def tag(tags: Column, key: str) -> Column:
    """The tag in lower case without surrounding blanks, empty where absent."""
    return F.lower(stripped(F.coalesce(F.try_element_at(tags, F.lit(key)), F.lit(""))))


def is_highway(tags: Column) -> Column:
    return F.coalesce(F.map_contains_key(tags, "highway"), F.lit(False))


def road_class(tags: Column) -> Column:
    """Class code from the highway tag's prefix; parking aisles, driveways and the like are Other."""
    highway, service = tag(tags, "highway"), tag(tags, "service")
    minor = F.lit(False)
    for prefix in _MINOR_SERVICE:
        minor = minor | service.startswith(prefix)
    out = F.when(highway.startswith(_PREFIXES[0][0]), ROAD_CLASSES[_PREFIXES[0][1]])
    for prefix, name in _PREFIXES[1:]:
        out = out.when(highway.startswith(prefix), ROAD_CLASSES[name])
    out = out.when(highway.startswith("service"), F.when(minor, ROAD_CLASSES["Other"]).otherwise(ROAD_CLASSES["Service"]))
    return out.when(highway.startswith("living_street"), ROAD_CLASSES["Residential"]).otherwise(ROAD_CLASSES["Other"])


def is_roundabout(tags: Column) -> Column:
    return tag(tags, "junction") == "roundabout"


def is_one_way(tags: Column) -> Column:
    """By the oneway tag where it says yes or no; else motorways and roundabouts are."""
    told = tag(tags, "oneway")
    return F.when(told.isin("yes", "1", "true"), True).when(told.isin("no", "0", "false"), False).otherwise((tag(tags, "highway") == "motorway") | is_roundabout(tags))


def is_link(tags: Column) -> Column:
    return tag(tags, "highway").endswith("_link")


def way_name(tags: Column) -> Column:
    return stripped(F.coalesce(F.try_element_at(tags, F.lit("name")), F.lit("")))
