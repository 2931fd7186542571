"""What file and folder names say, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A well and site, e.g. A02_s1; a pair of identifiers between underscores; channels of files and of maps.
STUB = r"[A-H]([1-9]|[0][1-9]|[1][0-2])_s(\d{2}|\d{1})"
POSITION = r"_(\w\d+)_(\w\d+)_"
CHANNEL = "GFP|Texas Red|Cy5|phs"
MAP_KIND = "background|intensity"
MASK_ROLE = "instance|semantic"


def stub(name: Column) -> Column:
    """The first well-and-site in the name, '' if there is none."""
    return F.regexp_extract(name, STUB, 0)


def stubs(name: Column) -> Column:
    """Every well-and-site in the name that an underscore follows."""
    return F.regexp_extract_all(name, F.lit(f"({STUB})_"), F.lit(1))


def prefix(name: Column) -> Column:
    """What stands before the stub; '' without one."""
    found = stub(name)
    return F.when(found == "", F.lit("")).otherwise(F.split_part(name, found, F.lit(1)))


def position(name: Column) -> Column:
    """The second of the first pair of identifiers; dates before the well shift it."""
    return F.regexp_extract(name, POSITION, 2)


def channel(name: Column) -> Column:
    """Channel of an image file, phase for phs; null if the name says none."""
    found = F.regexp_extract(name, CHANNEL, 0)
    return F.when(found == "phs", F.lit("phase")).when(found != "", found)


def correction_map(name: Column) -> Column:
    """<channel>_<kind>_map of a correction map's file name; null for other files."""
    kind, of = F.regexp_extract(name, MAP_KIND, 0), F.regexp_extract(name, CHANNEL, 0)
    return F.when((kind != "") & (of != ""), F.concat_ws("_", of, kind, F.lit("map")))


def mask_role(name: Column) -> Column:
    found = F.regexp_extract(name, MASK_ROLE, 0)
    return F.when((found != "") & name.endswith(".tif"), found)


def is_inference(name: Column) -> Column:
    """Folders with results: the name holds _inference."""
    return name.contains("_inference")


def canonical_channel(name: str) -> str:
    """Texas_Red is accepted for Texas Red."""
    return name.replace("Texas_Red", "Texas Red")
