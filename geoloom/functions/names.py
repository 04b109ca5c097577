"""Tile ids, file names, titles and addresses as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE = r"x=(\d+), y=(\d+), z=(\d+)"


def parse_tile_id(tile: Column) -> Column:
    """(t, x, y, z) of an id (x, y, z) or (t, x, y, z); null where it isn't one of whole numbers."""
    parts = F.split(F.regexp_replace(tile, r"[() ]", ""), ",")
    number = lambda k: F.get(parts, k).try_cast("int")
    four = F.size(parts) == 4
    first = F.when(four, 1).otherwise(0)
    whole = F.forall(parts, lambda p: p.try_cast("int").isNotNull()) & F.size(parts).isin(3, 4)
    found = F.struct(F.when(four, number(F.lit(0))).alias("t"), number(first).alias("x"), number(first + 1).alias("y"), number(first + 2).alias("z"))
    return F.when(whole, found)


def file_to_id(name: Column) -> Column:
    """z_x_y gives (x, y, z), t_z_x_y gives (t, x, y, z); another number of parts gives null."""
    stem = F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]*$", "")
    p = F.split(stem, "_")
    three = F.concat(F.lit("("), p[1], F.lit(", "), p[2], F.lit(", "), p[0], F.lit(")"))
    four = F.concat(F.lit("("), p[0], F.lit(", "), p[2], F.lit(", "), p[3], F.lit(", "), p[1], F.lit(")"))
    return F.when(F.size(p) == 3, three).when(F.size(p) == 4, four)


def title_to_id(title: Column, year: Column | None = None) -> Column:
    """The id of a title with x=.., y=.., z=.., after a year if there is one; null if the title has none."""
    part = [F.regexp_extract(title, TITLE, k) for k in (1, 2, 3)]
    lead = F.lit("(") if year is None else F.concat(F.lit("("), year.cast("string"), F.lit(", "))
    return F.when(title.rlike(TITLE), F.concat(lead, F.concat_ws(", ", *part), F.lit(")")))


def box_name(number: Column, x: Column, y: Column) -> Column:
    """The file name of a box: its number and the whole coordinates of its lower left corner, halves to the even side."""
    return F.format_string("%s_%d_%d.tif", number.cast("string"), F.bround(x).cast("long"), F.bround(y).cast("long"))


def tile_file(x: Column, y: Column, z: Column, suffix: Column, year: Column | None = None) -> Column:
    """z_x_y.suffix, after a year if there is one."""
    return F.concat(F.concat_ws("_", *(c.cast("string") for c in ((year,) if year is not None else ()) + (z, x, y))), F.lit("."), suffix)


def image_format(url: Column) -> Column:
    """png, jpg or tif, whichever an address names first in this order; null if none."""
    u = F.lower(url)
    return F.when(u.contains("png"), "png").when(u.contains("jpg") | u.contains("jpeg"), "jpg").when(u.contains("tif"), "tif")


def fill_address(template: str, **values: Column) -> Column:
    """A template with {x}, {y}, {z} or {year} filled from columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def destination(name: Column, dataset: Column) -> Column:
    """Where a file below a folder for all images goes for its set: all becomes the set's name in the folders, not in the file."""
    file = F.substring_index(name, "/", -1)
    folders = F.substring(name, F.lit(1), F.length(name) - F.length(file))
    return F.concat(F.replace(folders, F.lit("all"), dataset), file)


def captured(seconds: Column) -> Column:
    """Seconds since 1970 as a date and time in ISO form, in UTC whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
