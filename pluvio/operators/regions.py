"""The exact region of a coordinate: ray casting behind an equi join on grid cells.

A region is a set of rings (outer borders, islands, lakes), each an array of
(latitude, longitude) corners. ``region_index`` covers every region with grid
cells. A cell that no border touches lies wholly inside a region or is left
out; a cell on a border carries the border segments of its latitude band, and
only points there are tested. So a point meets the few regions of its own
cell, by an equi join, and the test is a column expression.

A point is inside a region if a ray to the east crosses its rings an odd
number of times. Segments are directed from south to north before they are
compared, and hold their southern end but not their northern one: of two
regions that share a border, a point on it belongs to exactly one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_ROWS, rows_at_most

#: An index is broadcast with at most so many border segments (32 bytes each).
BROADCAST_SEGMENTS = 2_000_000
#: Cells this far (in cells) beside a border count as touched by it, so that rounding never loses one.
MARGIN = 1e-9


def border_segments(regions: DataFrame, region: str = "state_name", ring: str = "ring") -> DataFrame:
    """(region, y1, x1, y2, x2): the sides of every ring, from south to north;
    the last corner is joined to the first. Null and NaN corners are left out."""
    corner = lambda c: c["latitude"].isNotNull() & c["longitude"].isNotNull() & ~F.isnan(
        c["latitude"]) & ~F.isnan(c["longitude"])
    corners = regions.select(F.col(region).alias("region"), F.filter(F.col(ring), corner).alias("c"))
    after = F.concat(F.slice("c", 2, F.size("c")), F.slice("c", 1, 1))
    sides = corners.where(F.size("c") > 0).select("region", F.explode(F.arrays_zip(
        F.col("c").alias("a"), after.alias("b"))).alias("s"))
    a, b = (F.struct(F.col(f"s.{end}.latitude").cast("double").alias("y"),
                     F.col(f"s.{end}.longitude").cast("double").alias("x")) for end in "ab")
    low, high = F.least(a, b), F.greatest(a, b)
    return sides.select("region", low["y"].alias("y1"), low["x"].alias("x1"), high["y"].alias("y2"), high["x"].alias("x2"))


def inside(segments: Column, y: Column, x: Column) -> Column:
    """Whether a ray to the east of (y, x) crosses an odd number of ``segments``."""
    def crossed(s: Column) -> Column:
        at = (s["x2"] - s["x1"]) * (y - s["y1"]) / F.nullif(s["y2"] - s["y1"], F.lit(0.0)) + s["x1"]
        return (s["y1"] <= y) & (y < s["y2"]) & (x < at)

    return F.size(F.filter(segments, crossed)) % 2 == 1


def region_index(regions: DataFrame, resolution: float = 1.0, region: str = "state_name", ring: str = "ring") -> DataFrame:
    """(cell_lat, cell_lon, found): per grid cell its regions, as structs of
    ``region`` and ``segments`` (null where the cell lies wholly inside).

    A finer resolution means more cells and fewer segments in each. The index
    is a table to be written once and joined often.
    """
    res = F.lit(float(resolution))
    cell = lambda v: F.floor(v / res).cast("int")
    banded = border_segments(regions, region, ring).withColumn(
        "cell_lat", F.explode(F.sequence(cell(F.col("y1")), cell(F.col("y2")))))
    # where the segment runs inside its band
    slope = (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    ends = [F.col("x1") + slope * (edge - F.col("y1")) for edge in (
        F.greatest("y1", F.col("cell_lat") * res), F.least("y2", (F.col("cell_lat") + 1) * res))]
    west, east = (F.coalesce(pick(*ends), other) for pick, other in (
        (F.least, F.least("x1", "x2")), (F.greatest, F.greatest("x1", "x2"))))
    edge = lambda v, by: F.floor(v / res + by).cast("int")
    spans = banded.withColumns({"first": edge(west, -MARGIN), "last": edge(east, MARGIN)})
    bands = spans.groupBy("region", "cell_lat").agg(
        F.collect_list(F.struct("y1", "x1", "y2", "x2")).alias("segments"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.collect_set(F.struct("first", "last")).alias("touched"))
    cells = bands.select("*", F.explode(F.sequence("first", "last")).alias("cell_lon"))
    on_border = F.exists("touched", lambda t: F.col("cell_lon").between(t["first"], t["last"]))
    middle = inside(F.col("segments"), (F.col("cell_lat") + 0.5) * res, (F.col("cell_lon") + 0.5) * res)
    return (cells.withColumn("border", on_border).where(F.col("border") | middle)
            .groupBy("cell_lat", "cell_lon").agg(F.collect_list(F.struct(
                "region", F.when(F.col("border"), F.col("segments")).alias("segments"))).alias("found")))


def _bounded(index: DataFrame, max_rows: int, max_segments: int) -> DataFrame:
    """The index with a broadcast hint, if its rows and its segments are proven few."""
    if not rows_at_most(index, max_rows):
        return index
    sizes = F.transform("found", lambda f: F.coalesce(F.size(f["segments"]), F.lit(0)))
    total = index.agg(F.sum(F.aggregate(sizes, F.lit(0), lambda a, b: a + b))).first()[0] or 0
    return F.broadcast(index) if total <= max_segments else index


def assign_region(points: DataFrame, index: DataFrame, resolution: float = 1.0, lat: str = "latitude",
                  lon: str = "longitude", out: str = "state_name", max_rows: int = DEFAULT_BROADCAST_ROWS,
                  max_segments: int = BROADCAST_SEGMENTS) -> DataFrame:
    """``points`` with the region that holds each one, exactly; NULL where none does.

    Where regions overlap the smallest name wins, so a point stays one row.
    A NULL or NaN coordinate is in no region. ``index`` must be of the same
    resolution. It is broadcast if its size is proven small, else joined on the cell.
    """
    res = F.lit(float(resolution))
    keyed = points.withColumns({
        "_cell_lat": F.floor(F.nanvl(F.col(lat).cast("double"), F.lit(None)) / res).cast("int"),
        "_cell_lon": F.floor(F.nanvl(F.col(lon).cast("double"), F.lit(None)) / res).cast("int")})
    cells = _bounded(index, max_rows, max_segments).select(
        F.col("cell_lat").alias("_cell_lat"), F.col("cell_lon").alias("_cell_lon"), F.col("found").alias("_found"))
    joined = keyed.join(cells, ["_cell_lat", "_cell_lon"], "left")
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    holds = F.filter("_found", lambda f: f["segments"].isNull() | inside(f["segments"], y, x))
    return joined.withColumn(out, F.array_min(F.transform(holds, lambda f: f["region"]))).drop(
        "_cell_lat", "_cell_lon", "_found")
