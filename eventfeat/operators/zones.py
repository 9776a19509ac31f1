"""The zone that contains a point (polygons with holes, date line).

Zone borders are cut into the tiles of a grid once.  Tiles that no border touches belong
to a zone in whole, so their points need an equi-join only; in a border tile a point is
compared with the few border pieces inside the tile.  No point meets a whole polygon, and
no point x zone product exists.

Inside means an odd number of border crossings to the east, so rings of one zone that lie
in each other are holes and islands in turn.  A point on a western or southern border is
inside, one on an eastern or northern border is not: neighbours share no point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: place of a tile's reference column inside the tile; away from round coordinates
REFERENCE = 0.4867513
#: widening of a border piece, in degrees, so that rounding never misses a tile
MARGIN = 1e-9


def zone_edges(vertices: DataFrame, zone_id: str = "zone_id", ring: str = "ring", seq: str = "seq", lat: str = "lat",
               lon: str = "lon") -> DataFrame:
    """``zone_id, x1, y1, x2, y2``: the closed rings of a vertex table as edges, with
    longitudes that run on over the date line.

    Two neighbouring vertices more than 180 degrees apart (but not 360, the seam of a map
    drawn from -180 to 180) are joined the short way.  A ring's first vertex need not be
    repeated at its end.  Rows with a null coordinate are left out."""
    v = vertices.select(F.col(zone_id).alias("zone_id"), F.col(ring).alias("ring"), F.col(seq).alias("seq"),
                        F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x")).dropna(subset=["x", "y"])
    w = Window.partitionBy("zone_id", "ring").orderBy("seq")
    step = F.col("x") - F.lag("x").over(w)
    turn = F.when((F.abs(step) > 180) & (F.abs(step) < 360), -360 * F.signum(step)).otherwise(0.0)
    v = v.withColumn("turn", F.coalesce(turn, F.lit(0.0)))
    v = v.withColumn("x", F.col("x") + F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = w.rowsBetween(Window.unboundedPreceding, 0)
    nx, ny = F.lead("x").over(w), F.lead("y").over(w)
    e = v.select("zone_id", F.col("x").alias("x1"), F.col("y").alias("y1"),
                 F.coalesce(nx, F.first("x").over(first)).alias("x2"), F.coalesce(ny, F.first("y").over(first)).alias("y2"))
    return e.filter("x1 <> x2 OR y1 <> y2")


def _east(x: Column, y: Column, e) -> Column:
    """Whether the ray from ``(x, y)`` to the east crosses edge ``e``."""
    cut = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    return F.when((e["y1"] <= y) != (e["y2"] <= y), x < cut).otherwise(F.lit(False))


def _north(x: Column, y: Column, e) -> Column:
    """Whether the ray from ``(x, y)`` to the north crosses edge ``e``; on the edge itself,
    a point counts as a little to the east."""
    slope = (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])
    cut = e["y1"] + (x - e["x1"]) * slope
    return F.when((e["x1"] <= x) != (e["x2"] <= x), (y < cut) | ((y == cut) & (slope > 0))).otherwise(F.lit(False))


def _odd(edges: Column, test) -> Column:
    return F.size(F.filter(edges, test)) % 2 == 1


def zone_tiles(edges: DataFrame, cell_deg: float = 1.0) -> DataFrame:
    """``row, col, shift, zone_id, inside, edges``: the tiles of each zone.  ``edges`` are
    the border pieces that touch the tile (none: the whole tile is inside), ``inside`` says
    whether the tile's reference point is, and a point's longitude plus ``360 * shift`` is
    in the zone's running longitudes."""
    n = round(360 / cell_deg)
    if abs(n * cell_deg - 360) > 1e-9:
        raise ValueError("cell_deg must divide 360")
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = F.sequence(F.floor((lo + 90 - MARGIN) / cell_deg), F.floor((hi + 90 + MARGIN) / cell_deg))
    e = edges.withColumn("edge", F.struct("x1", "y1", "x2", "y2")).withColumn("row", F.explode(rows))
    # the piece of the edge inside the row of tiles
    flat = F.col("y1") == F.col("y2")
    along = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    bottom, top = F.greatest(lo, F.col("row") * cell_deg - 90), F.least(hi, (F.col("row") + 1) * cell_deg - 90)
    xa = F.when(flat, F.col("x1")).otherwise(F.col("x1") + (bottom - F.col("y1")) * along)
    xb = F.when(flat, F.col("x2")).otherwise(F.col("x1") + (top - F.col("y1")) * along)
    e = e.withColumn("from", F.floor((F.least(xa, xb) + 180 - MARGIN) / cell_deg)).withColumn(
        "to", F.floor((F.greatest(xa, xb) + 180 + MARGIN) / cell_deg)).select("zone_id", "row", "from", "to", "edge")
    border = e.select("zone_id", "row", F.explode(F.sequence("from", "to")).alias("c"), "edge").groupBy("zone_id", "row", "c").agg(
        F.collect_list("edge").alias("edges"))
    # all tiles between the first and last border tile of a row, with the crossings to the
    # east of their reference points: one join of a zone's tiles with its edges of one row
    spans = e.groupBy("zone_id", "row").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    tiles = spans.select("zone_id", "row", F.explode(F.sequence("from", "to")).alias("c"))
    rx, ry = (F.col("c") + REFERENCE) * cell_deg - 180, (F.col("row") + REFERENCE) * cell_deg - 90
    crossed = tiles.join(e.select("zone_id", "row", "edge"), ["zone_id", "row"]).groupBy("zone_id", "row", "c").agg(
        (F.count_if(_east(rx, ry, F.col("edge"))) % 2 == 1).alias("inside"))
    none = F.expr("CAST(array() AS array<struct<x1:double,y1:double,x2:double,y2:double>>)")
    out = crossed.join(border, ["zone_id", "row", "c"], "left").filter("inside OR edges IS NOT NULL")
    return out.select("row", F.pmod("c", F.lit(n)).alias("col"), F.floor(F.col("c") / n).alias("shift"), "zone_id", "inside",
                      F.coalesce("edges", none).alias("edges"))


def zone_containing(points: DataFrame, vertices: DataFrame, lat: str, lon: str, zone_id: str = "zone_id", ring: str = "ring",
                    seq: str = "seq", zone_lat: str = "lat", zone_lon: str = "lon", zone_cols: Sequence[str] = (),
                    cell_deg: float = 1.0) -> DataFrame:
    """J11 by containment: ``points`` with ``zone_id`` and ``zone_cols`` of the zone that
    holds them, the least ``zone_id`` where zones overlap, NULL outside of all.

    ``vertices`` has one row per ring vertex; ``zone_cols`` are equal in all rows of a
    zone.  One output row per input row; NULL, NaN and impossible coordinates have no
    zone; longitudes of any turn count (190 is -170)."""
    tiles = zone_tiles(zone_edges(vertices, zone_id, ring, seq, zone_lat, zone_lon), cell_deg)
    n = round(360 / cell_deg)
    x = F.pmod(F.col(lon).cast("double") + 180, F.lit(360.0)) - 180
    pts = points.withColumn("_x", x).withColumn("_y", F.col(lat).cast("double"))
    ok = F.col("_y").between(-90, 90) & F.col("_x").between(-180, 180)
    # each place once, however many rows are there; rows without a place keep their own row
    places = pts.select("_x", "_y").filter(ok).distinct()
    places = places.withColumn("row", F.floor((F.col("_y") + 90) / cell_deg)).withColumn(
        "col", F.least(F.floor((F.col("_x") + 180) / cell_deg), F.lit(n - 1)))
    j = places.join(tiles, ["row", "col"]).withColumn("_u", F.col("_x") + 360 * F.col("shift"))
    rx = (F.col("col") + n * F.col("shift") + REFERENCE) * cell_deg - 180
    ry = (F.col("row") + REFERENCE) * cell_deg - 90
    # from the point along its row of tiles to the reference column, then along that column
    # to the reference point: only edges of this tile can lie between
    west = _odd(F.col("edges"), lambda e: _east(F.col("_u"), F.col("_y"), e) != _east(rx, F.col("_y"), e))
    south = _odd(F.col("edges"), lambda e: _north(rx, F.col("_y"), e) != _north(rx, ry, e))
    inside = F.when(F.size("edges") == 0, F.col("inside")).otherwise((F.col("inside") != west) != south)
    found = j.filter(inside).groupBy("_x", "_y").agg(F.min("zone_id").alias("_zone"))
    names = vertices.select(F.col(zone_id).alias("_zone"), *zone_cols).dropDuplicates(["_zone"])
    found = found.join(names, "_zone").select("_x", "_y", F.struct(F.col("_zone").alias(zone_id), *zone_cols).alias("_best"))
    out = pts.join(found, ["_x", "_y"], "left")
    return out.select(*points.columns, *[F.col("_best")[c].alias(c) for c in [zone_id, *zone_cols]])
