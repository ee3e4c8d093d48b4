"""Nearest neighbours on the plane.

Points are hashed into square cells; a point looks into its own cell and the eight around it. A neighbour
found there is certain if it is no farther than the nearest border of those nine cells. What isn't certain
looks again in cells four times as wide, until the cells are as wide as the map, where everything is in sight.
Every join is an equi-join on cells, and no side has to fit into one task. The first cells are so narrow
that the right side's points are spread thinly over them, and points at one place are looked up once.
Distances are planar, longitudes shortened by the cosine of a mean latitude.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from .tables import kept, only_row, zero_filled

#: Points that a point of the right side shares its first cell with, on average, and halvings of the map tried.
SHARED, HALVINGS = 4, 24
#: Parts a crowded place is cut into.
PARTS = 64


def longitude_scale(points: DataFrame, lat: str = "lat") -> DataFrame:
    """One row: cosine of the unweighted mean latitude."""
    return points.agg(F.cos(F.radians(F.avg(lat))).alias("scale"))


def _placed(points: DataFrame, scale: DataFrame, key: str, lon: str, lat: str) -> DataFrame:
    return only_row(points, scale).select(F.col(key), (F.col(lon) * F.col("scale")).alias("x"), F.col(lat).alias("y"))


def _first_cell(there: DataFrame, extent: float) -> float:
    """The widest cell, of the map's width halved again and again, in which points have few neighbours. Only
    counts of cells are looked at, and not at every width: wider cells never hold fewer, so halving the choice finds it."""
    cell = extent / 2.0**HALVINGS
    wide = lambda c, level: F.shiftright(F.floor(F.col(c) / cell), level)
    few, many = 0, HALVINGS + 1
    while many - few > 1:
        level = (few + many) // 2
        counts = there.groupBy(wide("rx", level).alias("x"), wide("ry", level).alias("y")).agg(F.count(F.lit(1)).alias("n"))
        shared = counts.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0]
        few, many = (level, many) if shared <= SHARED else (few, level)
    return cell * 2.0**few


def nearest_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, scale: DataFrame, cell: float | None = None, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """(left_key, right_key): the nearest right point of every left point, ties to the smaller key. Points
    without coordinates have no place and take no part; without right points there is nothing to find.
    Each level is kept, as the next level and the result both read it."""
    placed = _placed(left, scale, left_key, lon, lat).dropna(subset=["x", "y"])
    there = _placed(right, scale, right_key, lon, lat).dropna(subset=["x", "y"])
    there = kept(there.groupBy(F.col("x").alias("rx"), F.col("y").alias("ry")).agg(F.min(right_key).alias(right_key)))
    todo = kept(placed.select("x", "y").distinct())
    ends = todo.unionByName(there.select(F.col("rx").alias("x"), F.col("ry").alias("y")))
    if there.isEmpty():
        return placed.join(there.select(right_key), F.lit(False)).select(left_key, right_key)
    b = ends.agg(*(f(c).alias(f"{n}{c}") for c in ("x", "y") for n, f in (("least_", F.min), ("most_", F.max)))).first()
    extent = max(b.most_x - b.least_x, b.most_y - b.least_y)
    size = cell or _first_cell(there, extent or 1.0)
    out = None
    while True:
        last = size >= extent
        column = lambda c: F.floor(F.col(c) / size)
        around = F.explode(F.array(*(F.lit(i).cast("long") for i in (-1, 0, 1))))
        asked = todo.withColumn("dx", around).withColumn("dy", around)
        asked = asked.withColumn("cx", column("x") + F.col("dx")).withColumn("cy", column("y") + F.col("dy"))
        held = there.withColumn("cx", column("rx")).withColumn("cy", column("ry"))
        d2 = (F.col("x") - F.col("rx")) ** 2 + (F.col("y") - F.col("ry")) ** 2
        near = F.when(F.col(right_key).isNotNull(), F.struct(d2.alias("d2"), F.col(right_key)))
        best = asked.join(held, ["cx", "cy"], "left").groupBy("x", "y").agg(F.min(near).alias("best"))
        border = F.least(*(F.col(c) - (column(c) - 1) * size for c in ("x", "y")), *((column(c) + 2) * size - F.col(c) for c in ("x", "y")))
        sure = F.col("best").isNotNull() & (F.lit(last) | (F.sqrt("best.d2") <= border))
        seen = kept(best.withColumn("sure", sure))
        found = seen.filter("sure").select("x", "y", F.col(f"best.{right_key}").alias(right_key))
        out = found if out is None else out.unionByName(found)
        todo, size = seen.filter("NOT sure").select("x", "y"), size * 4.0
        if last or todo.isEmpty():
            return placed.join(out, ["x", "y"]).select(left_key, right_key)


def capacity_by_cluster(workplaces: DataFrame, radios: DataFrame, clusters: DataFrame, cell: float | None = None) -> DataFrame:
    """cluster, capacity: every workplace's capacity at the cluster of its nearest radio, 0 where none is. Without
    radios or clusters that is an error.

    workplaces: workplace, lon, lat, capacity; radios: radio, lon, lat, cluster; clusters: cluster."""
    if radios.isEmpty() or clusters.isEmpty():
        raise ValueError("Workplaces need radios and clusters to go to")
    near = nearest_join(workplaces, radios, "workplace", "radio", longitude_scale(radios), cell)
    facts = workplaces.join(near, "workplace").join(radios.select("radio", "cluster"), "radio")
    return zero_filled(clusters, facts, "cluster", "capacity", "capacity")


def _few_at_one_place(points: DataFrame, key: str, k: int) -> DataFrame:
    """Of points at one place the k with the least keys, as no others can be among anyone's k nearest. A crowded
    place is cut by parts first."""
    part = F.pmod(F.xxhash64(key), F.lit(PARTS))
    least = lambda rows, *by: rows.withColumn("_n", F.row_number().over(Window.partitionBy("lon", "lat", *by).orderBy(key))).filter(F.col("_n") <= k).drop("_n")
    return least(least(points.withColumn("_part", part), "_part")).drop("_part")


def nearest_k(asked: DataFrame, held: DataFrame, k: int, key: str, other: str, scale: DataFrame) -> DataFrame:
    """key, other, d2: for each point of ``asked`` (key, lon, lat) the k nearest of ``held`` (other, lon, lat), all if
    there are fewer; ties go to the smaller ``other``. d2 is the planar distance in square kilometres.

    Cells of all widths, each half of the next, are counted. The least cell around a place that holds k points
    gives the k-th best distance as a bound, and the second look is at just the other cells of that width which
    a circle of that radius meets, a ring of two at most. Both looks are equi-joins on cells, so rows follow k, not
    the number of points. Points at one place are asked once; points without coordinates take no part."""
    flat = lambda df, name: only_row(df.select(F.col(name), "lon", "lat").dropna(subset=["lon", "lat"]), scale).withColumn("x", F.col("lon") * F.col("scale") * geo.KM_PER_DEGREE).withColumn("y", F.col("lat") * geo.KM_PER_DEGREE)
    there = kept(_few_at_one_place(flat(held, other), other, k))
    here = flat(asked, key)
    places = here.groupBy("lon", "lat").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.first("scale").alias("scale"))
    box = there.agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{n}{c}") for c in ("x", "y") for n, f in (("least_", F.min), ("most_", F.max)))).first()
    if not box.n:
        return here.join(there.select(other), F.lit(False)).select(key, other, F.lit(0.0).alias("d2"))
    # The widest cell holds all of it, whatever else is asked.
    finest = max(box.most_x - box.least_x, box.most_y - box.least_y, 1e-9) * 1.0001 / 2.0**HALVINGS
    at = lambda c, least: F.floor((F.col(c) - F.lit(least)) / finest).cast("long")
    gridded = lambda df: df.withColumn("cx", at("x", box.least_x)).withColumn("cy", at("y", box.least_y))
    shifted = lambda c: F.expr(f"shiftright({c}, level)")
    levels = F.explode(F.sequence(F.lit(0), F.lit(HALVINGS))).alias("level")
    there, places = gridded(there), gridded(places)
    on = ["level", "x0", "y0"]
    leveled = lambda df, *more: df.select(*more, "cx", "cy", levels).withColumn("x0", shifted("cx")).withColumn("y0", shifted("cy"))
    counts = leveled(there.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")), "n").groupBy(*on).agg(F.sum("n").alias("n"))
    enough = counts.filter(F.col("n") >= min(k, box.n)).select(*on)
    own = leveled(places.select("cx", "cy").distinct()).join(enough, on).groupBy("cx", "cy").agg(F.min("level").alias("level"))
    # A place beyond the points' box has no such cell, and starts from all of it.
    places = places.join(own, ["cx", "cy"], "left").withColumn("level", F.coalesce("level", F.lit(HALVINGS)))
    places = kept(places.withColumn("x0", F.when(F.col("level") == HALVINGS, 0).otherwise(shifted("cx"))).withColumn("y0", F.when(F.col("level") == HALVINGS, 0).otherwise(shifted("cy"))))
    used = [r[0] for r in places.select("level").distinct().collect()]  # HALVINGS + 1 at most
    cells = there.select(other, F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), "cx", "cy", F.explode(F.array(*map(F.lit, used or [0]))).alias("level"))
    cells = cells.withColumn("x0", shifted("cx")).withColumn("y0", shifted("cy")).drop("cx", "cy")
    d2 = geo.planar2(F.col("lon2"), F.col("lat2"), F.col("lon"), F.col("lat"), F.col("scale"))
    order = Window.partitionBy("lon", "lat").orderBy("d2", other)
    first = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    near = kept(first(places.join(cells, on).select("lon", "lat", other, d2.alias("d2"))))
    bound = near.groupBy("lon", "lat").agg(F.max("d2").alias("bound"))
    width = F.lit(finest) * F.pow(F.lit(2.0), F.col("level"))
    wide = F.sqrt("bound") * (1 + 1e-9) + 1e-9
    around = lambda c, least: F.sequence(
        F.greatest(F.floor((F.col(c) - F.lit(least) - wide) / width), F.lit(0)).cast("long"), F.least(F.floor((F.col(c) - F.lit(least) + wide) / width), F.expr(f"shiftright({2**HALVINGS}, level)")).cast("long")
    )
    look = places.withColumnRenamed("x0", "own_x").withColumnRenamed("y0", "own_y").join(bound, ["lon", "lat"]).filter(F.col("level") < HALVINGS)
    look = look.withColumn("x0", F.explode(around("x", box.least_x))).withColumn("y0", F.explode(around("y", box.least_y)))
    gap = lambda c, least, cell: F.greatest(F.lit(least) + F.col(cell) * width - F.col(c), F.col(c) - F.lit(least) - (F.col(cell) + 1) * width, F.lit(0.0))
    meets = F.pow(gap("x", box.least_x, "x0"), F.lit(2.0)) + F.pow(gap("y", box.least_y, "y0"), F.lit(2.0)) <= F.pow(wide, F.lit(2.0))
    look = look.filter(meets & ~((F.col("x0") == F.col("own_x")) & (F.col("y0") == F.col("own_y"))))
    more = look.join(cells, on).select("lon", "lat", other, d2.alias("d2"), "bound").filter("d2 <= bound").drop("bound")
    return here.select(key, "lon", "lat").join(first(near.drop("rank").unionByName(more)).drop("rank"), ["lon", "lat"]).select(key, other, "d2")


def candidate_edges(origins: DataFrame, destinations: DataFrame, k: int, decay_km: float) -> DataFrame:
    """o, d, w: for each destination its k nearest origins, and for an origin that no destination chose
    its nearest destination; w falls exponentially with the great-circle distance. Ties go to the smaller
    index.

    origins: o, lon, lat; destinations: d, lon, lat."""
    origins, destinations = kept(origins.select("o", "lon", "lat")), kept(destinations.select("d", "lon", "lat"))
    scale = kept(longitude_scale(origins))
    near = kept(nearest_k(destinations, origins, k, "d", "o", scale).select("o", "d"))
    lost = kept(origins.join(near, "o", "left_anti"))
    found = near if lost.isEmpty() else near.unionByName(nearest_k(lost, destinations, 1, "o", "d", scale).select("o", "d"))
    o = origins.select("o", F.col("lon").alias("olon"), F.col("lat").alias("olat"))
    d = destinations.select("d", F.col("lon").alias("dlon"), F.col("lat").alias("dlat"))
    km = geo.haversine_km(F.col("olon"), F.col("olat"), F.col("dlon"), F.col("dlat"))
    return found.join(o, "o").join(d, "d").select("o", "d", geo.gravity(km, decay_km).alias("w"))
