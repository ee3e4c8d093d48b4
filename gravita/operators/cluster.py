"""Zones, adaptive display clusters and their centroids."""

from __future__ import annotations

from bisect import bisect_left, insort
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.scalar import padded
from .tables import enumerate_rows, number_rows, only_row, zero_filled

#: Tasks that zones are dealt over, at least.
LEAST_TASKS = 64


def zoned(radios: DataFrame, degrees: float) -> DataFrame:
    """Adds the grid keys zx and zy of radios (radio, lon, lat, employed)."""
    return radios.withColumn("zx", geo.bucket(F.col("lon"), degrees)).withColumn("zy", geo.bucket(F.col("lat"), degrees))


def zone_totals(radios: DataFrame) -> DataFrame:
    """zone (numbered in order of keys), zx, zy, employed, radio_count."""
    sums = radios.groupBy("zx", "zy").agg(F.sum("employed").alias("employed"), F.count(F.lit(1)).alias("radio_count"))
    return number_rows(sums, "zone", "zx", "zy")


def apportioned(zones: DataFrame, budget: DataFrame) -> DataFrame:
    """zone, clusters: the budget (one row, column budget) shared by highest averages, at least one and at
    most radio_count for each zone. Every possible seat beyond the first has the priority
    employed / seat; the best ones are taken, ties to the smaller zone and seat."""
    bounds = zones.agg(F.count(F.lit(1)).alias("least"), F.sum("radio_count").alias("most"))
    free = budget.crossJoin(bounds)
    message = F.lit("The cluster budget must lie between the number of zones and the number of radios")
    wrong = (F.col("budget") < F.col("least")) | (F.col("budget") > F.col("most"))
    free = free.select(F.when(wrong, F.raise_error(message).cast("long")).otherwise(F.col("budget") - F.col("least")).alias("free"))
    seats = zones.filter("radio_count > 1").select("zone", "employed", F.explode(F.sequence(F.lit(2).cast("long"), F.col("radio_count"))).alias("seat"))
    ranked = enumerate_rows(seats.withColumn("priority", F.col("employed") / F.col("seat")), "n", F.desc("priority"), "zone", "seat")
    won = only_row(ranked, free).filter("n < free")
    return zero_filled(zones, won.withColumn("one", F.lit(1).cast("long")), "zone", "one", "more").select("zone", (F.col("more") + 1).alias("clusters"))


class _Clusters:
    """Clusters of points on the plane, with their weights, in a tree of boxes that are halved at medians. A box knows
    the least weight of what it holds, and so the least cost of a merge with anything in it."""

    #: Points that a box isn't halved for.
    FEW = 8

    def __init__(self, points: np.ndarray):
        self.x, self.y, self.weight = points[:, 0].tolist(), points[:, 1].tolist(), [1.0] * len(points)
        self.above, self.left, self.right, self.held, self.box, self.cut = [], [], [], [], [], []
        self.leaf = [0] * len(points)
        todo = [(np.arange(len(points)), -1, (-np.inf, -np.inf, np.inf, np.inf))]
        while todo:
            inside, above, box = todo.pop()
            node, own = len(self.above), points[inside]
            for column, value in ((self.above, above), (self.left, -1), (self.right, -1), (self.held, None), (self.box, box), (self.cut, None)):
                column.append(value)
            if above >= 0:  # the right half comes first
                (self.left if self.right[above] >= 0 else self.right)[above] = node
            low, high = own.min(0), own.max(0)
            if len(inside) <= self.FEW or (low == high).all():
                self.held[node] = inside.tolist()
                for i in self.held[node]:
                    self.leaf[i] = node
                continue
            axis = int((high - low).argmax())
            values = own[:, axis]
            at = float(np.partition(values, len(values) // 2)[len(values) // 2])
            if at == low[axis]:
                at = float(values[values > at].min())
            self.cut[node] = axis, at
            less = values < at
            for half, end in ((less, axis + 2), (~less, axis)):  # the upper end of one box is the lower end of the other
                todo.append((inside[half], node, (*box[:end], at, *box[end + 1 :])))
        self.least = [1.0] * len(self.above)

    def _weigh(self, node: int, new: int) -> None:
        """Bring the least weights of a leaf and of the boxes around it up to date, after ``new`` came or went."""
        if any(self.weight[i] == self.least[node] for i in self.held[node]) and self.weight[new] >= self.least[node]:
            return
        least = min((self.weight[i] for i in self.held[node]), default=np.inf)
        while self.least[node] != least:
            self.least[node] = least
            node = self.above[node]
            if node < 0:
                return
            least = min(self.least[self.left[node]], self.least[self.right[node]])

    def merge(self, lo: int, hi: int) -> None:
        """The two become ``lo``, at their common centre."""
        for i in (lo, hi):
            held = self.held[self.leaf[i]]
            del held[bisect_left(held, i)]
            self._weigh(self.leaf[i], i)
        a, b = self.weight[lo], self.weight[hi]
        self.x[lo] = (self.x[lo] * a + self.x[hi] * b) / (a + b)
        self.y[lo] = (self.y[lo] * a + self.y[hi] * b) / (a + b)
        self.weight[lo], self.weight[hi] = a + b, 0.0
        node = 0
        while self.cut[node]:
            axis, at = self.cut[node]
            node = (self.left if (self.y if axis else self.x)[lo] < at else self.right)[node]
        self.leaf[lo] = node
        insort(self.held[node], lo)
        self._weigh(node, lo)

    def cost(self, i: int, j: int) -> float:
        """Growth of squared error by a merge."""
        a, b, dx, dy = self.weight[j], self.weight[i], self.x[j] - self.x[i], self.y[j] - self.y[i]
        return a * b / (a + b) * (dx * dx + dy * dy)

    def cheapest(self, i: int, before: int) -> tuple[int, float]:
        """With which other cluster a merge costs least: ``before`` (-1: none) where none costs less, else the first of
        equals. Looks into the box of i first, then beside each box around it, and only where less may be found."""
        best, found = (self.cost(i, before), -1) if before >= 0 else (np.inf, len(self.x))
        px, py, w = self.x[i], self.y[i], self.weight[i]
        xs, ys, weights, lefts, rights, helds, boxes, cuts, leasts = self.x, self.y, self.weight, self.left, self.right, self.held, self.box, self.cut, self.least
        top, todo = self.leaf[i], [self.leaf[i]]
        while True:
            while todo:
                node = todo.pop()
                m = leasts[node]
                if m == np.inf:
                    continue
                x0, y0, x1, y1 = boxes[node]
                dx = x0 - px if px < x0 else px - x1 if px > x1 else 0.0
                dy = y0 - py if py < y0 else py - y1 if py > y1 else 0.0
                if m * w / (m + w) * (dx * dx + dy * dy) > best:
                    continue
                held = helds[node]
                if held is None:
                    axis, at = cuts[node]
                    todo += (rights[node], lefts[node]) if (py if axis else px) < at else (lefts[node], rights[node])  # the near one is next
                    continue
                for j in held:
                    if j != i:
                        a, dx, dy = weights[j], xs[j] - px, ys[j] - py
                        c = a * w / (a + w) * (dx * dx + dy * dy)
                        if c < best or (c == best and j < found):
                            best, found = c, j
                            if c == 0:  # all at this place are in this leaf, in order
                                return j, c
            if best == 0 or self.above[top] < 0:
                return (found if found >= 0 else before), best
            up = self.above[top]
            todo.append(rights[up] if lefts[up] == top else lefts[up])
            top = up

    def within(self, i: int, bound: float) -> list[tuple[float, int]]:
        """Costs of all merges with i that are below a bound, and with what."""
        px, py, w, todo, out = self.x[i], self.y[i], self.weight[i], [0], []
        while todo:
            node = todo.pop()
            m = self.least[node]
            if m == np.inf:
                continue
            x0, y0, x1, y1 = self.box[node]
            dx, dy = max(x0 - px, px - x1, 0.0), max(y0 - py, py - y1, 0.0)
            if m * w / (m + w) * (dx * dx + dy * dy) >= bound:
                continue
            if self.held[node] is None:
                todo += (self.left[node], self.right[node])
            else:
                out += [(c, j) for j in self.held[node] if j != i and (c := self.cost(i, j)) < bound]
        return out


class _Seen:
    """What a cluster has seen around it: all that costs it less than a bound, and whatever was merged since. Where a
    long chain comes back to its first cluster again and again, it needn't look once more."""

    #: The bound, in least costs.
    WIDE = 1.5

    def __init__(self, clusters: _Clusters, i: int):
        self.i, self.clusters, self.bound, self.costs = i, clusters, 0.0, []

    def merged(self, j: int) -> None:
        heappush(self.costs, (self.clusters.cost(self.i, j), j, self.clusters.weight[j]))

    def cheapest(self) -> tuple[int, float]:
        weight, costs = self.clusters.weight, self.costs
        while costs and weight[costs[0][1]] != costs[0][2]:
            heappop(costs)
        if not costs or costs[0][0] >= self.bound:
            j, cost = self.clusters.cheapest(self.i, -1)
            self.bound = self.WIDE * cost
            self.costs = [(c, k, weight[k]) for c, k in self.clusters.within(self.i, self.bound)]
            heapify(self.costs)
            return j, cost
        return costs[0][1], costs[0][0]


def ward(points: np.ndarray, n: int) -> np.ndarray:
    """Labels of n clusters by least growth of squared error, in the order of the least member. Chains of
    nearest neighbours find the merges, each step by a look into the boxes around a cluster, and the cheapest
    of them count (ties: the one found first). Only centroids, weights and boxes are held."""
    size = len(points)
    if n >= size:
        return np.arange(size)
    clusters, alive = _Clusters(points.astype(float)), [True] * size
    merges, chain, first = [], [], 0
    seen = _Seen(clusters, 0)
    while len(merges) < size - 1:
        if not chain:
            while not alive[first]:
                first += 1
            chain.append(first)
            seen = _Seen(clusters, first)
        i, before = chain[-1], chain[-2] if len(chain) > 1 else -1
        j, cost = clusters.cheapest(i, before) if before >= 0 else seen.cheapest()
        if j == before:
            del chain[-2:]
            lo, hi = min(i, j), max(i, j)
            merges.append((cost, lo, hi))
            clusters.merge(lo, hi)
            alive[hi] = False
            if chain:
                seen.merged(lo)
        else:
            chain.append(j)
    up = list(range(size))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for _, lo, hi in sorted(merges, key=lambda m: m[0])[: size - n]:
        lo, hi = sorted((top(lo), top(hi)))
        up[hi] = lo
    return np.unique([top(i) for i in range(size)], return_inverse=True)[1]


def ward_clusters(radios: DataFrame, zones: DataFrame, counts: DataFrame) -> DataFrame:
    """radio, zone, label: radios of each zone in as many clusters as it was given."""
    keyed = radios.join(zones.select("zone", "zx", "zy"), ["zx", "zy"]).join(counts, "zone")
    scale = radios.agg(F.cos(F.radians(F.avg("lat"))).alias("scale"))
    placed = only_row(keyed, scale).select("radio", "zone", "clusters", (F.col("lon") * F.col("scale")).alias("x"), F.col("lat").alias("y"))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("radio")
        labels = ward(pdf[["x", "y"]].to_numpy(), int(pdf.clusters.iloc[0]))
        return pd.DataFrame({"radio": pdf.radio, "zone": pdf.zone, "label": labels})

    # A zone's rows are few bytes but much work: partitions aren't joined by their sizes. With the number of tasks that the
    # join has, its own partitions would do, and those are.
    tasks = max(2 * int(radios.sparkSession.conf.get("spark.sql.shuffle.partitions")), LEAST_TASKS)
    return placed.repartition(tasks, "zone").groupBy("zone").applyInPandas(label, "radio long, zone long, label long")


def centroids(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and centroids of rows (lon, lat, employed) by key; a row weighs its employed, at least 1."""
    w = F.greatest(F.col("employed"), F.lit(1)).cast("double")
    sums = rows.withColumn("w", w).groupBy(*keys).agg(
        (F.sum(F.col("lon") * F.col("w")) / F.sum("w")).alias("lon"), (F.sum(F.col("lat") * F.col("w")) / F.sum("w")).alias("lat"),
        F.sum("employed").alias("employed"), F.count(F.lit(1)).alias("radio_count"),
    )
    return sums


def display_clusters(radios: DataFrame, labels: DataFrame, bbox) -> DataFrame:
    """cluster, id, zone, label, lon, lat, employed, radio_count, numbered by zone and label."""
    west, south, east, north = bbox
    sums = centroids(labels.join(radios, "radio"), ["zone", "label"])
    sums = sums.withColumn("lon", geo.clamp(F.col("lon"), west, east)).withColumn("lat", geo.clamp(F.col("lat"), south, north))
    return number_rows(sums, "cluster", "zone", "label").withColumn("id", padded("origin_", 5, F.col("cluster")))


def solver_zones(clusters: DataFrame, zones: DataFrame) -> DataFrame:
    """zone, id, lon, lat, employed: centroids over the clusters of each zone."""
    mean = centroids(clusters.select("zone", "lon", "lat", "employed"), ["zone"]).drop("radio_count")
    return mean.join(zones.select("zone", F.concat_ws("_", F.lit("zone"), "zx", "zy").alias("id")), "zone")


def destination_zones(clusters: DataFrame, capacities: DataFrame, zones: DataFrame) -> DataFrame:
    """d, id, zone, lon, lat, capacity: zones whose clusters have capacity, numbered by zone."""
    sums = clusters.select("cluster", "zone").join(capacities, "cluster").groupBy("zone").agg(F.sum("capacity").alias("capacity")).filter("capacity > 0")
    rows = sums.join(zones.select("zone", "lon", "lat", "id"), "zone").withColumn("id", F.concat(F.lit("destination_"), "id"))
    return number_rows(rows, "d", "zone")


def formal_targets(clusters: DataFrame, capacities: DataFrame) -> DataFrame:
    """cluster, employed, scaled: employed in proportion to what all workplaces hold (never more than all)."""
    totals = clusters.agg(F.sum("employed").alias("all_employed")).crossJoin(capacities.agg(F.sum("capacity").alias("all_capacity")))
    rows = only_row(clusters.select("cluster", "employed"), totals)
    formal = F.least("all_employed", "all_capacity")
    return rows.select("cluster", "employed", (F.col("employed").cast("double") * formal / F.col("all_employed")).alias("scaled"), formal.alias("formal_total"))
