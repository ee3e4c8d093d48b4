"""Validation rules. Each gives the rows that break it, as (rule, offender); none is an empty result.

``failures`` puts them in the order of the rules, and ``first_failure`` names the one to raise."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.readers import index_header
from .emit import roles

OFFENCE = "rule string, offender string"


def _told(df: DataFrame, rule: str, offender: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), offender.cast("string").alias("offender"))


def bbox(boxes: DataFrame) -> DataFrame:
    """boxes: name, bbox (array)."""
    b = F.col("bbox")
    ok = (F.size(b) == 4) & (F.get(b, 0) < F.get(b, 2)) & (F.get(b, 1) < F.get(b, 3))
    return _told(boxes.filter(~F.coalesce(ok, F.lit(False))), "bbox", F.col("name"))


def count_between(df: DataFrame, rule: str, least: int | None = None, most: int | None = None) -> DataFrame:
    """Breaks if there are fewer or more rows; the offender is their number."""
    n = F.col("n")
    bad = F.lit(False)
    bad = bad if least is None else bad | (n < least)
    bad = bad if most is None else bad | (n > most)
    return _told(df.agg(F.count(F.lit(1)).alias("n")).filter(bad), rule, n)


def unique(df: DataFrame, rule: str, *keys: str) -> DataFrame:
    return _told(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), rule, F.concat_ws(",", *(F.col(k).cast("string") for k in keys)))


def references(points: DataFrame, pops: DataFrame) -> DataFrame:
    """Populations whose residence or job is no point."""
    ids = points.select(F.col("id").alias("point"))
    return _told(roles(pops).join(ids, "point", "left_anti").select("pop").distinct(), "references", F.col("pop"))


def job_locations(points: DataFrame, allowed: DataFrame) -> DataFrame:
    """The least job place that isn't allowed (lon, lat)."""
    lost = points.filter("jobs > 0").join(allowed.select("lon", "lat"), ["lon", "lat"], "left_anti")
    least = lost.agg(F.min(F.struct("lon", "lat")).alias("p")).filter("p IS NOT NULL")
    return _told(least, "job_locations", F.concat_ws(",", F.col("p.lon").cast("string"), F.col("p.lat").cast("string")))


def sizes(pops: DataFrame, most: int) -> DataFrame:
    return _told(pops.filter((F.col("size") <= 0) | (F.col("size") > most) | F.col("size").isNull()), "sizes", F.col("id"))


def in_bbox(points: DataFrame, box) -> DataFrame:
    return _told(points.filter(~F.coalesce(geo.inside(F.col("lon"), F.col("lat"), box), F.lit(False))), "in_bbox", F.col("id"))


def pop_ids(points: DataFrame, pops: DataFrame) -> DataFrame:
    """Points whose popIds repeat or aren't those of the populations that live or work there."""
    listed = points.select(F.col("id").alias("point"), F.explode("popIds").alias("pop")).groupBy("point", "pop").agg(F.count(F.lit(1)).alias("times"))
    real = roles(pops).filter("listed").join(points.select(F.col("id").alias("point")), "point", "left_semi").select("point", "pop", F.lit(True).alias("real"))
    bad = listed.join(real, ["point", "pop"], "full_outer").filter("times IS NULL OR times > 1 OR real IS NULL")
    return _told(bad.select("point").distinct(), "pop_ids", F.col("point"))


def point_sums(points: DataFrame, pops: DataFrame) -> DataFrame:
    """Points whose residents or jobs aren't the sums of their populations."""
    sums = roles(pops).groupBy("point").agg(F.sum("residents").alias("r"), F.sum("jobs").alias("j"))
    both = points.join(sums, points["id"] == sums["point"], "left")
    bad = (F.col("residents") != F.coalesce("r", F.lit(0))) | (F.col("jobs") != F.coalesce("j", F.lit(0)))
    return _told(both.filter(bad), "point_totals", F.col("id"))


def global_sums(points: DataFrame, pops: DataFrame, population: int) -> DataFrame:
    """Breaks if residents, jobs and the sizes don't all sum to the stated population."""
    p = points.agg(F.coalesce(F.sum("residents"), F.lit(0)).alias("residents"), F.coalesce(F.sum("jobs"), F.lit(0)).alias("jobs"))
    q = p.crossJoin(pops.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")))
    bad = (F.col("residents") != F.col("size")) | (F.col("jobs") != F.col("size")) | (F.col("residents") != population)
    return _told(q.filter(bad), "global_totals", F.concat_ws(",", "residents", "jobs", "size"))


def report(figures: DataFrame, most: int, expected: int | None = None) -> DataFrame:
    """figures: one row; a missing exported figure fails, and so does one that is no number."""
    far = lambda name, most_km: F.coalesce(F.nanvl(F.abs(F.col(f"exported_{name}") - F.col(f"dense_{name}")), F.lit(float("inf"))), F.lit(float("inf"))) > most_km
    rules = [
        ("duplicate_coordinates", F.coalesce(F.col("duplicate_coordinates") != 0, F.lit(True))),
        ("populations", F.coalesce(F.col("populations") > most, F.lit(True))),
        ("points", F.coalesce(F.col("points") != expected, F.lit(True)) if expected is not None else F.lit(False)),
        ("density", F.coalesce("points", F.lit(0)) <= F.coalesce("solver_zones", F.lit(0)) * 3),
        ("mean_drift", far("formal_mean_km", 2.0)),
        ("p90_drift", far("formal_p90_km", 5.0)),
    ]
    broken = F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules)), lambda x: x.isNotNull())
    return _told(figures.select(F.explode(broken).alias("name")), "report", F.col("name"))


def building_index(described: DataFrame, files: DataFrame, least: int) -> DataFrame:
    """described: name, json; files: name, content. The stated count (or the listed buildings), the
    binary count, and more than ``least``."""
    stated = F.coalesce(F.get_json_object("json", "$.stats.count").cast("long"), F.json_array_length(F.get_json_object("json", "$.buildings")).cast("long"))
    both = described.select("name", stated.alias("stated")).join(index_header(files).select("name", "count"), "name")
    bad = F.coalesce((F.col("stated") != F.col("count")) | (F.col("stated") <= least), F.lit(True))
    return _told(both.filter(bad), "building_index", F.col("name"))


def package(files: DataFrame, code: str, foreign: str) -> DataFrame:
    """files: code, name (one row for each file). The code, the tiles' name, and no other city's files."""
    tiles = F.count_if(F.col("name") == f"{code}.pmtiles") > 0
    alien = F.count_if(F.col("name").startswith(foreign)) > 0
    wrong = F.count_if(F.coalesce(F.col("code") != code, F.lit(True))) > 0
    state = files.agg(tiles.alias("tiles"), alien.alias("alien"), wrong.alias("wrong"))
    return _told(state.filter("NOT tiles OR alien OR wrong"), "package", F.lit(code))


def required_files(present: DataFrame, required: DataFrame) -> DataFrame:
    """Names that are required (both tables: name) but not present."""
    return _told(required.join(present, "name", "left_anti"), "required_files", F.col("name"))


def config_code(configs: DataFrame, code: str) -> DataFrame:
    """configs: json. A configuration with another code, or none."""
    said = F.get_json_object("json", "$.code")
    return _told(configs.filter(~said.eqNullSafe(F.lit(code))), "config_code", F.coalesce(said, F.lit("")))


def demand(points: DataFrame, pops: DataFrame, box, most_size: int, most_pops: int, population: int, expected: int | None = None, allowed: DataFrame | None = None) -> list[DataFrame]:
    """The rules of a demand document, in order. points: id, lon, lat, jobs, residents, popIds."""
    rules = [
        count_between(points, "points_empty", least=1), count_between(pops, "pops_empty", least=1), count_between(pops, "budget", most=most_pops),
        *([count_between(points, "point_count", least=expected, most=expected)] if expected is not None else []),
        unique(points, "point_ids", "id"), unique(points, "coordinates", "lon", "lat"),
        *([job_locations(points, allowed)] if allowed is not None else []),
        unique(pops, "population_ids", "id"), references(points, pops), sizes(pops, most_size), in_bbox(points, box),
        pop_ids(points, pops), point_sums(points, pops), global_sums(points, pops, population),
    ]
    return rules


def _digest(pop: Column) -> tuple[Column, Column, Column]:
    """Aggregates by which lists of populations are compared without being put together: number, sum and parity of
    64-bit hashes."""
    h = F.when(pop.isNotNull(), F.xxhash64(pop))
    return F.count(pop), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)


@dataclass(frozen=True)
class Document:
    """A demand document with what it is held against. points: id, lon, lat, jobs, residents, popIds; pops: id,
    residenceId, jobId, size; allowed: lon, lat of places that may have jobs; more: rules about other files."""

    points: DataFrame
    pops: DataFrame
    box: tuple[float, float, float, float]
    most_size: int
    most_pops: int
    population: int
    expected: int | None = None
    allowed: DataFrame | None = None
    more: tuple[DataFrame, ...] = ()

    def rules(self) -> list[DataFrame]:
        """Every rule's offenders, in order."""
        own = demand(self.points, self.pops, self.box, self.most_size, self.most_pops, self.population, self.expected, self.allowed)
        return [*own, *self.more]

    def counted(self) -> dict[str, int]:
        """How many rows break the rules that counts, sums and one join can tell: one job reads both tables once.
        Without points or populations there is nothing to observe, and every rule counts as broken till it is run."""
        empty = {"points_empty": int(self.points.isEmpty()), "pops_empty": int(self.pops.isEmpty())}
        if any(empty.values()):
            return dict.fromkeys(("budget", "point_count", "references", "sizes", "in_bbox", "pop_ids", "point_totals", "global_totals"), 1) | empty
        total, rows = lambda c: F.coalesce(F.sum(c), F.lit(0)), F.count(F.lit(1)).alias("rows")
        told = {name: Observation(f"{name}-{uuid.uuid4().hex}") for name in ("points", "pops", "both")}
        pops = self.pops.observe(told["pops"], rows, total("size").alias("size"), F.count_if((F.col("size") <= 0) | (F.col("size") > self.most_size) | F.col("size").isNull()).alias("sizes"))
        outside = ~F.coalesce(geo.inside(F.col("lon"), F.col("lat"), self.box), F.lit(False))
        points = self.points.observe(told["points"], rows, total("residents").alias("residents"), total("jobs").alias("jobs"), F.count_if(outside).alias("in_bbox"))
        zero = F.lit(0).cast("long")
        role = lambda point, r, j, pop: F.struct(F.col(point).alias("point"), r.alias("r"), j.alias("j"), pop.alias("pop"))
        at_work = F.when(F.col("jobId").eqNullSafe(F.col("residenceId")), F.lit(None)).otherwise(F.col("id"))
        parts = pops.select(F.explode(F.array(role("residenceId", F.col("size"), zero, F.col("id")), role("jobId", zero, F.col("size"), at_work))).alias("x")).select("x.*")
        sums = parts.groupBy("point").agg(total("r").alias("r"), total("j").alias("j"), *(c.alias(f"real{i}") for i, c in enumerate(_digest(F.col("pop")))))
        hashes = F.transform("popIds", lambda p: F.xxhash64(p))
        listed = (
            F.size("popIds").cast("long"),
            F.aggregate(hashes, F.lit(0).cast("decimal(38,0)"), lambda a, h: (a + h).cast("decimal(38,0)")), F.aggregate(hashes, zero, lambda a, h: a.bitwiseXOR(h)),
        )
        same = F.lit(True)
        for i, c in enumerate(listed):
            same = same & (c == F.coalesce(f"real{i}", F.lit(0)))
        both = points.join(sums, points["id"] == sums["point"], "full_outer")
        known = F.col("id").isNotNull()
        off = (F.col("residents") != F.coalesce("r", F.lit(0))) | (F.col("jobs") != F.coalesce("j", F.lit(0)))
        both = both.observe(
            told["both"], F.count_if(F.col("point").isNotNull() & ~known).alias("references"),
            F.count_if(known & ~F.coalesce(same, F.lit(False))).alias("pop_ids"), F.count_if(known & F.coalesce(off, F.lit(True))).alias("point_totals"),
        )
        both.write.format("noop").mode("overwrite").save()
        a, b = told["points"].get, told["pops"].get
        unequal = int(not (a["residents"] == a["jobs"] == b["size"] == self.population))
        return {
            **empty, "budget": int(b["rows"] > self.most_pops),
            "point_count": int(self.expected is not None and a["rows"] != self.expected), "sizes": b["sizes"], "in_bbox": a["in_bbox"],
            "global_totals": unequal, **told["both"].get,
        }

    def broken(self) -> set[str]:
        """Names of the rules that are broken, in two jobs: counts and sums in one, the others in another."""
        counted = self.counted()
        rest = [unique(self.points, "point_ids", "id"), unique(self.points, "coordinates", "lon", "lat"), unique(self.pops, "population_ids", "id"), *self.more]
        rest += [job_locations(self.points, self.allowed)] if self.allowed is not None else []
        found = reduce(DataFrame.unionByName, rest).select("rule").distinct().collect()  # as many as there are rules
        return {name for name, n in counted.items() if n} | {r.rule for r in found}

    def offenders(self) -> DataFrame:
        """step, rule, offender of every broken rule; those that hold aren't run again."""
        broken = self.broken()
        names = ["points_empty", "pops_empty", "budget", *(["point_count"] if self.expected is not None else []), "point_ids", "coordinates"]
        names += [*(["job_locations"] if self.allowed is not None else []), "population_ids", "references", "sizes", "in_bbox", "pop_ids", "point_totals", "global_totals"]
        steps = [(i, r) for i, r in enumerate(self.rules()) if i >= len(names) or names[i] in broken]
        none = self.points.sparkSession.createDataFrame([], f"step int, {OFFENCE}")
        return reduce(DataFrame.unionByName, (r.select(F.lit(i).alias("step"), "rule", "offender") for i, r in steps), none)

    def check(self) -> None:
        """Raise the first offence."""
        row = self.offenders().orderBy("step", "offender").first()
        if row is not None:
            raise ValueError(f"{row.rule}: {row.offender}")


def failures(rules: list[DataFrame]) -> DataFrame:
    """All offenders: step (the rule's place), rule, offender."""
    numbered = [r.select(F.lit(i).alias("step"), "rule", "offender") for i, r in enumerate(rules)]
    return reduce(DataFrame.unionByName, numbered)


def first_failure(spark: SparkSession, rules: list[DataFrame]) -> None:
    """Raise the first offence by rule and offender."""
    row = failures(rules).orderBy("step", "offender").first()
    if row is not None:
        raise ValueError(f"{row.rule}: {row.offender}")
