"""From radios and workplaces to points, populations and a report: the whole model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..operators import allocate, checks, cluster, emit, gravity, report, spatial
from ..operators.tables import integerize, kept, some
from ..sources import writers


@dataclass(frozen=True)
class Demand:
    points: DataFrame
    pops: DataFrame
    report: DataFrame
    clusters: DataFrame

    def document(self, config: Config, population: int, expected: int | None = None, allowed: DataFrame | None = None) -> checks.Document:
        """With all rules; ``population`` is what the configuration states."""
        flat = self.points.select("id", F.col("location")[0].alias("lon"), F.col("location")[1].alias("lat"), "jobs", "residents", "popIds")
        more = checks.report(self.report, config.maximum_population_count, expected)
        return checks.Document(flat, self.pops, config.bbox, config.maximum_population_size, config.maximum_population_count, population, expected, allowed, (more,))

    def write(self, path: str, config: Config, population: int, expected: int | None = None, allowed: DataFrame | None = None) -> None:
        """The document, if it breaks no rule; else the first offence is raised and nothing is written."""
        self.document(config, population, expected, allowed).check()
        writers.write_demand(self.points, self.pops, path, config.maximum_population_count)


def build(radios: DataFrame, workplaces: DataFrame, config: Config, budget: DataFrame | None = None) -> Demand:
    """radios: radio, lon, lat, employed; workplaces: workplace, lon, lat, employment_weight; budget: one
    row with the number of display clusters. Each step's table is kept in the shared
    folder, so that plans stay small and nothing is computed twice."""
    spark = radios.sparkSession
    budget = budget if budget is not None else spark.range(1).select(F.lit(config.display_cluster_count).cast("long").alias("budget"))
    radios = some(cluster.zoned(radios, config.solver_zone_degrees), "There are no radios")
    zones = kept(cluster.zone_totals(radios))
    labels = kept(cluster.ward_clusters(radios, zones, cluster.apportioned(zones, budget)))
    clusters = kept(cluster.display_clusters(radios, labels, config.bbox))
    state = clusters.crossJoin(F.broadcast(budget)).agg(F.max("budget"), F.count(F.lit(1)), F.count_distinct("lon", "lat")).first()
    if state[0] != state[1] or state[1] != state[2]:
        raise ValueError(f"{state[0]} clusters at places of their own were asked for, {state[1]} at {state[2]} places were found")
    solver = kept(cluster.solver_zones(clusters, zones))
    homes = radios.join(labels, "radio").join(clusters.select("zone", "label", "cluster"), ["zone", "label"]).select("radio", "lon", "lat", "cluster")
    placed = some(integerize(workplaces, "employment_weight", "workplace", "capacity"), "There are no workplaces")
    capacities = kept(spatial.capacity_by_cluster(placed, homes, clusters))
    destinations = kept(cluster.destination_zones(clusters, capacities, solver))
    scaled = cluster.formal_targets(clusters, capacities)
    targets = kept(integerize(scaled, "scaled", "cluster", "formal", scaled.agg(F.max("formal_total").alias("total"))))
    o_targets = targets.join(clusters.select("cluster", "zone"), "cluster").groupBy(F.col("zone").alias("o")).agg(F.sum("formal").alias("target"))
    d_targets = destinations.select("d", F.col("capacity").alias("target"))
    edges = spatial.candidate_edges(solver.select(F.col("zone").alias("o"), "lon", "lat"), destinations.select("d", "lon", "lat"), config.candidate_origins, config.gravity_decay_km)
    flows = kept(gravity.transported(
        edges, o_targets, d_targets, config.ipf_tolerance, config.ipf_max_iterations, config.projection_capacity_multiplier, config.projection_flow_quantum
    ))
    own = targets.join(clusters.select("cluster", "zone"), "cluster").select(F.col("zone").alias("o"), F.col("cluster").alias("oc"), F.col("formal").alias("size"))
    held = capacities.join(clusters.select("cluster", "zone"), "cluster").join(destinations.select("d", "zone"), "zone")
    held = held.select("d", F.col("cluster").alias("dc"), F.col("capacity").alias("size"))
    assigned = kept(allocate.disaggregate(flows.select("o", "d", "size"), own, held))
    for side, wanted in (("oc", own), ("dc", held)):
        if not allocate.margin_errors(assigned, wanted.filter("size > 0"), side).isEmpty():
            raise ValueError(f"Flows between clusters don't add up to the targets of {side}")
    residual = targets.select(F.col("cluster").alias("oc"), (F.col("employed") - F.col("formal")).alias("size"))
    pops = kept(emit.populations(assigned, residual, clusters.select("cluster", "id", "lon", "lat"), config.maximum_population_size))
    points = kept(emit.demand_points(clusters.select("id", "lon", "lat"), pops))
    dense = report.commute_figures(kept(report.with_km(flows, solver.select("zone", "lon", "lat"), destinations.select("d", "lon", "lat"), "o", "d").select("km", "w")), "w", "dense_formal")
    spots = clusters.select("cluster", "lon", "lat")
    exported = report.commute_figures(kept(report.with_km(assigned, spots, spots, "oc", "dc").select("km", "size")), "size", "exported_formal")
    totals = targets.agg(F.sum("employed").alias("employed"), F.sum("formal").alias("formal"), F.sum(F.col("employed") - F.col("formal")).alias("local_residual"))
    model = flows.agg(
        F.count(F.lit(1)).alias("dense_candidate_edges"), F.count_if(F.col("w") > 0).alias("dense_positive_edges"), F.count_if(F.col("size") > 0).alias("sparse_zone_flows")
    ).crossJoin(solver.agg(F.count(F.lit(1)).alias("solver_zones")))
    figures = totals.crossJoin(model).crossJoin(dense).crossJoin(exported).crossJoin(report.output_figures(points, pops)).crossJoin(report.cluster_figures(clusters))
    return Demand(points, pops, figures, clusters)
