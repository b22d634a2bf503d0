"""Per-run context: the domain views of one scale-factor folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import feed
from ..operators.grid import GridSpec, generate_grid
from ..session import materialize
from ..sources import fixtures as fx

# Registered queries use 500 m cells so that cells are not mostly empty at
# the small scale factors; the pipeline default is the configured 200 m.
QUERY_CELL_SIZE_M = 500
QUERY_SPEC = GridSpec.from_bounds(cell_size_m=QUERY_CELL_SIZE_M)


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str, spec: GridSpec = QUERY_SPEC):
        self.spark, self.sf_dir, self.spec = spark, sf_dir, spec

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, name)

    @cached_property
    def stops(self) -> DataFrame:
        return fx.stops(self.spark, self.sf_dir)

    @cached_property
    def trips(self) -> DataFrame:
        return fx.trips(self.spark, self.sf_dir)

    @cached_property
    def stop_times(self) -> DataFrame:
        return fx.stop_times(self.spark, self.sf_dir)

    @cached_property
    def stop_times_arr(self) -> DataFrame:
        return fx.stop_times(self.spark, self.sf_dir, with_arrival=True)

    @cached_property
    def calendar(self) -> DataFrame:
        return fx.calendar(self.spark)

    @cached_property
    def cells(self) -> DataFrame:
        return generate_grid(self.spark, self.spec)

    @cached_property
    def cells_id(self) -> DataFrame:
        return generate_grid(self.spark, self.spec, with_census_id=True)

    @cached_property
    def census(self) -> DataFrame:
        return fx.census(self.spark, self.sf_dir, self.spec)

    @cached_property
    def features(self) -> DataFrame:
        return feed.extract_features(self.cells, self.stops, self.stop_times, self.trips,
                                     self.calendar, self.spec)


def _features_norm(self) -> DataFrame:
    from ..operators.scaling import normalize_features
    return normalize_features(self.features)


def _features_pop(self) -> DataFrame:
    """Features + z-scores + census population (auto merge) + population_norm."""
    from ..operators.census import merge_population
    from ..operators.scaling import normalize_population
    grid = self.cells_id.select("cell_id", "ID36")
    merged = merge_population(grid, self.census, method="auto", bin_size=self.spec.dlon)
    enriched = self.features_norm.join(merged.select("cell_id", "population"), "cell_id", "left")
    enriched = enriched.withColumn("population", F.coalesce("population", F.lit(0)).cast("long"))
    # one row per cell, reused by every label statistic: written once
    return materialize(normalize_population(enriched), "features_pop")


def _labels(self) -> DataFrame:
    from ..operators.labels import generate_labels
    # one row per cell, read by splits, metrics and statistics: written once
    return materialize(generate_labels(self.features_pop), "labels")


Ctx.features_norm = cached_property(_features_norm)
Ctx.features_norm.__set_name__(Ctx, "features_norm")
Ctx.features_pop = cached_property(_features_pop)
Ctx.features_pop.__set_name__(Ctx, "features_pop")
Ctx.labels = cached_property(_labels)
Ctx.labels.__set_name__(Ctx, "labels")
