"""Census queries: cleaning, merges by id / space, validation, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BOUNDS
from ..functions.geo import ring_bbox
from ..functions.seeded import sql_lit as L
from ..operators import census as cs
from .context import Ctx
from .queries import SPEC, V, query

_B = BOUNDS
_BOUNDS_SQL = (f"cy BETWEEN {L(_B['lat_min'])} AND {L(_B['lat_max'])} "
               f"AND cx BETWEEN {L(_B['lon_min'])} AND {L(_B['lon_max'])}")
ID_POP = "SELECT ID36, sum(POP) AS pop FROM census GROUP BY ID36"
SPATIAL_POP = ("SELECT g.cell_id, sum(k.POP) AS pop FROM cells g JOIN census k ON g.centroid_lon > k.xmin "
               "AND g.centroid_lon < k.xmax AND g.centroid_lat > k.ymin AND g.centroid_lat < k.ymax "
               "GROUP BY g.cell_id")


def _bbox_cols(df: DataFrame) -> DataFrame:
    bb = ring_bbox(F.col("ring"))
    return df.select(*[c for c in df.columns if c != "ring"],
                     *[F.round(bb[k], 9).alias(k) for k in ("xmin", "xmax", "ymin", "ymax")])


@query("census_clean", V(
    "SELECT ID36, POP, round(xmin, 9) AS xmin, round(xmax, 9) AS xmax, round(ymin, 9) AS ymin, "
    f"round(ymax, 9) AS ymax FROM census WHERE {_BOUNDS_SQL}", "census"))
def q_census_clean(c: Ctx) -> DataFrame:
    """S12 + P6-P8 + C8 + C19 + C20: census cleaned, kept by centroid in bounds."""
    return _bbox_cols(cs.load_census(c.census, bounds=BOUNDS))


@query("census_quality", V(
    "SELECT count(*) AS n_rows, sum(CASE WHEN POP IS NULL THEN 1 ELSE 0 END) AS n_null_pop, "
    "sum(CASE WHEN POP < 0 THEN 1 ELSE 0 END) AS n_negative_pop, 0 AS n_invalid_ring, "
    "0 AS n_unrepairable_ring FROM census", "census"))
def q_census_quality(c: Ctx) -> DataFrame:
    """Q8: null / negative population and invalid ring counts."""
    return cs.census_quality(c.census).select(*[F.col(x).cast("long").alias(x) for x in
                                                ["n_rows", "n_null_pop", "n_negative_pop", "n_invalid_ring",
                                                 "n_unrepairable_ring"]])


@query("merge_by_id", V(
    f"SELECT g.cell_id, CAST(coalesce(p.pop, 0) AS BIGINT) AS population, "
    f"CASE WHEN p.pop IS NOT NULL THEN 'id' END AS merge_method FROM cells_id g LEFT JOIN ({ID_POP}) p "
    f"ON p.ID36 = g.ID36", "cells_id", "census"))
def q_merge_by_id(c: Ctx) -> DataFrame:
    """Population by census id; repeated ids are summed first."""
    return cs.merge_by_id(c.cells_id.select("cell_id", "ID36"), c.census).select("cell_id", "population",
                                                                                 "merge_method")


@query("merge_spatial", V(
    f"SELECT g.cell_id, CAST(coalesce(p.pop, 0) AS BIGINT) AS population, "
    f"CASE WHEN p.pop IS NOT NULL THEN 'spatial' END AS merge_method FROM cells g LEFT JOIN ({SPATIAL_POP}) p "
    f"ON p.cell_id = g.cell_id", "cells", "census"))
def q_merge_spatial(c: Ctx) -> DataFrame:
    """Population of census polygons containing the cell centroid (summed)."""
    return cs.merge_spatial(c.cells, c.census.select("POP", "ring"), bin_size=SPEC.dlon).select(
        "cell_id", "population", "merge_method")


@query("merge_auto", V(
    f"SELECT g.cell_id, CAST(coalesce(p.pop, 0) AS BIGINT) AS population, "
    f"CASE WHEN p.pop IS NOT NULL THEN 'id' END AS merge_method FROM cells_id g LEFT JOIN ({ID_POP}) p "
    f"ON p.ID36 = g.ID36", "cells_id", "census"))
def q_merge_auto(c: Ctx) -> DataFrame:
    """J9 auto: id merge; spatial only when ids match nothing."""
    return cs.merge_population(c.cells_id, c.census, "auto", bin_size=SPEC.dlon).select(
        "cell_id", "population", "merge_method")


@query("merge_residual", V(
    f"SELECT g.cell_id, CAST(CASE WHEN p.pop IS NOT NULL THEN p.pop ELSE coalesce(s.pop, 0) END AS BIGINT) "
    f"AS population, CASE WHEN p.pop IS NOT NULL THEN 'id' WHEN s.pop IS NOT NULL THEN 'spatial' END "
    f"AS merge_method FROM cells_id g LEFT JOIN ({ID_POP}) p ON p.ID36 = g.ID36 "
    f"LEFT JOIN ({SPATIAL_POP}) s ON s.cell_id = g.cell_id", "cells_id", "cells", "census"))
def q_merge_residual(c: Ctx) -> DataFrame:
    """J9 with fallback='residual': spatial merge for cells the id merge missed."""
    return cs.merge_population(c.cells_id, c.census, "auto", bin_size=SPEC.dlon, fallback="residual").select(
        "cell_id", "population", "merge_method")


@query("unmatched_cells", V(
    f"SELECT g.cell_id FROM cells_id g LEFT JOIN ({ID_POP}) p ON p.ID36 = g.ID36 WHERE p.pop IS NULL",
    "cells_id", "census"))
def q_unmatched_cells(c: Ctx) -> DataFrame:
    """Cells without a census match."""
    return cs.unmatched_cells(cs.merge_by_id(c.cells_id.select("cell_id", "ID36"), c.census)).select("cell_id")


MERGED = (f"SELECT g.cell_id, CAST(coalesce(p.pop, 0) AS BIGINT) AS population FROM cells_id g "
          f"LEFT JOIN ({ID_POP}) p ON p.ID36 = g.ID36")


@query("population_validation", V(
    "SELECT len(errs) = 0 AS is_valid, cell_count, total_population, round(cov, 2) AS coverage_pct, "
    "round(zero, 2) AS zero_pop_pct, pop_min, pop_max, errs AS errors, warns AS warnings FROM ("
    "SELECT *, list_filter([CASE WHEN cov < 50.0 THEN printf('populated cells: %.1f%%, at least 50.0%% wanted', cov) END, "
    "CASE WHEN pop_min < 0 THEN printf('population under zero, down to %d', pop_min) END], "
    "lambda x: x IS NOT NULL) AS errs, "
    "list_filter([CASE WHEN zero > 50.0 THEN printf('empty cells: %.1f%%, at most 50.0%% wanted', "
    "zero) END, CASE WHEN pop_max > 3000 THEN printf('Maximum population %d is above 3000', "
    "pop_max) END], lambda x: x IS NOT NULL) AS warns FROM ("
    "SELECT count(*) AS cell_count, CAST(coalesce(sum(population), 0) AS BIGINT) AS total_population, "
    "avg(CASE WHEN population > 0 THEN 1.0 ELSE 0.0 END) * 100 AS cov, "
    "avg(CASE WHEN population = 0 THEN 1.0 ELSE 0.0 END) * 100 AS zero, "
    "CAST(min(population) AS BIGINT) AS pop_min, CAST(max(population) AS BIGINT) AS pop_max "
    "FROM merged) a) b", "cells_id", "census", ctes=[f"merged AS ({MERGED})"]))
def q_population_validation(c: Ctx) -> DataFrame:
    """Q9: population checks with the pipeline's 50% / 50% gates."""
    merged = cs.merge_population(c.cells_id, c.census, "auto", bin_size=SPEC.dlon)
    return cs.validate_population(merged, min_coverage_pct=50.0, max_zero_pop_pct=50.0)


@query("population_summary", V(
    "SELECT CAST(coalesce(sum(population), 0) AS BIGINT) AS total_population, count(*) AS cells, "
    "count(*) FILTER (WHERE population > 0) AS populated_cells, count(*) FILTER (WHERE population = 0) "
    "AS zero_cells, CAST(min(population) AS BIGINT) AS pop_min, CAST(max(population) AS BIGINT) AS pop_max, "
    "round(avg(population), 6) AS mean_all, round(avg(population) FILTER (WHERE population > 0), 6) "
    "AS mean_populated, round(avg(CASE WHEN population > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS coverage_pct, "
    "quantile_cont(population, 0.5) AS median FROM merged", "cells_id", "census",
    ctes=[f"merged AS ({MERGED})"]))
def q_population_summary(c: Ctx) -> DataFrame:
    """Q10: totals, populated / zero cells, means, exact median."""
    merged = cs.merge_population(c.cells_id, c.census, "auto", bin_size=SPEC.dlon)
    s = cs.population_summary(merged)
    return s.withColumns({k: F.round(k, 6) for k in ("mean_all", "mean_populated", "coverage_pct")})
