"""One job from pixels and buildings to its result tables.

Planes and polygons are found once and written; energy and panels read them again. Each result table
is partitioned by job, and a job that runs again replaces its own rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooflight.operators import polygons, roofs
from rooflight.sources.tables import count_rows, read_job, write_job


@dataclass(frozen=True)
class Parameters:
    """What a job can be told; numbers out of range are refused."""

    job_id: int
    pixel_side: float = 1.0
    peak_power: float = 0.2
    edge: float = 0.3
    max_slope: float = 80.0
    min_area: float = 8.0
    from_north: float = 45.0
    flat_slope: float = 10.0

    def __post_init__(self):
        ranges = {"job_id": (0, None), "pixel_side": (0.1, 10), "peak_power": (0, None), "edge": (0, None), "max_slope": (0, 90), "min_area": (0, None), "from_north": (0, 180), "flat_slope": (0, 90)}
        for name, (low, high) in ranges.items():
            value = getattr(self, name)
            if value is None or isinstance(value, (bool, str)):
                raise ValueError(f"parameter {name} must be a number, was {value!r}")
            if value < low or (high is not None and value > high):
                raise ValueError(f"parameter {name} must lie in {low} to {high}, was {value}")


def model_solar_pv(spark: SparkSession, buildings: DataFrame, pixels: DataFrame, out: str, parameters: Parameters, resume: bool = False) -> dict[str, int]:
    """Roof planes, energy, panels and buildings below ``out``; how many rows each table has for all jobs.

    buildings: toid, polygon (text), building (WKB), max_ground_height, exclusion_reason; pixels: toid, x, y, elevation,
    aspect, kwh_year, wh (12 days), horizon. Excluded buildings are not modelled and keep their reason;
    others get one if no plane or no usable plane is found. ``resume`` takes planes that the job
    has written already.
    """
    p = parameters
    paths = {n: f"{out.rstrip('/')}/{n}" for n in ("planes", "pv_roof_plane", "panels", "pv_building")}
    wanted = buildings.where("exclusion_reason IS NULL")
    if not (resume and count_rows(spark, paths["planes"]) and not read_job(spark, paths["planes"], p.job_id).isEmpty()):
        found = roofs.detect(pixels.join(wanted.select("toid"), "toid", "left_semi"), wanted.drop("exclusion_reason"))
        drawn = polygons.roof_polygons(found, wanted, p.edge, p.pixel_side, p.flat_slope, p.max_slope, p.min_area, p.from_north)
        write_job(drawn.drop("building"), paths["planes"], p.job_id)
    drawn = read_job(spark, paths["planes"], p.job_id).drop("job_id")
    usable = drawn.where("usable")
    energy = polygons.plane_energy(usable, pixels, p.pixel_side, p.peak_power)
    write_job(energy.join(usable.select("toid", "plane_id", "slope", "aspect", "is_flat", "roof_wkb"), ["toid", "plane_id"]), paths["pv_roof_plane"], p.job_id)
    roof = usable.select(F.concat_ws(":", "toid", "plane_id").alias("plane_id"), "roof_wkb", "aspect", "slope", "is_flat")
    write_job(polygons.panels(roof), paths["panels"], p.job_id)
    planes = drawn.groupBy("toid").agg(F.max("usable").alias("any_usable"), F.count("*").alias("n_planes"))
    reason = F.coalesce("exclusion_reason", F.when(F.col("n_planes").isNull(), "NO_ROOF_PLANES_DETECTED").when(~F.col("any_usable"), "ALL_ROOF_PLANES_UNUSABLE"))
    write_job(buildings.join(planes, "toid", "left").select("toid", reason.alias("exclusion_reason")), paths["pv_building"], p.job_id)
    return {n: count_rows(spark, path) for n, path in paths.items()}
