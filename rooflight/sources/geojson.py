"""GeoJSON: features of collections to rows, and rows to features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FILE = "type string, features array<struct<type: string, geometry: string, properties: string>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: file, geometry and properties as JSON texts, kind of geometry. Collections without features give none."""
    whole = spark.read.schema(_FILE).json(path, multiLine=True)
    features = whole.select(F.input_file_name().alias("file"), F.inline("features"))
    return features.select("file", F.get_json_object("geometry", "$.type").alias("kind"), "geometry", "properties")


def features(rows: DataFrame, ring: str) -> DataFrame:
    """Each row as the text of a polygon feature: ``ring`` is an array of [x, y], the other columns are its properties."""
    others = [c for c in rows.columns if c != ring]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(*others).alias("properties"),
    )
    return rows.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))
