"""Reading and writing label files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEOMETRY = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])


def encodings(spark: SparkSession, path: str, fallback: str = "ISO-8859-1") -> dict[str, list[str]]:
    """The files below ``path`` by encoding: UTF-8 where every line is, else ``fallback``.

    Lines are read as bytes, so a large file is looked at in parts by many tasks. One row a file comes to the driver.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"))
    out: dict[str, list[str]] = {}
    for r in lines.groupBy("file").agg(F.bool_and("ok").alias("ok")).collect():
        out.setdefault("UTF-8" if r["ok"] else fallback, []).append(r["file"])
    return out


def read_labels(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str | None = None, encoding: str | None = "UTF-8") -> DataFrame:
    """Delimited labels with a header: tabs in ``.txt``, commas else (or by ``fmt``: csv or txt). NaN becomes null.

    With ``encoding`` None each file of ``path`` (a file, folder or pattern) is read as UTF-8 or, where a byte of it is broken as such, as
    Latin-1, which knows all bytes.
    """
    kind = fmt or ("txt" if path.endswith(".txt") else "csv")
    one = lambda files, code: spark.read.csv(files, sep="\t" if kind == "txt" else ",", header=True, schema=schema, encoding=code, nullValue="", enforceSchema=False)
    if encoding:
        df = one(path, encoding)
    else:
        by = sorted(encodings(spark, path).items()) or [("UTF-8", path)]
        df = one(by[0][1], by[0][0])
        for code, files in by[1:]:
            df = df.unionByName(one(files, code))
    return df.select([F.nanvl(c, F.lit(None).cast(t)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def read_geojson(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """Features of GeoJSON files: their properties, geometry type and coordinates (as text; ``rings`` types them)."""
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("properties", properties), T.StructField("geometry", GEOMETRY)])))])
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return rows.select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def rings(coordinates, geometry_type: str = "Polygon"):
    """Outer rings of polygons as arrays of (x, y), without the repeated last vertex."""
    if geometry_type != "Polygon":
        raise ValueError("only polygons have one outer ring; parts() takes multipolygons")
    outer = F.get(F.from_json(coordinates, "array<array<array<double>>>"), F.lit(0))
    return F.transform(F.slice(outer, F.lit(1), F.size(outer) - 1), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))


def parts(coordinates, geometry_type):
    """Polygons and multipolygons as lists of parts, each its outer ring and its holes; null for other geometries."""
    one = F.array(F.from_json(coordinates, "array<array<array<double>>>"))
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    ring = lambda r: F.transform(F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0))), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return F.transform(F.when(geometry_type == "Polygon", one).when(geometry_type == "MultiPolygon", many), lambda part: F.transform(part, ring))


def read_all_labels(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """All CSV files of a folder in one read, with ``dataset`` from the file's name."""
    df = spark.read.csv(f"{folder}/*.csv", header=True, schema=schema)
    return df.withColumn("dataset", F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)\.csv$", 1))


def write_labels(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, one folder a dataset."""
    df.write.mode(mode).partitionBy("dataset").parquet(path)
