"""Files in and out: vector and tabular files by driver, landed responses, key files, documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_DRIVERS = ("CSV", "JSON")
VECTOR_DRIVERS = ("GeoJSON",)
_GEOMETRY = "struct<type:string,coordinates:string>"
GEOSPATIAL_KEY_SCHEMA = "geom_id long, field_id long"
TEMPORAL_KEY_SCHEMA = "start_date date, end_date date"


# ---- vector files ---------------------------------------------------------------------------
def rings_of_coordinates(kind: str, coordinates: str) -> Column:
    """Rings from a GeoJSON geometry type and the JSON text of its coordinates.

    Parts of a multi geometry follow one another; a point is a ring of one point.
    """
    def point(p: str) -> str:
        return f"named_struct('x', {p}[0], 'y', {p}[1])"

    def parsed(depth: int) -> str:
        text = "array<" * depth + "double" + ">" * depth
        return f"from_json({coordinates}, '{text}')"

    line = f"transform({parsed(2)}, p -> {point('p')})"
    lines = f"transform({parsed(3)}, g -> transform(g, p -> {point('p')}))"
    parts = f"transform(flatten({parsed(4)}), g -> transform(g, p -> {point('p')}))"
    return F.expr(
        f"case upper({kind}) when 'POINT' then array(array({point(parsed(1))})) "
        f"when 'MULTIPOINT' then array({line}) when 'LINESTRING' then array({line}) "
        f"when 'MULTILINESTRING' then {lines} when 'POLYGON' then {lines} "
        f"when 'MULTIPOLYGON' then {parts} end"
    )


def coordinates_of_rings(kind: str, rings: str) -> Column:
    """The JSON text of GeoJSON coordinates; the reverse of :func:`rings_of_coordinates`.

    A multi polygon is written ring by ring, each as its own part.
    """
    nested = f"transform({rings}, g -> transform(g, p -> array(p.x, p.y)))"
    return F.expr(
        f"case upper({kind}) when 'POINT' then to_json({nested}[0][0]) "
        f"when 'MULTIPOINT' then to_json({nested}[0]) when 'LINESTRING' then to_json({nested}[0]) "
        f"when 'MULTIPOLYGON' then to_json(transform({nested}, g -> array(g))) "
        f"else to_json({nested}) end"
    )


def features_of_text(lines: DataFrame, properties: str, column: str = "value") -> DataFrame:
    """One GeoJSON feature per text line: property columns, ``kind`` and ``rings``."""
    schema = f"struct<properties:struct<{properties}>,geometry:{_GEOMETRY}>"
    parsed = lines.select(F.from_json(column, schema).alias("f")).filter("f is not null")
    return _with_rings(parsed)


def _with_rings(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "f.properties.*", F.upper("f.geometry.type").alias("kind"),
        rings_of_coordinates("f.geometry.type", "f.geometry.coordinates").alias("rings"),
    )


def read_features(
    spark: SparkSession, path: str, properties: str, layout: str = "collection"
) -> DataFrame:
    """Features of GeoJSON files.

    ``layout="collection"`` reads files that are one FeatureCollection: such a file is one JSON
    document, parsed by one task, after which its features are dealt out. ``"lines"`` reads files
    with one feature per line, which split; use it for anything large.
    """
    if layout == "lines":
        return features_of_text(spark.read.text(path), properties)
    if layout != "collection":
        raise ValueError('layout must be "collection" or "lines"')
    schema = (
        "type string, features array<struct<properties:struct<"
        f"{properties}>,geometry:{_GEOMETRY}>>"
    )
    documents = spark.read.schema(schema).json(path, multiLine=True)
    spread = documents.select(F.explode("features").alias("f")).repartition(
        spark.sparkContext.defaultParallelism
    )
    return _with_rings(spread)


def feature_text(df: DataFrame) -> DataFrame:
    """GeoJSON feature lines from columns, ``kind`` and ``rings``."""
    rest = [c for c in df.columns if c not in ("kind", "rings")]
    names = {k: v for k, v in (
        ("POINT", "Point"), ("MULTIPOINT", "MultiPoint"), ("LINESTRING", "LineString"),
        ("MULTILINESTRING", "MultiLineString"), ("POLYGON", "Polygon"),
        ("MULTIPOLYGON", "MultiPolygon"),
    )}
    proper = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*rest)),
            F.lit(',"geometry":{"type":"'), F.element_at(proper, F.col("kind")),
            F.lit('","coordinates":'), coordinates_of_rings("kind", "rings"), F.lit("}}"),
        ).alias("value")
    )


# ---- tabular files --------------------------------------------------------------------------
def read_table(
    spark: SparkSession, path: str, driver: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A CSV (with header) or JSON (one object per line) file by driver name."""
    if driver.upper() not in TABLE_DRIVERS:
        raise ValueError(f"no reader for driver {driver}")
    reader = spark.read.format(driver.lower())
    if driver.upper() == "CSV":
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif driver.upper() == "CSV":
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def new_key(prefix: str | None = None, delim: str = "_") -> str:
    """A key nobody used before, with an optional prefix."""
    key = str(uuid.uuid4())
    return key if prefix is None else delim.join([prefix, key])


def write_table(
    df: DataFrame, folder: str, driver: str, prefix: str | None = None, has_geometry: bool = False
) -> str:
    """Write a table under a new key in ``folder``; gives the path.

    With geometry the driver must be GeoJSON, written one feature per line.
    """
    path = f"{folder}/{new_key(prefix)}"
    if has_geometry:
        if driver not in VECTOR_DRIVERS:
            raise ValueError(f"no vector writer for driver {driver}")
        feature_text(df).write.text(path)
        return path
    if driver.upper() not in TABLE_DRIVERS:
        raise ValueError(f"no writer for driver {driver}")
    writer = df.write.format(driver.lower())
    if driver.upper() == "CSV":
        writer = writer.option("header", "true")
    writer.save(path)
    return path


# ---- landed responses and keys --------------------------------------------------------------
def one_row_per_response(landed: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """The JSON object of each response as columns, next to its key columns."""
    keys = [c for c in landed.columns if c != body]
    return landed.select(*keys, F.from_json(body, f"struct<{schema}>").alias("_r")).select(
        *keys, "_r.*"
    )


def many_rows_per_response(landed: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """One row per element of each response's JSON array, next to its key columns."""
    keys = [c for c in landed.columns if c != body]
    rows = F.from_json(body, f"array<struct<{schema}>>")
    return landed.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def read_geospatial_keys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GEOSPATIAL_KEY_SCHEMA).json(path, multiLine=True)


def read_temporal_keys(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TEMPORAL_KEY_SCHEMA).json(path, multiLine=True)


def write_documents(columns: DataFrame, fields: DataFrame, features: DataFrame, folder: str) -> None:
    """Feature columns, field documents and features per field as JSON lines, one folder each."""
    for name, df in (("columns", columns), ("fields", fields), ("field_to_features", features)):
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(
            f"{folder}/{name}"
        )
