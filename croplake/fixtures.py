"""Projections of the synthetic star-schema tables into the model tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croplake.catalog import NUTRIENTS
from croplake.session import shuffled, small_tasks

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
#: divisors of p_size that give the 13 nutrient percentages; 0 stands for "none"
NUTRIENT_DIVISORS = (1, 2, 4, 5, 8, 10, 20, 25, 40, 50, 80, 100, 0)
SQUARE = 0.25
#: shapes stand on a lattice of cells of so many degrees (a power of two: corners are exact), three
#: cells apart and so many in a row, so that they are as dense however many there are
CELL, LATTICE_WIDTH = 1 / 512, 900
#: rings of the shapes in corners of cells: kind, rings
SHAPES = (
    ("POLYGON", [[(0, 0), (4, 0), (4, 4), (0, 4)]]),
    ("POLYGON", [[(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)]]),
    ("POLYGON", [[(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4)]]),
    ("MULTIPOLYGON", [[(0, 0), (1, 0), (1, 4), (0, 4)], [(2, 0), (4, 0), (4, 4), (2, 4)]]),
    ("POLYGON", [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 3), (3, 3), (3, 1)]]),
    ("POINT", [[(2, 2)]]),
    ("POLYGON", [[(1, 1), (3, 1), (3, 3), (1, 3)]]),
    ("POLYGON", [[(0, 0), (1, 0), (1, 1), (0, 1)]]),
    ("POLYGON", [[(1, 0), (3, 0), (3, 4), (1, 4)]]),
)
#: which of them activities have
ACT_SHAPES = (0, 6, 7, 1, 5, 8)
NOW = "2024-01-30 15:00:00"
FIELD_START, FIELD_END = "1995-01-01 00:00:00", "2000-12-31 00:00:00"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _rank_of(column: str, values: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column)).cast("long")


class Tables:
    """Model tables over one folder of input tables; each is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        small_tasks(spark)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # ---- core ------------------------------------------------------------------------------
    @cached_property
    def organization(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("long").alias("organization_id"), F.col("r_name").alias("name")
        )

    @cached_property
    def _customer(self) -> DataFrame:
        return self.raw("customer").join(
            self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )

    @cached_property
    def grouper(self) -> DataFrame:
        null_id = F.lit(None).cast("long")
        roots = self.raw("region").select(
            F.col("r_regionkey").cast("long").alias("grouper_id"), F.col("r_name").alias("name"),
            F.col("r_regionkey").cast("long").alias("organization_id"),
            null_id.alias("parent_grouper_id"),
        )
        middle = self.raw("nation").select(
            (F.col("n_nationkey") + 100).cast("long").alias("grouper_id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("long").alias("organization_id"),
            F.col("n_regionkey").cast("long").alias("parent_grouper_id"),
        )
        leaves = (
            self._customer.select("n_nationkey", "n_regionkey", "c_mktsegment")
            .distinct()
            .select(
                self._segment_group().alias("grouper_id"),
                F.col("c_mktsegment").alias("name"),
                F.col("n_regionkey").cast("long").alias("organization_id"),
                (F.col("n_nationkey") + 100).cast("long").alias("parent_grouper_id"),
            )
        )
        return roots.unionByName(middle).unionByName(leaves)

    @staticmethod
    def _segment_group() -> Column:
        return (1000 + F.col("n_nationkey") * 10 + _rank_of("c_mktsegment", SEGMENTS)).cast("long")

    @cached_property
    def field(self) -> DataFrame:
        return self._customer.select(
            F.col("c_custkey").alias("field_id"),
            F.col("c_name").alias("name"),
            ntz(FIELD_START).alias("date_start"),
            ntz(FIELD_END).alias("date_end"),
            F.col("c_custkey").alias("geom_id"),
            F.col("n_regionkey").cast("long").alias("organization_id"),
            self._segment_group().alias("grouper_id"),
        )

    @cached_property
    def field_trial(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("field_trial_id"),
            F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("name"),
            F.col("o_custkey").alias("field_id"),
            F.col("o_orderdate").alias("date_start"),
            (F.col("o_orderdate") + F.expr("interval 180 days")).alias("date_end"),
            F.lit(None).cast("long").alias("geom_id"),
            F.lit(None).cast("long").alias("grouper_id"),
            F.lit("{}").alias("details"),
        )

    @cached_property
    def plot(self) -> DataFrame:
        pairs = self.raw("lineitem").select("l_orderkey", "l_linenumber").distinct()
        owner = self.raw("orders").select("o_orderkey", "o_custkey")
        line = F.col("l_linenumber")
        return pairs.join(shuffled(owner), F.col("l_orderkey") == F.col("o_orderkey")).select(
            (F.col("l_orderkey") * 10 + line).alias("plot_id"),
            F.concat(F.lit("P"), line.cast("string")).alias("name"),
            F.col("o_custkey").alias("field_id"),
            F.col("l_orderkey").alias("field_trial_id"),
            F.lit(None).cast("long").alias("geom_id"),
            (line % 4).cast("short").alias("treatment_id"),
            (line % 2).cast("short").alias("block_id"),
            F.lit(1).cast("short").alias("replication_id"),
        )

    @staticmethod
    def _points(table: DataFrame, key_name: str) -> DataFrame:
        key = F.col(key_name)
        return table.select(
            key.alias("point_id"),
            (F.lit(-96.0) + F.lit(6.0) * ((key * 37) % 1500) / F.lit(1500.0)).alias("lon"),
            (F.lit(40.0) + F.lit(8.0) * ((key * 91) % 1500) / F.lit(1500.0)).alias("lat"),
        )

    @staticmethod
    def _squares(points: DataFrame) -> DataFrame:
        def pt(dx: float, dy: float) -> Column:
            return F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") + dy).alias("y"))

        s = SQUARE
        ring = F.array(pt(0, 0), pt(s, 0), pt(s, s), pt(0, s), pt(0, 0))
        return points.select(
            F.col("point_id").alias("geom_id"), F.lit("POLYGON").alias("kind"),
            F.array(ring).alias("rings"),
        )

    @cached_property
    def points(self) -> DataFrame:
        return self._points(self.raw("customer"), "c_custkey")

    @cached_property
    def geom(self) -> DataFrame:
        return self._squares(self.points)

    @staticmethod
    def _shapes(keys: DataFrame, shape: Column) -> DataFrame:
        """Geometry of each ``geom_id``: the given one of SHAPES at the place of ``key``."""
        x0 = F.lit(-96.0) + F.pmod("key", F.lit(LATTICE_WIDTH)) * 3 * CELL
        y0 = F.lit(30.0) + F.floor(F.col("key") / LATTICE_WIDTH) * 3 * CELL

        def rings(number: int) -> Column:
            drawn = [g + g[:1] if len(g) > 1 else g for g in SHAPES[number][1]]
            return F.array(*[
                F.array(*[F.struct((F.col("x0") + x * CELL).alias("x"), (F.col("y0") + y * CELL).alias("y")) for x, y in g])
                for g in drawn
            ])

        made, kind = rings(0), F.lit(SHAPES[0][0])
        for number in range(1, len(SHAPES)):
            made = F.when(F.col("shape") == number, rings(number)).otherwise(made)
            kind = F.when(F.col("shape") == number, SHAPES[number][0]).otherwise(kind)
        return keys.withColumns({"x0": x0, "y0": y0, "shape": shape}).select(
            "geom_id", kind.alias("kind"), made.alias("rings")
        )

    @cached_property
    def shapes(self) -> DataFrame:
        """A shape for every field: squares, L and U shapes, two parts, one with a hole, points."""
        keys = self.raw("customer").select(F.col("c_custkey").alias("geom_id"), F.col("c_custkey").alias("key"))
        return self._shapes(keys, F.col("key") % 6)

    @cached_property
    def supplier_shapes(self) -> DataFrame:
        keys = self.raw("supplier").select(F.col("s_suppkey").alias("geom_id"), F.col("s_suppkey").alias("key"))
        return self._shapes(keys, (F.col("key") + 2) % 6)

    @cached_property
    def act_shapes(self) -> DataFrame:
        """Shapes that activities on a field may have, at the field's place."""
        kinds = F.posexplode(F.array(*[F.lit(k) for k in ACT_SHAPES])).alias("k", "which")
        keys = self.raw("customer").select(F.col("c_custkey").alias("key"), kinds)
        keys = keys.withColumn("geom_id", F.lit(10**9) + F.col("key") * 8 + F.col("k"))
        return self._shapes(keys, F.col("which"))

    @cached_property
    def shape_points(self) -> DataFrame:
        """A point near every field's shape, in half cells: corners, middles of edges and of cells."""
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("point_id"),
            (F.lit(-96.0) + (F.pmod(key, F.lit(LATTICE_WIDTH)) * 3 + (key * 7 % 9) / 2) * CELL).alias("lon"),
            (F.lit(30.0) + (F.floor(key / LATTICE_WIDTH) * 3 + (key * 5 % 9) / 2) * CELL).alias("lat"),
        )

    @cached_property
    def supplier_points(self) -> DataFrame:
        return self._points(self.raw("supplier"), "s_suppkey")

    @cached_property
    def supplier_geom(self) -> DataFrame:
        return self._squares(self.supplier_points)

    @cached_property
    def crop_type(self) -> DataFrame:
        return self.raw("orders").select("o_orderpriority").distinct().select(
            F.substring("o_orderpriority", 1, 1).cast("long").alias("crop_type_id"),
            F.upper(F.substring("o_orderpriority", 3, 40)).alias("crop"),
            F.lit(None).cast("string").alias("product_name"),
        )

    @cached_property
    def act(self) -> DataFrame:
        orders = self.raw("orders")
        first_plots = (
            self.raw("lineitem").filter("l_linenumber = 1").select("l_orderkey").distinct()
        )
        # only every third order hangs on a plot, so only those look their plot up
        on_plot = orders.filter("o_orderkey % 3 = 2").join(
            shuffled(first_plots), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
        )
        placed = orders.filter("o_orderkey % 3 <> 2").unionByName(on_plot)
        key = F.col("o_orderkey")
        steps = F.when(
            F.col("o_orderstatus").isin("O", "F"),
            F.array(F.lit("PLANT"), F.lit("HARVEST")),
        ).otherwise(F.array(F.lit("PLANT")))
        return placed.select("*", F.explode(steps).alias("act_type")).select(
            (key * 2 + (F.col("act_type") == "HARVEST").cast("long")).alias("act_id"),
            "act_type",
            F.when(F.col("act_type") == "PLANT", F.col("o_orderdate"))
            .otherwise(F.col("o_orderdate") + F.expr("interval 120 days"))
            .alias("date_performed"),
            F.when(key % 83 != 0, F.substring("o_orderpriority", 1, 1).cast("long"))
            .alias("crop_type_id"),
            F.when(key % 3 == 0, F.col("o_custkey")).alias("field_id"),
            F.when(key % 3 == 1, key).alias("field_trial_id"),
            F.when(key % 3 == 2, key * 10 + 1).alias("plot_id"),
            F.lit(None).cast("long").alias("geom_id"),
        )

    @cached_property
    def nutrient_source(self) -> DataFrame:
        return self._nutrient_source(F.col("p_size").cast("double"))

    @cached_property
    def nutrient_source_out_of_range(self) -> DataFrame:
        """The same table with ``n`` tripled on the largest parts, so that some pass 100."""
        size = F.col("p_size").cast("double")
        return self._nutrient_source(F.when(size == 50, size * 3).otherwise(size))

    def _nutrient_source(self, n: Column) -> DataFrame:
        size = F.col("p_size").cast("double")
        shares = [
            (n if name == "n" else F.lit(0.0) if d == 0 else size / F.lit(float(d))).alias(name)
            for name, d in zip(NUTRIENTS, NUTRIENT_DIVISORS)
        ]
        return self.raw("part").select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("r")).select(
            (F.col("p_partkey") * 10 + F.col("r")).alias("nutrient_source_id"),
            F.concat_ws("-", F.col("p_name"), F.col("p_partkey").cast("string")).alias("nutrient"),
            F.col("r").cast("long").alias("organization_id"),
            *shares,
        )

    @cached_property
    def app(self) -> DataFrame:
        # orders are fewer than line items, so they go to the customers
        owner = self.raw("orders").select("o_orderkey", "o_custkey").join(
            self._customer.select("c_custkey", "n_regionkey"), F.col("o_custkey") == F.col("c_custkey")
        )
        line = F.col("l_linenumber")
        digest = F.md5(
            F.concat_ws(
                "|", *[F.col(c).cast("string") for c in
                       ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
            ).cast("binary")
        )
        return (
            self.raw("lineitem")
            .join(shuffled(owner), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("app_id"),
                F.lit("FERTILIZER").alias("app_type"),
                F.lit("BROADCAST").alias("app_method"),
                F.col("l_shipdate").alias("date_applied"),
                F.col("l_quantity").alias("rate"),
                F.lit("lb/ac").alias("rate_unit"),
                F.lit(None).cast("long").alias("crop_type_id"),
                (F.col("l_partkey") * 10 + F.col("n_regionkey")).alias("nutrient_source_id"),
                F.when(line % 3 == 2, F.col("o_custkey")).alias("field_id"),
                F.when(line % 3 == 1, F.col("l_orderkey")).alias("field_trial_id"),
                F.when(line % 3 == 0, F.col("l_orderkey") * 10 + line).alias("plot_id"),
                F.lit(None).cast("long").alias("geom_id"),
            )
        )

    @cached_property
    def s3(self) -> DataFrame:
        """A file registry over suppliers; every seventh row names the wrong format."""
        key = F.col("s_suppkey")
        formats = F.array(*[F.lit(v) for v in ("csv", "json", "tif", "geojson", "parquet")])
        ending = F.element_at(formats, (key % 5 + 1).cast("int"))
        return self.raw("supplier").join(
            self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            key.alias("s3_id"),
            F.concat(F.lit("s3://files/"), F.col("s_name"), F.lit("."), ending).alias("s3_url"),
            F.when(key % 7 == 0, F.lit("CSV")).otherwise(F.upper(ending)).alias("file_format"),
            F.col("n_regionkey").cast("long").alias("organization_id"),
            F.when(key % 11 == 0, F.lit("OTHER")).when(key % 2 == 0, F.lit("SOIL")).alias("category"),
        )

    # ---- observations ----------------------------------------------------------------------
    @cached_property
    def observation_type(self) -> DataFrame:
        return self.raw("events").select("event_type").distinct().select(
            _rank_of("event_type", EVENT_TYPES).alias("observation_type_id"),
            F.upper("event_type").alias("observation_type_name"),
            F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.lit("SENSOR"))
            .cast("string").alias("category"),
        )

    @staticmethod
    def _unit_number() -> Column:
        return F.get_json_object("props", "$.k").cast("long") % 3

    @cached_property
    def unit_type(self) -> DataFrame:
        pairs = self.raw("events").select("event_type", self._unit_number().alias("u")).distinct()
        return pairs.select(
            (_rank_of("event_type", EVENT_TYPES) * 10 + F.col("u")).alias("unit_type_id"),
            F.concat(F.lit("U"), F.col("u").cast("string")).alias("unit_name"),
            _rank_of("event_type", EVENT_TYPES).alias("observation_type_id"),
        )

    @cached_property
    def observation(self) -> DataFrame:
        kind = _rank_of("event_type", EVENT_TYPES)
        return self.raw("events").select(
            F.col("event_id").alias("observation_id"),
            F.col("user_id").alias("field_id"),
            (kind * 10 + self._unit_number()).alias("unit_type_id"),
            kind.alias("observation_type_id"),
            (F.floor(F.col("value") / 10) * 10).cast("double").alias("value_observed"),
            F.col("ts").alias("date_observed"),
            F.col("user_id").alias("geom_id"),
            F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 4)
            .alias("observation_grouper_id"),
            F.when(F.col("event_id") % 3 == 0, F.format_string('{"depth":%d,"by":["a","b"]}', F.col("event_id") % 7))
            .alias("details"),
        )

    @cached_property
    def observation_group(self) -> DataFrame:
        return self.raw("region").filter("r_regionkey between 1 and 3").select(
            F.col("r_regionkey").cast("long").alias("observation_grouper_id"),
            F.col("r_name").alias("group_name"),
            F.lit(None).cast("string").alias("group_category"),
        )

    # ---- weather ---------------------------------------------------------------------------
    @cached_property
    def weather_type(self) -> DataFrame:
        return self.raw("events").select("event_type").distinct().select(
            _rank_of("event_type", EVENT_TYPES).alias("weather_type_id"),
            F.concat(F.col("event_type"), F.lit("_24h")).alias("weather_type"),
            F.expr("interval '1 00:00:00' day to second").alias("temporal_extent"),
        )

    @cached_property
    def daily(self) -> DataFrame:
        cell = F.col("user_id") % 40
        return self.raw("events").select(
            F.col("event_id").alias("daily_id"),
            (cell % 4).cast("int").alias("world_utm_id"),
            cell.alias("cell_id"),
            F.date_sub(F.to_date("ts"), (F.col("event_id") % 5).cast("int")).alias("date"),
            _rank_of("event_type", EVENT_TYPES).alias("weather_type_id"),
            F.col("value").cast("float").alias("value"),
            F.col("ts").alias("date_requested"),
        )

    @cached_property
    def world_utm(self) -> DataFrame:
        """The four polygons of the ``daily`` projection, with zone and offset."""
        polygon = F.col("world_utm_id")
        return self.daily.select("world_utm_id").distinct().select(
            "world_utm_id",
            (polygon + 14).cast("int").alias("utm_zone"),
            F.lit("T").alias("utm_row"),
            (polygon * 10800 - 21600).cast("int").alias("utc_offset_seconds"),
        )

    @cached_property
    def cell_centroid(self) -> DataFrame:
        """Made-up centroids of the cells of ``daily``."""
        cell = F.col("cell_id")
        return self.daily.select("world_utm_id", "cell_id").distinct().select(
            "world_utm_id", "cell_id",
            F.round(F.lit(-96.0) + cell * 0.05, 5).alias("lon"),
            F.round(F.lit(40.0) + cell * 0.04, 5).alias("lat"),
        )

    @cached_property
    def need(self) -> DataFrame:
        """Cells needed by fields: three of four cells of the fields, from 2019 + cell % 7 on."""
        cell = F.col("c_custkey") % 60
        return (
            self.raw("customer").select(cell.alias("cell_id")).distinct()
            .filter("cell_id % 4 <> 3 or cell_id >= 40")
            .select(
                (F.col("cell_id") % 4 + 14).cast("int").alias("utm_zone"),
                ((F.col("cell_id") % 4) * 10800 - 21600).cast("int").alias("utc_offset_seconds"),
                (F.col("cell_id") % 4).cast("int").alias("world_utm_id"),
                "cell_id",
                F.round(F.lit(-96.0) + F.col("cell_id") * 0.05, 5).alias("lon"),
                F.round(F.lit(40.0) + F.col("cell_id") * 0.04, 5).alias("lat"),
                F.make_date((F.lit(2019) + F.col("cell_id") % 7).cast("int"), F.lit(1), F.lit(1))
                .alias("date_first"),
                F.lit("2024-02-06").cast("date").alias("date_last"),
            )
        )

    @cached_property
    def request(self) -> DataFrame:
        """Requests: one per order, one to four points, one to three parameters, 1 to 30 days."""
        key = F.col("o_orderkey")
        zone = (F.col("o_custkey") % 60 + 1).cast("int")
        fail = F.col("o_orderstatus") == "P"
        params = F.slice(
            F.array(F.lit("t_min_2m_24h:C"), F.lit("t_max_2m_24h:C"), F.lit("precip_24h:mm")),
            F.lit(1), (key % 3 + 1).cast("int"),
        )
        coords = F.transform(
            F.sequence(F.lit(0), (key % 4).cast("int")),
            lambda i: F.struct(
                F.round(F.lit(40.0) + i * 0.5, 5).alias("lat"),
                F.round(F.lit(-96.0) + i * 0.25, 5).alias("lon"),
            ),
        )
        return self.raw("orders").select(
            key.alias("request_id"),
            zone.alias("zone"),
            (key % 7).cast("int").alias("utm_request_id"),
            coords.alias("coordinate_list"),
            F.col("o_orderdate").alias("startdate"),
            (F.col("o_orderdate") + F.make_dt_interval((key % 30).cast("int"))).alias("enddate"),
            params.alias("parameters"),
            F.when(fail, F.lit("FAIL")).otherwise(F.lit("SUCCESS")).alias("status"),
            F.when(fail & (key % 4 == 0), F.lit(-404.0))
            .when(fail & (key % 4 == 1), F.lit(-429.0))
            .when(fail & (key % 4 == 2), F.lit(-500.0))
            .when(fail, F.lit(-408.0))
            .otherwise((key % 50).cast("double")).alias("request_seconds"),
            F.when(fail & (key % 4 == 0), F.lit("NotFound('no data for t_min_2m_24h:C')"))
            .when(fail, F.lit("other")).alias("error"),
            F.col("o_orderdate").alias("date_requested"),
        )

    # ---- lineage ---------------------------------------------------------------------------
    @cached_property
    def execution(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("execution_id"), (F.col("o_custkey") % 7).alias("function_id")
        )

    @cached_property
    def _runs(self) -> DataFrame:
        """Executions as the side of a join that must stay a shuffle: orders are small to Spark, not as a hash table."""
        return shuffled(self.execution)

    @cached_property
    def s3_input_line(self) -> DataFrame:
        """S3 inputs by execution, before their executions are looked up; some may have none."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("execution_id"), (F.col("l_partkey") % 3).alias("s3_type_id"),
            (F.col("l_partkey") % 20).alias("s3_object_id"),
        )

    @cached_property
    def s3_output_line(self) -> DataFrame:
        """S3 outputs by execution, before their executions are looked up; some may have none."""
        return self.raw("lineitem").filter("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("execution_id"), F.lit("out").alias("s3_output_parameter_name"),
            (F.col("l_suppkey") % 3).alias("s3_type_id"), F.col("l_suppkey").alias("s3_object_id"),
        )

    @cached_property
    def s3_input_argument(self) -> DataFrame:
        return self.s3_input_line.join(self._runs, "execution_id").select(
            "function_id", "execution_id", "s3_type_id", "s3_object_id"
        )

    @cached_property
    def s3_output_argument(self) -> DataFrame:
        return self.s3_output_line.join(self._runs, "execution_id").select(
            "function_id", "execution_id", "s3_output_parameter_name", "s3_type_id", "s3_object_id"
        )

    @cached_property
    def observation_argument(self) -> DataFrame:
        return self.execution.filter("execution_id % 2 = 0").select(
            "function_id", "execution_id",
            (F.col("execution_id") % 5).alias("observation_type_id"),
            (F.col("execution_id") % 10).alias("number_of_observations"),
        )

    @cached_property
    def keyword_argument(self) -> DataFrame:
        return self.execution.filter("execution_id % 3 = 0").select(
            "function_id", "execution_id", F.lit("year").alias("keyword_name"),
            (F.col("execution_id") % 4).cast("double").alias("value_number"),
            F.lit(None).cast("string").alias("value_string"),
        )

    @cached_property
    def execution_key(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("execution_id"),
            (F.col("o_custkey") % 10).alias("geospatial_key_id"),
            F.month("o_orderdate").cast("long").alias("temporal_key_id"),
        )

    @cached_property
    def s3_object(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("s3_object_id"),
            F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("key"),
            F.lit("files").alias("bucket_name"),
            (F.col("o_orderkey") % 3).alias("s3_type_id"),
        )

    @cached_property
    def s3_object_key(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("s3_object_id"),
            (F.col("o_custkey") % 100).alias("geospatial_key_id"),
            F.month("o_orderdate").cast("long").alias("temporal_key_id"),
        )
