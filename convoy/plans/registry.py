"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per operator or
published table, and its DuckDB twin.

All queries read the whole testdata tables (through the fixture views).  Queries that
exercise table writes put their tables in a fresh folder under the session's checkpoint
directory and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.casts import cast_columns, flatten_struct
from convoy.functions.time import parse_date, parse_timestamp, timestamp_micros_sql
from convoy.operators.intervals import interval_join
from convoy.operators.normalise import normalise_telemetry
from convoy.operators.sequence import number_rows, surrogate_key
from convoy.operators.tables import TableSpec, dedupe_latest, read_table, write_layouts, write_table
from convoy.plans import deliveries as dl
from convoy.plans import fleet as fl
from convoy.plans import oracles as oq
from convoy.plans.publish import FLEET_SPEC, RAW_LAYOUTS, SAMPLE_SCHEMA
from convoy.session import checkpoint_root, materialize, staging, workspace
from convoy.sources import files
from convoy.sources.arrays import scan_json_array
from convoy.sources import fixtures as fx

AS_OF = "2024-01-17"  # the "D-1" of the daily status question on the fixture dates
MEANS = oq.MEANS


def rounded(df: DataFrame, cols=MEANS, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols if c in df.columns})


# ---------------------------------------------------------------- scaled pipeline
def _inputs(spark, sf):
    return fx.shipments(spark, sf), fx.telemetry(spark, sf)


def _enriched(spark, sf):
    s, t = _inputs(spark, sf)
    return dl.enriched_orders(s, t)


def _silver(spark, sf):
    s, t = _inputs(spark, sf)
    return dl.silver_orders(dl.enriched_orders(s, t), dl.pending_orders(s))


def q_interval_join(spark, sf):
    return dl.telemetry_pairs(*_inputs(spark, sf))


def q_interval_join_plain(spark, sf):
    return dl.telemetry_pairs(*_inputs(spark, sf), method="plain")


def q_interval_join_delivered(spark, sf):
    return dl.delivered_samples(*_inputs(spark, sf))


def q_order_telemetry_means(spark, sf):
    return rounded(_enriched(spark, sf))


def _dense(spark, sf):
    return fx.shipments(spark, sf, fx.REFERENCE_FLEET), fx.telemetry(spark, sf, fx.REFERENCE_FLEET)


def q_order_means_fleet50(spark, sf):
    """Per-order means on the dense variant (50 vehicles, tens of samples per window)."""
    return rounded(dl.enriched_orders(*_dense(spark, sf)))


def q_order_means_prefix(spark, sf):
    """Per-order means from running sums, without a row per (order, sample)."""
    return rounded(dl.enriched_orders(*_inputs(spark, sf), method="prefix"))


def q_order_means_fleet50_prefix(spark, sf):
    """The same on the dense variant."""
    return rounded(dl.enriched_orders(*_dense(spark, sf), method="prefix"))


def q_order_means_fleet50_plain(spark, sf):
    return rounded(dl.enriched_orders(*_dense(spark, sf), method="plain"))


def q_order_means_fleet50_lanes(spark, sf):
    """Bucketed, with buckets of more than four rows of a side split into lanes."""
    return rounded(dl.enriched_orders(*_dense(spark, sf), method="bucket", lane_rows=4))


def q_pending_orders(spark, sf):
    return dl.pending_orders(fx.shipments(spark, sf))


def q_unmatched_orders(spark, sf):
    s, t = _inputs(spark, sf)
    return dl.unmatched_orders(s, dl.enriched_orders(s, t))


def q_silver_orders(spark, sf):
    return rounded(_silver(spark, sf))


def q_ml_orders(spark, sf):
    return rounded(dl.ml_orders(_enriched(spark, sf)))


def q_compliance_orders(spark, sf):
    return rounded(dl.compliance_orders(_enriched(spark, sf)))


def q_sales_dashboard(spark, sf):
    return dl.sales_dashboard(_silver(spark, sf))


def q_open_orders(spark, sf):
    return dl.open_orders(_silver(spark, sf))


def q_compliance_check(spark, sf):
    return dl.compliance_check(dl.compliance_orders(_enriched(spark, sf)))


def q_daily_status_counts(spark, sf):
    return dl.daily_status_counts(fx.shipments(spark, sf), AS_OF)


def q_daily_status_counts_curated(spark, sf):
    return dl.daily_status_counts_curated(dl.sales_dashboard(_silver(spark, sf)), AS_OF)


VEHICLE_ACTIVITY_SQL = """
SELECT vehicle_id, count(DISTINCT order_id) AS n_orders, min(order_date) AS first_day, max(order_date) AS last_day,
       round(max(speed), 6) AS top_speed, count_if(fuel_level < 40) AS n_low_fuel
FROM {orders}
GROUP BY vehicle_id
HAVING count(DISTINCT order_date) > 1
"""


DELIVERED_PER_DAY_SQL = """
SELECT order_date, count(*) AS n_orders, count(vehicle_id) AS n_with_vehicle
FROM {orders}
WHERE order_status = 'delivered'
GROUP BY order_date
"""


def q_sql_equality(spark, sf):
    """SQL text with an equality filter: orders delivered per day."""
    return files.run_sql(spark, DELIVERED_PER_DAY_SQL, orders=fx.shipments(spark, sf))


def q_sql_query(spark, sf):
    """SQL text over a published table: the activity of vehicles that were out on several days."""
    return files.run_sql(spark, VEHICLE_ACTIVITY_SQL, orders=dl.compliance_orders(_enriched(spark, sf)))


# ---------------------------------------------------------------- keyed tables
SILVER_SPEC = TableSpec("orders", "order_id", "order_date", ("order_date", "order_status"))
LAYOUTS = RAW_LAYOUTS  # the three bronze layouts of the publish job


def restamped(silver: DataFrame) -> DataFrame:
    """A later batch: every order in transit is delivered one day later."""
    return silver.filter(F.col("order_status") == dl.IN_TRANSIT).withColumns(
        {"order_status": F.lit(dl.DELIVERED), "order_date": F.date_add("order_date", 1)}
    )


def q_table_partitioned(spark, sf):
    path = write_table(_silver(spark, sf), SILVER_SPEC, workspace(spark, "orders"))
    return rounded(read_table(spark, path))


def q_table_replace(spark, sf):
    silver = _silver(spark, sf)
    path = workspace(spark, "orders")
    write_table(restamped(silver), SILVER_SPEC, path)
    write_table(silver, SILVER_SPEC, path, "replace")
    return rounded(read_table(spark, path))


def q_table_upsert(spark, sf):
    with staging(spark):
        silver, _ = materialize(_silver(spark, sf), "silver_source")
        path = write_table(silver, SILVER_SPEC, workspace(spark, "orders"))
        # the batch comes from the source, never lazily from the files the upsert replaces
        batch = restamped(silver)
        write_table(batch, SILVER_SPEC, path, "upsert")
        write_table(batch, SILVER_SPEC, path, "upsert")  # idempotent: same batch twice = once
    return rounded(read_table(spark, path))


def q_dedupe_latest(spark, sf):
    silver = _silver(spark, sf)
    return rounded(dedupe_latest(silver.unionByName(restamped(silver)), "order_id", "order_date"))


def q_pruned_read(spark, sf):
    path = write_table(_silver(spark, sf), SILVER_SPEC, workspace(spark, "orders"))
    t = read_table(spark, path)
    return rounded(
        t.filter(
            (F.col("order_date") == F.lit(AS_OF).cast("date"))
            & (F.col("order_status") == dl.DELIVERED)
            & (F.col("speed") > 50)
        )
    )


def q_multi_layout(spark, sf):
    paths = write_layouts(_enriched(spark, sf), LAYOUTS, workspace(spark, "bronze"))
    return rounded(read_table(spark, paths["raw_date_partition"]))


def q_layouts_read_back(spark, sf):
    """All three bronze layouts, read back."""
    paths = write_layouts(_enriched(spark, sf), LAYOUTS, workspace(spark, "bronze"))
    out = None
    for name, path in paths.items():
        rows = read_table(spark, path).withColumn("layout", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return rounded(out)


def q_upsert_unpartitioned(spark, sf):
    """Two successive upserts into a table without partitions: delivered orders get a day more,
    then pending orders a day less."""
    spec = TableSpec("orders", "order_id", "revision", ())
    s = fx.shipments(spark, sf).select("order_id", "order_status", "order_date").withColumn("revision", F.lit(0))
    path = write_table(s, spec, workspace(spark, "orders"))
    later = s.filter(F.col("order_status") == dl.DELIVERED)
    write_table(later.withColumns({"order_date": F.date_add("order_date", 1), "revision": F.lit(1)}), spec, path, "upsert")
    earlier = s.filter(F.col("order_status") == dl.PENDING)
    write_table(earlier.withColumns({"order_date": F.date_sub("order_date", 1), "revision": F.lit(2)}), spec, path, "upsert")
    return read_table(spark, path)


def q_upsert_moved_partitions(spark, sf):
    """Keys that move between boolean and fractional-second partitions: every open order closes, so
    its old partitions empty."""
    spec = TableSpec("orders", "order_id", "revision", ("is_open", "slot"))
    s = fx.shipments(spark, sf).selectExpr(
        "order_id",
        "order_status <> 'delivered' AS is_open",
        "CASE WHEN order_status <> 'delivered' THEN timestamp_ntz'2024-01-01 00:00:00.5' "
        "ELSE timestamp_ntz'2024-01-02 00:00:00' END AS slot",
        "0 AS revision",
    )
    path = write_table(s, spec, workspace(spark, "orders"))
    closed = s.filter("is_open").selectExpr(
        "order_id", "false AS is_open", "timestamp_ntz'2024-01-03 00:00:00.25' AS slot", "1 AS revision"
    )
    write_table(closed, spec, path, "upsert")
    return read_table(spark, path)


def q_upsert_zone_free_partitions(spark, sf):
    """Upserts into zone-free timestamp partitions under two session zones: pending orders change
    in place, orders in transit move to a partition an hour later."""
    spec = TableSpec("orders", "order_id", "revision", "slot")
    s = fx.shipments(spark, sf).selectExpr(
        "order_id",
        "order_status",
        "cast(date_trunc('QUARTER', cast(order_date AS timestamp_ntz)) AS timestamp_ntz) + INTERVAL '02:30:00' HOUR TO SECOND AS slot",
        "0 AS revision",
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    with staging(spark):
        s, _ = materialize(s, "slots")
        path = write_table(s, spec, workspace(spark, "orders"))
        changed = s.filter(F.col("order_status") == dl.PENDING).withColumn("revision", F.lit(1))
        moved = s.filter(F.col("order_status") == dl.IN_TRANSIT).selectExpr(
            "order_id", "order_status", "slot + INTERVAL '1' HOUR AS slot", "2 AS revision"
        )
        try:
            for session_zone, batch in (("America/New_York", changed), ("UTC", moved)):
                spark.conf.set("spark.sql.session.timeZone", session_zone)
                write_table(batch, spec, path, "upsert")
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    return read_table(spark, path)


def _bounds_query(spark, sf, start: str, end: str, at: str) -> DataFrame:
    s = fx.shipments(spark, sf).filter("vehicle_id IS NOT NULL").selectExpr(
        "order_id", "vehicle_id", f"{start} AS opens", f"{end} AS closes"
    )
    t = fx.telemetry(spark, sf).selectExpr("vehicle_id", f"{at} AS at", "speed")
    pairs = interval_join(s, t, start="opens", end="closes", at="at", on=("vehicle_id",), method="bucket")
    return pairs.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_samples"), F.round(F.max("speed"), 6).alias("top_speed"))


def q_interval_join_dates(spark, sf):
    """Whole days as bounds: dates against dates."""
    return _bounds_query(spark, sf, "cast(delivery_start_datetime AS date)", "cast(delivery_end_datetime AS date)",
                         "cast(sample_ts AS date)")


def q_interval_join_date_bounds(spark, sf):
    """Dates as bounds (their midnights) of zone-free samples."""
    return _bounds_query(spark, sf, "cast(delivery_start_datetime AS date)", "cast(delivery_end_datetime AS date)", "sample_ts")


def q_interval_join_zoned(spark, sf):
    """Zoned instants on both sides (UTC, whatever the session's zone)."""
    z = "to_timestamp_ltz(concat(date_format({}, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), 'Z'), 'yyyy-MM-dd HH:mm:ss.SSSSSSX')"
    return _bounds_query(spark, sf, z.format("delivery_start_datetime"), z.format("delivery_end_datetime"), z.format("sample_ts"))


def q_interval_join_open_end(spark, sf):
    """Numbers as bounds: a decimal start, and no end (infinity) for orders in transit."""
    first, last, at = (
        f"({timestamp_micros_sql(c)} / 1000000.0D)" for c in ("delivery_start_datetime", "delivery_end_datetime", "sample_ts")
    )
    last = f"CASE WHEN order_status = 'in transit' THEN double('infinity') ELSE {last} END"
    return _bounds_query(spark, sf, f"cast({first} AS decimal(20,6))", last, at)


def q_stream_upsert_orders(spark, sf):
    """The orders file as a stream (``orders.parquet`` of the testdata folder), shaped into
    delivery orders per micro-batch and merged into a keyed table; returns the table."""
    from convoy.streaming.ingest import file_stream, upsert_stream

    orders_schema = fx.read_table(spark, sf, "orders").schema
    stream = file_stream(spark, sf, orders_schema, "parquet", {"pathGlobFilter": "orders.parquet"})
    fleet = fx.fleet_size(spark, sf)
    spec = TableSpec("orders", "order_id", "order_date", ("order_date", "order_status"))
    root = workspace(spark, "stream")
    q = upsert_stream(stream, spec, f"{root}/table", f"{root}/_checkpoint", lambda b: fx.shipments_from(b, fleet))
    q.awaitTermination()
    return read_table(spark, f"{root}/table")


# ---------------------------------------------------------------- ingest (text round trips)
def _shipments_text(spark, sf):
    s = fx.shipments(spark, sf)
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return s.select(
        "order_id",
        "order_status",
        F.date_format(F.col("order_date").cast("timestamp_ntz"), fmt).alias("order_date"),
        F.col("delivery_latitude").cast("string").alias("delivery_latitude"),
        F.col("delivery_longitude").cast("string").alias("delivery_longitude"),
        F.date_format("delivery_start_datetime", fmt).alias("delivery_start_datetime"),
        F.date_format("delivery_end_datetime", fmt).alias("delivery_end_datetime"),
        "vehicle_id",
    )


def q_ingest_orders_csv(spark, sf):
    path = files.sink_csv(_shipments_text(spark, sf), workspace(spark, "orders_csv"))
    raw = files.scan_csv(spark, path)
    return raw.select(
        "order_id",
        "order_status",
        parse_date("order_date").alias("order_date"),
        *[F.col(c).try_cast("float").alias(c) for c in ("delivery_latitude", "delivery_longitude")],
        parse_timestamp("delivery_start_datetime").alias("delivery_start_datetime"),
        parse_timestamp("delivery_end_datetime").alias("delivery_end_datetime"),
        "vehicle_id",
    )


def q_ingest_rejects(spark, sf):
    """Order text in which one priority class writes its dates as dd.MM.yyyy: those rows
    are the rejects of the permissive typed ingest."""
    from convoy.operators.typed import typed_with_rejects

    o = fx.read_table(spark, sf, "orders")
    text = o.selectExpr(
        "format_string('O%07d', o_orderkey) AS order_id",
        "o_orderpriority AS order_priority",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN date_format(o_orderdate, 'dd.MM.yyyy') "
        "ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.SSSSSS') END AS order_date",
        "cast(o_totalprice AS string) AS delivery_cost",
    )
    path = files.sink_csv(text, workspace(spark, "orders_text"))
    _, rejects = typed_with_rejects(
        files.scan_csv(spark, path), {"order_date": ("date", None), "delivery_cost": ("double", None)}
    )
    return rejects.select("order_id", "order_priority", "order_date", F.col("rejected_columns")[0].alias("rejected"))


def q_ingest_malformed(spark, sf):
    """Order lines of which some lack their last field, some have one too many and some a date that
    does not parse: the rejects of a scan that parses the text once."""
    from convoy.operators.typed import typed_with_rejects

    fields = fx.read_table(spark, sf, "orders").selectExpr(
        "o_orderpriority AS p",
        "format_string('O%07d', o_orderkey) AS id",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS d",
        "cast(o_custkey AS string) AS c",
    )
    line = F.when(F.col("p") == "2-HIGH", F.concat_ws(",", "id", "d")).when(
        F.col("p") == "3-MEDIUM", F.concat_ws(",", "id", "d", "c", F.lit("more"))
    )
    lines = fields.select(F.coalesce(line, F.concat_ws(",", "id", "d", "c")))
    text = files.sink_csv_lines(lines, workspace(spark, "order_text"), "order_id,order_date,customer")
    _, rejects = typed_with_rejects(
        files.scan_csv(spark, text, malformed="line"), {"order_date": ("date", None), "customer": ("bigint", None)},
        malformed="line", stage="order_text",
    )
    return rejects.select("order_id", "customer", "line", F.array_join("rejected_columns", ",").alias("rejected"))


def q_ingest_telemetry_json_array(spark, sf):
    """Telemetry from files that hold arrays of a thousand records, read by the scan that splits them."""
    path = workspace(spark, "samples_arrays")
    numbered = fx.raw_samples(spark, sf, keep=("event_id",))
    record = F.to_json(F.struct(*[c for c in numbered.columns if c != "event_id"]))
    arrays = numbered.groupBy(F.expr("event_id div 1000")).agg(F.concat_ws(", ", F.collect_list(record)).alias("all"))
    arrays.select(F.concat(F.lit("["), "all", F.lit("]"))).write.text(path)
    return normalise_telemetry(scan_json_array(spark, path, SAMPLE_SCHEMA), vehicle_id=F.col("vehicle"))


def q_ingest_telemetry_csv(spark, sf):
    t = fx.telemetry(spark, sf).withColumn(
        "sample_ts", F.date_format("sample_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    path = files.sink_csv(t, workspace(spark, "telemetry_csv"))
    raw = files.scan_csv(spark, path).withColumn("sample_ts", parse_timestamp("sample_ts"))
    return cast_columns(raw, (*MEANS, "latitude", "longitude"), "float")


def q_ingest_telemetry_json(spark, sf):
    path = workspace(spark, "samples_json")
    fx.raw_samples(spark, sf).write.mode("overwrite").json(path)
    raw = files.scan_json(spark, path, SAMPLE_SCHEMA)
    return normalise_telemetry(raw, vehicle_id=F.col("vehicle"))


def q_ingest_telemetry_csv_typed(spark, sf):
    """The same text read with a declared schema (zone-free timestamps, floats)."""
    t = fx.telemetry(spark, sf)
    path = files.sink_csv(t, workspace(spark, "telemetry_csv"))
    schema = ", ".join(f"`{c}` {'float' if kind == 'double' else kind}" for c, kind in t.dtypes)
    return files.scan_csv_typed(spark, path, schema)


def q_view_by_name(spark, sf):
    """A DataFrame registered as a view and asked by name."""
    files.register_view(fx.shipments(spark, sf), "convoy_shipments")
    return spark.sql("SELECT order_status, count(*) AS n_orders, max(order_date) AS last_day "
                     "FROM convoy_shipments GROUP BY order_status")


def q_normalise_service(spark, sf):
    """Telemetry records with the two service fields."""
    raw = fx.raw_samples(spark, sf).withColumns({
        "maintenance_required": F.col("timestamp") % 5 == 0,
        "last_service_date": F.expr("concat(1 + timestamp % 12, '/', 1 + timestamp % 28, '/2023')"),
    })
    return normalise_telemetry(raw, vehicle_id=F.col("vehicle"), service_fields=True)


def q_normalise_telemetry(spark, sf):
    return fx.samples(spark, sf)


def q_normalise_orders(spark, sf):
    return fx.parcels(spark, sf)


def q_sink_parquet_ms(spark, sf):
    path = files.sink_parquet_ms(fx.telemetry(spark, sf), workspace(spark, "telemetry_ms"))
    return files.scan(spark, path, "parquet")


def q_flatten_struct(spark, sf):
    r = fx.raw_samples(spark, sf)
    nested = r.select(
        "vehicle",
        F.struct("latitude", "longitude").alias("position"),
        F.struct("battery_temperature", "engine_temperature", "speed", "fuel_level", "tire_pressure").alias(
            "readings"
        ),
        "timestamp",
    )
    return flatten_struct(nested, sep="_")


# ---------------------------------------------------------------- small pipeline
def _fleet(spark, sf):
    checkpoint_root(spark)
    return fl.build(fx.parcels(spark, sf), fx.samples(spark, sf))


def q_chained_windows(spark, sf):
    return fl.chained_windows(fx.parcels(spark, sf))


def q_chained_windows_per_vehicle(spark, sf):
    """A chain of windows, and numbers, per vehicle; every third order is on one vehicle."""
    vehicle = "CASE WHEN seq % 3 = 0 THEN 0 ELSE 1 + cast(split(delivery_address, ' ')[0] AS bigint) % 50 END"
    p = fx.parcels(spark, sf).withColumn("vehicle_id", F.expr(vehicle))
    return fl.chained_windows(p, number_as="stop", partition_by=("vehicle_id",))


def q_row_numbers(spark, sf):
    """Orders numbered by status, start and id: text, moments with NULLs, and a tiebreak."""
    s = fx.shipments(spark, sf).select("order_id", "order_status", "delivery_start_datetime")
    return number_rows(s, ("order_status", "delivery_start_datetime", "order_id"), "place")


def q_surrogate_key(spark, sf):
    return surrogate_key(fx.parcels(spark, sf), "seq", "order_id")


def q_daily_vehicle_means(spark, sf):
    return rounded(fl.daily_vehicle_means(fx.samples(spark, sf)))


def q_window_enrich_left(spark, sf):
    chained, _ = materialize(fl.chained_windows(fx.parcels(spark, sf)), "chained_orders")
    return rounded(fl.enrich_windows(chained, fx.samples(spark, sf)))


def q_window_enrich_all_groups(spark, sf):
    """Every (vehicle, date) group of an order's window, a row each; orders without samples keep one."""
    chained, _ = materialize(fl.chained_windows(fx.parcels(spark, sf)), "chained_orders")
    return rounded(fl.enrich_windows(chained, fx.samples(spark, sf), groups="all"))


def q_fleet_transit_known_speed(spark, sf):
    """Open orders with a known speed, whatever else is missing."""
    return rounded(fl.transit_orders(_fleet(spark, sf)["bronze_layer"], required=("speed",)))


def _fleet_table(name):
    def q(spark, sf):
        return rounded(_fleet(spark, sf)[name])

    q.__name__ = f"q_fleet_{name}"
    return q


def q_published_sales_dashboard(spark, sf):
    """The whole scaled pipeline published (bronze -> silver -> gold, each layer read back from
    the written tables); returns the gold dashboard table."""
    from convoy.plans.publish import publish_deliveries

    paths = publish_deliveries(spark, *_inputs(spark, sf), workspace(spark, "published"))
    return read_table(spark, paths["sales_dashboard"])


def q_published_temperature_alerts(spark, sf):
    """The whole small pipeline published; returns the gold temperature-alert table."""
    from convoy.plans.publish import publish_fleet

    paths = publish_fleet(spark, fx.parcels(spark, sf), fx.samples(spark, sf), workspace(spark, "published"))
    return rounded(read_table(spark, paths["temperature_alerts"]))


def q_job_deliveries_files(spark, sf):
    """The scaled job from raw text: orders and telemetry written as CSV, then cast, joined and
    published; returns the gold compliance table."""
    from convoy.plans.publish import deliveries_from_files

    t = fx.telemetry(spark, sf).withColumn("timestamp", F.date_format("sample_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    orders = files.sink_csv(_shipments_text(spark, sf), workspace(spark, "orders_csv"))
    telemetry = files.sink_csv(t.drop("sample_ts"), workspace(spark, "telemetry_csv"))
    paths = deliveries_from_files(spark, orders, telemetry, workspace(spark, "published"))
    return read_table(spark, paths["compliance_check"])


def q_job_fleet_files(spark, sf):
    """The small job from raw text: orders CSV in delivery order, telemetry JSON; returns the bronze
    table without its file position."""
    from convoy.plans.publish import fleet_from_files

    p = fx.raw_parcels(spark, sf).orderBy("seq").drop("seq")
    orders = files.sink_csv(p, workspace(spark, "parcels_csv"))
    telemetry = workspace(spark, "samples_json")
    fx.raw_samples(spark, sf).write.json(telemetry)
    paths = fleet_from_files(spark, orders, telemetry, workspace(spark, "published"))
    return rounded(read_table(spark, paths["bronze_layer"])).drop("seq")


def q_status_lookup(spark, sf):
    # the status is an order column: look it up among the orders, then enrich those found
    found = fl.orders_with_status(fl.numbered_chain(fx.parcels(spark, sf)))
    return rounded(fl.bronze_of(found, fx.samples(spark, sf)))


def q_status_lookup_base(spark, sf):
    """The same question to the stored base file (plain parquet, millisecond timestamps)."""
    path = files.sink_parquet_ms(_fleet(spark, sf)["bronze_layer"], workspace(spark, "base"))
    return rounded(fl.orders_with_status(files.scan_parquet(spark, path)))


def q_status_lookup_table(spark, sf):
    """The same question to the table as it is published, clustered by status."""
    path = write_table(_fleet(spark, sf)["bronze_layer"], FLEET_SPEC, workspace(spark, "bronze_layer"), assume_unique=True)
    return rounded(fl.orders_with_status(read_table(spark, path)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # scaled pipeline
    "interval_join": q_interval_join,
    "interval_join_plain": q_interval_join_plain,
    "interval_join_delivered": q_interval_join_delivered,
    "order_telemetry_means": q_order_telemetry_means,
    "order_means_fleet50": q_order_means_fleet50,
    "order_means_fleet50_plain": q_order_means_fleet50_plain,
    "order_means_prefix": q_order_means_prefix,
    "order_means_fleet50_prefix": q_order_means_fleet50_prefix,
    "interval_join_dates": q_interval_join_dates,
    "interval_join_date_bounds": q_interval_join_date_bounds,
    "interval_join_zoned": q_interval_join_zoned,
    "interval_join_open_end": q_interval_join_open_end,
    "pending_orders": q_pending_orders,
    "unmatched_orders": q_unmatched_orders,
    "silver_orders": q_silver_orders,
    "ml_orders": q_ml_orders,
    "compliance_orders": q_compliance_orders,
    "sales_dashboard": q_sales_dashboard,
    "open_orders": q_open_orders,
    "compliance_check": q_compliance_check,
    "daily_status_counts": q_daily_status_counts,
    "daily_status_counts_curated": q_daily_status_counts_curated,
    "sql_query": q_sql_query,
    "sql_equality": q_sql_equality,
    "stream_upsert_orders": q_stream_upsert_orders,
    # keyed tables
    "table_partitioned": q_table_partitioned,
    "table_replace": q_table_replace,
    "table_upsert": q_table_upsert,
    "dedupe_latest": q_dedupe_latest,
    "pruned_read": q_pruned_read,
    "multi_layout": q_multi_layout,
    "layouts_read_back": q_layouts_read_back,
    "upsert_unpartitioned": q_upsert_unpartitioned,
    "upsert_moved_partitions": q_upsert_moved_partitions,
    "upsert_zone_free_partitions": q_upsert_zone_free_partitions,
    # ingest
    "ingest_orders_csv": q_ingest_orders_csv,
    "ingest_telemetry_csv": q_ingest_telemetry_csv,
    "ingest_telemetry_csv_typed": q_ingest_telemetry_csv_typed,
    "view_by_name": q_view_by_name,
    "ingest_rejects": q_ingest_rejects,
    "ingest_malformed": q_ingest_malformed,
    "ingest_telemetry_json": q_ingest_telemetry_json,
    "ingest_telemetry_json_array": q_ingest_telemetry_json_array,
    "normalise_telemetry": q_normalise_telemetry,
    "normalise_service": q_normalise_service,
    "normalise_orders": q_normalise_orders,
    "sink_parquet_ms": q_sink_parquet_ms,
    "flatten_struct": q_flatten_struct,
    # small pipeline
    "chained_windows": q_chained_windows,
    "chained_windows_per_vehicle": q_chained_windows_per_vehicle,
    "row_numbers": q_row_numbers,
    "surrogate_key": q_surrogate_key,
    "daily_vehicle_means": q_daily_vehicle_means,
    "window_enrich_left": q_window_enrich_left,
    "window_enrich_all_groups": q_window_enrich_all_groups,
    "fleet_transit_known_speed": q_fleet_transit_known_speed,
    "order_means_fleet50_lanes": q_order_means_fleet50_lanes,
    "fleet_bronze": _fleet_table("bronze_layer"),
    "fleet_transit": _fleet_table("transit_orders"),
    "fleet_successful": _fleet_table("successful_orders"),
    "fleet_daily": _fleet_table("daily_orders"),
    "fleet_speeding": _fleet_table("speed_inefficiency"),
    "fleet_finances": _fleet_table("finances"),
    "fleet_temperature_alerts": _fleet_table("temperature_alerts"),
    "status_lookup": q_status_lookup,
    "status_lookup_base": q_status_lookup_base,
    "status_lookup_table": q_status_lookup_table,
    "published_sales_dashboard": q_published_sales_dashboard,
    "published_temperature_alerts": q_published_temperature_alerts,
    "job_deliveries_files": q_job_deliveries_files,
    "job_fleet_files": q_job_fleet_files,
}
