"""Registry of the library's queries over the driver tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
whole driver tables (through :mod:`fleetlake.sources.testdata`). The key
that print a surrogate id or a wall-clock time leave that column out, so
the result is a pure function of the input tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .config import DEFAULT_BOUNDS, ImputePolicy, RouteMap
from .functions.bands import band_sql, band_table
from .functions.numeric import round_half_up
from .functions.text import canonical_route, minute_bucket
from .functions.time import parse_iso_utc, parse_ts, with_date_parts
from .operators import aggregate as agg
from .operators import audit, insights, quality, sales, starschema
from .operators.dedup import split_duplicates
from .operators.enrich import impute_temperature, mean_temperature
from .plans import jobs, local, manual, warehouse
from .session import scratch_path
from .sinks.files import (append_rows, check_not_null, create_quality_views, create_table_if_absent, replace_table,
                          write_csv, write_json_records)
from .sources import testdata as td
from .sources.files import (first_available, ingest_raw, json_array_to_ndjson, load_pings, load_weather_json,
                            scan_csv, scan_ndjson, scan_table)
from .streaming import ingest, live, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ inputs

def _pings(spark, sf):
    return td.pings(spark, sf)


def _weather(spark, sf):
    return td.weather(spark, sf)


def _enriched(spark, sf):
    return warehouse.clean_enriched(_pings(spark, sf), _weather(spark, sf))


def _live(spark, sf):
    events = live.events_from_pings(_pings(spark, sf))
    return live.process_batch(events, impute_temperature(_weather(spark, sf)))


def _positions(spark, sf):
    return _live(spark, sf)[0].drop("viaje_id")


def _outcomes(spark, sf):
    return _live(spark, sf)[1]


def _fact(spark, sf):
    return starschema.fact_trips(_pings(spark, sf), starschema.dim_weather(_weather(spark, sf)))


def _mart(spark, sf):
    return sales.wide_mart(sales.fact_transactions(td.transactions(spark, sf)),
                           sales.dim_users(td.users(spark, sf)), sales.dim_regions(td.regions(spark, sf)),
                           sales.dim_items(td.items(spark, sf)),
                           sales.dim_payment_methods(td.payment_methods(spark, sf)))


def _votes(spark, sf):
    return sales.voting_view(td.read_table(spark, sf, "events"), td.items(spark, sf), td.regions(spark, sf))


# ------------------------------------------------------------ 2.1 sources

@register("s11_load_stats")
def s11(spark, sf):
    p = _pings(spark, sf).agg(F.count(F.lit(1)).alias("registros_gps"))
    w = _weather(spark, sf).agg(F.count(F.lit(1)).alias("registros_clima"))
    return p.crossJoin(w)


# ------------------------------------------------------------ 2.3 quality

@register("v1_split_range_invalid")
def v1(spark, sf):
    return quality.split_range(_pings(spark, sf), C.SPEED, C.SPEED_MIN, C.SPEED_MAX)[1]


@register("v2_split_nulls_invalid")
def v2(spark, sf):
    return quality.split_nulls(_weather(spark, sf), ["fecha", "condicion", "temperatura_promedio"])[1]


@register("v3_duplicates_evidence")
def v3(spark, sf):
    return split_duplicates(_pings(spark, sf))[1]


@register("v3_dedup_kept")
def v3_kept(spark, sf):
    return split_duplicates(_pings(spark, sf))[0]


@register("v4_split_bbox_invalid")
def v4(spark, sf):
    return quality.split_bbox(_pings(spark, sf))[1]


@register("v5_split_date_format_invalid")
def v5(spark, sf):
    p = _pings(spark, sf).withColumn("_ts_text", F.col(C.TS).cast("string"))
    return quality.split_date_format(p, "_ts_text")[1].drop("_ts_text")


@register("v6_validation_report")
def v6(spark, sf):
    return quality.local_validation_report(_pings(spark, sf))


@register("v6_report_summary")
def v6_summary(spark, sf):
    return quality.report_summary(quality.local_validation_report(_pings(spark, sf)))


@register("t7_invalid_sample")
def t7(spark, sf):
    st = local.stages(_pings(spark, sf), _weather(spark, sf))
    cols = [C.BUS, C.ROUTE, C.SPEED, C.LAT, C.LON, C.TS]
    speed = C.TEXT_RANGE.format(int(DEFAULT_BOUNDS.speed_min), int(DEFAULT_BOUNDS.speed_max), C.SPEED)
    return quality.sample_invalid([(C.RULE_DUPLICATES, C.TEXT_DUPLICATES, st["duplicados"].select(*cols)),
                                   (C.RULE_SPEED, speed, st["velocidades_invalidas"].select(*cols)),
                                   (C.RULE_COORDS, C.TEXT_COORDS, st["coordenadas_invalidas"].select(*cols))])


@register("v7_valid_pings")
def v7(spark, sf):
    return warehouse.valid_pings(_pings(spark, sf))


@register("v8_invalid_evidence")
def v8(spark, sf):
    return quality.invalid_evidence(_pings(spark, sf))


@register("v9_raw_profile")
def v9(spark, sf):
    return quality.raw_profile(_pings(spark, sf))


@register("v10_gps_null_profile")
def v10(spark, sf):
    return quality.gps_null_profile(_pings(spark, sf))


@register("v11_weather_null_profile")
def v11(spark, sf):
    return quality.weather_null_profile(_weather(spark, sf))


@register("v12_dataset_profile")
def v12(spark, sf):
    return quality.dataset_profile(_pings(spark, sf))


@register("v13_weather_profile")
def v13(spark, sf):
    return quality.weather_profile(_weather(spark, sf))


@register("v14_expected_rows")
def v14(spark, sf):
    return quality.expect_rows(_pings(spark, sf), 10100, "gps")


@register("v16_live_rejections")
def v16(spark, sf):
    o = _outcomes(spark, sf)
    return o.where(F.col("outcome") == live.REJECTED_INVALID)


@register("v17_error_summary")
def v17(spark, sf):
    o = _outcomes(spark, sf)
    tagged = o.withColumn("error", F.when(F.col("outcome") == live.REJECTED_INVALID, F.col("reason")))
    return audit.quarantine_summary(tagged)


@register("v18_dq_duplicates")
def v18(spark, sf):
    return quality.dq_duplicates(_positions(spark, sf))


@register("v19_dq_anomalous_speed")
def v19(spark, sf):
    return quality.dq_anomalous_speed(_positions(spark, sf))


@register("v20_dq_outside_box")
def v20(spark, sf):
    return quality.dq_outside_box(_positions(spark, sf))


@register("v21_load_snapshot")
def v21(spark, sf):
    return quality.load_snapshot(_pings(spark, sf), _enriched(spark, sf), with_time=False)


@register("v22_duplicate_transactions")
def v22_dup(spark, sf):
    return sales.duplicate_transactions(sales.fact_transactions(td.transactions(spark, sf)))


@register("v22_anomalous_amounts")
def v22_anom(spark, sf):
    return sales.anomalous_amounts(sales.fact_transactions(td.transactions(spark, sf)))


@register("j6_orphan_transactions")
def j6(spark, sf):
    return sales.orphan_transactions(sales.fact_transactions(td.transactions(spark, sf)),
                                     sales.dim_users(td.users(spark, sf)))


# ------------------------------------------------------- 2.4 projections

@register("j6_orphans_of_solvent_users")
def j6_solvent(spark, sf):
    """J6 with real orphans: the user dimension holds only customers whose
    balance is not negative, so the sales of all others have no parent."""
    solvent = td.read_table(spark, sf, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    return sales.orphan_transactions(td.transactions(spark, sf), solvent)


@register("v12_column_types")
def v12_types(spark, sf):
    """The columns of the raw pings, their types and non-null values."""
    return quality.column_types(_pings(spark, sf))


@register("p1_route_map")
def p1(spark, sf):
    p = _pings(spark, sf)
    return p.select(F.col(C.ROUTE).alias("ruta_raw"),
                    canonical_route(C.ROUTE, RouteMap(mode="map")).alias("ruta")).distinct()


@register("p2_route_case")
def p2(spark, sf):
    p = _pings(spark, sf)
    return p.select(F.col(C.ROUTE).alias("ruta_raw"), canonical_route(C.ROUTE).alias("ruta")).distinct()


@register("p7_date_parts")
def p7(spark, sf):
    return with_date_parts(_pings(spark, sf)).select("Fecha", "Hora", "DiaSemana").distinct()


@register("p9_band_table")
def p9(spark, sf):
    return (_pings(spark, sf).groupBy(band_table(C.SPEED).alias("nivel_congestion"))
            .agg(F.count(F.lit(1)).alias("registros")))


@register("p10_band_sql")
def p10(spark, sf):
    return (_pings(spark, sf).groupBy(band_sql(C.SPEED).alias("nivel_congestion"))
            .agg(F.count(F.lit(1)).alias("registros")))


@register("p11_impute_rounded")
def p11(spark, sf):
    return impute_temperature(_weather(spark, sf), ImputePolicy(digits=1))


@register("p12_impute_mean")
def p12(spark, sf):
    return impute_temperature(_weather(spark, sf))


@register("p16_composite_key")
def p16(spark, sf):
    return quality.key_counts(_pings(spark, sf), list(C.PING_COLUMNS))


# ------------------------------------------------------------- 2.5 joins

@register("j1_enriched")
def j1(spark, sf):
    return _enriched(spark, sf)


@register("j4_mean_temperature")
def j4(spark, sf):
    return mean_temperature(_weather(spark, sf)).select(F.round("_fill", 6).alias("temperatura_media"))


# ------------------------------------------------------- 2.6 aggregations

@register("a1_route_hour")
def a1(spark, sf):
    return warehouse.route_hour_report(_pings(spark, sf), _weather(spark, sf))


@register("a1_route_hour_local")
def a1_local(spark, sf):
    return local.route_hour_local(_pings(spark, sf), _weather(spark, sf))


@register("a2_post_clean_stats")
def a2(spark, sf):
    return agg.post_clean_stats(_enriched(spark, sf))


@register("a3_band_distribution")
def a3(spark, sf):
    return agg.band_distribution(_enriched(spark, sf))


@register("a4_live_view")
def a4(spark, sf):
    return agg.live_view(_positions(spark, sf))


@register("a5_live_summary")
def a5(spark, sf):
    return agg.live_summary(_positions(spark, sf))


@register("a6_totals")
def a6(spark, sf):
    return agg.totals(_positions(spark, sf))


@register("a7_band_summary")
def a7(spark, sf):
    return agg.band_summary(_positions(spark, sf))


@register("a8_ingest_counters")
def a8(spark, sf):
    return agg.ingest_counters(_outcomes(spark, sf))


@register("a9_heatmap")
def a9(spark, sf):
    return insights.heatmap(_enriched(spark, sf))


@register("a10_worst_cells")
def a10(spark, sf):
    return insights.worst_cells(_enriched(spark, sf))


@register("a11_hour_series")
def a11(spark, sf):
    return insights.hour_series(_enriched(spark, sf))


@register("a12_peak_hours")
def a12(spark, sf):
    return insights.peak_hours(_enriched(spark, sf))


@register("a13_condition_means")
def a13(spark, sf):
    return insights.condition_means(_enriched(spark, sf))


@register("a14_rain_impact")
def a14(spark, sf):
    return insights.rain_impact(_enriched(spark, sf))


@register("a15_box_by_condition")
def a15(spark, sf):
    return insights.box_by(_enriched(spark, sf), "Clima_Condicion")


@register("a16_band_shares")
def a16(spark, sf):
    return insights.band_shares(_enriched(spark, sf))


@register("a17_kpis")
def a17(spark, sf):
    return insights.kpis(_enriched(spark, sf))


@register("a18_route_table")
def a18_route(spark, sf):
    return insights.route_table(_fact(spark, sf))


@register("a18_band_by_route")
def a18_band_route(spark, sf):
    return insights.band_by_route(_fact(spark, sf))


@register("a18_band_counts")
def a18_bands(spark, sf):
    return insights.band_counts(_fact(spark, sf))


@register("a18_box_by_band")
def a18_box(spark, sf):
    return insights.box_by(_fact(spark, sf), "nivel_congestion")


@register("a19_pings_by_route_band")
def a19_a(spark, sf):
    return insights.view_totals(agg.live_view(_positions(spark, sf)), ["ruta", "nivel_congestion"], "total_pings")


@register("a19_speed_by_hour")
def a19_b(spark, sf):
    return insights.view_mean(agg.live_view(_positions(spark, sf)), ["hora"])


@register("a19_speed_by_hour_weighted")
def a19_b_weighted(spark, sf):
    return insights.view_mean(agg.live_view(_positions(spark, sf)), ["hora"], weight="total_pings")


@register("a19_buses_by_route")
def a19_c(spark, sf):
    return insights.view_totals(agg.live_view(_positions(spark, sf)), ["ruta"], "buses_unicos")


@register("a19_speed_by_condition")
def a19_d(spark, sf):
    return insights.view_mean(agg.live_view(_positions(spark, sf)), ["clima_condicion"])


@register("a19_pings_per_coordinate")
def a19_e(spark, sf):
    return _positions(spark, sf).groupBy("latitud", "longitud").agg(F.count(F.lit(1)).alias("pings"))


@register("a20_sales_by_region")
def a20(spark, sf):
    return sales.sales_by_region(_mart(spark, sf))


@register("a21_beneficiary_totals")
def a21(spark, sf):
    return sales.beneficiary_totals(sales.donations_view(td.read_table(spark, sf, "events"), td.regions(spark, sf)))


@register("a22_sales_by_date")
def a22_date(spark, sf):
    return sales.sales_report(_mart(spark, sf))["by_date"]


@register("a22_sales_by_item")
def a22_item(spark, sf):
    return sales.sales_report(_mart(spark, sf))["by_item"]


@register("a22_sales_by_rarity")
def a22_rarity(spark, sf):
    return sales.sales_report(_mart(spark, sf))["by_rarity"]


@register("a22_sales_by_method")
def a22_method(spark, sf):
    return sales.sales_report(_mart(spark, sf))["by_method"]


@register("a23_vote_shares")
def a23_share(spark, sf):
    return sales.share_of_total(_votes(spark, sf), "skin_name")


@register("a23_votes_by_charity")
def a23_charity(spark, sf):
    return _votes(spark, sf).groupBy("charity_voted").agg(F.count("vote_id").alias("votes"))


@register("a23_votes_by_device")
def a23_device(spark, sf):
    return _votes(spark, sf).groupBy("device_type").agg(F.count("vote_id").alias("votes"))


@register("a23_votes_by_premium")
def a23_premium(spark, sf):
    return _votes(spark, sf).groupBy("is_premium_player").agg(F.count("vote_id").alias("votes"))


@register("a23_votes_by_hour")
def a23_hour(spark, sf):
    v = _votes(spark, sf)
    return (v.groupBy(F.window(F.col("voted_at").cast("timestamp"), "1 hour").start.cast("timestamp_ntz")
                      .alias("hora"))
            .agg(F.count("vote_id").alias("votes")))


@register("a24_aggregate_summary")
def a24(spark, sf):
    return agg.aggregate_summary(warehouse.route_hour_report(_pings(spark, sf), _weather(spark, sf)))


@register("a25_voting_view")
def a25_votes(spark, sf):
    return _votes(spark, sf)


@register("a25_donations_view")
def a25_donations(spark, sf):
    return sales.donations_view(td.read_table(spark, sf, "events"), td.regions(spark, sf))


# ---------------------------------------------------------- 2.8 sort/limit

@register("t3_latest_log")
def t3(spark, sf):
    return audit.latest_log(audit.activity_log_from_outcomes(_outcomes(spark, sf)))


@register("t4_preview")
def t4(spark, sf):
    """The first 20 enriched rows in time order (a top-k)."""
    e = _enriched(spark, sf)
    return e.orderBy(C.TS, *[c for c in e.columns if c != C.TS]).limit(20)


@register("t5_recent_positions")
def t5(spark, sf):
    return live.recent_positions(_positions(spark, sf))


# ------------------------------------------------------------- 2.9 sets

@register("u2_union_sources")
def u2(spark, sf):
    hist = _enriched(spark, sf).select(
        F.col(C.BUS).alias("bus_id"), F.col("Ruta").alias("ruta"), F.col(C.SPEED).alias("velocidad_kmh"),
        F.col("Hora").alias("hora"), F.col("Nivel_Congestion").alias("nivel_congestion"),
        F.col(C.TS).alias("ts"), F.lit("historico").alias("fuente"))
    now = _positions(spark, sf).select("bus_id", "ruta", "velocidad_kmh", "hora", "nivel_congestion",
                                       F.col("ingest_timestamp").alias("ts"), F.lit("vivo").alias("fuente"))
    return hist.unionByName(now)


# ---------------------------------------------------- 2.10 star schemas

@register("d1_dim_route")
def d1(spark, sf):
    return starschema.dim_route(_pings(spark, sf))


@register("d2_dim_bus")
def d2(spark, sf):
    return starschema.dim_bus(_pings(spark, sf))


@register("d3_dim_date")
def d3(spark, sf):
    return starschema.dim_date(_pings(spark, sf))


@register("d4_dim_weather")
def d4(spark, sf):
    return starschema.dim_weather(_weather(spark, sf)).drop("clima_id")


@register("d5_fact_trips")
def d5(spark, sf):
    f = _fact(spark, sf)
    return f.select(*[c for c in f.columns if c not in ("viaje_id", "clima_id")],
                    F.col("clima_id").isNotNull().alias("con_clima"))


@register("d5_fact_ids")
def d5_ids(spark, sf):
    """D5 + P14: rows and distinct trip ids of the fact table."""
    return _fact(spark, sf).agg(F.count(F.lit(1)).alias("viajes"), F.countDistinct("viaje_id").alias("ids"))


@register("d6_transformed")
def d6(spark, sf):
    return starschema.transformed(_pings(spark, sf))


@register("d7_dim_users")
def d7_users(spark, sf):
    return sales.dim_users(td.users(spark, sf))


@register("d7_dim_regions")
def d7_regions(spark, sf):
    r = sales.dim_regions(td.regions(spark, sf))
    return r.withColumn("avg_player_spending", round_half_up(F.col("avg_player_spending"), 4))


@register("d7_dim_payment_methods")
def d7_methods(spark, sf):
    return sales.dim_payment_methods(td.payment_methods(spark, sf))


@register("d7_dim_items")
def d7_items(spark, sf):
    return sales.dim_items(td.items(spark, sf))


@register("d7_fact_transactions")
def d7_fact(spark, sf):
    return sales.fact_transactions(td.transactions(spark, sf))


@register("d8_wide_mart")
def d8(spark, sf):
    return _mart(spark, sf)


# ------------------------------------------------------- 2.11 streaming twins

@register("r1_outcomes")
def r1(spark, sf):
    return _outcomes(spark, sf)


@register("r2_dedup_batch_twin")
def r2_twin(spark, sf):
    return _positions(spark, sf)


# ------------------------------------------------------- 2.11 streaming runs

def _stream_events(spark, sf):
    """The ping events as a file stream over the events table (the same
    mapping as the batch fixture: every event plus a copy of every 100th)."""
    schema = td.read_table(spark, sf, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return live.events_from_pings(td._ping_projection(td.with_copies(e)))


@register("r2_stream_dedup")
def r2_stream(spark, sf):
    positions, _ = ingest.positions_stream(_stream_events(spark, sf), impute_temperature(_weather(spark, sf)))
    out = scratch_path(spark, f"r2_{uuid.uuid4().hex}")
    q = (positions.writeStream.format("parquet").option("path", out + "/data")
         .option("checkpointLocation", out + "/_ckpt").trigger(availableNow=True).start())
    ingest.run_available(q)
    # which ping of a minute is accepted depends on arrival; that one is, does not
    p = spark.read.parquet(out + "/data")
    return p.select("bus_id", F.date_trunc("minute", "ingest_timestamp").cast("timestamp_ntz").alias("minuto"))


@register("r4_stream_rejections")
def r4_stream(spark, sf):
    """The rejected-event side output of the stream (file sink)."""
    _, rejected = ingest.positions_stream(_stream_events(spark, sf))
    out = scratch_path(spark, f"r4_{uuid.uuid4().hex}")
    q = (rejected.writeStream.format("parquet").option("path", out + "/data")
         .option("checkpointLocation", out + "/_ckpt").trigger(availableNow=True).start())
    ingest.run_available(q)
    return spark.read.parquet(out + "/data").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("k7_lake_sink")
def k7(spark, sf):
    """K7: accepted positions written by the stream as NDJSON partitioned by
    ingest day, read back."""
    out = _streamed_positions(spark, sf, "k7")
    ingest.run_available(ingest.start_lake_sink(_position_stream(spark, out), out + "/lake", name=None,
                                                trigger={"availableNow": True}, checkpoint=out + "/_ckpt"))
    lake = spark.read.schema(ingest.POSITION_SCHEMA + ", day string").json(out + "/lake")
    return lake.drop("viaje_id").withColumn("ingest_timestamp", F.col("ingest_timestamp").cast("timestamp_ntz"))


def _streamed_positions(spark, sf, name):
    """The folder of an outcome stream over all events, with positions."""
    out = scratch_path(spark, f"{name}_{uuid.uuid4().hex}")
    ingest.run_available(ingest.start_outcomes(
        _stream_events(spark, sf), out, weather=lambda s: impute_temperature(_weather(s, sf))))
    return out


def _position_stream(spark, out, files=None):
    r = spark.readStream.schema(ingest.POSITION_SCHEMA)
    if files:
        r = r.option("maxFilesPerTrigger", files)
    return r.parquet(f"{out}/positions/batch_id=*")


@register("r2_stream_positions")
def r2_positions(spark, sf):
    """R2 + J5: the whole positions that the outcome stream accepts, with the
    band of the kept ping's speed and the weather of its day."""
    rows = spark.read.schema(ingest.POSITION_SCHEMA).parquet(_streamed_positions(spark, sf, "r2p") + "/positions")
    return rows.drop("viaje_id", "batch_id").withColumn(
        "ingest_timestamp", F.col("ingest_timestamp").cast("timestamp_ntz"))


# ------------------------------------------------------------ more operators

@register("p15_minute_bucket")
def p15(spark, sf):
    return (_pings(spark, sf).groupBy(F.col(C.BUS).alias("bus_id"), minute_bucket(C.TS).alias("minuto"))
            .agg(F.count(F.lit(1)).alias("pings")))


@register("l3_activity_log")
def l3(spark, sf):
    return audit.activity_log_from_outcomes(_outcomes(spark, sf))


@register("s10_raw_manifest")
def s10(spark, sf):
    return ingest_raw(spark, [f"{sf}/*.parquet"]).drop("modificado")


# ------------------------------------------------------------ manual path

@register("j1_enriched_manual")
def j1_manual(spark, sf):
    return manual.enriched(_pings(spark, sf), _weather(spark, sf))


@register("a1_route_hour_manual")
def a1_manual(spark, sf):
    return manual.route_hour(manual.enriched(_pings(spark, sf), _weather(spark, sf)))


@register("r1_stream_outcomes")
def r1_stream(spark, sf):
    """R1 as a stream with every event's outcome, duplicates included."""
    out = scratch_path(spark, f"r1_{uuid.uuid4().hex}")
    ingest.run_available(ingest.start_outcomes(_stream_events(spark, sf), out))
    return spark.read.parquet(f"{out}/outcomes").drop("batch_id").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("a4_live_view_stream")
def a4_stream(spark, sf):
    """A4 kept up to date, batch by batch, from the positions that the outcome
    stream accepts; exact."""
    out = _streamed_positions(spark, sf, "a4")
    ingest.run_available(views.start_live_view(_position_stream(spark, out, files=2), out + "/live"))
    return views.read_live_view(spark, out + "/live")


@register("a8_stream_counters")
def a8_stream(spark, sf):
    """The counters that the outcome stream keeps for its whole life."""
    out = scratch_path(spark, f"a8_{uuid.uuid4().hex}")
    ingest.run_available(ingest.start_outcomes(_stream_events(spark, sf), out))
    return ingest.stream_counters(spark, out)


@register("k4_live_view")
def k4_live(spark, sf):
    """K4: the stored positions, queried by the name of the live view."""
    return spark.table(_named_views(spark, sf)[0])


@register("k4_quality_views")
def k4_quality(spark, sf):
    """K4: the quality views by name, over raw pings stored as positions."""
    names = _named_views(spark, sf, raw=True)[1:]
    return reduce(DataFrame.unionByName, [
        spark.table(n).agg(F.lit(k + 1).cast("long").alias("vista"), F.count(F.lit(1)).alias("filas"))
        for k, n in enumerate(names)])


def _named_views(spark, sf, raw=False):
    name = f"posiciones_{uuid.uuid4().hex}"
    rows = (live.events_from_pings(_pings(spark, sf)).withColumnRenamed("ts", "ingest_timestamp")
            .withColumns({c: F.lit(None).cast("string") for c in ("hora", "nivel_congestion", "clima_condicion")})
            if raw else _positions(spark, sf))
    replace_table(rows, name, path=scratch_path(spark, name))
    return create_quality_views(spark, name, prefix=f"{name}_")


@register("v17_first_errors")
def v17_first(spark, sf):
    """The first 10 quarantined events (top-k by all columns)."""
    o = _outcomes(spark, sf)
    tagged = o.withColumn("error", F.when(F.col("outcome") == live.REJECTED_INVALID, F.col("reason")))
    return audit.first_errors(tagged, 10)


@register("a5_recent_summary")
def a5_recent(spark, sf):
    """A5, in-memory form: the summary over the 200 most recent accepted
    positions (the service's buffer)."""
    return agg.live_summary(live.recent_positions(_positions(spark, sf), 200))


@register("p19_iso_roundtrip")
def p19(spark, sf):
    """Event times printed as ISO-8601 UTC text with a ``Z`` suffix and
    parsed back; the parse must give the same instant for every event."""
    e = td.read_table(spark, sf, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    back = parse_iso_utc(text).cast("timestamp_ntz")
    return e.agg(F.count(F.lit(1)).alias("registros"),
                 F.count_if(back.isNull() | (back != F.col("ts"))).cast("long").alias("distintos"))


@register("p6_text_timestamp")
def p6(spark, sf):
    """Event times as 'yyyy-MM-dd HH:mm:ss' text (the CSV form) parsed
    strictly back; every parse must equal the time truncated to seconds."""
    e = td.read_table(spark, sf, "events")
    back = parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return e.agg(F.count(F.lit(1)).alias("registros"),
                 F.count_if(back.isNull() | (back != F.date_trunc("second", "ts").cast("timestamp_ntz")))
                 .cast("long").alias("distintos"))


# --------------------------------------------- variants and written outputs

@register("a13_present_conditions")
def a13_present(spark, sf):
    """A13, warehouse form: only conditions that occur."""
    return insights.condition_means(_enriched(spark, sf), only_present=True)


@register("a14_rain_impact_filled")
def a14_filled(spark, sf):
    """A14, warehouse form: a missing class takes the extreme of the others."""
    return insights.rain_impact(_enriched(spark, sf), fill_missing=True)


@register("r4_stream_log")
def r4_log(spark, sf):
    """R4 + L3: the activity-log rows that the outcome stream writes."""
    out = scratch_path(spark, f"r4log_{uuid.uuid4().hex}")
    ingest.run_available(ingest.start_outcomes(_stream_events(spark, sf), out))
    log = spark.read.parquet(f"{out}/activity_log").drop("batch_id", "event_id")
    return log.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@register("k6_append_rows")
def k6(spark, sf):
    """K6: the weather appended twice to one table, read back."""
    path = scratch_path(spark, f"k6_{uuid.uuid4().hex}")
    for _ in range(2):
        append_rows(_weather(spark, sf), path=path)
    return spark.read.parquet(path).groupBy("fecha", "condicion").agg(F.count(F.lit(1)).alias("filas"))


@register("v12_route_values")
def v12_routes(spark, sf):
    return quality.value_list(_pings(spark, sf), C.ROUTE)


@register("v13_condition_values")
def v13_conditions(spark, sf):
    return quality.value_list(_weather(spark, sf), "condicion")


@register("v14_expected_weather")
def v14_weather(spark, sf):
    """The weather file is expected to have a row for each of 31 days."""
    return quality.expect_rows(_weather(spark, sf), 31, "clima")


@register("v18_raw_duplicates")
def v18_raw(spark, sf):
    """V18 on events that no dedup has seen: buses and minutes with more than
    one ping of a route."""
    events = live.events_from_pings(_pings(spark, sf)).withColumnRenamed("ts", "ingest_timestamp")
    return quality.dq_duplicates(events)


@register("v19_raw_anomalous_speed")
def v19_raw(spark, sf):
    return quality.dq_anomalous_speed(live.events_from_pings(_pings(spark, sf)))


@register("v20_raw_outside_box")
def v20_raw(spark, sf):
    return quality.dq_outside_box(live.events_from_pings(_pings(spark, sf)))


@register("v15_normalisation_log")
def v15_log(spark, sf):
    """V15 + L3: events without an id (route 104) or with a speed that is no
    number (route 502) reach the log with the stage that refused them."""
    events = live.events_from_pings(_pings(spark, sf))
    broken = (events.withColumn("bus_id", F.when(F.col("ruta") == "104", "  ").otherwise(F.col("bus_id")))
              .withColumn("velocidad_kmh", F.when(F.col("ruta") == "502", "n/a")
                          .otherwise(F.col("velocidad_kmh").cast("string"))))
    _, outcomes = live.process_batch(broken)
    log = audit.activity_log_from_outcomes(outcomes).where(F.col("event_type") == C.EVENT_REJECTED)
    stage = F.substring_index("description", ":", 1)
    return log.groupBy(stage.alias("etapa"), (stage == C.STAGE_NORMALISE).alias("normalizacion")).agg(
        F.count(F.lit(1)).alias("filas"))


# ------------------------------------------- files and tables, there and back

def _unique(name):
    return f"{name}_{uuid.uuid4().hex}"


def _ping_csv(spark, sf):
    """K1: all pings as CSV, times to the second as in the original files."""
    path = scratch_path(spark, _unique("pings_csv"))
    write_csv(_pings(spark, sf).withColumn(C.TS, F.date_format(C.TS, "yyyy-MM-dd HH:mm:ss")), path)
    return path


def _weather_json(spark, sf):
    """The weather as one JSON array (a row per calendar day bounds it)."""
    path = scratch_path(spark, _unique("clima_json"))
    day = F.struct("fecha", "condicion", "temperatura_promedio")
    _weather(spark, sf).agg(F.to_json(F.collect_list(day)).alias("value")).write.text(path)
    return path


@register("s1_csv_scan")
def s1(spark, sf):
    """S1 / S3 + K1: pings written as CSV and read with inferred types."""
    return scan_csv(spark, _ping_csv(spark, sf)).withColumn(C.TS, F.col(C.TS).cast("timestamp_ntz"))


@register("s2_load_pings")
def s2(spark, sf):
    """The same files with the fixed schema; a malformed row would fail."""
    return load_pings(spark, _ping_csv(spark, sf)).withColumn(C.TS, F.col(C.TS).cast("timestamp_ntz"))


@register("s4_weather_array")
def s4(spark, sf):
    """The weather read from a JSON array."""
    return load_weather_json(spark, _weather_json(spark, sf))


@register("s6_weather_ndjson")
def s6(spark, sf):
    """S6 + S5: the JSON array turned into NDJSON, read with inferred types."""
    out = scratch_path(spark, _unique("clima_ndjson"))
    json_array_to_ndjson(spark, _weather_json(spark, sf), out)
    return scan_ndjson(spark, out).withColumn("fecha", F.to_date("fecha"))


@register("s8_first_available")
def s8(spark, sf):
    """Neither the table nor the first folder exists, the third does."""
    found = first_available(spark, [("table", _unique("sin_tabla")), ("csv", f"{sf}/sin_archivo.csv"),
                                    ("parquet", f"{sf}/events.parquet")])
    return found.select("event_id", "event_type", "value")


@register("k2_json_records")
def k2(spark, sf):
    """K2: the route-hour table as JSON records, read back with its types."""
    detail = _enriched(spark, sf)
    report, path = agg.route_hour(detail), scratch_path(spark, _unique("ruta_hora_json"))
    if not write_json_records(report, detail, path):
        return report.limit(0)
    return spark.read.schema(report.schema).json(path)


@register("k3_replaced_table")
def k3(spark, sf):
    """K3 + S7: the fact table stored twice under one name, bucketed by bus,
    and scanned: the second replaces the first."""
    name = _unique("hechos")
    for _ in range(2):
        replace_table(_fact(spark, sf), name, path=scratch_path(spark, name), bucket_by=(8, ["bus_id"]))
    f = scan_table(spark, name)
    return f.select(*[c for c in f.columns if c not in ("viaje_id", "clima_id")],
                    F.col("clima_id").isNotNull().alias("con_clima"))


@register("k5_guarded_table")
def k5(spark, sf):
    """K5: created if absent, filled through the NOT NULL guard; a second
    creation leaves the rows alone."""
    name, rows = _unique("posiciones"), _positions(spark, sf).select("bus_id", "ruta", "velocidad_kmh", "ingest_timestamp")
    schema, place = "bus_id string, ruta string, velocidad_kmh double, ingest_timestamp timestamp_ntz", scratch_path(spark, name)
    create_table_if_absent(spark, name, schema, place)
    append_rows(check_not_null(rows.withColumn("ingest_timestamp", F.col("ingest_timestamp").cast("timestamp_ntz")),
                               ["bus_id", "ruta", "ingest_timestamp"]), name)
    create_table_if_absent(spark, name, schema, place)
    return scan_table(spark, name)


@register("k8_table_sink")
def k8(spark, sf):
    """K8: accepted positions appended to the guarded table by a stream."""
    out = _streamed_positions(spark, sf, "k8")
    ingest.run_available(ingest.start_table_sink(_position_stream(spark, out), out + "/tabla", name=_unique("k8")))
    return _plain_positions(spark.read.schema(ingest.POSITION_SCHEMA).parquet(out + "/tabla"))


@register("k9_fanout_table")
def k9(spark, sf):
    """K9: the table of the fan-out, whole batches only."""
    return _plain_positions(ingest.read_positions(spark, _fanout(spark, sf)))


@register("k9_fanout_rejected")
def k9_rejected(spark, sf):
    """K9 + R4: the rejected events that the fan-out logs."""
    log = spark.read.parquet(_fanout(spark, sf) + "/rejected")
    return log.drop("event_id").withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def _fanout(spark, sf):
    out = _streamed_positions(spark, sf, "k9")
    _, rejected = ingest.positions_stream(_stream_events(spark, sf))
    ingest.run_available(ingest.start_fanout(_position_stream(spark, out), rejected, out + "/salidas"))
    return out + "/salidas"


def _plain_positions(rows):
    return rows.drop("viaje_id").withColumn("ingest_timestamp", F.col("ingest_timestamp").cast("timestamp_ntz"))


@register("p18_default_weather")
def p18(spark, sf):
    """P18 + J5: positions of days without weather take fixed values."""
    accepted = _outcomes(spark, sf).where(F.col("outcome") == live.ACCEPTED)
    rows = live.enrich_positions(accepted, impute_temperature(_weather(spark, sf)), default_weather=("Despejado", 18.0))
    return rows.drop("viaje_id")


@register("r8_stream_and_batch")
def r8(spark, sf):
    """The lake stream and the batch report run in one session."""
    out = _streamed_positions(spark, sf, "r8")

    def report():
        agg.route_hour(_enriched(spark, sf)).write.parquet(out + "/informe")

    ingest.run_concurrently(spark, lambda: ingest.start_lake_sink(
        _position_stream(spark, out), out + "/lake", name=None, trigger={"availableNow": True},
        checkpoint=out + "/_ckpt"), report)
    done = {"lago": spark.read.schema(ingest.POSITION_SCHEMA).json(out + "/lake"),
            "informe": spark.read.parquet(out + "/informe")}
    return reduce(DataFrame.unionByName, [df.agg(F.lit(k).alias("salida"), F.count(F.lit(1)).alias("filas"))
                                          for k, df in done.items()])


@register("l1_stage_log")
def l1(spark, sf):
    """L1 + L2: what the warehouse batch run writes to its stage log and to
    the run registry."""
    base = scratch_path(spark, _unique("l1"))
    jobs.run_warehouse_batch(spark, _pings(spark, sf), _weather(spark, sf), base)
    log = spark.read.parquet(base + "/proceso_log").select(
        F.col("evento").alias("etapa"), "estado", F.lit(None).cast("long").alias("registros"))
    runs = audit.latest_runs(spark.read.parquet(base + "/ejecuciones")).select(
        F.col("proceso").alias("etapa"), F.col("resultado").alias("estado"), "registros")
    return log.unionByName(runs)


@register("f2_user_function")
def f2(spark, sf):
    """F2 + V17: a function of the user over all pings; rows it cannot take
    keep their error."""
    def metres_per_second(pdf):
        if (pdf[C.SPEED] < 0).any():
            raise ValueError("velocidad negativa")
        return pdf[[C.BUS, C.TS]].assign(ms=pdf[C.SPEED] * 10)

    done = audit.user_function(_pings(spark, sf).select(C.BUS, C.TS, C.SPEED), metres_per_second,
                               f"{C.BUS} string, {C.TS} timestamp_ntz, ms double")
    return done.groupBy(C.BUS, "error").agg(F.count(F.lit(1)).alias("filas"), F.max("ms").alias("ms_max"))
