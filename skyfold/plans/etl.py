"""The nightly star load as one Spark application.

run log RUNNING -> dimensions (upsert / insert-if-absent) -> ticket fact
(incremental from the watermark, minus the lookback) -> watermark advance
(only when rows were read) -> occupancy and lifecycle facts -> run log
SUCCESS with per-table counts. Every table is a versioned folder under
``out_dir`` (default: ``<spark.checkpoint.dir>/star``), so a failed or
repeated run never corrupts what readers see; running twice gives the same
tables as running once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.operators.dims import dim_channel, extend_channels
from skyfold.operators.facts import change_time
from skyfold.plans.star import Star
from skyfold.session import configure, work_dir
from skyfold.sources import sinks
from skyfold.sources.fixtures import DEFAULT_AS_OF, FlightModel

# Mutable column sets of each upsert target (everything else is frozen at
# first insert), as in the reference's ON CONFLICT clauses.
MUTABLE = {
    "dim_route": (["route_key"], ["distance_km", "distance_band"]),
    "dim_fare": (["fare_key"], ["rule_name", "min_advance_days"]),
    "dim_flight": (["flight_key"], ["flight_status", "aircraft_registration"]),
    "fact_ticket_sale": (["ticket_key"], ["ticket_status", "is_cancelled", "ancillary_amount", "total_amount",
                                          "loaded_at"]),
    "fact_flight_occupancy": (["flight_key", "cabin_code"], ["capacity", "seats_sold", "seats_held", "load_factor",
                                                             "revenue_amount", "revenue_per_seat", "loaded_at"]),
    "fact_reservation_lifecycle": (["reservation_key"], ["final_status", "minutes_to_confirm", "minutes_to_cancel",
                                                         "days_before_departure_at_cancel", "was_confirmed",
                                                         "was_cancelled", "expired_without_payment", "event_count",
                                                         "loaded_at"]),
}
INSERT_ONLY = {"dim_date": ["date_key"]}
# Facts are stored partitioned by month of their date key, so date-bounded
# reads (marts by month, occupancy windows) prune whole folders.
FACT_PARTITION = {"fact_ticket_sale": ("issue_month", "issue_date_key"),
                  "fact_flight_occupancy": ("departure_month", "departure_date_key"),
                  "fact_reservation_lifecycle": ("created_month", "created_date_key")}


def _with_month(df: DataFrame, name: str) -> DataFrame:
    col, key = FACT_PARTITION[name]
    return df.withColumn(col, F.floor(F.col(key) / 100).cast("int"))


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ", timespec="seconds")


def run_etl(spark: SparkSession, source_dir: str, out_dir: str | None = None, as_of: str = DEFAULT_AS_OF,
            full_refresh: bool = False, lookback_minutes: int = 60) -> dict[str, int]:
    configure(spark)
    out = out_dir or work_dir(spark, "star")
    started = _now()
    log_path = f"{out}/etl_run_log"
    prev_log = sinks.read_current(spark, log_path)
    run_id = 1 if prev_log is None else int(prev_log.agg(F.max("run_id")).first()[0]) + 1
    running = sinks.run_log_entry(spark, run_id, started, None, "RUNNING", {})
    sinks.write_version(running if prev_log is None else prev_log.unionByName(running), log_path)

    try:
        counts = _load(spark, source_dir, out, run_id, started, as_of, full_refresh, lookback_minutes)
    except Exception:
        _finish(spark, log_path, run_id, started, "FAILED", {})
        raise
    _finish(spark, log_path, run_id, started, "SUCCESS", counts)
    return counts


def _finish(spark: SparkSession, log_path: str, run_id: int, started: str, status: str, counts: dict[str, int]) -> None:
    """Replaces the run's RUNNING entry."""
    done = sinks.run_log_entry(spark, run_id, started, _now(), status, counts)
    sinks.write_version(sinks.read_current(spark, log_path).where(F.col("run_id") != run_id).unionByName(done), log_path)


def _load(spark: SparkSession, source_dir: str, out: str, run_id: int, started: str, as_of: str, full_refresh: bool,
          lookback_minutes: int) -> dict[str, int]:
    model = FlightModel(spark, source_dir).snapshot(f"{out}/_snapshot/run={run_id}", FlightModel.STAR_SNAPSHOT)
    wm_path = f"{out}/etl_watermark"
    wm_df = sinks.read_current(spark, wm_path)
    old_wm = None
    if wm_df is not None and not full_refresh:
        row = wm_df.where(F.col("table_name") == "fact_ticket_sale").select(
            F.date_format("last_loaded_at", "yyyy-MM-dd HH:mm:ss")).first()
        old_wm = row[0] if row else None
    bound = sinks.extract_bound(old_wm, lookback_minutes, full_refresh)
    counts: dict[str, int] = {}
    # channels first: facts take their keys from the stored dimension
    channel_path = f"{out}/dim_channel"
    channels = extend_channels(sinks.read_current(spark, channel_path), dim_channel(model.reservation, model.agency))
    _, counts["dim_channel"] = sinks.write_version_counted(channels, channel_path)
    star = Star(model, as_of=as_of, watermark=bound, change_mode="latest", channels=sinks.read_current(spark, channel_path))
    loaded_at = F.lit(started).cast("timestamp")

    for name, keys in INSERT_ONLY.items():
        path = f"{out}/{name}"
        merged = sinks.insert_if_absent(sinks.read_current(spark, path), getattr(star, name), keys)
        _, counts[name] = sinks.write_version_counted(merged, path)
    for name in ("dim_route", "dim_fare", "dim_flight"):
        keys, mutable = MUTABLE[name]
        _, counts[name] = sinks.upsert_table(getattr(star, name), f"{out}/{name}", keys, mutable)

    extract = star.fact_ticket_sale.withColumn("loaded_at", loaded_at)
    extract_path = f"{out}/_extract_fact_ticket_sale"
    ev, read_rows = sinks.write_version_counted(extract, extract_path)   # cut lineage once, reuse twice
    extract = spark.read.parquet(f"{extract_path}/v={ev}")
    keys, mutable = MUTABLE["fact_ticket_sale"]
    _, counts["fact_ticket_sale"] = sinks.upsert_partitions(
        _with_month(extract.drop("issued_at"), "fact_ticket_sale"), f"{out}/fact_ticket_sale", keys, mutable,
        FACT_PARTITION["fact_ticket_sale"][0], materialized=True)     # the extract is a written copy
    if read_rows:
        changed = model.ticket.select(change_time(model.ticket, "latest").alias("changed_at")).where(F.col("changed_at") > F.lit(bound).cast("timestamp"))
        new_wm = sinks.watermark_advance(changed, "changed_at", "fact_ticket_sale", old_wm)
        old_rows = wm_df.where(F.col("table_name") != "fact_ticket_sale") if wm_df is not None else None
        sinks.write_version(new_wm if old_rows is None else old_rows.unionByName(new_wm), wm_path)

    for name in ("fact_flight_occupancy", "fact_reservation_lifecycle"):
        keys, mutable = MUTABLE[name]
        fact = _with_month(getattr(star, name).withColumn("loaded_at", loaded_at), name)
        _, counts[name] = sinks.upsert_partitions(fact, f"{out}/{name}", keys, mutable, FACT_PARTITION[name][0])

    return counts


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    out = {}
    for n in [*INSERT_ONLY, "dim_channel", *MUTABLE]:
        if n in FACT_PARTITION:
            out[n] = sinks.read_current_partitioned(spark, f"{out_dir}/{n}", FACT_PARTITION[n][0])
        else:
            out[n] = sinks.read_current(spark, f"{out_dir}/{n}")
    return out
