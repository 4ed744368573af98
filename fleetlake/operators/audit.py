"""Process logging, run registry, activity log and error quarantine, all as
tables (append-only writes), never as driver-side state."""

from __future__ import annotations

import contextlib
import datetime as _dt
import json
import traceback

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import round_half_up
from ..functions.text import rejection_text
from ..sinks import versioned

PROCESS_LOG_SCHEMA = ("proceso string, tipo string, evento string, estado string, registros_leidos long, "
                      "registros_cargados long, nulos long, mensaje string, timestamp timestamp")
ACTIVITY_LOG_SCHEMA = "event_id string, event_type string, description string, status string, created_at timestamp"
RUN_SCHEMA = "proceso string, resultado string, detalles string, registros long, timestamp timestamp"


def _append(spark: SparkSession, rows: list[tuple], schema: str, path: str | None, table: str | None) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    if table:
        df.write.mode("append").saveAsTable(table)
    elif path:
        df.write.mode("append").parquet(path)
    return df


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


@contextlib.contextmanager
def stage(spark: SparkSession, name: str, path: str | None = None, table: str | None = None,
          continue_on_error: bool = False, process: str = "batch"):
    """L1: log INICIO / FIN / ERROR rows for a block of work.

    On error the row carries the exception type and message; the error is
    re-raised unless ``continue_on_error`` (then the block's result is just
    missing, as the original decorator returns None).
    """
    def row(estado: str, mensaje: str):
        return [(process, "STAGE", name, estado, None, None, None, mensaje, _now())]

    _append(spark, row("INICIO", ""), PROCESS_LOG_SCHEMA, path, table)
    try:
        yield
    except Exception as e:  # noqa: BLE001
        _append(spark, row("ERROR", f"{type(e).__name__}: {e}\n{traceback.format_exc()}"),
                PROCESS_LOG_SCHEMA, path, table)
        if not continue_on_error:
            raise
    else:
        _append(spark, row("FIN", ""), PROCESS_LOG_SCHEMA, path, table)


def record_run(spark: SparkSession, process: str, result: str, details: str = "", records: int = 0,
               path: str | None = None, table: str | None = None) -> DataFrame:
    """L2: append one run row; the registry is the latest row per process."""
    return _append(spark, [(process, result, details, records, _now())], RUN_SCHEMA, path, table)


def latest_runs(runs: DataFrame) -> DataFrame:
    """L2: latest run per process: the greatest number of a registry with
    numbers, else the latest time."""
    last = F.max_by(F.struct("resultado", "detalles", "registros", "timestamp"),
                    F.col("orden" if "orden" in runs.columns else "timestamp"))
    return runs.groupBy("proceso").agg(last.alias("r")).select("proceso", "r.*")


def register_run(spark: SparkSession, process: str, result: str, details: str = "", records: int = 0, *,
                 path: str) -> int:
    """L2 with more than one writer: the run takes the next free number of its
    process and is stored under it, if no other run has. The number is its
    place in the process's history, whatever the writers' clocks say."""
    folder = f"{path}/{process}"
    while True:
        used = versioned.names(spark, folder)
        number = int(used[-1].split(".")[0]) + 1 if used else 1
        row = {"proceso": process, "resultado": result, "detalles": details, "registros": records,
               "timestamp": _now().isoformat(sep=" "), "orden": number}
        if versioned.create_if_absent(spark, f"{folder}/{number:012d}.json", json.dumps(row)):
            return number


def registered_runs(spark: SparkSession, path: str) -> DataFrame:
    """L2: the rows of :func:`register_run`, in order within a process."""
    return (spark.read.schema(RUN_SCHEMA + ", orden long").option("recursiveFileLookup", True).json(path)
            .orderBy("proceso", "orden"))


def can_run(runs: DataFrame, process: str) -> tuple[bool, object]:
    """L2: an earlier run never blocks; returns (True, last run time or None).
    Reads one aggregated row for one process."""
    row = latest_runs(runs.where(F.col("proceso") == process)).select("timestamp").first()
    return True, (row[0] if row else None)


def log_event(spark: SparkSession, event_type: str, description: str, status: str = "OK",
              path: str | None = None, table: str | None = None) -> DataFrame:
    """Append one activity-log row."""
    import uuid
    return _append(spark, [(str(uuid.uuid4()), event_type, description, status, _now())],
                   ACTIVITY_LOG_SCHEMA, path, table)


def activity_log_from_outcomes(outcomes: DataFrame, ts: str = "ts") -> DataFrame:
    """The activity-log rows the live path writes per event:
    rejected -> (posicion_rechazada, <stage>: <reason>, ERROR), duplicate
    -> (posicion_duplicada, <bus> en <minute>, WARN). Accepted events are not
    logged. ``event_id`` is left to the writer."""
    o = F.col("outcome")
    rej = o == "rechazado_validacion"
    dup = o == "rechazado_duplicado"
    minute = F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm")
    return outcomes.where(rej | dup).select(
        F.when(rej, F.lit(C.EVENT_REJECTED)).otherwise(F.lit(C.EVENT_DUPLICATE)).alias("event_type"),
        F.when(rej, rejection_text(F.col("reason")))
        .otherwise(F.concat(F.col("bus_id"), F.lit(" en "), minute)).alias("description"),
        F.when(rej, F.lit("ERROR")).otherwise(F.lit("WARN")).alias("status"),
        F.col(ts).alias("created_at"))


def latest_log(log: DataFrame, n: int = 20, ts: str = "created_at",
               tie: tuple[str, ...] = ("event_type", "description")) -> DataFrame:
    """The ``n`` most recent log rows (a top-k, ``n`` rows per task)."""
    return log.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tie]).limit(n)


def quarantine(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows by an error expression (NULL = ok); the
    quarantine keeps the error text in column ``error``."""
    tagged = df.withColumn("error", error)
    return tagged.where(F.col("error").isNull()).drop("error"), tagged.where(F.col("error").isNotNull())


def quarantine_summary(tagged: DataFrame, error: str = "error") -> DataFrame:
    """Processed, ok, failed, error rate text ('N/A' when empty)."""
    total = F.count(F.lit(1))
    failed = F.count_if(F.col(error).isNotNull())
    row = tagged.agg(total.alias("total_procesados"), failed.cast("long").alias("total_fallidos"))
    rate = F.when(F.col("total_procesados") > 0,
                  F.format_string("%.1f%%", round_half_up(F.col("total_fallidos") * 100.0
                                                          / F.col("total_procesados"), 1))) \
        .otherwise(F.lit("N/A"))
    return row.select("total_procesados", (F.col("total_procesados") - F.col("total_fallidos"))
                      .alias("total_exitosos"), "total_fallidos", rate.alias("tasa_error"))


def first_errors(tagged: DataFrame, n: int = 10, error: str = "error",
                 order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` errors (top-k by ``order_by``)."""
    bad = tagged.where(F.col(error).isNotNull())
    return bad.orderBy(*(order_by or bad.columns)).limit(n)


#: Tasks of a user function for every core of the cluster.
TASKS_A_CORE = 3


class _Groups:
    """How many rows to try at once: all of a batch until a row fails, then
    some 0.7 of the mean distance of the last failing rows."""

    def __init__(self):
        self.gap, self.since = None, 0

    def size(self, rows: int) -> int:
        return rows if self.gap is None else max(1, min(rows, int(0.7 * self.gap)))

    def passed(self, rows: int) -> None:
        self.since += rows

    def failed(self) -> None:
        gap, self.since = self.since + 1, 0
        self.gap = gap if self.gap is None else 0.9 * self.gap + 0.1 * gap


def _apply(fn, pdf, out_cols: list[str], groups: _Groups) -> tuple[list, list[str]]:
    """``fn`` over all rows of ``pdf``: its frames, and the errors of the rows
    that it cannot take. The rows ``at`` to ``dirty`` are known to hold one:
    the first half is tried, and where it passes the other half need not be
    tried as a whole. Groups that pass double."""
    good, errors = [], []
    at, dirty, size = 0, 0, groups.size(len(pdf))
    while at < len(pdf):
        end = at + max(1, (dirty - at) // 2) if dirty > at else min(len(pdf), at + size)
        try:
            res = fn(pdf.iloc[at:end])
            good.append(res if list(res.columns) == out_cols else res[out_cols])
        except Exception as e:  # noqa: BLE001
            if end - at > 1:
                dirty = end
                continue
            errors.append(f"{type(e).__name__}: {e}")
            groups.failed()
            dirty, size = 0, groups.size(len(pdf))
        else:
            groups.passed(end - at)
            size = size if dirty > at else 2 * size
        at = end
    return good, errors


def user_function(df: DataFrame, fn, schema: str, tasks: int | None = None) -> DataFrame:
    """apply a user function to every pandas batch of rows; a batch that
    raises is tried in parts until only failing rows are left, which get their
    error text (column ``error``) instead of output. Every row of the output
    comes from a call that passed, every error from a call with its row alone.
    A batch with f failing rows of n takes some f log2(n / f) + 2 f calls (0.36
    a row where one in 17 fails), one without them a single call.

    The calls are the work, whatever the size of the rows: the rows are dealt
    over ``tasks`` tasks (``TASKS_A_CORE`` for every core), as a file with few
    row groups would leave them to as few tasks.
    """
    import pandas as pd

    out_cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    tasks = tasks or TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism

    def run(batches):
        groups = _Groups()
        for pdf in batches:
            if not len(pdf):
                continue
            good, errors = _apply(fn, pdf, out_cols, groups)
            if good:
                # parts of other types (integers, and floats for nulls) keep their values as objects
                alike = all(g.dtypes.equals(good[0].dtypes) for g in good)
                whole = pd.concat(good if alike else [g.astype(object) for g in good], ignore_index=True)
                yield whole.assign(error=None)
            if errors:
                yield pd.DataFrame({**dict.fromkeys(out_cols), "error": errors})

    return df.repartition(tasks).mapInPandas(run, schema + ", error string")
