"""Run log: rows, latest batch, latest status, platform figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.functions.numbers import count_where, duration_text, ratio
from shelfline.operators.dedup import newest_per_key, rows_of_newest_run
from shelfline.schemas import RUN_LOG

MESSAGE_LENGTH = 500


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Step:
    """What a run is doing: the key columns of its log row."""

    run_id: str
    layer: str
    step: str
    target_table: str
    started_at: dt.datetime = field(default_factory=utc_now)

    def outcome(self, spark: SparkSession, rows: int = 0, problem: BaseException | None = None, ended_at: dt.datetime | None = None) -> DataFrame:
        """The log row of this step once it has ended; a failure keeps the first part of its message."""
        ended_at = ended_at or utc_now()
        row = {
            **asdict(self),
            "rows_written": int(rows),
            "ended_at": ended_at,
            "duration_s": (ended_at - self.started_at) / dt.timedelta(seconds=1),
            "status": "SUCCESS",
            "message": None,
        }
        if problem is not None:
            row |= {"status": "FAILED", "message": str(problem)[:MESSAGE_LENGTH]}
        schema = StructType.fromDDL(RUN_LOG)
        return spark.createDataFrame([tuple(row[name] for name in schema.fieldNames())], schema)


def stamped(results: DataFrame, run_id: str, at: dt.datetime | None = None) -> DataFrame:
    """Check or reconciliation rows of one run, ready to be appended to the log of results."""
    return results.select(F.lit(run_id).alias("run_id"), "*", F.lit(at or utc_now()).alias("checked_at"))


def latest_status(log: DataFrame, step: str | None = None) -> DataFrame:
    """Newest entry per target table."""
    entries = log if step is None else log.filter(F.col("step") == step)
    return newest_per_key(entries, ["target_table"], [c for c in ("ended_at", "entry_id") if c in entries.columns])


def latest_batch_start(log: DataFrame, minutes: int = 15) -> DataFrame:
    """Earliest bronze start within ``minutes`` before the newest bronze start: one row."""
    bronze = log.filter("layer = 'bronze'").select("started_at")
    newest = bronze.agg(F.max("started_at").alias("_newest"))
    window = F.col("started_at") >= F.col("_newest") - F.make_dt_interval(mins=F.lit(minutes))
    return bronze.join(F.broadcast(newest), window).agg(F.min("started_at").alias("batch_start"))


def flag_latest(df: DataFrame, log: DataFrame, at: str = "started_at", minutes: int = 15) -> DataFrame:
    """Marks the rows at or after the start of the latest batch."""
    flagged = df.join(F.broadcast(latest_batch_start(log, minutes)))
    return flagged.withColumn("is_latest_run", F.col(at) >= F.col("batch_start")).drop("batch_start")


def platform_kpis(log: DataFrame, checks: DataFrame, counts: DataFrame, step: str, minutes: int = 15) -> DataFrame:
    """One row of platform figures: runs, table rows by layer, checks and duration of the latest run."""
    runs = log.agg(
        F.countDistinct(F.when(F.col("step") == step, F.col("run_id"))).alias("pipeline_runs"),
        F.max("ended_at").alias("data_as_of"),
    )
    flagged = flag_latest(log, log, "started_at", minutes)
    span = flagged.filter("is_latest_run").agg(F.min("started_at").alias("last_run_start"), F.max("ended_at").alias("_end"))
    seconds = F.unix_seconds(F.col("_end").cast("timestamp")) - F.unix_seconds(F.col("last_run_start").cast("timestamp"))
    span = span.select("last_run_start", duration_text(seconds).alias("last_run_duration"))
    by_layer = lambda layer: F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("row_count"))), F.lit(0))
    sizes = counts.agg(
        (by_layer("bronze") / 1e6).alias("rows_processed_m"),
        (by_layer("silver") / 1e6).alias("silver_rows_m"),
        F.count(F.lit(1)).alias("tables"),
        count_where(F.col("layer") == "gold").alias("gold_tables"),
        F.sum("row_count").alias("table_rows"),
    )
    current = flag_latest(checks, log, "checked_at", minutes).filter("is_latest_run")
    passed = count_where(F.col("status") == "PASS")
    verdicts = current.agg(
        F.count(F.lit(1)).alias("checks_total"),
        (F.count(F.lit(1)) - passed).alias("checks_failed"),
        F.concat(passed.cast("string"), F.lit(" / "), F.count(F.lit(1)).cast("string")).alias("checks_passed"),
        ratio(passed, F.count(F.lit(1))).alias("pass_rate"),
        F.coalesce(F.sum(F.abs("difference")), F.lit(0.0)).alias("difference_total"),
    )
    # four one-row frames side by side
    return runs.join(F.broadcast(span)).join(F.broadcast(sizes)).join(F.broadcast(verdicts))


def result_kpis(logs: Mapping[str, DataFrame]) -> DataFrame:
    """Checks, passed, pass rate and summed difference of the newest run of each log of results.  Each log has its own
    newest run: a later run of another kind does not hide it."""
    passed = count_where(F.col("status") == "PASS")
    total = F.count(F.lit(1))
    found = None
    for kind, log in logs.items():
        one = rows_of_newest_run(log, "checked_at").agg(
            F.lit(kind).alias("kind"),
            F.max("run_id").alias("run_id"),
            total.alias("checks"),
            passed.alias("passed"),
            ratio(passed, total).alias("pass_rate"),
            F.coalesce(F.sum(F.abs("difference")).cast("double"), F.lit(0.0)).alias("difference_total"),
        )
        found = one if found is None else found.unionByName(one)
    return found
