"""Source against target: counts, content checksums, business totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.hashing import checksum
from shelfline.functions.numbers import ratio
from shelfline.operators.dedup import rows_of_newest_run

EXACT = "decimal(38,2)"
TECHNICAL = ("_ingested_at", "_source", "_source_file", "_file_modified")


def drop_technical(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)


def verdict(compared: DataFrame, tolerance: Column | float = 0.0) -> DataFrame:
    """Difference target - source and PASS while it stays within the tolerance."""
    limit = tolerance if isinstance(tolerance, Column) else F.lit(tolerance)
    difference = F.col("target_value") - F.col("source_value")
    return compared.withColumn("difference", difference).withColumn(
        "status", F.when(F.abs("difference") <= limit, "PASS").otherwise("FAIL")
    )


def _one_pass(df: DataFrame, measures: Mapping[str, Column], side: str) -> DataFrame:
    return df.agg(*[m.alias(f"{side}_{n}") for n, m in measures.items()])


def reconcile_tables(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]],
    hashed: Callable[[Sequence[str]], Column] = checksum,
) -> DataFrame:
    """Row count and content checksum of every (source, target) pair; each side is read once."""
    result = None
    for name, (source, target) in pairs.items():
        columns = sorted(source.columns)
        measures = {"count": F.count(F.lit(1)).cast("decimal(38,0)"), "hash": hashed(columns)}
        both = _one_pass(source, measures, "s").crossJoin(_one_pass(drop_technical(target).select(*columns), measures, "t"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(level).alias("check_level"),
                    F.lit(name).alias("object_name"),
                    F.lit(check).alias("check_name"),
                    F.col(f"s_{m}").alias("source_value"),
                    F.col(f"t_{m}").alias("target_value"),
                )
                for level, check, m in (("1_counts", "row_count", "count"), ("2_hash", "content_checksum", "hash"))
            ]
        )
        one = verdict(both.select(F.inline(rows)))
        result = one if result is None else result.unionByName(one)
    return result


def reconcile_totals(
    source: DataFrame, target: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[Column, float]]
) -> DataFrame:
    """Totals per key on both sides; a key missing on one side counts as 0 there.

    ``measures`` maps a check name to (aggregate, tolerance).  Both sides are aggregated before they meet,
    so the comparison sees one row per key.
    """

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[m.cast(EXACT).alias(f"{prefix}{i}") for i, (m, _) in enumerate(measures.values())])

    both = side(source, "s").join(side(target, "t"), list(keys), "full_outer")
    zero = F.lit(0).cast(EXACT)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.coalesce(f"s{i}", zero).alias("source_value"),
                F.coalesce(f"t{i}", zero).alias("target_value"),
                F.lit(tolerance).alias("tolerance"),
            )
            for i, (name, (_, tolerance)) in enumerate(measures.items())
        ]
    )
    labelled = both.select(
        F.lit("3_business").alias("check_level"),
        F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]).alias("object_name"),
        F.inline(rows),
    )
    return verdict(labelled, F.col("tolerance")).drop("tolerance")


def naive_gap(lines: DataFrame, correct: Column, amount: str) -> DataFrame:
    """What a total over everything overstates against the total over the rows meeting ``correct``."""
    totals = lines.agg(
        F.sum(amount).cast("double").alias("naive_total"),
        F.sum(F.when(correct, F.col(amount))).cast("double").alias("correct_total"),
    )
    return totals.withColumns(
        {
            "overstatement": F.round(F.col("naive_total") - F.col("correct_total"), 2),
            "overstatement_pct": F.round(100 * (ratio(F.col("naive_total"), F.col("correct_total")) - 1), 2),
        }
    )


def pass_rate(results: DataFrame) -> DataFrame:
    """Checks, passed checks and pass rate per level of the newest run."""
    passed = F.col("status") == "PASS"
    newest = rows_of_newest_run(results, "checked_at")
    return newest.groupBy("check_level").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(passed).alias("passed"),
        F.round(100.0 * F.avg(F.when(passed, 1.0).otherwise(0.0)), 1).alias("pass_rate_pct"),
    )
