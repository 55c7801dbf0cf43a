"""Data-quality rules: expectations (warn / drop / fail), quarantine, metrics,
reconciliation and completeness checks.

Rules are SQL boolean expressions keyed by name. As in a SQL ``WHERE``, a
rule that evaluates to NULL counts as failed: every rule is read through
``coalesce(expr, false)``. All counting is one aggregate pass on the
executors; only the per-rule counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from driftwood import constants as C


class ExpectationFailed(Exception):
    """Raised by ``expect(..., action="fail")`` before anything is published."""


def _passed(expr: str | Column) -> Column:
    c = F.expr(expr) if isinstance(expr, str) else expr
    return F.coalesce(c, F.lit(False))


def rule_counts(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """One row per rule: rule, passed, failed, total, failure_pct (one scan)."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    for i, (_, e) in enumerate(rules.items()):
        aggs.append(F.count_if(~_passed(e)).alias(f"__f{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', __f{i}" for i, n in enumerate(rules))
    long = wide.selectExpr("__total", f"stack({len(rules)}, {stack}) AS (rule, failed)")
    return long.select(
        "rule",
        (F.col("__total") - F.col("failed")).alias("passed"),
        F.col("failed"),
        F.col("__total").alias("total"),
        F.round(F.col("failed") * 100.0 / F.nullif(F.col("__total"), F.lit(0)), 2).alias("failure_pct"),
    )


def expect(df: DataFrame, rules: Mapping[str, str | Column], action: str = "warn",
           observation: Observation | None = None) -> DataFrame:
    """Apply a rule set.

    warn: rows kept, failures counted through ``observation`` (no extra job).
    drop: rows failing any rule removed.
    fail: a count job runs first; any failure raises ``ExpectationFailed``.
    """
    if action not in ("warn", "drop", "fail"):
        raise ValueError(action)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("total"),
                        *[F.count_if(~_passed(e)).alias(n) for n, e in rules.items()])
    if action == "drop":
        ok = F.lit(True)
        for e in rules.values():
            ok = ok & _passed(e)
        return df.filter(ok)
    if action == "fail":
        bad = rule_counts(df, rules).filter("failed > 0").select("rule", "failed").collect()
        if bad:
            raise ExpectationFailed(", ".join(f"{r.rule}: {r.failed} rows" for r in bad))
    return df


def with_reasons(df: DataFrame, rules: Mapping[str, str | Column],
                 col: str = "_quarantine_reason") -> DataFrame:
    """Add an array of the names of rules the row fails (empty when valid)."""
    fails = [F.when(~_passed(e), F.lit(n)) for n, e in rules.items()]
    return df.withColumn(col, F.filter(F.array(*fails), lambda x: x.isNotNull()))


def quarantine_split(df: DataFrame, rules: Mapping[str, str | Column],
                     col: str = "_quarantine_reason") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): exact complements of each other, NULL rules included."""
    tagged = with_reasons(df, rules, col)
    valid = tagged.filter(F.size(col) == 0).drop(col)
    bad = tagged.filter(F.size(col) > 0).withColumn(col, F.array_join(F.col(col), ","))
    return valid, bad


def quality_metrics(df: DataFrame, rules: Mapping[str, str | Column],
                    alert_pct: float = C.QUALITY_ALERT_PCT) -> DataFrame:
    """Rule metrics table with an alert flag when failures exceed ``alert_pct``."""
    return rule_counts(df, rules).withColumn(
        "alert", F.coalesce(F.col("failure_pct") > F.lit(alert_pct), F.lit(False)))


def reconcile(source: DataFrame, target: DataFrame, key: str, recent_col: str | None = None,
              recent_since=None, max_count_diff: int = C.RECONCILE_MAX_COUNT_DIFF,
              max_id_gap: int = C.RECONCILE_MAX_ID_GAP) -> DataFrame:
    """Compare two tables: counts, max key, gap; PASS/FAIL against thresholds."""

    # Tag both sides and aggregate once: no pairing of rows is needed.
    cols = [F.col(key).alias("__k")] + ([F.col(recent_col).alias("__r")] if recent_col else [])
    both = (source.select(*cols, F.lit("source").alias("__side"))
            .unionByName(target.select(*cols, F.lit("target").alias("__side"))))
    aggs = []
    for p in ("source", "target"):
        on = F.col("__side") == p
        aggs += [F.count_if(on).alias(f"{p}_count"), F.max(F.when(on, F.col("__k"))).alias(f"{p}_max_id")]
        if recent_col is not None:
            aggs.append(F.count_if(on & (F.col("__r") >= F.lit(recent_since))).alias(f"{p}_recent"))
    j = both.agg(*aggs)
    j = j.withColumn("count_diff", F.abs(F.col("source_count") - F.col("target_count")))
    j = j.withColumn("id_gap", F.abs(F.col("source_max_id") - F.col("target_max_id")))
    return j.withColumn(
        "status",
        F.when((F.col("count_diff") > max_count_diff) | (F.col("id_gap") > max_id_gap), "FAIL")
        .otherwise("PASS"))


def file_completeness(counts: DataFrame, manifest: DataFrame, file_col: str = "file",
                      expected_col: str = "expected_rows", actual_col: str = "actual_rows") -> DataFrame:
    """Full outer join of a manifest and per-file row counts -> status per file."""
    j = manifest.join(counts, file_col, "full_outer")
    return j.withColumn(
        "status",
        F.when(F.col(actual_col).isNull(), "MISSING")
        .when(F.col(expected_col).isNull(), "UNEXPECTED")
        .when(F.col(actual_col) != F.col(expected_col), "MISMATCH")
        .otherwise("OK"))
