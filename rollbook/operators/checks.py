"""Data-quality gates.

A check is a named DataFrame of offenders, evaluated lazily. :class:`CheckLog` runs checks, keeps one
log row per check (the log is a handful of rows, so it lives on the driver), stores the offenders of a
failed check as a DataFrame and raises. Gates that look at single rows share one pass over the data.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nullsafe import any_of, col, count_where, flag, join_same, n_distinct, not_in, pct


class CheckFailed(Exception):
    pass


@dataclass(frozen=True)
class Check:
    name: str
    offenders: DataFrame
    detail: str | None = None

    def result(self) -> DataFrame:
        """One row: check, result, n_offenders."""
        return self.offenders.agg(F.count(F.lit(1)).alias("n_offenders")).select(
            F.lit(self.name).alias("check"),
            F.when(F.col("n_offenders") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("result"),
            "n_offenders")


def missing_columns(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c not in df.columns]


def need_columns(df: DataFrame, columns, name: str) -> None:
    lost = missing_columns(df, columns)
    if lost:
        raise CheckFailed(f"{name}: missing column(s) {', '.join(lost)}")


def unique(df: DataFrame, keys, name: str = "keys are unique") -> Check:
    """No key combination (nulls included) occurs twice."""
    need_columns(df, keys, name)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    return Check(name, dup.orderBy(F.desc("n_rows"), *keys))


def no_nulls(df: DataFrame, columns, name: str = "values are present") -> Check:
    need_columns(df, columns, name)
    return Check(name, df.filter(any_of([F.col(c).isNull() for c in columns])))


def values_in(df: DataFrame, column: str, allowed, name: str = "values are allowed") -> Check:
    """Known values outside the allowed set; nulls are ignored."""
    need_columns(df, [column], name)
    bad = df.filter(F.col(column).isNotNull() & not_in(column, allowed))
    return Check(name, bad.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def rows_stable(before: DataFrame, after: DataFrame, name: str = "row count is unchanged") -> Check:
    one = lambda d, c: d.agg(F.count(F.lit(1)).alias(c))
    return Check(name, one(before, "n_before").join(one(after, "n_after"), F.lit(True))
                 .filter("n_before <> n_after"))


def ids_stable(before: DataFrame, after: DataFrame, id_col: str, name: str = "ids are unchanged") -> Check:
    """Ids lost or gained, with the direction."""
    b, a = before.select(id_col).distinct(), after.select(id_col).distinct()
    lost = join_same(b, a, id_col, "left_anti").withColumn("direction", F.lit("lost"))
    gained = join_same(a, b, id_col, "left_anti").withColumn("direction", F.lit("gained"))
    return Check(name, lost.unionByName(gained))


def row_rule(df: DataFrame, rule: Column, name: str) -> Check:
    """Rows breaking ``rule``; a row where it cannot be decided breaks it."""
    return Check(name, df.filter(~flag(rule)))


def gates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Many row rules in one pass: (check, result, n_offenders) per rule."""
    counted = df.agg(*[count_where(~flag(r)).alias(f"g{i}") for i, r in enumerate(rules.values())])
    args = ", ".join(f"{json.dumps(n)}, g{i}" for i, n in enumerate(rules))
    out = counted.select(F.expr(f"stack({len(rules)}, {args}) as (check, n_offenders)"))
    return out.select("check", F.when(F.col("n_offenders") == 0, "PASS").otherwise("FAIL").alias("result"),
                      "n_offenders")


def gate_share(df: DataFrame, bad: Column, tolerance_pct: float, name: str) -> DataFrame:
    """Share of rows that are bad, against a tolerance; the base is all rows."""
    return df.agg(count_where(bad).alias("n_offenders"), F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("check"),
        F.when(F.lit(100.0) * F.col("n_offenders") <= F.lit(float(tolerance_pct)) * F.col("n_rows"), "PASS")
         .otherwise("FAIL").alias("result"),
        "n_offenders", pct("n_offenders", "n_rows", 3).alias("pct"))


def distinct_values(df: DataFrame, *columns) -> DataFrame:
    return df.agg(n_distinct(*columns).alias("n_distinct"))


# The badge texts and the log result each one stands for.
BADGES = {"PASS": "PASS", "CHECK": "REVIEW", "FAIL": "FAIL"}


def badge_result(c) -> Column:
    """Log result of a badge text; anything unknown is informational."""
    out = F.lit("INFO")
    for badge, result in BADGES.items():
        out = F.when(flag(col(c) == badge), F.lit(result)).otherwise(out)
    return out


LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.IntegerType(), False), T.StructField("stage", T.StringType()),
    T.StructField("check", T.StringType(), False), T.StructField("severity", T.StringType(), False),
    T.StructField("result", T.StringType(), False), T.StructField("value", T.StringType()),
    T.StructField("detail", T.StringType()), T.StructField("time", T.TimestampType(), False),
])


def log_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("severity", "result").agg(F.count(F.lit(1)).alias("n_checks"))


@dataclass
class CheckLog:
    """Ordered record of the checks of one run."""
    spark: SparkSession
    evidence_dir: str | None = None
    stage: str | None = None
    rows: list = field(default_factory=list)
    failed: dict = field(default_factory=dict)

    def begin(self, stage: str) -> None:
        self.stage = stage

    def reset(self) -> None:
        self.rows.clear(), self.failed.clear()
        self.stage = None

    def _add(self, check, severity, result, value=None, detail=None) -> None:
        self.rows.append((len(self.rows) + 1, self.stage, check, severity, result,
                          None if value is None else str(value), detail, dt.datetime.now()))

    def info(self, check: str, value=None, detail: str | None = None) -> None:
        self._add(check, "info", "INFO", value, detail)

    def badge(self, check: str, status: str, value=None) -> None:
        self._add(check, "review", BADGES.get(status, "INFO"), value)

    def add_gate(self, check: str, passed: bool, value=None, detail: str | None = None) -> None:
        """Log a gate that was decided elsewhere, such as by observed metrics."""
        self._add(check, "stop", "PASS" if passed else "FAIL", value, detail)

    def keep(self, check: Check) -> None:
        """Keep the offenders of a failed gate, and write them where evidence is wanted."""
        self.failed[check.name] = check.offenders
        self._write_evidence(check)

    def require_equal(self, check: str, before: int, after: int) -> None:
        self.add_gate(check, before == after, f"{before} before, {after} after")
        if before != after:
            raise CheckFailed(f"{check}: {before} before, {after} after")

    def require(self, check: Check) -> None:
        """Run a check; on failure keep its offenders, write the evidence and raise."""
        row = check.result().first()
        self._add(check.name, "stop", row["result"], f"{row['n_offenders']} offender(s)", check.detail)
        if row["result"] != "PASS":
            self.keep(check)
            raise CheckFailed(f"{check.name}: {row['n_offenders']} offender(s)")

    def require_all(self, results: DataFrame) -> None:
        """Run a (check, result, n_offenders) table, such as :func:`gates` gives, and raise if any failed."""
        bad = []
        for row in results.collect():
            self._add(row["check"], "stop", row["result"], f"{row['n_offenders']} offender(s)")
            if row["result"] != "PASS":
                bad.append(row["check"])
        if bad:
            raise CheckFailed("; ".join(bad))

    def _write_evidence(self, check: Check) -> None:
        if self.evidence_dir:
            plain = "".join(ch if ch.isalnum() else "_" for ch in check.name.lower()).strip("_")
            name = f"{plain[:60]}-{hashlib.sha256(check.name.encode()).hexdigest()[:16]}"  # readable, and one folder per check
            check.offenders.write.mode("overwrite").parquet(f"{self.evidence_dir}/{name}")
            self.table().write.mode("overwrite").parquet(f"{self.evidence_dir}/check_log")

    def offenders(self, check: str | None = None):
        return list(self.failed) if check is None else self.failed[check]

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, LOG_SCHEMA)

    def write(self, sink, run: str, district: str, config: dict) -> dict | None:
        """Publish the log with the run's name, the district and a hash of the parameters; a run is logged once."""
        digest = hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:12]
        stamped = self.table().withColumns({"run_at": F.current_timestamp(), "district": F.lit(district), "config_hash": F.lit(digest)})
        return sink.publish(stamped, "check_log", run, config=digest)
