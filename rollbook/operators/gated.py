"""Stopping gates that cost no scan: their counts are observed while a stage is written.

A stage is a table that is stored anyway. Its gates are flag columns that travel with the rows into the store, and their counts are
metrics of that same write, taken directly under it (tasks that write count once, also when an executor is lost and its tasks run again).
When a gate fails, the offenders are a filter on the stored table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.nullsafe import flag
from ..sources.tables import cut_lineage
from .checks import Check, CheckFailed, CheckLog, need_columns


@dataclass(frozen=True)
class Gate:
    """Rows where ``bad`` holds break the gate; at most ``tolerance_pct`` percent of the rows in ``base`` (all, unless given) may.
    ``keys``: what names an offender, then offenders are distinct keys with their rows."""
    name: str
    bad: Column
    tolerance_pct: float = 0.0
    base: Column | None = None
    keys: tuple = ()


def must(rule: Column) -> Column:
    """Rows that break a rule; one where it cannot be decided breaks it."""
    return ~flag(rule)


def write_gated(df: DataFrame, stage: str, log: CheckLog | None, gates=(), info: dict[str, Column] | None = None, min_rows: int = 0, store=cut_lineage,
                each: Column | None = None) -> tuple[DataFrame, dict]:
    """Store ``df`` and run its gates on the way: the stored table and the observed metrics (``rows`` among them).

    ``each``: how many rows a stored row stands for, where it is not one.

    ``info``: aggregates (none distinct) that are logged and never stop. ``min_rows``: a shorter table stops. All gates are logged before the first that fails raises.
    Without a ``log`` the table is only stored.
    """
    if log is None:
        return store(df), {}
    log.begin(stage)
    mark = {f"__gate{i}": flag(g.bad) & (F.lit(True) if g.base is None else flag(g.base)) for i, g in enumerate(gates)}
    base = [F.count(F.lit(1)) if g.base is None else F.count_if(flag(g.base)) for g in gates]
    seen = Observation(f"{stage} {len(log.rows)}")
    counts = [(F.count(F.lit(1)) if each is None else F.sum(each)).alias("rows"), *[F.count_if(F.col(m)).alias(m) for m in mark], *[b.alias(f"__base{i}") for i, b in enumerate(base)],
              *[c.alias(f"__info{i}") for i, c in enumerate((info or {}).values())]]
    stored = store(df.withColumns(mark).observe(seen, *counts))
    # an empty result may have been planned away together with its metrics
    found = {} if stored.isEmpty() else seen.get
    rows, out, failed = found.get("rows", 0), stored.drop(*mark), []
    log.info(f"{stage}: rows", rows)
    for i, name in enumerate(info or {}):
        log.info(name, found.get(f"__info{i}"))
    if min_rows:
        log.add_gate(f"{stage}: at least {min_rows} row(s)", rows >= min_rows, f"{rows} row(s)")
        failed += [f"{stage}: {rows} row(s), need {min_rows}"] * (rows < min_rows)
    for i, g in enumerate(gates):
        bad, of = found.get(f"__gate{i}", 0), found.get(f"__base{i}", 0)
        passed = 100.0 * bad <= g.tolerance_pct * of
        log.add_gate(g.name, passed, f"{bad} of {of}", f"tolerance {g.tolerance_pct}%" if g.tolerance_pct else None)
        if not passed:
            hits = stored.filter(F.col(f"__gate{i}")).drop(*mark)
            log.keep(Check(g.name, hits.groupBy(*g.keys).agg(F.count(F.lit(1)).alias("n_rows")) if g.keys else hits))
            failed.append(f"{g.name}: {bad} of {of}")
    if failed:
        raise CheckFailed("; ".join(failed))
    return out, {"rows": rows} | {name: found.get(f"__info{i}") for i, name in enumerate(info or {})}


def keyed(df: DataFrame, keys, name: str, log: CheckLog | None, store=cut_lineage) -> DataFrame:
    """A lookup with one row per key (nulls are a key), stored. Repeated keys stop when there is a ``log``; without one the smallest row by its other columns is kept,
    so that a join can never multiply rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    need_columns(df, keys, name)
    fields = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*fields)).alias("__f") if fields else F.lit(None).alias("__f"))
    one = one.select(*keys, *[F.col(f"__f.`{c}`").alias(c) for c in fields], "__n")
    stored, _ = write_gated(one, name, log, [Gate(f"{name}: keys are unique", F.col("__n") > 1, keys=tuple(keys))], store=store)
    return stored.drop("__n")
