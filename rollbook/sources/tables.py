"""Declared sources, header rules, sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_header
from ..operators.checks import Check, CheckFailed


def read_source(spark: SparkSession, sources: dict, key: str, clean_names: bool = False) -> DataFrame | None:
    """Read one declared source.

    ``sources`` maps a key to ``None`` (declared, not supplied) or ``{"path", "format", "schema",
    "options"}``. A key that is not declared is an error; one without a file gives ``None``.
    """
    if key not in sources:
        raise KeyError(f"source is not declared: {key}")
    spec = sources[key]
    if not spec or not spec.get("path"):
        return None
    fmt = spec.get("format", "parquet")
    reader = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {}))
    reader = reader.options(**spec.get("options", {}))
    if spec.get("schema") is not None:
        reader = reader.schema(spec["schema"])
    df = reader.load(spec["path"])
    return normalise_headers(df) if clean_names else df


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower snake case headers; a repeated header gets a running number."""
    seen: dict[str, int] = {}
    names = []
    for c in map(clean_header, df.columns):
        seen[c] = seen.get(c, 0) + 1
        names.append(c if seen[c] == 1 else f"{c}_{seen[c]}")
    return df.toDF(*names)


def rename_to_standard(df: DataFrame, column_map: dict, keep_only: bool = False) -> DataFrame:
    """Apply ``standard name -> source name``. ``keep_only`` also projects to the mapped columns and
    drops exact duplicate rows. Mapped columns that the source lacks are skipped."""
    present = {src: std for std, src in column_map.items() if src in df.columns}
    out = df.withColumnsRenamed(present)
    return out.select(*present.values()).distinct() if keep_only else out


def restore_prefix(df: DataFrame, lower: str = "c_", upper: str = "C_") -> DataFrame:
    return df.withColumnsRenamed({c: upper + c[len(lower):] for c in df.columns if c.startswith(lower)})


def ensure_columns(df: DataFrame, columns: dict[str, str] | list[str]) -> DataFrame:
    """Add the columns that are missing as typed nulls (``{name: type}`` or names, then text)."""
    wanted = columns if isinstance(columns, dict) else {c: "string" for c in columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def prefix_order(df: DataFrame) -> DataFrame:
    """Reported columns, then derived, then measures, then the rest."""
    rank = lambda c: next((i for i, p in enumerate(("D_", "C_", "M_")) if c.startswith(p)), 3)
    return df.select(*sorted(df.columns, key=rank))


def require_input(df: DataFrame | None, name: str, min_rows: int = 1) -> DataFrame:
    """A needed table: absent or too short raises. At most ``min_rows`` rows are looked at."""
    if df is None:
        raise CheckFailed(f"{name}: not supplied")
    found = df.limit(min_rows).count() if min_rows > 0 else 0
    if found < min_rows:
        raise CheckFailed(f"{name}: {found} row(s), need {min_rows}")
    return df


def row_floor(df: DataFrame, name: str, min_rows: int) -> Check:
    return Check(name, df.limit(min_rows).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < min_rows))


def coding_template(df: DataFrame, group_by, uncoded_fields) -> DataFrame:
    """Distinct course keys with every field to be coded set to a marker."""
    return df.select(*group_by).distinct().withColumns({f: F.lit("UNCODED") for f in uncoded_fields})


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; only a local session may fall back to a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can read")


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder beside the stored tables, for files that every executor can read."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"


#: Parts of :func:`deal` for each of the session's shuffle partitions.
FINER = 4


def deal(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by ``keys`` for several sorts in a row, in a fixed number of parts.

    Spark joins parts by the compressed bytes that were shuffled. Rows that are exploded or sorted wide afterwards take many times that in a task, and what does not fit
    is spilled in every sort. The number of parts follows the session's shuffle partitions.
    """
    return df.repartition(FINER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def cut_lineage(df: DataFrame, compression: str = "zstd", level: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    Later steps start from the stored table: an iteration's plan does not grow, a table read by many
    steps is computed once, a lost executor costs a re-read, and the stored size lets Spark choose joins.
    ``level``: that of zstd, where it is not the writer's own.
    """
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    options = {} if level is None else {"parquet.compression.codec.zstd.level": str(level)}
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
