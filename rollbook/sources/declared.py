"""Declared text sources read under a gate: a record that does not fit its schema is kept as it stands, counted, reported and stopped on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.checks import CheckLog
from ..operators.gated import Gate, write_gated
from .tables import normalise_headers, read_source

#: Columns of a record that could not be read: the record, and the file that holds it.
BAD, FILE = "__bad_record", "__source_file"
TEXT_FORMATS = ("csv", "json")


def read_gated(spark: SparkSession, sources: dict, key: str, log: CheckLog | None = None, tolerance_pct: float = 0.0, clean_names: bool = False,
               min_rows: int = 0) -> tuple[DataFrame, DataFrame] | None:
    """``(records, bad)`` of one declared source of :func:`read_source`, or ``None`` for one that is not supplied.

    ``bad`` has each record with too few or too many fields, a value that is not of its column's type or broken syntax: ``record, file``, nothing of it is in ``records``.
    More of them than ``tolerance_pct`` percent of all stop (with a ``log``; its offenders are the bad records). The source is read once: what is returned is stored, and the
    gate's count is a metric of that write. Text sources need a schema; other formats hold no bad records. A header is compared with the schema unless
    the options of the source say otherwise, since columns in another order would be read as each other.
    """
    spec = sources.get(key)
    if not spec or not spec.get("path") or spec.get("format", "parquet") not in TEXT_FORMATS:
        df = read_source(spark, sources, key)
        if df is None:
            return None
        df = df.withColumns({BAD: F.lit(None).cast("string"), FILE: F.lit(None).cast("string")})
    else:
        if spec.get("schema") is None:
            raise ValueError(f"a {spec['format']} source needs a schema to tell its bad records: {key}")
        schema = spec["schema"] if isinstance(spec["schema"], StructType) else StructType.fromDDL(spec["schema"])
        checked = {"enforceSchema": "false"} if spec["format"] == "csv" else {}
        options = checked | spec.get("options", {}) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
        df = read_source(spark, {key: spec | {"schema": StructType([*schema.fields]).add(BAD, StringType()), "options": options}}, key)
        df = df.withColumn(FILE, F.col("_metadata.file_path"))
    gate = Gate(f"{key}: records can be read", F.col(BAD).isNotNull(), tolerance_pct)
    stored, _ = write_gated(df, f"source {key}", log, [gate], min_rows=min_rows)
    good = stored.filter(F.col(BAD).isNull()).drop(BAD, FILE)
    return normalise_headers(good) if clean_names else good, stored.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("record"), F.col(FILE).alias("file"))
