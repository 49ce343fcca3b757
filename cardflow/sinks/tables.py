"""Table sinks (SNK-1..SNK-5) and the incremental key load (CMP-5).

A target is a parquet folder when it contains ``/`` or ``:``, else a catalog table name.
Materialisation uses reliable ``checkpoint()`` into the session's shared checkpoint folder, so
a lost executor cannot take the only copy of rows that are about to be appended.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardflow.functions.dates import BusinessDate
from cardflow.operators.membership import unseen_rows
from cardflow.session import checkpoint_dir
from cardflow.sinks.files import Folder


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """A catalog table, a folder of Parquet files, or the current version of a versioned folder."""
    if not is_path(target):
        return spark.table(target)
    from cardflow.sinks.versions import Versions, is_versioned

    return Versions(spark, target).read() if is_versioned(spark, target) else spark.read.parquet(target)


def target_exists(spark: SparkSession, target: str) -> bool:
    """Whether the catalog table or folder exists, asked of the catalog or the file system
    (not by a read that fails)."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (reliable checkpoint in the shared folder)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def append_rows(df: DataFrame, target: str, columns: Sequence[str]) -> None:
    """``INSERT INTO target (columns) SELECT columns ...`` (SNK-1).

    Columns are matched by name. A catalog table must exist, like the SQL original; a parquet
    folder is created on first append.
    """
    out = df.select(*columns)
    if is_path(target):
        out.write.mode("append").parquet(target)
    else:
        table_cols = [c.name for c in out.sparkSession.catalog.listColumns(target)]
        out.select(*table_cols).write.insertInto(target)


def append_returning(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Append and hand the appended rows on (``INSERT ... RETURNING *``, SNK-2).

    The rows are materialised *before* the append; a lazy plan that anti-joins the target would
    re-evaluate to nothing once its own rows are in the target.
    """
    kept = materialize(df.select(*columns))
    append_rows(kept, target, columns)
    return kept


def replace_table(df: DataFrame, target: str) -> None:
    """``DROP TABLE IF EXISTS`` + ``CREATE TABLE AS`` (SNK-3).

    The rows are completely written to a staging table or sibling folder first, and only then take
    the target's place by renaming. A job that fails leaves the old rows as they were, and a plan that
    reads its own target, however the path is spelled, needs no special care. Between the two
    renames (drop and rename for a catalog table) there is a moment without a target.
    """
    spark = df.sparkSession
    if is_path(target):
        _replace_folder(df, target)
        return
    staging = f"{target}__staging"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    df.write.format("parquet").saveAsTable(staging)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {target}")


def _replace_folder(df: DataFrame, target: str) -> None:
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(target.rstrip("/"))
    mark = uuid.uuid4().hex
    staging, old = (hadoop.Path(place.getParent(), f"_{kind}_{place.getName()}_{mark}") for kind in ("new", "old"))
    df.write.parquet(staging.toString())
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"could not move {target} aside; the new rows are in {staging}")
    if not fs.rename(staging, place):
        fs.rename(old, place)
        raise OSError(f"could not move {staging} to {target}")
    fs.delete(old, True)


def report_path(root: str, name: str, bd: BusinessDate, grain: str = "day") -> str:
    """``{root}/{name}_{stamp}``: ``%Y%m%d`` for daily, ``%Y%m`` for monthly reports (SNK-4)."""
    return f"{root.rstrip('/')}/{name}_{bd.stamp(grain)}"


def write_report(df: DataFrame, root: str, name: str, bd: BusinessDate, grain: str = "day",
                 fmt: str = "csv") -> tuple[str, int]:
    """Export a report under a dated name and return (path, row count) (SNK-4, SNK-5).

    A re-run for the same period overwrites. The row count comes from an ``Observation`` on
    the write itself, not from a second pass over the data.
    """
    path = report_path(root, name, bd, grain)
    obs = Observation(f"rows_{name}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite")
    if fmt == "csv":
        # text as it is: blanks at either end belong to the value
        writer = (writer.option("header", True).option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False))
    writer.format(fmt).save(path)
    return path, int(obs.get["rows"])


@dataclass(frozen=True)
class Manifest:
    """What an export holds, independent of the order of its rows."""

    name: str
    rows: int
    row_digest: int
    column_digests: dict[str, int]


_PRIME = (1 << 31) - 1


def _text_values(df: DataFrame) -> dict[str, Column]:
    """Every column as the export's text has it; NULL and empty text are one in CSV."""
    return {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns}


def _digests(df: DataFrame) -> list[Column]:
    values = _text_values(df)
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.pmod(F.xxhash64(*values.values()), F.lit(_PRIME))).alias("row_digest"),
            *[F.sum(F.pmod(F.xxhash64(v), F.lit(_PRIME))).alias(f"c_{k}") for k, v in enumerate(values.values())]]


def _manifest(name: str, columns: Sequence[str], seen: Mapping[str, int | None]) -> Manifest:
    return Manifest(name, int(seen["rows"]), int(seen["row_digest"] or 0),
                    {c: int(seen[f"c_{k}"] or 0) for k, c in enumerate(columns)})


def export_with_manifest(df: DataFrame, root: str, name: str, bd: BusinessDate, grain: str = "day",
                         fmt: str = "csv") -> tuple[str, Manifest]:
    """``write_report`` with a manifest beside the rows (``_manifest.json``): the dated name, the row count, a
    digest of the rows and one of each column, all observed in the write itself (SNK-4, SNK-5, FN-12)."""
    path = report_path(root, name, bd, grain)
    seen = Observation(f"manifest_{name}")
    observed = df.observe(seen, *_digests(df))
    write_report(observed, root, name, bd, grain, fmt)
    manifest = _manifest(path.rpartition("/")[2], df.columns, seen.get)
    Folder(df.sparkSession, path).write_json("_manifest.json", asdict(manifest))
    return path, manifest


def verify_export(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> Manifest:
    """Read an export back and compare it with its manifest; raises where they differ."""
    kept = Folder(spark, path).read_json("_manifest.json")
    reader = spark.read.schema(schema)
    back = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    found = _manifest(path.rstrip("/").rpartition("/")[2], back.columns, back.agg(*_digests(back)).first().asDict())
    if asdict(found) != kept:
        wrong = [c for c in found.column_digests if found.column_digests[c] != kept["column_digests"].get(c)]
        raise ValueError(f"{path} differs from its manifest: rows {found.rows} of {kept['rows']}, columns {wrong}")
    return found


def stamp_rows(df: DataFrame, load_date: dt.date, load_col: str = "data_load_dt") -> DataFrame:
    """Constant load-date stamp column (PRJ-10)."""
    return df.withColumn(load_col, F.lit(load_date))


def new_keys(batch: DataFrame, history: DataFrame, match_on: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not yet in ``history`` (``NOT EXISTS``).

    Only the key columns of the history are read; a bitmap of the batch's keys filters them in the scan, so
    only keys that may be in the batch are shuffled. Duplicate keys inside the batch all stay: the
    check sees the history as it was before this load.
    """
    return unseen_rows(batch, history, match_on)


def load_new_keys(batch: DataFrame, target: str, match_on: Sequence[str], columns: Sequence[str],
                  load_date: dt.date, load_col: str = "data_load_dt") -> DataFrame:
    """Incremental load (CMP-5): append the batch rows with unseen keys and return them.

    Keys the target already holds, of whatever load date, are left out, so a second batch of the same
    date adds its unseen keys and a re-run adds nothing. The returned rows are read back from the
    target by ``load_date``: a retry after a failure between append and report gives the same report.
    """
    spark = batch.sparkSession
    delta = new_keys(batch, read_target(spark, target), match_on) if target_exists(spark, target) else batch
    append_rows(stamp_rows(delta, load_date, load_col), target, columns)
    return read_target(spark, target).filter(F.col(load_col) == F.lit(load_date))
