"""Products on disk: masters, corrected frames, zero points and tables of star widths.

Masters, corrected frames and zero points are versioned by key (versions.py): a rerun of one frame, or of one night's master, replaces that
one alone, and a run that breaks changes nothing. Nulls are written as nulls; an empty table is a version without rows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import newest, upsert

PSF_SCHEMA = "frame_id long, i int, j int, fwhm_avg double, fwhm_median double, fwhm_stddev double, peak_min double, peak_max double, n_star long"
MASTER_KEYS = ["imagetyp", "grp", "obsdate"]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all machines share: in spark.checkpoint.dir, or a temporary one where all runs on this machine."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not shared and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{shared or 'file://' + tempfile.gettempdir() + '/frameloom-checkpoints'}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def write_masters(masters: DataFrame, path: str) -> int:
    """Add masters (imagetyp, grp, obsdate, y, x, ...): those of a type, group (an exposure, a filter) and day replace what was there."""
    return upsert(masters, path, MASTER_KEYS, ["imagetyp", "obsdate"])


def read_masters(spark: SparkSession, path: str) -> DataFrame:
    return newest(spark, path, MASTER_KEYS)


def write_level1(pixels: DataFrame, path: str) -> int:
    """Add corrected pixels and their mask bits (frame_id, obsdate, lv1_name, y, x, v, bits): a frame replaces its earlier self."""
    return upsert(pixels, path, ["frame_id"], ["obsdate"])


def read_level1(spark: SparkSession, path: str) -> DataFrame:
    return newest(spark, path, ["frame_id"])


def write_zeropoints(zeropoints: DataFrame, path: str) -> int:
    """Add rows (frame_id, obsdate, ...): a frame's rows replace its earlier ones."""
    return upsert(zeropoints, path, ["frame_id"], ["obsdate"])


def read_zeropoints(spark: SparkSession, path: str) -> DataFrame:
    return newest(spark, path, ["frame_id"])


def apply_updates(frames: DataFrame, updates: DataFrame, columns: list[str]) -> DataFrame:
    """frames with the columns set to those of updates (frame_id, columns): where a frame has no update, or the update is null, the old value stays;
    columns that frames lack are new. frame_id names an update once."""
    new = updates.select(F.col("frame_id").alias("_id"), *(F.col(c).alias(f"_new_{c}") for c in columns))
    out = frames.join(new, F.col("frame_id") == F.col("_id"), "left")
    return out.withColumns({c: F.coalesce(f"_new_{c}", c) if c in frames.columns else F.col(f"_new_{c}") for c in columns}).drop("_id", *(f"_new_{c}" for c in columns))


def write_psf_table(tiles: DataFrame, path: str) -> None:
    """Columns that tiles lack are written as nulls."""
    columns = [c.split(" ") for c in PSF_SCHEMA.split(", ")]
    tiles.select(*(F.col(c) if c in tiles.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns)).write.mode("overwrite").option("header", True).csv(path)


def read_psf_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PSF_SCHEMA).option("header", True).csv(path)
