"""Session-level helpers shared by the operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names in ``spark.checkpoint.dir``. Only a single-machine session (tests) may do without: it gets a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="concordia-checkpoint-")
        sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder, so that later steps neither repeat it nor depend on an executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


def settled(c):
    """``c``, marked so that the optimizer works it out once: no rule repeats or moves an expression that is not deterministic.

    For costly columns that later filters and columns read many times over. The row number is only there to be not deterministic; it is never negative.
    """
    return F.when(F.monotonically_increasing_id() >= 0, c)


#: White space of Unicode, the zero-width blank and the byte-order mark.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200C))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def blank_trim(c):
    """``c`` without Unicode white space at either end; looks at the ends only."""
    return F.btrim(c, F.lit(BLANKS))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def existing_paths(spark: SparkSession, *paths: str) -> list[str]:
    """Those of ``paths`` (globs may be) that are there. What cannot be looked at raises: it is not the same as missing."""
    out = []
    for path in paths:
        p, fs = _path(spark, path)
        found = fs.globStatus(p)
        if found is not None and len(found):
            out.append(path)
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on the cluster's storage, in the place of one that is there."""
    p, fs = _path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
