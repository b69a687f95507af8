"""Tables and text written by Spark into the folder that all machines share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local session may
go without that setting; it then uses one temporary folder, which is removed at its end.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Separator and quote characters that never occur in text, so that a line is written as it is.
_NO_SEPARATOR, _NO_QUOTE = "\u0001", "\u0002"
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if (spark.conf.get("spark.master", "") or "").startswith("local"):
        return _own_folder(spark)
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def _own_folder(spark: SparkSession) -> str:
    """The temporary folder of a local session without the setting, the same at every call."""
    application = spark.conf.get("spark.app.id", "")
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="linefit-")
        remove_at_exit(spark, _own_folders[application])
    return _own_folders[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/linefit/{name}-{uuid.uuid4().hex}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the written folder removed when the session's JVM ends.

    A remote (Connect) client has no JVM of its own and leaves the folder in place.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        hadoop = spark._jsparkSession.sessionState().newHadoopConf()
        target.getFileSystem(hadoop).deleteOnExit(target)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a written folder now (a Connect client leaves it in place)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        hadoop = spark._jsparkSession.sessionState().newHadoopConf()
        target.getFileSystem(hadoop).delete(target, True)


def kept_table(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, Callable[[], None]]:
    """As :func:`write_table`, with a function that removes the table again."""
    path = new_path(df.sparkSession, name)
    try:
        return _written(df, path, **options), lambda: remove(df.sparkSession, path)
    except BaseException:
        remove(df.sparkSession, path)
        raise


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet and read back: a short lineage that outlives executors."""
    return _written(df, new_path(df.sparkSession, name))


def _written(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(**options).parquet(path)
    remove_at_exit(df.sparkSession, path)
    fresh = df.sparkSession.read.schema(df.schema).parquet(path)
    return fresh.select(
        *[F.col(f.name).alias(f.name, metadata=f.metadata) for f in df.schema.fields]
    )


def write_lines(lines: DataFrame, name: str, header: str | None = None) -> str:
    """Write the column ``value`` as text files, each starting with ``header`` if given.

    With a header the lines pass through the CSV writer, which leaves blank ones out (as
    readers of such files do).
    """
    path = new_path(lines.sparkSession, name)
    if header is None:
        lines.select("value").write.text(path)
    else:
        lines.select(F.col("value").alias(header)).write.csv(
            path, header=True, sep=_NO_SEPARATOR, quote=_NO_QUOTE, escape=_NO_QUOTE,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="",
        )
    remove_at_exit(lines.sparkSession, path)
    return path
