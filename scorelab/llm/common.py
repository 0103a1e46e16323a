"""Tables, shared folders and worker state for the operators of this package.

Intermediate tables of an application lie in one folder of its own under the
shared checkpoint folder. A result may read them until it has been written, so
they go when the application ends, or when ``remove_intermediates`` is called.
"""

from __future__ import annotations

import atexit
import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders that this driver process removes when it ends.
_owned: set[str] = set()


def working_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, in the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scorelab-{spark.sparkContext.applicationId}"


def _delete(jvm, conf, folder: str) -> None:
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def remove_intermediates(spark: SparkSession) -> None:
    """Removes all intermediate tables of this application; results that were not written yet can't be read any more."""
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), working_folder(spark))


def _at_end(jvm, conf, folder: str) -> None:
    try:
        _delete(jvm, conf, folder)
    except Exception as e:  # the JVM may have ended before
        print(f"intermediate tables stay in {folder}: {e}", file=sys.stderr)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's working folder."""
    folder = working_folder(spark)
    if folder not in _owned:
        _owned.add(folder)
        atexit.register(_at_end, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_by_worker(key: tuple, make):
    """An object that a Python worker keeps from task to task (vocabulary tables, bounded caches)."""
    holder = sys.modules.setdefault("_scorelab_worker", types.ModuleType("_scorelab_worker"))
    kept = holder.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
