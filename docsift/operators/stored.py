"""Tables that cut a lineage, kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own; a cluster must name a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docsift-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet and read back: columnar, compressed, safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Deletes the stored tables that these read, once nothing needs them, and asks the driver to collect its garbage:
    only then do the shuffle files of finished steps go. Other files are left alone."""
    session = tables[0].sparkSession
    made = shared_folder(session).rsplit("/", 1)[-1] + "/table-"
    path_of = session.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        if made in path:
            gone = path_of(path)
            gone.getFileSystem(session._jsc.hadoopConfiguration()).delete(gone, True)
    session.sparkContext._jvm.System.gc()
