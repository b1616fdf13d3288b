"""Session helpers: the shared folder, cutting lineage, tables of a run and their removal."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths that written() and folder() made in this process and that are still there.
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a new folder of this machine, but only if all executors run on it: in a local session. On a cluster that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="docloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    where = shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def folder(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, for sweep() to delete."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder: columns compressed, read with pruning."""
    path = folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """What sweep() takes to leave everything made up to now."""
    return len(_made)


def sweep(spark: SparkSession, since: int = 0, *but: str) -> None:
    """Deletes the tables and folders made in this process since the mark, but for the paths named; to be called when no result is read from the others any more."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = [p for p in _made[since:] if p not in but]
    _made[since:] = [p for p in _made[since:] if p in but]
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(hadoop).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deals the rows out anew if the input comes in fewer partitions than there are cores, as one small file does; larger inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def gathered(df: DataFrame, tasks: int = 16) -> DataFrame:
    """Puts so many tasks of a scan of small files into one, while all cores have some left: Spark counts a file as 4 MB at least, so a task of a few dozen small ones is over before it has paid for its start."""
    n, cores = df._jdf.queryExecution().toRdd().getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(n // tasks, 4 * cores)) if n > 4 * cores else df


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """Deals the rows out anew, about so many to a task, and some to all cores: for short rows that stand for much work each."""
    return df.repartition(max(-(-df.count() // rows), 4 * df.sparkSession.sparkContext.defaultParallelism))
