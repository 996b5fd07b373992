"""Intermediate tables on the storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def names(frame: DataFrame, *without: str) -> list[str]:
    """The columns but for some, quoted for select."""
    return [f"`{c.replace('`', '``')}`" for c in frame.columns if c not in without]


def unused(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that the frame doesn't have: the wanted ones, lengthened where they are taken."""
    taken, free = {c.lower() for c in frame.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def masked(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame under column names that no helper column has, and these names by the frame's own."""
    free = [f"given_{i}" for i in range(len(frame.columns))]
    return frame.toDF(*free), dict(zip(frame.columns, free))


def quoted(name: str) -> str:
    """One column name, whatever characters it has, for select and col."""
    return f"`{name.replace('`', '``')}`"


def checkpoints(spark: SparkSession) -> None:
    """Settle the folder for checkpoints: spark.checkpoint.dir, or on a local master a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)


def stored(frame: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint: lineage ends here, and lost executors cost no recomputation."""
    checkpoints(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame) -> DataFrame:
    """The rows as a Parquet table below the checkpoint folder: as reliable, and read by column. It stays until the folder is cleared."""
    return placed(frame)[0]


def placed(frame: DataFrame, codec: str | None = None) -> tuple[DataFrame, str]:
    """As written, and the table's folder. codec: the session's if not given.

    A checkpoint hands on what the optimizer knows of its columns, and in a loop that knowledge multiplies from round to round
    until the driver has no memory left. A table read again knows nothing of its making.
    """
    session = frame.sparkSession
    checkpoints(session)
    path = f"{session.sparkContext.getCheckpointDir()}/written-{uuid.uuid4().hex}"
    frame.write.parquet(path, compression=codec)
    return session.read.schema(frame.schema).parquet(path), path


def erase(session: SparkSession, *folders: str) -> None:
    """Delete the folders of tables that nothing will be computed from any more."""
    for folder in folders:
        path = session._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def forget(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing will be computed from any more."""
    for frame in frames:
        session = frame.sparkSession
        path = frame._jdf.logicalPlan().rdd().getCheckpointFile()
        if path.isDefined():
            folder = session._jvm.org.apache.hadoop.fs.Path(path.get())
            folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)
