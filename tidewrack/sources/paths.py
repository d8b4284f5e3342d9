"""Names of files and small files of their own, through the file system of the path (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Paths of a folder's entries in order of name; none if it is missing."""
    fs, p = _fs(spark, folder)
    return sorted(x.getPath().toString() for x in fs.listStatus(p)) if fs.exists(p) else []


def readable(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    try:
        fs.access(p, spark._jvm.org.apache.hadoop.fs.permission.FsAction.READ)
        return True
    except Exception as e:
        if "AccessControlException" in str(e) or "FileNotFoundException" in str(e):
            return False
        raise


def as_folder(spark: SparkSession, path: str, name: str) -> None:
    """If the path is a file, makes it a folder that holds the file under the name."""
    fs, p = _fs(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.moving")
        fs.rename(p, aside)
        fs.mkdirs(p)
        fs.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(p, name))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a short text as one file, in place of what is there."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_one(spark: SparkSession, path: str, parts: list[str | DataFrame]) -> None:
    """Writes texts and the lines of frames (one text column, in their order) as one file: frames are written by their tasks beside it, then
    all is copied together stream by stream, so that no frame passes through the driver's memory."""
    fs, p = _fs(spark, path)
    io = spark._jvm.org.apache.hadoop.io.IOUtils
    beside = f"{path}.parts"
    try:
        for i, x in enumerate(parts):
            if isinstance(x, DataFrame):
                x.write.mode("overwrite").text(f"{beside}/{i}")
        out = fs.create(p, True)
        try:
            for i, x in enumerate(parts):
                if not isinstance(x, DataFrame):
                    out.write(bytearray(x.encode("utf-8")))
                    continue
                for f in listed(spark, f"{beside}/{i}"):
                    if f.rsplit("/", 1)[-1].startswith("part-"):
                        source = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f))
                        io.copyBytes(source, out, spark._jsc.hadoopConfiguration(), False)
                        source.close()
        finally:
            out.close()
    finally:
        delete(spark, beside)
