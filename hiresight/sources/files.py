"""The few file operations that tables need beside Spark's readers and
writers, through Hadoop's file system (any store Spark reaches)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def any_match(spark: SparkSession, glob: str) -> bool:
    fs, p = _at(spark, glob)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted (none if it is missing)."""
    fs, p = _at(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()) if fs.exists(p) else []


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, sorted (none if it is missing)."""
    fs, p = _at(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile()) if fs.exists(p) else []


def modified(spark: SparkSession, path: str) -> float:
    """Last change, in seconds since 1970."""
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; false if another writer has created it."""
    fs, p = _at(spark, path)
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            return False
        raise e
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    fs, p = _at(spark, path)
    fs.delete(p, True)
