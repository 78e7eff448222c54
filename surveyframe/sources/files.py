"""Small file operations on whatever file system a path names, by Spark's own Hadoop client."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of the entries of a folder; none where it does not exist."""
    fs, path = _at(spark, folder)
    return sorted(e.getPath().getName() for e in fs.listStatus(path)) if fs.exists(path) else []


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _at(spark, folder)
    fs.delete(path, True)


def read_text(spark: SparkSession, file: str) -> str:
    fs, path = _at(spark, file)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, file: str, encoding: str = "UTF-8") -> str | None:
    """The first line that is not blank; None where there is none. Reads one buffer, compressed files too."""
    fs, path = _at(spark, file)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    stream = fs.open(path)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(plain, encoding))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: list[str], encoding: str = "UTF-8", at_once: int = 16) -> list[str | None]:
    """The first lines of many files, some at a time and without a Spark job."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda f: first_line(spark, f, encoding), files))


def publish_text(spark: SparkSession, file: str, text: str) -> bool:
    """Write a new file that others see whole or not at all; False where its name is taken already."""
    fs, path = _at(spark, file)
    folder, name = file.rsplit("/", 1)
    _, staged = _at(spark, f"{folder}/.{name}-{spark._jvm.java.util.UUID.randomUUID().toString()}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(staged, path, no_options)  # fails where the target exists
        return True
    except Py4JJavaError as e:
        fs.delete(staged, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
