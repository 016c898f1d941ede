"""Uploaded files: listing, admission rules, duplicate detection and line reads."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Admission rules of an upload.
ADMITTED_EXTENSIONS = ["csv", "txt", ""]
MAX_FILE_BYTES = 100 * 1024 * 1024
# A stream's checkpoint decides what is loaded, never the age of a file.
_ANY_AGE = "36500d"
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
SAFE_NAME = r"^[a-zA-Z0-9_\-\.]+$"
UPLOAD_NAME = r"(?i)^detail_record_\d{4}_\d{2}_\d{2}_\d{2}_\d{2}_\d{2}(\.(csv|txt))?$"
MONTH_IN_NAME = r"(?i)^detail_record_\d{4}_(0[1-9]|1[0-2])_"
# A name that passes every rule: the upload pattern implies extension and characters.
ADMITTED_NAME = UPLOAD_NAME.replace(r"\d{4}_\d{2}", r"\d{4}_(0[1-9]|1[0-2])", 1)


def upload_name(path: Column) -> Column:
    """Name of the upload a physical file belongs to.

    An upload is a file, or a folder of part files as Spark writes one, which may
    also be the folder of a partition value (``column=upload``). Plain string
    functions, because this is computed for every line.
    """
    last = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.substring_index(F.when(last.startswith("part-"), folder).otherwise(last), "=", -1)


def upload_path(path: Column) -> Column:
    """The file, or the folder of part files, that is the upload: the path up to its last component."""
    return F.regexp_replace(path, "/part-[^/]*$", "")


def file_extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))


def rejection(name: Column, size: Column) -> Column:
    """The first admission rule a file breaks, or NULL if it may be loaded."""
    return (
        F.when(~file_extension(name).isin(ADMITTED_EXTENSIONS), "extension")
        .when(size > MAX_FILE_BYTES, "size")
        .when(~name.rlike(SAFE_NAME), "characters")
        .when(~name.rlike(UPLOAD_NAME), "pattern")
        .when(~name.rlike(MONTH_IN_NAME), "month")
    )


def literal_path(path: str) -> str:
    """A path as readers take it, with the characters of their patterns escaped."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Files under ``folder``, or under several, recursively; contents are not read and empty files are passed over.

    The part files of one upload share its ``file_name``, and ``file_size`` is the size of
    all of them, so that all or none are admitted. ``file_path`` is spelled
    as in :func:`read_lines`; ``path`` and ``upload`` are as readers take them.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    )
    name = upload_name(F.col("path"))
    parts = Window.partitionBy(upload_path(F.col("path")))
    return listing.select(
        "_metadata.file_path",
        name.alias("file_name"),
        "path",
        upload_path(F.col("path")).alias("upload"),
        F.sum("length").over(parts).alias("file_size"),
        file_extension(name).alias("extension"),
        F.col("modificationTime").alias("modified"),
    )


def stream_files(spark: SparkSession, folder: str, max_bytes: int | None, max_files: int) -> DataFrame:
    """Paths of files as they appear under ``folder``; the checkpoint of a query remembers them.

    A batch has at most ``max_files`` files and, if given, about ``max_bytes``. Contents are not read.
    """
    reader = spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", "true")
    reader = reader.option("maxFileAge", _ANY_AGE)
    # A source takes one of the two limits; a file has at least one byte, or costs nothing.
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    return reader.option(*limit).load(folder).select("path")


def admit_files(files: DataFrame) -> DataFrame:
    """Each file with its verdict: ``admitted`` and the ``reason`` if it is not."""
    reason = rejection(F.col("file_name"), F.col("file_size"))
    return files.withColumn("reason", reason).withColumn("admitted", F.col("reason").isNull())


def drop_seen_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose name is not in ``seen``.

    No broadcast hint: the log of seen names grows with the data, so Spark picks
    the join from its measured size.
    """
    return files.join(seen.select("file_name"), "file_name", "left_anti")


def read_lines(
    spark: SparkSession,
    paths: str | list[str],
    streaming: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """Raw lines with the name, path and size of the upload they come from.

    A stream may bound each batch to about ``max_bytes`` of files.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming:
        reader = reader.option("maxFileAge", _ANY_AGE)
    if streaming and max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    text = reader.format("text").option("recursiveFileLookup", "true").load(paths)
    path = F.col("_metadata.file_path")
    return text.select(
        "value",
        upload_name(path).alias("file_name"),
        path.alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def admitted_lines(lines: DataFrame) -> DataFrame:
    """Lines of admitted files only.

    The rules use nothing but file metadata, so Spark applies them to the file
    listing and never opens a file that fails. They are also tested on every line,
    so they come down to one pattern and one comparison here.
    """
    fits = F.col("file_size") <= MAX_FILE_BYTES
    return lines.filter(fits & F.col("file_name").rlike(ADMITTED_NAME))
