"""Document sources: files, raw text, fetched web pages."""

from __future__ import annotations

import os
import shutil

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.schemas import DEFAULT_MIME, MIME_BY_EXTENSION

MAX_FILE_BYTES = 1 << 30
FOLDER_FILES = 4096
TASK_BYTES = 4 << 20


def file_id_of(content) -> Column:
    """Content address: equal bytes share one id."""
    return F.concat(F.lit(S.FILE_ID_PREFIX), F.sha2(S._c(content), 256))


def mime_type(file_name, declared=None) -> Column:
    """Declared type, else by extension, else the generic binary type."""
    table = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    ext = F.lower(F.regexp_extract(S._c(file_name), r"\.([A-Za-z0-9]+)$", 1))
    by_ext = F.try_element_at(table, ext)
    given = S.blank_to_null(declared) if declared is not None else F.lit(None).cast("string")
    return F.coalesce(given, by_ext, F.lit(DEFAULT_MIME))


def resolve_mime(files: DataFrame, declared: str | None = None) -> DataFrame:
    return files.withColumn("mime_type", mime_type("file_name", declared))


def check_size(files: DataFrame, limit: int = MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Split into accepted files and rejects with ``INVALID_FILE``."""
    too_big = F.col("file_size") > limit
    # A size nobody knows is not too big.
    ok = files.where(~F.coalesce(too_big, F.lit(False)))
    return ok, files.where(too_big).select("*", *_too_large(limit))


def _too_large(limit: int) -> list[Column]:
    return [
        F.lit("INVALID_FILE").alias("code"),
        F.concat(F.lit("file is larger than "), F.lit(limit), F.lit(" bytes")).alias("message"),
    ]


def _listing(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def _small_files_together(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Tasks of about ``TASK_BYTES`` where files are small: the scan counts 4 MB for opening one, so 32 would make a task."""
    size = int(str(listing._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files.coalesce(max(files.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES))


def _oversized(listing: DataFrame, limit: int) -> DataFrame:
    """Rejects from the listing's columns alone: the bytes of these files are not read."""
    return (
        listing.where(F.col("_metadata.file_size") > limit).select("file_name", F.col("length").alias("file_size"))
        .select("file_name", "file_size", mime_type("file_name").alias("mime_type"), *_too_large(limit))
    )


def ingest_files(
    spark: SparkSession, path: str, labels: dict[str, str] | None = None, limit: int = MAX_FILE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """A folder of files as catalog rows, and its oversized files as rejects.

    The folder is listed once and parted by the sizes of that listing, before
    tasks are planned: oversized files are never read, and no file is visited twice.
    """
    listing = _listing(spark, path)
    raw = listing.where(F.col("_metadata.file_size") <= limit)
    pairs = [F.lit(x) for kv in (labels or {}).items() for x in kv]
    label_col = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    files = (
        raw.withColumn("checksum_sha256", F.sha2("content", 256))
        .select(
            F.concat(F.lit(S.FILE_ID_PREFIX), F.col("checksum_sha256")).alias("file_id"),
            "file_name",
            mime_type("file_name").alias("mime_type"),
            F.col("length").alias("file_size"),
            "checksum_sha256",
            F.col("modificationTime").alias("created_at"),
            label_col.alias("labels"),
        )
    )
    return _small_files_together(files, listing), _small_files_together(_oversized(listing, limit), listing)


def write_files(texts: DataFrame, path: str, text_col: str = "text") -> None:
    """Every row's text, ended by a line break, as a ``.txt`` file of its own below a new folder.

    The counterpart of ``ingest_files``; NULL counts as empty.  On a ``file:``
    path Spark's writer starts processes that set rights for every file, so
    there each task writes its files itself, into a hidden folder of its
    attempt, renamed at the end: listings skip hidden folders, so a failed or
    repeated attempt adds no file.  Other stores go through Spark's writer,
    which ends the job at a million rows in one task.
    """
    spark = texts.sparkSession
    lines = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("value"))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    if uri.getScheme() != "file":
        lines.write.option("maxRecordsPerFile", 1).text(path)
        return
    root = uri.getPath()
    os.makedirs(root)

    def run(batches):
        task, n = TaskContext.get(), 0
        mine, done = f"{root}/_{task.taskAttemptId()}", f"{root}/part-{task.partitionId():05d}"
        for batch in batches:
            for body in batch.column(0):
                if n % FOLDER_FILES == 0:
                    folder = f"{mine}/{n // FOLDER_FILES:05d}"
                    os.makedirs(folder)
                with open(f"{folder}/{n:08d}.txt", "wb") as out:
                    out.write(body.as_buffer())
                n += 1
        if n:
            try:
                os.rename(mine, done)
            except OSError:
                # An earlier attempt may have ended; its files are the same.
                if not os.path.isdir(done):
                    raise
                shutil.rmtree(mine)
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    ended = F.concat("value", F.lit("\n")).cast("binary").alias("body")
    lines.select(ended).mapInArrow(run, "files long").agg(F.sum("files")).collect()


TEXT_TYPES = ("text/plain", "text/markdown", "text/x-markdown", "text/html", "text/csv", "text/xml")


def read_documents(spark: SparkSession, path: str, limit: int = MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Files with their text, ready for a job; other types and oversized files are rejects.

    A type that is not text is rejected on its name alone, and an oversized
    file on its length, before their bytes are read.
    """
    listing = _listing(spark, path)
    raw = listing.where(F.col("_metadata.file_size") <= limit).withColumn("mime_type", mime_type("file_name"))
    readable = F.col("mime_type").isin(*TEXT_TYPES)
    docs = raw.where(readable).select(
        file_id_of("content").alias("file_id"), "file_name", "mime_type",
        # Broken bytes become replacement characters instead of failing the job.
        F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
    )
    rejects = raw.where(~readable).select(
        "file_name", "mime_type", F.lit("INVALID_MIME_TYPE").alias("code"), F.lit("no text reader for this type").alias("message")
    )
    large = _oversized(listing, limit).select("file_name", "mime_type", "code", "message")
    return docs, rejects.unionByName(large)


def from_raw_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Raw text without an upload: checksum, content id and size in bytes."""
    return (
        df.withColumn("checksum_sha256", F.sha2(text_col, 256))
        .withColumn("file_id", F.concat(F.lit(S.FILE_ID_PREFIX), F.col("checksum_sha256")))
        .withColumn("file_size", F.octet_length(text_col).cast("bigint"))
    )


def from_web_pages(requests: DataFrame, web: DataFrame) -> DataFrame:
    """URL requests joined with already fetched pages ``(url, html)``.

    ``html`` is NULL for a URL nobody fetched.  Requests repeat URLs, so the
    join carries the page text once per request; adaptive execution splits the
    requests of a hot URL.
    """
    return requests.join(web.select(F.col("url").alias("file_url"), "html"), "file_url", "left")


def dedup_files(files: DataFrame) -> DataFrame:
    """One catalog row per content: earliest name, first time seen, copies.

    A plain aggregate: copies collapse before the shuffle, however many there are.
    """
    return files.groupBy("file_id").agg(
        F.min_by("file_name", F.struct("created_at", "file_name")).alias("file_name"),
        F.min("created_at").alias("created_at"),
        F.count(F.lit(1)).alias("copies"),
    )


def duplicate_report(files: DataFrame) -> DataFrame:
    """How many contents exist in how many copies."""
    return (
        files.groupBy("file_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("copies")
        .agg(F.count(F.lit(1)).alias("contents"), F.sum("copies").alias("files"))
    )
