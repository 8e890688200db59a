"""WARC archives with a two-level capture index.

Records are written as gzip members, one per page, into archives in the shared
folder.  The capture index is sorted by reversed-host URL keys and cut into
compressed blocks; a sparse directory holds the first key of every block and,
above it, of every segment of blocks.  A lookup binary-searches the directory,
opens one block and reads byte ranges of the archives.

Every task attempt writes an archive of its own name; only archives named in the
committed index are ever read, so lost executors and repeated attempts leave
nothing behind that counts.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docspark.llm.common import bounded_broadcast, materialise, shared_base

BLOCK_LINES = 1024
# The upper level of the directory is broadcast: at most this many segments.
SEGMENTS = 16384
# A new archive is begun beyond this size.
ARCHIVE_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.org:80/x?q#f`` becomes ``org,a)/x?q``; null is empty, unreadable URLs sort as they are."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or ""), u.port
    except ValueError:
        host = ""
    key = url
    if host:
        host = host.removeprefix("www.")
        port = f":{port}" if port and port != {"http": 80, "https": 443}.get(u.scheme) else ""
        key = f"{','.join(reversed(host.split('.')))}{port}){(u.path or '/').lower()}{'?' + u.query.lower() if u.query else ''}"
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m.group()):02X}", key)  # blanks end fields and lines of the index


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
           refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but its length and digest."""
    clean = lambda u: "".join(c for c in (u or "urn:none") if c > " " and c != "\x7f") or "urn:none"
    body = b"" if revisit else payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Header fields and body of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its header says")
    return fields | {"body": rest[:size]}


def _open_fs(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _number(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return int(value) if value else None


# ---- writing -------------------------------------------------------------


def resolve_duplicates(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, keep_id, response): of equal payloads the largest page_id is the response.

    Payloads below ``min_bytes`` are responses all.  Null page ids are smallest;
    of rows with equal page id and payload one is the response.  The narrow table
    of digests is grouped first; payloads move once, to meet their response's id.
    """
    hashed = pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    keep = hashed.groupBy("digest").agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    # Rows that share the page id of the response too: the first of an order decides.
    same = hashed.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("same"))
    info = materialise(keep.join(
        same.withColumnRenamed("digest", "d2"),
        (F.col("digest") == F.col("d2")) & F.col("keep_id").eqNullSafe(F.col("page_id")), "left",
    ).select("digest", "keep_id", "copies", "same").where("copies > 1"))
    # Only payloads that occur twice have a row; beyond the bound payloads are shuffled to meet it.
    joined = hashed.join(bounded_broadcast(info, 128), "digest", "left")
    single = F.col("copies").isNull() | (F.octet_length("payload") < min_bytes)
    is_keep = F.col("page_id").eqNullSafe(F.col("keep_id"))
    plain = joined.where(single | ~is_keep | (F.col("same") == 1)).select(
        "page_id", "url", "payload", "digest", F.when(~single, F.col("keep_id")).alias("keep_id"), (single | is_keep).alias("response")
    )
    # Repeated page ids: number them inside (digest, page id), which only ties reach.
    tied = bounded_broadcast(materialise(info.where("same > 1")), 128)
    ties = hashed.join(tied, "digest").where(is_keep & (F.octet_length("payload") >= min_bytes)).withColumn(
        "n", F.row_number().over(Window.partitionBy("digest", "page_id").orderBy(F.coalesce("url", F.lit(""))))
    ).select("page_id", "url", "payload", "digest", "keep_id", (F.col("n") == 1).alias("response"))
    return plain.unionByName(ties)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write one gzip member per record into archives below ``folder``; returns the captures, written once.

    Captures: url_key, page_id, file, offset, length, digest.
    """
    def run(batches):
        store, root = _open_fs(folder)
        out, name, at = None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, payload, keep_id, response in zip(
                *(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "keep_id", "response"))
            ):
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"archive-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                digest = digest32(payload)
                member = gzip.compress(record(page_id, url, payload, digest, keep_id, not response), 6, mtime=0)
                out.write(member)
                rows.append((url_key(url), page_id, name, at, len(member), digest))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("url_key", "page_id", "file", "offset", "length", "digest"), r)) for r in rows],
                    schema=pa.schema([("url_key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                                      ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string())]))
        if out is not None:
            out.close()

    spark = records.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return materialise(records.mapInArrow(
        run, "url_key string, page_id long, file string, offset long, length long, digest string"
    ))


# ---- index ---------------------------------------------------------------


class CaptureIndex:
    """Compressed blocks of sorted captures with a sparse two-level directory."""

    def __init__(self, blocks: DataFrame, folder: str, segments: int = SEGMENTS):
        self.blocks, self.folder = blocks, folder
        # Upper level: the first key of every k-th block, at most ``segments`` of them.
        n = blocks.count()
        step = max(1, -(-n // segments))
        directory = blocks.select("part", "block", "first_key")
        per_part = {r.part: r.n for r in blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
        before, total = {}, 0
        for part in sorted(per_part):
            before[part], total = total, total + per_part[part]
        spark = blocks.sparkSession
        self._starts = spark.createDataFrame(list(before.items()) or [(0, 0)], "part int, before long")
        placed = directory.join(F.broadcast(self._starts), "part").withColumn("at", F.col("before") + F.col("block"))
        top = placed.where(F.col("at") % step == 0).orderBy("at").select("first_key").collect()  # <= segments rows
        self.top = [r.first_key for r in top]
        self.step = step

    @staticmethod
    def build(captures: DataFrame, folder: str, lines: int = BLOCK_LINES, segments: int = SEGMENTS) -> "CaptureIndex":
        """Sort captures by (url key, page id) over range partitions and pack them into blocks.

        ``page_id`` is part of the key, so one URL with a third of all captures
        still spreads over many partitions and blocks.
        """
        n = max(1, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        ordered = captures.withColumn("key", index_key(F.col("url_key"), F.col("page_id"))).repartitionByRange(n, "key", "offset", "file").sortWithinPartitions("key", "offset", "file")

        def pack(batches):
            from pyspark import TaskContext

            part, block, held = TaskContext.get().partitionId(), 0, []

            def out(rows, block):
                text = "\n".join("\t".join(map(str, r)) for r in rows).encode()
                return {"part": part, "block": block, "first_key": rows[0][0], "last_key": rows[-1][0], "n": len(rows),
                        "packed": zlib.compress(text, 6)}

            done = []
            for b in batches:
                held += list(zip(b["key"], b["file"], b["offset"], b["length"], b["digest"]))
                while len(held) >= lines:
                    done.append(out(held[:lines], block))
                    held, block = held[lines:], block + 1
                if done:
                    yield pd.DataFrame(done)
                    done = []
            if held:
                yield pd.DataFrame([out(held, block)])

        blocks = ordered.select("key", "file", "offset", "length", "digest").mapInPandas(
            pack, "part int, block int, first_key string, last_key string, n int, packed binary"
        )
        return CaptureIndex(materialise(blocks), folder, segments)

    @staticmethod
    def unpack(packed: bytes) -> list[tuple]:
        rows = (line.split("\t") for line in zlib.decompress(packed).decode().split("\n"))
        return [(k, f, int(o), int(n), d) for k, f, o, n, d in rows]

    def captures(self, keys: DataFrame) -> DataFrame:
        """Captures (key, file, offset, length, digest) whose index key is in ``keys`` (column ``key``).

        Upper directory: binary search in the first keys of the segments, which
        every task holds.  Lower directory: binary search over the first keys of
        one segment's blocks.  Then binary search inside the blocks hit; other
        blocks are not opened.
        """
        top, step = self.top, self.step

        def between(edges: list[str], k: str) -> range:
            # Equal keys may fill several neighbours: begin before the first equal edge.
            return range(max(0, bisect_left(edges, k) - 1), bisect_right(edges, k))

        @F.pandas_udf("array<long>")
        def segments(key: pd.Series) -> pd.Series:
            return pd.Series([list(between(top, k)) for k in key])

        blocks = self.blocks.join(F.broadcast(self._starts), "part").withColumn("at", F.col("before") + F.col("block"))
        directory = blocks.select(F.floor(F.col("at") / step).cast("long").alias("segment"), "at", "first_key")
        wanted = keys.select("key").distinct().withColumn("segment", F.explode(segments("key")))

        def locate(asked: pd.DataFrame, level: pd.DataFrame) -> pd.DataFrame:
            level = level.sort_values("at")
            edges, at = level["first_key"].tolist(), level["at"].tolist()
            return pd.DataFrame([(k, at[i]) for k in asked["key"] for i in between(edges, k)], columns=["key", "at"])

        hits = wanted.groupBy("segment").cogroup(directory.groupBy("segment")).applyInPandas(locate, "key string, at long")
        asked = hits.groupBy("at").agg(F.sort_array(F.collect_set("key")).alias("asked"))
        unpack = CaptureIndex.unpack

        def search(batches):
            for b in batches:
                out = []
                for packed, asked in zip(b["packed"], b["asked"]):
                    rows = unpack(packed)
                    names = [r[0] for r in rows]
                    for k in asked:
                        out += rows[bisect_left(names, k): bisect_right(names, k)]
                if out:
                    yield pd.DataFrame(out, columns=["key", "file", "offset", "length", "digest"])

        return blocks.select("at", "packed").join(asked, "at").mapInPandas(
            search, "key string, file string, offset long, length long, digest string"
        )

    def read(self, captures: DataFrame) -> DataFrame:
        """Range reads of the captures' records: page_id, payload_bytes, payload_digest, record_type, refers_to, body."""
        folder = self.folder

        def run(batches):
            store, root = _open_fs(folder)
            name, source = None, None
            for b in batches:
                out = []
                for file, offset, length, digest in zip(b["file"], b["offset"], b["length"], b["digest"]):
                    if file != name:
                        if source is not None:
                            source.close()
                        name, source = file, store.open_input_file(f"{root}/{file}")
                    r = parse(gzip.decompress(source.read_at(length, offset)))
                    kind, stated = r["WARC-Type"], r["WARC-Payload-Digest"].removeprefix("sha1:")
                    if stated != digest or kind == "response" and digest32(r["body"]) != digest:
                        raise ValueError(f"{file} at {offset}: the payload does not have the indexed digest")
                    out.append((_number(r["WARC-Record-ID"]), r["WARC-Target-URI"], int(r["WARC-Payload-Length"]), stated, kind,
                                _number(r["WARC-Refers-To"]) if kind == "revisit" else None, r["body"]))
                frame = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "body"])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
            if source is not None:
                source.close()

        n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        near = captures.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
        return near.mapInPandas(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                     "record_type string, refers_to long, body binary")


@F.pandas_udf(StringType())
def _keys(url: pd.Series) -> pd.Series:
    return url.map(url_key)


def index_key(url_key_column, page_id) -> Column:
    """Key of a capture in the index: URL key, then page id."""
    return F.concat(url_key_column, F.lit(" "), F.format_string("%020d", F.coalesce(page_id, F.lit(0).cast("long"))))


def archive(pages: DataFrame, min_bytes: int = 0, lines: int = BLOCK_LINES, segments: int = SEGMENTS) -> CaptureIndex:
    """Write ``pages`` (page_id, url, html) as WARC records and index them.

    A null html is an empty payload, a null url an empty key, a null page id is
    written as none; repeated rows are records of their own; other columns are
    not read.  An empty table gives an empty index.
    """
    folder = f"{shared_base(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    captures = write_archives(resolve_duplicates(pages, min_bytes), folder)
    return CaptureIndex.build(captures, folder, lines, segments)


def fetch(index: CaptureIndex, wanted: DataFrame) -> DataFrame:
    """Records of the (url, page_id) rows of ``wanted``, found through the index."""
    keys = wanted.select(index_key(_keys("url"), F.col("page_id")).alias("key"))
    return index.read(index.captures(keys))
