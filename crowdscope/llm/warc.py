"""Web archives: capture records in WARC files, and an external merge of their
locally sorted indexes into one globally ordered capture history."""

from __future__ import annotations

import hashlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import land, text_column
from crowdscope.session import scratch_path

#: Record bytes of one archive, which is one sorted run and one read unit.
ARCHIVE_BYTES = 8 << 20
#: Smallest payload whose copies become revisits.
REVISIT_BYTES = 100
#: Index rows that one merge task handles on average.
RANGE_ROWS = 100_000
#: Two line ends close a record.
CLOSE = "\r\n\r\n"

INDEX = "url_key string, captured_at long, page_id long, archive string, record_offset long, record_length long, " \
        "payload_bytes long, payload_digest string"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then path and query.
    Scheme, fragment, user and port are left out, the host is lower-cased."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").split(".")
    except ValueError:
        return url
    return f"{','.join(reversed(host))}){parts.path}" + (f"?{parts.query}" if parts.query else "")


def record(page_id: int | None, url: str | None, captured: str, payload: bytes) -> bytes:
    """One WARC record, without the line ends that close it."""
    uri = "".join(c for c in url or "" if c >= " ")
    name = "null" if page_id is None else page_id
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Date: {captured}\r\n"
            f"WARC-Target-URI: {uri}\r\nWARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\n"
            f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n")
    return head.encode() + payload


def records(data: bytes):
    """(offset, length, header fields, payload) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        stop = end + int(fields["Content-Length"])
        yield at, stop - at, fields, data[end:stop]
        at = stop + 4


def write_archives(pages: DataFrame, out_dir: str, captured_at: Column, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per row, as archives of about ``archive_bytes``, each
    sorted by URL key, capture time and page id. Spark's text writer puts the
    files in place, so a repeated task never leaves half an archive."""

    def run(batches):
        number, held, size = 0, [], 0
        task = None

        def emit():
            held.sort(key=lambda r: r[:3])
            cols = ([f"{task:06d}-{number:06d}"] * len(held), list(range(len(held))), [r[3] for r in held])
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                               pa.array(cols[2], pa.binary()).cast(pa.string())],
                                              names=["archive", "place", "value"])

        for batch in batches:
            for row in range(batch.num_rows):
                page, url, html, when, date, part = (batch.column(k)[row].as_py() for k in range(6))
                task = part
                body = record(page, url, date, (html or "").encode())
                held.append((url_key(url), when, -1 if page is None else page, body))
                size += len(body)
                if size >= archive_bytes:
                    yield emit()
                    number, held, size = number + 1, [], 0
        if held:
            yield emit()

    when = captured_at.cast("long")
    date = F.date_format(F.timestamp_seconds(when), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text_column(pages, "html"),
                        when, date, F.spark_partition_id())
    made = rows.mapInArrow(run, "archive string, place long, value string")
    (made.sortWithinPartitions("archive", "place").select("value", "archive")
     .write.partitionBy("archive").option("lineSep", CLOSE).text(out_dir))


def read_index(spark, archive_dir: str) -> DataFrame:
    """One index row per record, from the archives alone; payload length and
    digest are those of the bytes read, which must match the record's own."""

    def run(batches):
        from datetime import datetime
        for batch in batches:
            for row in range(batch.num_rows):
                path, data = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                cols = [[] for _ in range(8)]
                for at, length, fields, payload in records(data):
                    digest = hashlib.sha256(payload).hexdigest()
                    if fields["WARC-Payload-Digest"] != f"sha256:{digest}":
                        raise ValueError(f"{path}: payload at byte {at} is damaged")
                    page = fields["WARC-Record-ID"][len("<urn:page:"):-1]
                    when = datetime.fromisoformat(fields["WARC-Date"].replace("Z", "+00:00"))
                    values = (url_key(fields["WARC-Target-URI"]), int(when.timestamp()),
                              None if page == "null" else int(page), path, at, length, len(payload), digest)
                    for c, v in zip(cols, values):
                        c.append(v)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 3, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=[x.split()[0] for x in INDEX.split(", ")])

    files = spark.read.format("binaryFile").load(archive_dir)
    return files.select(F.regexp_extract("path", "archive=([^/]+)", 1).alias("archive"), "content").mapInArrow(run, INDEX)


class LoserTree:
    """k-way merge of sorted runs: each inner node keeps the loser of its match,
    so the next row costs one walk from a leaf to the root."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, leaf: int) -> None:
        """Walk up from a leaf; while the tree fills, an empty node stops the walk."""
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k and self.heads[self.losers[0]] is not None:
            run = self.losers[0]
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self._play(run)


def merge_index(index: DataFrame, ranges: int) -> DataFrame:
    """Merge all runs (one per archive) into one order by URL key, capture time
    and page id; adds ``capture_no``, the row's place in it, from 0.

    Key ranges are dealt to tasks, a URL's long history over several; a task
    merges its slices of the runs with a loser tree. ``index`` must be landed.
    """
    names = index.columns
    key = [names.index(c) for c in ("url_key", "captured_at", "page_id")]
    run_at = names.index("archive")

    def run(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                page = row[key[2]]
                runs.setdefault(row[run_at], []).append(
                    ((row[key[0]], row[key[1]], page is not None, page or 0), len(runs), row))
        for r in runs.values():
            r.sort(key=lambda x: x[0])  # a shuffle may hand over a run's blocks in any order
        merged = (x[-1] for x in LoserTree([[(k, i, row) for i, (k, _, row) in enumerate(r)] for r in runs.values()]))
        held = []
        at = 0
        for row in merged:
            held.append((*row, at))
            at += 1
            if len(held) == 10_000:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    kinds = [T.StructField(f.name, f.dataType) for f in index.schema]
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = [*(to_arrow_type(f.dataType) for f in kinds), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), arrow)], names=[*names, "_at"])

    order = [F.col("url_key").asc(), F.col("captured_at").asc(), F.col("page_id").asc_nulls_first()]
    merged = (index.repartitionByRange(ranges, *order)
              .mapInArrow(run, T.StructType([*kinds, T.StructField("_at", T.LongType())]))
              .withColumn("_range", F.spark_partition_id()))
    merged = land(merged, "merged-index")
    sizes = sorted(tuple(r) for r in merged.groupBy("_range").count().collect())  # one row a range
    firsts, total = [], 0
    for r, n in sizes:
        firsts.append((r, total))
        total += n
    offsets = index.sparkSession.createDataFrame(firsts or [(-1, 0)], "_range int, _first long")
    return (merged.join(F.broadcast(offsets), "_range")
            .withColumn("capture_no", F.col("_first") + F.col("_at")).drop("_range", "_first", "_at"))


def capture_history(pages: DataFrame, captured_at: Column, archive_dir: str | None = None,
                    archive_bytes: int = ARCHIVE_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Archive every page, read the archives back and return the merged index.

    Adds to the index columns ``record_type``, ``refers_to`` and
    ``capture_no``. Of records with equal payloads of at least 100 bytes the
    one with the smallest page_id is the response, the others revisit it.

    Defined cases: a null html is an empty payload; a null url has the empty
    key and sorts first; of rows that repeat the smallest page_id all are
    responses; a record without page_id revisits the smallest id and is a
    response if no id exists; an empty table gives no rows; other columns are
    not archived.
    """
    spark = pages.sparkSession
    path = archive_dir or scratch_path(spark, "archives")
    write_archives(pages, path, captured_at, archive_bytes)
    if not spark.read.format("binaryFile").load(path).select("path").head(1):
        index = spark.createDataFrame([], INDEX)
    else:
        index = land(read_index(spark, path), "capture-index")
    copies = (index.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
              .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    typed = (index.join(copies, "payload_digest", "left")
             .withColumn("record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
             .withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_first"))
    ranges = max(1, -(-index.count() // range_rows))
    return merge_index(typed, ranges)
