"""WARC archives and their capture index by external merge.

Writing: every row becomes one record; of records with equal payloads the one with the smallest id is
the response and the others are revisits that refer to it. Records are written by Spark's
text writer, whose line separator is the record separator of the format.

Reading: each archive file is parsed by one task into a run of index entries, sorted by URL key and
timestamp. Splitters taken from the runs cut the key space into ranges of bounded size; each
range's slices of all runs are merged by a loser tree, giving globally ordered capture histories.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import lookup_join
from ..session import pin, scratch_path
from .common import width

VERSION = "WARC/1.1"
FILE_BYTES = 24 << 20  # payload bytes aimed at for an archive file
RANGE_ROWS = 100_000  # index entries aimed at for a merge task
EPOCH = 1_700_000_000  # capture time of page 0 where a table has none
SPAN = 250_000_000_000  # seconds after which capture times by page start again, so that years have four digits for any id
ENTRY = ("file string, run bigint, urlkey string, ts bigint, page_id bigint, record_type string, payload_bytes bigint, "
         "payload_digest string, refers_to bigint, at bigint, size bigint, good boolean")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_column(payload: Column) -> Column:
    @F.pandas_udf("string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda p: digest(p.encode("utf-8", "surrogatepass")))

    return digests(payload)


def url_key(url: str) -> str:
    """Host labels reversed and comma-joined, ``)``, then the rest, in lower case; without scheme and ``www.``."""
    rest = url.split("://", 1)[-1].split("#", 1)[0].lower()
    host, slash, tail = rest.partition("/")
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + slash + tail if url else ""


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            ts: Column | None = None, least: int = 0) -> DataFrame:
    """One row a record: (page_id, url, payload, ts, payload_bytes, payload_digest, refers_to)."""
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
        (ts if ts is not None else F.lit(EPOCH) + F.pmod(F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)), F.lit(SPAN))).cast("bigint").alias("ts"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", digest_column(F.col("payload")))
    ids = pin(rows.select("page_id", "payload_bytes", "payload_digest"), "warc-ids")  # no payloads
    first = (ids.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # Only payloads that repeat can be revisited: that table is broadcast behind a check of its size, so
    # payloads do not move for it; beyond the limit it is a shuffle join.
    rows = lookup_join(rows, first, ["payload_digest", "payload_bytes"], label="warc-first")
    return rows.withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first"))).drop("first")


def record_text(id_: Column, url: Column, payload: Column, ts: Column, size: Column, digest_: Column, refers_to: Column) -> Column:
    """Header and block of a record; the writer's line separator ends it."""
    revisit = refers_to.isNotNull()
    target = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "%", "%25"), r"\r", "%0D"), r"\n", "%0A")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    return F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", target), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest_)),
        line("X-Payload-Length", size.cast("string")), F.lit("Content-Type: text/html\r\n"),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers_to.cast("string"), F.lit(">"))))).otherwise(""),
        line("Content-Length", F.when(revisit, "0").otherwise(size.cast("string"))), F.lit("\r\n"),
        F.when(revisit, "").otherwise(payload))


def write(recs: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Archive files (gzip) of about ``file_bytes`` of payload under ``folder``; a larger record has its file's task alone."""
    total = recs.agg(F.sum("payload_bytes")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    text = record_text(*(F.col(c) for c in ("page_id", "url", "payload", "ts", "payload_bytes", "payload_digest", "refers_to")))
    (recs.select(text.alias("value")).repartition(files).write.mode("overwrite")
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder))


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, size) of an archive's records; offsets in the uncompressed file."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        first, *lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if first != VERSION:
            raise ValueError(f"no record at {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        block = raw[end + 4:end + 4 + size]
        if raw[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} has a wrong length")
        yield headers, block, at, end + 8 + size - at
        at = end + 8 + size


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index entries (ENTRY) of all archives under ``folder``: a run for each file, sorted by URL key, timestamp and page.

    A response's length and digest are those of the block as read, a revisit's those that its header states.
    ``good``: a response's block has the length and digest that its header states, a revisit has no block.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                raw = gzip.GzipFile(fileobj=io.BytesIO(content)).read()
                entries = []
                for h, block, at, size in parse(raw):
                    url = h["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    when = datetime.strptime(h["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
                    stated = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = h["WARC-Type"] == "revisit"
                    length, sha = stated if revisit else (len(block), digest(block))
                    good = not block if revisit else (length, sha) == stated
                    entries.append((name, 0, url_key(url), int(when.timestamp()), _page(h["WARC-Record-ID"]), h["WARC-Type"],
                                    length, sha, _page(h.get("WARC-Refers-To")), at, size, good))
                entries.sort(key=lambda e: (e[2], e[3], -1 if e[4] is None else e[4], e[9]))
                frame = pd.DataFrame(entries, columns=[c.split()[0] for c in ENTRY.split(", ")])
                frame["run"] = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=7).digest())
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    # one file a batch: a task holds one archive at a time
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(min(64 << 20, 2 * FILE_BYTES)))
    return files.mapInPandas(run, ENTRY)


class LoserTree:
    """Merges sorted iterators: inner nodes hold the loser of their match, and a new item plays its way up once."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.items = [next(r, None) for r in runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        """Run ``a``'s item comes before ``b``'s; exhausted runs come last, equal items by run."""
        x, y = self.items[a], self.items[b]
        if x is None or y is None:
            return x is not None
        kx, ky = self.key(x), self.key(y)
        return kx < ky or (kx == ky and a < b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # still being built: wait here for an opponent
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            run = self.losers[0]
            if self.items[run] is None:
                return
            yield self.items[run]
            self.items[run] = next(self.runs[run], None)
            self._play(run)


def merge_index(entries: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``entries`` in global order: with ``range`` and ``place`` (position in the range); ordered by (range, place).

    Spark's range partitioning picks the splitters, which only balance the ranges; the key ends in the
    page id and position, so a hot URL is cut as well.
    """
    spark = entries.sparkSession
    entries = pin(entries, "warc-runs")
    order = ["urlkey", "ts", "page_id", "file", "at"]
    n = entries.count()
    ranges = max(1, -(-n // range_rows), min(width(spark), n // 1000))
    ranged = entries.repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in order])
    ranged = ranged.withColumn("range", F.spark_partition_id()).sortWithinPartitions("run", *[F.col(c).asc_nulls_first() for c in order])
    names = [c.split()[0] for c in ENTRY.split(", ")]

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs: dict[int, list[tuple]] = {}
        number = None
        for batch in batches:  # about range_rows entries in all
            for row in zip(*(batch[c].astype(object).where(batch[c].notna(), None) for c in names)):
                runs.setdefault(row[1], []).append(row)
            number = int(batch["range"].iloc[0]) if len(batch) else number
        out, place = [], 0
        tree = LoserTree([iter(r) for r in runs.values()], lambda e: (e[2], e[3], -1 if e[4] is None else e[4], e[0], e[9]))
        for e in tree:
            out.append((*e, number, place))
            place += 1
            if len(out) == 20_000:
                yield pd.DataFrame(out, columns=[*names, "range", "place"]).astype({"page_id": "Int64", "refers_to": "Int64"})
                out = []
        yield pd.DataFrame(out, columns=[*names, "range", "place"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    return ranged.mapInPandas(merge, f"{ENTRY}, range int, place bigint")


def report(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of an index; fails at a record that is not ``good``."""
    damaged = F.raise_error(F.concat(F.lit("damaged record in "), F.col("file"), F.lit(" at "), F.col("at").cast("string")))
    return index.select("page_id", "payload_bytes", F.when(F.col("good"), F.col("payload_digest")).otherwise(damaged).alias("payload_digest"),
                        "record_type", "refers_to")


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", least: int = 0) -> DataFrame:
    """Writes ``pages`` as archives under ``folder`` (a shared folder), reads them back and returns the merged index.

    Defined cases: a NULL payload is an empty one, a NULL url an empty one; payloads of at least
    ``least`` bytes take part in the revisits; rows that repeat the smallest page_id are all responses, and a
    NULL page_id is never the smallest; an empty table gives an empty archive and no rows; other columns
    are ignored; a payload of any length is one record.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write(records(pages, id_col, url_col, payload_col, least=least), folder)
    return merge_index(read_index(spark, folder))
