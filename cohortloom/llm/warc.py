"""WARC archives and their revisit records.

Archives are written through Spark's text sink: a record is one value, and the line
separator is the pair of line breaks that ends every record. They are read back as
whole files, each of a bounded number of records, and cut by Content-Length. Both go
through Spark's file systems, so any store that Spark reaches will do.

Resolution works on headers: payload digests are shuffled, the first record of each
digest is the original, and records that repeat it are joined to it. The rewriting
step meets each archive with its own decisions, by file, so payloads are shuffled
only compressed, and writes archives with fresh headers in which a repeated payload
is left out.

Defined cases: a null payload is empty. Rows with equal ids are records of their own;
with equal payloads too, the one read first is the original. Null ids come last and
are kept; where all records of a payload have one, the first is the original and the
others revisit it by its record id, with no page to name. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import salted_left_join
from cohortloom.sources.files import scratch_dir

END = "\r\n\r\n"
RECORDS_PER_FILE = 2000
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = (
    "path string, at long, page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to long, record_id string, refers_to_record string, date string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


class Original(NamedTuple):
    """What a revisit says of the record that it repeats."""

    record_id: str
    page_id: int | None
    url: str
    date: str


def record_id(path: str, at: int) -> str:
    """The id of the record that is written anew for the one at this place: the same in every attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{at}')}>"


def record(page_id, url, payload: str, digest: str, size: int, date: str, own_id: str, original: Original | None = None) -> str:
    """One record without its closing line breaks; with an original, a revisit of it and no payload."""
    fields = {
        "WARC-Type": "response" if original is None else "revisit",
        "WARC-Record-ID": own_id,
        "WARC-Date": date,
        "WARC-Target-URI": "" if url is None else url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-Id": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(size),
    }
    if original is not None:
        fields |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": original.record_id,
            "WARC-Refers-To-Target-URI": original.url,
            "WARC-Refers-To-Date": original.date,
            "X-Refers-To-Page": "" if original.page_id is None else str(original.page_id),
        }
    body, length = (payload, size) if original is None else ("", 0)
    fields |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(length)}
    return "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields.items()), "", body])


def parse(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, header fields, payload) of each record of an uncompressed archive."""
    at, view = 0, memoryview(content)
    while at < len(content):
        head = content.index(END.encode(), at)
        lines = content[at:head].decode().split("\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = head + len(END)
        size = int(fields["Content-Length"])
        yield at, fields, bytes(view[start : start + size])
        at = start + size + len(END)


def write_archives(records: DataFrame, path: str) -> None:
    """Write a column of records as compressed archives of at most RECORDS_PER_FILE records."""
    sink = records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    sink.text(path)


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def to_records(pages: DataFrame, now: datetime) -> DataFrame:
    """A response record for each (page_id, url, html), dated `now`."""
    date = f"{now:%Y-%m-%dT%H:%M:%SZ}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page_id, url, html in zip(frame["page_id"], frame["url"], frame["html"], strict=True):
                payload = html.encode("utf-8")
                known = None if page_id is None else int(page_id)
                out.append(record(known, url, html, base32_sha1(payload), len(payload), date, f"<urn:uuid:{uuid.uuid4()}>"))
            yield pd.DataFrame({"value": out})

    # As text, ids keep their nulls through pandas.
    narrow = pages.select(F.col("page_id").cast("string"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return narrow.mapInPandas(run, "value string")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the archives below a path, by its header fields alone."""
    number = lambda x: int(x) if x else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                rows = [
                    (
                        file, at, number(f["X-Page-Id"]), f["WARC-Target-URI"], f["WARC-Type"],
                        f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["X-Payload-Length"]), number(f.get("X-Refers-To-Page")),
                        f["WARC-Record-ID"], f.get("WARC-Refers-To"), f["WARC-Date"],
                    )
                    for at, f, _ in parse(gunzip(content))
                ]
                columns = [c.split()[0] for c in HEADERS.split(", ")]
                if rows:
                    yield pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})

    return archives(spark, path).mapInPandas(run, HEADERS)


def gunzip(content: bytes) -> bytes:
    import gzip

    return gzip.decompress(content)


def resolve(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(path, at, first): every record that repeats an earlier payload of at least `min_bytes`, with that record's place and page.

    A digest may hold a third of all records: originals come from a combinable minimum,
    and are joined back over several tasks a digest.
    """
    long = heads.filter(F.col("payload_bytes") >= min_bytes)
    key = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "path", "at", "url", "date")
    groups = long.groupBy("payload_digest", "payload_bytes").agg(F.min(key).alias("first"), F.count("*").alias("n"))
    originals = groups.filter("n > 1").select("payload_digest", "payload_bytes", "first")
    joined = salted_left_join(long.select("path", "at", "payload_digest", "payload_bytes"), originals, ["payload_digest", "payload_bytes"])
    again = F.col("first").isNotNull() & ~((F.col("path") == F.col("first.path")) & (F.col("at") == F.col("first.at")))
    return joined.filter(again).select("path", "at", "first")


def rewrite(spark: SparkSession, source: str, target: str, repeats: DataFrame) -> None:
    """Write the archives anew with fresh headers; records named in `repeats` become revisits without payload."""
    # A file has at most RECORDS_PER_FILE records, which bounds its list.
    # The page may be null, so its being an original's is said by the struct around it.
    first = F.struct(F.col("first.page_id").cast("string").alias("page_id"), "first.path", "first.at", "first.url", "first.date").alias("first")
    by_file = repeats.groupBy("path").agg(F.collect_list(F.struct("at", first)).alias("repeats"))
    work = archives(spark, source).join(by_file, "path", "left")

    def originals(found) -> dict[int, Original]:
        firsts = {} if found is None else {x["at"]: x["first"] for x in found}
        return {
            at: Original(record_id(x["path"], x["at"]), None if x["page_id"] is None else int(x["page_id"]), x["url"] or "", x["date"])
            for at, x in firsts.items()
        }

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content, found in zip(frame["path"], frame["content"], frame["repeats"], strict=True):
                original, out = originals(found), []
                for at, f, payload in parse(gunzip(content)):
                    digest, size = f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["X-Payload-Length"])
                    own = (f["X-Page-Id"] or None, f["WARC-Target-URI"], payload.decode(), digest, size, f["WARC-Date"], record_id(path, at))
                    out.append(record(*own, original.get(at)))
                if out:
                    yield pd.DataFrame({"value": out})

    write_archives(work.select("path", "content", "repeats").mapInPandas(run, "value string"), target)


def deduplicate(pages: DataFrame, min_bytes: int = 0, now: datetime | None = None) -> DataFrame:
    """Write pages as archives dated `now` (this moment unless given), resolve revisits, write deduplicated archives, and read these back: HEADERS."""
    spark = pages.sparkSession
    folder = scratch_dir(spark)
    raw, lean = f"{folder}/warc-raw", f"{folder}/warc-deduplicated"
    write_archives(to_records(pages, now or datetime.now(UTC)), raw)
    rewrite(spark, raw, lean, resolve(headers(spark, raw), min_bytes))
    return headers(spark, lean)
