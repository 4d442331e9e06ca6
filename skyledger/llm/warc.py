"""WARC archives with an index that is written first, and reads by coalesced byte ranges.

Each row of a table of pages becomes one record, a gzip member of its own, so any record can be
read alone by its offset and length. The first written copy of a payload is a response record,
the others are revisit records without payload that name it. The index has file, offset, length,
URL and digest per record. A read takes selected rows of the index, sorts them by offset,
unites neighbours to ranges and reads each range at once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.files import SharedFolder
from skyledger.llm.shared import materialize, scratch_path

# An archive is closed at this many bytes.
ARCHIVE_BYTES = 1 << 26

# Records this near to each other are read together, up to so many bytes.
GAP = 1 << 14
RANGE_BYTES = 1 << 22

DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "file string, offset long, length long, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
RECORDS = "file string, offset long, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_first_copy(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` and ``first_id``, the largest page_id with an equal payload.

    Payloads are compared by SHA-256 and length. Only that key and the id are aggregated, on the
    map side first; the join back visits every page once, and adaptive execution splits a
    payload that very many pages have.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumns({"key": F.unhex(F.sha2("html", 256)), "bytes": F.octet_length("html")})
    copies = rows.groupBy("key", "bytes").agg(F.max("page_id").alias("first_id"))
    return rows.join(copies, ["key", "bytes"]).select("page_id", "url", "html", "first_id")


def _record(kind: str, url: str, page_id: int | None, block: bytes, payload_digest: str, size: int, refers_to: int | None) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Bytes: {size}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page: {refers_to}",
        ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + block + b"\r\n\r\n"


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one gzip member."""
    content = gzip.decompress(member)
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _one_line(url: str | None) -> str:
    return "" if url is None else " ".join(url.split())


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) and return the index, already written.

    Line breaks in a URL become spaces and a null one is empty; a null html is an empty payload.
    A file is written whole before its index rows are given out. The index is a table in the
    shared folder, so nothing is written twice when it is read again.
    """
    rows = with_first_copy(pages).withColumn("task", F.spark_partition_id())
    rows = rows.withColumns({"no_id": F.col("page_id").isNull(), "page_id": F.coalesce("page_id", F.lit(0))})
    rows = rows.withColumns({"no_first": F.col("first_id").isNull(), "first_id": F.coalesce("first_id", F.lit(0))})

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held, index, offset = SharedFolder(folder), [], [], 0
        name = f"{uuid.uuid4().hex}.warc.gz"

        def close() -> pd.DataFrame:
            out.write(name, b"".join(held))
            frame = pd.DataFrame(index, columns=[c.split()[0] for c in INDEX.split(", ")])
            return frame.astype({"page_id": "Int64", "refers_to": "Int64"})

        for frame in frames:
            columns = (frame[c] for c in ("page_id", "no_id", "url", "html", "first_id", "no_first"))
            for page_id, no_id, url, html, first_id, no_first in zip(*columns, strict=True):
                payload = html.encode("utf-8", "replace")
                known = not no_first and (no_id or page_id != first_id)
                kind = "revisit" if known else "response"
                own, url = None if no_id else page_id, _one_line(url)
                refers_to = first_id if known else None
                sha = digest(payload)
                record = _record(kind, url, own, b"" if known else payload, sha, len(payload), refers_to)
                member = gzip.compress(record, 1, mtime=0)
                index.append((name, offset, len(member), own, url, len(payload), sha, kind, refers_to))
                held.append(member)
                offset += len(member)
                if offset >= ARCHIVE_BYTES:
                    yield close()
                    held, index, offset, name = [], [], 0, f"{uuid.uuid4().hex}.warc.gz"
        if held:
            yield close()

    return materialize(rows.drop("task").mapInPandas(write, INDEX), "warc-index")


def byte_ranges(index: DataFrame, gap: int = GAP, most: int = RANGE_BYTES) -> DataFrame:
    """``file, start, end, records`` (offset and length of each) that cover the rows of ``index``.

    A range ends where the next record is more than ``gap`` bytes away or beyond the next
    multiple of ``most`` in its file. An archive is of bounded size, so no file is a hot key.
    """
    by_offset = Window.partitionBy("file").orderBy("offset")
    before = F.lag(F.struct((F.col("offset") + F.col("length")).alias("end"), F.floor(F.col("offset") / most).alias("part")))
    rows = index.select("file", "offset", "length").distinct().withColumn("last", before.over(by_offset))
    breaks = (
        F.col("last").isNull()
        | (F.col("offset") - F.col("last.end") > gap)
        | (F.floor(F.col("offset") / most) != F.col("last.part"))
    )
    rows = rows.withColumn("range", F.sum(breaks.cast("int")).over(by_offset))
    return rows.groupBy("file", "range").agg(
        F.min("offset").alias("start"),
        F.max(F.col("offset") + F.col("length")).alias("end"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` selects, read back from the archives of ``folder``; see RECORDS.

    Sizes, digests and types come from the records. The payload of a revisit is empty here; its
    record names the page that has it. A response whose payload does not have its digest raises.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = SharedFolder(folder)
        for frame in frames:
            for name, start, end, records in zip(*(frame[c] for c in ("file", "start", "end", "records")), strict=True):
                content = source.read(name, int(start), int(end - start))
                rows = []
                for record in records:
                    at = int(record["offset"] - start)
                    headers, payload = parse_record(content[at : at + int(record["length"])])
                    kind, sha = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != sha:
                        raise ValueError(f"damaged record in {name} at {record['offset']}")
                    own, to = headers["X-Page-Id"], headers.get("X-Refers-To-Page")
                    rows.append(
                        (name, int(record["offset"]), int(own) if own else None, headers["WARC-Target-URI"], kind,
                         int(headers["X-Payload-Bytes"]), sha, None if to is None else int(to), payload)
                    )
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return byte_ranges(index).mapInPandas(read, RECORDS)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, then read every record back by the index.

    Of rows with equal payloads those with the largest page_id are response records, so a
    repeated row is a response each time; the others refer to it. Rows without id refer to the
    largest id among their copies, or are responses if no copy has one. A table without rows
    gives none.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder)
