"""WARC archives with an index: written record by record, read by byte ranges.

Each task writes one archive and notes offset, length, URL and digest of every record it
writes. Reading starts from the index: the wanted records are sorted by place, ranges
that lie close together are joined to one read, and records are cut out of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import new_folder, saved
from tallybook.llm.token_files import open_store
from tallybook.operators.match import own_shuffle

#: Records with smaller payloads are written in full even if they are equal.
MIN_REVISIT = 0
#: Ranges with at most this many bytes between them are read at once, up to READ bytes.
GAP = 1 << 16
READ = 8 << 20
RECORD_ID = "urn:x-page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_of(payload: Column) -> Column:
    """SHA-1 in upper-case base32, of text in UTF-8."""
    udf = F.pandas_udf(
        lambda texts: texts.map(lambda t: payload_digest(t.encode("utf-8", "surrogatepass"))), "string"
    )
    return udf(payload)


def record(
    page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """One record in a gzip member of its own."""
    block = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{RECORD_ID}{'' if page is None else page}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # white space and control characters would end the line
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        fields.insert(1, ("WARC-Target-URI", safe))
    if revisit:
        fields += [("WARC-Profile", _PROFILE)]
        if refers_to is not None:
            fields += [("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    whole = head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    return gzip.compress(whole, 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, payload) of a record; the payload of a revisit is empty."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if payload_digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError("damaged WARC record")
    return fields, block.partition(b"\r\n\r\n")[2]


def decide(rows: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``rows`` (id, url, payload text) with digest, size, revisit and refers_to.

    Of equal payloads of at least ``min_revisit`` bytes the one with the least id is
    written, the others refer to it; several rows with that id are all written.
    Rows without an id refer to the least id, or are written if no row has one. The
    least id comes from partial minima, and a payload with very many rows is split over tasks.
    """
    rows = rows.select("*", digest_of(F.col("payload")).alias("digest"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long"))
    first = saved(rows.select("id", "digest"), "digests").groupBy("digest").agg(
        F.min("id").alias("first")
    )
    joined = own_shuffle(rows, "digest").join(own_shuffle(first, "digest"), "digest")
    own = F.coalesce(F.col("first").eqNullSafe(F.col("id")), F.lit(False))
    revisit = (F.col("size") >= min_revisit) & ~own & F.col("first").isNotNull()
    return joined.select(
        "id", "url", "payload", "digest", "size", revisit.alias("revisit"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


_INDEX = "file string, offset long, length long, id long, url string, digest string, revisit boolean"


def write_archives(decided: DataFrame, folder: str, date: datetime | None = None) -> DataFrame:
    """Writes one archive for each task; the index of its records, also in the shared folder.

    A repeated task writes an archive of a new name, and the index names only those of
    tasks that count.
    """
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        system, where = open_store(folder)
        sink, at = None, 0
        for b in batches:
            if sink is None:
                system.create_dir(where)
                # members are compressed one by one, so the stream must not be
                sink = system.open_output_stream(f"{where}/{name}", compression=None)
            offsets, lengths = [], []
            for r in b.itertuples(index=False):
                data = record(
                    _whole(r.id), r.url, r.payload.encode("utf-8", "surrogatepass"),
                    r.digest, _whole(r.refers_to), r.revisit, stamp,
                )
                sink.write(data)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            yield b[["id", "url", "digest", "revisit"]].assign(
                file=name, offset=offsets, length=lengths
            )[["file", "offset", "length", "id", "url", "digest", "revisit"]]
        if sink is not None:
            sink.close()

    return saved(decided.mapInPandas(write, _INDEX), "index")


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


def ranges(places: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list]]:
    """(file, begin, end, [(offset, length), ..]): reads that cover the places, in their order."""
    now: tuple[str, int, int, list] | None = None
    for file, offset, length in places:
        if now and file == now[0] and offset - now[2] <= GAP and offset + length - now[1] <= READ:
            now = file, now[1], max(now[2], offset + length), [*now[3], (offset, length)]
            continue
        if now:
            yield now
        now = file, offset, offset + length, [(offset, length)]
    if now:
        yield now


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, digest, size, payload) of the records in ``index``.

    ``index`` may be any selection of rows of a written index. size is null for revisits.
    Payloads are checked against their digest.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, where = open_store(folder)
        for b in batches:
            rows = []
            places = zip(b["file"], b["offset"], b["length"], strict=True)
            source, name = None, None
            for file, begin, end, members in ranges(places):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{where}/{file}")
                data = source.read_at(end - begin, begin)
                for offset, length in members:
                    fields, payload = parse(data[offset - begin : offset - begin + length])
                    rows.append(_row(fields, payload))
            if source is not None:
                source.close()
            yield pd.DataFrame(rows, columns=list(_COLUMNS))

    placed = index.select("file", "offset", "length").repartitionByRange("file", "offset")
    return placed.sortWithinPartitions("file", "offset").mapInPandas(
        read, ", ".join(f"{k} {v}" for k, v in _COLUMNS.items())
    )


_COLUMNS = {
    "page_id": "long",
    "url": "string",
    "record_type": "string",
    "refers_to": "long",
    "digest": "string",
    "size": "long",
    "payload": "binary",
}


def _row(fields: dict[str, str], payload: bytes) -> tuple:
    number = lambda v: int(v) if (v := (v or "").strip("<>").removeprefix(RECORD_ID)) else None
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError("damaged payload")
    return (
        number(fields["WARC-Record-ID"]),
        fields.get("WARC-Target-URI"),
        kind,
        number(fields.get("WARC-Refers-To")),
        digest,
        len(payload) if kind == "response" else None,
        payload if kind == "response" else None,
    )


def archive_report(
    df: DataFrame,
    folder: str | None = None,
    payload: str = "html",
    url: str = "url",
    key: str = "page_id",
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to), from archives in ``folder``.

    Null payloads are empty; null URLs are left out of their record; rows without a key
    and repeated rows have records of their own; an empty table gives no rows and no
    archive. The size of a revisit is that of the response it repeats.
    """
    folder = folder or new_folder(df.sparkSession, "archives")
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"),
    )
    index = write_archives(decide(rows, min_revisit), folder)
    read = saved(read_records(index, folder).drop("payload", "url"), "records")
    sizes = (
        read.where("record_type = 'response'").groupBy("digest").agg(F.max("size").alias("full_size"))
    )
    return own_shuffle(read, "digest").join(own_shuffle(sizes, "digest"), "digest").select(
        F.col("page_id").alias(key),
        F.col("full_size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
