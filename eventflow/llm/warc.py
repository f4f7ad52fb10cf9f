"""WARC archives: a writer with revisit records and a splittable reader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm.common import stored, utf8_column

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FLUSH = 4 << 20
RECORD = (
    "path string, offset long, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_length long, payload binary"
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; tasks reach the shared folder by it."""
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    return pafs.FileSystem.from_uri(path)


def _line(text: str) -> str:
    """A header value without control characters."""
    return quote(text, safe=";/?:@&=+$,-_.!~*'()#%[]") if re.search(r"[\x00-\x20\x7f]", text) else text


def encode_record(
    kind: str, record_id: str, uri: str | None, digest: str, payload: bytes, length: int,
    refers_to: str | None, date: str,
) -> bytes:
    """One gzip member with one record whose block is an HTTP response."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {length}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
    ]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_line(uri)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    return squeeze.compress(whole) + squeeze.flush()


def decode_records(data: bytes) -> list[dict] | None:
    """The records of one decompressed member; None if it is not made of whole records."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or data[at : at + 5] != b"WARC/":
            return None
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            return None
        block = data[end + 4 : end + 4 + int(fields["content-length"])]
        at = end + 4 + int(fields["content-length"]) + 4
        if len(data) < at:
            return None
        payload, length = block, len(block)
        if fields.get("content-type", "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
            said = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
            length = int(said[1]) if said else len(payload)
        out.append(fields | {"payload": payload, "length": length})
    return out


class RangeReader:
    """Records of one archive that start inside a byte range.

    Looks for gzip magic, and takes a place as a member only if it decodes to whole
    records; a magic inside compressed data fails that test. After a member the next one
    is expected at once; otherwise the search goes on. Damaged members are passed over.
    """

    def __init__(self, file, start: int, end: int, size: int, block: int = 1 << 18) -> None:
        self.file, self.start, self.end, self.size, self.block = file, start, end, size, block

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(max(0, min(n, self.size - at)))

    def _search(self, at: int) -> int | None:
        while at < self.end:
            got = self._read(at, min(self.block, self.end - at) + len(MAGIC) - 1)
            found = got.find(MAGIC)
            if 0 <= found and at + found < self.end:
                return at + found
            at += self.block
        return None

    def _member(self, at: int) -> tuple[list[dict], int] | None:
        inflate, parts, place = zlib.decompressobj(31), [], at
        try:
            while not inflate.eof:
                got = self._read(place, self.block)
                if not got:
                    return None
                place += len(got)
                parts.append(inflate.decompress(got))
                if len(parts) == 1 and not parts[0].startswith(b"WARC/"[: len(parts[0])]):
                    return None
        except zlib.error:
            return None
        records = decode_records(b"".join(parts))
        return None if not records else (records, place - len(inflate.unused_data))

    def __iter__(self) -> Iterator[tuple[int, dict]]:
        at = self._search(self.start)
        while at is not None and at < self.end:
            member = self._member(at)
            if member is None:
                at = self._search(at + 1)
                continue
            records, after = member
            for record in records:
                yield at, record
            at = after if self._read(after, 3) == MAGIC else self._search(after)


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    revisit_from: int = 100,
    date: str = "2000-01-01T00:00:00Z",
) -> int:
    """Write one record per row, a gzip member each, to ``path``/part-*.warc.gz.

    Of rows with equal payloads of ``revisit_from`` bytes or more, those with the least id
    become responses, the others revisits of it; shorter ones are all responses. A null
    payload is empty, a null id stays empty in the record id and is never a first one, a
    null URL leaves the header out; equal rows give equal records. Other columns are
    ignored. A task writes its file under another name and renames it, so a task that runs
    again replaces its own file. Returns the number of records; an empty table writes none.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    firsts = stored(
        rows.where(F.octet_length("payload") >= revisit_from).groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL").select("digest", "first"),
        "warc-firsts",
    )
    planned = rows.join(firsts, "digest", "left").select(
        "id", "url", "payload", "digest",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first"),
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, folder = _open(path)
        name = f"part-{task.partitionId():06d}.warc.gz"
        own = f"{folder}/.{name}.{task.taskAttemptId()}"
        out, n = None, 0
        for batch in batches:
            data, offsets = utf8_column(batch.column("payload"))
            columns = (batch.column(c).to_pylist() for c in ("id", "url", "digest", "first"))
            for i, (page, url, digest, first) in enumerate(zip(*columns)):
                if out is None:
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(own, compression=None)
                payload = data[offsets[i] : offsets[i + 1]].tobytes()
                out.write(
                    encode_record(
                        "response" if first is None else "revisit",
                        f"urn:page:{'' if page is None else page}", url, digest,
                        payload if first is None else b"", len(payload), f"urn:page:{first}", date,
                    )
                )
                n += 1
        if out is not None:
            out.close()
            fs.move(own, f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    fs, folder = _open(path)
    fs.create_dir(folder, recursive=True)  # also when there is no record
    return planned.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def read_warc(spark: SparkSession, path: str, *, split_bytes: int = 8 << 20) -> DataFrame:
    """All records of ``path``/*.warc.gz; files are cut into ranges of ``split_bytes``.

    A task owns the records that start inside its range and reads the last one to its end.
    Columns: path, offset of the member, record_type, record_id and refers_to (bare),
    target_uri, payload_digest, payload_length (as the record says) and payload (of
    revisits: empty). Absent headers are null; a folder without archives gives no rows.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
        .select("path", "length").where("length > 0")
    )
    ranges = files.select(
        "path", "length",
        F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start"),
    )
    names = [f.split()[0] for f in RECORD.split(", ")]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
            )

        for batch in batches:
            for row in batch.to_pylist():
                fs, place = _open(row["path"])
                rows, held = [], 0
                with fs.open_input_file(place) as file:
                    end = min(row["start"] + split_bytes, row["length"])
                    for offset, r in RangeReader(file, row["start"], end, row["length"]):
                        bare = lambda k: r[k].strip("<>") if k in r else None  # noqa: B023, E731
                        rows.append((
                            row["path"], offset, r.get("warc-type"), bare("warc-record-id"),
                            r.get("warc-target-uri"), bare("warc-refers-to"),
                            r.get("warc-payload-digest"), r["length"], r["payload"],
                        ))
                        held += len(r["payload"]) + 200
                        if held > FLUSH:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "path", "start").mapInArrow(read, RECORD)


def page_records(records: DataFrame) -> DataFrame:
    """One row per record with the full payload's size and digest, revisits resolved.

    Columns: page_id, payload_bytes, payload_digest (bare hex), record_type, refers_to
    (page of the response for revisits), target_uri. Responses are measured on the payload
    read; a revisit takes the values of the response it refers to that has its digest header.
    Without one any response of that page will do; without such a response they are null.
    """
    page = lambda c: F.expr(f"try_cast(nullif(substring({c}, 10), '') AS bigint)")
    meta = stored(
        records.select(
            page("record_id").alias("page_id"), "record_type", page("refers_to").alias("refers_to"),
            "target_uri", F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"), F.col("payload_digest").alias("said"),
        ),
        "warc-records",
    )
    first = meta.where("record_type = 'response'")
    again = meta.where("record_type = 'revisit'").select(
        "page_id", "record_type", "refers_to", "target_uri", F.coalesce("said", F.lit("")).alias("said"),
    )
    # Responses of one page id may hold different payloads; "" stands for any of them.
    said = F.coalesce("said", F.concat(F.lit("sha256:"), F.col("payload_digest")))
    known = stored(
        first.select(
            F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest",
            F.explode(F.array(said, F.lit(""))).alias("said"),
        )
        .join(again.select("refers_to", "said").distinct(), ["refers_to", "said"])
        .groupBy("refers_to", "said").agg(F.min(F.struct("payload_digest", "payload_bytes")).alias("one"))
        .select("refers_to", "said", "one.payload_digest", "one.payload_bytes"),
        "warc-known",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
    return first.select(*columns).union(again.join(known, ["refers_to", "said"], "left").select(*columns))
