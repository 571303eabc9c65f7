"""Dictionary-compressed WARC archives (operator 6).

One Zstandard dictionary is built from a bounded sample of the records to be archived.  Every
file begins with a skippable frame that holds it, followed by one frame per record, so any
record can be read alone with nothing but its file's first frame.  Of pages with equal payloads of at
least ``min_bytes`` the one with the smallest id is archived in full; the others become revisit
records that name it and keep its HTTP header but no payload.

Equal payloads are found by their SHA-256 with partial minima, and only digests that repeat are
joined back, so neither a payload nor a common digest meets in one task.  Each task writes one file;
an index row names a run of records, and runs are read back in parallel.

Defined cases: null html is an empty payload; a null url is written empty; a page without id is
always a response and no revisit names it; rows with the same id and payload are all
responses; an empty table writes nothing; with too few records for a dictionary, files have no leading
frame; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import shared_files
from reelhouse.llm.chunks import shuffle_partitions, stage

# The skippable frame that carries a dictionary, and the revisit profile.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"   # pages carry no capture time

SAMPLE_RECORDS = 512
SAMPLE_BYTES = 65_536           # larger pages are not sampled
DICTIONARY_BYTES = 65_536
LEVEL = 3
RUN_RECORDS = 256               # records per index row


def payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, payload, digest)."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"),
                        F.encode(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), "UTF-8").alias("payload"))
    return rows.withColumn("digest", F.sha2("payload", 256))


def marked(rows: DataFrame, min_bytes: int) -> DataFrame:
    """``payloads`` with refers_to, the page whose payload a revisit repeats."""
    first = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter((F.col("n") > 1) & F.col("first").isNotNull()).drop("n"))
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def build_dictionary(rows: DataFrame, sample_records: int = SAMPLE_RECORDS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``sample_records`` pages of no more than SAMPLE_BYTES, drawn by
    the hash of their ids (so bounded in number and in bytes); empty if they are too few."""
    share = max(1, rows.count() // sample_records)
    drawn = F.xxhash64("page_id", "digest")
    sample = (rows.filter(F.pmod(drawn, F.lit(share)) == 0)
              .filter(F.octet_length("payload").between(1, SAMPLE_BYTES))
              .select("page_id", "url", "payload", "digest").orderBy(drawn).limit(sample_records).collect())
    records = [record(r["page_id"], r["url"], bytes(r["payload"]), r["digest"], None) for r in sample]
    if sum(map(len, records)) < 8 * 1024 or len(records) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, records)) // 8), records, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of page ``refers_to``."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record does not end where its header says")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def leading_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""


def read_dictionary(uri: str) -> tuple[bytes, int]:
    """(dictionary, where the records begin) of an archive."""
    if shared_files.file_size(uri) < 8:
        return b"", 0
    magic, size = struct.unpack("<II", shared_files.read_range(uri, 0, 8))
    return (shared_files.read_range(uri, 8, size), 8 + size) if magic == DICTIONARY_FRAME else (b"", 0)


def records_in(data: bytes, dictionary: bytes) -> Iterator[bytes]:
    """The records of consecutive frames."""
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary \
        else zstandard.ZstdDecompressor()
    while data:
        frame = d.decompressobj()
        yield frame.decompress(data)
        if not frame.eof:
            raise ValueError("an archive ends inside a record")
        data = frame.unused_data


def write_archives(rows: DataFrame, dictionary: bytes, folder: str) -> DataFrame:
    """Write the marked pages, a file per task; an index row (path, place, size, records) per run."""
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("size", pa.int64()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.zst"
        made = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=True)
        index, at, begun, n = [], 0, 0, 0
        with shared_files.whole_file(path) as out:
            for batch in batches:
                for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    if not at:
                        head = leading_frame(dictionary)
                        out.write(head)
                        at = begun = len(head)
                    frame = press.compress(record(page_id, url, payload, digest, refers))
                    out.write(frame)
                    at, n = at + len(frame), n + 1
                    if n == RUN_RECORDS:
                        index.append((path, begun, at - begun, n))
                        begun, n = at, 0
        if n:
            index.append((path, begun, at - begun, n))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in index], f.type) for i, f in enumerate(schema)],
                                         schema=schema)

    # a fixed order, so that a second attempt of a task writes the same file
    ordered = rows.sortWithinPartitions("page_id", "digest", "url")
    return stage(ordered.mapInArrow(run, "path string, place long, size long, records long"), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) per record.  A
    response's size and digest are those of the payload read; a digest that differs from its
    header raises.  A revisit has no payload, its size and digest are its headers'."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to", pa.int64())])

    def number(text):
        return None if text is None else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["path"] not in known:
                    known = {r["path"]: read_dictionary(r["path"])[0]}
                out = []
                for data in records_in(shared_files.read_range(r["path"], r["place"], r["size"]), known[r["path"]]):
                    fields, http, payload = parse(data)
                    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
                    full = fields["WARC-Type"] == "response"
                    if full and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{r['path']}: a payload is not the one archived")
                    out.append((number(fields.get("X-Page-ID")), fields["WARC-Target-URI"], fields["WARC-Type"],
                                payload if full else None, size, digest, number(fields.get("X-Refers-To-Page-ID"))))
                if len(out) != r["records"]:
                    raise ValueError(f"{r['path']}: records are missing")
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    # runs are few and small rows: dealt round to the tasks
    return index.repartition(shuffle_partitions(index.sparkSession)).mapInArrow(
        run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
             "refers_to long")


def archive(pages: DataFrame, folder: str, min_bytes: int = 100, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Write ``pages`` to ``folder`` and return the index of what was written."""
    rows = payloads(pages, id_col, url_col, html_col)
    return write_archives(marked(rows, min_bytes), build_dictionary(rows), folder)
