"""WARC archives: one gzip member a record, written by Spark's text sink, and a reader that salvages damaged files.

The sink puts an empty gzip member between records, as its line separator, so every file is a plain sequence of members.
The reader checks each record (length, end mark, block digest, payload digest). Where a check fails it looks for the next
member or version line that holds a valid record, goes on from there, and reports the bytes between as a gap. It does so
inside a member too, and of a damaged member it keeps the records that come out before the damage.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.common import map_rows, text_or_empty
from kgspark.session import scratch_root

#: Fixed values of the formats.
MEMBER, VERSION, END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" + "0300" + "00000000" * 2)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NEXT = re.compile(re.escape(MEMBER) + b"|" + re.escape(VERSION))
CHUNK = 1 << 15


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of 40 hex digits: five of them are four signs."""
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or, with ``refers_to``, a revisit record: its HTTP headers still tell the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)] if refers_to is not None else []), ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + END


def member(data: bytes, level: int = 5) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_roles(pages: DataFrame, id_col: str, url_col: str, payload_col: str, at_least: int = 0) -> DataFrame:
    """Beside each page, in ``first``, the id that it revisits (null: it is a response)."""
    payload = text_or_empty(payload_col)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha1(F.encode(payload, "UTF-8")).alias("digest"))
    firsts = rows.filter(F.octet_length("payload") >= at_least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    found = rows.join(firsts, "digest", "left")
    return found.select("id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", at_least: int = 0, records_per_file: int = 2048) -> None:
    """Write a record per row to ``folder``, as files of at most ``records_per_file`` records.

    Of rows with equal payloads of at least ``at_least`` bytes the one with the smallest id is a response and the others
    revisit it. Null payloads are empty, null addresses about:blank. A row without an id revisits the smallest id of its
    group, or is a response if there is none; rows that repeat the smallest id are responses. Other columns are ignored.
    """

    def rows():
        return lambda b: {"value": [member(record(i, u, p.encode("utf-8", "surrogatepass"), f)) for i, u, p, f in zip(b["id"], b["url"], b["payload"], b["first"], strict=True)]}

    packed = map_rows(with_roles(pages, id_col, url_col, payload_col, at_least), rows, "value binary")
    text = packed.select(F.col("value").cast("string").alias("value"))  # bytes stay as they are
    text.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("maxRecordsPerFile", records_per_file).text(folder)


def _unpacked(data: memoryview, at: int, most: int | None = None) -> tuple[bytes, int, bool]:
    """The content of the gzip member at ``at``, where it ends, and whether it is whole.

    Of a damaged member it is what comes out before the damage. With ``most``, reading ends at the first byte of the file
    by which so many bytes have come out. Only the stretch where reading ends early is read byte by byte.
    """
    reader, out, n, end, step = zlib.decompressobj(31), [], 0, at, CHUNK
    while not reader.eof and end < len(data) and (most is None or n < most):
        kept = reader.copy() if step > 1 and (most is not None or end > at) else None
        try:
            got = reader.decompress(data[end : end + step])
        except zlib.error:
            got = None
        if step > 1 and (got is None or (most is not None and n + len(got) >= most)):
            reader, step = kept or zlib.decompressobj(31), 1
            continue
        if got is None:
            return b"".join(out), end, False
        out.append(got)
        n += len(got)
        end = min(end + step, len(data))
    return b"".join(out), end - len(reader.unused_data), reader.eof


def parse_record(raw: bytes | memoryview, at: int = 0) -> tuple[dict, bytes, int] | str:
    """Header fields (lower-case names), block and end of the record at ``at``; or what is wrong with it."""
    raw = memoryview(raw)
    if bytes(raw[at : at + len(VERSION)]) != VERSION:
        return "no version line"
    window = 1 << 12
    while (head_end := bytes(raw[at : at + window]).find(END)) < 0:
        if at + window >= len(raw) or window > 1 << 20:
            return "headers do not end"
        window *= 4
    lines = bytes(raw[at : at + head_end]).decode("utf-8", "replace").split("\r\n")[1:]
    fields: dict[str, str] = {k.strip().lower(): v.strip() for k, colon, v in (line.partition(":") for line in lines) if colon}
    if not {"warc-type", "warc-record-id", "warc-date"} <= fields.keys():
        return "a named field is missing"
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        return "no content length"
    start = at + head_end + len(END)
    end = start + int(fields["content-length"])
    if end + len(END) > len(raw):
        return "cut short"
    if bytes(raw[end : end + len(END)]) != END:
        return "no end mark"
    block = bytes(raw[start:end])
    if (want := fields.get("warc-block-digest", "").removeprefix("sha1:")) and want != base32_sha1(block):
        return "block digest differs"
    if fields.get("warc-type") == "response" and (want := fields.get("warc-payload-digest", "").removeprefix("sha1:")) and want != base32_sha1(block.partition(END)[2]):
        return "payload digest differs"
    return fields, block, end + len(END)


def _records(raw: bytes) -> Iterator[tuple[int, str | None, dict, bytes]]:
    """The records of a member's content and the gaps between them: where each ends, reason, header fields, block."""
    at, why = 0, None
    while 0 <= at < len(raw):
        one = parse_record(raw, at)
        if isinstance(one, str):
            why = why or one
            at = raw.find(VERSION, at + 1)
            continue
        if why is not None:
            yield at, why, {}, b""
            why = None
        at = one[2]
        yield at, None, *one[:2]
    if why is not None:
        yield len(raw), why, {}, b""


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    """All of a file, in order: offset, length, reason (None for a good record), header fields, block.

    What lies in a member, a record or a gap between records, has the place of the member; of a damaged member that is the
    part up to its last good record, and what follows is searched for the next member or version line. The record that reaches
    up to the damage, if only the check sum is hurt, is lost with it.
    """
    view, at, size = memoryview(data), 0, len(data)
    gap, why = None, ""

    def read(p: int):
        """What lies at ``p`` (reason, fields, block), where it ends, and what is wrong from there on (None: nothing)."""
        if bytes(view[p : p + 3]) != MEMBER:
            one = parse_record(view, p)
            return ([], p, one) if isinstance(one, str) else ([(None, *one[:2])], one[2], None)
        raw, end, whole = _unpacked(view, p)
        found = list(_records(raw))
        if whole:
            return [x[1:] for x in found], end, None
        while found and (found[-1][1] is not None or found[-1][0] == len(raw)):
            found.pop()
        return [x[1:] for x in found], _unpacked(view, p, found[-1][0])[1] if found else p, "damaged member"

    while at < size:
        found, end, wrong = read(at)
        if gap is not None and end > at:
            if at > gap:
                yield gap, at - gap, why, {}, b""
            gap = None
        for reason, fields, block in found:
            yield at, end - at, reason, fields, block
        if wrong is None:
            at = end
            continue
        if gap is None:
            gap, why = end, wrong
        after = NEXT.search(data, max(end, at + 1))
        at = after.start() if after else size
    if gap is not None and gap < size:
        yield gap, size - gap, why, {}, b""


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives in ``folder``: files are read whole, so keep them of moderate size.

    Columns: ``path``, ``offset``, ``length`` (bytes in the file), ``reason`` (null for records; for gaps what the first
    failed check was), ``record_type``, ``record_id``, ``refers_to``, ``target_uri``, ``payload_digest`` (bare base32),
    ``payload_bytes`` (of a revisit: as its HTTP headers tell) and, if asked for, ``payload`` (null for revisits).
    An empty folder has no rows; an empty file none either.
    """

    def rows():
        def apply(batch):
            out = {k: [] for k in ("path", "offset", "length", "reason", "record_type", "record_id", "refers_to", "target_uri", "payload_digest", "payload_bytes", "payload")}
            for path, data in zip(batch["path"], batch["content"], strict=True):
                for offset, length, reason, fields, block in salvage(data):
                    http, _, payload = block.partition(END)
                    revisit = fields.get("warc-type") == "revisit"
                    told = re.search(rb"(?i)\r\ncontent-length:\s*([0-9]+)", http)
                    row = (
                        path, offset, length, reason, fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri"),
                        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, None if reason else int(told[1]) if revisit and told else len(payload),
                        payload if with_payload and not revisit and reason is None else None,
                    )
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
            return out if with_payload else {k: v for k, v in out.items() if k != "payload"}

        return apply

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    schema = "path string, offset long, length long, reason string, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes long"
    return map_rows(files.select("path", "content"), rows, schema + (", payload binary" if with_payload else ""))


def page_id(urn: str | Column) -> Column:
    """The id in a record name written here; null where there is none."""
    return F.regexp_extract(F.col(urn) if isinstance(urn, str) else urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def scratch_archives(spark: SparkSession) -> str:
    """A new folder for archives below the shared scratch folder."""
    return f"{scratch_root(spark)}/kgspark/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
