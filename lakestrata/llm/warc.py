"""WARC archives: one gzip member per record, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import parted, saved

VERSION = b"WARC/1.1\r\n"
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# an empty member parts two records in a file; as text of one byte per character
_PART = gzip.compress(b"", mtime=0).decode("latin-1")
_PAGE = "urn:lakestrata:page:"
# members go to the writer in pieces of about so many bytes, and so many pieces make a file
_PIECE, _PIECES = 16 << 20, 4
_SALTS = 32
_CUT = "member is cut off"


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(page: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    revisit = first is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("Content-Type", "application/http; msgtype=response")]
    fields += [("WARC-Record-ID", f"<{_PAGE}{page}>")] if page is not None else []
    fields += [("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~"))] if url is not None else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{_PAGE}{first}>")] if revisit else []
    fields += [("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def _members(level: int, size: int):
    """Runs of gzip members of ``size`` bytes or one record more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held = [], 0

        def taken() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(piece)], pa.binary())], ["members"])

        for batch in batches:
            for page, url, html, first in zip(*batch.columns, strict=True):
                record = _record(page.as_py(), url.as_py(), (html.as_py() or "").encode(), first.as_py())
                piece.append(gzip.compress(record, level, mtime=0))
                held += len(piece[-1])
                if held >= size:
                    yield taken()
                    piece, held = [], 0
        if piece:
            yield taken()

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    level: int = 4,
    piece_bytes: int = _PIECE,
) -> str:
    """Write one record per row as files of gzip members below ``folder``; returns the folder.

    A task starts a new file after about ``4 * piece_bytes``, so that no archive outgrows what one task reads.

    Of rows whose payloads are equal and have at least ``least`` bytes, that with the smallest id is a
    response and the others are revisits that refer to it; all smaller payloads are responses. Payloads whose
    digest occurs once are written where they are read; the others are joined with the smallest id of their digest,
    each digest salted, so that a body which a third of the pages share is spread over tasks and files.

    NULL payloads are empty. Rows that repeat the smallest id are responses too. A row with NULL id has no
    record id; where only such rows share a payload all are responses. A NULL url is left out. Other
    columns are not written. An empty table gives a folder without records.
    """
    html = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha")
    )
    repeated = saved(
        rows.where(F.octet_length("html") >= least)
        .groupBy("sha").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("sha").alias("sha_again"), "first"),
        "repeated",
    )
    shared, alone = parted(rows, F.col("sha"), repeated.select("sha_again"))
    shared = shared.withColumn("salt", F.pmod(F.xxhash64("page", "url"), F.lit(_SALTS)).cast("int"))
    spread = repeated.withColumn("salt_again", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    marked = shared.join(spread, (F.col("sha") == F.col("sha_again")) & (F.col("salt") == F.col("salt_again")), "left").select(
        "page", "url", "html", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("first")
    )
    marked = marked.unionByName(alone.select("page", "url", "html", F.lit(None).cast("long").alias("first")))
    # bytes as text of one byte per character go through the text writer unchanged
    members = marked.mapInArrow(_members(level, piece_bytes), "members binary").select(F.col("members").cast("string").alias("value"))
    members.write.option("lineSep", _PART).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", _PIECES).text(folder)
    return folder


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _checked(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at a place: fields, block, end. ValueError when a check fails."""
    if not data.startswith(b"WARC/1.", at):
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise ValueError("header does not end")
    fields = _fields(data[at:stop])
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no content length")
    start, end = stop + 4, stop + 4 + int(fields["content-length"])
    block = data[start:end]
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    if (said := fields.get("warc-block-digest", "")).startswith("sha1:") and said[5:] != digest(block):
        raise ValueError("block digest differs")
    return fields, block, end + 4


def _unpacked(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the member at a place gives, where it ends or fails, and why it fails (None: it is whole)."""
    # a view: the rest of the file is not copied for each member
    view, out, place, step = memoryview(data), [], at, 65536
    unpack = zlib.decompressobj(31)
    while not unpack.eof:
        if place >= len(data):
            return b"".join(out), len(data), _CUT
        before = unpack.copy() if step > 1 and place > at else None
        try:
            out.append(unpack.decompress(view[place : place + step]))
        except zlib.error as error:
            if step == 1:
                return b"".join(out), place, f"damaged member: {error}"
            # once more byte by byte from the last state that was good, so that nothing before the damage is lost
            unpack, step = before or zlib.decompressobj(31), 1
            continue
        place += step
    return b"".join(out), min(place, len(data)) - len(unpack.unused_data), None


def _next(data: bytes, at: int) -> int:
    """The next place after ``at`` where a member or a record may begin; the end if there is none."""
    return min((p for p in (data.find(_MAGIC, at + 1), data.find(b"WARC/1.", at + 1)) if p >= 0), default=len(data))


def _records(inner: bytes, failure: str | None) -> list[tuple]:
    """``kind, start, end, fields or reason, block`` of all bytes of an unpacked member: records that pass, gaps between them.

    Without the member's checksum a record passes by its block digest only, or where the member is just cut off.
    """
    out, at, bad, reason = [], 0, None, ""
    kind = "salvaged" if failure else "record"
    while at < len(inner):
        try:
            fields, block, end = _checked(inner, at)
            if failure not in (None, _CUT) and not fields.get("warc-block-digest", "").startswith("sha1:"):
                raise ValueError("neither checksum nor digest")
        except ValueError as error:
            if bad is None:
                bad, reason = at, str(error)
            at = inner.find(b"WARC/1.", at + 1)
            if at < 0:
                break
            continue
        if bad is not None:
            out.append(("gap", bad, at, reason, None))
            bad = None
        out.append((kind, at, end, fields, block))
        at = end
    if bad is not None:
        out.append(("gap", bad, len(inner), reason, None))
    return out


def salvage(data: bytes) -> Iterator[tuple]:
    """``kind, start, end, inner, what, block`` of each record and gap in file order.

    ``what`` is the dictionary of a record's fields or the reason of a gap. ``start`` and ``end`` are bytes of the file: those of a plain
    record, of a gap between members, or of the whole member for what lies inside one; ``inner`` is then the range in the
    unpacked member, else None. Every byte of the file belongs to one record, member or gap, and every byte of an
    unpacked member to one record or gap.

    After a failed check the next gzip member or version line that passes is searched for, in the file and
    inside a member; what lies before it is one gap with the first failure as its reason. A damaged member gives the
    records it holds before the damage, found in the same way, as kind ``salvaged``: their blocks are checked, but
    what their headers say is not, since only the member's checksum covers it. The member's range ends where unpacking failed or where the next
    good member or record begins, and the bytes between these two are a gap.
    """
    at, start, stop, found, reason = 0, None, 0, [], ""

    def closed(place: int) -> Iterator[tuple]:
        """What the open piece from ``start`` gives, and its gap up to ``place``."""
        if start is not None:
            end = min(stop, place)
            yield from ((kind, start, end, (a, z), what, block) for kind, a, z, what, block in found)
            if end < place:
                yield "gap", end, place, None, reason, None

    while at < len(data):
        if data.startswith(_MAGIC, at):
            inner, end, failure = _unpacked(data, at)
            held = _records(inner, failure)
            if failure is None:
                yield from closed(at)
                yield from ((kind, at, end, (a, z), what, block) for kind, a, z, what, block in held)
                at, start = end, None
                continue
            if any(kind == "salvaged" for kind, *_ in held):
                yield from closed(at)
                start, stop, found, reason = at, end, held, failure
        else:
            try:
                fields, block, end = _checked(data, at)
            except ValueError as error:
                failure = str(error)
            else:
                # a damaged member that was stored without compression shows the records it gave once more
                if start is not None and at < stop and any(f[0] == "salvaged" and f[4] == block for f in found):
                    at = _next(data, at)
                    continue
                yield from closed(at)
                yield "record", at, end, None, fields, block
                at, start = end, None
                continue
        if start is None:
            start, stop, found, reason = at, at, [], failure
        at = _next(data, at)
    yield from closed(len(data))


def _page(fields: dict[str, str], name: str) -> int | None:
    value = fields.get(name, "").strip("<>")
    number = value.removeprefix(_PAGE)
    return int(number) if number != value and number.lstrip("-").isdigit() else None


def _row(path: str, found: tuple) -> tuple:
    kind, start, end, inner, fields, block = found
    place = (kind, path, start, end, *(inner or (None, None)))
    if kind == "gap":
        return (*place, fields, *[None] * 7)
    http, _, payload = block.partition(b"\r\n\r\n")
    said = _fields(http).get("content-length", "")
    return (
        *place, None, _page(fields, "warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-type"),
        _page(fields, "warc-refers-to"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        int(said) if said.isdigit() else len(payload), payload,
    )


_SCHEMA = (
    "kind string, file string, start long, end long, inner_start long, inner_end long, reason string, page_id long, url string, record_type string, "
    "refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def _salvaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in _SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows, held = [], 0
            for found in salvage(content.as_py()):
                rows.append(_row(path, found))
                held += len(found[5] or b"")
                if len(rows) >= 1000 or held > 16 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every record and every gap of the archives below a folder, one row each (``kind``: record, salvaged or gap).

    One task reads one archive at a time, whole, and unpacks one member at a time (the writer's archives hold about
    64 MB, its members one record). An archive from elsewhere has to be below 2 GB, the most that Spark's reader
    takes. A damaged file never stops the job: see ``salvage``, which also tells what the columns of places mean. For records the payload
    is what the archive holds; ``payload_bytes`` and ``payload_digest`` are those of the full payload also for
    a revisit, which holds none. A folder without files gives no rows.
    """
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").load(folder)
    return files.select("path", "content").mapInArrow(_salvaged, _SCHEMA)
