"""WARC derivatives: each response yields a metadata record and a plain-text conversion record, linked to it.

A record is one binary value in WARC/1.1 form.  Derived records keep the response's target URI and date, refer to its
id (WARC-Refers-To, with its URI and date), and carry its HTTP headers and digests in the metadata block.  Record ids
are derived from what they identify, so a task that runs again writes the same bytes.

Records come from pages (``responses``) or from .warc and .warc.gz files (``read``), and go to .warc.gz files, a gzip
member for each record (``write``).  Header names are matched in any case; bodies that were sent in chunks or compressed
are decoded, and texts by the charset that the response names.

Null html counts as an empty body, a null url as an empty target; line breaks and control characters in a target are
percent-encoded; equal rows give equal records; records of other types have no derivatives; what is no record of version 1.0 or 1.1, or
cut short, has none either and an index row of type "", never an error, and the records after it in its file are read; a record without a
digest has a null digest_holds; texts of any length are converted whole; an empty table gives no records.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .markup import visible

DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_CHUNK = re.compile(rb"\s*([0-9a-fA-F]+)[^\r\n]*\r?\n")
#: Bytes that are read or inflated at a time; the longest line of a header; the largest file that travels as one row.
PIECE, LONGEST_LINE, WHOLE_FILE = 1 << 20, 1 << 16, 64 << 20
_LINK = re.compile(r"""<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)""", re.I)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + lines + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


class Headers:
    """Header fields in the order and spelling in which they were sent, repeated ones too; looked up in any case of letters."""

    def __init__(self, lines: list[bytes]):
        pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
        self.fields = [(k.strip(), v.strip()) for k, _, v in pairs]
        self._first: dict[str, str] = {}
        for k, v in self.fields:
            self._first.setdefault(k.lower(), v)

    def __getitem__(self, name: str) -> str:
        return self._first[name.lower()]

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._first

    def get(self, name: str, default=None):
        return self._first.get(name.lower(), default)

    def every(self, name: str) -> list[str]:
        """The values of all fields of that name."""
        return [v for k, v in self.fields if k.lower() == name.lower()]


class _Source:
    """Bytes that come in pieces, read by lines and lengths; a piece of None is where something was lost, over which nothing is read."""

    def __init__(self, pieces: Iterator[bytes | None]):
        self.pieces, self.buffer, self.at, self.lost, self.over = pieces, b"", 0, False, False

    def _more(self) -> bool:
        if self.lost or self.over:
            return False
        piece = next(self.pieces, b"")
        if piece is None:
            self.lost = True
            return False
        if not piece:
            self.over = True
            return False
        self.buffer, self.at = self.buffer[self.at :] + piece, 0
        return True

    def go_on(self) -> bool:
        """Past what was lost; whether there is anything left."""
        self.lost = False
        return self.at < len(self.buffer) or self._more() or (self.lost and self.go_on())

    def line(self) -> bytes:
        """The next line with its end; a line longer than LONGEST_LINE comes in parts."""
        start = 0
        while (end := self.buffer.find(b"\n", self.at + start)) < 0:
            start = len(self.buffer) - self.at
            if start >= LONGEST_LINE or not self._more():
                end = len(self.buffer) - 1
                break
        out = self.buffer[self.at : end + 1]
        self.at += len(out)
        return out

    def take(self, n: int) -> bytes:
        """The next n bytes, or as many as there are."""
        parts, need = [], n
        while need > 0:
            part = self.buffer[self.at : self.at + need]
            if not part and not self._more():
                break
            self.at += len(part)
            need -= len(part)
            parts.append(part)
        return b"".join(parts)


def _record(f: _Source, first: bytes) -> tuple[bytes, Headers, bytes]:
    """The head as it was sent, the headers and the block of the record whose first line has been read from f.

    A ValueError says what is wrong; what has been read of the record is its second argument.
    """
    head = [first]
    if first.strip() not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("not a record of this version", first)
    lines: list[bytes] = []
    while sent := f.line():
        head.append(sent)
        line = sent.rstrip(b"\r\n")
        if not line:
            break
        if line[:1] in b" \t" and lines:  # a folded line
            lines[-1] += b" " + line.strip()
        else:
            lines.append(line)
    headers, sent = Headers(lines), b"".join(head)
    length = headers.get("Content-Length", "")
    if not length.isascii() or not length.isdigit():
        raise ValueError("the record has no length", sent)
    block = f.take(int(length))
    if len(block) != int(length):
        raise ValueError("the record does not end where it says", sent + block)
    return sent, headers, block


def parse(data: bytes) -> tuple[Headers, bytes]:
    """Headers and block of one record."""
    f = _Source(iter([data]))
    _, headers, block = _record(f, f.line())
    if f.take(len(data)).strip(b"\r\n"):
        raise ValueError("the record does not end where it says", data)
    return headers, block


def _parsed(data: bytes) -> tuple[Headers, bytes] | None:
    try:
        return parse(data)
    except ValueError:
        return None


def inflated(pieces: Iterator[bytes]) -> Iterator[bytes | None]:
    """The contents of gzip members one after another, a piece at a time; None where a member cannot be read, after which the next
    one that can goes on."""
    data, member = b"", None
    for piece in pieces:
        data += piece
        while data:
            if member is None:
                start = data.find(b"\x1f\x8b")
                if start < 0:
                    data = data[-1:] if data.endswith(b"\x1f") else b""
                    break
                data, member = data[start:], zlib.decompressobj(31)
            try:
                out = member.decompress(data, PIECE)
            except zlib.error:
                # the member's first byte is skipped, or we would find it again
                data, member = data[1:], None
                yield None
                continue
            if out:
                yield out
            data = member.unused_data if member.eof else member.unconsumed_tail
            if member.eof:
                member = None
            elif not data:
                break
    if member is not None:
        yield None


def split(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a .warc or .warc.gz file, each with the bytes of its headers as they are.

    What cannot be read is one record of its own, up to the next line that begins one; the records after it come as well.
    """
    pieces = iter(pieces)
    first = b""
    while len(first) < 2 and (more := next(pieces, b"")):
        first += more
    every = chain([first], pieces) if first else iter(())
    f = _Source(inflated(every) if first[:2] == b"\x1f\x8b" else every)
    lost: list[bytes] = []
    held = 0
    while True:
        line = f.line()
        if not line:
            if lost:
                yield b"".join(lost)
                lost, held = [], 0
            if not f.go_on():
                return
            continue
        starts = line.startswith(b"WARC/")
        if lost and not starts and held < LONGEST_LINE:
            lost.append(line)
            held += len(line)
            continue
        if lost:
            yield b"".join(lost)
            lost, held = [], 0
        if not line.strip():
            continue
        if not starts:
            lost, held = [line], len(line)
            continue
        try:
            sent, _, block = _record(f, line)
            yield sent + block + b"\r\n\r\n"
        except ValueError as error:
            # its block may be cut short by the next record, which is looked for in what was read
            bad = error.args[1]
            at = bad.find(b"\nWARC/1.", 1)
            if at > 0:
                f.buffer, f.at = bad[at + 1 :] + f.buffer[f.at :], 0
                bad = bad[: at + 1]
            lost, held = [bad], len(bad)


def _chunks(body: bytes) -> bytes:
    """A chunked body in one piece; as it is where it is not in chunks."""
    parts, at = [], 0
    while (m := _CHUNK.match(body, at)) and int(m[1], 16):
        parts.append(body[m.end() : m.end() + int(m[1], 16)])
        at = m.end() + int(m[1], 16)
    return b"".join(parts) or body


def _decoded(kind: str, body: bytes) -> bytes | None:
    """A body without one content coding, all its members and as far as it can be read; null where the coding is not known."""
    if kind in ("gzip", "x-gzip"):
        return b"".join(x for x in inflated(iter([body])) if x)
    if kind == "zstd":
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(body), read_across_frames=True) as f:
            try:
                return f.read()
            except zstandard.ZstdError:
                return b""
    if kind == "deflate":
        for bits in (15, -15):
            try:
                return zlib.decompressobj(bits).decompress(body)
            except zlib.error:
                continue
        return body
    return None


def body_of(http: Headers, body: bytes) -> tuple[str, str]:
    """The text of a response's body, and the codings that could not be undone: chunks joined, decompressed in the order of all
    codings that were named, decoded, as far as it can be read; a body in an unknown coding has no text."""
    if "chunked" in ",".join(http.every("Transfer-Encoding")).lower():
        body = _chunks(body)
    kinds = [k.strip().lower() for v in http.every("Content-Encoding") for k in v.split(",")]
    kinds = [k for k in kinds if k not in ("", "identity", "none")]
    while kinds:
        plain = _decoded(kinds[-1], body)
        if plain is None:
            return "", ", ".join(kinds)
        # a body that is sent without the coding that it names is taken as it is
        body = plain or (body if not body.startswith(b"\x1f\x8b") else b"")
        kinds.pop()
    charset = re.search(r"charset=[\"']?([\w.:-]+)", http.get("Content-Type", ""), re.I)
    try:
        return body.decode(codecs.lookup(charset[1]).name if charset else "utf-8", "replace"), ""
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace"), ""


def response(page_id, url: str | None, page: str | None) -> bytes:
    body, uri = (page or "").encode(), _uri(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    payload = sha1(body)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", _id("response", str(page_id), uri, payload)), ("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    headers += [("WARC-Payload-Digest", payload), ("WARC-Block-Digest", sha1(http + body)), ("Content-Type", "application/http; msgtype=response")]
    return record(headers, http + body)


def derive(data: bytes) -> list[bytes]:
    """The metadata and conversion records of a response; none of other records."""
    headers, block = _parsed(data) or (Headers([]), b"")
    if headers.get("WARC-Type") != "response" or "WARC-Record-ID" not in headers:
        return []
    http, _, body = block.partition(b"\r\n\r\n")
    page, coded = body_of(Headers(http.split(b"\r\n")[1:]), body)
    source, uri, date = headers["WARC-Record-ID"], headers.get("WARC-Target-URI", ""), headers.get("WARC-Date", DATE)
    link = [("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date)]
    out, written = [], {}
    text = visible(page).encode()
    title = _TITLE.search(page)
    fields = [("source-" + k, headers[k]) for k in ("WARC-Payload-Digest", "WARC-Block-Digest", "Content-Length") if k in headers]
    fields += [("http-" + a, b) for a, _, b in (x.partition(": ") for x in http.decode("utf-8", "replace").split("\r\n")[1:])]
    fields += [("http-status", http.split(b"\r\n", 1)[0].decode("utf-8", "replace")), ("title", " ".join(title[1].split()) if title else "")]
    fields += [("undecoded", coded)] if coded else []
    fields += [("outlink", x) for x in _LINK.findall(page)]
    for kind, content, data in (("conversion", "text/plain; charset=utf-8", text), ("metadata", "application/warc-fields", None)):
        if kind == "metadata":
            data = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("conversion-record", written["conversion"])]).encode()
        written[kind] = _id(kind, source)
        named = [("WARC-Type", kind), ("WARC-Record-ID", written[kind]), ("WARC-Date", date), ("WARC-Target-URI", uri)]
        out.append(record([*named, *link, ("WARC-Block-Digest", sha1(data)), ("Content-Type", content)], data))
    return out


def responses(pages: DataFrame) -> DataFrame:
    """page_id and record (a WARC response) of pages (page_id, url, html)."""

    def work(batches):
        for pdf in batches:
            pdf["record"] = [response(*x) for x in zip(pdf["page_id"], pdf["url"], pdf["html"])]
            yield pdf[["page_id", "record"]].astype({"page_id": "Int64"})

    return pages.select("page_id", "url", "html").mapInPandas(work, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """page_id and record of each derived record; page_id only passes through."""

    def work(batches):
        for pdf in batches:
            rows = [(i, d) for i, r in zip(pdf["page_id"], pdf["record"]) for d in derive(r)]
            yield pd.DataFrame(rows, columns=["page_id", "record"]).astype({"page_id": "Int64"})

    return records.select("page_id", "record").mapInPandas(work, "page_id long, record binary")


FIELDS = {"type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To", "target_uri": "WARC-Target-URI", "block_digest": "WARC-Block-Digest", "content_type": "Content-Type"}


def index(records: DataFrame) -> DataFrame:
    """What each record says, read from its bytes: the named headers, its size, whether its digest holds, its digest."""

    def work(batches):
        for pdf in batches:
            rows = []
            for i, data in zip(pdf["page_id"], pdf["record"]):
                headers, block = _parsed(data) or (Headers([]), b"")
                holds = sha1(block) == headers["WARC-Block-Digest"] if "WARC-Block-Digest" in headers else None
                rows.append((i, *(headers.get(h, "") for h in FIELDS.values()), len(block), holds, hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(rows, columns=["page_id", *FIELDS, "n_bytes", "digest_holds", "record_sha256"]).astype({"page_id": "Int64", "digest_holds": "boolean"})

    return records.select("page_id", "record").mapInPandas(work, "page_id long, " + ", ".join(f"{k} string" for k in FIELDS) + ", n_bytes long, digest_holds boolean, record_sha256 string")


def linked(records: DataFrame) -> DataFrame:
    """The index of derived records."""
    return index(records).where(F.col("refers_to") != "")


def _frames(records: Iterator[bytes]) -> Iterator[pd.DataFrame]:
    """Records in frames of about PIECE bytes."""
    held, size = [], 0
    for one in records:
        held.append(one)
        size += len(one)
        if size >= PIECE:
            yield pd.DataFrame({"page_id": pd.array([None] * len(held), "Int64"), "record": held})
            held, size = [], 0
    if held:
        yield pd.DataFrame({"page_id": pd.array([None] * len(held), "Int64"), "record": held})


def read(spark: SparkSession, path: str, whole: int = WHOLE_FILE) -> DataFrame:
    """page_id (null) and record of every record in the .warc and .warc.gz files under a path that Spark reads.

    Files of up to whole bytes come through Spark; larger ones, which no row should hold, are streamed by pyarrow, which has to reach
    their file system.  Of either, a record and a piece of the file are in memory at a time.
    """

    def small_files(batches):
        for pdf in batches:
            for data in pdf["content"]:
                yield from _frames(split(iter([data])))

    def large_files(batches):
        from pyarrow import fs

        for pdf in batches:
            for path in pdf["path"]:
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_stream(at, compression=None) as f:
                    yield from _frames(split(iter(lambda: f.read(PIECE), b"")))

    schema = "page_id long, record binary"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(path)
    through_spark = files.where(F.col("length") <= whole).select("content").mapInPandas(small_files, schema)
    return through_spark.unionByName(files.where(F.col("length") > whole).select("path").mapInPandas(large_files, schema))


def write(records: DataFrame, uri: str) -> DataFrame:
    """Writes records to part-NNNNN.warc.gz under a URI that pyarrow reaches, one file a partition and a gzip member a
    record; returns name and n_records.  A file appears under its name when whole, so that a task may run again."""

    def work(batches):
        from pyarrow import fs

        context = TaskContext.get()
        system, at = fs.FileSystem.from_uri(uri)
        system.create_dir(at)
        name, n = f"part-{context.partitionId():05d}.warc.gz", 0
        unfinished = f"{at}/_{name}.{context.taskAttemptId()}"
        with system.open_output_stream(unfinished, compression=None) as f:
            for pdf in batches:
                for record in pdf["record"]:
                    f.write(gzip.compress(record, mtime=0))
                    n += 1
        system.move(unfinished, f"{at}/{name}")
        yield pd.DataFrame({"name": [name], "n_records": [n]})

    return records.select("record").mapInPandas(work, "name string, n_records long")
