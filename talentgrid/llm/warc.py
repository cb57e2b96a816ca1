"""WARC archives: a writer and a splittable reader.

Each record is one gzip member.  The writer leaves the files to Spark's text sink, so lost tasks
leave nothing behind: the last byte of a member, the high byte of its length, is 0 below 16 MB
and serves as the line end; after a longer record an empty member supplies that byte.

The reader lets Spark cut the files into byte ranges and scan them for the gzip magic, as the line
separator of the text source: a range yields the candidates that start inside it.  A candidate is
a record if its first bytes inflate to a WARC header; otherwise the magic stood by chance inside
a member and its bytes continue the member before.  Where such a member reaches into the next
range, both tasks hand their parts over and they are put together by file; these are rare, and
files in which no member is left open hand over nothing.

Spark's text source would inflate a file whose name ends in .gz as a whole, in one task.  Such files are
cut into ranges of RANGE bytes here: a task opens the file, scans its range for the magic, validates
candidates alike and reads on beyond the range where its last record does.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentgrid.llm.byte_bpe import slices
from talentgrid.llm.frames import checkpointed, pick

#: Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads with fewer bytes are always written out.
LEAST_REVISIT = 100
#: Parts that the copies of one payload are dealt to.
SALTS = 32
#: Bytes of a range of a file named .gz, and bytes read from it at once.
RANGE, READ = 1 << 27, 1 << 20
#: Names that the text source doesn't inflate, and those that it would.
PLAIN_NAMES, GZ_NAMES = "{*[!z],*[!g]z,*[!.]gz}", "*.gz"
SCHEMA = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, record_id string, refers_to_id string, verified boolean"
)
KINDS = [
    pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(),
    pa.bool_(),
]
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
#: How the writer names the record of a page.
OWN_ID = "<urn:page:"


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): what each page's record will hold.

    Of pages with equal payloads of LEAST_REVISIT bytes or more, those with the smallest page_id
    are written out (refers_to null), the others refer to it.  A null html is an empty payload.
    """
    source = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("bigint"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    first = source.filter(F.length("payload") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select("digest", "first")
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    first = first.withColumn("salt", F.explode(salts))
    salted = source.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    return salted.join(first, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("first") < F.col("page_id"), F.col("first"))
        .when(F.col("page_id").isNull(), F.col("first")).alias("refers_to"),
    )


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record, not compressed."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    name = lambda x: f"{OWN_ID}{'none' if x is None else x}>"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": date,
        "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        head["WARC-Target-URI"] = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    body = http + payload
    if refers_to is not None:
        head |= {"WARC-Profile": REVISIT, "WARC-Refers-To": name(refers_to)}
        body = http
    head["Content-Length"] = str(len(body))
    lines = "".join(f"{key}: {value}\r\n" for key, value in head.items())
    return VERSION + b"\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + body + b"\r\n\r\n"


def squeeze(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def as_line(member: bytes) -> bytes:
    """The member without its last byte, which the line end supplies."""
    return member[:-1] if member[-1] == 0 else member + squeeze(b"")[:-1]


def write(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for each page (page_id, url, html) below ``path``, a new folder.

    Repeated rows get a record each; null ids are written as none; other columns are not read.
    """
    def work(batches):
        for batch in slices(batches, 64):
            lines = [as_line(squeeze(record(*row, date))) for row in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["line"])

    lines = with_revisits(pages).mapInArrow(work, "line binary")
    lines.select(F.col("line").cast("string")).write.option("lineSep", "\x00").text(path)


def fields_of(lines: str) -> dict[str, str]:
    """Header fields by name in lower case; a line that begins with white space continues the one before."""
    fields, name = {}, ""
    for line in lines.split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def page_of(record_id: str | None) -> int | None:
    """The page that a record written here names; None for any other id."""
    if record_id is None or not record_id.startswith(OWN_ID):
        return None
    number = record_id[len(OWN_ID):-1]
    return int(number) if number.lstrip("-").isdigit() else None


def checked(payload: bytes, digest: str | None) -> bool | None:
    """Whether a payload has its recorded digest; None without one, or one of another kind."""
    kind, _, value = (digest or "").partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha256", "sha1", "md5"):
        return None
    raw = hashlib.new(kind, payload).digest()
    return value.lower() == raw.hex() or value.upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=")


def parsed(data: bytes) -> tuple | None:
    """The row of an inflated record; None for one that is no response or revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = fields_of(head.decode("utf-8", "surrogateescape"))
    kind = fields.get("warc-type", "").lower()
    if kind not in ("response", "revisit"):
        return None
    length = fields.get("content-length", "")
    body = rest[:int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    if body.startswith(b"HTTP/"):
        http, _, payload = body.partition(b"\r\n\r\n")
    else:
        http, payload = b"", body
    record_id, refers_to, digest = (fields.get(f"warc-{name}") for name in ("record-id", "refers-to", "payload-digest"))
    own, url = (record_id or "").startswith(OWN_ID), fields.get("warc-target-uri")
    if url is not None:
        url = url.removeprefix("<").removesuffix(">") if url.startswith("<") else url
        if own:
            url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
        url = url.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
    if kind == "revisit":
        told = fields_of(http.decode("latin-1")).get("content-length", "")
        bare = digest.removeprefix("sha256:") if digest else None
        return page_of(record_id), url, kind, None, int(told) if told.isdigit() else None, bare, page_of(refers_to), \
            record_id, refers_to, None
    verified = checked(payload, digest)
    if own and verified is False:
        raise ValueError(f"payload of {record_id} doesn't have its digest")
    return page_of(record_id), url, kind, payload, len(payload), hashlib.sha256(payload).hexdigest(), None, record_id, None, verified


class Members:
    """Puts the candidates of one byte range, in order, together to members."""

    def __init__(self):
        self.parts: list[bytes] = []  # of the member that isn't complete
        self.inflater = None

    def feed(self, candidate: bytes) -> tuple[str, bytes | None]:
        """("record", inflated bytes), ("open", None), or ("tail", candidate) if it begins nothing."""
        if self.inflater is not None:
            try:
                self.inflated += self.inflater.decompress(candidate)
            except zlib.error:  # the member before was broken off
                self.inflater = None
        if self.inflater is None:
            inflater = zlib.decompressobj(31)
            try:
                begin = inflater.decompress(candidate, 64)
                if not begin.startswith(VERSION[:5]) and not (inflater.eof and not begin):
                    return "tail", candidate
                begin += inflater.decompress(inflater.unconsumed_tail)
            except zlib.error:
                return "tail", candidate
            self.inflater, self.inflated, self.parts = inflater, bytearray(begin), []
        if not self.inflater.eof:
            self.parts.append(candidate)
            return "open", None
        self.inflater, self.parts = None, []
        return "record", bytes(self.inflated)


def begins(candidate: bytes) -> bool:
    """True if the first bytes inflate to a WARC header, or to nothing, as an empty member does."""
    inflater = zlib.decompressobj(31)
    try:
        begin = inflater.decompress(candidate, 64)
    except zlib.error:
        return False
    return begin.startswith(VERSION[:5]) or (inflater.eof and not begin)


def _candidates(batches) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    """(path, start) of each range, and its candidates in order."""
    for at, rows in groupby(
        (((path.as_py(), start.as_py()), value) for batch in batches for path, start, value in zip(*batch.columns)),
        itemgetter(0),
    ):
        values = (MAGIC + value.as_py() for _, value in rows)
        if at[1] == 0:
            next(values)  # what stands before the first magic of a file
        yield at, values


def _records(batches) -> Iterator[tuple]:
    """Rows of the records that lie in one range."""
    for _, values in _candidates(batches):
        members = Members()
        for value in values:
            kind, data = members.feed(value)
            if kind == "record" and data and (row := parsed(data)):
                yield row


def _pieces(batches) -> Iterator[tuple]:
    """(path, start, place, opens, data) of members that cross ranges.

    Of a range these are the candidates before its first member, and its last member if that is
    not complete; only this one has to be inflated.
    """
    for at, values in _candidates(batches):
        last: list[bytes] = []
        for place, value in enumerate(values):
            if begins(value):
                last = [value]
            elif last:
                last.append(value)
            else:
                yield *at, place, False, value
        if last:
            members = Members()
            done = [members.feed(value)[0] for value in last]
            if members.inflater is not None and done:
                yield *at, 1 << 40, True, b"".join(members.parts)


def opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark gives it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", path))
    system, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system.open_input_file(name)


def _whole(batches, reach: int) -> Iterator[tuple]:
    """Rows of the records that begin in byte ranges (path, start) of files, read up to their ends."""
    for batch in batches:
        for path, start in zip(*batch.columns):
            with opened(path.as_py()) as source:
                for inflated in members_from(source, start.as_py(), reach):
                    if inflated and (row := parsed(inflated)):
                        yield row


def members_from(source, start: int, reach: int) -> Iterator[bytes]:
    """Inflated members that begin at one of ``reach`` places from ``start`` on."""
    size = source.size()
    at, stop = start, min(start + reach, size)
    while at < stop:
        source.seek(at)
        block = source.read(min(READ, stop - at + len(MAGIC) - 1))
        found = block.find(MAGIC)
        if found < 0:
            at += max(len(block) - len(MAGIC) + 1, 1)
            continue
        at += found
        if at >= stop:
            return
        source.seek(at)
        head = source.read(READ)
        if not begins(head):
            at += 1
            continue
        inflater, inflated, taken = zlib.decompressobj(31), bytearray(), 0
        try:
            while head:
                inflated += inflater.decompress(head)
                taken += len(head) - len(inflater.unused_data)
                head = b"" if inflater.eof else source.read(READ)
        except zlib.error:
            pass
        if inflater.eof:
            yield bytes(inflated)
        at += taken if inflater.eof else 1


def _batched(rows, names, kinds, size=256):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each response and revisit record: page_id, url, record_type, payload, ...

    payload_bytes and payload_digest (SHA-256) are those of the full payload; for a revisit, whose payload
    is null, they are what its record says.  record_id and refers_to_id are the records' names; page_id and
    refers_to are the numbers in them if :func:`write` made them, else null.  verified tells whether the
    payload has its recorded digest (SHA-256, SHA-1 or MD5, in hex or base 32), null if there is none; one
    that :func:`write` wrote and that doesn't have it raises an error.  Other kinds of records, and bytes that belong to
    no record, are skipped.  Records must be gzip members of their own.  Files whose names end in .gz are
    opened by the tasks themselves, by pyarrow, which must know their file system.
    """
    source = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).option(
        "pathGlobFilter", PLAIN_NAMES
    ).text(path).select(
        F.input_file_name().alias("path"), F.input_file_block_start().alias("start"),
        F.col("value").cast("binary").alias("value"),
    )
    parts = ["path", "start", "place", "opens", "data"]
    part_kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def records(batches):
        yield from _batched(_records(batches), NAMES, KINDS, 64)

    def pieces(batches):
        yield from _batched(_pieces(batches), parts, part_kinds, 64)

    def ranges(batches):
        yield from _batched(_whole(batches, RANGE), NAMES, KINDS, 64)

    def together(found):
        rows, members = [], None
        for opens, piece in found.sort_values(["start", "place"])[["opens", "data"]].itertuples(index=False):
            if opens:
                members = Members()
            elif members is None:
                continue
            kind, inflated = members.feed(piece)
            if kind == "record" and inflated and (row := parsed(inflated)):
                rows.append(row)
            if kind != "open":
                members = None
        return pd.DataFrame(rows, columns=NAMES).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    crossing = checkpointed(source.mapInArrow(pieces, "path string, start bigint, place bigint, opens boolean, data binary"))
    crossing = crossing.join(crossing.filter("opens").select("path").distinct(), "path", "left_semi")
    files = spark.read.format("binaryFile").option("pathGlobFilter", GZ_NAMES).load(path).select("path", "length")
    cut = files.filter("length > 0").select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(RANGE).cast("bigint"))).alias("start"))
    return (
        source.mapInArrow(records, SCHEMA)
        .union(crossing.groupBy("path").applyInPandas(together, SCHEMA))
        .union(cut.repartition("path", "start").mapInArrow(ranges, SCHEMA))
    )
