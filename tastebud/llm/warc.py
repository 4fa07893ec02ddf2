"""WARC archives with payload deduplication, and a two-level capture index.

Writing: each page becomes one WARC/1.1 record, an HTTP response block around the UTF-8 html, and
one gzip member of its own.  Of records with equal payloads of at least ``min_bytes`` the one with
the largest page_id is the response, the others are revisits that name its id, page and url.
Archives are written by Spark's text writer; its separator is the gzip member of a record
terminator, so a file is a plain sequence of members and needs no folder that executors share
beyond the target.  Each record states where in its file its member begins.

Reading: archives split at the separators, so one large file is read by many tasks.  A task holds
one record at a time.  ``read_captures`` reads single members by range.

Index: one line per record under the reversed-host URL key, sorted by range over the cluster,
``block_lines`` lines to a zlib block (first level), plus a sparse directory of first keys (second
level): every block's, or every s-th where there are more than ``MAX_DIRECTORY``.  A look-up
binary-searches the directory and reads only the run of blocks that can hold the key.  ``find``
looks up a table of captures as one Spark job: each search is a row, the found runs are joined
with the blocks.  Revisits take length and digest from the line of the capture they refer to.

Defined cases: null html is an empty payload; a null url has no target line and the empty key;
control characters in a url are percent-encoded; pages without page_id are written, but are
never referred to while a page with an id has the payload; rows repeated with the same page_id
and payload are all responses if theirs is the largest, and revisits refer to the one with the
largest url; an empty table gives empty archives; a revisit whose response isn't in the index has
null length and its stated digest.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

END = "\r\n\r\n"
MIN_BYTES = 1000
BLOCK_LINES = 3000
#: directory entries that are searched in memory; with more blocks an entry stands for a run of them
MAX_DIRECTORY = 1_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(text) -> F.Column:
    h = F.md5(text)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _header(name: str, value) -> F.Column:
    return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))


def warc_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """One column ``value``: each page's record without the terminator."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("bytes"))
    # one row per repeated payload; small tables are broadcast by their measured file size, others shuffle
    shared, _ = materialize(rows.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max(F.struct("page", "url")).alias("k"), F.count("*").alias("n"))
                            .where("n > 1 AND k.page IS NOT NULL").select(F.col("digest").alias("d"), F.col("k.page").alias("keeper"), F.col("k.url").alias("keeper_url")))
    rows = rows.join(shared, (F.col("digest") == F.col("d")) & (F.col("bytes") >= min_bytes), "left")
    name = lambda page: F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("-")), "digest")
    revisit = F.col("keeper").isNotNull() & ~F.col("page").eqNullSafe(F.col("keeper"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "\r", "%0D"), "\n", "%0A"), "\t", "%09")
    url = plain("url")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), _uuid(name(F.col("page"))), F.lit(">"))),
        _header("WARC-Date", F.lit(DATE)), F.coalesce(_header("WARC-Target-URI", url), F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_header("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), _uuid(name(F.col("keeper"))), F.lit(">"))),
                                 F.coalesce(_header("WARC-Refers-To-Target-URI", plain("keeper_url")), F.lit("")), _header("X-Refers-To-Page-Id", F.col("keeper").cast("string")),
                                 _header("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        F.coalesce(_header("X-Page-Id", F.col("page").cast("string")), F.lit("")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(head, block).alias("value"))


def _member(raw: bytes) -> bytes:
    return gzip.compress(raw, 6, mtime=0)


#: the gzip member of a record terminator, between any two records and after the last
SEPARATOR = _member(END.encode())
OFFSET = "X-Archive-Offset: "


def _members(batches):
    """Records -> gzip members, each with the place where it begins in this task's file."""
    at = 0
    version = b"WARC/1.1\r\n"
    for batch in batches:
        for value in batch.column(0):
            raw = value.as_buffer().to_pybytes()
            member = _member(version + f"{OFFSET}{at}\r\n".encode() + raw[len(version):])
            if SEPARATOR in member:  # compressed bytes that look like the separator: store them another way
                member = next(m for level in (9, 1, 0) if SEPARATOR not in (m := gzip.compress(version + f"{OFFSET}{at}\r\n".encode() + raw[len(version):], level, mtime=0)))
            at += len(member) + len(SEPARATOR)
            yield pa.RecordBatch.from_arrays([pa.array([member], pa.binary())], names=["value"])


def _options(io):
    return io.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1")


def write_archives(pages: DataFrame, path: str, **columns) -> None:
    members = warc_records(pages, **columns).select(F.col("value").cast("binary")).mapInArrow(_members, "value binary")
    # one file per task, so that the offsets counted in the task hold
    _options(members.select(F.col("value").cast("string")).write).option("maxRecordsPerFile", 0).option("compression", "none").text(path)


RECORD = ("page_id long, record_id string, record_type string, refers_id string, refers_url string, refers_to long, url string, payload_bytes long, "
          "payload_digest string, stated_digest string, archive string, start long, length long")


def _record(raw: bytes) -> tuple[dict, bytes]:
    """Header fields and payload of one record; Content-Length must hold."""
    head_end = raw.find(END.encode())
    head = dict(line.partition(": ")[::2] for line in raw[:head_end].decode().split("\r\n")[1:])
    block = raw[head_end + 4:]
    if head_end < 0 or len(block) != int(head["Content-Length"]):
        raise ValueError("a record's length differs from its Content-Length")
    return head, block.partition(END.encode())[2]


def _parse(batches):
    """(archive, member) -> records."""
    schema = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in RECORD.split(", ")])
    number = lambda head, name: int(head[name]) if name in head else None
    for batch in batches:
        rows = []
        for name, member in zip(batch.column(0).to_pylist(), batch.column(1)):
            packed = member.as_buffer().to_pybytes()
            head, payload = _record(gzip.decompress(packed))
            revisit = head["WARC-Type"] == "revisit"
            rows.append((number(head, "X-Page-Id"), head["WARC-Record-ID"], head["WARC-Type"], head.get("WARC-Refers-To"), head.get("WARC-Refers-To-Target-URI"),
                         number(head, "X-Refers-To-Page-Id"), head.get("WARC-Target-URI"), None if revisit else len(payload), None if revisit else hashlib.sha1(payload).hexdigest(),
                         head["WARC-Payload-Digest"].removeprefix("sha1:"), name, int(head[OFFSET[:-2]]), len(packed)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def read_records(spark, path: str) -> DataFrame:
    """All records as they are in the archives; revisits have no payload of their own."""
    members = _options(spark.read).text(path).select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("member"))
    return materialize(members.mapInArrow(_parse, RECORD))[0]


def resolve_revisits(records: DataFrame, index: "CaptureIndex") -> DataFrame:
    """Records with the length and digest of revisits taken from the index line of their response."""
    columns = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "archive", "start", "length"]
    revisits = records.where("record_type <> 'response'")
    # every response is looked up once, however many revisits refer to it
    wanted = revisits.select(F.col("refers_url").alias("url"), F.col("refers_to").alias("page_id")).distinct()
    lines = (index.find(wanted).where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated_digest"), F.col("payload_bytes").alias("b"))
             .dropDuplicates(["refers_to", "stated_digest"]))
    found = revisits.join(lines, ["refers_to", "stated_digest"], "left").withColumns({"payload_bytes": F.col("b"), "payload_digest": F.col("stated_digest")})
    return records.where("record_type = 'response'").select(*columns).unionByName(found.select(*columns))


def read_archives(spark, path: str) -> DataFrame:
    """All records, revisits resolved by index look-ups: page_id, record_type, refers_to, payload_bytes, payload_digest, url, archive, start, length."""
    records = read_records(spark, path)
    return resolve_revisits(records, CaptureIndex.build(records))


def _open(archive: str):
    """A file by path or URI, on any file system Arrow knows."""
    local = archive.removeprefix("file:") if archive.startswith("file:") else archive
    if "://" not in local:
        from urllib.parse import unquote
        return pa.fs.LocalFileSystem().open_input_file(unquote(local) if archive.startswith("file:") else local)
    system, path = pa.fs.FileSystem.from_uri(archive)
    return system.open_input_file(path)


CAPTURE = "page_id long, archive string, start long, payload binary"


def _read_ranges(batches):
    for batch in batches:
        for page, archive, start, length in zip(*(c.to_pylist() for c in batch.columns)):
            with _open(archive) as f:
                f.seek(start)
                payload = _record(gzip.decompress(f.read(length)))[1]
            yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([archive]), pa.array([start], pa.int64()), pa.array([payload], pa.binary())],
                                             names=["page_id", "archive", "start", "payload"])


def read_captures(lines: DataFrame) -> DataFrame:
    """Payloads of index lines, each read as one range of its archive (revisits: empty)."""
    return lines.select("page_id", "archive", "start", "length").mapInArrow(_read_ranges, CAPTURE)


# ------------------------------------------------------------------------ index

def url_key(url: str | None) -> str:
    """Reversed host, then the rest: ``http://www.a.org:80/x?y`` -> ``org,a,www)/x?y``."""
    if not url:
        return ""
    url = url.replace("\r", "%0D").replace("\n", "%0A").replace("\t", "%09")  # as in the archives
    rest = url.split("://", 1)[-1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:]
    host, _, port = host.partition(":")
    name = ",".join(reversed(host.split(".")))
    return name + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (path or "/")


LINE = "url_key string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, start long, length long"
FIELDS = [f.split()[0] for f in LINE.split(", ")]


def _with_key(batches):
    for batch in batches:
        keys = pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, *batch.columns[1:]], names=FIELDS)


def _write_blocks(batches, lines: int):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("first_key", pa.string()), ("first_page", pa.int64()), ("last_key", pa.string()), ("n", pa.int32()), ("block", pa.binary())])
    held: list[tuple] = []
    part, seq = TaskContext.get().partitionId(), -1

    def block(rows):
        nonlocal seq
        seq += 1
        text = "\n".join("\t".join("" if x is None else str(x) for x in r) for r in rows)
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, seq, rows[0][0], rows[0][1], rows[-1][0], len(rows), zlib.compress(text.encode(), 6)), schema.types)], schema=schema)

    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns))
        while len(held) >= lines:
            yield block(held[:lines])
            held = held[lines:]
    if held:
        yield block(held)


def _decode(block: bytes) -> list[tuple]:
    kinds = [str, int, str, int, int, str, str, int, int]
    return [tuple((k(x) if x != "" else (None if k is int else "")) for k, x in zip(kinds, line.split("\t"))) for line in zlib.decompress(block).decode().split("\n")]


def _read_blocks(batches):
    schema = pa.schema([(n, pa.int64() if "long" in f else pa.string()) for n, f in zip(FIELDS, LINE.split(", "))])
    for batch in batches:
        for block in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*_decode(block)), schema.types)], schema=schema)


class CaptureIndex:
    """Sorted compressed blocks (a table; part and seq give their order) and their sparse directory."""

    def __init__(self, blocks: DataFrame, max_directory: int = MAX_DIRECTORY):
        self.blocks, self.max_directory, self._entries = blocks, max_directory, None

    @classmethod
    def build(cls, records: DataFrame, block_lines: int = BLOCK_LINES, max_directory: int = MAX_DIRECTORY) -> "CaptureIndex":
        lines = records.select("url", *FIELDS[1:]).mapInArrow(_with_key, LINE)
        # ranges over (key, page_id): a host with a third of all captures is many ranges
        sorted_lines = lines.repartitionByRange("url_key", "page_id").sortWithinPartitions("url_key", "page_id")
        blocks = sorted_lines.mapInArrow(lambda it: _write_blocks(it, block_lines), "part int, seq long, first_key string, first_page long, last_key string, n int, block binary")
        return cls(materialize(blocks)[0], max_directory)

    def directory(self) -> DataFrame:
        return self.blocks.select("part", "seq", "first_key", "first_page", "last_key", "n")

    def _sparse(self) -> tuple[int, list[tuple]]:
        """s and the sorted first (key, page) with (part, run) of every run of s blocks."""
        if self._entries is None:
            s = max(1, -(-self.blocks.count() // self.max_directory))
            first = self.directory().where(F.col("seq") % s == 0).select("first_key", "first_page", "part", F.floor(F.col("seq") / s).alias("run")).collect()
            # order of lines: key by bytes, then page, nulls first; Python compares code points, the same order
            self._entries = s, sorted(((r.first_key, r.first_page is not None, r.first_page or 0), r.part, r.run) for r in first)
        return self._entries

    def find(self, captures: DataFrame) -> DataFrame:
        """Index lines of the captures (url, page_id), all in one job."""
        s, entries = self._sparse()
        shared = captures.sparkSession.sparkContext.broadcast(entries)

        def search(batches):
            firsts = [e[0] for e in shared.value]
            for batch in batches:
                out = []
                for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    key = (url_key(url), page is not None, page or 0)
                    # equal lines may begin in the run before and go on over several
                    for i in range(max(bisect.bisect_left(firsts, key) - 1, 0), bisect.bisect_right(firsts, key)):
                        out.append((key[0], page, shared.value[i][1], shared.value[i][2]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.int64()))], names=["k", "p", "part", "run"])

        wanted, _ = materialize(captures.select("url", F.col("page_id").cast("long")).distinct().mapInArrow(search, "k string, p long, part int, run long"))
        runs = wanted.select("part", "run").distinct()
        lines = (self.blocks.withColumn("run", F.floor(F.col("seq") / s)).join(runs, ["part", "run"], "left_semi")
                 .select("block").mapInArrow(_read_blocks, LINE))
        keys = wanted.select("k", "p").distinct()
        return lines.join(keys, (F.col("url_key") == F.col("k")) & F.col("page_id").eqNullSafe(F.col("p")), "left_semi")

    def lines(self) -> DataFrame:
        """Every index line."""
        return self.blocks.select("block").mapInArrow(_read_blocks, LINE)

    def lookup(self, urls: list[str]) -> DataFrame:
        """Index lines of the urls' keys; reads the blocks that can hold them, found by binary search."""
        keys = sorted({url_key(u) for u in urls})
        s, entries = self._sparse()
        firsts = [e[0][0] for e in entries]
        runs = {entries[i][1:] for k in keys for i in range(max(bisect.bisect_left(firsts, k) - 1, 0), bisect.bisect_right(firsts, k))}
        wanted = self.blocks.sparkSession.createDataFrame(sorted(runs), "part int, run long")
        return (self.blocks.withColumn("run", F.floor(F.col("seq") / s)).join(wanted, ["part", "run"], "left_semi")
                .select("block").mapInArrow(_read_blocks, LINE).where(F.col("url_key").isin(keys)))


def archive_folder(spark) -> str:
    """A new folder for archives beside the session's checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
