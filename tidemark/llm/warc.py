"""Web archives and their two-level capture index.

``write`` puts every page into a WARC record (gzip member by record) of an archive file.
``build_index`` sorts the captures by reversed-host URL key, cuts the order into compressed
blocks and keeps one directory line per block.  ``lookup`` finds a capture by binary search:
first over the shards of the order, then over the shard's sparse directory, then in one
block that a range read fetches; the record itself is a second range read.

Of records with equal payloads the one with the smallest id is the response and the others
revisit it; payloads smaller than ``least_revisit`` bytes are always written in full.

Defined results: a null html is an empty payload, a null url an empty key; equal urls are
captures of their own, told apart by the page id.  A null id comes before all others in the index; its
page revisits a page with an id that has the same payload, and is a response where there is none.
Control characters of a url are percent-encoded in the record header.  Rows that share
url and id are captures of their own as well, and are all found together; each is
judged by its own payload.  A hot host or a hot url spreads over shards, because the order
is on (key, id).  Pages of any length are held whole; extra columns stay outside, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import ship, store

#: Bytes of records in an archive file, captures in an index block.
ARCHIVE_BYTES = 64 << 20
BLOCK_CAPTURES = 512
CACHED_BLOCKS = 8
_KEY_PART = "\x1f"
#: Characters that no header line may have.
_CONTROL = re.compile("[\x00-\x1f\x7f-\x9f\u2028\u2029]")
#: Captures that a task looks up, where there are many; smaller archives use all cores.
LOOKUPS_PER_TASK = 50_000
LEAST_LOOKUPS = 1_000


def url_key(url: str | None) -> str:
    """The URL with its host reversed: ``com,example)/path?query``, without scheme and user."""
    if not url:
        return ""
    try:
        parts = urlsplit(url if "://" in url else f"//{url}")
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{port}){path}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_url(url: str) -> str:
    """The URL as a header value: a line break in it would end the header."""
    return _CONTROL.sub(lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), url)


def _page_name(page_id: int | None) -> str:
    return "" if page_id is None else str(page_id)


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit has no payload."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{_page_name(page_id)}>",
        f"WARC-Target-URI: {_header_url(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def with_decisions(pages: DataFrame, least_revisit: int) -> DataFrame:
    """Pages with ``_digest`` and ``_refers_to``; only digests and ids are shuffled for it."""
    html = F.coalesce(F.col("_html"), F.lit("")).cast("binary")
    own = pages.withColumns({"_sha": F.sha1(html), "_size": F.octet_length(html).cast("long")})
    narrow = session.checkpointed(own.where(F.col("_size") >= least_revisit).select("_page", "_sha", "_size"))
    first = narrow.groupBy("_sha", "_size").agg(F.min("_page").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # Without any id there is no page to refer to.
    other = F.col("_first").isNotNull() & ~F.col("_page").eqNullSafe(F.col("_first"))
    again = narrow.join(ship.measured(first), ["_sha", "_size"]).where(other)
    names = {"_page": "_again", "_sha": "_again_sha", "_size": "_again_size", "_first": "_refers_to"}
    again = ship.measured(again.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct())
    same = (F.col("_sha") == F.col("_again_sha")) & (F.col("_size") == F.col("_again_size"))
    return own.join(again, same & F.col("_page").eqNullSafe(F.col("_again")), "left")


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_revisit: int = 0
) -> DataFrame:
    """Write all archives; the captures: ``key``, ``page_id``, ``uri``, ``offset``, ``length``."""
    names = pages.select(
        F.col(id_col).cast("long").alias("_page"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")
    )
    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        rows: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            uri = store.write(folder, ".warc.gz", b"".join(held))
            keys, ids, offsets, lengths = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array([uri] * len(rows), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                schema=schema,
            )

        for batch in batches:
            for page, url, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                member = record(page, url or "", payload, payload_digest(payload), refers)
                rows.append((url_key(url), page, size, len(member)))
                held.append(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    held, rows, size = [], [], 0
        if rows:
            yield close()

    decided = with_decisions(names, least_revisit).select("_page", "_url", "_html", "_refers_to")
    return session.checkpointed(decided.mapInArrow(run, "key string, page_id long, uri string, offset long, length long"))



def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """The shards of the sorted index: first and last key, block file, place of its directory.

    A shard file holds its compressed blocks, then the directory: for each block its
    first key, its offset and its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[bytes] = []
        directory: list[tuple[str, int, int]] = []
        lines: list[str] = []
        first = last = None
        size = total = 0

        def close() -> None:
            nonlocal lines, size
            block = zlib.compress("\n".join(lines).encode(), 6)
            directory.append((lines[0].rsplit(_KEY_PART, 3)[0], size, len(block)))
            blocks.append(block)
            size += len(block)
            lines = []

        for batch in batches:
            for key, page, uri, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"{_line(key)}{_KEY_PART}{_page_name(page)}"
                first = name if first is None else first
                last = name
                lines.append(_KEY_PART.join((name, uri, str(offset), str(length))))
                total += 1
                if len(lines) == BLOCK_CAPTURES:
                    close()
        if lines:
            close()
        if total:
            sparse = zlib.compress("\n".join(_KEY_PART.join((k, str(o), str(n))) for k, o, n in directory).encode(), 6)
            uri = store.write(folder, ".cdx", b"".join(blocks) + sparse)
            yield pa.RecordBatch.from_pydict(
                {"first": [first], "last": [last], "uri": [uri], "at": [size], "length": [len(sparse)], "captures": [total]},
                schema=pa.schema([("first", pa.string()), ("last", pa.string()), ("uri", pa.string()), ("at", pa.int64()), ("length", pa.int64()), ("captures", pa.int64())]),
            )

    ordered = captures.select("key", "page_id", "uri", "offset", "length").repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "uri", "offset")
    return session.checkpointed(ordered.mapInArrow(run, "first string, last string, uri string, at long, length long, captures long"))


def _line(key: str) -> str:
    """Keys in index lines have no line breaks and no part marks."""
    return key.replace("%", "%25").replace("\n", "%0A").replace(_KEY_PART, "%1F")


def _order(name: str) -> tuple[bytes, float]:
    key, _, page = name.rpartition(_KEY_PART)
    for code, mark in (("%0A", "\n"), ("%1F", _KEY_PART), ("%25", "%")):
        key = key.replace(code, mark)
    return key.encode(), int(page) if page else -math.inf


class Index:
    """One shard: its directory in memory, its blocks by range reads."""

    def __init__(self, uri: str, at: int, length: int):
        self.file = store.Ranges(uri)
        lines = zlib.decompress(self.file.read(at, length)).decode().split("\n")
        self.directory = [line.rsplit(_KEY_PART, 2) for line in lines]
        self.firsts = [_order(d[0]) for d in self.directory]
        self.blocks: dict[int, dict[str, list[tuple[str, int, int]]]] = {}

    def _block(self, k: int) -> dict[str, list[tuple[str, int, int]]]:
        if k not in self.blocks:
            if len(self.blocks) >= CACHED_BLOCKS:
                del self.blocks[next(iter(self.blocks))]
            _, at, length = self.directory[k]
            lines = zlib.decompress(self.file.read(int(at), int(length))).decode().split("\n")
            block: dict[str, list[tuple[str, int, int]]] = {}
            for own, uri, o, n in (line.rsplit(_KEY_PART, 3) for line in lines):
                block.setdefault(own, []).append((uri, int(o), int(n)))
            self.blocks[k] = block
        return self.blocks[k]

    def find(self, name: str) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of the captures, by binary search and the blocks that have them."""
        order = _order(name)
        k = bisect_right(self.firsts, order) - 1
        while k >= 0:
            yield from self._block(k).get(name, [])
            # A block that starts with the name may continue the one before it.
            if self.firsts[k] != order:
                return
            k -= 1


def lookup(spark: SparkSession, index: DataFrame, asked: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """The records of the asked (url, id) pairs, read back from the archives.

    ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``; a pair
    gives all its captures, once however often it is asked, and no row if it is not in the
    index.  Payloads of responses are checked against their
    digest.  The shard list has one row per index partition and goes to the tasks as a
    broadcast; questions are sorted like the index, so that neighbours share blocks.
    """
    shards = sorted(index.collect(), key=lambda r: _order(r["first"]))
    shared = spark.sparkContext.broadcast([(r["first"], r["last"], r["uri"], r["at"], r["length"]) for r in shards])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch.column(1)], ["key", "page_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        firsts = [_order(s[0]) for s in listed]
        open_index: tuple[int, Index] | None = None
        archives: dict[str, store.Ranges] = {}
        before = None
        for batch in batches:
            out: list[tuple] = []
            for key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"{_line(key)}{_KEY_PART}{_page_name(page)}"
                if name == before:  # equal questions are neighbours
                    continue
                before = name
                k = bisect_right(firsts, _order(name)) - 1
                if k < 0:
                    continue
                if open_index is None or open_index[0] != k:
                    open_index = (k, Index(*listed[k][2:]))
                for uri, offset, length in open_index[1].find(name):
                    if uri not in archives:
                        if len(archives) >= 64:
                            archives.pop(next(iter(archives))).close()
                        archives[uri] = store.Ranges(uri)
                    headers, block = parse(archives[uri].read(offset, length))
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and payload_digest(block) != digest:
                        raise ValueError(f"page {page}: the payload does not have its digest")
                    refers = headers.get("WARC-Refers-To")
                    out.append((page, int(headers["X-Payload-Length"]), digest, kind, int(refers[len("<urn:page:") : -1]) if refers else None))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    questions = asked.select(F.col(url_col).alias("_url"), F.col(id_col).cast("long").alias("page_id"))
    captures = sum(r["captures"] for r in shards)
    cores = min(spark.sparkContext.defaultParallelism, math.ceil(captures / LEAST_LOOKUPS))
    tasks = max(2, cores, math.ceil(captures / LOOKUPS_PER_TASK))
    keys = questions.mapInArrow(keyed, "key string, page_id long")
    ordered = keys.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_and_read(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """Write all pages, index them, and read every one back through the index."""
    spark = pages.sparkSession
    folder = ship.folder(spark, "warc")
    index = build_index(write(pages, folder, least_revisit=least_revisit), folder)
    return lookup(spark, index, pages)
