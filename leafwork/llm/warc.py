"""WARC archives through a chunked record table.

Reading and writing go by rows (record, chunk number): the engine cuts payloads into chunks, and the workers that write
or read a record hold one chunk of it, with the digest of everything up to it. Equal payloads meet as aggregates, so a
payload is carried and written once and its copies are counts. Archives are WARC/1.1 files of one gzip member a record,
written under a temporary name and renamed when complete, so a task that runs again leaves one whole file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.llm.common import fresh_path, table

CHUNK = 1 << 16
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_WRITTEN = ("kind", "sole", "page_id", "url", "refers_to", "hex", "payload_bytes", "chunk", "data", "last")
CHUNK_ROW = "file string, record_id string, record_type string, page_id long, refers_to_id string, refers_to_page long, chunk int, at long, size int, digest string, declared string, last boolean"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str, row: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}/{row}')}>"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ---------------------------------------------------------------- plan


def _order(*also: str) -> Column:
    """What makes a row the response of its payload: the smallest page_id, null last, then the smallest url, null first."""
    return F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", *also)


def _pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (UTF-8), payload_bytes and hex (SHA-1) of each page; a null html is empty."""
    url = F.col("url") if "url" in pages.columns else F.lit(None)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), url.cast("string").alias("url"), payload.alias("payload"))
    return rows.select("*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("hex"))


def _revisits(rows: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, hex, refers_to: all rows of `_pages` but the first of each payload.

    Rows that agree in all are counted before they meet, and come back in blocks, so a frequent row is no large group.
    """
    same = rows.groupBy("hex", "payload_bytes", "page_id", "url").agg(F.count("*").alias("n"))
    first = same.groupBy(F.col("hex").alias("h"), F.col("payload_bytes").alias("b")).agg(F.min(_order()).alias("first"), F.sum("n").alias("all")).filter("all > 1")
    left = same.join(first, F.expr("hex = h and payload_bytes = b")).withColumn("n", F.col("n") - F.when(_order().eqNullSafe(F.col("first")), 1).otherwise(0)).filter("n > 0")
    block = 10_000
    blocks = left.select("page_id", "url", "payload_bytes", "hex", F.col("first.page_id").alias("refers_to"), F.col("n"), F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block))).alias("at"))
    return blocks.repartition("hex", "page_id", "url", "at").select("page_id", "url", "payload_bytes", "hex", "refers_to", F.explode(F.sequence(F.lit(1), F.least(F.lit(block).cast("long"), F.col("n") - F.col("at") * block).cast("int"))).alias("k")).drop("k")


def plan(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, record_type and refers_to of each row: of equal payloads of at least `least` bytes the row with the
    smallest page_id is the response, and the others, its own repetitions too, revisit it. Null page_ids sort last; smaller
    payloads are all responses.
    """
    rows = _pages(pages).drop("payload")
    large = rows.filter(F.col("payload_bytes") >= least)
    response = large.groupBy("hex", "payload_bytes").agg(F.min(_order()).alias("first")).selectExpr("first.page_id as page_id", "'response' as record_type", "cast(null as long) as refers_to")
    out = response.unionByName(_revisits(large).selectExpr("page_id", "'revisit' as record_type", "refers_to"))
    small = rows.filter(F.col("payload_bytes") < least).selectExpr("page_id", "'response' as record_type", "cast(null as long) as refers_to")
    return out.unionByName(small) if least > 0 else out


# ---------------------------------------------------------------- write


def to_chunks(pages: DataFrame, least: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table to be written: kind, sole, page_id, url, refers_to, hex, payload_bytes, chunk, data, last.

    A record's rows are neighbours, in order. `sole` tells that no other response has the payload, so that page_id and
    digest make a record id that revisits can name; a revisit, or an empty payload, is one row without data.
    """
    rows = _pages(pages)
    large = rows.filter(F.col("payload_bytes") >= least)
    first = large.groupBy("hex", "payload_bytes").agg(F.min(_order("payload")).alias("first"))
    responses = first.select("first.page_id", "first.url", "payload_bytes", "hex", "first.payload", F.lit(True).alias("sole"))
    if least > 0:
        small = rows.filter(F.col("payload_bytes") < least)
        responses = responses.unionByName(small.withColumn("sole", F.lit(False)))
    parts = F.when(F.col("payload_bytes") <= chunk, F.array("payload")).otherwise(F.transform(F.sequence(F.lit(0), ((F.col("payload_bytes") - 1) / chunk).cast("int")), lambda i: F.substring(F.col("payload"), i * chunk + 1, F.lit(chunk))))
    cut = responses.select(F.lit("response").alias("kind"), "sole", "page_id", "url", F.lit(None).cast("long").alias("refers_to"), "hex", "payload_bytes", F.posexplode(parts).alias("chunk", "data"))
    cut = cut.withColumn("last", (F.col("chunk") + 1) * F.lit(chunk).cast("long") >= F.col("payload_bytes"))
    again = _revisits(large.drop("payload")).select(F.lit("revisit").alias("kind"), F.lit(False).alias("sole"), "page_id", "url", "refers_to", "hex", "payload_bytes", F.lit(0).alias("chunk"), F.lit(b"").alias("data"), F.lit(True).alias("last"))
    return cut.unionByName(again)


def _header(kind: str, own_id: str, page_id, url: str, digest: str, length: int, size: int, refers, refers_id: str | None, date: str) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own_id}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {size}"]
    if url:
        lines.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_id}", f"X-Refers-To-Page: {'' if refers is None else refers}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write(pages: DataFrame, folder: str, least: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) to archives in `folder`; rows (file, records, size).

    Record ids differ, and a revisit names that of its response. Payloads come as chunks; one whose digest differs from the
    engine's raises an error.

    The result must be evaluated once for the archives to exist; the names of files that no finished task reported are
    not in it, so a task's second attempt never shows records twice.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        out, records, gz, sha = None, 0, None, None
        for batch in batches:
            for kind, sole, page_id, url, refers, hexed, size, k, data, last in zip(*(batch.column(c) for c in _WRITTEN)):
                kind, hexed, size = kind.as_py(), hexed.as_py(), size.as_py()
                if k.as_py() == 0:
                    out = out or files.open_output_stream(f"{root}/{name}.tmp", compression=None)
                    gz, sha, digest = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha1(), _base32(bytes.fromhex(hexed))
                    page_id, refers = page_id.as_py(), refers.as_py()
                    own_id = record_id(page_id, digest, "" if sole.as_py() else f"{name}/{records}")
                    refers_id = record_id(refers, digest) if kind == "revisit" else None
                    length = len(_HTTP) + (size if kind == "response" else 0)
                    out.write(gz.compress(_header(kind, own_id, page_id, url.as_py(), digest, length, size, refers, refers_id, date) + _HTTP))
                if size and kind == "response":
                    sha.update(data.as_buffer())
                    out.write(gz.compress(data.as_buffer()))
                if last.as_py():
                    if kind == "response" and sha.hexdigest() != hexed:
                        raise ValueError(f"chunks of {hexed} don't make its payload")
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    records += 1
        if out:
            written = out.tell()
            out.close()
            files.move(f"{root}/{name}.tmp", f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": [records], "size": [written]})

    return to_chunks(pages, least).select(*_WRITTEN).mapInArrow(save, "file string, records long, size long")


# ---------------------------------------------------------------- read


class _Stream:
    """Inflated bytes of a file of gzip members, read on demand."""

    def __init__(self, handle):
        self.handle, self.ready, self.raw, self.gz = handle, bytearray(), b"", zlib.decompressobj(31)

    def more(self) -> bool:
        if self.gz.eof:
            self.raw, self.gz = self.gz.unused_data, zlib.decompressobj(31)
        self.raw = self.raw or self.handle.read(CHUNK)
        if not self.raw:
            return False
        self.ready += self.gz.decompress(self.raw, CHUNK)
        self.raw = self.gz.unconsumed_tail
        return True

    def take(self, most: int) -> bytes:
        while not self.ready and self.more():
            pass
        found = bytes(self.ready[:most])
        del self.ready[:most]
        return found

    def until(self, mark: bytes) -> bytes:
        at = self.ready.find(mark)
        while at < 0 and self.more():
            at = self.ready.find(mark)
        if at < 0:
            if bytes(self.ready).strip():
                raise ValueError("the archive ends within a header")
            return b""
        found = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return found


def records(handle, chunk: int = CHUNK) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """(headers, payload chunks) of each record of an opened archive; the chunks must be read before the next record."""
    stream = _Stream(handle)
    while True:
        head = stream.until(b"\r\n\r\n")
        if not head:
            return
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        left = int(headers["Content-Length"])
        inner = stream.until(b"\r\n\r\n")
        left -= len(inner) + 4

        def parts(left=left) -> Iterator[bytes]:
            held = bytearray()
            while left:
                part = stream.take(min(left, chunk - len(held)))
                if not part:
                    raise ValueError("the archive ends within a record")
                left -= len(part)
                held += part
                if len(held) == chunk:
                    yield bytes(held)
                    held.clear()
            if held:
                yield bytes(held)

        yield headers, parts()
        tail = b""
        while len(tail) < 4 and (more := stream.take(4 - len(tail))):
            tail += more
        if tail != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its length says")


def read_chunks(files: DataFrame, with_data: bool = False, chunk: int = CHUNK, flush: int = 256) -> DataFrame:
    """The chunked record table of archives, from rows with `file`.

    A row per chunk, with the chunk's place, size and the digest of the payload up to its end; a record without
    payload has one chunk of size 0. `last` marks a record's last chunk, whose digest is the payload's, or for a revisit
    the declared one. With `with_data` the bytes come as well. Damaged archives raise an error.
    """
    columns = [x.split()[0] for x in CHUNK_ROW.split(", ")] + ["data"] * with_data

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"].tolist():
                source, path = _filesystem(name)
                rows: list[tuple] = []
                with source.open_input_stream(path, compression=None) as handle:
                    for headers, parts in records(handle, chunk):
                        declared = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        page, refers = headers.get("X-Page-ID") or None, headers.get("X-Refers-To-Page") or None
                        fixed = (name, headers["WARC-Record-ID"], headers["WARC-Type"], page and int(page), headers.get("WARC-Refers-To"), refers and int(refers))
                        sha, at, k, held = hashlib.sha1(), 0, 0, b""
                        for part in parts:
                            if k or held:
                                rows.append((*fixed, k, at - len(held), len(held), _base32(sha.digest()), declared, False, *((held,) if with_data else ())))
                                k += 1
                            sha.update(part)
                            at, held = at + len(part), part
                            if len(rows) >= flush:
                                yield _frame(rows, columns)
                                rows = []
                        own = declared if headers["WARC-Type"] == "revisit" else _base32(sha.digest())
                        rows.append((*fixed, k, at - len(held), len(held), own, declared, True, *((held,) if with_data else ())))
                        if len(rows) >= flush:
                            yield _frame(rows, columns)
                            rows = []
                if rows:
                    yield _frame(rows, columns)

    return files.select("file").mapInPandas(load, CHUNK_ROW + ", data binary" * with_data)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to_page": "Int64"})


def payloads(chunks: DataFrame) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's payload is that of the response of the page it refers to (null: one without page_id) with the digest it
    declares. A response whose digest differs from the declared one has a null payload_digest.
    """
    last = chunks.filter("last")
    own = last.selectExpr("page_id", "record_type", "refers_to_page", "at + size as payload_bytes", "declared", "if(digest = declared, digest, null) as payload_digest")
    kept = own.filter("record_type = 'response'").selectExpr("page_id as _id", "declared as _declared", "payload_digest is not null as _sound", "payload_bytes as _bytes")
    wanted = own.filter("record_type = 'revisit'")
    # Few of the responses are referred to, by many revisits: each is fetched once, a sound copy before a damaged one.
    asked = wanted.select(F.col("refers_to_page").alias("_page"), F.col("declared").alias("_asked")).distinct().join(kept, F.expr("_page <=> _id and _asked = _declared")).groupBy("_page", "_asked").agg(F.max_by("_bytes", "_sound").alias("_bytes"), F.max("_sound").alias("_sound"))
    found = wanted.join(asked, F.expr("refers_to_page <=> _page and declared = _asked"), "left").selectExpr("page_id", "_bytes as payload_bytes", "if(_sound, declared, null) as payload_digest", "record_type", "refers_to_page as refers_to")
    return own.filter("record_type = 'response'").selectExpr("page_id", "payload_bytes", "payload_digest", "record_type", "cast(null as long) as refers_to").unionByName(found)


def archive(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write `pages` as archives in the shared folder; rows (file, records, size), stored, so nothing is written twice."""
    folder = fresh_path(spark, "warc")
    listing = fresh_path(spark, "warc-files")
    write(pages, folder, least).write.parquet(listing)
    return spark.read.schema("file string, records long, size long").parquet(listing)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives; see `plan` for null and repeated page_ids.

    A null html is an empty payload, which is revisited like any other; an empty table has no archives and no rows.
    """
    files = archive(spark, table(spark, sf_dir, "pages"))
    n = max(1, files.count())
    return payloads(read_chunks(files.repartition(n, "file")))
