"""WARC archives, index first.

Writing: each task writes one archive of gzip members, a record each, and gives
back its index: path, offset, length, url, digest, page_id and type of every
record.  The index is written as a table at once, so it names exactly the
archives that count; files that lost attempts left behind are never read.

Reading: the wanted index rows are put in the order of path and offset, by
segments of SEGMENT bytes, and neighbouring byte ranges are joined, up to GAP
bytes apart and READ bytes long, so that a few long reads replace many short
ones.

Equal payloads of at least LEAST bytes have one response, that of the smallest
page_id; the others are revisits, with the HTTP head of the response alone.
Only digests and ids shuffle to find them.

Defined results.  A null html is an empty payload; a null url is written empty.
Null page ids sort last, so they are responses only where no other row has the
payload; rows that repeat the response's page_id are responses too.  A very long
html is one record.  Only page_id, url and html are read, so further columns may
have any name.  An empty table writes no archive and gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.arrow import filesystem, slices
from kindred.llm.common import materialize, new_folder, ship, sized_join, text_of

LEAST, SEGMENT, GAP, READ, LEVEL = 100, 8 << 20, 64 << 10, 8 << 20, 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "path string, offset long, length long, url string, digest string, page_id long, type string, refers_to long, folder string"


def record(url: str, page_id, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record of an HTTP response, or a revisit of one."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    lines += [f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record; names in lower case."""
    def fields(raw: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in raw.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)}

    head, _, rest = data.partition(b"\r\n\r\n")
    named = fields(head)
    http, _, payload = rest[: int(named["content-length"])].partition(b"\r\n\r\n")
    return named, fields(http), payload


def typed(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, and digest, type and refers_to of each row."""
    html = text_of(F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), text_of(F.col("url")).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    long = rows.where(F.octet_length("html") >= least)
    first = materialize(long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "warc-repeats")
    rows = sized_join(rows, first, "digest", "left")
    revisit = F.coalesce((F.octet_length("html") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return rows.select("page_id", "url", "html", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Write the archives; their index, a row for each record."""
    ship(pages.sparkSession)
    folder = folder or new_folder(pages.sparkSession, "warc")
    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at = None, 0
        for batch in slices(batches, "html"):
            if out is None:
                fs, root = filesystem(folder)
                fs.create_dir(root, recursive=True)
                path = f"{uuid.uuid4().hex}.warc.gz"
                out = fs.open_output_stream(f"{root}/{path}", compression=None)
            rows = []
            for r in batch.to_pylist():
                member = gzip.compress(record(r["url"], r["page_id"], r["html"].encode(), r["digest"], r["refers_to"], r["revisit"]), LEVEL, mtime=0)
                out.write(member)
                rows.append((path, at, len(member), r["url"], r["digest"], r["page_id"], "revisit" if r["revisit"] else "response", r["refers_to"], folder))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], names=names)
        if out is not None:
            out.close()

    return materialize(typed(pages, least).mapInArrow(run, INDEX), "warc-index")


def ranges(rows: list[tuple[str, int, int]], gap: int = GAP, most: int = READ) -> Iterator[tuple[str, int, int, list[int]]]:
    """(path, from, to, positions) of the joined reads of rows (path, offset, length), which come in order."""
    held = None
    for i, (path, offset, length) in enumerate(rows):
        if held and held[0] == path and offset - held[2] <= gap and offset + length - held[1] <= most:
            held[3].append(i)
            held = (path, held[1], max(held[2], offset + length), held[3])
        else:
            if held:
                yield held
            held = (path, offset, offset + length, [i])
    if held:
        yield held


def read(index: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for revisits) of the records that rows of an index name."""
    ship(index.sparkSession)
    out = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folders, paths, offsets, lengths = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("folder", "path", "offset", "length"))
            if not paths:
                continue
            fs, root = filesystem(folders[0])
            rows = list(zip(paths, offsets, lengths))
            open_path, f = None, None
            for path, begin, end, at in ranges(rows):
                if path != open_path:
                    if f is not None:
                        f.close()
                    open_path, f = path, fs.open_input_file(f"{root}/{path}")
                data, got = f.read_at(end - begin, begin), []
                for i in at:
                    member = data[offsets[i] - begin : offsets[i] - begin + lengths[i]]
                    named, http, payload = parse(zlib.decompress(member, 31))
                    number = lambda k: int(named[k]) if named.get(k) else None
                    revisit = named["warc-type"] == "revisit"
                    digest = named["warc-payload-digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
                    got.append((number("x-page-id"), named["warc-target-uri"], named["warc-type"], number("x-refers-to-page-id"), int(http["content-length"]) if revisit else len(payload), digest, None if revisit else payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names=names)
            f.close()

    segment = F.expr(f"offset div {SEGMENT}")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = index.select("folder", "path", "offset", "length").repartition(parts, "path", segment).sortWithinPartitions("folder", "path", "offset")
    return ordered.mapInArrow(run, out)


def report(pages: DataFrame) -> DataFrame:
    """Write an archive of pages and read all of it back."""
    return read(write(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: sha256 of DuckDB reads the UTF-8 bytes.
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {LEAST} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND page_id <> first THEN first END AS refers_to FROM q
"""
