"""WARC archives: written through Spark's committer, indexed first, read back by ranges.

Every record is a gzip member of its own (the usual layout of ``.warc.gz``), so it can be
read alone.  Tasks build the members; Spark's text writer puts them into files: a member
ends in a zero byte, which is the writer's line separator, so the files hold the members
and nothing else, and a lost or repeated task leaves no half archive.

The index has a row per record (file, offset, length, URL, digest, type).  Selected
records are dealt by file, sorted by offset, and neighbouring ranges are read together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mcrunstat.llm.common import n_partitions, stored

BLOCK = 1 << 20
DATE = "1970-01-01T00:00:00Z"


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = c.compress(data) + c.flush()
    # the last byte is the top of the size: not zero only from 16 MiB on
    return out if out[-1] == 0 else out + _gzip(b"")


def _header(fields: list[tuple[str, object]]) -> bytes:
    clean = lambda v: str(v).replace("\r", "%0D").replace("\n", "%0A").replace("\0", "%00")
    return b"WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def _record(kind: str, page_id, url, digest: str, size: int, payload: bytes, refers_to=None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    return _gzip(_header([
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None),
        ("WARC-Refers-To", None if kind != "revisit" else f"<urn:page:{'none' if refers_to is None else refers_to}>"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ]) + block + b"\r\n\r\n")


def write(pages: DataFrame, folder: str, least: int = 100) -> None:
    """An archive of one record per row of ``pages`` (page_id, url, html; null html: empty).

    Of rows with equal payloads of at least ``least`` bytes the smallest page_id (then the
    smallest url) is the response and the others revisit it; exactly one row is the
    response even where rows repeat.  A null page_id sorts after all others and is read
    back as null.  Payloads are gathered nowhere: the equal ones meet as digests.
    """
    rows = pages.select("page_id", "url", "html")
    slim = rows.select("page_id", "url", F.octet_length("html").alias("n"), F.sha2("html", 256).alias("digest"))
    by_id = slim.filter(F.col("n") >= least).groupBy("digest", "page_id").agg(F.count("*").alias("k"))
    first = (by_id.groupBy("digest").agg(F.sum("k").alias("copies"), F.min(F.struct(
        F.col("page_id").isNull().alias("none"), "page_id", "k")).alias("first")).filter("copies > 1")
        .select("digest", F.col("first.page_id").alias("first"), (F.col("first.k") > 1).alias("tied")))
    first = stored(first, "warc-first")

    def build(it):
        for b in it:
            out = []
            for page_id, url, html in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "html")]):
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                out.append((digest, page_id, url, len(payload), _record("response", page_id, url, digest, len(payload), payload)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*out)) or [[]] * 5, types)],
                                             ["digest", "page_id", "url", "n", "record"])

    kind = pages.schema["page_id"].dataType.simpleString()
    types = [pa.string(), pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64(), pa.string(),
             pa.int64(), pa.binary()]
    records = rows.mapInArrow(build, f"digest string, page_id {kind}, url string, n long, record binary")
    joined = records.join(first, "digest", "left").withColumn(
        "least", F.col("page_id").eqNullSafe(F.col("first")) & F.col("tied").isNotNull())
    # rows that repeat a response's page_id: the first by url stays the response, decided on
    # slim rows.  Of equal ones any record serves, so one is kept, and the rest come from the slim rows.
    if not first.filter("tied").isEmpty():
        is_tied = F.col("least") & F.coalesce("tied", F.lit(False))
        same = F.col("url").eqNullSafe(F.col("first_url"))
        ties = (slim.join(first.filter("tied"), "digest").filter(F.col("page_id").eqNullSafe(F.col("first")))
                .withColumn("row", F.monotonically_increasing_id()))
        ties = stored(ties, "warc-ties")
        urls = stored(ties.groupBy("digest").agg(F.min(F.struct(F.col("url").isNotNull(), "url", "row")).alias("u"))
                      .select("digest", F.col("u.url").alias("first_url"), F.col("u.row").alias("first_row")), "warc-urls")
        tied = joined.filter(is_tied).join(urls, "digest")
        response = tied.filter(same).dropDuplicates(["digest"]).select(joined.columns)
        others = tied.filter(~same).withColumn("least", F.lit(False)).select(joined.columns)
        equal = (ties.join(urls, "digest").filter(same & (F.col("row") != F.col("first_row")))
                 .withColumns({"record": F.lit(None).cast("binary"), "least": F.lit(False)}).select(joined.columns))
        joined = joined.filter(~is_tied).unionByName(response).unionByName(others).unionByName(equal)

    def finish(it):
        for b in it:
            cols = zip(*[b.column(c).to_pylist() for c in ("digest", "page_id", "url", "n", "first", "tied", "least")])
            out = [r if tied is None or least_ else _record("revisit", page_id, url, digest, n, b"", first_)
                   for r, (digest, page_id, url, n, first_, tied, least_) in zip(b.column("record").to_pylist(), cols)]
            yield pa.RecordBatch.from_arrays([pa.array([r[:-1] for r in out], pa.binary())], ["value"])

    (joined.mapInArrow(finish, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\0").text(folder))


def _open(path: str):
    fs, name = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(name)


def _members(read, size: int) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a stream of ``size`` bytes; empty
    members belong to the record before."""
    held, at, taken = b"", 0, 0
    begin, content = 0, None
    while at < size:
        d, parts = zlib.decompressobj(31), []
        start = at
        while not d.eof:
            if not held:
                held = read(BLOCK)
                if not held:
                    raise EOFError("archive ends inside a record")
                taken += len(held)
            parts.append(d.decompress(held))
            held = d.unused_data
        at = taken - len(held)
        part = b"".join(parts)
        if part:
            if content is not None:
                yield begin, start - begin, content
            begin, content = start, part
    if content is not None:
        yield begin, size - begin, content


def _parse(record: bytes) -> tuple[dict, bytes]:
    """Header fields and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _id(urn: str | None) -> str | None:
    value = None if urn is None else urn[len("<urn:page:"):-1]
    return None if value == "none" else value


INDEX = ("file string, offset long, length long, url string, digest string, record_type string, page_id string, "
         "refers_to string")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The stored index of an archive: each file is scanned once, in one stream."""
    files = (spark.read.format("binaryFile").load(folder).select("path", "length").filter("length > 0")
             .repartition(n_partitions(spark), "path"))

    def scan(it):
        for b in it:
            for path, size in zip(b.column("path").to_pylist(), b.column("length").to_pylist()):
                out = []
                with _open(path) as f:
                    for offset, length, content in _members(f.read, size):
                        h, _ = _parse(content)
                        out.append((path, offset, length, h.get("WARC-Target-URI"), h["WARC-Payload-Digest"][7:],
                                    h["WARC-Type"], _id(h["WARC-Record-ID"]), _id(h.get("WARC-Refers-To"))))
                        if len(out) == 10_000:
                            yield _batch(out)
                            out = []
                if out:
                    yield _batch(out)

    def _batch(out):
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                          [c.split()[0] for c in INDEX.split(", ")])

    return stored(files.mapInArrow(scan, INDEX), "warc-index")


def read(selected: DataFrame, gap: int = 1 << 16, most: int = 8 << 20) -> DataFrame:
    """The records of rows of an index with their payload and its digest as read.

    Rows are dealt by file and sorted by offset; ranges with at most ``gap`` bytes between
    them are read in one piece of up to ``most`` bytes (or one record).
    """
    names = [c.split()[0] for c in INDEX.split(", ")]

    def fetch(rows):
        """Rows of one piece: one read, then each record on its own."""
        begin, end = rows[0][1], rows[-1][1] + rows[-1][2]
        with _open(rows[0][0]) as f:
            f.seek(begin)
            piece = f.read(end - begin)
        for r in rows:
            part = piece[r[1] - begin: r[1] - begin + r[2]]
            d = zlib.decompressobj(31)
            _, payload = _parse(d.decompress(part))
            yield (*r, payload, hashlib.sha256(payload).hexdigest())

    def run(it):
        held = []
        for b in it:
            for r in zip(*[b.column(c).to_pylist() for c in names]):
                if held and (r[0] != held[0][0] or r[1] - (held[-1][1] + held[-1][2]) > gap
                             or r[1] + r[2] - held[0][1] > most):
                    yield _out(list(fetch(held)))
                    held = []
                held.append(r)
        if held:
            yield _out(list(fetch(held)))

    def _out(rows):
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                          [*names, "payload", "read_digest"])

    return (selected.select(*names).repartition(n_partitions(selected.sparkSession), "file")
            .sortWithinPartitions("file", "offset")
            .mapInArrow(run, INDEX + ", payload binary, read_digest string"))


def captures(records: DataFrame) -> DataFrame:
    """One row per record as read: size and digest of the full payload, a revisit's taken
    from the response that it refers to."""
    slim = records.select("page_id", "url", "record_type", "refers_to", "digest", "read_digest",
                          F.octet_length("payload").cast("long").alias("n"))
    slim = stored(slim, "warc-read")
    own = slim.filter("record_type = 'response'").select(
        "page_id", "url", "record_type", "refers_to", F.col("n").alias("payload_bytes"),
        F.col("read_digest").alias("payload_digest"))
    revisits = slim.filter("record_type = 'revisit'").select("page_id", "url", "record_type", "refers_to", "digest")
    # of the responses, only those that a revisit names; small payloads may repeat a digest
    of = (slim.filter("record_type = 'response'").join(revisits.select("digest").distinct(), "digest", "left_semi")
          .groupBy("read_digest").agg(F.max("n").alias("payload_bytes")))
    full = revisits.join(of, revisits.digest == of.read_digest).select(
        "page_id", "url", "record_type", "refers_to", "payload_bytes", F.col("read_digest").alias("payload_digest"))
    return own.unionByName(full)
