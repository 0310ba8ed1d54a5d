"""WARC 1.1 archives: writing captures, reading records, assembling transactions.

A capture is a request, a response (or a revisit, where an equal payload is stored elsewhere) and a
metadata record, tied together by ``WARC-Concurrent-To``. Spark's own text writer lays the records
down, so any file system will do and a lost executor's files are written again by its committer.

Cases, by definition: a null html is an empty payload; null urls are written as an empty target, null
ids as an empty field, and both come back as nulls; payloads under ``least`` bytes are never revisits;
of equal payloads every row with the largest id is a response and rows without ids revisit it; where
no row of them has an id all are responses; repeated rows share record ids and are paired by
their order within a file, one capture for each; a record without a partner makes a capture with nulls in its
place; no pages make no captures; extra columns are left alone.
"""

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialize

LEAST = 1000
#: Payload bytes of an archive file, about.
FILE_BYTES = 16 << 20
#: Archives of more bytes are not loaded by Spark but read as streams by the workers.
WHOLE = 128 << 20
#: A fixed date, so that rewriting the same pages gives the same archives.
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
RECORD = "record_id string, type string, concurrent_to array<string>, refers_to string, target string, payload_digest string, fields map<string,string>, payload_bytes long, payload binary, file string, place long"


def _urn(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def _header(kind: str, record: Column, more: list[tuple[str, Column | None]], block: Column) -> Column:
    """A record up to, not with, the blank lines that end it; fields whose column is null are left out."""
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Date: {DATE}{CRLF}WARC-Record-ID: "), record, F.lit(CRLF)]
    for name, value in more:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)


def plan_captures(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """``id, url, html, digest, size`` and ``refers_id``: the id of the response that a row revisits, else null."""
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html").cast("long")})
    shared = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1 and top is not null")
    shared = materialize(shared.select(F.col("digest").alias("_d"), "top"), "warc-shared")
    out = rows.join(shared, (F.col("digest") == F.col("_d")) & (F.col("size") >= least), "left")
    # one row of a hot digest may be any of many: the join is plain, so adaptive execution splits it
    return out.select("id", "url", "html", "digest", "size", F.when(F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_id"))


def write_warc(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, file_bytes: int = FILE_BYTES) -> None:
    """Write a transaction of three records for each page under ``path``."""
    plan = plan_captures(pages, id, url, html, least)
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    response, request, meta = _urn("response", F.col("id"), F.col("digest")), _urn("request", F.col("id"), F.col("digest")), _urn("metadata", F.col("id"), F.col("digest"))
    origin = F.when(F.col("refers_id").isNotNull(), _urn("response", F.col("refers_id"), F.col("digest")))
    page = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"), F.col("html"))
    head = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    common = [("WARC-Target-URI", target), ("WARC-Payload-Digest", digest)]
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    full = _header("response", response, [*common, ("Content-Type", F.lit("application/http; msgtype=response"))], page)
    again = _header("revisit", response, [*common, ("WARC-Refers-To", origin), ("WARC-Profile", profile), ("Content-Type", F.lit("application/http; msgtype=response"))], head)
    get = F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    asked = _header("request", request, [("WARC-Target-URI", target), ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/http; msgtype=request"))], get)
    text = F.concat(
        F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(f"{CRLF}payload-bytes: "), F.col("size").cast("string"),
        F.coalesce(F.concat(F.lit(f"{CRLF}refers-to-page: "), F.col("refers_id").cast("string")), F.lit("")), F.lit(CRLF),
    )
    noted = _header("metadata", meta, [("WARC-Target-URI", target), ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/warc-fields"))], text)
    records = plan.select(F.array(asked, F.when(origin.isNull(), full).otherwise(again), noted).alias("r")).select(F.explode("r").alias("value"))
    mean = pages.agg(F.avg(F.octet_length(html))).first()[0] or 0
    # files hold about file_bytes: a reader takes one whole
    per_file = max(3, int(3 * file_bytes / (mean + 1000)) // 3 * 3)
    records.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path)


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields (lower-cased names) and block of each record, by Content-Length, never by separators.

    One record is held at a time; anything but whole records is an error that names the record's number.
    """
    count = 0
    while True:
        line = stream.readline()
        while line == CRLF.encode():
            line = stream.readline()
        if not line:
            return
        count += 1
        head = b""
        if line.startswith(b"WARC/"):
            while (line := stream.readline()) not in (CRLF.encode(), b""):
                head += line
        if line != CRLF.encode():
            raise ValueError(f"no WARC record in place {count}")
        fields: dict[str, list[str]] = {}
        for m in _FIELD.finditer(head):
            fields.setdefault(m[1].decode("utf-8", "replace").strip().lower(), []).append(m[2].decode("utf-8", "replace").strip())
        size = int(fields["content-length"][0])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"WARC record in place {count} is cut short")
        yield fields, block


def _plain(stream: BinaryIO) -> BinaryIO:
    """``stream``, which can be peeked into, decompressed if it is gzip of any number of members."""
    return gzip.GzipFile(fileobj=stream) if stream.peek(2)[:2] == b"\x1f\x8b" else stream


def _open(path: str) -> BinaryIO:
    """A stream over a file of any size, from this worker."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    files, at = fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + quote(rest, safe="/:@"))
    return io.BufferedReader(files.open_input_stream(at, compression=None), 1 << 20)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("target", pa.string()), ("payload_digest", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("file", pa.string()), ("place", pa.int64()),
    ])
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, held = [], 0
            stream = io.BufferedReader(io.BytesIO(data.as_py())) if data.is_valid else _open(path)
            for place, (fields, block) in enumerate(parse_records(_plain(stream))):
                one = lambda name, fields=fields: (fields.get(name) or [None])[0] or None
                kind, notes, payload = one("warc-type"), {}, block
                if kind in ("response", "revisit", "request") and (one("content-type") or "").startswith("application/http"):
                    cut = block.find(b"\r\n\r\n")
                    payload = block[cut + 4 :] if cut >= 0 else b""
                elif kind == "metadata":
                    notes = {m[1].decode("utf-8", "replace"): m[2].decode("utf-8", "replace") for m in _FIELD.finditer(block)}
                rows.append((one("warc-record-id"), kind, fields.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), one("warc-payload-digest"), list(notes.items()), len(payload), payload, path, place))
                held += len(block) + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows, held = [], 0
            stream.close()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def read_warc(spark: SparkSession, path: str, whole: int = WHOLE) -> DataFrame:
    """One row per record of the archives under ``path``, plain or gzip.

    Files of at most ``whole`` bytes come through Spark, a scan task's share of them in memory at once. Larger
    ones are opened by the workers, which must reach the file system through Arrow, and held a record at a time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    records = files.where(F.col("length") <= whole).select("path", "content").mapInArrow(_read_batches, RECORD)
    large = files.where(F.col("length") > whole).select("path")
    if large.isEmpty():
        return records
    # dealt singly, as a scan would pack files into tasks by their bytes
    large = large.repartition("path").withColumn("content", F.lit(None).cast("binary"))
    return records.unionByName(large.mapInArrow(_read_batches, RECORD))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id``, ``response`` (or revisit), and arrays of its ``requests`` and ``metadata``.

    A record belongs to the response that it names as concurrent, or that names it, or that the
    request does which it names. Where a response's id is repeated, records of one file belong together, the n-th of
    each kind in it; those in files without such a response go to one file that has it. So no id, however
    often it is repeated, brings more than a file's records together.
    """
    main = F.col("type").isin("response", "revisit")
    named = F.try_element_at(F.col("concurrent_to"), F.lit(1))
    links = materialize(records.select("record_id", main.alias("main"), "concurrent_to", named.alias("named"), F.xxhash64("file").alias("at")), "warc-links")
    by_response = links.where("main").select(F.explode("concurrent_to").alias("via"), F.col("record_id").alias("to"))
    by_request = links.where("not main and named is not null and named <> record_id").select(F.col("record_id").alias("via"), F.col("named").alias("to"))
    wanted = links.where("not main").select(F.coalesce("named", "record_id").alias("want")).distinct()
    mains = links.where("main").select(F.col("record_id").alias("want"))
    wanted = wanted.join(mains, "want", "left_anti")
    hops = by_response.unionByName(by_request).join(wanted, F.col("via") == F.col("want"), "left_semi").groupBy("via").agg(F.min("to").alias("to"))
    hops = materialize(hops, "warc-hops")
    homes = links.where("main").select(F.col("record_id").alias("_key"), F.col("at").alias("_home"))
    spread = homes.groupBy("_key").agg(F.min("_home").alias("_least"), F.max("_home").alias("_last")).where("_least <> _last").drop("_last")
    spread = materialize(spread, "warc-spread")
    body = F.struct(*(c for c in records.columns if c != "concurrent_to"))
    key = F.when(main, F.col("record_id")).otherwise(F.coalesce(named, F.col("record_id")))
    kind = F.when(main, "main").when(F.col("type") == "request", "request").otherwise("metadata")
    keyed = records.select(key.alias("key"), kind.alias("kind"), "file", "place", body.alias("body"))
    if not hops.isEmpty():
        keyed = keyed.join(hops, F.col("key") == F.col("via"), "left").withColumn("key", F.coalesce("to", "key")).drop("via", "to")
    of = ["key"]
    if not spread.isEmpty():
        of = ["key", "at"]
        homes = materialize(homes.join(spread, "_key", "left_semi").distinct().withColumnRenamed("_key", "_of"), "warc-homes")
        own = F.xxhash64("file")
        keyed = keyed.join(spread, F.col("key") == F.col("_key"), "left").join(homes, (F.col("key") == F.col("_of")) & (own == F.col("_home")), "left")
        keyed = keyed.withColumn("at", F.coalesce("_home", "_least")).drop("_key", "_least", "_of", "_home")
    keyed = keyed.repartition(*of)
    count = F.sum(F.when(F.col("kind") == "main", 1).otherwise(0)).over(Window.partitionBy(*of))
    rank = F.row_number().over(Window.partitionBy(*of, "kind").orderBy("file", "place"))
    ranked = keyed.withColumns({"mains": count, "rank": rank})
    nth = F.when(F.col("kind") == "main", F.col("rank")).otherwise(F.least("rank", F.greatest("mains", F.lit(1))))
    item = F.struct("file", "place", "body")
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, item)), _by_place), lambda x: x["body"])
    return ranked.withColumn("nth", nth).groupBy(*of, "nth").agg(
        F.any_value(F.when(F.col("kind") == "main", F.col("body")), True).alias("response"), pick("request").alias("requests"), pick("metadata").alias("metadata")
    ).select(F.col("key").alias("capture_id"), "nth", "response", "requests", "metadata")


def _by_place(a: Column, b: Column) -> Column:
    return F.when(a["file"] < b["file"], -1).when(a["file"] > b["file"], 1).when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0)


def digest_of(payload: bytes) -> str:
    """Bare lower-case hex SHA-1."""
    return hashlib.sha1(payload).hexdigest()
