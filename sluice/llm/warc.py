"""WARC archives of pages, and one index of all captures in order of URL key and time.

Writing: pages of equal payload (SMALLEST bytes or more) have one response, that of the smallest page_id; the others
become revisit records that refer to it. Each task streams its pages into gzip archives, a member for each record, on
any file system that Arrow reaches. Names hold a token of the attempt, and only archives listed by attempts that
succeeded are read, so a lost executor leaves files that nothing refers to, never a wrong record.

Reading: archives are streamed record by record; responses' digests are worked out anew from their payloads.

Index by external merge: each reading task sorts its captures into a run that is written out. Runs are cut by ranges
of key, time and id, and a task merges its range's runs through a loser tree, so each capture costs one comparison a
level of the tree. Ranges are numbered in order: (index_part, index_row) is a capture's place among all. Ranges split
a URL with very many captures too; `capture`, its number in the URL's history, adds what stands in earlier ranges.

Defined results: a null payload is empty; a null page_id is larger than any other and a page without any id is a
response; rows that repeat the response's id are responses too; a null URL has a null key, and those captures are one
history; control characters and blanks of a URL are percent-encoded; a null time is the epoch; an empty table makes
no archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, shared_folder, small

#: Payloads of fewer bytes are always responses.
SMALLEST = 100
#: Compressed bytes after which a task begins another archive.
MOST_BYTES = 1 << 30
READ_BYTES = 1 << 20
#: Rows that a cursor of a run, and a batch of merged rows, hold.
CURSOR_ROWS, OUT_ROWS = 512, 4096
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
#: Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LISTED = "file string, records long, bytes long"
CAPTURES = "page_id long, url string, captured long, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean, file string, offset long, length long"
#: The order of the index.
ORDER = ["url_key", "captured", "page_id", "file", "offset"]


def marked(pages: DataFrame, captured: Column | None = None, smallest: int = SMALLEST) -> DataFrame:
    """page_id, url, payload, captured (seconds), payload_digest, record_type and refers_to of each page."""
    payload = F.coalesce(pages["html"].cast("binary"), F.lit("").cast("binary"))
    seconds = F.coalesce(captured if captured is not None else F.lit(None), F.lit(0)).cast("long")
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"), seconds.alias("captured"), F.sha2(payload, 256).alias("payload_digest"))
    # only digests of several pages are joined, and the pages' payloads stay where they are while those are few
    alike = p.filter(F.octet_length("payload") >= smallest).groupBy(F.col("payload_digest").alias("__digest")).agg(F.count("*").alias("n"), F.min("page_id").alias("__first"))
    alike = small(cut(alike.filter("n > 1 and __first is not null").drop("n")))
    p = p.join(alike, (F.col("payload_digest") == F.col("__digest")) & (F.octet_length("payload") >= smallest), "left")
    again = F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(F.col("page_id"))
    return p.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("__first"))).drop("__digest", "__first")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id_of(said: str | None) -> int | None:
    digits = (said or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def uri(url: str) -> str:
    """The URL on one line without blanks."""
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page_id: int | None, url: str | None, payload: bytes, captured: int, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record; a revisit holds the answer's header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    at = (EPOCH + timedelta(seconds=max(0, min(captured, 253402300799)))).strftime("%Y-%m-%dT%H:%M:%SZ")
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {at}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {uri(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        part, listed, out = TaskContext.get().partitionId(), [], None
        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        name = f"{part:06d}-{len(listed):04d}-{uuid.uuid4().hex[:12]}.warc.gz"
                        out = where.open_output_stream(f"{path}/{name}", compression=None)
                        listed.append([name, 0, 0])
                    packer = zlib.compressobj(5, wbits=31)
                    member = packer.compress(record(*row)) + packer.flush()
                    out.write(member)
                    listed[-1][1] += 1
                    listed[-1][2] += len(member)
                    if listed[-1][2] >= most_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in listed], pa.string()), pa.array([x[1] for x in listed], pa.int64()), pa.array([x[2] for x in listed], pa.int64())], ["file", "records", "bytes"])

    return run


def written(pages: DataFrame, folder: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Writes marked pages to archives in folder; the list of archives (file, records, bytes), kept there as Parquet."""
    spark = pages.sparkSession
    _folder(spark, folder)
    p = pages.select("page_id", "url", "payload", "captured", "payload_digest", "record_type", "refers_to")
    p.mapInArrow(_write(folder, most_bytes), LISTED).write.parquet(f"{folder}/archives")
    return spark.read.parquet(f"{folder}/archives")


def _folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def members(stream: Any) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member; one member is in memory at a time."""
    offset, data = 0, b""
    while data or (data := stream.read(READ_BYTES)):
        unpacker, parts, length = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not data and not (data := stream.read(READ_BYTES)):
                raise ValueError(f"the archive ends within the record at {offset}")
            parts.append(unpacker.decompress(data))
            length += len(data) - len(unpacker.unused_data)
            data = unpacker.unused_data
        yield offset, length, b"".join(parts)
        offset += length


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:n]


def capture(content: bytes) -> tuple[Any, ...]:
    """page_id, url, captured, record_type, payload_bytes, payload_digest, refers_to and intact of a record."""
    fields, block = parsed(content)
    http, _, payload = block.partition(b"\r\n\r\n")
    said = fields["warc-payload-digest"].removeprefix("sha256:")
    at = int((datetime.fromisoformat(fields["warc-date"]) - EPOCH).total_seconds())
    kind = fields["warc-type"]
    if kind == "revisit":
        length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
        return _id_of(fields["warc-record-id"]), fields.get("warc-target-uri"), at, kind, length, said, _id_of(fields["warc-refers-to"]), True
    digest = hashlib.sha256(payload).hexdigest()
    return _id_of(fields["warc-record-id"]), fields.get("warc-target-uri"), at, kind, len(payload), digest, None, digest == said


def _read(folder: str):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in CAPTURES.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(folder)
        rows = []
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with where.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for offset, length, content in members(stream):
                        rows.append((*capture(content), name, offset, length))
                        if len(rows) >= OUT_ROWS:
                            yield packed(rows)
                            rows = []
        yield packed(rows)

    return run


def read(archives: DataFrame, folder: str) -> DataFrame:
    """The captures of the listed archives, an archive a task as far as there are tasks."""
    return archives.select("file").repartition(max(1, archives.count())).mapInArrow(_read(folder), CAPTURES)


def url_key(url: Column) -> Column:
    """The URL with its host's labels turned round; scheme, www, usual ports and the fragment don't count."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), r"^www[0-9]*\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(rest, "^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))


class LoserTree:
    """Merges sorted runs: each inner node remembers the loser of its match, so a new key plays against one node a level."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.keys = [self._next(i) for i in range(self.k)]
        self.losers = [0] * self.k
        self.winner = self._first(1) if self.k > 1 else 0

    def _next(self, i: int) -> tuple:
        key = next(self.runs[i], None)
        return (1,) if key is None else (0, key)

    def _first(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._first(2 * node), self._first(2 * node + 1)
        best, self.losers[node] = (b, a) if self.keys[b] < self.keys[a] else (a, b)
        return best

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.keys[self.winner][0] == 0:
            best = self.winner
            yield self.keys[best][1]
            self.keys[best] = self._next(best)
            node = (best + self.k) // 2
            while node:
                other = self.losers[node]
                if self.keys[other] < self.keys[best]:
                    best, self.losers[node] = other, best
                node //= 2
            self.winner = best


def _keys(table: pa.Table | pa.RecordBatch, start: int, end: int) -> Iterator[tuple]:
    """The comparable keys of rows, each with its row number; nulls come first."""
    for at in range(start, end, CURSOR_ROWS):
        columns = [table.column(c).slice(at, min(CURSOR_ROWS, end - at)).to_pylist() for c in ORDER]
        for i, (key, captured, page_id, file, offset) in enumerate(zip(*columns, strict=True), at):
            yield (key is not None, key or "", captured, page_id is not None, page_id or 0, file, offset), i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's runs in one order. A run begins wherever a row is less than the row before it."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    starts, before = [], None
    for key, i in _keys(table, 0, table.num_rows):
        if before is None or key < before:
            starts.append(i)
        before = key
    merged = iter(LoserTree([_keys(table, a, b) for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True)]))
    part, done, last, nth = TaskContext.get().partitionId(), 0, None, 0
    while done < table.num_rows:
        rows, numbers = [], []
        for key, i in merged:
            nth = nth + 1 if key[:2] == last else 1
            last = key[:2]
            rows.append(i)
            numbers.append(nth)
            if len(rows) == OUT_ROWS:
                break
        for batch in table.take(pa.array(rows)).combine_chunks().to_batches():
            extra = [pa.array([part] * len(rows), pa.int32()), pa.array(range(done, done + len(rows)), pa.int64()), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "index_part", "index_row", "__nth"])
        done += len(rows)


def indexed(captures: DataFrame, folder: str) -> DataFrame:
    """captures with url_key, their place in the whole order (index_part, index_row) and in their URL's history (capture)."""
    spark = captures.sparkSession
    keyed = captures.withColumn("url_key", url_key(F.col("url")))
    keyed.sortWithinPartitions(*ORDER).write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    kind = ", ".join([CAPTURES, "url_key string", "index_part int", "index_row long", "__nth long"])
    runs.repartitionByRange(*ORDER).mapInArrow(_merge, kind).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    # a range's first URL may go on from earlier ranges: a row for each range, not for each URL
    firsts = index.filter("index_row = 0").select("index_part", "url_key")
    spanning = firsts.select(F.col("url_key").alias("__url")).distinct()
    here = index.join(small(spanning), F.col("url_key").eqNullSafe(F.col("__url"))).groupBy("index_part", "__url").agg(F.max("__nth").alias("n"))
    earlier = here.select(F.col("index_part").alias("__part"), "__url", F.coalesce(F.sum("n").over(Window.partitionBy("__url").orderBy("index_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__earlier"))
    met = index.join(small(earlier), (F.col("index_part") == F.col("__part")) & F.col("url_key").eqNullSafe(F.col("__url")), "left")
    return met.withColumn("capture", F.col("__nth") + F.coalesce("__earlier", F.lit(0))).drop("__nth", "__part", "__url", "__earlier")


#: Pages have no time; this one grows with the id (a fixed rule of the query, from 2020-09-13 on).
FIRST_SECOND, SECONDS = 1_600_000_000, 1_000_000_000


def archived(pages: DataFrame) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads them back through the index."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    captured = F.pmod(F.coalesce(pages["page_id"].cast("long"), F.lit(0)), F.lit(SECONDS)) + FIRST_SECOND
    archives = written(marked(pages, captured), folder)
    return indexed(read(archives, folder), folder)


#: The query's columns in SQL for DuckDB.
ORACLE = r"""
with p as (select page_id, url, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest, coalesce(page_id, 0) % 1000000000 + 1600000000 as captured,
    regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*', '') as rest from pages),
q as (select *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), '^www[0-9]*\.', ''), ':(80|443)$', '') as host, regexp_replace(rest, '^[^/?]*', '') as path,
    case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from p),
k as (select *, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || case when path = '' then '/' else path end as url_key, first is not null and first is distinct from page_id as again from q)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then first end as refers_to,
    url_key, row_number() over (partition by url_key order by captured, page_id nulls first) as capture from k"""
