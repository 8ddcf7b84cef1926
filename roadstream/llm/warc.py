"""Web archives: records written and read back, and their index by external merging.

Archives are WARC 1.1 files in a shared folder, every record a gzip member of its own, so
that one is read from its offset alone. An archive closes at ``ARCHIVE_BYTES``. Spark's
writers and readers move them, so any file system of the cluster will do (the text writer
names them ``.txt``). Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes only
the one with the largest id is stored (``response``), the others refer to it (``revisit``).

Each archive gives a run of captures sorted by URL key and time. Range partitioning
cuts the runs at common borders; each task merges the pieces of the runs in its range
with a loser tree, as they come and without another sort, so that the ranges one after
the other are the captures in order.

Rows: a null html is an empty payload; a null URL has an empty key and sorts first.
Rows with a null id are revisits where the payload has a response, else responses.
Repeated rows give a record each; those with the group's largest id are all responses.
A page of any length is one record, in an archive by itself if it is above the bound. No
pages give no archive and no capture. Other columns are ignored.
"""

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadstream.llm.store import small_batches, stored
from roadstream.operators.sizes import dimension_join

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20  # compressed; an archive is one cell where it is written and read
CHUNK = 1 << 16
CAPTURES_PER_RANGE = 200_000
FIRST_DATE = "2024-01-01"

CAPTURE = (
    "url_key string, captured string, page_id long, url string, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, archive string, at long, span long"
)
ORDER = ("url_key", "captured", "page_id", "at")


def with_record_types(pages: DataFrame) -> DataFrame:
    """Adds ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``.

    Only digests that occur twice are joined back, without the payloads of others.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    digested = pages.select("page_id", "url", "html").withColumns(
        {
            "payload_bytes": F.octet_length(payload).cast("long"),
            "payload_digest": F.sha1(payload.cast("binary")),
        }
    )
    repeated = stored(
        digested.filter(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    found = dimension_join(digested, repeated, "payload_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return found.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit, F.col("_first")),
        }
    ).drop("_first")


def record_text(date: Column) -> Column:
    """A WARC record from the columns of ``with_record_types``."""
    line = F.lit("\r\n")
    payload = F.coalesce(F.col("html"), F.lit(""))
    is_revisit = F.col("record_type") == "revisit"
    stored_payload = F.when(is_revisit, "").otherwise(payload)
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
        stored_payload,
    )
    uri = F.col("url")
    for mark, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        uri = F.replace(uri, F.lit(mark), F.lit(code))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, line), F.lit(""))

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.coalesce(urn("page_id"), F.lit("<urn:page:>"))),
        field("WARC-Date", date),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Profile", F.when(is_revisit, profile)),
        field("WARC-Refers-To", F.when(is_revisit, urn("refers_to"))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        line,
        block,
        F.lit("\r\n\r\n"),
    )


def default_date() -> Column:
    """A capture time for tables without one: a second a page, by id."""
    seconds = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)).cast("long"), F.lit(10**9))
    time = F.expr(f"timestamp_ntz'{FIRST_DATE}'") + F.make_dt_interval(secs=seconds)
    return F.concat(F.replace(time.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def member(record: bytes) -> bytes:
    """A record as a gzip member that ends with a zero byte.

    A member ends with the high byte of its length, which is zero below 16 MB; above, an
    empty member follows.
    """
    packed = gzip.compress(record, 6, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", mtime=0)


def write_archives(
    pages: DataFrame,
    folder: str,
    date: Column | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """One record for each row of ``pages`` (page_id, url, html) below ``folder``.

    The line end that the text writer adds is the zero byte that archives end with.
    """
    small_batches(pages.sparkSession)
    text = record_text(default_date() if date is None else date)

    def packed(batches):
        members, size = [], 0

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(members)[:-1]])], ["value"])

        for batch in batches:
            for record in batch.column(0):
                own = member(record.as_py())
                if members and size + len(own) > archive_bytes:
                    yield archive()
                    members, size = [], 0
                members.append(own)
                size += len(own)
        if members:
            yield archive()

    (
        with_record_types(pages)
        .select(text.cast("binary").alias("record"))
        .mapInArrow(packed, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


def members_of(content: bytes, start: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and plain bytes of each gzip member from ``start`` on."""
    view = memoryview(content)
    while start < len(view):
        unpack, at, plain = zlib.decompressobj(31), start, []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError(f"cut off gzip member at {start}")
            plain.append(unpack.decompress(view[at : at + CHUNK]))
            at += CHUNK
        end = min(at, len(view)) - len(unpack.unused_data)
        yield start, end - start, b"".join(plain)
        start = end


def record_fields(plain: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at a place, and the place after it."""
    if not plain.startswith(b"WARC/", at):
        raise ValueError("no WARC record")
    body = plain.index(b"\r\n\r\n", at) + 4
    headers = {}
    for line in plain[at:body].split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers[name.lower()] = value.strip()
    end = body + int(headers["content-length"])
    return headers, plain[body:end], end + 4


def parse_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset and length of the member, headers and block of each record of an archive."""
    for offset, span, plain in members_of(content):
        at = 0
        while at < len(plain):
            headers, block, at = record_fields(plain, at)
            yield offset, span, headers, block


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the last on, then the path, in lower case."""
    rest = (url or "").lower().partition("://")
    rest = (rest[2] if rest[1] else rest[0]).partition("#")[0]
    if not rest:
        return ""
    host, slash, path = rest.partition("/")
    labels = host.removeprefix("www.").partition(":")[0].split(".")
    return ",".join(reversed(labels)) + ")" + (slash + path if path else "/")


def _page_number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _http_body(block: bytes) -> tuple[int, bytes]:
    """Length of the whole payload by the HTTP header, and what is stored of it."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = [line.partition(b":") for line in head.split(b"\r\n")]
    length = next(int(v) for n, _, v in fields if n.lower() == b"content-length")
    return length, body


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content")


PAYLOADS = "page_id long, record_type string, payload binary"


def _payload_batches(records) -> Iterator[pa.RecordBatch]:
    """(headers, block) of records as batches of ``PAYLOADS``, some MB at a time."""

    def batch(rows):
        columns = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.string(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["page_id", "record_type", "payload"])

    rows, size = [], 0
    for headers, block in records:
        payload = _http_body(block)[1]
        rows.append((_page_number(headers["warc-record-id"]), headers["warc-type"], payload))
        size += len(payload) + 100
        if size > ARCHIVE_BYTES:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id``, ``record_type`` and the stored ``payload`` of every record."""

    def rows(batches):
        for batch in batches:
            for content in batch.column("content"):
                yield from _payload_batches(r[2:] for r in parse_records(content.as_py()))

    return _archives(spark, folder).mapInArrow(rows, PAYLOADS)


def payloads_at(spark: SparkSession, folder: str, captures: DataFrame) -> DataFrame:
    """The ``read_payloads`` of some captures of the index, unpacking their members alone.

    A task has the places in one archive, of which there are as many as records at most.
    """
    places = captures.groupBy("archive").agg(F.sort_array(F.collect_set("at")).alias("places"))
    files = _archives(spark, folder).withColumn("archive", F.element_at(F.split("path", "/"), -1))

    def rows(batches):
        for batch in batches:
            for content, own in zip(batch["content"], batch["places"], strict=True):
                whole = content.as_py()
                found = (next(members_of(whole, at))[2] for at in own.as_py())
                yield from _payload_batches(record_fields(plain)[:2] for plain in found)

    chosen = files.join(places, "archive").select("content", "places")
    return chosen.mapInArrow(rows, PAYLOADS)


def _sort_key(row: tuple) -> tuple:
    """Order of captures; null ids come first."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[9]


def capture_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures (``CAPTURE``) of every archive, each archive's as a sorted run.

    Length and digest of a response are taken from its payload, and must agree with its
    headers; those of a revisit are in its headers.
    """
    names = [c.split()[0] for c in CAPTURE.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64()}
    types = [kinds[c.split()[1]] for c in CAPTURE.split(", ")]

    def capture(path: str, offset: int, span: int, headers: dict[str, str], block: bytes) -> tuple:
        length, body = _http_body(block)
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        if headers["warc-type"] == "response":
            if len(body) != length or hashlib.sha1(body).hexdigest() != digest:
                raise ValueError(f"damaged record at {offset} of {path}")
        return (
            url_key(headers.get("warc-target-uri")),
            headers["warc-date"],
            _page_number(headers["warc-record-id"]),
            headers.get("warc-target-uri"),
            headers["warc-type"],
            _page_number(headers.get("warc-refers-to")),
            length,
            digest,
            path.rpartition("/")[2],
            offset,
            span,
        )

    def rows(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                run = [capture(path.as_py(), *r) for r in parse_records(content.as_py())]
                run.sort(key=_sort_key)
                columns = list(zip(*run, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
                )

    return _archives(spark, folder).mapInArrow(rows, CAPTURE)


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """The rows of sorted runs in order, by a loser tree.

    An inner node keeps the run that lost there; the winner's next row is played only
    against the losers on its way to the root. On ties the earlier run wins.
    """
    k = len(runs)
    if not k:
        return
    at = [0] * k
    heads = [_sort_key(run[0]) if run else None for run in runs]

    def wins(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[a] is not None
        return (heads[a], a) < (heads[b], b)

    losers, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if wins(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while heads[best] is not None:
        run = runs[best]
        yield run[at[best]]
        at[best] += 1
        heads[best] = _sort_key(run[at[best]]) if at[best] < len(run) else None
        node = (best + k) // 2
        while node:
            if wins(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2


def sorted_stretches(rows: Iterator[tuple]) -> list[list[tuple]]:
    """The rows cut where one does not come after the row before it.

    A run that arrives in its order is one stretch; a run cut up or mixed with others on
    the way gives several, which merge as well.
    """
    out, last = [], None
    for row in rows:
        key = _sort_key(row)
        if last is None or key < last:
            out.append([])
        out[-1].append(row)
        last = key
    return out


def capture_index(runs: DataFrame, captures_per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """All captures with their ``position``, from 0, in global order.

    A range holds about ``captures_per_range`` rows without payloads at most; the order
    includes the time and the id, so a URL of any number of captures is cut too. Each
    task numbers its range; the counts of the ranges, a row for each, add up the rest.
    """
    spark = runs.sparkSession
    runs = stored(runs)
    wanted = -(-runs.count() // captures_per_range)
    ranges = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = f"{CAPTURE}, place long"
    names = [c.split()[0] for c in schema.split(", ")]

    def merged(batches):
        types = []

        def received():
            for batch in batches:
                types[:] = batch.schema.types
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        block = []
        for place, row in enumerate(merge_runs(sorted_stretches(received()))):
            block.append((*row, place))
            if len(block) == 10_000:
                yield _rows(block, [*types, pa.int64()], names)
                block = []
        if block:
            yield _rows(block, [*types, pa.int64()], names)

    ranged = runs.repartitionByRange(ranges, *(F.col(c).asc_nulls_first() for c in ORDER))
    placed = stored(ranged.mapInArrow(merged, schema).withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    )
    counted = dimension_join(placed, before, "part", rows_at_most=ranges)
    position = (F.col("before") + F.col("place")).alias("position")
    return counted.select(*names[:-1], position)


def _rows(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)
