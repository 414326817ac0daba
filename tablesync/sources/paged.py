"""Paged endpoint scan as a Spark Python DataSource (``format("paged")``).

The driver reads page 1 of each endpoint to learn its ``total`` and how many
records a page really holds (a server may give fewer than asked), and cuts the
pages into ranges that executors fetch in parallel.  An endpoint without a
total is probed for its last page.  The last range of an endpoint stays open
until an empty page, so pages the plan did not foresee are read as well.  A scan
never loses rows silently: an empty page before a page with records or the page
cap fail it, and ``land_pages``, through which every scan here goes, fetches
each page once, keeps it as parquet and compares the sum of the page lengths
with the total, a grouped sum over three small columns.

The source yields Arrow record batches in one of two forms (``output``):

* ``pages``: one row per page with its body as fetched and the time it came;
  records are exploded and parsed on the JVM (``explode_pages``,
  ``parse_records``);
* ``records``: one row per record, its JSON text and its cursor value.  A
  filter ``cursor >= x`` is pushed to the fetcher as ``since`` (and evaluated
  again by Spark), one on ``endpoint`` leaves the others unread.  As a stream
  (``endpoint_stream``) the offset is the cursor.

The page fetcher is injected.  ``DirectoryFetcher`` reads pages laid out as
``<root>/endpoint=<e>/page=<n>/*`` -- exactly what
``bodies.write.partitionBy("endpoint", "page").text(root)`` produces -- or in
blocks of pages, as ``write_blocks`` leaves them, and
stands in for the HTTP client in tests.  Another fetcher is named with the
``fetcher`` option as ``module:factory``; the factory gets the options dict
and returns an object with ``fetch(endpoint, page, page_size, since)`` and, for
streams, ``newest(endpoint, key, since, numeric)``: the greatest key there is,
which a server answers with one record, sorted by key.
"""

from __future__ import annotations

import importlib
import json
import math
import sys
from collections.abc import Iterator
from datetime import datetime, timezone
from decimal import Decimal, InvalidOperation
from json.decoder import scanstring
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import json as pa_json
from pyspark import SparkFiles, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition)

from tablesync.functions.clean import parse_total
from tablesync.operators.cursor import delta_filter, is_number

# Fixed value: the safety cap on pages per endpoint.
MAX_PAGES = 100_000
DEFAULT_PAGE_SIZE = 5_000
PAGE_SCHEMA = "endpoint string, page int, total string, records int, fetched_at timestamp, body string"
RECORD_SCHEMA = "endpoint string, page int, total string, fetched_at timestamp, cursor string, record string"
BATCH_BYTES = 8 * 1024 * 1024   # page text gathered into one Arrow batch
# Pages are dealt in ranges of this much text, or smaller ones if there are few
# for the cores, but none under so many pages.
RANGE_BYTES = 32 * 1024 * 1024
RANGE_PAGES = 8
RANGES_PER_CORE = 3
BLOCK_PAGES = 64                # pages that ``write_blocks`` puts into one folder
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class PagingError(RuntimeError):
    """The server's pages do not add up; nothing may be published from them."""


def robust_total(raw: Any) -> int | None:
    """Driver-side twin of ``functions.parse_total`` for planning only."""
    try:
        value = float(str(raw).strip())
        if math.isnan(value) or math.isinf(value):
            return None
        n = int(value)
    except (TypeError, ValueError):
        return None
    return n if n >= 0 else None


class DirectoryFetcher:
    """Serves pages from text files: ``<root>/endpoint=<e>/page=<n>/`` has one,
    ``<root>/endpoint=<e>/block=<n div BLOCK_PAGES>/`` lines of a page number,
    a tab and the body (``write_blocks``)."""

    def __init__(self, options: dict[str, str]):
        import os

        root = options["path"]
        # ``file:`` URIs and plain folders are local; other URIs pass through.
        if root.startswith("file:"):
            root = "/" + root[len("file:"):].lstrip("/")
        self.root = root if "://" in root else os.path.abspath(root)
        self._blocks: dict[str, tuple[int, dict[int, str]]] = {}  # endpoint -> its block read last

    def fetch(self, endpoint: str, page: int, page_size: int, since: str | None) -> dict:
        text = self.fetch_text(endpoint, page, page_size, since)
        return json.loads(text) if text else {"registros": [], "total": ""}

    def fetch_text(self, endpoint: str, page: int, page_size: int, since: str | None) -> str | None:
        """The page body as fetched (None when there is no such page)."""
        n = page // BLOCK_PAGES
        if self._blocks.get(endpoint, (None,))[0] != n:
            text = next(self._texts(f"endpoint={endpoint}/page={page}"), None)
            if text:
                return text
            lines = (line.partition("\t") for text in self._texts(f"endpoint={endpoint}/block={n}")
                     for line in text.split("\n"))
            self._blocks[endpoint] = (n, {int(number): body for number, _, body in lines})
        return self._blocks[endpoint][1].get(page) or next(self._texts(f"endpoint={endpoint}/page={page}"), None)

    def _texts(self, folder: str) -> Iterator[str]:
        """The texts of a folder's files that have any, by file name."""
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(
            self.root if "://" in self.root else "file://" + self.root)
        infos = filesystem.get_file_info(pafs.FileSelector(f"{base}/{folder}", allow_not_found=True))
        for info in sorted(infos, key=lambda i: i.path):
            name = info.path.rsplit("/", 1)[-1]
            if info.type != pafs.FileType.File or name.startswith(("_", ".")):
                continue
            with filesystem.open_input_stream(info.path) as fh:
                text = fh.read().decode("utf-8").strip()
            if text:
                yield text

    def newest(self, endpoint: str, key: str, since: str | None, numeric: bool = False) -> str | None:
        """The greatest key of the pages there are (a server would sort)."""
        best, page, more = None, 1, True
        while more:
            texts, size = [], 0
            while more and size < BATCH_BYTES:
                text = self.fetch_text(endpoint, page, 0, since)
                more = text is not None
                texts += [text] if more else []
                size += len(text or "")
                page += 1
            found, ended = newest_of_pages(texts, key, numeric)
            best, more = max(best, found, key=lambda c: cursor_order(c, numeric)), more and not ended
        return best


def cursor_text(value: Any) -> str | None:
    """A key as cursor text; blank is none."""
    if value is None or value == "":
        return None
    return value if isinstance(value, str) else json.dumps(value)


def cursor_order(cursor: str | None, numeric: bool) -> tuple:
    """Sort key of cursors: none first, then as text or as numbers."""
    if cursor is None:
        return (0, 0)
    if not numeric:
        return (1, cursor)
    try:
        number = Decimal(cursor)
    except InvalidOperation:
        return (0, 0)
    return (1, number) if number.is_finite() else (0, 0)


def newest_of_pages(texts: list[str], key: str, numeric: bool) -> tuple[str | None, bool]:
    """The greatest key of page bodies up to the first without records, and
    whether there is such a one.  Keys that are all text (all whole numbers,
    when ``numeric``) are read by Arrow, others record by record."""
    if not texts:
        return None, True
    # Unescaped line ends stand between values only.
    data = "\n".join(t.replace("\n", " ").replace("\r", " ") for t in texts).encode("utf-8", "surrogatepass")
    schema = pa.schema([("registros", pa.list_(pa.struct([(key, pa.int64() if numeric else pa.string())])))])
    try:
        body = pa_json.read_json(
            pa.BufferReader(data), pa_json.ReadOptions(block_size=max(1 << 20, *(4 * len(t) + 2 for t in texts))),
            pa_json.ParseOptions(explicit_schema=schema, unexpected_field_behavior="ignore"))
    except pa.ArrowException:
        body = None
    if body is None or body.num_rows != len(texts):
        best = None
        for text in texts:
            records = json.loads(text).get("registros")
            if not records:
                return best, True
            best = max((best, *(cursor_text(r.get(key)) for r in records)), key=lambda c: cursor_order(c, numeric))
        return best, False
    lists = body["registros"].combine_chunks()
    empty = pc.index(pc.equal(pc.fill_null(pc.list_value_length(lists), 0), 0), True).as_py()
    keys = (lists if empty < 0 else lists.slice(0, empty)).flatten().field(0)
    return cursor_text(pc.max(keys).as_py()), empty >= 0


def split_page(text: str) -> tuple[list[tuple[str, Any]], Any]:
    """``([(record text, record)], total)`` of a page body; record texts are as
    fetched."""
    decode, records, total = json.JSONDecoder().raw_decode, [], None

    def blank(i: int) -> int:
        while i < len(text) and text[i] in " \t\n\r":
            i += 1
        return i

    i = blank(0)
    if i == len(text):
        return [], None
    if text[i] != "{":
        raise PagingError("a page is not a JSON object")
    i = blank(i + 1)
    while text[i] != "}":
        name, i = scanstring(text, i + 1)
        i = blank(blank(i) + 1)
        if name == "registros" and text[i] == "[":
            records, i = [], blank(i + 1)
            while text[i] != "]":
                value, end = decode(text, i)
                records.append((text[i:end], value))
                i = blank(end)
                i = blank(i + 1) if text[i] == "," else i
            i += 1
        else:
            value, i = decode(text, i)
            if name == "registros":
                records = []
            elif name == "total":
                total = value
        i = blank(i)
        i = blank(i + 1) if text[i] == "," else i
    return records, total


def _make_fetcher(options: dict[str, str]):
    spec = options.get("fetcher")
    if not spec:
        return DirectoryFetcher(options)
    module, _, attr = spec.partition(":")
    try:
        found = importlib.import_module(module)
    except ModuleNotFoundError:
        # A stream is planned by a process that lacks the files of ``addPyFile``.
        if options.get("pyfiles") in (None, *sys.path):
            raise
        sys.path.append(options["pyfiles"])
        found = importlib.import_module(module)
    return getattr(found, attr)(options)


class PageRange(InputPartition):
    """Pages ``first .. last`` of an endpoint; ``open_end``: and on until an
    empty page.  ``since`` went to the fetcher; a stream's batch also ends at
    ``until``."""

    def __init__(self, endpoint: str, first: int, last: int, open_end: bool = False, since: str | None = None,
                 until: str | None = None):
        super().__init__((endpoint, first, last))
        self.endpoint, self.first, self.last, self.open_end = endpoint, first, last, open_end
        self.since, self.until = since, until


class _Pages:
    """What batch and stream readers share: planning ranges, reading one."""

    def __init__(self, options: dict[str, str]):
        # Spark passes a case-insensitive mapping; keep a plain lower-case dict.
        self.options = {str(k).lower(): v for k, v in dict(options).items()}
        opt = self.options.get
        self.endpoints = [e for e in opt("endpoints", opt("endpoint", "")).split(",") if e]
        self.page_size = int(opt("pagesize", DEFAULT_PAGE_SIZE))
        self.pages_per_partition = int(opt("pagesperpartition", 0))  # 0: by size
        self.cores = int(opt("cores", 8))
        self.max_pages = int(opt("maxpages", MAX_PAGES))
        self.since = opt("since")
        self.output = opt("output", "pages")
        self.key = opt("replicationkey")
        self.numeric = opt("numeric", "false").lower() == "true"

    def _text(self, fetcher, endpoint: str, page: int, since: str | None) -> str | None:
        """A page's body, as fetched where the fetcher can give it."""
        if page > self.max_pages:
            raise PagingError(f"{endpoint}: more than {self.max_pages} pages; raise maxPages to read them")
        raw_text = getattr(fetcher, "fetch_text", None)
        if raw_text is None:
            return json.dumps(fetcher.fetch(endpoint, page, self.page_size, since), ensure_ascii=False)
        return raw_text(endpoint, page, self.page_size, since)

    def _rows(self, fetcher, endpoint: str, page: int, since: str | None) -> int:
        if page > self.max_pages:
            return 0
        body = json.loads(self._text(fetcher, endpoint, page, since) or "{}")
        return len(body.get("registros") or [])

    def _ranges(self, fetcher, endpoint: str, since: str | None, until: str | None = None) -> list[PageRange]:
        text = self._text(fetcher, endpoint, 1, since) or "{}"
        first = json.loads(text)
        rows, total = len(first.get("registros") or []), robust_total(first.get("total", ""))
        if not rows:
            if total:
                raise PagingError(f"{endpoint}: page 1 is empty, but the total is {total}")
            return []
        n = math.ceil(total / rows) if total else self._last_page(fetcher, endpoint, since)
        if n > self.max_pages:
            raise PagingError(f"{endpoint}: {n} pages; at most {self.max_pages} are read (maxPages)")
        step = self.pages_per_partition or max(
            RANGE_PAGES, min(RANGE_BYTES // len(text), -(-n // (RANGES_PER_CORE * self.cores))))
        out = [PageRange(endpoint, a, min(a + step - 1, n), False, since, until) for a in range(1, n + 1, step)]
        out[-1].open_end = True
        return out

    def _last_page(self, fetcher, endpoint: str, since: str | None) -> int:
        """The last page with records, by doubling and halving: a few dozen
        fetches for any length."""
        low, high = 1, 2
        while self._rows(fetcher, endpoint, high, since):
            low, high = high, high * 2
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self._rows(fetcher, endpoint, mid, since) else (low, mid)
        return low

    def plan(self, since: str | None, until: str | None = None) -> list[PageRange]:
        from concurrent.futures import ThreadPoolExecutor

        fetcher = _make_fetcher(self.options)
        # Concurrently: fetching is I/O bound.
        with ThreadPoolExecutor(max_workers=min(16, max(1, len(self.endpoints)))) as pool:
            ranges = list(pool.map(lambda e: self._ranges(fetcher, e, since, until), self.endpoints))
        return [r for rs in ranges for r in rs] or [PageRange("", 1, 0)]

    def _between(self, cursor: str | None, part: PageRange) -> bool:
        """Whether a record belongs to a stream's batch."""
        at = cursor_order(cursor, self.numeric)
        low = cursor_order(part.since, self.numeric)
        return at[0] >= low[0] and low <= at <= cursor_order(part.until, self.numeric)

    def batches(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        if not part.endpoint:
            return
        fetcher = _make_fetcher(self.options)
        schema = _ARROW[self.output]
        page, held, size = part.first, [], 0
        while part.open_end or page <= part.last:
            text = self._text(fetcher, part.endpoint, page, part.since)
            at = datetime.now(timezone.utc)
            if self.output == "pages":
                body = json.loads(text) if text else {}
                n, total = len(body.get("registros") or []), body.get("total")
                rows = [(n, at, text)]
            else:
                records, total = split_page(text or "")
                n = len(records)
                rows = []
                for raw, record in records:
                    cursor = cursor_text(record.get(self.key)) if self.key and isinstance(record, dict) else None
                    if part.until is None or self._between(cursor, part):
                        rows.append((at, cursor, raw))
            if not n:
                break
            total = None if total is None else str(total)
            held += [(part.endpoint, page, total, *r) for r in rows]
            size += len(text)
            page += 1
            if size >= BATCH_BYTES:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)
        if page <= part.last:
            # Empty within the plan: the end, if nothing follows; else a hole.
            for later in (*range(page + 1, part.last + 1), part.last + 1):
                if self._rows(fetcher, part.endpoint, later, part.since):
                    raise PagingError(f"{part.endpoint}: page {page} is empty, but page {later} has records")


_TIME = pa.timestamp("us", tz="UTC")
_ARROW = {
    "pages": pa.schema([("endpoint", pa.string()), ("page", pa.int32()), ("total", pa.string()),
                        ("records", pa.int32()), ("fetched_at", _TIME), ("body", pa.string())]),
    "records": pa.schema([("endpoint", pa.string()), ("page", pa.int32()), ("total", pa.string()),
                          ("fetched_at", _TIME), ("cursor", pa.string()), ("record", pa.string())]),
}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.pages = _Pages(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """``cursor >= x``, ``> x`` and ``= x`` bound what the fetcher asks for
        and stay with Spark, as do all others but those on ``endpoint``."""
        pages = self.pages
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("endpoint",):
                wanted = set(f.value) if isinstance(f, In) else {f.value}
                pages.endpoints = [e for e in pages.endpoints if e in wanted]
                continue
            bound = isinstance(f, (GreaterThanOrEqual, GreaterThan, EqualTo)) and f.attribute == ("cursor",)
            if bound and pages.key and not pages.numeric:
                pages.since = f.value if pages.since is None else max(pages.since, f.value)
            yield f

    def partitions(self):
        return self.pages.plan(self.pages.since)

    def read(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        return self.pages.batches(part)


class PagedStreamReader(DataSourceStreamReader):
    """The cursor is the offset: a batch holds the records from the last cursor
    (inclusive, as every incremental read here) to the newest one known when it
    was planned.  A restart asks the server from the saved cursor on."""

    def __init__(self, options: dict[str, str]):
        self.pages = _Pages(options)
        if not self.pages.key:
            raise PagingError("a stream needs the option replicationKey")
        self._last = self.pages.since

    def initialOffset(self) -> dict:
        return {"cursor": self.pages.since}

    def latestOffset(self) -> dict:
        from concurrent.futures import ThreadPoolExecutor

        fetcher = _make_fetcher(self.pages.options)
        # Concurrently, as in ``plan``.
        with ThreadPoolExecutor(max_workers=min(16, max(1, len(self.pages.endpoints)))) as pool:
            found = list(pool.map(lambda e: fetcher.newest(e, self.pages.key, self._last, self.pages.numeric),
                                  self.pages.endpoints))
        self._last = max((self._last, *found), key=lambda c: cursor_order(c, self.pages.numeric))
        return {"cursor": self._last}

    def partitions(self, start: dict, end: dict):
        low, high = (cursor_order(x["cursor"], self.pages.numeric) for x in (start, end))
        if end["cursor"] is None or high < low:
            return [PageRange("", 1, 0)]
        return self.pages.plan(start["cursor"], end["cursor"])

    def read(self, part: PageRange) -> Iterator[pa.RecordBatch]:
        return self.pages.batches(part)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return RECORD_SCHEMA if self.options.get("output") == "records" else PAGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStreamReader({**self.options, "output": "records"})


def register(spark: SparkSession) -> None:
    from tablesync.session import ship_package

    ship_package(spark)  # the reader runs on Python workers
    # A stream is planned by a process without that: the source carries its code.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedSource)
    spark.conf.set(PUSHDOWN, "true")  # off by default, and then a reader with pushFilters fails


def _options(spark: SparkSession, endpoints: list[str], path: str | None, page_size: int,
             pages_per_partition: int | None, fetcher: str | None, max_pages: int = MAX_PAGES,
             **more: str | None) -> dict[str, str]:
    out = {"endpoints": ",".join(endpoints), "pageSize": str(page_size), "maxPages": str(max_pages),
           "cores": str(spark.sparkContext.defaultParallelism), **{k: v for k, v in more.items() if v is not None}}
    if pages_per_partition:
        out["pagesPerPartition"] = str(pages_per_partition)
    if path:
        from tablesync.session import hadoop_path

        # Resolved on the driver, as Spark resolves paths.
        out["path"] = hadoop_path(spark, path)[1].toString()
    if fetcher:
        out.update(fetcher=fetcher, pyfiles=SparkFiles.getRootDirectory())
    return out


def read_pages(spark: SparkSession, endpoints: list[str], path: str | None = None,
               page_size: int = DEFAULT_PAGE_SIZE, since: str | None = None, pages_per_partition: int | None = None,
               fetcher: str | None = None, max_pages: int = MAX_PAGES) -> DataFrame:
    """One row per page, read anew by every action, lengths not compared with
    the total: for ``land_pages``."""
    register(spark)
    return spark.read.format("paged").options(**_options(
        spark, endpoints, path, page_size, pages_per_partition, fetcher, max_pages, since=since)).load()


def land_pages(pages: DataFrame) -> DataFrame:
    """Fetch every page once, into parquet under the shared checkpoint folder,
    and read it from there.  Fails if the pages of an endpoint sum up to fewer
    records than the total its first page gave."""
    from tablesync.session import scratch_dir

    path = scratch_dir(pages.sparkSession, "landed-pages") + "/pages"
    pages.write.parquet(path)
    landed = pages.sparkSession.read.schema(pages.schema).parquet(path)
    sums = (landed.groupBy("endpoint").agg(F.sum("records").alias("n"),
                                           parse_total(F.min_by("total", "page")).alias("total"))
            .where(F.col("n") < F.col("total")).orderBy("endpoint").first())
    if sums:
        raise PagingError(f"{sums.endpoint}: {sums.n} records, short of the total {sums.total}")
    return landed


def paged_scan(spark: SparkSession, endpoints: list[str], path: str | None = None,
               page_size: int = DEFAULT_PAGE_SIZE, since: str | None = None,
               pages_per_partition: int | None = None, fetcher: str | None = None,
               replication_key: str | None = None, output: str = "records",
               numeric: bool = False, max_pages: int = MAX_PAGES) -> DataFrame:
    """Records of the given endpoints as (endpoint, page, total, record JSON)
    [+ cursor_value when ``replication_key`` is given]; with
    ``output="pages"`` one row per page (endpoint, page, total, fetched_at,
    body).  The pages are landed, each fetched once.

    ``since`` goes to the fetcher, so a server can filter; with a
    ``replication_key`` the rows are also filtered here (``key >= since``, as
    numbers when ``numeric``), on the JVM."""
    pages = land_pages(read_pages(spark, endpoints, path, page_size, since, pages_per_partition, fetcher, max_pages))
    if output == "pages":
        return pages.drop("records")
    parsed = F.from_json(F.col("body"), "registros array<string>")
    rows = pages.select("endpoint", "page", "total", F.explode(parsed["registros"]).alias("record"))
    if replication_key:
        quoted = replication_key.replace("'", "\\'")
        rows = rows.withColumn("cursor_value", F.get_json_object("record", f"$['{quoted}']"))
        if since is not None:
            rows = delta_filter(rows, "cursor_value", since, numeric)
    return rows


def record_scan(spark: SparkSession, endpoints: list[str], replication_key: str | None = None,
                path: str | None = None, page_size: int = DEFAULT_PAGE_SIZE, pages_per_partition: int | None = None,
                fetcher: str | None = None, max_pages: int = MAX_PAGES) -> DataFrame:
    """Records as (endpoint, page, total, fetched_at, cursor, record JSON), not
    yet fetched: a ``where`` on ``cursor`` or ``endpoint`` decides what is asked
    of the server.  ``cursor`` is the text of ``replication_key``."""
    register(spark)
    return spark.read.format("paged").options(**_options(
        spark, endpoints, path, page_size, pages_per_partition, fetcher, max_pages, output="records",
        replicationKey=replication_key)).load()


def endpoint_stream(spark: SparkSession, endpoints: list[str], record_schema: str, replication_key: str,
                    path: str | None = None, page_size: int = DEFAULT_PAGE_SIZE, pages_per_partition: int | None = None,
                    fetcher: str | None = None, since: str | None = None, numeric_cursor: bool = False) -> DataFrame:
    """The records of the endpoints as a stream, typed by ``record_schema``,
    for ``streaming.upsert_stream.start_stream_upsert``.  Its checkpoint folder
    keeps the cursor; without one the stream starts at ``since``, or with all
    records, those without a key too."""
    register(spark)
    rows = spark.readStream.format("paged").options(**_options(
        spark, endpoints, path, page_size, pages_per_partition, fetcher, output="records", since=since,
        replicationKey=replication_key, numeric=str(numeric_cursor).lower())).load()
    return parse_records(rows, record_schema)


def endpoint_source(spark: SparkSession, endpoints: list[str], record_schema: str,
                    replication_key: str | None = None, path: str | None = None,
                    page_size: int = DEFAULT_PAGE_SIZE, fetcher: str | None = None,
                    pages_per_partition: int | None = None, numeric_cursor: bool | None = None):
    """A ``source(since)`` for ``plans.job.sync_table``: the records of the
    endpoints, typed by ``record_schema``.  With ``since`` the fetcher gets it
    and records before it are dropped; a key that ``record_schema`` types as a
    number (or ``numeric_cursor``) compares as one, and a ``since`` that is no
    number is then no bound."""
    types = {f.name: f.dataType for f in T.DataType.fromDDL(record_schema).fields}
    numeric = numeric_cursor
    if numeric is None:
        numeric = isinstance(types.get(replication_key), T.NumericType)

    def source(since: str | None) -> DataFrame:
        if not replication_key or (numeric and since is not None and not is_number(since)):
            since = None
        raw = paged_scan(spark, endpoints, path=path, page_size=page_size, fetcher=fetcher, since=since,
                         pages_per_partition=pages_per_partition, replication_key=replication_key,
                         numeric=numeric)
        return parse_records(raw, record_schema)

    return source


def parse_records(raw: DataFrame, schema: str, record: str = "record") -> DataFrame:
    """Typed record columns from the JSON text column (JVM-side ``from_json``)."""
    return raw.select(F.from_json(F.col(record), schema).alias("_r")).select("_r.*")


# ------------------------------------------------------------ page bodies
def write_blocks(bodies: DataFrame, root: str) -> None:
    """Lay out ``(endpoint, page, body)`` for ``DirectoryFetcher``, many pages a
    file; bodies without line ends, as ``to_json`` gives them."""
    placed = bodies.select("endpoint", F.expr(f"page div {BLOCK_PAGES}").cast("int").alias("block"),
                           F.concat_ws("\t", "page", "body").alias("value"))
    (placed.repartition("endpoint", "block").sortWithinPartitions("endpoint", "block")
     .write.partitionBy("endpoint", "block").text(root))


def explode_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of each page body; missing/NULL ``registros`` give no rows."""
    parsed = F.from_json(F.col(body), "registros array<string>, total string")
    return (pages.select("endpoint", "page", parsed.alias("_p"))
            .select("endpoint", "page", parse_total(F.col("_p.total")).alias("total"),
                    F.explode(F.col("_p.registros")).alias("record")))
