"""Ledger queries, blocked running totals and the paged source."""

import json
import os
import random

import pytest

from pyspark.sql import functions as F

from tablesync.operators import ledger
from tablesync.operators.ordinal import row_ordinal, running_total
from tablesync.sources import paged


def test_running_total_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), i * 3 + rnd.randint(0, 2), rnd.randint(1, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r.g, r.o): r.rt for r in running_total(df, ["g"], "o", F.col("v"), "rt", block_bits=3).collect()}
    exp = {}
    for g in "abc":
        acc = 0
        for _, o, v in sorted(r for r in rows if r[0] == g):
            acc += v
            exp[(g, o)] = acc
    assert got == exp


def test_row_ordinal_descending_with_totals(spark):
    df = spark.createDataFrame([("x", i) for i in range(50)] + [("y", i) for i in range(5)], "g string, o long")
    out = row_ordinal(df, ["g"], "o", "rn", descending=True, total_col="n", block_bits=2).collect()
    got = {(r.g, r.o): (r.rn, r.n) for r in out}
    assert got[("x", 49)] == (1, 50) and got[("x", 0)] == (50, 50) and got[("y", 4)] == (1, 5)


def test_checkpoint_latest_and_resume(spark):
    log = spark.createDataFrame([
        ("c", "p", "EXTRACT", 1, False), ("c", "p", "LOAD", 2, False),
        ("c", "q", "VERIFY", 1, False), ("c", "r", "LOAD", 1, False), ("c", "r", "CLEARED", 2, True),
    ], "client string, pipeline string, stage string, seq long, cleared boolean")
    latest = ledger.checkpoint_latest(log)
    got = {r.pipeline: (r.stage, r.resume_stage) for r in ledger.resume_point(latest).collect()}
    assert got == {"p": ("LOAD", "VERIFY"), "q": ("VERIFY", "EXTRACT")}


def test_run_summary_failed_if_any_stream_failed(spark):
    runs = spark.createDataFrame([
        ("acme", 1, "clientes", "SUCCESS", 10), ("acme", 1, "titulos", "FAILED", 0),
        ("beta", 1, "clientes", "SUCCESS", 5)],
        "client string, started_at long, pipeline string, status string, records_out long")
    got = {r.client: (r.status, json.loads(r.streams)) for r in ledger.run_summary(runs).collect()}
    assert got["acme"][0] == "failed" and got["beta"][0] == "success"
    assert [s["stream"] for s in got["acme"][1]] == ["clientes", "titulos"]


def test_status_top_orders_ties_by_run_id(spark):
    runs = spark.createDataFrame([(i, "c", 1 if i < 30 else 0) for i in range(40)],
                                 "run_id long, client string, started_at long")
    top = [r.run_id for r in ledger.status_top(runs, n=5).collect()]
    assert top == [29, 28, 27, 26, 25]


def test_failed_on_latest_day(spark):
    runs = spark.createDataFrame([
        (1, "FAILED", "2024-01-01 10:00:00"), (2, "FAILED", "2024-01-02 10:00:00"),
        (3, "SUCCESS", "2024-01-02 11:00:00")], "run_id long, status string, started_at string")
    runs = runs.withColumn("started_at", F.to_timestamp_ntz("started_at"))
    assert [r.run_id for r in ledger.failed_on_day(runs).collect()] == [2]
    assert [r.run_id for r in ledger.failed_on_day(runs, "2024-01-01").collect()] == [1]


def test_page_progress_and_eta(spark):
    pages = spark.createDataFrame([
        ("e", 1, json.dumps({"registros": [{"id": i} for i in range(5)], "total": "12"})),
        ("e", 2, json.dumps({"registros": [{"id": i} for i in range(5)], "total": "12"})),
        ("e", 3, json.dumps({"registros": [{"id": 1}, {"id": 2}], "total": "12"})),
        ("e", 4, json.dumps({"registros": [], "total": "12"})),
    ], "endpoint string, page int, body string")
    prog = ledger.page_progress(ledger.page_ledger(pages), 5).withColumn("elapsed_s", F.col("page") * 2.0)
    got = [(r.page, r.fetched, r.pct, r.total_pages, r.eta_s) for r in ledger.page_eta(prog).orderBy("page").collect()]
    assert [g[:4] for g in got] == [(1, 5, 41.7, 3), (2, 10, 83.3, 3), (3, 12, 100.0, 3)]
    assert got[0][4] == pytest.approx(2.8) and got[1][4] == pytest.approx(0.8) and got[2][4] is None


def _write_pages(root, endpoint, bodies):
    for i, body in enumerate(bodies, start=1):
        d = os.path.join(root, f"endpoint={endpoint}", f"page={i}")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.txt"), "w") as fh:
            fh.write(json.dumps(body))


def test_paged_source_splits_pages_into_partitions(spark, workdir):
    recs = [{"id": i, "nome": f"n{i}"} for i in range(23)]
    bodies = [{"registros": recs[i:i + 5], "total": "23"} for i in range(0, 23, 5)] + [{"registros": []}]
    _write_pages(workdir, "cliente", bodies)
    pages = paged.read_pages(spark, ["cliente"], workdir, page_size=5, pages_per_partition=2)
    assert pages.rdd.getNumPartitions() == 3
    df = paged.paged_scan(spark, ["cliente"], path=workdir, page_size=5, pages_per_partition=2)
    rows = paged.parse_records(df, "id long, nome string").collect()
    assert sorted(r.id for r in rows) == list(range(23))


def test_paged_source_unknown_total_is_probed(spark, workdir):
    bodies = [{"registros": [{"id": i}], "total": "" if i % 2 else "abc"} for i in range(11)]
    _write_pages(workdir, "x", bodies + [{"registros": None}, {"registros": [{"id": 99}]}])
    assert paged.read_pages(spark, ["x"], workdir, page_size=1, pages_per_partition=4).rdd.getNumPartitions() == 3
    df = paged.paged_scan(spark, ["x"], path=workdir, page_size=1, pages_per_partition=4)
    assert sorted(r.id for r in paged.parse_records(df, "id long").collect()) == list(range(11))


@pytest.mark.parametrize("per_partition", [1, 2, 7])
def test_paged_source_reads_all_of_pages_shorter_than_asked(spark, workdir, per_partition):
    recs = [{"id": i} for i in range(9)]
    _write_pages(workdir, "s", [{"registros": recs[i:i + 3], "total": "9"} for i in range(0, 9, 3)])
    # Page 1 longer than the others: the last range stays open.
    _write_pages(workdir, "u", [{"registros": recs[a:b], "total": "9"} for a, b in ((0, 5), (5, 7), (7, 8), (8, 9))])
    # Page 1 shorter: planned pages beyond the end are empty, and that is no fault.
    _write_pages(workdir, "v", [{"registros": recs[a:b], "total": "9"} for a, b in ((0, 1), (1, 5), (5, 9))])
    for endpoint in "suv":
        df = paged.paged_scan(spark, [endpoint], path=workdir, page_size=5, pages_per_partition=per_partition)
        assert sorted(r.id for r in paged.parse_records(df, "id long").collect()) == list(range(9)), endpoint


@pytest.mark.parametrize("per_partition", [1, 8])
def test_paged_source_fails_rather_than_lose_rows(spark, workdir, per_partition):
    page = lambda *ids: {"registros": [{"id": i} for i in ids], "total": "8"}
    _write_pages(workdir, "hole", [page(0, 1), page(2, 3), page(), page(6, 7)])
    _write_pages(workdir, "short", [page(0, 1), page(2, 3)])
    _write_pages(workdir, "none", [page()])
    _write_pages(workdir, "many", [page(0, 1), page(2, 3), page(4, 5), page(6, 7)])
    cases = [("hole", 100, "page 3 is empty"), ("short", 100, "short of the total"),
             ("none", 100, "page 1 is empty"), ("many", 3, "4 pages")]
    for endpoint, cap, message in cases:
        with pytest.raises(Exception, match=message):
            paged.paged_scan(spark, [endpoint], path=workdir, page_size=2, max_pages=cap,
                             pages_per_partition=per_partition).count()


def test_endpoint_source_compares_number_keys_as_numbers(spark, workdir):
    _write_pages(workdir, "k", [{"registros": [{"id": i} for i in range(7, 13)], "total": "6"}])
    source = paged.endpoint_source(spark, ["k"], "id long", replication_key="id", path=workdir)
    assert sorted(r.id for r in source("9").collect()) == [9, 10, 11, 12]
    assert source("2024-01-01 00:00:00").count() == 6  # a look-back bounds no number
    assert source(None).count() == 6


def test_explode_pages_missing_registros(spark):
    pages = spark.createDataFrame([("e", 1, '{"registros":[{"a":1},{"a":2}],"total":"2"}'),
                                   ("e", 2, '{"registros":null,"total":"2"}'), ("e", 3, '{"total":"2"}')],
                                  "endpoint string, page int, body string")
    assert paged.explode_pages(pages).count() == 2


def test_incremental_scan_filters_on_the_jvm(spark, workdir):
    recs = [{"id": i, "at": f"2024-01-{i + 1:02d} 00:00:00", "n": 1.50} for i in range(12)]
    _write_pages(workdir, "c", [{"registros": recs[i:i + 4], "total": "12"} for i in range(0, 12, 4)])
    df = paged.paged_scan(spark, ["c"], path=workdir, page_size=4, replication_key="at", since="2024-01-09 00:00:00")
    assert sorted(r.id for r in paged.parse_records(df, "id long").collect()) == [8, 9, 10, 11]
    # Full and incremental runs see the same record text.
    whole = {r.record for r in paged.paged_scan(spark, ["c"], path=workdir, page_size=4).collect()}
    assert {r.record for r in df.collect()} <= whole


def test_paged_source_empty_endpoints(spark, workdir):
    _write_pages(workdir, "empty", [{"registros": [], "total": "0"}])
    _write_pages(workdir, "nulls", [{"registros": None, "total": ""}])
    none = paged.paged_scan(spark, ["empty", "nulls", "missing"], path=workdir, page_size=2)
    assert none.count() == 0


def test_paged_source_reads_pages_beyond_the_total(spark, workdir):
    pages = [{"registros": [{"id": 1}, {"id": 2}], "total": "4.0"},
             {"registros": [{"id": 3}, {"id": 4}], "total": "4"},
             {"registros": [{"id": 5}], "total": "4"}]
    _write_pages(workdir, "t", pages)
    df = paged.paged_scan(spark, ["t"], path=workdir, page_size=2)
    assert sorted(r.id for r in paged.parse_records(df, "id long").collect()) == [1, 2, 3, 4, 5]


def test_paged_source_page_output_matches_records(spark, workdir):
    recs = [{"id": i, "nome": f"n{i}"} for i in range(9)]
    _write_pages(workdir, "p", [{"registros": recs[i:i + 4], "total": "9"} for i in range(0, 9, 4)])
    pages = paged.paged_scan(spark, ["p"], path=workdir, page_size=4, output="pages")
    assert pages.columns == ["endpoint", "page", "total", "fetched_at", "body"] and pages.count() == 3
    rows = paged.parse_records(paged.explode_pages(pages), "id long, nome string").collect()
    assert sorted(r.id for r in rows) == list(range(9))


# A server in a folder: records of an endpoint in one file, filtered by the
# server and cut into pages as asked; every request leaves a file.
FETCHER = """
import json, os, uuid

class Server:
    def __init__(self, options):
        self.root, self.key = options["path"].removeprefix("file:"), options.get("replicationkey", "at")

    def records(self, endpoint, since):
        with open(f"{self.root}/{endpoint}.json") as fh:
            rows = json.load(fh)
        return [r for r in rows if since is None or (r.get(self.key) or "") >= since]

    def fetch(self, endpoint, page, page_size, since):
        with open(f"{self.root}/log/{endpoint}-{page}-{uuid.uuid4().hex}", "w") as fh:
            fh.write(since or "")
        rows = self.records(endpoint, since)
        return {"registros": rows[(page - 1) * page_size:page * page_size], "total": str(len(rows))}

    def newest(self, endpoint, key, since, numeric):
        return max((r[key] for r in self.records(endpoint, since) if r.get(key)), default=None)
"""


@pytest.fixture()
def server(spark, workdir):
    name = f"server_{os.path.basename(workdir).replace('-', '_')}"
    os.makedirs(f"{workdir}/log")
    with open(f"{workdir}/{name}.py", "w") as fh:
        fh.write(FETCHER)
    spark.sparkContext.addPyFile(f"{workdir}/{name}.py")

    def put(endpoint, rows):
        with open(f"{workdir}/{endpoint}.json", "w") as fh:
            json.dump(rows, fh)

    def asked():
        """Requests since the last call, by endpoint and page."""
        names = sorted(os.listdir(f"{workdir}/log"))
        for n in names:
            os.remove(f"{workdir}/log/{n}")
        return ["-".join(n.split("-")[:2]) for n in names]

    return f"{name}:Server", put, asked


def _day(i):
    return f"2024-{1 + i // 28:02d}-{1 + i % 28:02d} 00:00:00"


def test_a_cursor_filter_is_pushed_to_the_server(spark, workdir, server):
    fetcher, put, asked = server
    put("a", [{"id": i, "at": _day(i), "x": {"n": [1.50, "é"]}} for i in range(100)])
    put("b", [{"id": i, "at": _day(i)} for i in range(100)] + [{"id": 100, "at": None}])
    scan = paged.record_scan(spark, ["a", "b"], "at", workdir, page_size=10, pages_per_partition=3, fetcher=fetcher)
    asked()
    assert scan.count() == 201 and len(asked()) >= 21
    late = scan.where((F.col("cursor") >= _day(85)) & (F.col("endpoint") == "a"))
    assert sorted(r.id for r in paged.parse_records(late, "id long").collect()) == list(range(85, 100))
    pages = asked()
    assert set(pages) <= {"a-1", "a-2", "a-3"} and len(pages) <= 5  # of ten pages each
    # What the source cannot take over stays with Spark; null cursors match nothing.
    both = scan.where((F.col("cursor") > _day(97)) & (F.length("record") > 10))
    assert sorted((r.endpoint, r.cursor) for r in both.collect()) == [(e, _day(i)) for e in "ab" for i in (98, 99)]
    asked()
    assert scan.where(F.col("cursor") < _day(2)).count() == 4 and len(asked()) >= 20
    record = scan.where(F.col("cursor") == _day(7)).where("endpoint = 'a'").first()
    assert json.loads(record.record) == {"id": 7, "at": _day(7), "x": {"n": [1.5, "é"]}}
    assert record.fetched_at is not None and record.total == "93"


def test_record_texts_are_as_fetched():
    text = ' {"total" : "3", "x": {"registros": [0]}, "registros": [ {"a" : 1.50} ,{"b": "]}"}, null ] , "y":[]} '
    records, total = paged.split_page(text)
    assert [r for r, _ in records] == ['{"a" : 1.50}', '{"b": "]}"}', "null"] and total == "3"
    assert paged.split_page('{"registros": null, "total": 7}') == ([], 7)
    assert paged.split_page("") == ([], None) and paged.split_page("{}") == ([], None)
    assert [paged.cursor_text(v) for v in ("a", "", None, 1.5, True)] == ["a", None, None, "1.5", "true"]
    with pytest.raises(paged.PagingError):
        paged.split_page("[1]")


def test_a_short_total_is_found_without_fetching_again(spark, workdir, server, monkeypatch):
    fetcher, put, asked = server
    put("s", [{"id": i, "at": _day(i)} for i in range(40)])
    paged.paged_scan(spark, ["s"], workdir, page_size=5, pages_per_partition=2, fetcher=fetcher)
    once = asked()
    # Page 1 is planned with; then each page, and the empty one after the last.
    assert sorted(once) == sorted(["s-1"] + [f"s-{p}" for p in range(1, 10)])
    bodies = [{"registros": [{"id": p}] * (3 if p != 2 else 1), "total": "9"} for p in range(3)]
    _write_pages(workdir + "/files", "u", bodies)
    fetched = []
    original = paged.DirectoryFetcher.fetch_text
    monkeypatch.setattr(paged.DirectoryFetcher, "fetch_text",
                        lambda self, e, p, n, since: fetched.append(p) or original(self, e, p, n, since))
    with pytest.raises(paged.PagingError, match="7 records, short of the total 9"):
        paged.paged_scan(spark, ["u"], workdir + "/files", page_size=3)
    assert fetched in ([], [1])  # on the driver: only the page planned with


def test_arrow_batches_hold_many_pages():
    reader = paged._Pages({"endpoints": "e", "path": "/none"})
    reader._text = lambda f, e, p, s: json.dumps({"registros": [{"id": p}] if p < 6 else [], "total": 5})
    batches = list(reader.batches(paged.PageRange("e", 1, 3, True)))
    assert [b.num_rows for b in batches] == [5] and batches[0].schema == paged._ARROW["pages"]
    assert batches[0]["total"].to_pylist() == ["5"] * 5


def _stream(spark, store, server_options, checkpoint):
    from tablesync.streaming.upsert_stream import drain

    source = paged.endpoint_stream(spark, ["a", "b"], "id long, at string, v string", "at", **server_options)
    drain(spark, source, "st", "id", store, checkpoint)
    return sorted((r.id, r.at, r.v) for r in store.current("st").collect())


def test_a_restarted_stream_asks_for_new_pages_only(spark, workdir, server):
    from tablesync.plans.publish import TableStore

    fetcher, put, asked = server
    rows = {e: [{"id": 100 * k + i, "at": _day(i), "v": "old"} for i in range(60)] for k, e in enumerate("ab")}
    rows["a"].append({"id": 99, "at": None, "v": "never"})
    for e in "ab":
        put(e, rows[e])
    store = TableStore(spark, f"{workdir}/tables")
    options = {"path": workdir, "page_size": 5, "pages_per_partition": 4, "fetcher": fetcher}
    first = _stream(spark, store, options, f"{workdir}/cp")
    assert len(first) == 121 and len(asked()) >= 24
    generation = store.state("st")["run_id"]
    # Nothing new: the newest cursor is the saved one.
    assert _stream(spark, store, options, f"{workdir}/cp") == first
    assert store.state("st", refresh=True)["run_id"] == generation and set(asked()) <= {"a-1", "b-1"}
    # Changed and new records: only their pages are asked for.
    rows["a"][3].update(at=_day(70), v="new")
    rows["b"].append({"id": 500, "at": _day(71), "v": "new"})
    for e in "ab":
        put(e, rows[e])
    second = _stream(spark, store, options, f"{workdir}/cp")
    pages = asked()
    assert set(pages) <= {"a-1", "a-2", "b-1", "b-2"}
    assert [r for r in second if r[2] == "new"] == [(3, _day(70), "new"), (500, _day(71), "new")] and len(second) == 122
    # A replay of all batches by another query changes nothing.
    assert _stream(spark, store, options, f"{workdir}/cp2") == second


def test_the_newest_key_of_text_pages_is_read_without_a_record_loop(workdir, monkeypatch):
    pages = [{"registros": [{"k": f"{(7 * i + p) % 90:02d}", "n": 90 - i, "m": i or "x"} for i in range(20)]}
             for p in range(9)]
    _write_pages(workdir, "t", [*pages[:5], {"registros": []}, *pages[5:]])
    _write_pages(workdir, "u", [{"registros": [{"k": "a\u00e9\n"}, {"k": ""}, {"k": None}, {}], "total": "4"}])
    fetcher = paged.DirectoryFetcher({"path": workdir})
    until_the_gap = [r for p in pages[:5] for r in p["registros"]]
    assert fetcher.newest("t", "m", None, True) == "19"  # text among numbers: record by record
    assert fetcher.newest("t", "m", None) == "x" and fetcher.newest("none", "k", None) is None
    assert paged.newest_of_pages(['{"registros": [{"k": 1}, {"k": "2"}]}', "{}"], "k", False) == ("2", True)
    assert paged.newest_of_pages(['{"registros": [{"k": 9}]}', ' {"registros":\n[{"k": 10}]}'], "k", True) == ("10", False)
    monkeypatch.setattr(paged, "cursor_order", lambda c, numeric, order=paged.cursor_order: seen.append(c) or order(c, numeric))
    seen = []
    assert fetcher.newest("t", "k", None) == max(r["k"] for r in until_the_gap)
    assert fetcher.newest("t", "n", None, True) == "90" and fetcher.newest("u", "k", None) == "a\u00e9\n"
    assert len(seen) < 20  # a few a window of pages, none a record


def test_ranges_follow_the_size_of_the_pages():
    def ranges(n, text="", **options):
        reader = paged._Pages({"endpoints": "e", "path": "/none", **options})
        body = json.dumps({"registros": [{"t": text}], "total": n})
        reader._text = lambda f, e, p, s: body
        parts = reader.plan(None)
        assert [p.first for p in parts[1:]] == [p.last + 1 for p in parts[:-1]] and parts[-1].last == n
        return parts

    assert len(ranges(14_400, cores="12")) == 36 and len(ranges(100, cores="12")) == 13
    assert len(ranges(14_400, "x" * 2 ** 20, cores="1")) > 400  # 31 pages of a MB each
    assert len(ranges(100, pagesPerPartition="3")) == 34


def test_pages_in_blocks_are_served_like_pages_in_folders(spark, workdir):
    bodies = {p: json.dumps({"registros": [{"id": p, "t": "a\tb\u00e9"}], "total": "200"}) for p in range(1, 201)}
    rows = spark.createDataFrame([("e", p, b) for p, b in bodies.items()], "endpoint string, page int, body string")
    paged.write_blocks(rows, f"{workdir}/blocks")
    files = [f for _, _, names in os.walk(f"{workdir}/blocks") for f in names if f.endswith(".txt")]
    assert len(files) < 10  # not one a page
    fetcher = paged.DirectoryFetcher({"path": f"{workdir}/blocks"})
    for page in (1, 64, 63, 200, 128, 2):
        assert fetcher.fetch_text("e", page, 1, None) == bodies[page]
    assert fetcher.fetch_text("e", 0, 1, None) is None and fetcher.fetch_text("e", 201, 1, None) is None
    assert fetcher.fetch_text("f", 1, 1, None) is None and fetcher.fetch("e", 500, 1, None)["registros"] == []
    scan = paged.paged_scan(spark, ["e"], f"{workdir}/blocks", page_size=1)
    assert sorted(r.id for r in paged.parse_records(scan, "id long").collect()) == list(range(1, 201))


def test_stream_cursors_as_numbers():
    reader = paged.PagedStreamReader({"endpoints": "e", "path": "/none", "replicationKey": "k", "numeric": "true"})
    part = paged.PageRange("e", 1, 1, False, "9", "10")
    assert [reader.pages._between(c, part) for c in ("8", "9", "9.5", "10", "11", "x", None)] == \
        [False, True, True, True, False, False, False]
    assert reader.pages._between(None, paged.PageRange("e", 1, 1, False, None, "10"))
    assert reader.partitions({"cursor": "10"}, {"cursor": "9"})[0].endpoint == ""
    with pytest.raises(paged.PagingError):
        paged.PagedStreamReader({"endpoints": "e"})


def test_eta_by_fetch_times(spark, workdir):
    _write_pages(workdir, "e", [{"registros": [{"id": i}] * 5, "total": "12"} for i in range(2)] +
                 [{"registros": [{"id": 1}] * 2, "total": "12"}])
    landed = paged.paged_scan(spark, ["e"], path=workdir, page_size=5, output="pages")
    eta = ledger.page_eta(ledger.page_progress(ledger.page_ledger(landed), 5)).orderBy("page").collect()
    assert [r.fetched for r in eta] == [5, 10, 12] and eta[2].eta_s is None
    assert 0 <= eta[0].elapsed_s <= eta[1].elapsed_s <= eta[2].elapsed_s < 60 and eta[1].eta_s >= 0
    # A later page that came earlier does not count before the pages up to it are there.
    rows = [("e", 1, 5, 20, "2024-01-01 00:00:04"), ("e", 2, 5, 20, "2024-01-01 00:00:02"),
            ("e", 3, 5, 20, "2024-01-01 00:00:08")]
    df = spark.createDataFrame(rows, "endpoint string, page long, n_records long, total long, fetched_at string")
    prog = ledger.page_progress(df.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz")), 5)
    got = [(r.elapsed_s, r.eta_s) for r in ledger.page_eta(prog).orderBy("page").collect()]
    assert got == [(2.0, 6.0), (2.0, 2.0), (6.0, 2.0)]


def test_running_total_with_sparse_keys_picks_wide_blocks(spark):
    from tablesync.operators.ordinal import block_bits_for

    rows = [("g", i * 10**9, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    assert block_bits_for(df, "o") == 18  # sqrt of a ~2**35.5 range
    got = sorted((r.o, r.rt) for r in running_total(df, ["g"], "o", F.col("v"), "rt").collect())
    assert got == [(i * 10**9, i + 1) for i in range(50)]
