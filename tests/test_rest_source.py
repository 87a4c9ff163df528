"""The REST source over a local stub server: what it reads, and what it asks for."""

import json
import threading
import time
from bisect import bisect_left
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from lectern.operators import extract
from lectern.sources import rest_source

BOOKS = {"GEN": 3, "EXO": 2}


class Service:
    """Two versions of two books of one chapter each; logs the paths that are asked for."""

    def __init__(self):
        self.asked: list[tuple[float, str]] = []
        self.days = 2
        service = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                service.asked.append((time.time(), self.path))
                status, body = service.answer(self.path)
                self.send_response(status)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.base = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def answer(self, path):
        parts = path.strip("/").split("/")
        if path == "/bibles":
            return 200, json.dumps({"data": [{"id": v, "title": f"V{v}", "abbreviation": f"v{v}", "language_tag": "en"} for v in (1, 2)]})
        if path == "/verse_of_the_days":
            return 200, json.dumps({"data": [{"day": d, "passage_id": f"GEN.1.{d}"} for d in range(1, self.days + 1)]})
        if parts[0] == "pages":
            return 200, f"<ol><li>first of {parts[1]}</li><li>second</li></ol>"
        if parts[-1] == "books":
            verses = lambda b, n: [{"id": "intro", "passage_id": f"{b}.INTRO"}] + [{"id": str(v), "passage_id": f"{b}.1.{v}"} for v in range(1, n + 1)]
            return 200, json.dumps({"data": [{"id": b, "chapters": [{"id": "1", "verses": verses(b, n)}]} for b, n in BOOKS.items()]})
        passage = parts[-1]
        if passage == "GEN.1.2":
            return 404, ""
        return 200, json.dumps({"id": passage, "content": f"{parts[1]}:{passage}"})

    def paths(self):
        return sorted({p for _, p in self.asked})


@pytest.fixture
def service(spark):
    rest_source.register(spark)
    s = Service()
    yield s
    s.server.shutdown()


def reader(spark, service, **options):
    return spark.read.format(rest_source.NAME).options(base=service.base, per_second=1000, lanes=3, **options)


def test_verses_of_all_versions(spark, service):
    rows = reader(spark, service).load().collect()
    assert sorted((r["version_id"], r["book_id"], r["book_sort"], r["chapter_sort"], r["verse_sort"]) for r in rows) == [(v, b, i, 1, n) for v in (1, 2) for i, b in ((2, "EXO"), (1, "GEN")) for n in range(1, BOOKS[b] + 1)]
    by = {(r["version_id"], r["passage_id"]): (r["content"], r["status"], r["error"]) for r in rows}
    assert by[2, "EXO.1.1"] == ("2:EXO.1.1", 200, None) and by[1, "GEN.1.2"] == (None, 404, None)


def test_filters_reach_the_requests(spark, service):
    found = reader(spark, service).load().filter("version_id = 2 AND book_id IN ('EXO', 'LEV') AND verse_sort > 1")
    assert [r["passage_id"] for r in found.collect()] == ["EXO.1.2"]
    assert service.paths() == ["/bibles/2/books", "/bibles/2/passages/EXO.1.1", "/bibles/2/passages/EXO.1.2"]


def test_a_schema_without_texts_fetches_none(spark, service):
    found = reader(spark, service, versions="1").schema("passage_id string, verse_sort int").load()
    assert sorted(map(tuple, found.collect())) == sorted((f"{b}.1.{n}", n) for b in BOOKS for n in range(1, BOOKS[b] + 1))
    assert service.paths() == ["/bibles/1/books"]


def test_versions_and_days(spark, service):
    versions = reader(spark, service, kind="versions").load()
    assert sorted(map(tuple, versions.collect())) == [(1, "v1", "V1", "en"), (2, "v2", "V2", "en")]
    assert [tuple(r) for r in versions.filter("version_id = 2").collect()] == [(2, "v2", "V2", "en")]
    assert sorted(map(tuple, reader(spark, service, kind="days").load().collect())) == [(1, "GEN.1.1"), (2, "GEN.1.2")]


def test_pages_are_planned_by_number(spark, service):
    pages = reader(spark, service, kind="pages", url=f"{service.base}/pages/%d", first=1, last=50).load()
    found = pages.filter("page_id > 3 AND page_id <= 6 AND page_id <> 5").withColumnRenamed("content", "html")
    items = extract.numbered(extract.list_items(found)).collect()
    assert sorted((r["page_id"], r["verse_sort"], r["content"]) for r in items) == [(4, 1, "first of 4"), (4, 2, "second"), (6, 1, "first of 6"), (6, 2, "second")]
    assert service.paths() == ["/pages/4", "/pages/5", "/pages/6"]  # the last condition is left to Spark


def test_lanes_keep_one_rate(spark, service):
    found = spark.read.format(rest_source.NAME).options(kind="pages", url=f"{service.base}/pages/%d", last=45, per_second=15, lanes=4).load()
    assert found.count() == 45
    times = sorted(t for t, _ in service.asked)
    assert max(bisect_left(times, t + 1.0) - i for i, t in enumerate(times)) <= 16  # one more may arrive late


def test_a_broken_list_fails_the_plan(spark, service, monkeypatch):
    monkeypatch.setattr(service, "answer", lambda path: (403, "no"))
    with pytest.raises(Exception, match="forbidden"):
        reader(spark, service).load().collect()


def test_stream_takes_up_what_is_new(spark, service, tmp_path):
    def run():
        stream = spark.readStream.format(rest_source.NAME).options(base=service.base, kind="days", per_second=1000, lanes=2).load()
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").start()
        query.processAllAvailable()
        query.stop()
        return sorted(r["day"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == [1, 2]
    service.days = 4
    assert run() == [1, 2, 3, 4]  # each once
