"""The crawl: one rate for all tasks, slices that stay, failures over runs."""

import json
import sys
import time
from bisect import bisect_left

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lectern.operators.store import Store
from lectern.sources import crawl, files


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


def URL(rows):
    return rows.withColumn("url", F.concat(F.lit("https://x/"), "passage_id"))


def work(spark, n, lang="english"):
    return spark.createDataFrame([(lang, f"GEN.1.{v}", 1, 1, v) for v in range(1, n + 1)], "lang string, passage_id string, book_sort int, chapter_sort int, verse_sort int")


def body(passage, content="text"):
    return json.dumps({"id": passage, "content": content, "reference": "r"}).encode()


def asked(tmp_path):
    """The requests of each url, as the stub has logged them."""
    lines = [x.split(" ") for f in tmp_path.glob("log/*") for x in f.read_text().splitlines()]
    found: dict[str, list[float]] = {}
    for url, at in lines:
        found.setdefault(url.rpartition("/")[2], []).append(float(at))
    return found


def stub(tmp_path, answer):
    """A server: logs each request in a file of its worker, then answers."""
    (tmp_path / "log").mkdir(exist_ok=True)
    log = str(tmp_path / "log")

    def get(url, headers, timeout):
        import os

        with open(f"{log}/{os.getpid()}", "a") as f:
            f.write(f"{url} {time.time()}\n")
        return answer(url.rpartition("/")[2], int(url.rpartition(".")[2]))

    return get


def contents(spark, path):
    return sorted(r["passage_id"] for r in files.good(files.read_records(spark, path)).collect())


def test_numbers_and_slots(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("(id * 37) % 1000 AS k")
    got = sorted(tuple(r) for r in crawl.schedule(rows.repartition(5), ["k"], 8.0, 3, 100).collect())
    assert got == [(k, k, k % 3, k // 100, k * 125) for k in range(1000)]
    assert crawl.schedule(rows.limit(0), ["k"], 8.0, 3, 100).count() == 0
    # a lane's slots: on time, late, and several of them gone
    assert [crawl.next_slot(-1, 1, 4, 2.0, 0.0), crawl.next_slot(0, 1, 4, 2.0, 0.6), crawl.next_slot(0, 1, 4, 2.0, 7.0)] == [0, 1, 4]


def test_no_second_holds_more_than_the_rate(spark, tmp_path):
    """Uneven answers: some lanes fall behind and must not catch up by bursts."""

    def answer(passage, number):
        time.sleep(0.4 if number % 4 == 1 and number < 60 else 0.0)  # all of one lane
        return 200, body(passage)

    rate, lanes = 40.0, 4
    transport = crawl.http(rate, lanes, get=stub(tmp_path, answer))
    store = Store(spark, f"file://{tmp_path}/s")
    found = crawl.crawl(work(spark, 120), store, f"file://{tmp_path}/lines", transport, URL, 1, rate, lanes=lanes, slice_size=60)
    assert found == {"done": 120, "missing": 0, "waiting": 0, "dead": 0}
    times = sorted(t for at in asked(tmp_path).values() for t in at)
    assert len(times) == 120
    # the stub logs a little after the slot: one request more may fall into a window than was sent in it
    assert max(bisect_left(times, t + 1.0) - i for i, t in enumerate(times)) <= rate + 1
    assert len(contents(spark, f"file://{tmp_path}/lines")) == 120


def test_a_stopped_run_keeps_its_slices(spark, tmp_path):
    path, store = f"file://{tmp_path}/lines", Store(spark, f"file://{tmp_path}/s")
    transport = crawl.http(1e5, 4, get=stub(tmp_path, lambda p, n: (404, b"") if n % 10 == 0 else (200, body(p))))
    go = lambda **o: crawl.crawl(work(spark, 100), store, path, transport, URL, 1, 1e5, lanes=4, slice_size=20, **o)
    assert go(stop=lambda done: done == 2) == {"done": 36, "missing": 4, "waiting": 0, "dead": 0}
    assert set(asked(tmp_path)) == {f"GEN.1.{v}" for v in range(1, 41)} and len(contents(spark, path)) == 36
    assert go() == {"done": 54, "missing": 6, "waiting": 0, "dead": 0}
    assert all(len(t) == 1 for t in asked(tmp_path).values()) and len(asked(tmp_path)) == 100  # only the rest was asked for
    assert go() == dict.fromkeys(("done", "missing", "waiting", "dead"), 0)
    assert len(contents(spark, path)) == 90


def test_a_run_that_dies_between_its_writes(spark, tmp_path, monkeypatch):
    """The passages of a slice are there, its states are not: they are not asked for again."""
    path, store = f"file://{tmp_path}/lines", Store(spark, f"file://{tmp_path}/s")
    transport = crawl.http(1e5, 2, get=stub(tmp_path, lambda p, n: (200, body(p))))
    go = lambda: crawl.crawl(work(spark, 12), store, path, transport, URL, 1, 1e5, lanes=2, slice_size=6)
    with monkeypatch.context() as m:
        m.setattr(store, "merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            go()
    assert len(contents(spark, path)) == 6
    assert go()["done"] == 6
    assert all(len(t) == 1 for t in asked(tmp_path).values()) and len(contents(spark, path)) == 12


def test_failures_over_three_runs(spark, tmp_path):
    """Down until the second run, always down, forbidden, empty, malformed."""
    path, store, clock = f"file://{tmp_path}/lines", Store(spark, f"file://{tmp_path}/s"), [1000.0]

    def answer(passage, number):
        before = len(asked(tmp_path).get(passage, [])) - 1  # this one is logged already
        if number == 1 and before < 1 or number == 2:
            return 503, b"busy"
        if number == 3:
            raise OSError("no route")
        return {4: (403, b""), 5: (200, b" "), 6: (200, b"{broken"), 7: (200, body(passage))}.get(number, (200, body(passage)))

    transport = crawl.http(1e5, 2, get=stub(tmp_path, answer))
    go = lambda: crawl.crawl(work(spark, 7), store, path, transport, URL, 1, 1e5, lanes=2, limit=3, base=10.0, now=lambda: clock[0])
    state = lambda: {int(r["passage_id"][6:]): (r["state"], r["attempts"], r["status"], r["error"]) for r in store.read("requests", crawl.REQUESTS).collect()}
    assert go() == {"done": 1, "missing": 0, "waiting": 4, "dead": 2}
    first = state()
    assert first[1] == first[2] == ("waiting", 1, 503, "status 503: busy") and first[3] == ("waiting", 1, 0, "no route")
    assert first[4] == ("dead", 1, 403, "forbidden") and first[5] == ("dead", 1, 200, "empty body") and first[6] == ("waiting", 1, 200, "no content") and first[7][0] == "done"
    assert sum(go().values()) == 0  # nothing is due yet
    clock[0] += 13  # the first delay is 7.5 to 12.5 seconds
    assert go() == {"done": 1, "missing": 0, "waiting": 3, "dead": 0}
    clock[0] += 13
    assert sum(go().values()) == 0  # the second delay is 15 to 25 seconds
    clock[0] += 13
    go()
    last = state()
    assert last[1][:2] == ("done", 2) and last[2][:2] == last[3][:2] == last[6][:2] == ("dead", 3)
    clock[0] += 10**6
    assert sum(go().values()) == 0 and contents(spark, path) == ["GEN.1.1", "GEN.1.7"]
    assert {r["state"]: (r["requests"], r["sent"]) for r in crawl.summary(spark, store).collect()} == {"done": (2, 3), "dead": (5, 11)}


def test_retries_in_one_run_wait_for_their_time(spark, tmp_path):
    slept = []
    transport = crawl.served(spark.createDataFrame([(f"https://x/GEN.1.{v}", 200, body(f"GEN.1.{v}").decode(), v) for v in (1, 2, 3)], "url string, status int, body string, fails int"))
    clock = [0.0]

    def sleep(seconds):
        slept.append(seconds)
        clock[0] += seconds

    store = Store(spark, f"file://{tmp_path}/s")
    found = crawl.crawl(work(spark, 4), store, f"file://{tmp_path}/lines", transport, URL, 1, 10.0, passes=3, limit=5, base=8.0, now=lambda: clock[0], sleep=sleep)
    assert found == {"done": 2, "missing": 1, "waiting": 6, "dead": 0} and len(slept) == 2 and 6 <= slept[0] <= 10 and 12 <= slept[1] <= 20
