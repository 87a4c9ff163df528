"""The REST service as a Spark source: ``spark.read.format("lectern_rest").option("base", ...)``.

What is read is the option ``kind``:

* ``versions``: the versions that the service lists;
* ``verses`` (the default): a row per verse of the versions, with its text where the schema asks for it;
* ``days``: the verse of each day;
* ``pages``: web pages of a numbered address, ``url`` with ``%d`` in it, from ``first`` to ``last``.

The reader asks for no more than the query needs. Filters on version_id, book_id and page_id (``=``, ``IN``, and for
pages ``<``, ``<=``, ``>``, ``>=``) are pushed into the plan: other versions are not listed, other books not asked for.
A schema without content, status and error needs no text, so none is fetched: pass ``.schema(...)``. What is left is
numbered and dealt to ``lanes`` partitions, which share one rate (``per_second``) as in ``lectern.sources.crawl``.

As a stream, ``days`` and ``verses`` have the place in the service's list as their offset: a run takes up what
has been added behind the last one's. ``register`` makes the format known, and lets Spark push filters to it.
"""

from __future__ import annotations

import json
import time
import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lectern.sources import rest
from lectern.sources.crawl import next_slot

NAME = "lectern_rest"
ANSWER = ("content", "status", "error")
SCHEMAS = {
    "versions": "version_id int, abbreviation string, title string, language_tag string",
    "verses": "version_id int, book_id string, book_sort int, chapter_sort int, verse_sort int, passage_id string, content string, status int, error string",
    "days": "day int, passage_id string",
    "pages": "page_id long, url string, content string, status int, error string",
}
TRIES = 3


@dataclass(frozen=True)
class Lane(InputPartition):
    """Rows that one task completes, in slots of its own."""

    lane: int
    lanes: int
    start: float
    rows: tuple[dict, ...] = field(repr=False)


class _Plan:
    """What to ask for: options, and the filters that were pushed."""

    def __init__(self, options: dict, schema: StructType):
        self.options, self.names = options, schema.fieldNames()
        self.schema = to_arrow_schema(schema)
        self.kind = options.get("kind", "verses")
        self.base = options.get("base", "").rstrip("/")
        self.rate, self.lanes = float(options.get("per_second", 10.0)), int(options.get("lanes", 8))
        self.timeout = float(options.get("timeout", 30.0))
        self.headers = {k.removeprefix("header."): v for k, v in options.items() if k.startswith("header.")}
        self.wanted: dict[str, set] = {}
        self.least, self.most = int(options.get("first", 1)), int(options.get("last", 0))

    def push(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take the filters that the requests can meet; the others are Spark's."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            exact = {"verses": ("version_id", "book_id"), "versions": ("version_id",), "pages": ("page_id",)}.get(self.kind, ())
            if name in exact and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            elif name == "page_id" and self.kind == "pages" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.least = max(self.least, f.value + isinstance(f, GreaterThan))
            elif name == "page_id" and self.kind == "pages" and isinstance(f, LessThan | LessThanOrEqual):
                self.most = min(self.most, f.value - isinstance(f, LessThan))
            else:
                yield f

    # ------------------------------------------------------------ planning

    def _got(self, path: str) -> list[dict]:
        """The data of a list; what cannot be had fails the plan."""
        for attempt in range(TRIES):
            if attempt:
                time.sleep(rest.delay(attempt - 1, 0.5))
            status, body, error = rest.ask(f"{self.base}{path}", self.headers, self.timeout)
            if body is not None:
                return json.loads(body).get("data") or []
            if status in (403, 404):
                break
        raise OSError(f"{path}: {error or status}")

    def _meets(self, name: str, value) -> bool:
        return name not in self.wanted or value in self.wanted[name]

    def _versions(self) -> list[int]:
        given = self.options.get("versions")
        if given:
            listed = [int(x) for x in given.split(",")]
        else:  # named by the filter, or all that the service has
            listed = sorted(self.wanted["version_id"]) if "version_id" in self.wanted else [v["id"] for v in self._got("/bibles")]
        return [v for v in listed if self._meets("version_id", v)]

    def _verses(self) -> Iterator[dict]:
        for version in self._versions():
            for book_sort, book in enumerate(self._got(f"/bibles/{version}/books"), 1):
                if not self._meets("book_id", book["id"]):
                    continue
                for chapter_sort, chapter in enumerate(book.get("chapters") or [], 1):
                    for verse in chapter.get("verses") or []:
                        if str(verse["id"]).isdigit() and int(verse["id"]) > 0:
                            url = f"{self.base}/bibles/{version}/passages/{urllib.parse.quote(verse['passage_id'], safe='')}"
                            yield {"version_id": version, "book_id": book["id"], "book_sort": book_sort, "chapter_sort": chapter_sort, "verse_sort": int(verse["id"]), "passage_id": verse["passage_id"], "_url": url}

    def rows(self) -> list[dict]:
        """All rows without their answers, in the order of the service."""
        if self.kind == "versions":
            known = ((v["id"], v) for v in self._got("/bibles"))
            return [{"version_id": n, **{c: v.get(c) for c in ("abbreviation", "title", "language_tag")}} for n, v in known if self._meets("version_id", n)]
        if self.kind == "days":
            return [{"day": d["day"], "passage_id": d["passage_id"]} for d in self._got("/verse_of_the_days")]
        if self.kind == "pages":
            return [{"page_id": n, "url": (u := self.options["url"].replace("%d", str(n))), "_url": u} for n in range(self.least, self.most + 1) if self._meets("page_id", n)]
        return list(self._verses())

    def dealt(self, rows: list[dict]) -> list[Lane]:
        start = time.time() + 1 / self.rate
        return [Lane(i, self.lanes, start, tuple(rows[i :: self.lanes])) for i in range(min(self.lanes, len(rows)))] or [Lane(0, 1, start, ())]

    # ------------------------------------------------------------ reading

    def read(self, part: Lane) -> Iterator[pa.RecordBatch]:
        if not set(ANSWER) & set(self.names):
            yield self._batch(list(part.rows))
            return
        last = -1
        for row in part.rows:
            last = next_slot(last, part.lane, part.lanes, self.rate, time.time() - part.start)
            time.sleep(max(0.0, part.start + (last * part.lanes + part.lane) / self.rate - time.time()))
            status, body, error = rest.ask(row["_url"], self.headers, self.timeout)
            if body is not None and self.kind == "verses":
                try:
                    body, error = json.loads(body)["content"], None
                except (ValueError, KeyError, TypeError):
                    body, error = None, "no content"
            yield self._batch([row | {"content": body, "status": status, "error": error}])  # one at a time: a page may be large

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in self.schema], schema=self.schema)


class RestReader(DataSourceReader):
    def __init__(self, plan: _Plan):
        self.plan = plan

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        return self.plan.push(filters)

    def partitions(self) -> list[Lane]:
        return self.plan.dealt(self.plan.rows())

    def read(self, partition: Lane) -> Iterator[pa.RecordBatch]:
        return self.plan.read(partition)


class RestStream(DataSourceStreamReader):
    """Offsets are places in the service's list."""

    def __init__(self, plan: _Plan):
        self.plan = plan

    def initialOffset(self) -> dict:
        return {"place": 0}

    def latestOffset(self) -> dict:
        return {"place": len(self.plan.rows())}

    def partitions(self, start: dict, end: dict) -> list[Lane]:
        return self.plan.dealt(self.plan.rows()[start["place"] : end["place"]])

    def read(self, partition: Lane) -> Iterator[pa.RecordBatch]:
        return self.plan.read(partition)


class RestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "verses")]

    def reader(self, schema: StructType) -> RestReader:
        return RestReader(_Plan(dict(self.options), schema))

    def streamReader(self, schema: StructType) -> RestStream:
        return RestStream(_Plan(dict(self.options), schema))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RestSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
