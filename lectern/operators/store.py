"""Tables of Parquet folders that are merged by key, and written to in proportion to what changes.

A version of a table is a list of folders in one small file: a base; rows whose keys were new when they came
(``insert``); and rows that took the place of others (``update``). A merge writes the rows that it inserts
or updates, once, and a version that names the new folders beside the old ones.
Readers take base and inserts as they are, and put the last update of a key in place of its row; a key without
updates costs nothing. When updates reach ``ratio`` of the rows, or the folders are more than ``most``, the rows
are written anew as a base. Every version is a snapshot: its folders stay, whatever merges or compacts beside it,
until ``keep`` versions and ``age`` seconds have passed.

How many files a folder has follows its size: Spark's rebalancing decides, not a number of parts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.merge import INSERT, NOOP, UPDATE, counts, get_or_create, upsert_actions

BASE = "base"


@dataclass(frozen=True)
class Folder:
    """Rows of a version: what they are, where they lie, and how many there are."""

    kind: str
    place: str
    rows: int


@dataclass(frozen=True)
class Version:
    number: int
    keys: tuple[str, ...]
    folders: tuple[Folder, ...]

    def rows(self, *kinds: str) -> int:
        return sum(f.rows for f in self.folders if f.kind in kinds)


class Conflict(Exception):
    """Another writer has written this version."""


class Store:
    """Tables under one path; see the module."""

    def __init__(self, spark, path: str, keep: int = 2, age: float = 3600.0, ratio: float = 0.25, most: int = 24, tries: int = 5):
        self.spark, self.path = spark, path.rstrip("/")
        self.keep, self.age, self.ratio, self.most, self.tries = keep, age, ratio, most, tries

    # ------------------------------------------------------------ files

    def _hadoop(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _listed(self, path: str) -> dict[str, float]:
        """Names in a folder with the seconds of their last change."""
        files, at = self._hadoop(path)
        return {x.getPath().getName(): x.getModificationTime() / 1000 for x in files.listStatus(at)} if files.exists(at) else {}

    def _remove(self, path: str) -> None:
        files, at = self._hadoop(path)
        files.delete(at, True)

    def _log(self, name: str) -> dict[int, float]:
        return {int(x): t for x, t in sorted(self._listed(f"{self.path}/_log/{name}").items()) if x.isdigit()}

    # ------------------------------------------------------------ versions

    def version(self, name: str, number: int) -> Version:
        files, at = self._hadoop(f"{self.path}/_log/{name}/{number}")
        stream = files.open(at)
        try:
            keys, *lines = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
        return Version(number, tuple(keys.split("\t")), tuple(Folder(k, p, int(n)) for k, p, n in (x.split("\t") for x in lines)))

    def current(self, name: str) -> Version | None:
        numbers = self._log(name)
        return self.version(name, max(numbers)) if numbers else None

    def _commit(self, name: str, after: Version | None, keys: list[str], folders: list[Folder]) -> Version:
        number = after.number + 1 if after else 1
        files, at = self._hadoop(f"{self.path}/_log/{name}/{number}")
        text = "\t".join(keys) + "\n" + "".join(f"{f.kind}\t{f.place}\t{f.rows}\n" for f in folders)
        try:
            out = files.create(at, False)  # fails if another writer was first
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName() and not files.exists(at):
                raise
            raise Conflict(f"{name} has a version {number}") from error
        out.write(bytearray(text.encode()))
        out.close()
        return Version(number, tuple(keys), tuple(folders))

    # ------------------------------------------------------------ reading

    def read(self, name: str, schema: str, version: Version | None = None) -> DataFrame:
        """The newest version, or another one that is still there."""
        version = version or self.current(name)
        place = lambda f: f"{self.path}/{name}/{f.place}"
        whole = [place(f) for f in version.folders if f.kind != UPDATE] if version else []
        updates = [place(f) for f in version.folders if f.kind == UPDATE] if version else []
        if not whole:
            return self.spark.createDataFrame([], schema)
        rows, keys = self.spark.read.schema(schema).parquet(*whole), list(version.keys)
        if not updates:
            return rows
        changed = None
        for n, at in enumerate(updates):
            one = self.spark.read.schema(schema).parquet(at).withColumn("_n", F.lit(n))
            changed = one if changed is None else changed.unionByName(one)
        if len(updates) > 1:  # each has a key once
            values = [c for c in rows.columns if c not in keys]
            changed = changed.groupBy(*keys).agg(F.max_by(F.struct(*values), "_n").alias("_last")).select(*keys, *(F.col("_last").getField(c).alias(c) for c in values))
        return rows.join(changed.select(*keys), keys, "left_anti").select(*rows.columns).unionByName(changed.select(*rows.columns))

    # ------------------------------------------------------------ writing

    def _written(self, name: str, df: DataFrame) -> Folder:
        place = uuid.uuid4().hex
        df.hint("rebalance").write.parquet(f"{self.path}/{name}/{place}")
        return Folder(BASE, place, self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}/{place}").count())

    def replace(self, name: str, df: DataFrame, keys: list[str] | None = None) -> None:
        """A new version with these rows only; each key once."""
        self._commit(name, self.current(name), keys or df.columns[:1], [self._written(name, df)])
        self.vacuum(name)

    def merge(self, name: str, schema: str, incoming: DataFrame, keys: list[str], compare: list[str]) -> dict[str, int]:
        """Upsert, or get-or-create where ``compare`` is empty; returns how many rows did what.

        ``incoming`` has a key once, or any number of times for get-or-create. A merge that another writer
        overtakes is planned again over what that one has written.
        """
        for _ in range(self.tries):
            try:
                return self._merged(name, schema, incoming, keys, compare)
            except Conflict as error:
                last = error
        raise last

    def _merged(self, name: str, schema: str, incoming: DataFrame, keys: list[str], compare: list[str]) -> dict[str, int]:
        found = self.current(name)
        target = self.read(name, schema, found)
        if compare:
            # where few rows come in, they are sent to the target's scan; the target is not shuffled for them
            there = target.select(*keys, *compare).join(incoming.select(*keys), keys, "left_semi")
            actions = upsert_actions(there, incoming, keys, compare)
        else:
            actions = get_or_create(target, incoming, keys).withColumn("action", F.lit(INSERT))
        run = uuid.uuid4().hex
        at = f"{self.path}/{name}/{run}"
        # of rows that stay as they are the keys are written, to be counted from the files and removed
        changed = [F.when(F.col("action") != NOOP, F.col(c)).alias(c) for c in incoming.columns if c not in keys]
        actions.select(*keys, *changed, "action").hint("rebalance", "action").write.partitionBy("action").parquet(at)
        done = counts(self.spark.read.schema(f"{schema}, action string").parquet(at))
        self._remove(f"{at}/action={NOOP}")
        folders = [Folder(a, f"{run}/action={a}", done[a]) for a in (INSERT, UPDATE) if done[a]]
        try:
            if folders:
                now = self._commit(name, found, keys, [*(found.folders if found else ()), *folders])
        except Conflict:
            self._remove(at)
            raise
        if not folders:
            self._remove(at)
        elif now.rows(UPDATE) > self.ratio * now.rows(BASE, INSERT) or len(now.folders) > self.most:
            self.compact(name, schema, now)
        else:
            self.vacuum(name)
        return done

    def compact(self, name: str, schema: str, version: Version | None = None) -> bool:
        """Write a version's rows anew as one base; nothing is done if another writer has gone on meanwhile."""
        version = version or self.current(name)
        if version is None:
            return False
        base = self._written(name, self.read(name, schema, version))
        try:
            self._commit(name, version, list(version.keys), [base])
        except Conflict:
            self._remove(f"{self.path}/{name}/{base.place}")
            return False
        self.vacuum(name)
        return True

    def truncate(self, name: str, schema: str) -> None:
        found = self.current(name)
        self._commit(name, found, list(found.keys) if found else schema.split()[:1], [])
        self.vacuum(name)

    def drop(self, name: str) -> None:
        """DROP TABLE IF EXISTS: forget every version."""
        self._remove(f"{self.path}/_log/{name}")
        self._remove(f"{self.path}/{name}")

    def vacuum(self, name: str) -> None:
        """Remove versions that were overtaken ``age`` seconds ago, but for the last ``keep``, with the folders that
        only they name; and of folders that no version names, left by writers that died, those of 24 times that age."""
        log, late = self._log(name), time.time() - self.age
        numbers = sorted(log)
        gone = [n for n, after in zip(numbers, numbers[1:], strict=False) if log[after] <= late and n not in numbers[-self.keep :]]
        if not gone:
            return
        places = {n: {f.place.split("/")[0] for f in self.version(name, n).folders} for n in numbers}
        needed = set().union(*(p for n, p in places.items() if n not in gone))
        for n in gone:
            self._remove(f"{self.path}/_log/{name}/{n}")
        old = set().union(*(places[n] for n in gone))
        for run, at in self._listed(f"{self.path}/{name}").items():
            if run not in needed and (run in old or at <= late - 23 * self.age):
                self._remove(f"{self.path}/{name}/{run}")

    @contextmanager
    def once(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` written beside the tables for as long as the block lasts, so that what reads it plans it once."""
        at = f"{self.path}/_once/{uuid.uuid4().hex}"
        try:
            df.write.parquet(at)
            yield self.spark.read.schema(df.schema).parquet(at)
        finally:
            self._remove(at)
