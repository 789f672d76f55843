"""Archives, keyword streams and listings of posts and comments as Spark data sources.

The client that fetches pages is named by the option ``client`` (``package.module:factory``) and made in
the task, so that tests and clusters bring their own. For an archive ``factory()`` returns ``fetch(sub, kind,
after, before, limit)``, which lists records of ``[after, before)`` in ascending ``created_utc``; sessions, tokens and
throttles are the client's.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

PAGE = 100


class Window(InputPartition):
    def __init__(self, sub: str, after: int, before: int):
        super().__init__((sub, after, before))
        self.sub, self.after, self.before = sub, after, before


def walk(fetch: Callable, sub: str, kind: str, after: int, before: int, page: int = PAGE) -> Iterator[dict]:
    """All records of the half-open window, page by page. Records of a page's last second are asked for again and told once."""
    seen: set[str] = set()
    while after < before:
        records = fetch(sub, kind, after, before, page)
        fresh = [r for r in records if r["id"] not in seen]
        yield from fresh
        if len(records) < page:
            return
        last = int(records[-1]["created_utc"])
        seen = {r["id"] for r in records if int(r["created_utc"]) == last}
        after = last if fresh and last > after else last + 1


def with_retries(call: Callable, tries: int = 4, most_wait: int = 60, sleep: Callable = time.sleep) -> Callable:
    """Repeat a call that is refused for its rate (an error with ``retry_after`` seconds); other errors go through."""

    def run(*args):
        for left in range(tries - 1, -1, -1):
            try:
                return call(*args)
            except Exception as error:
                wait = getattr(error, "retry_after", None)
                if wait is None or not left:
                    raise
                sleep(min(wait, most_wait))

    return run


class Place(InputPartition):
    """One community, stream or listing, and the time from which it is read."""

    def __init__(self, name: str, after: int):
        super().__init__((name, after))
        self.name, self.after = name, after


def walk_cursor(fetch: Callable, name: str, after: int, most_pages: int) -> Iterator[dict]:
    """Pages behind a cursor, newest first: until one is empty, has no cursor, or all its records are older than ``after``,
    and at most ``most_pages``. Older records are left out. ``fetch(name, cursor, after)`` gives (records, next cursor)."""
    cursor = None
    for _ in range(most_pages):
        records, cursor = fetch(name, cursor, after)
        yield from (r for r in records if int(r["created_utc"]) >= after)
        if not records or cursor is None or all(int(r["created_utc"]) < after for r in records):
            return


def _names(options: dict) -> list[str]:
    return [s.strip() for s in options["subs"].split(",") if s.strip()]


class Reader(DataSourceReader):
    """Rows (sub, json, error). With ``isolate`` a community that can't be read gives one row with its error, and what it had
    given before that stays; without, its error ends the query."""

    def __init__(self, options: dict):
        self.options = options
        self.starts = {k: int(v) for k, v in json.loads(options.get("starts", "{}")).items()}

    def records(self, fetch: Callable, partition) -> Iterator[tuple[str, dict]]:
        raise NotImplementedError

    def read(self, partition):
        module, factory = self.options["client"].split(":")
        try:
            fetch = with_retries(getattr(importlib.import_module(module), factory)())
            for sub, record in self.records(fetch, partition):
                yield (sub, json.dumps(record), None)
        except Exception as failure:
            if self.options.get("isolate") != "true":
                raise
            yield (partition.sub if isinstance(partition, Window) else partition.name, None, str(failure)[:500] or type(failure).__name__)


class ArchiveReader(Reader):
    """One partition for each community and time window, so that a long walk is spread over tasks."""

    def partitions(self) -> list[Window]:
        after, before = int(self.options["after"]), int(self.options["before"])
        step = int(self.options.get("window", 86400 * 7))
        return [Window(s, t, min(before, t + step)) for s in _names(self.options) for t in range(max(0, self.starts.get(s, after)), before, step)]

    def records(self, fetch, partition):
        for record in walk(fetch, partition.sub, self.options.get("kind", "posts"), partition.after, partition.before):
            yield partition.sub, record


class CursorReader(Reader):
    """One partition for each keyword stream or listing, as a cursor can't be split."""

    def partitions(self) -> list[Place]:
        return [Place(s, self.starts.get(s, int(self.options.get("after", 0)))) for s in _names(self.options)]

    def records(self, fetch, partition):
        for record in walk_cursor(fetch, partition.name, partition.after, int(self.options.get("pages", 3))):
            yield partition.name, record


class CursorWalk(SimpleDataSourceStreamReader):
    """A walk back through streams or listings as a stream, ``pages`` pages of each name a batch.

    The offset holds each name's next cursor, so Spark's checkpoint is the point from which a walk goes on: one that was
    stopped asks for the next page, and a batch that is run again asks for the same pages. A name is done when a page is
    empty, has no cursor, or is all older than ``after``. One that can't be read gives a row with its error and stays
    where it is, at most ``tries`` times; then its walk is over and its error is the last that it gives.
    """

    def __init__(self, options: dict):
        self.options, self.names = options, _names(options)
        self.after, self.pages, self.tries = int(options.get("after", 0)), int(options.get("pages", 1)), int(options.get("tries", 3))

    def initialOffset(self) -> dict:
        return {n: {"cursor": None, "done": False, "failed": 0} for n in self.names}

    def _walk(self, start: dict) -> tuple[list[tuple], dict]:
        module, factory = self.options["client"].split(":")
        fetch, rows, end = with_retries(getattr(importlib.import_module(module), factory)()), [], {}
        for name, place in start.items():
            at = dict(place)
            try:
                for _ in range(self.pages if not at["done"] else 0):
                    records, cursor = fetch(name, at["cursor"], self.after)
                    rows += [(name, json.dumps(r), None) for r in records if int(r["created_utc"]) >= self.after]
                    over = not records or cursor is None or all(int(r["created_utc"]) < self.after for r in records)
                    at = {"cursor": at["cursor"] if cursor is None else cursor, "done": over, "failed": 0}
                    if over:
                        break
            except Exception as failure:
                at["failed"] += 1
                at["done"] = at["failed"] >= self.tries
                rows.append((name, None, str(failure)[:500] or type(failure).__name__))
            end[name] = at
        return rows, end

    def read(self, start: dict):
        rows, end = self._walk(start)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter(self._walk(start)[0])

    def commit(self, end: dict) -> None:
        pass


class Archive(DataSource):
    """``spark.read.format("discussion_archive")`` with options client, subs, after, before, kind, window, starts, isolate."""

    @classmethod
    def name(cls) -> str:
        return "discussion_archive"

    def schema(self) -> str:
        return "sub string, json string, error string"

    def reader(self, schema) -> Reader:
        return ArchiveReader(dict(self.options))


class Cursored(Archive):
    """``spark.read.format("discussion_cursor")``: keyword streams (newest first) and listings (new, top or search), with
    options client, subs, after, pages, starts, isolate. The client knows the query or listing behind a name. As a stream it is
    a walk back that goes on where it was stopped, with options client, subs, after, pages, tries."""

    @classmethod
    def name(cls) -> str:
        return "discussion_cursor"

    def reader(self, schema) -> Reader:
        return CursorReader(dict(self.options))

    def simpleStreamReader(self, schema) -> CursorWalk:
        return CursorWalk(dict(self.options))


def replies(posts: DataFrame, client: str, schema: str, least: int = 3, most: int = 20, errors: bool = False) -> DataFrame:
    """The first ``most`` replies of each post that has at least ``least``, as the client gives them, without a shuffle.

    ``factory()`` returns ``fetch(row, most)``, which lists records of ``schema``. A post whose replies can't be read has none;
    with ``errors`` it has one row instead, all null but its ``post`` (its row_key) and ``error``, so that they can be counted.
    """
    def run(batches):
        import pandas as pd

        module, factory = client.split(":")
        fetch = with_retries(getattr(importlib.import_module(module), factory)())
        for batch in batches:
            found = []
            for row in batch.to_dict("records"):
                try:
                    found += fetch(row, most)[:most]
                except Exception as failure:  # one post's replies never end the read; the post itself is kept
                    if errors:
                        found.append({"post": row["row_key"], "error": str(failure)[:500] or type(failure).__name__})
            if found:
                made = pd.DataFrame(found).reindex(columns=names).astype(object)
                yield made.where(made.notna(), None)

    schema = f"{schema}, post string, error string" if errors else schema
    names = StructType.fromDDL(schema).names
    return posts.where(F.col("num_comments") >= least).mapInPandas(run, schema)
