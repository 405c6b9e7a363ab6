"""Paged and keyset sources behind a plain ``fetch`` callable; network clients plug in, tests use lists."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

WINDOW, PAGE = 10_000, 25


def windows(count: Callable[[int, int], int], start: int, end: int, most: int = WINDOW, should_skip: Callable | None = None) -> Iterator[tuple[int, int]]:
    """Half-open ranges of seconds that hold at most ``most`` hits, or are one second long."""
    open_ = [(start, end)]
    while open_:
        a, b = open_.pop()
        if should_skip and should_skip(a, b):
            continue
        if count(a, b) <= most or b - a <= 1:
            yield a, b
        else:
            m = (a + b) // 2
            open_ += [(m, b), (a, m)]


def pages(fetch: Callable[[int, int], list], most: int = WINDOW, size: int = PAGE) -> Iterator:
    for n in range(1, -(-most // size) + 1):
        got = fetch(n, size)
        yield from got
        if len(got) < size:
            return


def keyset_page(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """The next page by a unique key: a filter that reaches the scan and a top-n."""
    return (df if after is None else df.where(F.col(key) > after)).orderBy(key).limit(n)


def many(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of queries' results, each row with its query."""
    out = None
    for q, f in frames.items():
        f = f.withColumn("query", F.lit(q))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def query_set(fixed: list[str], left: list[str], right: list[str]) -> list[str]:
    """Fixed queries and the cross product of two word lists."""
    return [*fixed, *[f"{a} AND {b}" for a in left for b in right]]


def batches(sizes: list[int], most: int = 256, most_bytes: int = 256 << 20) -> list[int]:
    """Batch number of each range: flushed at ``most`` ranges or bytes; a huge one stands alone."""
    out, b, n, total = [], 0, 0, 0
    for s in sizes:
        if n and (n >= most or total + s > most_bytes or s >= most_bytes):
            b, n, total = b + 1, 0, 0
        out.append(b)
        n, total = n + 1, total + s
    return out


class _Window(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        self.start, self.end = start, end


class _Pages(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.client, self.start, self.end, self.most = options["client"], int(options["start"]), int(options["end"]), int(options.get("most", WINDOW))

    def _made(self):
        module, name = self.client.split(":")
        return getattr(importlib.import_module(module), name)()

    def partitions(self):
        return [_Window(a, b) for a, b in windows(self._made().count, self.start, self.end, self.most)]

    def read(self, part):
        from provlake.sources.ranges import retrying

        fetch = retrying(self._made().page)
        for hit in pages(lambda n, size: fetch(part.start, part.end, n, size), self.most):
            yield part.start, json.dumps(hit)


class PagedSearch(DataSource):
    """(window, hit): a search's hits as JSON text, a task for each window of time that the search can give whole.

    ``client`` names a factory, ``module:function``, of an object with count(start, end) and page(start, end, number, size);
    ``start`` and ``end`` are seconds, ``most`` the hits that one window may have."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "window long, hit string"

    def reader(self, schema) -> DataSourceReader:
        return _Pages(self.options)
