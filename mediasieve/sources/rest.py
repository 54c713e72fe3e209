"""A paged REST scan as a Spark data source: one partition for each value of the query, pages in turn inside it."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, LessThan

PAGE_COUNTS = ("numPages", "num_pages", "page_count", "pages")


def get(url: str, retries: int = 4, wait: float = 0.2, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> dict | None:
    """A JSON document; None for a refusal (4xx) or after retries of failures, each twice as long apart."""
    for k in range(retries + 1):
        sleep(wait)
        try:
            with opener(url, timeout=30) as answer:
                return json.loads(answer.read())
        except urllib.error.HTTPError as e:
            if 400 <= e.code < 500:
                return None
        except (OSError, ValueError):
            pass
        if k < retries:
            sleep(2**k)
    return None


def pages(fetch: Callable[[int], dict | None], drop=("sono", "osci")) -> Iterator[dict]:
    """Records of page 1 and on, until the last page by the count given, an empty page, or none."""
    page, last = 1, 1
    while page <= last:
        answer = fetch(page)
        records = (answer or {}).get("recordings") or []
        if not records:
            return
        last = next((int(answer[k]) for k in PAGE_COUNTS if answer.get(k)), last)
        for r in records:
            yield {k: v for k, v in r.items() if k not in drop}
        page += 1


class _Value(InputPartition):
    def __init__(self, value: str):
        self.value = value


class RestReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.options = schema, dict(options)
        self.values = [v for v in self.options.get("values", "").split(",") if v]
        self.before: int | None = int(self.options["yearBefore"]) if "yearBefore" in self.options else None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """The value of the query and an upper bound of the year go to the server."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == (self.options.get("column", "cnt"),):
                self.values = [v for v in self.values if v == f.value]
            elif isinstance(f, LessThan) and f.attribute == ("year",):
                self.before = min(int(f.value), self.before or int(f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [_Value(v) for v in self.values]

    def read(self, partition: _Value) -> Iterator[tuple]:
        base, query = self.options["url"], f'{self.options.get("column", "cnt")}:"{partition.value}"'
        if self.before is not None:
            query += f" year:<{self.before}"
        names = [f.name for f in self.schema.fields]

        def fetch(page: int) -> dict | None:
            return get(f"{base}?{urllib.parse.urlencode({'query': query, 'page': page, 'key': self.options.get('key', '')})}", wait=float(self.options.get("wait", "0.2")))

        for r in pages(fetch):
            yield tuple(None if r.get(n) is None else str(r[n]) for n in names)


class RestSource(DataSource):
    """register(spark); spark.read.format("paged_rest").schema(text columns).option("url", ...).option("values", "a,b").load()"""

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def reader(self, schema) -> DataSourceReader:
        return RestReader(schema, self.options)


def register(spark) -> None:
    """Makes the source known, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RestSource)


def download(url: str, retries: int = 3, least: int = 1024, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> tuple[bytes | None, str, float]:
    """Bytes of a URL (or None), why not, and seconds. Fewer than least bytes are a failure; refusals aren't tried again."""
    began, why = time.time(), ""
    for k in range(retries + 1):
        try:
            with opener(url, timeout=60) as answer:
                body = answer.read()
            if len(body) >= least:
                return body, "", time.time() - began
            why = f"too small: {len(body)} bytes"
        except urllib.error.HTTPError as e:
            return None, f"HTTP {e.code}", time.time() - began
        except OSError as e:
            why = str(e)
        if k < retries:
            sleep(2**k)
    return None, why, time.time() - began


def downloaded(rows, url_col: str, key_col: str, opener: Callable | None = None):
    """rows with content, bytes, error and elapsed_s. A task that is tried again downloads again: write the result once and read it from there."""
    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("content binary, bytes long, error string, elapsed_s double").fields])

    def run(batches):
        import pandas as pd

        for pdf in batches:
            got = [download(u, opener=opener or urllib.request.urlopen) if u else (None, "no_url", 0.0) for u in pdf[url_col]]
            yield pdf.assign(content=[g[0] for g in got], bytes=pd.array([len(g[0]) if g[0] else 0 for g in got], dtype="int64"), error=[g[1] for g in got], elapsed_s=[g[2] for g in got])

    return rows.mapInPandas(run, schema)
