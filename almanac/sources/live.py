"""A read-only data source for the remote service: one HTTP GET per request, with headers, time limit and retries.

    live.register(spark)
    spark.read.format("encyclopedia").option("requests", json_list).load()
    live.fetch(requests)  # a table of requests, of any length
    with live.cancellable(spark, "lookups"): ...  # live.cancel(spark, "lookups") ends what runs inside

Requests are dealt over partitions; each row is id, url, status, body. Bodies go to almanac.sources.wire.
"""

from __future__ import annotations

import json
import os
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from almanac import params
from almanac.functions.text import HOST
from almanac.runtime import ship

#: Limits of one request (fixed values).
TIMEOUT_S, RETRIES, BASE_S, MOST_S, JITTER = 15, 3, 1.0, 30.0, 0.25
USER_AGENT = "almanac/0.1"
#: The environment variable that replaces it where no option does.
USER_AGENT_ENV = "ALMANAC_USER_AGENT"
_HTML = re.compile(r"\s*<(!DOCTYPE html|html)", re.I)


class Transient(Exception):
    """A failure that may pass."""


def decimal(x: float) -> str:
    """A number as it was given, in full and without an exponent."""
    out = format(Decimal(repr(float(x))), "f")
    return out.removesuffix(".0")


def base_url(language: str) -> str:
    return f"https://{params.language(language)}.{HOST}"


def action_url(base: str, **query) -> str:
    return f"{base}/w/api.php?{urllib.parse.urlencode({**query, 'format': 'json', 'formatversion': 2})}"


def summary_url(base: str, title: str) -> str:
    return f"{base}/api/rest_v1/page/summary/{urllib.parse.quote(title.replace(' ', '_'), safe=chr(33) + chr(42) + chr(39) + '()')}"


#: Operator to the parameters of its request (fixed names of the remote interface).
QUERIES: dict[str, Callable[..., dict]] = {
    "search": lambda query, limit=params.SEARCH_LIMIT: dict(action="query", list="search", srsearch=query, srlimit=params.row_limit(limit), srprop="snippet|wordcount"),
    "article": lambda title: dict(action="query", prop="extracts", titles=title, explaintext="true", exsectionformat="wiki"),
    "section": lambda title, section_index: dict(action="parse", page=title, prop="wikitext", section=params.section_index(section_index)),
    "sections": lambda title: dict(action="parse", page=title, prop="sections"),
    "languages": lambda title: dict(action="query", prop="langlinks", titles=title, lllimit=params.MOST_LINKS, llprop="url"),
    "nearby": lambda latitude, longitude, radius_meters=params.RADIUS, limit=params.NEARBY_LIMIT: dict(action="query", list="geosearch", gscoord="|".join(map(decimal, params.coordinates(latitude, longitude))), gsradius=params.radius(radius_meters), gslimit=params.row_limit(limit)),
}


def url_of(operator: str, language: str, base: str | None = None, **parameters) -> str:
    base = base or base_url(language)
    if operator == "summary":
        return summary_url(base, parameters["title"])
    return action_url(base, **QUERIES[operator](**parameters))


def get(url: str, user_agent: str = USER_AGENT, timeout: float = TIMEOUT_S) -> tuple[int, str]:
    """Status and body; a page of HTML, a server's error or a lost connection is Transient."""
    request = urllib.request.Request(url, headers={"User-Agent": user_agent, "Accept": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            status, body = r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        if e.code == 429 or e.code >= 500:
            raise Transient(f"{url}: {e.code}") from None
        return e.code, e.read().decode(errors="replace")
    except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
        raise Transient(f"{url}: {e}") from None
    if _HTML.match(body):
        raise Transient(f"{url}: HTML where JSON was asked for")
    return status, body


def with_retry(f: Callable[[], tuple[int, str]], retries: int = RETRIES, base: float = BASE_S, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str]:
    """f(), again after a growing pause while it is Transient."""
    for n in range(retries + 1):
        try:
            return f()
        except Transient:
            if n == retries:
                raise
            pause = min(MOST_S, base * 2**n)
            sleep(pause * (1 + JITTER * (2 * random.random() - 1)))
    raise AssertionError


def user_agent(option: str | None = None) -> str:
    return option or os.environ.get(USER_AGENT_ENV) or USER_AGENT


def answer(operator: str, language: str, parameters: dict, base: str | None, agent: str, retries: int, pause: float) -> tuple[str | None, int, str]:
    """URL, status and body of one request. What cannot be asked has status 400, what stays transient 503; neither ends the others."""
    try:
        url = url_of(operator, language, base, **parameters)
    except (params.ValidationError, KeyError, TypeError) as e:
        return None, 400, str(e)
    try:
        return url, *with_retry(lambda: get(url, agent), retries, pause)
    except Transient as e:
        return url, 503, str(e)


#: How the parameters of a request table's map are read; others stay text.
_TYPES = {"limit": int, "section_index": int, "radius_meters": int, "latitude": float, "longitude": float}


def fetch(requests: DataFrame, agent: str | None = None, base: str | None = None, retries: int = RETRIES, pause: float = BASE_S) -> DataFrame:
    """requests (id, operator, language, parameters: map of texts) to id, url, status, body. The table's partitions are asked side by side."""
    ship(requests.sparkSession)
    agent = user_agent(agent)

    def typed(name: str, value: str | None):
        try:
            return _TYPES.get(name, str)(value) if value is not None else None
        except ValueError:
            return value  # refused where it is checked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                given = {k: typed(k, v) for k, v in (row["parameters"] or [])}
                found = answer(row["operator"], row["language"] or "en", given, base, agent, retries, pause)
                yield pa.RecordBatch.from_pylist([{"id": row["id"], **dict(zip(("url", "status", "body"), found))}], _ANSWERS)

    return requests.select(F.col("id").cast("long").alias("id"), "operator", "language", "parameters").mapInArrow(run, "id long, url string, status int, body string")


_ANSWERS = pa.schema([("id", pa.int64()), ("url", pa.string()), ("status", pa.int32()), ("body", pa.string())])


@contextmanager
def cancellable(spark: SparkSession, tag: str):
    """Jobs started inside can be ended by cancel(); their requests end with their tasks."""
    spark.sparkContext.addJobTag(tag)
    spark.sparkContext.setInterruptOnCancel(True)
    try:
        yield
    finally:
        spark.sparkContext.removeJobTag(tag)


def cancel(spark: SparkSession, tag: str) -> None:
    spark.sparkContext.cancelJobsWithTag(tag)


class _Part(InputPartition):
    def __init__(self, requests: list):
        self.requests = requests


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.requests = json.loads(options.get("requests", "[]"))
        self.parts = int(options.get("partitions", "8"))
        self.agent, self.base = user_agent(options.get("useragent")), options.get("baseurl")
        self.retries, self.pause = int(options.get("retries", RETRIES)), float(options.get("pause", BASE_S))

    def partitions(self) -> list[InputPartition]:
        n = max(1, min(self.parts, len(self.requests)))
        return [_Part(self.requests[i::n]) for i in range(n)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for r in partition.requests:
            r = dict(r)
            number, operator, language = r.pop("id"), r.pop("operator"), r.pop("language", "en")
            yield number, *answer(operator, language, r, self.base, self.agent, self.retries, self.pause)


class RemoteSource(DataSource):
    """Options: requests (JSON list of {id, operator, language, ...}), partitions, userAgent, baseUrl, retries, pause."""

    @classmethod
    def name(cls) -> str:
        return "encyclopedia"

    def schema(self) -> str:
        return "id long, url string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(RemoteSource)
