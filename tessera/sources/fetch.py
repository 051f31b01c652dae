"""Fetching the rows of a manifest: a transport that is given, throttling, retries, and files that appear whole or not at all.

The transport is any callable (url) -> Response, picklable, so that tests and other archives bring their own; :class:`UrlTransport` is that of
the standard library. Each task waits between its requests: give ``tasks`` times the interval a server allows.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.writers import _below, _file_system

# What is gone for good, and what may be better next time.
GONE, TRANSIENT = (404, 410), (403, 429, 500, 502, 503, 504)
#: Seconds between two requests of a task, and the longest wait before a retry.
INTERVAL, LONGEST = 0.15, 60.0
RESULT = "filing_url string, output_path string, status string, bytes_written long, error_message string, attempts int"


class Response(NamedTuple):
    code: int
    body: bytes = b""
    retry_after: str | None = None


class UrlTransport(NamedTuple):
    """GET through the standard library, with the given headers."""

    headers: tuple[tuple[str, str], ...] = ()
    timeout: float = 60.0

    def __call__(self, url: str) -> Response:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=dict(self.headers)), timeout=self.timeout) as r:
                return Response(r.status or 200, r.read())
        except urllib.error.HTTPError as e:
            return Response(e.code, b"", e.headers.get("Retry-After"))


def retry_delay(attempt: int, retry_after: str | None = None) -> float:
    """Seconds to wait after failed attempt ``attempt`` (from 1): what the server asks for, else doubling; never over ``LONGEST``."""
    try:
        return min(LONGEST, max(0.0, float(retry_after))) if retry_after else min(LONGEST, 2.0**attempt)
    except ValueError:
        return min(LONGEST, 2.0**attempt)


class Throttle:
    """Waits until ``interval`` seconds have gone by since the last request."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep, self.last = interval, clock, sleep, float("-inf")

    def wait(self) -> None:
        if (rest := self.interval - (self.clock() - self.last)) > 0:
            self.sleep(rest)
        self.last = self.clock()


def get(url: str, transport: Callable[[str], Response], retries: int, throttle: Throttle, sleep: Callable[[float], None] = time.sleep) -> tuple[Response | None, str, int]:
    """(response, error, attempts): the first answer that is not transient, or the error of the last attempt."""
    error = ""
    for attempt in range(1, retries + 2):
        throttle.wait()
        answer = None
        try:
            answer = transport(url)
            if answer.code not in TRANSIENT:
                return answer, "", attempt
            error = f"HTTP {answer.code}"
        except OSError as e:
            error = str(e)
        if attempt <= retries:
            sleep(retry_delay(attempt, answer.retry_after if answer else None))
    return None, error, retries + 1


def free_bytes(df: DataFrame, root: str) -> int:
    """Bytes the file system of ``root`` has left."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    while not fs.exists(path) and path.getParent() is not None:  # a folder that is still to be made
        path = path.getParent()
    return fs.getStatus(path).getRemaining()


def fetch(rows: DataFrame, root: str, transport: Callable[[str], Response], retries: int = 2, interval: float = INTERVAL, reserve: int = 0, tasks: int | None = None) -> DataFrame:
    """Fetch (filing_url, output_path) to files below ``root``: the rows of the download log.

    status: exists (a file that is not empty is there), downloaded, 404 or 410, else failed (an empty body fails as well). With less than
    ``reserve`` bytes left nothing is begun. An action on the result fetches; rows already there are not fetched again, so a task may be rerun.
    """
    if reserve and (left := free_bytes(rows, root)) < reserve:
        raise OSError(f"{left} bytes left below {root}, {reserve} are reserved")

    def one(fs, base: str, url: str, path: str, throttle: Throttle) -> tuple:
        target = _below(base, path)
        info = fs.get_file_info(target)
        if info.type == pa.fs.FileType.File and info.size > 0:
            return url, path, "exists", 0, "", 0
        answer, error, attempts = get(url, transport, retries, throttle)
        if answer is None:
            return url, path, "failed", 0, error, attempts
        if answer.code in GONE:
            return url, path, str(answer.code), 0, f"{answer.code} Client Error", attempts
        if answer.code != 200 or not answer.body:
            return url, path, "failed", 0, f"HTTP {answer.code}" if answer.code != 200 else "empty body", attempts
        fs.create_dir(target.rpartition("/")[0], recursive=True)
        part = f"{target}.{uuid.uuid4().hex}.part"
        with fs.open_output_stream(part) as f:
            f.write(answer.body)
        fs.move(part, target)
        return url, path, "downloaded", len(answer.body), "", attempts

    types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(root)
        throttle = Throttle(interval)
        for batch in batches:
            done = [one(fs, base, url.strip(), path, throttle) for url, path in zip(*(c.to_pylist() for c in batch.columns)) if url and url.strip() and path]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*done)) or [[]] * 6, types)], [f.split()[0] for f in RESULT.split(", ")])

    wanted = rows.select("filing_url", F.col("output_path"))
    return (wanted.repartition(tasks) if tasks else wanted).mapInArrow(run, RESULT)
