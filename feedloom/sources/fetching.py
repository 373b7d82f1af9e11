"""Bringing documents by address: one policy for feeds and pages, retries, size bounds.

The transport is a callable that the caller gives (tests give a table in a dict), so nothing here needs a
network; it runs in Arrow batches, one request at a time per task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class FetchError(RuntimeError):
    """A document that cannot be had; another attempt would not help."""


class TryAgain(FetchError):
    """A failure that another attempt may mend: connection, timeout, 429, 5xx or no real status."""


class Response(Protocol):
    status: int
    headers: Mapping[str, str]

    def chunks(self) -> Iterable[bytes]: ...


@dataclass(frozen=True)
class Policy:
    user_agent: str = "feedloom"
    connect_s: float = 10.0
    read_s: float = 20.0
    most_mb: int = 5
    attempts: int = 3
    pause_s: float = 1.0

    @property
    def most_bytes(self) -> int:
        return self.most_mb * 1024 * 1024


#: What opens an address: raises TryAgain for connections and timeouts, FetchError for other failures.
Opener = Callable[[str, Policy], Response]


def worth_retrying(error: BaseException) -> bool:
    return isinstance(error, TryAgain)


def check_status(status: int, url: str) -> None:
    if status == 429 or status >= 500:
        raise TryAgain(f"status {status}: {url}")
    if status >= 400:
        raise FetchError(f"status {status}: {url}")


def fetch_once(url: str, policy: Policy, opener: Opener) -> bytes:
    """The body, refused by its declared size before it is read and by its real size while it is."""
    response = opener(url, policy)
    check_status(response.status, url)
    declared = {k.lower(): v for k, v in response.headers.items()}.get("content-length", "")
    if declared.strip().isdigit() and int(declared) > policy.most_bytes:
        raise FetchError(f"too large ({declared.strip()} bytes): {url}")
    body = bytearray()
    for chunk in response.chunks():
        body += chunk
        if len(body) > policy.most_bytes:
            raise FetchError(f"too large: {url}")
    return bytes(body)


def fetch(url: str, policy: Policy, opener: Opener, sleep: Callable[[float], None] = time.sleep) -> bytes:
    for attempt in range(1, policy.attempts + 1):
        try:
            return fetch_once(url, policy, opener)
        except Exception as e:
            if not worth_retrying(e) or attempt == policy.attempts:
                raise e if isinstance(e, FetchError) else FetchError(str(e)) from e
            sleep(policy.pause_s)
    raise FetchError(f"no attempt allowed: {url}")


def fetched(rows: DataFrame, opener: Opener, policy: Policy = Policy(), url: str = "url") -> DataFrame:  # noqa: B008
    """``rows`` with ``body`` and ``fetch_error``, one of them null; a null address is an error."""
    names = [c for c in rows.columns if c not in ("body", "fetch_error")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got: list[tuple[bytes | None, str | None]] = []
            for u in b[url]:
                try:
                    got.append((fetch(u, policy, opener), None) if u else (None, "no address"))
                except FetchError as e:
                    got.append((None, str(e)))
            yield b[names].assign(body=[x for x, _ in got], fetch_error=[x for _, x in got])

    return rows.mapInPandas(run, f"{fields}, body binary, fetch_error string")
