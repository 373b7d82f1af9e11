"""Services that a run is given from outside: language models, speech, sheets and chat.

Each is a small callable or protocol; none is called in a plan that has not been handed one. Calls run in
Arrow batches, with the client made once per task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame


class ServiceError(RuntimeError):
    """A call that failed for good: only its row fails."""


class ServiceBusy(ServiceError):
    """A call that may succeed later: 429, 5xx, transport."""


class ServiceFatal(RuntimeError):
    """A failure that no row can outlive: 401, 403, 404. It ends the run."""


class SetupError(ValueError):
    """A service that cannot be set up."""


class TextModel(Protocol):
    def __call__(self, prompt: str, label: str) -> str: ...


class Transcriber(Protocol):
    def __call__(self, url: str) -> str: ...


class Worksheet(Protocol):
    def fetch_all(self) -> Sequence[Sequence[object]]: ...

    def append_row(self, values: list[str]) -> None: ...

    def update_row(self, row_number: int, values: list[str]) -> None: ...


def error_of_status(status: int, detail: str = "") -> Exception:
    """The error that a provider's status means."""
    text = f"status {status}: {detail}" if detail else f"status {status}"
    if status in (401, 403, 404):
        return ServiceFatal(text)
    return ServiceBusy(text) if status == 429 or status >= 500 else ServiceError(text)


def backoff(attempt: int, first: float, factor: float, most: float) -> float:
    """Seconds before attempt 2, 3, ...: growing by ``factor`` from ``first``, at most ``most``."""
    return min(most, first * factor ** (attempt - 2)) if attempt >= 2 else 0.0


class Paced:
    """A text model held to so many starts a minute, tried again while it is busy."""

    def __init__(self, call: TextModel, *, per_minute: float, attempts: int = 3, first: float = 1.0, factor: float = 2.0, most: float = 30.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.call, self.spacing, self.attempts = call, 60.0 / per_minute, attempts
        self.growth, self.clock, self.sleep, self.started = (first, factor, most), clock, sleep, None

    def __call__(self, prompt: str, label: str) -> str:
        ended = None
        for attempt in range(1, self.attempts + 1):
            now = self.clock()
            due = [now] + ([] if self.started is None else [self.started + self.spacing]) + ([] if ended is None else [ended + backoff(attempt, *self.growth)])
            if max(due) > now:
                self.sleep(max(due) - now)
            self.started = self.clock()
            try:
                text = self.call(prompt, label)
            except ServiceBusy:
                ended = self.clock()
                if attempt == self.attempts:
                    raise
                continue
            if not isinstance(text, str) or not text.strip():
                raise ServiceError("empty answer")
            return text
        raise ServiceError("no attempt allowed")


def text_model(provider: str, providers: Mapping[str, Callable[[], TextModel]]) -> TextModel:
    """The client of the named provider."""
    if provider not in providers:
        raise SetupError(f"unknown provider {provider!r}; known: {', '.join(sorted(providers))}")
    return providers[provider]()


def api_key(env: Mapping[str, str], name: str, configured: str | None = None) -> tuple[str, str]:
    """(key, where it is from): the environment first, then the settings."""
    for value, source in ((env.get(name), "env"), (configured, "config")):
        if value and value.strip():
            return value.strip(), source
    raise SetupError(f"no API key: set {name} or give one in the settings")


def called(rows: DataFrame, make: Callable[[], Callable[..., str]], args: Sequence[str], out: str = "response") -> DataFrame:
    """``rows`` with the answer of a service to the columns ``args`` and ``<out>_error``, one of them null.

    ``make`` builds the client, once per task, so that models are loaded there. Rows with a null
    argument are not asked. A :class:`ServiceFatal` ends the job; any other failure is the row's own.
    """
    names = [c for c in rows.columns if c not in (out, f"{out}_error")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = None
        for b in batches:
            got: list[tuple[str | None, str | None]] = []
            for values in b[list(args)].itertuples(index=False, name=None):
                if any(v is None or v != v for v in values):
                    got.append((None, None))
                    continue
                client = client or make()
                try:
                    got.append((client(*values), None))
                except ServiceFatal:
                    raise
                except Exception as e:
                    got.append((None, str(e) or type(e).__name__))
            yield b[names].assign(**{out: [x for x, _ in got], f"{out}_error": [x for _, x in got]})

    return rows.mapInPandas(run, f"{fields}, `{out}` string, `{out}_error` string")


def send_message(url: str, text: str, post: Callable[..., Any], timeout_s: int = 20) -> None:
    """Posts to a chat webhook; any status but 2xx is an error with the answer's text."""
    try:
        answer = post(url, json={"text": text}, timeout=timeout_s)
    except Exception as e:
        raise ServiceError(f"not sent: {e}") from e
    status = getattr(answer, "status_code", None)
    if not isinstance(status, int) or not 200 <= status < 300:
        detail = str(getattr(answer, "text", "") or "").strip()
        raise ServiceError(f"not sent, status {status}" + (f": {detail}" if detail else ""))


def write_sheet(changes: DataFrame, sheet: Worksheet, order: str = "rank") -> tuple[int, int]:
    """(inserted, updated): the changes in order, one call each. A run's rows are bounded by its limit."""
    done = {"insert": 0, "update": 0}
    for r in changes.orderBy(order).toLocalIterator():
        if r["action"] == "insert":
            sheet.append_row(list(r["cells"]))
        else:
            sheet.update_row(r["row_number"], list(r["cells"]))
        done[r["action"]] += 1
    return done["insert"], done["update"]
