"""Ingestion: adapters give pending units; each unit is fetched and written, and a failure of one doesn't stop the others."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame

from tessera.sources.datasets import Lake

RETRY_STATUS = {429, 500, 502, 503, 504}


@dataclass(frozen=True)
class Unit:
    dataset: str
    key: str
    parameters: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Result:
    unit: Unit
    status: str
    rows: int = 0
    reason: str = ""


class Adapter(Protocol):
    def pending(self, lake: Lake) -> Iterable[Unit]: ...

    def fetch(self, unit: Unit) -> DataFrame: ...

    def date_column(self) -> str: ...


class TemporaryFailure(Exception):
    """A status worth another try."""


def with_retries(call: Callable, tries: int = 3, pause_s: float = 0.5, sleep: Callable[[float], None] = time.sleep):
    """Calls again after TemporaryFailure and timeouts, each time after twice the pause."""
    for k in range(tries):
        try:
            return call()
        except (TemporaryFailure, TimeoutError):
            if k == tries - 1:
                raise
            sleep(pause_s * 2**k)


def run(adapters: Iterable[Adapter], lake: Lake, mode: str = "fail") -> list[Result]:
    out: list[Result] = []
    for adapter in adapters:
        for unit in adapter.pending(lake):
            try:
                df = with_retries(lambda: adapter.fetch(unit))  # noqa: B023
                rows = df.count()
                if rows:
                    lake.write(df, unit.dataset, adapter.date_column(), mode, unit.parameters, unit.dataset)
                out.append(Result(unit, "written" if rows else "empty", rows))
            except Exception as error:  # one unit's failure is its result
                out.append(Result(unit, "skipped", 0, f"error: {error}"[:500]))
    return out
