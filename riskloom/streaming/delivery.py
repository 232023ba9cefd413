"""Alert delivery with a bounded number of attempts."""

import time
from collections.abc import Callable
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame

from riskloom.config import DEFAULTS, Settings

OUTCOME = "attempts int, delivered boolean"


def attempt_all(
    deliver: Callable[[str], None],
    payloads: list[str],
    max_attempts: int,
    backoff_seconds: float,
    sleep: Callable[[float], None] = time.sleep,
) -> list[tuple[int, bool]]:
    """Calls `deliver` for all payloads, waits, and calls it again for those that raised.

    The wait doubles after each round and is taken once for all that failed; there is none after the last.
    """
    outcome = [(max_attempts, False)] * len(payloads)
    waiting = list(range(len(payloads)))
    for number in range(1, max_attempts + 1):
        failed = []
        for i in waiting:
            try:
                deliver(payloads[i])
                outcome[i] = (number, True)
            except Exception:
                failed.append(i)
        waiting = failed
        if not waiting:
            break
        if number < max_attempts:
            sleep(backoff_seconds * 2 ** (number - 1))
    return outcome


def attempt(
    deliver: Callable[[str], None],
    payload: str,
    max_attempts: int,
    backoff_seconds: float,
    sleep: Callable[[float], None] = time.sleep,
) -> tuple[int, bool]:
    """The same for one payload."""
    return attempt_all(deliver, [payload], max_attempts, backoff_seconds, sleep)[0]


def _attempt_batches(batches, deliver, max_attempts, backoff_seconds, sleep):
    for batch in batches:
        payloads = [bytes(value).decode() for value in batch["value"]]
        tried = attempt_all(deliver, payloads, max_attempts, backoff_seconds, sleep)
        yield batch.assign(
            attempts=pd.Series([t[0] for t in tried], dtype="int32", index=batch.index),
            delivered=[t[1] for t in tried],
        )


def deliver_alerts(
    alerts: DataFrame,
    deliver: Callable[[str], None],
    settings: Settings = DEFAULTS,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Alert messages with the outcome of their delivery; every partition delivers its own.

    `deliver` runs on the executors and signals failure by raising.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in alerts.schema)
    run = partial(
        _attempt_batches,
        deliver=deliver,
        max_attempts=settings.alert_max_attempts,
        backoff_seconds=settings.alert_backoff_seconds,
        sleep=sleep,
    )
    return alerts.mapInPandas(run, f"{schema}, {OUTCOME}")
