"""Keyed state of the scoring stream: remembered times, devices and countries.

The processor sees the rows of one customer in one micro-batch and keeps their arrival
order.  It only derives the features; rules and model run as column expressions after it.
"""

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskloom.config import DEFAULTS, Settings
from riskloom.functions.scoring import risky_merchant

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What a decision needs; nothing else travels through the Python workers.
CARRIED = (
    "transaction_id string, customer_id string, event_time timestamp, amount double, "
    "currency string, merchant_category string, device_id string, country_code string, "
    "label boolean, topic string, partition int, offset long, timestamp timestamp"
)
DERIVED = "transaction_count_5m int, is_new_device boolean, is_new_country boolean"
CARRIED_NAMES = [column.strip().split(" ")[0] for column in CARRIED.split(", ")]


class SeenValues:
    """A set of texts in a map state; known members are looked up once per batch.

    With `refresh`, a member's time to live starts again with every batch that uses it.
    """

    def __init__(self, state, refresh: bool) -> None:
        self._state = state
        self._refresh = refresh
        self._known: dict[str, bool] = {}

    def start(self) -> None:
        self._known.clear()

    def is_new(self, value: str) -> bool:
        known = self._known.get(value)
        if known is None:
            known = self._state.containsKey((value,))
            if not known or self._refresh:
                self._state.updateValue((value,), (True,))
        self._known[value] = True
        return not known


class CustomerHistory(StatefulProcessor):
    def __init__(self, window_seconds: int, ttl_ms: int | None) -> None:
        self._window_us = window_seconds * 1_000_000
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._times = handle.getListState("times", "at long", self._ttl_ms)
        self._devices = SeenValues(
            handle.getMapState("devices", "value string", "seen boolean", self._ttl_ms),
            self._ttl_ms is not None,
        )
        self._countries = SeenValues(
            handle.getMapState("countries", "value string", "seen boolean", self._ttl_ms),
            self._ttl_ms is not None,
        )
        self._known_customer = handle.getValueState("known", "seen boolean", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Several Arrow chunks may arrive for one key; the trigger bounds their sum.
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["partition", "offset"], kind="stable", ignore_index=True)
        remembered = [row[0] for row in self._times.get()] if self._times.exists() else []
        heapify(remembered)
        known = self._known_customer.exists()
        self._devices.start()
        self._countries.start()

        micros = batch["event_time"].astype("datetime64[us]").astype("int64")
        counts, new_devices, new_countries = [], [], []
        for at, device, country in zip(
            micros, batch["device_id"], batch["country_code"], strict=True
        ):
            while remembered and remembered[0] < at - self._window_us:
                heappop(remembered)
            heappush(remembered, at)
            counts.append(len(remembered))
            # Both sets are asked every time, so that they learn the first values too.
            new_device = self._devices.is_new(device)
            new_country = self._countries.is_new(country)
            new_devices.append(new_device and known)
            new_countries.append(new_country and known)
            known = True

        self._times.put([(int(at),) for at in remembered])
        self._known_customer.update((True,))
        yield batch.assign(
            transaction_count_5m=pd.Series(counts, dtype="int32"),
            is_new_device=new_devices,
            is_new_country=new_countries,
        )

    def close(self) -> None:
        pass


def with_stream_features(
    transactions: DataFrame, settings: Settings = DEFAULTS, ttl_ms: int | None = None
) -> DataFrame:
    """Adds the derived features to a stream of valid transactions, in arrival order.

    Without `ttl_ms` nothing a customer did is ever forgotten, and there is no watermark:
    late events are scored like any other.
    """
    transactions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        transactions.select(*CARRIED_NAMES)
        .groupBy("customer_id")
        .transformWithStateInPandas(
            statefulProcessor=CustomerHistory(settings.velocity_window_seconds, ttl_ms),
            outputStructType=f"{CARRIED}, {DERIVED}",
            outputMode="Append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
        )
        .withColumn("is_risky_merchant", risky_merchant(F.col("merchant_category")))
    )
