import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"

TRANSACTION_TYPES = (
    "seq long, schema_version string, transaction_id string, customer_id string, card_id string, "
    "merchant_id string, merchant_category string, amount double, currency string, "
    "country_code string, city string, latitude double, longitude double, device_id string, "
    "ip_address string, channel string, event_time timestamp, label boolean"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", "4", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE = {
    "schema_version": "1.0",
    "transaction_id": "11111111-2222-4333-8444-555555555555",
    "customer_id": "customer-81",
    "card_id": "card-7",
    "merchant_id": "merchant-30",
    "merchant_category": "grocery",
    "amount": 41.2,
    "currency": "USD",
    "country_code": "US",
    "city": "Quincy",
    "latitude": 42.25,
    "longitude": -71.0,
    "device_id": "device-55",
    "ip_address": "203.0.113.9",
    "channel": "mobile",
    "event_time": datetime(2026, 1, 1, tzinfo=UTC),
    "label": None,
}


@pytest.fixture(scope="session")
def make(spark):
    """Transactions from dicts of what differs from a valid one; seq is the position."""

    def build(*rows):
        names = [part.strip().split(" ")[0] for part in TRANSACTION_TYPES.split(", ")]
        full = [{"seq": i, **BASE, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], TRANSACTION_TYPES)

    return build
