import copy
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def money(amount, currency="EUR"):
    return {"gross": {"amount": amount, "currency": currency}}


ORDER = {
    "id": "ord-a",
    "number": "A/17",
    "created": "2025-05-02T08:15:00Z",
    "updatedAt": "2025-05-02T09:45:00Z",
    "status": "FULFILLED",
    "channel": {"slug": "north", "currencyCode": "EUR"},
    "total": money("37.50"),
    "lines": [
        {
            "id": "ord-a/1",
            "productName": "Desk lamp",
            "productSku": "DL-9",
            "quantity": 3,
            "unitPrice": money("12.50"),
            "totalPrice": money("37.50"),
        }
    ],
}


def make_order(**changes):
    """A valid raw order; dotted paths set nested values, ``DROP`` removes a key."""
    raw = copy.deepcopy(ORDER)
    for path, value in changes.items():
        target, keys = raw, path.split("__")
        for key in keys[:-1]:
            target = target[int(key) if key.isdigit() else key]
        last = int(keys[-1]) if keys[-1].isdigit() else keys[-1]
        if value is DROP:
            del target[last]
        else:
            target[last] = value
    return raw


@pytest.fixture(scope="session")
def order():
    return make_order


DROP = object()


@pytest.fixture
def drop():
    return DROP


def write_rows(folder, *rows, name="input.jsonl"):
    path = folder / name
    text = [row if isinstance(row, str) else json.dumps(row) for row in rows]
    path.write_text("".join(f"{line}\n" for line in text), encoding="utf-8")
    return str(path)


@pytest.fixture
def write_lines(tmp_path):
    return lambda *rows, **how: write_rows(tmp_path, *rows, **how)
