from __future__ import annotations

import csv
import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstar.plans.star import build_star  # noqa: E402
from tillstar.schemas import RAW_COLUMNS, raw_columns  # noqa: E402
from tillstar.session import local_session  # noqa: E402
from tillstar.sources.warehouse import staged  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


GOOD = {
    "item_id": "1",
    "order_id": "1",
    "item_name_id": "garden_m",
    "quantity": "1",
    "order_date": "01-01-2015",
    "order_time": "11:38:36",
    "unit_price": "13.25",
    "total_price": "13.25",
    "item_size": "M",
    "item_category": "Classic",
    "item_ingredients": "Tomatoes, Goat Cheese",
    "item_name": "The Garden Item",
}


@pytest.fixture(scope="session")
def raw(spark):
    """raw(row, ...) -> frame of text rows; each row only names what differs from a good one."""

    def make(*rows: dict):
        full = [{**GOOD, **{k: str(v) for k, v in r.items()}} for r in rows]
        data = [(i, *[r[c] for c in RAW_COLUMNS]) for i, r in enumerate(full)]
        schema = "_row bigint, " + ", ".join(f"{c} string" for c in RAW_COLUMNS)
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def write_csv():
    def write(path: Path, rows: list[dict], noun: str = "item", columns: list[str] | None = None):
        names = dict(zip(RAW_COLUMNS, raw_columns(noun)))
        wanted = columns or RAW_COLUMNS
        with open(path, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow([names[c] for c in wanted])
            for r in rows:
                full = {**GOOD, **{k: str(v) for k, v in r.items()}}
                out.writerow([full[c] for c in wanted])
        return str(path)

    return write


LINES = (
    "item_id bigint, order_id bigint, item_name_id string, order_ts timestamp_ntz, quantity int, "
    "unit_price decimal(10,2), total_price decimal(18,2), total_price_source decimal(18,2), "
    "price_variance_flag boolean, item_size string, item_category string, "
    "item_ingredients string, item_name string"
)


@pytest.fixture(scope="session")
def lines(spark):
    """lines((order, product, when, quantity, price), ...) -> clean lines of size M."""

    def make(*rows):
        data = []
        for i, (order, product, when, quantity, price) in enumerate(rows, 1):
            p = Decimal(str(price)).quantize(Decimal("0.01"))
            data.append(
                (i, order, f"{product}_m", datetime.fromisoformat(when), quantity, p,
                 p * quantity, p * quantity, False, "M", "Classic", "Tomatoes, Feta",
                 f"The {product.title()} Item")
            )
        return spark.createDataFrame(data, LINES)

    return make


@pytest.fixture(scope="session")
def star(lines, tmp_path_factory):
    """star((order, product, when, quantity, price), ...); the same rows are built once."""
    built = {}

    def make(*rows):
        if rows not in built:
            folder = str(tmp_path_factory.mktemp("star"))
            built[rows] = build_star(lines(*rows), lambda df, name: staged(df, folder, name))
        return built[rows]

    return make
