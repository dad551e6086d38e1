import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from tillroll.plans.warehouse import Warehouse  # noqa: E402
from tillroll.schema import RAW_SCHEMA, SOURCE_COLUMNS  # noqa: E402
from tillroll.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tillroll-tests", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


GOOD = {
    "invoice_no": "I900",
    "customer_id": "C70",
    "gender": "Female",
    "age": "33",
    "category": "Toys",
    "quantity": "2",
    "price": "12.50",
    "payment_method": "Cash",
    "invoice_date": "7/3/2022",
    "shopping_mall": "Metrocity",
}


@pytest.fixture
def feed(spark):
    """Build a raw feed from partial rows; missing cells come from a good row."""

    def build(*rows):
        full = [{**GOOD, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(row[c] for c in SOURCE_COLUMNS) for row in full], RAW_SCHEMA
        ).coalesce(1)

    return build


@pytest.fixture
def holidays(spark):
    return spark.createDataFrame([("2022-04-23",), ("2022-05-01",)], "date string")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).reset()


@pytest.fixture
def csv_file(tmp_path):
    """Write partial rows as a CSV file and return its path."""

    def write(name, *rows, header=SOURCE_COLUMNS):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [",".join(header)]
        for row in rows:
            full = {**GOOD, **row}
            lines.append(",".join("" if full[c] is None else full[c] for c in SOURCE_COLUMNS))
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write


@pytest.fixture
def json_file(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_text(json.dumps(content), encoding="utf-8")
        return str(path)

    return write
