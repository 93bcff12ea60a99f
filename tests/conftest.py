import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "Asia/Tokyo")  # results must not depend on it
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def make_raw(spark):
    """Raw records from dicts; fields not given get a sound default."""
    from caselake.schemas import RAW_FIELDS, text_schema

    default = {
        "product": "Mortgage", "company": "BankA", "timely": "Yes", "company_response": "Closed",
        "date_received": "2024-01-01T22:07:34.000Z", "date_sent_to_company": "2024-01-03T01:00:00.000Z",
    }

    def make(*records):
        rows = []
        for i, given in enumerate(records):
            text = f"narrative number {i} is long enough"
            record = {**default, "complaint_id": str(i), "complaint_what_happened": text, **given}
            rows.append(tuple(record.get(f) for f in RAW_FIELDS))
        return spark.createDataFrame(rows, text_schema())

    return make
