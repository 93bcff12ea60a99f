import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caselake.functions.text import (
    CONTROL_SPACES,
    SPACES,
    build_prompt,
    is_present,
    parse_label,
    scrub,
    short_label,
    strip_whitespace,
    trim_spaces,
)
from caselake.functions.typing import iso_date, parse_iso_timestamp, to_bigint
from caselake.operators import selection
from caselake.operators.dedupe import first_per_key
from caselake.operators.staging import clean_for_training, cleaning_report, stage_cases
from caselake.schemas import STAGED_SCHEMA

LONG = "a narrative that is long enough"


def one(df):
    return df.collect()[0]


def column(df, name):
    return sorted(row[name] for row in df.collect())


def test_staged_schema_and_typing(make_raw):
    staged = stage_cases(make_raw({"complaint_id": "12"}))
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in STAGED_SCHEMA]
    row = one(staged)
    assert row["complaint_id"] == 12
    assert row["date_received"] == datetime.date(2024, 1, 1)  # the next day in the session's zone
    assert row["days_to_route"] == 2
    assert row["was_timely"] is True


def test_timeliness_has_three_values(make_raw):
    raw = make_raw({"timely": "Yes"}, {"timely": "No"}, {"timely": None})
    assert [r["was_timely"] for r in stage_cases(raw).orderBy("complaint_id").collect()] == [True, False, None]


def test_lowest_numeric_id_survives_across_products(make_raw):
    raw = make_raw(
        {"complaint_id": "10", "complaint_what_happened": LONG},
        {"complaint_id": "9", "complaint_what_happened": LONG, "product": "Student loan"},
        {"complaint_id": "100", "complaint_what_happened": f"  {LONG} "},
    )
    assert column(stage_cases(raw), "complaint_id") == [9]


def test_short_and_missing_narratives_go(make_raw):
    texts = [None, "", "x" * 19, "x" * 20, "   " + "y" * 19 + "   ", "é" * 20]
    raw = make_raw(*[{"complaint_what_happened": t} for t in texts])
    assert column(stage_cases(raw), "complaint_id") == [3, 5]


def test_a_hot_text_keeps_one_row_and_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("t")
    )
    kept = first_per_key(df, "t", [F.col("id")])
    assert kept.count() == 2001
    assert kept.filter("t = 'same text'").collect()[0]["id"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


@pytest.mark.parametrize("few", [1, 7, 20_000])
def test_top_per_group_equals_one_window(spark, few, monkeypatch):
    monkeypatch.setattr(selection, "FEW", few)
    df = spark.range(0, 2000, 1, 5).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 9).cast("string")).alias("g"),
        F.xxhash64("id").alias("o"),
    )
    got = {(r["g"], r["id"]) for r in selection.first_per_group(df, "g", [F.col("o")], 30).collect()}
    by_group = {}
    for r in sorted(df.collect(), key=lambda r: r["o"]):
        by_group.setdefault(r["g"], []).append(r["id"])
    assert got == {(g, i) for g, ids in by_group.items() for i in ids[:30]}


def test_strict_timestamps(spark):
    df = spark.createDataFrame([("2024-09-03T22:07:34.000Z",), ("2024-09-03T22:07:34.123456Z",)], "t string")
    assert {r[0] for r in df.select(iso_date(F.col("t"))).collect()} == {datetime.date(2024, 9, 3)}
    for bad in ("2024-09-03T22:07:34Z", "2024-09-03 22:07:34.000Z", "soon"):
        broken = spark.createDataFrame([(bad,)], "t string")
        with pytest.raises(PySparkException):
            broken.select(iso_date(F.col("t"))).collect()


def test_lenient_timestamps(spark):
    df = spark.createDataFrame([("2024-09-03T22:07:34Z",), ("soon",), (None,)], "t string")
    seconds = F.unix_seconds(parse_iso_timestamp(F.col("t"), strict=False))
    assert [r[0] for r in df.select(seconds).collect()] == [1725401254, None, None]


def test_dates_before_1970(spark):
    df = spark.createDataFrame([("1969-12-31T23:59:59.000Z",)], "t string")
    assert one(df.select(iso_date(F.col("t")).alias("d")))["d"] == datetime.date(1969, 12, 31)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_id_fails_in_either_ansi_mode(spark, ansi):
    df = spark.createDataFrame([("x1",)], "c string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            df.select(to_bigint(F.col("c"))).collect()
        assert one(df.select(to_bigint(F.col("c"), strict=False).alias("c")))["c"] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_trim_variants(spark):
    padded = "\t  text \n"
    df = spark.createDataFrame([(padded,), ("　text  ",)], "t string")
    assert [r[0] for r in df.select(trim_spaces(F.col("t"))).collect()] == [padded, "text"]
    assert [r[0] for r in df.select(strip_whitespace(F.col("t"))).collect()] == ["text", "text"]


def test_whitespace_is_what_python_strips():
    assert set(SPACES + CONTROL_SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_training_rows(make_raw):
    raw = make_raw(
        {"complaint_id": "5", "complaint_what_happened": f"\n{LONG}\t"},
        {"complaint_id": "3", "complaint_what_happened": LONG},
        {"product": None}, {"complaint_what_happened": None}, {"complaint_what_happened": "short"},
        {"complaint_id": "8", "complaint_what_happened": LONG + " too"},
    )
    assert column(clean_for_training(raw), "complaint_id") == ["3", "8"]
    assert one(cleaning_report(raw)).asDict() == {
        "rows_before": 6, "rows_after": 2, "duplicates": 1, "missing_or_short": 3,
    }


def test_cleaning_report_of_nothing(make_raw):
    empty = one(cleaning_report(make_raw({}).limit(0)))
    assert tuple(empty) == (0, 0, 0, 0)


def test_label_texts(spark):
    df = spark.createDataFrame([("x" * 18,), ("x" * 19,), ("x" * 22,), ("x" * 23,), (None,)], "c string")
    short = [r[0] for r in df.select(short_label(F.col("c"))).collect()]
    longer = [r[0] for r in df.select(short_label(F.col("c"), 22, 20)).collect()]
    assert short == ["x" * 18] + ["x" * 16 + "…"] * 3 + [None]
    assert longer == ["x" * 18, "x" * 19, "x" * 22, "x" * 20 + "…", None]


def test_parse_label_takes_the_first_in_list_order(spark):
    df = spark.createDataFrame(
        [(" MORTGAGE\n",), ("student loan or credit card?",), ("none of these",), ("",), (None,)], "r string"
    )
    assert [r[0] for r in df.select(parse_label(F.col("r"))).collect()] == [
        "Mortgage", "Credit card", None, None, None,
    ]


def test_prompt_and_scrub(spark):
    df = spark.createDataFrame([("key k1 and K1 k1", "")], "n string, e string")
    prompt = one(df.select(build_prompt(F.col("n"), ["A", "B"]).alias("p")))["p"]
    assert prompt.endswith("Categories:\n- A\n- B\n\nComplaint:\nkey k1 and K1 k1\n\nCategory:")
    assert one(df.select(scrub(F.col("n"), ["k1", None, ""]).alias("s")))["s"] == (
        "key [REDACTED] and K1 [REDACTED]"
    )
    assert one(df.select(is_present(F.col("e")).alias("p")))["p"] is False
