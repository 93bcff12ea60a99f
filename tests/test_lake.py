import json
import os

import pytest

from caselake.operators.checks import (
    CheckFailure,
    case_checks,
    check_accepted,
    check_non_negative,
    check_not_null,
    check_unique,
    run_checks,
)
from caselake.plans import daily
from caselake.schemas import RAW_FIELDS
from caselake.sources import lake, landed


def failures(df):
    return {(r["check"], r["column"]): r["failures"] for r in df.collect()}


def test_checks_count_violations(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", -1), (2, None, None), (None, "c", -5), (None, "c", 0)],
                               "id bigint, kind string, days bigint")
    assert failures(check_unique(df, "id", "t")) == {("unique", "id"): 1}
    assert failures(check_not_null(df, ["id", "kind"], "t")) == {("not_null", "id"): 2, ("not_null", "kind"): 1}
    assert failures(check_accepted(df, "kind", ["a"], "t")) == {("accepted_values", "kind"): 2}
    assert failures(check_non_negative(df, ["days"], "t")) == {("non_negative", "days"): 2}


def test_suite_has_fifteen_checks(make_raw):
    tables = daily.build_tables(make_raw(*[{} for _ in range(12)]))
    results = run_checks(tables).collect()
    assert len(results) == 15
    assert sum(r["failures"] for r in results) == 0


def test_daily_build_exports_and_reruns(spark, make_raw, tmp_path):
    root = str(tmp_path)
    raw = make_raw(*[{"company": "A" if i < 12 else "B", "timely": "Yes" if i < 12 else "No"} for i in range(20)])
    first = {r["dataset"]: (r["kind"], r["rows"]) for r in daily.run_daily(raw, root, "2024-03-01").collect()}
    assert first == {
        "mart_complaints_by_category": ("mart", 1), "mart_company_response_analysis": ("mart", 1),
        "mart_top_companies": ("mart", 1), "stg_complaints": ("fact table", 20),
    }
    daily.run_daily(raw.limit(15), root, "2024-03-02")
    daily.run_daily(raw, root, "2024-03-01")  # the same date again replaces that date only
    assert lake.snapshot_dates(spark, root, daily.FACTS) == ["2024-03-01", "2024-03-02"]
    counts = {d: lake.read_lake(spark, root, daily.FACTS, d).count() for d in ("2024-03-01", "latest", "all")}
    assert counts == {"2024-03-01": 20, "latest": 15, "all": 35}
    below = daily.lake_underperformers(spark, root, "2024-03-01").collect()
    assert [(r["company"], r["pct_timely_response"]) for r in below] == [("B", 0.0)]


def test_run_date_is_a_date_column(spark, make_raw, tmp_path):
    lake.export_table(make_raw({}), str(tmp_path), "t", "2024-03-01")
    assert dict(lake.read_lake(spark, str(tmp_path), "t").dtypes)["run_date"] == "date"


def test_failed_check_leaves_the_lake_alone(make_raw, tmp_path):
    raw = make_raw({}, {"timely": None})
    with pytest.raises(CheckFailure, match="was_timely: 1"):
        daily.run_daily(raw, str(tmp_path / "lake"), "2024-03-01")
    assert not os.path.exists(tmp_path / "lake")


def test_new_category_fails_the_gate(make_raw, tmp_path):
    with pytest.raises(CheckFailure, match="accepted_values"):
        daily.run_daily(make_raw({"product": "Payday loan"}), str(tmp_path / "lake"), "2024-03-01")


def test_empty_tables_are_refused(spark, make_raw, tmp_path):
    with pytest.raises(RuntimeError, match="0 rows"):
        lake.export_table(make_raw({}).limit(0), str(tmp_path / "lake"), "t", "2024-03-01")
    assert not os.path.exists(tmp_path / "lake")
    with pytest.raises(RuntimeError, match="no snapshot"):
        lake.read_lake(spark, str(tmp_path), "absent")
    with pytest.raises(RuntimeError, match="no rows"):
        lake.require_rows(make_raw({}).limit(0), "here")


def test_case_checks_are_the_expected_kinds():
    suite = case_checks().values()
    assert sum(len(m.unique) for m in suite) == 4
    assert sum(len(m.not_null) for m in suite) == 9


def test_responses(spark, tmp_path):
    def hit(i, product, text, received="2024-05-01T00:00:00.000Z"):
        return {"_source": {"complaint_id": str(i), "product": product, "date_received": received,
                            "complaint_what_happened": text, "extra": 1}}

    pages = [
        [hit(1, "Mortgage", "one"), hit(2, "Mortgage", "two"), hit(3, "Mortgage", None)],
        [hit(2, "Mortgage", "two"), hit(4, "Other", "four"), hit(5, "Student loan", "five"),
         hit(6, "Student loan", "old", "2022-12-31T00:00:00.000Z"), hit(7, "Mortgage", "")],
    ]
    for i, hits in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps({"hits": {"hits": hits}}, indent=1))
    rows = landed.read_responses(spark, str(tmp_path))
    assert rows.columns == list(RAW_FIELDS) and rows.count() == 8
    assert rows.filter("state is not null or timely is not null").count() == 0
    loaded = landed.load_raw(spark, str(tmp_path), n=500)
    assert sorted(r["complaint_id"] for r in loaded.collect()) == ["1", "2", "5"]
    assert [r["complaint_id"] for r in landed.load_raw(spark, str(tmp_path), n=1).orderBy("product").collect()] == ["1", "5"]


def test_csv_keeps_text_and_reads_null_tokens(spark, tmp_path):
    text = 'first line\nsecond, "quoted" line\r\n  padded\\ '
    df = spark.createDataFrame([("1", text), ("2", "N/A"), ("3", None), ("4", "nan "), ("5", "")], "id string, t string")
    path = str(tmp_path / "csv")
    landed.write_csv(df, path, single_file=True)
    got = {r["id"]: r["t"] for r in landed.read_csv(spark, path, ["id", "t"]).collect()}
    assert got == {"1": text, "2": None, "3": None, "4": "nan ", "5": None}


def test_metric_files(spark, tmp_path):
    row = spark.createDataFrame([(0.84, 12)], "f1 double, n int")
    path = str(tmp_path / "m")
    landed.write_metrics(landed.metric_rows(row, {"f1": "%.4f", "n": "%d"}), path)
    (tmp_path / "extra.txt").write_text("provider=a=b\n")
    assert [tuple(r) for r in landed.read_metrics(spark, path).orderBy("metric").collect()] == [
        ("f1", "0.8400", 0.84), ("n", "12", 12.0),
    ]
    assert tuple(landed.read_metrics(spark, str(tmp_path / "extra.txt")).collect()[0]) == ("provider", "a=b", None)


def test_replace_table_counts_what_is_there(spark, make_raw, tmp_path):
    path = str(tmp_path / "raw")
    assert landed.replace_table(make_raw({}, {}, {}), path) == 3
    assert landed.replace_table(make_raw({}), path) == 1


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "cases.csv"
    path.write_text("product,more,complaint_id\nMortgage,x,7\n")
    rows = landed.read_csv(spark, str(path), ["complaint_id", "product", "state"]).collect()
    assert [tuple(r) for r in rows] == [("7", "Mortgage", None)]
    with pytest.raises(ValueError, match="none of the columns"):
        landed.read_csv(spark, str(path), ["company"])


PAGE = '{"hits": {"hits": [{"_source": {"complaint_id": "1", "product": "Mortgage"}}]}}'


@pytest.mark.parametrize("bad", ['{"error": "too many requests"}', '{"hits": {"hits": [{"_sour', '{"hits": {}}'])
def test_a_bad_response_fails_the_read(spark, tmp_path, bad):
    (tmp_path / "pages.json").write_text(f"{PAGE}\n{bad}\n")
    with pytest.raises(Exception, match="no hits|MALFORMED|FAILFAST"):
        landed.read_responses(spark, str(tmp_path), multi_line=False).collect()
    counted = landed.rejected_pages(spark, str(tmp_path), multi_line=False).collect()
    assert [tuple(r) for r in counted] == [(2, 1)]


def test_an_empty_list_of_hits_is_sound(spark, tmp_path):
    (tmp_path / "pages.json").write_text(PAGE + '\n{"hits": {"hits": []}}\n')
    rows = landed.read_responses(spark, str(tmp_path), multi_line=False).collect()
    assert [r["complaint_id"] for r in rows] == ["1"]
    assert tuple(landed.rejected_pages(spark, str(tmp_path), multi_line=False).first()) == (2, 0)


def test_an_empty_mart_publishes_nothing(spark, make_raw, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(RuntimeError, match="mart_top_companies: 0 rows"):
        daily.run_daily(make_raw(*[{} for _ in range(6)]), root, "2024-03-01")
    assert os.listdir(tmp_path) == []


def test_a_failed_move_is_taken_back(spark, make_raw, tmp_path):
    root, staged = str(tmp_path / "lake"), str(tmp_path / "staged")
    lake.export_table(make_raw({}), root, "one", "2024-03-01")
    make_raw({}, {}).write.parquet(f"{staged}/one")
    with pytest.raises(Exception, match="two"):
        lake.publish(spark, staged, root, ["one", "two"], "2024-03-01")
    assert lake.read_lake(spark, root, "one").count() == 1
    assert spark.read.parquet(f"{staged}/one").count() == 2


def test_only_dates_are_snapshots(spark, make_raw, tmp_path):
    lake.export_table(make_raw({}), str(tmp_path), "t", "2024-03-01")
    for name in ("run_date=__HIVE_DEFAULT_PARTITION__", "run_date=later", "_temporary"):
        (tmp_path / "t" / name).mkdir()
    assert lake.snapshot_dates(spark, str(tmp_path), "t") == ["2024-03-01"]


def test_of_an_id_in_two_categories_the_first_listed_stays(spark, tmp_path):
    hits = [{"_source": {"complaint_id": "1", "product": product, "date_received": "2024-05-01",
                         "complaint_what_happened": "text"}} for product in ("A", "B")]
    (tmp_path / "p.json").write_text(json.dumps({"hits": {"hits": hits}}))
    for first, second in (("A", "B"), ("B", "A")):
        rows = landed.load_raw(spark, str(tmp_path), [first, second]).collect()
        assert [r["product"] for r in rows] == [first]


def test_csv_files_of_one_folder_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('complaint_id,product\n1,Mortgage\n2,"Student\nloan"\n')
    (tmp_path / "b.csv").write_text("product,complaint_id,more\nMortgage,3,x\n")
    (tmp_path / "c.csv").write_text("more,complaint_id\ny,4\n")
    (tmp_path / "d.csv").write_text("")
    got = landed.read_csv(spark, str(tmp_path), ["complaint_id", "product"])
    assert sorted(tuple(r) for r in got.collect()) == [
        ("1", "Mortgage"), ("2", "Student\nloan"), ("3", "Mortgage"), ("4", None)]
    assert len(landed.csv_layouts(spark, str(tmp_path))) == 3


def test_a_csv_file_without_any_wanted_column_is_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("complaint_id\n1\n")
    (tmp_path / "odd.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="odd.csv"):
        landed.read_csv(spark, str(tmp_path), ["complaint_id"])
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        landed.read_csv(spark, str(tmp_path / "empty"), ["complaint_id"])


def test_tables_and_views_are_read_by_name(spark, tmp_path):
    from caselake.sources import catalog

    first = catalog.save_table(spark.range(3), "caselake_test_table", str(tmp_path / "one"))
    view = catalog.save_view(spark.table("caselake_test_table").filter("id > 0"), "caselake_test_view")
    assert spark.table("caselake_test_view").count() == view.count() == 2
    catalog.save_table(spark.range(10), "caselake_test_table", str(tmp_path / "two"))
    assert spark.table("caselake_test_table").count() == 10 and spark.read.parquet(str(tmp_path / "one")).count() == 3
    assert first.schema.names == ["id"]
    for bad in ("", "a\nb"):
        with pytest.raises(ValueError):
            catalog.save_table(spark.range(1), bad)
    with pytest.raises(ValueError):
        catalog.save_view(spark.range(1), "a.b")
    spark.sql("drop table caselake_test_table")
