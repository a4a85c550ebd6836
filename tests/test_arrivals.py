"""Damaged and drifting arrivals: good rows and quarantine together are all rows."""

from pyspark.sql import types as T

from shelfloom.sources.arrivals import load_arrivals

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("when", T.DateType())])


def put(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text)
    return str(path), "csv"


def test_damaged_lines_go_to_quarantine_with_reason_and_file(spark, tmp_path):
    a = put(tmp_path / "a", "ID,x,when\n1,2.5,2024-01-02\n2,oops,2024-01-02\n3,1,2024-13-40\n4,1\n5,1,2024-01-02,more\n,7,2024-01-02\n6,,\n1,2.5,2024-01-02\n")
    b = put(tmp_path / "b", "when,file,id\n2024-02-01,clash,8\n")
    c = put(tmp_path / "c", "id,x,when\n")
    got = load_arrivals(spark, {"a": a, "b": b, "c": c, "gone": (str(tmp_path / "gone"), "parquet")}, SCHEMA, ["id"])
    good = sorted((r.arrival, r.id, r.x, str(r.when)) for r in got.good.collect())
    assert good == [("a", 1, 2.5, "2024-01-02"), ("a", 1, 2.5, "2024-01-02"), ("a", 6, None, "None"), ("b", 8, None, "2024-02-01")]
    bad = got.quarantine.collect()
    assert len(bad) == 5 and all(r.arrival == "a" and r.file.endswith("a/part.csv") for r in bad)
    by = {tuple(r.reasons): r.record for r in bad}
    assert by["bad x",].startswith('{"ID":"2"') and ("bad when",) in by and ("no id",) in by
    assert {r.record for r in bad if "malformed line" in r.reasons} == {"4,1", "5,1,2024-01-02,more"}
    assert {(r.arrival, r.column, r.kind) for r in got.drift.collect()} == {("b", "x", "missing"), ("b", "file", "extra")}


def test_parquet_files_of_several_schemas(spark, tmp_path):
    spark.createDataFrame([(1, "2.5"), (2, "x"), (None, "1")], "id int, x string").write.parquet(f"{tmp_path}/p")
    spark.createDataFrame([(3, True)], "id int, flag boolean").write.mode("append").parquet(f"{tmp_path}/p")
    got = load_arrivals(spark, {"p": (f"{tmp_path}/p", "parquet")}, SCHEMA, ["id"])
    assert sorted((r.id, r.x) for r in got.good.collect()) == [(1, 2.5), (3, None)]
    assert sorted(tuple(r.reasons) for r in got.quarantine.collect()) == [("bad x",), ("no id",)]
    assert {(r.column, r.kind) for r in got.drift.collect()} == {("id", "retyped"), ("x", "retyped"), ("when", "missing"), ("flag", "extra")}


def test_a_required_column_that_an_arrival_lacks_and_no_arrival(spark, tmp_path):
    got = load_arrivals(spark, {"b": put(tmp_path / "b", "x\n1\n2\n")}, SCHEMA, ["id"])
    assert got.good.count() == 0 and [r.reasons for r in got.quarantine.collect()] == [["no id"]] * 2
    none = load_arrivals(spark, {}, SCHEMA, ["id"])
    assert none.good.columns == ["arrival", "id", "x", "when"] and none.good.count() == none.quarantine.count() == none.drift.count() == 0
