"""Scans, sinks, contracts and the shared folder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcast import scratch
from shelfcast.operators import forecast
from shelfcast.operators.skew import measured_join
from shelfcast.plans import QUERIES, reading
from shelfcast.plans.shared import data_tag
from shelfcast.sources import scans, sinks
from shelfcast.sources.panel import HISTORY_END, sales_panel
from shelfcast.sources.schema import (
    LABELLED_SCHEMA,
    PANEL_SCHEMA,
    columns_by_kind,
    feature_columns,
    numbered_names,
    to_contract,
)

HEADER = ",".join(PANEL_SCHEMA.fieldNames())
GOOD = "2011,1,1,6,0,FOODS_1,FOODS_1_001,CA_1,3.0,0,"
BAD = "2011,1,2,7,0,FOODS_1,FOODS_1_001,CA_1,three,0,1.5"


def write_text(tmp_path, *lines):
    path = tmp_path / "panel.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_typed_csv(spark, tmp_path):
    rows = scans.read_csv_typed(spark, write_text(tmp_path, HEADER, GOOD), PANEL_SCHEMA).collect()
    assert len(rows) == 1 and rows[0]["sales"] == 3.0 and rows[0]["Sales_Pred"] is None


def test_typed_csv_does_not_lose_bad_rows(spark, tmp_path):
    path = write_text(tmp_path, HEADER, GOOD, BAD)
    with pytest.raises(Exception, match="(?i)malformed"):
        scans.read_csv_typed(spark, path, PANEL_SCHEMA).collect()
    marked = scans.read_csv_typed(spark, path, PANEL_SCHEMA, on_bad_rows="mark")
    rows = marked.orderBy("dn").collect()
    assert [r[scans.BAD_RECORD] for r in rows] == [None, BAD]
    with pytest.raises(ValueError):
        scans.read_csv_typed(spark, path, PANEL_SCHEMA, on_bad_rows="drop")


def test_typed_csv_reads_columns_nobody_asked_for(spark, tmp_path):
    path = write_text(tmp_path, HEADER, GOOD, BAD)
    for ask in (lambda t: t.select("dn").collect(), lambda t: t.count(), lambda t: t.where("dn = 2").select("year").collect()):
        with pytest.raises(Exception, match="(?i)malformed"):
            ask(scans.read_csv_typed(spark, path, PANEL_SCHEMA))
    empty = write_text(tmp_path, HEADER, GOOD, "," * (len(PANEL_SCHEMA) - 1))
    assert scans.read_csv_typed(spark, empty, PANEL_SCHEMA).select("dn").count() == 2


def test_typed_csv_checks_the_header(spark, tmp_path):
    path = write_text(tmp_path, HEADER.replace("sales", "turnover"), GOOD)
    with pytest.raises(Exception, match="(?i)header"):
        scans.read_csv_typed(spark, path, PANEL_SCHEMA).collect()


def test_contract(spark):
    df = spark.range(3).select(F.col("id").alias("dn"))
    with pytest.raises(ValueError, match="year, month"):
        to_contract(df, LABELLED_SCHEMA)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "Id int, Street string, SalePrice double")
    assert columns_by_kind(df.schema) == {"Id": "numeric", "Street": "categorical", "SalePrice": "numeric"}
    assert feature_columns(df, ["Id", "SalePrice"]) == ["Street"]
    names = numbered_names("d_", 1, 1913)
    assert (names[0], names[-1], len(names)) == ("d_1", "d_1913", 1913)


def test_csv_keeps_rows_and_header(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.range(1000).orderBy(F.desc("id")), path, sep=";")
    back = scans.read_csv_inferred(spark, path, sep=";")
    assert back.columns == ["id"]
    assert sorted(r["id"] for r in back.collect()) == list(range(1000))


def test_materialize_once(spark, tmp_path):
    path = str(tmp_path / "table")
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    for _ in range(3):
        assert sinks.materialize_once(spark, path, build).count() == 5
    assert len(built) == 1
    (tmp_path / "table" / "_SUCCESS").unlink()
    assert sinks.materialize_once(spark, path, build).count() == 5
    assert len(built) == 2


def test_two_builders_at_once(spark, tmp_path):
    """The table that is published first stays, and nothing else does."""
    path = str(tmp_path / "table")

    def slow():
        assert sinks.materialize_once(spark, path, lambda: spark.range(5)).count() == 5
        return spark.range(7)

    assert sinks.materialize_once(spark, path, slow).count() == 5
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    assert not [p for p in (tmp_path / "table").iterdir() if p.name.startswith("_building")]


def test_a_failed_build_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(Exception, match="(?i)not today"):
        sinks.materialize_once(spark, path, lambda: spark.range(5).select(F.raise_error(F.lit("not today")).cast("int").alias("x")))
    assert not sinks.path_exists(spark, path)
    assert sinks.materialize_once(spark, path, lambda: spark.range(5)).count() == 5


def test_replaced_data_get_another_tag(spark, tmp_path):
    data = str(tmp_path / "data")
    tags = []
    for rows in (10, 10_000, 10_000):
        spark.range(rows).write.mode("overwrite").parquet(f"{data}/lineitem.parquet")
        tags.append(data_tag(spark, data))
        assert data_tag(spark, data + "/") == tags[-1]
    spark.range(3).write.parquet(f"{data}/part.parquet")
    assert len({*tags, data_tag(spark, data), data_tag(spark, str(tmp_path / "none"))}) == 5


def test_hot_supplier_is_split(spark, sf_dir, tmp_path):
    """A supplier with nearly all line items, merge joins only: same panel, even tasks."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = F.when(F.col("l_linenumber") < 7, F.lit(1)).otherwise(F.col("l_suppkey")).cast("bigint")
    lines.withColumn("l_suppkey", key).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("supplier", "nation", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        plain = sales_panel(spark, str(tmp_path))
        split = sales_panel(spark, str(tmp_path), plain_rows=0)
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
        rows = spark.read.parquet(f"{tmp_path}/lineitem.parquet").select("l_suppkey", "l_partkey", "l_shipdate")
        stores = spark.read.parquet(f"{tmp_path}/supplier.parquet").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
        joined = measured_join(rows, stores, ["l_suppkey"], ["l_partkey", "l_shipdate"], plain_rows=0)
        assert "_salt" in plan_text(joined) and "SortMergeJoin" in plan_text(joined)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == rows.count() and max(sizes) < 0.3 * sum(sizes)
        assert measured_join(rows.limit(0), stores, ["l_suppkey"], ["l_partkey"], plain_rows=0).count() == 0
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()


def test_stage_and_fresh_paths(spark):
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")
    staged = scratch.stage(spark.range(10), "numbers")
    assert staged.count() == 10 and "parquet" in staged._jdf.queryExecution().toString().lower()


def test_day_range_equals_filter(spark, sf_dir):
    pushed = sales_panel(spark, sf_dir, first_day=HISTORY_END + 1, last_day=HISTORY_END + 10)
    plain = sales_panel(spark, sf_dir).where(F.col("dn").between(HISTORY_END + 1, HISTORY_END + 10))
    assert sorted(map(str, pushed.collect())) == sorted(map(str, plain.collect()))
    assert plain.count() > 0


def test_even_numbers(spark):
    assert [r["n"] for r in scans.even_numbers(spark, 0, 20).collect()] == list(range(0, 20, 2))


def test_csv_lines_read_like_the_wide_table(spark, tmp_path):
    rows = [('a,"b', 1, 2.0), ('a,"b', 4, 0.5), ("c", 5, 3.0), ("d", 3, None), ("", 2, 7.0), (None, 5, 1.0)]
    df = spark.createDataFrame(rows, "k string, day int, v double")
    vectors = forecast.day_vectors(df, ["k"], "day", "v").repartition(3, "k")
    names, lines = forecast.wide_lines(vectors, 1, 5)
    cells, text = str(tmp_path / "cells"), str(tmp_path / "lines")
    sinks.write_csv(forecast.wide_days(vectors, 1, 5), cells)
    sinks.write_csv_lines(lines, names, text)
    read = [scans.read_csv_strings(spark, path) for path in (cells, text)]
    assert read[0].columns == read[1].columns == names
    assert sorted(map(str, read[0].collect())) == sorted(map(str, read[1].collect()))
    with pytest.raises(Exception, match="outside 1..4"):
        sinks.write_csv_lines(forecast.wide_lines(vectors, 1, 4)[1], names, text)


def test_the_wide_file_does_not_grow_with_its_empty_columns(spark, tmp_path):
    vectors = forecast.day_vectors(spark.range(2000).selectExpr("id k", "1 day", "1.0D v"), ["k"], "day", "v")

    def size(last):
        path = tmp_path / str(last)
        sinks.write_csv_lines(forecast.wide_lines(vectors, 1, last)[1], ["k"], str(path))
        return sum(f.stat().st_size for f in path.iterdir())

    assert size(2443) < 5 * size(10)


def test_packed_cells_are_those_of_the_columns(spark, tmp_path, monkeypatch):
    names = numbered_names("d_", 1, 9)
    rows = ["x,a,1.0,,,,,,,,2.5", '"y, z",,,,,3,,,,,', '"q\\"r","",,,,,,,,,', "full,b,1,2,3,4,5,6,7,8,9", ",c,,2,,,,,,,", "é,a,,,,,,,-1E3,,"]
    path = write_text(tmp_path, ",".join(["k", "s", *names]), *rows)
    plain = scans.read_csv_strings(spark, path).collect()
    wanted = [(r["k"], r["s"], [(i, r[n]) for i, n in enumerate(names) if r[n] is not None]) for r in plain]
    for few in (64, 0):
        monkeypatch.setattr(scans, "FEW_CELLS", few)
        packed = scans.read_csv_strings(spark, path, packed=names)
        assert packed.columns == ["k", "s", "cells"]
        assert [(r["k"], r["s"], [tuple(c) for c in r["cells"]]) for r in packed.collect()] == wanted
    assert len(wanted) == 6 and wanted[1][2] == [(3, "3")]


def test_packed_columns_are_the_last_and_hold_no_quotes(spark, tmp_path):
    path = write_text(tmp_path, "k,d_1,d_2", 'x,"1",')
    with pytest.raises(ValueError, match="last ones"):
        scans.read_csv_strings(spark, path, packed=["d_1"])
    with pytest.raises(Exception, match="quoted"):
        scans.read_csv_strings(spark, path, packed=["d_1", "d_2"]).collect()


def test_totals_of_the_wide_table_parse_no_column_per_day(spark, sf_dir):
    found = QUERIES["wide_day_totals"](spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "d_2000#" not in plan and "item_id" in plan


def test_the_wide_table_is_written_by_as_many_tasks_as_asked_for(spark, sf_dir):
    files = scans.read_csv_strings(spark, reading._wide_csv(spark, sf_dir)).inputFiles()
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
