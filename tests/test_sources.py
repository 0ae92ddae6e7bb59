from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.schemas import STAGING
from tidewater.sources import CSV_PIPE, bulk_load, list_stage, project_positional, read_lines, records, staged_files
from tidewater.sources.delimited import _split_table, counted

NATION_HEAD = "n_nationkey,n_name,n_regionkey,n_comment\n"


def put(stage, name, text):
    path = stage / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def nations(spark, stage, text):
    put(stage, "tpch_sf1_nation.csv", NATION_HEAD + text)
    return bulk_load(spark, str(stage), STAGING["nation"])


def test_bulk_load_trims_and_splits_empty_from_missing(spark, stage):
    df = nations(spark, stage, '1, "x,y" ,2,plain\n2,  pad  ,3,\n3,"say ""hi""",4,""\n')
    assert rows(df, "n_nationkey", "n_name", "n_regionkey", "n_comment") == [
        (1, "x,y", 2, "plain"),
        (2, "pad", 3, None),
        (3, 'say "hi"', 4, ""),
    ]
    assert {(r.from_source, r.created_at) for r in df.collect()} == {(None, None)}
    assert [f.dataType.simpleString() for f in df.schema][:3] == ["bigint", "string", "bigint"]


def test_a_quoted_line_break_stays_in_its_field(spark, stage):
    df = nations(spark, stage, '1,"line one\n2,x",2,"a\nb"\n3,y,4,\n')
    assert rows(df, "n_nationkey", "n_name", "n_regionkey", "n_comment") == [
        (1, "line one\n2,x", 2, "a\nb"),
        (3, "y", 4, None),
    ]


@pytest.mark.parametrize(
    "line",
    ["1,a,2","1,a,2,c,extra", "x,a,2,c", "1,a,two,c", f"1,{'n' * 26},2,c"],
    ids=["short", "long", "bad key", "bad number", "text too long"],
)
def test_bulk_load_aborts_on_a_bad_row(spark, stage, line):
    with pytest.raises((PySparkException, Py4JJavaError)):
        nations(spark, stage, f"1,ok,2,c\n{line}\n").collect()


def test_patterns_pick_files(spark, stage):
    row = "7,5,1,2.50,c\n"
    head = "ps_partkey,ps_suppkey,ps_availqty,ps_supplycost,ps_comment\n"
    put(stage, "tpch_sf1_partsupp_1.csv", head + row)
    put(stage, "tpch_sf1_part.csv", ",".join("abcdefghi") + "\n1,n,m,b,t,5,c,9.99,k\n")
    put(stage, "sub/tpch_sf1_part.csv.bak", "not,a,table\n")
    assert rows(bulk_load(spark, str(stage), STAGING["part"]), "p_partkey", "p_retailprice") == [
        (1, Decimal("9.99"))
    ]
    loaded = bulk_load(spark, str(stage), STAGING["partsupp"])
    assert rows(loaded, "ps_partkey", "ps_supplycost") == [(7, Decimal("2.50"))]


def test_bulk_pattern_also_matches_pipe_files(spark, stage):
    line = "1,2,F,3.00,1995-01-01,1-URGENT,Clerk#1,0,c\n"
    put(stage, "tpch_sf1_orders.csv", "h,h,h,h,h,h,h,h,h\n" + line)
    put(stage, "tpch_sf1_orders_2.csv", "h,h,h,h,h,h,h,h,h\n" + line)
    assert bulk_load(spark, str(stage), STAGING["orders"]).count() == 2
    one = bulk_load(spark, str(stage), STAGING["orders"], STAGING["orders"].pipe_pattern)
    assert one.count() == 1
    assert one.first().o_orderdate == date(1995, 1, 1)


def delivered(seed, rows, breaks):
    """A file's text and its rows: quotes, commas, blank lines and line breaks inside fields."""
    import csv
    import io
    import random

    r = random.Random(seed)
    bits = ['"', ",", " x ", "né", "a", "\"\"", "日", "\r\n" if seed % 2 else "z"] + ["\n", "\n\n", "\n1,2,3,4\n"] * breaks
    data = [(i, "".join(r.choice(bits) for _ in range(r.randrange(9))), i % 5, r.choice(["", "c", 'say "hi"'])) for i in range(rows)]
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_NONNUMERIC, lineterminator="\r\n" if seed % 2 else "\n")
    writer.writerow(["n_nationkey", "n_name", "n_regionkey", "n_comment"])
    writer.writerows(data)
    return out.getvalue(), data


@pytest.mark.parametrize("split", ["48", "333", "134217728"])
def test_splits_of_a_file_give_whole_rows(spark, stage, split):
    """Whatever the splits, quoted line breaks stay in their field and no row is lost or cut."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    want = []
    try:
        for seed in range(6):
            text, data = delivered(seed, 60, breaks=seed % 3)
            (stage / f"tpch_sf1_nation_{seed}.csv").write_bytes(text.encode())
            want += [(seed, *row) for row in data]
        lines = read_lines(spark, str(stage), STAGING["nation"].bulk_pattern)
        found = records(lines)
        schema = "n_nationkey string, n_name string, n_regionkey string, n_comment string"
        file = F.regexp_extract("file", "_([0-9])[.]csv", 1).cast("int").alias("file")
        parsed = found.select(file, F.from_csv("record", schema, CSV_PIPE).alias("c")).select("file", "c.*")
        got = sorted((r.file, int(r.n_nationkey), r.n_name, int(r.n_regionkey), r.n_comment) for r in parsed.collect())
        assert got == sorted(want)
        assert split != "48" or lines.rdd.getNumPartitions() > 100
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unbalanced_quotes_are_an_error(spark, stage):
    with pytest.raises((PySparkException, Py4JJavaError), match="unbalanced quotes"):
        nations(spark, stage, '1,"open,2,c\n2,b,2,c\n').collect()


def test_lines_without_odd_quotes_are_not_brought_together(spark, stage):
    put(stage, "tpch_sf1_nation_1.csv", NATION_HEAD + '1,"x,y",2,c\n' * 3)
    put(stage, "tpch_sf1_nation_2.csv", NATION_HEAD + '1,"x\ny",2,c\n' * 3)
    lines = read_lines(spark, str(stage))
    table = {r._file[-5]: r.tangled for r in _split_table(counted(lines)).collect()}
    assert table == {"1": False, "2": True}


def test_lines_are_not_sorted_to_find_headers(spark, stage):
    """The first pass aggregates by hash: a sort of whole lines would spill as much text as a file holds."""
    put(stage, "tpch_sf1_nation_1.csv", NATION_HEAD + '1,"x,y",2,c\n' * 3)
    put(stage, "deep/tpch_sf1_nation_2.csv", "other,head\n" + "1,x,2,c\n" * 3)
    table = _split_table(counted(read_lines(spark, str(stage))))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    found = table.collect()
    assert {r._file[-5]: r.header for r in found} == {"1": NATION_HEAD.strip(), "2": "other,head"}
    stamps = {f"{f}": f.stat().st_mtime for f in stage.rglob("*.csv")}
    assert all(abs(r._modified.timestamp() - stamps[r._file.removeprefix("file:").replace("//", "/")]) < 1 for r in found)


def test_only_numbers_and_lines_are_brought_together(spark, stage):
    """A file's path and stamp, longer than most lines, are neither sorted by nor exchanged with each line."""
    (stage / "tpch_sf1_region_1.csv").write_text('k,n,c\n1,"a\nb",x\n2,"c\r",y\r\n3,"d\n\r\n",z\r\n')
    found = records(read_lines(spark, str(stage)))
    assert rows(found, "record") == [('1,"a\nb",x',), ('2,"c\r",y',), ('3,"d\n\r\n",z',)]
    assert {r.file[-21:] for r in found.collect()} == {"tpch_sf1_region_1.csv"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    by_line = [x for x in plan.splitlines() if "Window" in x and "line#" in x]
    assert by_line and all("windowspecdefinition(split#" in x and "file#" not in x for x in by_line)


def test_positional_cast_cuts_long_text(spark):
    df = spark.createDataFrame([("1", "n" * 30, "2", None)], "a string, b string, c string, d string")
    row = project_positional(df, STAGING["nation"].file_columns).first()
    assert (row.n_nationkey, row.n_name, row.n_comment) == (1, "n" * 25, None)
    with pytest.raises(ValueError):
        project_positional(df.select("a"), STAGING["nation"].file_columns)


def test_stage_listing(spark, stage):
    put(stage, "tpch_sf1_orders_1.csv", "x\n")
    put(stage, "deep/tpch_sf1_orders_2.csv", "longer\n")
    put(stage, "tpch_sf1_customer_1.csv", "x\n")
    assert list_stage(spark, str(stage)).count() == 3
    found = staged_files(spark, str(stage), STAGING["orders"].pipe_pattern)
    assert [r.file_name.rsplit("/", 1)[1] for r in found.collect()] == [
        "tpch_sf1_orders_2.csv",
        "tpch_sf1_orders_1.csv",
    ]
