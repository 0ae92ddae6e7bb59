from __future__ import annotations

import glob
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater.operators.layout import curve_place, write_on_curve


def files_read(path, column, low, high):
    """Files with a row group whose range of the column meets the filter's: the ones a scan cannot skip."""
    hit = 0
    found = glob.glob(f"{path}/*.parquet")
    for file in found:
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(s.has_min_max and s.min <= high and s.max >= low for s in stats)
    return hit, len(found)


def orders(spark):
    """Dates, customers and names that have nothing to do with each other."""
    day = F.expr("date_add(DATE '1998-01-01', cast(pmod(xxhash64(id), 1000) as int))")
    return spark.range(40000).select(
        "id", day.alias("day"), F.expr("pmod(xxhash64(id, 1), 5000)").alias("customer"), F.expr("md5(string(id))").alias("name")
    )


FILTERS = {"day": (date(1999, 3, 1), date(1999, 3, 10)), "customer": (700, 710), "name": ("7a", "7b")}


@pytest.mark.parametrize(("columns", "most"), [(["day", "customer"], 20), (["day", "customer", "name"], 36)])
def test_a_filter_on_any_column_skips_files(spark, tmp_path, columns, most):
    """Of 64 files each of two columns needs about 8, each of three about 16 (borders are sampled)."""
    path = str(tmp_path / "curve")
    write_on_curve(orders(spark), path, columns, partitions=64)
    assert spark.read.parquet(path).count() == 40000
    for column in columns:
        hit, all_files = files_read(path, column, *FILTERS[column])
        assert all_files == 64 and 0 < hit <= most, (column, hit)


def test_one_value_in_a_third_of_the_rows_is_spread(spark, tmp_path):
    path = str(tmp_path / "curve")
    hot = orders(spark).withColumn("customer", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("customer")))
    write_on_curve(hot, path, ["customer", "day"], partitions=32)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert max(sizes) < 3 * 40000 / 32


def test_places_of_nulls_and_of_an_empty_table(spark):
    df = spark.createDataFrame([(None, None), (1, "a"), (2, "b")], "n int, t string")
    place = df.select("n", curve_place(df, ["n", "t"]).alias("p")).collect()
    assert {r.n: r.p for r in place}[None] == 0 and all(r.p >= 0 for r in place)
    none = df.limit(0)
    assert none.select(curve_place(none, ["n", "t"])).count() == 0
    same = spark.createDataFrame([(5, date(1998, 1, 1) + timedelta(days=1))] * 4, "n int, d date")
    assert same.select(curve_place(same, ["n", "d"])).distinct().count() == 1
