"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.operators import catalogue as C
from tracklens.workload.all_queries import QUERIES

WRITES = {"document_search_indexed", "template_top", "catalogue_load", "catalogue_save", "track_scan", "calendar_scan", "variant_write", "recording_write", "recording", "setpoint_chain"}
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in WRITES)


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 2000)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_products_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "Scan ExistingRDD" not in text


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "books")
    C.clean(dims.seed_books(spark))[0].write.parquet(path)
    stored = spark.read.parquet(path)
    pushed = re.search(
        r"PushedFilters: \[(.*?)\], ReadSchema",
        plan(C.shelf(stored, status="want", retailer="Kobo", format="kindle", max_price=20, min_rating=3).select("id")),
    ).group(1)
    for column in ("status", "retailer", "format", "price", "rating"):
        assert column in pushed


def test_unused_columns_are_not_read(spark, tables):
    read = re.search(r"ReadSchema: (\S+)", plan(C.tally(tables.books))).group(1)
    assert "p_name" not in read and "p_brand" not in read


def test_top_k_is_not_a_full_sort(spark, tables):
    text = plan(C.top_shelf(tables.books, "price", 10))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_fixed_dims_are_broadcast(spark, tables):
    text = plan(C.with_format(tables.books, F.broadcast(dims.format_dim(spark))))
    assert "BroadcastHashJoin" in text


def test_history_cap_limits_before_the_shuffle(spark, tables):
    assert "WindowGroupLimit" in plan(QUERIES["downsample"](spark, SMALL))
