"""The star of a folder is built once a session, and anew when its files change or its joins are gone."""

import os
import shutil

import pyarrow.compute as pc
import pyarrow.parquet as pq

from lakeviews.plans.registry import QUERIES, star
from lakeviews.session import scratch_path
from lakeviews.sources.versions import remove

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def test_star_follows_its_files(spark, small_dir):
    folder = scratch_path(spark, "star-test").replace("file:", "")
    os.makedirs(folder)
    for t in TABLES:
        shutil.copy(f"{small_dir}/{t}.parquet", folder)
    first = star(spark, folder)
    assert star(spark, folder) is first and star(spark, small_dir) is not first
    rows = QUERIES["agg_sales"](spark, folder).count()
    orders = pq.read_table(f"{small_dir}/orders.parquet")
    pq.write_table(orders.filter(pc.not_equal(orders["o_orderstatus"], "F")), f"{folder}/orders.parquet")
    assert star(spark, folder) is not first
    assert QUERIES["agg_sales"](spark, folder).count() < rows
    second = star(spark, folder)
    remove(spark, second.joins)
    assert star(spark, folder) is not second and QUERIES["agg_sales"](spark, folder).count() > 0
