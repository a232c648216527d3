"""Tables that are folders of files, as on a cluster."""

import pytest
from helpers import rows_of

from stayscope.catalog import QUERIES
from stayscope.fixtures import table

NAMES = [
    "batch_popular_by_hotel",
    "scan_bookings",
    "partition_scan",
    "stream_scan_bookings",
    "stream_popular_by_children",
    "stream_popular_collapsed",
    "windowed_count",
]


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("folders")
    for name in ("lineitem", "orders", "supplier", "events"):
        table(spark, sf_dir, name).repartition(5).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", NAMES)
def test_same_result_from_folders(spark, sf_dir, folders, name):
    query = QUERIES[name]
    assert rows_of(query(spark, folders)) == rows_of(query(spark, sf_dir))
