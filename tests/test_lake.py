"""Text files with a byte-order mark, daily batches of several files."""

import datetime as dt

from lakewright.schemas import TABLES
from lakewright.sources import lake


def test_csv_with_a_mark(spark, tmp_path):
    df = spark.createDataFrame([("é", 1), ("한국", 2)], "a string, b int")
    lake.write_csv(df.coalesce(1), f"file://{tmp_path}/csv", mark=True)
    (path, _), = lake.list_csv(spark, f"file://{tmp_path}/csv")
    raw = lake.get(spark, path)
    assert raw.startswith(b"\xef\xbb\xbfa,b\n") and raw.decode("utf-8-sig").splitlines()[1:] == ["é,1", "한국,2"]
    lake.write_csv(df.coalesce(1), f"file://{tmp_path}/csv")
    got = lake.read_csv(spark, f"file://{tmp_path}/csv", "a string, b int").collect()
    assert sorted(map(tuple, got)) == [("é", 1), ("é", 1), ("한국", 2), ("한국", 2)]


def test_a_daily_batch_keeps_its_partitions(spark, tmp_path):
    catalog = lake.Catalog(spark, f"file://{tmp_path}/catalog")
    folder = lake.daily_batch(spark.range(100).repartition(3), f"file://{tmp_path}/bronze", catalog, "APPSTORE", dt.date(2026, 5, 3), dt.datetime(2026, 5, 4))
    assert len(lake.list_files(spark, folder)) == 3
    row = catalog.read("ingestion_batch").first()
    assert (row["record_count"], row["storage_path"], row["status"]) == (100, folder, "PENDING") and len(row) == len(TABLES["ingestion_batch"].split(", "))
