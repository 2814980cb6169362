from __future__ import annotations

import pytest

from tallyhouse.__main__ import available, main, parser
from tallyhouse.sources import read_layer


def test_steps_one_by_one(spark, tmp_path):
    lake, export = str(tmp_path / "lake"), str(tmp_path / "export")
    spark.createDataFrame([(1, "Web", "active", 5, 1), (2, "Web", "abandoned", 7, 2)],
                          "id long, channel string, status string, amount int, item_count int").selectExpr(
        "id", "channel", "status", "cast(amount as decimal(12,2)) total_amount", "item_count",
        "timestamp'2024-01-15 10:00:00' created_at", "cast(null as timestamp) updated_at",
    ).write.parquet(export)
    base = ["--lake", lake, "--ds", "2024-01-15"]
    main(["ingest", "--table", "cart", "--from", export, *base])
    main(["clean", "--table", "cart", *base])
    main(["mart", "--mart", "cart_analytics_mart", *base])
    tables = available(spark, lake)
    assert tables["cart"].count() == 2 and tables["orders"].isEmpty()
    row = read_layer(spark, lake, "gold", "cart_analytics_mart").first()
    assert (row.channel, row.total_carts, row.ds.isoformat() if hasattr(row.ds, "isoformat") else row.ds) == (
        "Web", 2, "2024-01-15")
    main(["export", "--table", "cart_analytics_mart", "--layer", "gold", "--lake", lake, "--to", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    main(["compact", "--table", "cart", "--layer", "silver", "--lake", lake])
    main(["expire", "--table", "cart", "--layer", "raw", "--lake", lake, "--ds", "2024-03-01"])
    assert read_layer(spark, lake, "silver", "cart").count() == 2
    with pytest.raises(Exception):
        read_layer(spark, lake, "raw", "cart")


@pytest.mark.parametrize("argv", [
    ["mart", "--mart", "nope", "--lake", "x", "--ds", "2024-01-01"],
    ["ingest", "--table", "orders", "--lake", "x"],
    ["ingest", "--table", "orders", "--lake", "x", "--ds", "2024-01-01"],
    [],
])
def test_bad_arguments_are_refused(argv):
    with pytest.raises(SystemExit):
        parser().parse_args(argv)
