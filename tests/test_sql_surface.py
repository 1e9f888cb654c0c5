"""Ad-hoc SQL over the lakehouse, pinned versions, DDL and the CLI."""

import datetime as dt

from helpers import T0, trips_df
from tripmart.cli import main as cli_main
from tripmart.plans.pipeline import Lakehouse, run_pipeline
from tripmart.plans.sql_surface import create_database, create_table, create_table_sql, register_version, register_views
from tripmart.schemas import GOLD, GOLD_PARTITIONS, ZONES


def test_views_and_time_travel(spark, tmp_root):
    zones = spark.createDataFrame([(100, "Manhattan", "Midtown", "Y")], ZONES)
    rows = lambda start, n: [
        dict(tpep_pickup_datetime=T0 + dt.timedelta(minutes=start + i), tpep_dropoff_datetime=T0 + dt.timedelta(hours=1))
        for i in range(n)
    ]
    run_pipeline(spark, trips_df(spark, rows(0, 2)), tmp_root, zones)
    run_pipeline(spark, trips_df(spark, rows(0, 5)), tmp_root, zones)
    lake = Lakehouse.at(spark, tmp_root)
    register_views(lake)
    assert spark.sql("SELECT COUNT(1) AS cnt FROM silver").first().cnt == 5
    assert spark.sql("SELECT MAX(tpep_pickup_datetime) AS wm FROM silver").first().wm == T0 + dt.timedelta(minutes=4)
    top = spark.sql(
        "SELECT pickup_borough, SUM(total_trips) AS n FROM agg GROUP BY 1 ORDER BY n DESC LIMIT 1"
    ).first()
    assert (top.pickup_borough, top.n) == ("Manhattan", 5)
    register_version(lake.gold, "gold_v1", as_of=1)
    assert spark.sql("SELECT COUNT(*) AS n FROM gold_v1").first().n == 2


def test_ddl(spark, tmp_root):
    create_database(spark, "tm_gold", f"{tmp_root}/gold.db")
    sql = create_table_sql("tm_gold.obt", GOLD, GOLD_PARTITIONS)
    assert "PARTITIONED BY (`pickup_year`, `pickup_month`)" in sql and "USING parquet" in sql
    create_table(spark, "tm_gold.obt", GOLD, GOLD_PARTITIONS)
    cols = [r.col_name for r in spark.sql("DESCRIBE TABLE tm_gold.obt").collect()]
    assert "trip_id" in cols and "created_at" in cols
    spark.sql("DROP TABLE tm_gold.obt")
    spark.sql("DROP DATABASE tm_gold")


def test_cli_run(spark, tmp_root, capsys):
    raw = f"{tmp_root}/raw"
    trips_df(spark, [{}]).write.parquet(f"{raw}/year=2024")
    zones = f"{tmp_root}/zones"
    spark.createDataFrame([(100, "Manhattan", "Midtown", "Y")], ZONES).write.option("header", True).csv(zones)
    cli_main(["run", "--bronze-path", raw, "--lake", f"{tmp_root}/lake", "--zones-csv", zones], spark=spark)
    out = capsys.readouterr().out
    assert out.count('"mode": "full"') == 3


def test_cli_reference_style_arguments_and_plan(spark, tmp_root, capsys):
    raw = f"{tmp_root}/raw"
    trips_df(spark, [{}]).write.parquet(f"{raw}/year=2024/yellow_tripdata_2024-01.parquet")
    zones = f"{tmp_root}/zones"
    spark.createDataFrame([(100, "Manhattan", "Midtown", "Y")], ZONES).write.option("header", True).csv(zones)
    silver, gold, agg = (f"{tmp_root}/{n}" for n in ("s", "g", "a"))
    cli_main(["clean", "--bronze-path", raw, "--silver_full_ref", silver], spark=spark)
    cli_main(["load", "--silver_full_ref", silver, "--gold_full_ref", gold, "--s3_taxi_zone_csv", zones], spark=spark)
    cli_main(["agg", "--gold_full_ref", gold, "--agg_full_ref", agg, "--silver_full_ref", silver], spark=spark)
    assert capsys.readouterr().out.count('"mode": "full"') == 3
    cli_main(
        ["plan", "--raw-root", raw, "--year", "2024", "--run-date", "2024-04-01",
         "--report-path", f"{tmp_root}/reports/r1"],
        spark=spark,
    )
    out = capsys.readouterr().out
    assert '"status": "skipped", "months": 1' in out and '"status": "pending", "months": 9' in out
    assert spark.read.json(f"{tmp_root}/reports/r1").count() == 12


def test_cli_sql(spark, tmp_root, capsys):
    raw = f"{tmp_root}/raw"
    trips_df(spark, [{}, {"VendorID": 2}]).write.parquet(f"{raw}/year=2024")
    zones = f"{tmp_root}/zones"
    spark.createDataFrame([(100, "Manhattan", "Midtown", "Y")], ZONES).write.option("header", True).csv(zones)
    lake = f"{tmp_root}/lake"
    cli_main(["run", "--bronze-path", raw, "--lake", lake, "--zones-csv", zones], spark=spark)
    capsys.readouterr()
    cli_main(
        ["sql", "--lake", lake, "--output", f"{tmp_root}/out",
         "SELECT pickup_borough, SUM(total_trips) AS trips FROM agg GROUP BY 1"],
        spark=spark,
    )
    assert '"pickup_borough": "Manhattan", "trips": 2' in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_root}/out").count() == 1
    cli_main(["compact", "--lake", lake, "--table", "silver"], spark=spark)
    assert '"table": "silver", "commit_id": null' in capsys.readouterr().out  # one commit: nothing to do
