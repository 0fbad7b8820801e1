import json
import tempfile
from pathlib import Path

from builders import listing, listings
from listingflow.plans.full_run import run_full
from listingflow.operators.model import ModelParams
from listingflow.session import materialize, shared_root, work_path
from listingflow.sources.listings import read_listings, rejected_lines, write_records


def test_csv_with_quotes_commas_and_line_breaks(spark):
    rows = [listing(1, title='A "prime", unit', description="line one\nline two"), listing(2, title=None, lat=None)]
    df = listings(spark, *rows)
    path = work_path(spark, "csv")
    df.write.csv(path, header=True, escape='"')
    assert read_listings(spark, path, multiline=True).orderBy("listing_id").collect() == df.collect()
    assert [r.listing_id for r in read_listings(spark, path).collect()] == [2]  # never a silently broken row
    assert any("prime" in r.line for r in rejected_lines(spark, path).collect())


def test_csv_that_can_be_split(spark):
    df = listings(spark, listing(1, title='A "prime", unit'), listing(2, description=None, listed_date=None))
    path = work_path(spark, "csv")
    df.write.csv(path, header=True, escape='"')
    assert read_listings(spark, path).orderBy("listing_id").collect() == df.collect()


def test_malformed_lines_are_rejects_among_good_ones(spark, tmp_path):
    listings(spark, listing(1), listing(2)).coalesce(1).write.csv(str(tmp_path / "good"), header=True, escape='"')
    lines = next((tmp_path / "good").glob("part-*.csv")).read_text().splitlines()
    bad = [",".join(["oops"] * 18), "3,too,few"]
    (tmp_path / "mixed.csv").write_text("\n".join([lines[0], lines[1], *bad, lines[2]]) + "\n")
    path = str(tmp_path / "mixed.csv")
    read = read_listings(spark, path)
    assert sorted(r.listing_id for r in read.collect()) == [1, 2] and read.count() == 2
    assert read.select("area").count() == 2
    rejected = rejected_lines(spark, path).collect()
    assert sorted(r.line for r in rejected) == sorted(bad) and all("mixed.csv" in r.file for r in rejected)


def test_parquet_batch(spark):
    df = listings(spark, listing(1), listing(2))
    path = work_path(spark, "parquet")
    df.write.parquet(path)
    assert read_listings(spark, path, fmt="parquet").count() == 2


def test_records_keep_nulls(spark, tmp_path):
    write_records(listings(spark, listing(1, title=None)).select("listing_id", "title"), str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part-*.json") for x in f.read_text().splitlines()]
    assert lines == [{"listing_id": 1, "title": None}]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_all_steps_on_one_batch(spark, tmp_path):
    rows = []
    for i in range(120):
        rows.append(listing(i, lat=25.0 + i * 0.01, size_sqft=600 + i * 3, price_aed_month=6000 + i * 40,
                            area="AB"[i % 2], dup_group_truth=i, title=f"unit {i} near park"))
    rows += [listing(500 + i, lat=25.0 + i * 0.01, size_sqft=600 + i * 3, price_aed_month=6050 + i * 40,
                     area="AB"[i % 2], dup_group_truth=i, title=f"unit {i} near park again") for i in range(20)]
    result = run_full(spark, listings(spark, *rows), str(tmp_path / "wh"), str(tmp_path / "out"),
                          params=ModelParams(rounds=3, step=0.5))
    metrics = result.duplicate_metrics.first()
    assert (int(metrics.true_pairs), metrics.recall, metrics.precision) == (20, 1.0, 1.0)
    assert result.scored.count() == 140 and result.load.run["rows_inserted"] == 140
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert {"duplicate_metrics", "fair_value_grid", "live_feed", "query_area_leaderboard", "model"} <= written


def test_written_tables_leave_no_shuffle_files_and_no_setting(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = lambda: {*Path(tempfile.gettempdir()).glob("blockmgr-*/*/shuffle_*.data")}
    before, kept = spark.conf.get(setting), files()
    counts = spark.range(1000).selectExpr("id % 10 as k").repartition(3).groupBy("k").count()
    assert materialize(counts, "counts").count() == 10
    assert not [f for f in files() - kept if f.stat().st_size > 200] and spark.conf.get(setting) == before
    assert counts.count() == 10
