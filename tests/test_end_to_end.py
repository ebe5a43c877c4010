"""Whole flow through the library API on landed pages built from sf0.001 events."""

from datetime import datetime

from pyspark.sql import functions as F

from marketpulse.operators.aggregates import load_audit
from marketpulse.operators.timegrid import HourGrid
from marketpulse.plans.bronze import bulk_load, incremental_load, read_bronze
from marketpulse.plans.gold import build_gold, correction_rows, read_gold, write_gold
from marketpulse.plans.silver import build_silver
from marketpulse.plans.upserts import merge_gold
from marketpulse.sources.company import company_dim
from marketpulse.sources.pages import flatten_pages, land_pages, read_pages
from marketpulse.sources.testdata import bars_from_events, posts_from_events, table

SF = "/root/testdata/sf0.001"


def test_pages_to_gold_to_merge(spark, tmp_path_str):
    events = table(spark, SF, "events")
    dim = company_dim(spark)
    landing = tmp_path_str + "/landing"
    land_pages(posts_from_events(events), landing)
    pages = read_pages(spark, landing)
    audit = {r.ticker: r.post_count for r in load_audit(pages, dim).collect()}
    assert sum(audit.values()) == events.count()

    posts = flatten_pages(pages)
    bronze = tmp_path_str + "/bronze"
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    bulk_load(posts.where(F.col("created_at") < cut), dim, bronze, "2024-02-01")
    incremental_load(posts, dim, bronze, "2024-02-02")
    b = read_bronze(spark, bronze)
    first = b.where(F.col("load_date") == "2024-02-01").count()
    later = b.where(F.col("load_date") == "2024-02-02")
    assert first == events.where(F.col("ts") < cut).count()
    assert later.where(F.dayofweek("Tweet_date").isin(1, 7)).count() == 0

    scores = events.select(F.col("event_id").cast("string").alias("id"), F.col("value").alias("sentID"))
    pre_silver = b.join(scores, "id")  # the score arrives from outside, keyed by post id
    silver = build_silver(pre_silver)
    assert silver.where(F.dayofweek("Tweet_date").isin(1, 7)).count() == 0

    grid = HourGrid.from_range("2024-01-02 01:30:00", "2024-01-30 00:00:00")
    gold = build_gold(bars_from_events(events, dim), silver, grid)
    path = tmp_path_str + "/gold"
    write_gold(gold, path)
    assert read_gold(spark, path).where("sentimentScore IS NOT NULL").count() > 0
    before = read_gold(spark, path).count()
    src = correction_rows(read_gold(spark, path), "CAT", "2024-01-08 14:30:00")
    n_source = src.count()
    counts = merge_gold(spark, path, src)
    after = read_gold(spark, path)
    assert counts["source"] == n_source and after.count() == before + counts["insert"]
    assert after.agg(F.min("Date")).first()[0] < datetime(2024, 1, 1)  # shifted correction rows were inserted
