from pyspark.sql import functions as F

from crowdscope.__main__ import main
from crowdscope.plans import inputs as I
from crowdscope.session import scratch_path
from tests.conftest import SF001


def _app_tables(spark):
    t = I.Tables(spark, SF001)
    events = scratch_path(spark, "cli-events")
    I.app_signups(t).withColumnRenamed("ts", "timestamp").withColumn("appid", F.lit(I.APP)).write.parquet(events)
    members = scratch_path(spark, "cli-members")
    I.members(t).write.parquet(members)
    reads = scratch_path(spark, "cli-reads")
    news = {"economy": "business", "small": "sports", "medium": "cricket", "large": "tech", "promo": "market",
            "standard": "politics"}
    url = F.col("aurl")
    for shop, section in news.items():
        url = F.regexp_replace(url, f"^http://shop.example.com/{shop}/", f"http://news.example.com/{section}/")
    I.reads(t).withColumn("aurl", url).withColumnRenamed("ts", "timestamp").write.parquet(reads)
    return t, events, members, reads


def test_retention_and_tags_jobs_append(spark):
    t, events, members, reads = _app_tables(spark)
    out = scratch_path(spark, "cli-retention")
    args = ["retention", "--events", events, "--members", members, "--out", out, "--as-of", I.EVENTS_AS_OF,
            "--app", I.APP]
    n_segments = I.members(t).select("segment_id").distinct().count()
    main(args, spark)
    main(args, spark)                       # a rerun of the same day replaces its partition
    got = spark.read.parquet(out)
    assert got.count() == n_segments
    main(args + ["--append"], spark)        # the original job's append behaviour
    assert spark.read.parquet(out).count() == 2 * n_segments
    assert str(got.select("installtodate").distinct().first()[0]) == I.EVENTS_AS_OF

    tags_out = scratch_path(spark, "cli-tags")
    main(["tags", "--events", reads, "--out", tags_out, "--as-of", I.TAG_AS_OF, "--days-back", "3000"], spark)
    tags = spark.read.parquet(tags_out)
    assert tags.count() > 0 and "createdtime" in tags.columns
    assert {r.pref_catg for r in tags.select("pref_catg").distinct().collect()} <= {"business", "sports", "tech"}


def test_members_from_payload_pages(spark):
    t, events, _, _ = _app_tables(spark)
    pages = scratch_path(spark, "cli-payloads")
    I.member_payloads(t).write.parquet(pages)
    out = scratch_path(spark, "cli-retention-payload")
    main(["retention", "--events", events, "--members", pages, "--members-format", "payload", "--out", out,
          "--as-of", I.EVENTS_AS_OF], spark)
    assert spark.read.parquet(out).count() == I.members(t).select("segment_id").distinct().count()
