"""Stateful jobs over logs and files that arrive bit by bit."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricetide import schema as S
from pricetide.operators import breaker
from pricetide.plans import jobs
from pricetide.sinks.tables import write_shard
from pricetide.sources.tables import read_shards
from pricetide.streaming import append
from pricetide.streaming.crawl import stream_pending
from pricetide.streaming.snapshot import captured, snapshot_run

LOG = "shard string, idx bigint, outcome string, url string"


@pytest.mark.parametrize("seed, ordered", [(1, True), (2, False)])
def test_breaker_over_an_arriving_log(spark, tmp_path, seed, ordered):
    draw = random.Random(seed)
    rows = []
    for n in range(14):
        for i in range(1, draw.choice([1, 2, 5, 40])):
            rows.append((f"s{n}", i, draw.choice(["ok", "fail", "fail", "neutral", None]), f"u{n}-{i}"))
    rows += [("none", i, "fail", "") for i in (2, 3, 4)]
    whole = spark.createDataFrame(rows, LOG)
    by_shard = F.when(F.col("shard").isin("s1", "s2", "s3"), F.lit(1)).otherwise(F.lit(0))
    want = {(r.shard, r.idx, r.stop_idx) for r in breaker.pending_links(whole.where("shard <> 'none'"), ["shard"], overlap=by_shard).collect()}
    if not ordered:
        draw.shuffle(rows)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    size = len(rows) // 4 + 1
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        spark.createDataFrame(part, LOG).write.mode("append").parquet(source)
        for _ in range(2):  # the second run finds nothing
            stream_pending(append.read_new(spark, source, LOG), ["shard"], target, checkpoint, overlap=by_shard, most_overlap=1, block_rows=4)
    got = [(r.shard, r.idx, r.stop_idx) for r in spark.read.parquet(target).collect()]
    # A shard whose first row never arrives stays unjudged.
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


PAGES = "store string, chunk int, run string, url string, html string, captured_at timestamp"


def test_snapshots_go_on_where_a_run_stopped(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("pages", "bronze", "state"))
    html = "<h1>Laptop</h1><p class='box-price-present'>19.000.000₫</p>"
    for i in range(7):
        row = [("tgdd", 1, "r1", f"u{i}", html, None)]
        spark.createDataFrame(row, PAGES).coalesce(1).write.mode("append").parquet(source)
    seen = []

    def run(stop_at=None):
        def transform(pages):
            seen.append(1)
            if len(seen) == stop_at:
                # Half of the batch is written before the run breaks off.
                write_shard(jobs.shard_tables(pages.limit(1), "tgdd").withColumn("run", F.lit(f"r1-{stop_at - 1:06d}")), root)
                raise RuntimeError("stopped")
            return jobs.shard_tables(pages, "tgdd")

        snapshot_run(captured(spark, source, PAGES, 2), transform, root, checkpoint)

    def urls():
        return sorted(r[S.LINK] for r in read_shards(spark, root, "tgdd").collect())

    with pytest.raises(StreamingQueryException):
        run(stop_at=3)
    assert len(urls()) == 5 and len(set(urls())) == 5
    run()
    assert urls() == [f"u{i}" for i in range(7)] and len(seen) == 5
    run()
    assert len(urls()) == 7 and len(seen) == 5


def test_pages_of_few_files_meet_all_tasks(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("pages", "bronze", "state"))
    rows = [("tgdd", 1, "r1", f"u{i}", "<h1>Laptop</h1>", None) for i in range(40)]
    spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(source)
    dealt = []

    def transform(pages):
        dealt.append(pages.groupBy(F.spark_partition_id()).count().count())
        return jobs.shard_tables(pages, "tgdd")

    snapshot_run(captured(spark, source, PAGES, 2), transform, root, checkpoint)
    assert dealt == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert read_shards(spark, root, "tgdd").count() == 40
