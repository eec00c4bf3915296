"""Settled tables cost no shuffle files: what made them is dropped as soon as they are written. Few links take few jobs."""

import random
import time

from pyspark.sql import functions as F

from quire.llm import common, graph, suffix_dedup


def shuffled(spark):
    return {f.getName().rsplit(".", 1)[0] for f in list(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles())) if f.getName().startswith("shuffle_")}


def test_settled_tables_leave_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(common, "TIDY", 0.0, raising=False)
    before = shuffled(spark)
    kept = [common.settle(spark.range(20_000).groupBy((F.col("id") % (90 + k)).alias("k")).agg(F.sum("id").alias("s"))) for k in range(3)]
    until = time.monotonic() + 5
    while (left := shuffled(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert [x.count() for x in kept] == [90, 91, 92]


def test_few_links_take_few_jobs_and_rounds_agree(spark):
    rng = random.Random(8)
    pairs = [(x, x + 1) for x in range(0, 60)] + [(rng.randrange(-500, 500), rng.randrange(-500, 500)) for _ in range(300)] + [(7, 7), (None, 3), (1 << 62, -(1 << 62))]
    links = spark.createDataFrame(pairs, "a long, b long")
    least = {x: x for a, b in pairs if a is not None and a != b for x in (a, b)}
    while any(least[a] != least[b] for a, b in pairs if a is not None and a != b):
        for a, b in pairs:
            if a is not None and a != b:
                least[a] = least[b] = min(least[a], least[b])
    spark.sparkContext.setJobGroup("few links", "")
    got = graph.components(links)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few links"))
    spark.sparkContext.setJobGroup("", "")
    assert sorted(map(tuple, got.collect())) == sorted(least.items())
    assert jobs <= 8
    assert sorted(map(tuple, graph.components(links, alone=0).collect())) == sorted(least.items())
    assert graph.components(links.where("a = b")).collect() == []


def test_spans_hold_no_shuffle_of_texts(spark):
    rng = random.Random(9)
    common_part = "".join(rng.choice("abcdefgh ") for _ in range(700))
    rows = spark.createDataFrame([(k, k, k, f"{k} {common_part} {k}") for k in range(6)] + [(9, 9, 9, "alone")], "id long, row long, crc long, text string")
    spans = suffix_dedup.removed_spans(rows, suffix_dedup.LENGTH, suffix_dedup.MEMORY)
    assert "Exchange" not in spans._jdf.queryExecution().toString()
    assert sorted(r["row"] for r in spans.collect()) == list(range(6))
