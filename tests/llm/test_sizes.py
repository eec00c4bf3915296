"""What must not grow faster than the input: maps, orders and rows whose size shows on large tables only."""

import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm import jaccard_join, links, substring_dedup
from tests.llm.conftest import sentence


def test_map_of_keys_grows_with_them(spark):
    """With 2^26 bits whatever the input, 4 million keys let through 6 % of what has no key, and 12 million 16 %."""
    keys = spark.range(4_000_000).select(F.xxhash64("id").bitwiseAND(F.lit(-2)).alias("key"))
    bits = substring_dedup.bitmap(keys)
    some = np.array([r["key"] for r in keys.where("key % 1000 = 0").collect()], np.int64).view(np.uint64)
    others = np.random.default_rng(3).integers(0, 1 << 63, 1_000_000, np.uint64) * np.uint64(2)
    assert len(some) > 1000 and substring_dedup.probed(bits, some).all()
    assert substring_dedup.probed(bits, others).mean() < 0.03


def test_windows_of_a_repeat_stay_together(spark, monkeypatch):
    rng = random.Random(4)
    passage = sentence(rng, 600, 9000)
    docs = [(k, sentence(rng, 80, 9000) + " " + passage + " " + sentence(rng, 80, 9000)) for k in range(3)] + [(3, " ".join(["one", "two", "three"] * 60))]
    rows = substring_dedup._numbered(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    exact = {r["id"]: [m for m in r["marks"] if m["key"] is None] for r in substring_dedup.marked(rows, 0.8).collect()}
    assert sum(m["more"] + 1 for m in exact[1]) == 600 - substring_dedup.PASSAGE + 1
    assert len(exact[1]) < 150 and len(exact[3]) < 50  # a row for each window made 551 and 128
    kept = [sorted(r["kept_sha256"] for r in substring_dedup.deduplicate(rows, id="id").collect())]
    monkeypatch.setattr(substring_dedup, "COMMON", 0)  # every anchor is a common one then, and windows are counted one by one
    kept.append(sorted(r["kept_sha256"] for r in substring_dedup.deduplicate(rows, id="id").collect()))
    assert kept[0] == kept[1]


def test_frequent_ngrams_are_told_apart():
    """An n-gram in 48 of the documents of 6 GB (1.4 billion n-grams) stands behind the rarest tenth, whatever shares its bucket."""
    others = np.random.default_rng(1).poisson(1.4e9 / jaccard_join.BUCKETS, 400_000)
    rare = np.quantile(jaccard_join.levels(others), 0.1)
    assert (jaccard_join.levels(others + 48) <= rare).mean() < 0.001
    steps = jaccard_join.levels(np.arange(1_000_000)).astype(int)
    assert (np.diff(steps) >= 0).all() and steps[0] == 0 and steps[1] > 0


def test_crowds_are_compared_in_waves(spark, monkeypatch):
    rng = random.Random(6)
    base = sentence(rng, 60).split()
    rows = []
    for k in range(150):
        text = list(base)
        text[rng.randrange(60)] = f"x{k % 50}"
        rows.append((k, " ".join(text[: 60 - k % 4])))
    monkeypatch.setitem(links.linked.__kwdefaults__, "limit", 8)
    monkeypatch.setattr(links, "BLOCK", 8)
    found, sent = [], []
    real = links.settle
    monkeypatch.setattr(links, "settle", lambda df: (sent.append(1) if df.columns == ["a", "b", "links"] else None, real(df))[1])
    for wave in (links.WAVE, 1):
        monkeypatch.setattr(links, "WAVE", wave)
        found.append(sorted(map(tuple, jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
        sent.append(0)
    assert found[0] == found[1] and sum(r[3] for r in found[0]) > 200
    assert sent.index(0) == 1 and len(sent) > 5  # one wave, then several
