"""Quality rules: fixed rules on counts, then a log-likelihood ratio of hashed n-grams.

Words and pairs of words of the trusted documents and of the whole corpus are hashed into a fixed number of buckets. The
mean logarithm of the ratio of the two multinomials over a document's n-grams is its score; a document is kept from a
fixed score on. Both tables of counts cover all rows, and only they (a fixed number of buckets) reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batch_of, small_batches, steps, utf8
from quire.llm.stats import Words

#: Buckets of the multinomials (a power of two), what is added to each count, and the least mean log ratio of a kept text.
BUCKETS, ADDED, LEAST = 1 << 16, 10.0, -0.1
#: Rows that carry one task's counts; each is summed on its own.
SLICES = 64


def counts(docs: DataFrame, trusted: DataFrame, id: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(trusted, all): n-grams in each bucket. A document is trusted if its id is in `trusted`."""
    marked = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text")).join(trusted.select(F.col(id).alias("__id")).where("__id is not null").distinct().withColumn("__good", F.lit(True)).hint("shuffle_hash"), "__id", "left").select("__text", "__good")
    fields = "slice int, part binary"

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in steps(batches, "__text"):
            w = Words(*utf8(batch.column("__text")))
            bucket, doc = w.grams(BUCKETS)
            good = batch.column("__good").is_valid().to_numpy(zero_copy_only=False)
            total[1] += np.bincount(bucket, minlength=BUCKETS)
            total[0] += np.bincount(bucket[good[doc]], minlength=BUCKETS)
        if total.any():
            yield batch_of(fields, slice=range(SLICES), part=[np.ascontiguousarray(x).tobytes() for x in np.split(total, SLICES, axis=1)])

    def add(rows: pa.Table) -> pa.Table:
        part = np.sum([np.frombuffer(p, np.int64) for p in rows.column("part").to_pylist()], axis=0)
        return pa.Table.from_batches([batch_of(fields, slice=[rows.column("slice")[0].as_py()], part=[part.tobytes()])])

    summed = sorted(marked.mapInArrow(count, fields).groupBy("slice").applyInArrow(add, fields).collect(), key=lambda r: r["slice"])
    if not summed:
        return np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    total = np.concatenate([np.frombuffer(bytes(r["part"]), np.int64).reshape(2, -1) for r in summed], axis=1)
    return total[0], total[1]


def log_ratio(good: np.ndarray, every: np.ndarray) -> np.ndarray:
    """The logarithm of trusted over raw probability of each bucket; all zero where nothing is trusted.

    Raw counts are scaled to the trusted total before the same number is added to both, so that a bucket which is rare in
    both says next to nothing, whether or not the trusted documents happen to hold it.
    """
    if not good.sum():
        return np.zeros(len(good))
    return np.log(good + ADDED) - np.log(every * (good.sum() / every.sum()) + ADDED)


def apply_rules(docs: DataFrame, trusted: DataFrame, *, id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept for every row of docs.

    A null text has no words; without n-grams the score is null and base_failed holds. Null ids are never trusted; rows
    that repeat are judged alike and count each time.
    """
    small_batches(docs.sparkSession)
    ratio = log_ratio(*counts(docs, trusted, id, text)).astype(np.float64)
    fields = f"{id} {docs.schema[id].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"

    def judge(batches):
        for batch in steps(batches, "__text"):
            w = Words(*utf8(batch.column("__text")))
            bucket, doc = w.grams(BUCKETS)
            grams = np.bincount(doc, minlength=w.n)
            score = np.bincount(doc, weights=ratio[bucket], minlength=w.n) / np.maximum(grams, 1)
            again = w.n_repeat_words()
            failed = (w.n_words < 20) | (100 * again > 30 * w.n_words)
            yield batch_of(fields, **{id: batch.column(id), "n_words": w.n_words, "word_chars": w.word_chars(), "n_symbols": w.n_symbols(), "n_dup_lines": w.n_lines_and_dup_lines()[1], "n_repeat_words": again, "base_failed": failed, "score": pa.array(score, mask=grams == 0), "kept": ~failed & (score >= least)})

    return docs.select(id, F.col(text).alias("__text")).mapInArrow(judge, fields)
