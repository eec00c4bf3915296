"""N-gram Jaccard join with vertical partitioning.

1. Documents of the same set of n-grams are one class; classes, not copies, are joined.
2. N-grams are ordered by how full their bucket of a fixed-size count over the whole corpus is, rare ones first. Two
   classes that may reach the threshold share one of their first (1 - threshold) * size + 1 n-grams in that order, so only
   those move; an n-gram that many documents share stands last and is hardly ever among them.
3. Pairs that meet often enough in their prefixes to reach the threshold are verified by vertical partitioning: the global
   order is cut into fragments, fragments count partial overlaps separately, and the parts are summed per pair (links).
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.llm.bpe import packed, unpacked
from quire.llm.common import batch_of, discard, hashed, lower_ascii, mixed, settle, small_batches, steps, unused, utf8, word_array, words
from quire.llm.links import all_links, grouped, linked
from quire.llm.stats import windows

#: Buckets of the corpus count, and rows that carry one task's counts. With too few of them, what else falls into a bucket
#: hides that an n-gram is frequent; its group is then large, and groups are what pairs and crowds grow with.
BUCKETS, SLICES = 1 << 24, 1024


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): each document's distinct n-grams, in order of their hash; shorter texts are one n-gram."""
    data, at = utf8(texts)
    data = lower_ascii(data)
    n = len(at) - 1
    starts, ends, doc = words(data, at)
    own = hashed(word_array(data, starts, ends))
    begins, found = windows(own, doc, width)
    which = doc[begins]
    n_words = np.bincount(doc, minlength=n)
    if (short := (n_words > 0) & (n_words < width)).any():
        picked = short[doc]
        inner = np.arange(len(doc)) - np.concatenate(([0], np.cumsum(n_words)))[doc]
        terms = own[picked] * (inner[picked].astype(np.uint64) * np.uint64(2) + np.uint64(0x5851F42D4C957F2D))
        sums = np.zeros(n, np.uint64)
        np.add.at(sums, doc[picked], terms)
        which = np.concatenate((which, np.flatnonzero(short)))
        found = np.concatenate((found, mixed(sums[short] + n_words[short].astype(np.uint64))))
    order = np.lexsort((found, which))
    which, found = which[order], found[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (which[1:] != which[:-1])
    which, found = which[first], found[first]
    return np.searchsorted(which, np.arange(n + 1)), found


def set_keys(bounds: np.ndarray, found: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    spread = mixed(found ^ np.uint64(0xA0761D6478BD642F))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)))
    return mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts in 256 steps, in their order: a quarter of a root up to 1600, as chance moves a count by half a root's unit
    whatever its size, and an eighth of a doubling from there on."""
    few = 4 * np.sqrt(counts)
    return np.minimum(np.where(counts < 1600, few, 160 + 8 * np.log2(np.maximum(counts, 1) / 1600)), 255).astype(np.uint8)


class Join:
    """The classes of docs and their links at a threshold; see the module for the method.

    Rows with a null id are left out here. Texts without words have an empty set and link with nothing, not even with
    each other. Rows that repeat are of one class; ids are taken to be of one text each.
    """

    def __init__(self, docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 3, threshold: float = 0.9):
        self.spark, self.width = docs.sparkSession, width
        self.share = Fraction(threshold).limit_denominator(1000)
        small_batches(self.spark)
        self.docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
        first = settle(self._first())
        self.rows = settle(first.where("part is null").select("id", "key", "n"))
        self.classes = settle(self.rows.where("n > 0").groupBy("key", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
        self.heaviness = self._heaviness(first)
        discard(first)
        self.shared = settle(self._shared())

    def _first(self) -> DataFrame:
        width, fields = self.width, "id long, key long, n int, slice int, part binary"

        def measure(batches):
            total = np.zeros(BUCKETS, np.uint16)
            for batch in steps(batches):
                bounds, found = shingles(batch.column("text"), width)
                np.add.at(total, (found & np.uint64(BUCKETS - 1)).astype(np.int64), np.uint16(1))
                np.minimum(total, 1 << 15, out=total)  # a step adds less than the rest
                none = pa.nulls(batch.num_rows)
                yield batch_of(fields, id=batch.column("id"), key=set_keys(bounds, found), n=np.diff(bounds), slice=none, part=none)
            parts = {k: packed(memoryview(x)) for k, x in enumerate(np.split(total, SLICES)) if x.any()}
            if parts:
                none = pa.nulls(len(parts))
                yield batch_of(fields, id=none, key=none, n=none, slice=list(parts), part=list(parts.values()))

        return self.docs.mapInArrow(measure, fields)

    def _heaviness(self, first: DataFrame) -> np.ndarray:
        def add(rows: pa.Table) -> pa.Table:
            part = np.zeros(BUCKETS // SLICES, np.int64)
            for p in rows.column("part").to_pylist():
                part += np.frombuffer(unpacked(p), np.uint16)
            return pa.Table.from_batches([batch_of("slice int, part binary", slice=[rows.column("slice")[0].as_py()], part=[levels(part).tobytes()])])

        out = np.zeros((SLICES, BUCKETS // SLICES), np.uint8)
        for r in first.where("part is not null").select("slice", "part").groupBy("slice").applyInArrow(add, "slice int, part binary").collect():
            out[r["slice"]] = np.frombuffer(bytes(r["part"]), np.uint8)
        return out.ravel()

    def _shared(self) -> DataFrame:
        """(h, id, n, g): classes at each n-gram that stands in the prefixes of two classes or more; id is the class's least."""
        width, share = self.width, self.share
        heavy = self.spark.sparkContext.broadcast(self.heaviness)  # BUCKETS numbers, whatever the input

        def prefixes(batches):
            seen: set[int] = set()  # classes this task has given out: a task repeats no copy
            for batch in steps(batches):
                bounds, found = shingles(batch.column("text"), width)
                keys, size = set_keys(bounds, found), np.diff(bounds)
                fresh = np.zeros(len(size), bool)
                for k, key in enumerate(keys.tolist()):
                    if size[k] and key not in seen:
                        seen.add(key)
                        fresh[k] = True
                doc = np.repeat(np.arange(len(size)), size)
                order = np.lexsort((found, heavy.value[(found & np.uint64(BUCKETS - 1)).astype(np.int64)], doc))
                rank = np.arange(len(found)) - bounds[:-1][doc]
                need = -(-size * share.numerator // share.denominator)
                kept = (rank < (size - need + 1)[doc]) & fresh[doc]
                which = doc[kept]
                yield batch_of("h long, key long, n int", h=found[order][kept].view(np.int64), key=keys[which], n=size[which])

        rows = self.docs.select("text").mapInArrow(prefixes, "h long, key long, n int")
        rows = grouped(rows.select("h", F.col("key").alias("id"), "n"))
        return rows.withColumnRenamed("id", "key").join(self.classes, ["key", "n"]).select("h", F.col("rep").alias("id"), "n", "g")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(id, found): the n-gram hashes of these classes."""
        width = self.width

        def collect(batches):
            for batch in steps(batches):
                bounds, found = shingles(batch.column("text"), width)
                yield batch_of("id long, found binary", id=batch.column("id"), found=[found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)])

        rows = self.docs.join(wanted.hint("shuffle_hash"), F.col("id") == F.col("wanted"), "left_semi").mapInArrow(collect, "id long, found binary")
        return rows

    def all_links(self) -> DataFrame:
        """(a, b, na, nb, overlap): every pair of classes that reaches the threshold, by their least ids."""
        return all_links(self.shared, self.sets, self.share, prefixes=True)

    def labels(self) -> DataFrame:
        """(id, label, links): the component of each class that has a link, and the documents that it is linked with."""
        return linked(self.shared, self.sets, self.share, prefixes=True, weights=self.classes.select(F.col("rep").alias("id"), F.col("copies").alias("weight")))

    def members(self) -> DataFrame:
        """(id, n_shingles, component_id, n_links) of every row: the least id that links reach, and how many rows it has a
        link with, copies of it among them."""
        found = self.classes.join(self.labels(), F.col("rep") == F.col("id"), "left").select("key", "n", F.coalesce("label", "rep").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
        rows = self.rows.join(found, ["key", "n"], "left")
        return rows.select("id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 3, threshold: float = 0.9) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row of docs with an id; rows with a null id have nulls in all
    four. Empty tables give no rows."""
    found = Join(docs, id=id, text=text, width=width, threshold=threshold).members().withColumnRenamed("id", "doc_id")
    return found.unionByName(docs.where(F.col(id).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(None).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 3, threshold: float = 0.9) -> DataFrame:
    """docs with one document of each component, that of the least id, with all its columns. Rows that repeat an id are
    one document, of which the row with the least text hash stays; rows with a null id stay."""
    own, number = unused(docs, "__kept"), unused(docs, "__row")
    found = jaccard_components(docs, id=id, text=text, width=width, threshold=threshold).where("doc_id = component_id").select(F.col("doc_id").alias(own)).distinct()
    kept = docs.join(found.hint("shuffle_hash"), F.col(id) == F.col(own), "left_semi")
    kept = kept.withColumn(number, F.row_number().over(W.partitionBy(id).orderBy(F.xxhash64(text)))).where(F.col(number) == 1).drop(number)
    return kept.union(docs.where(F.col(id).isNull()))
