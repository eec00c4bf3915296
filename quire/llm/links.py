"""Links between sets that reach a Jaccard threshold, from groups in which candidates meet, and their components.

Verification is by vertical partitioning: the global order of elements (their hash) is cut into fragments; each fragment of
a bucket of candidates counts its part of the overlaps on its own, and the parts are summed per pair. A bucket with more
elements is cut into more fragments, so no task holds more than a fixed number of them, about; where pairs crowd round one
set, they are dealt into more buckets.

Groups of up to LIMIT sets give all their pairs. Sets that meet in larger ones are gathered into crowds, a crowd is cut by
size into blocks, and each two blocks whose sizes allow a link are compared in one task, fragment after fragment, in a
matrix of overlaps. Such a task gives each set one link to its component in the two blocks and the number of its links, so
a large group of near copies makes rows in proportion to its members and not to their pairs, and both stay exact. The
number of block pairs still grows with the square of a crowd's blocks, as exact numbers of links need every pair; a block
goes to each of its pairs, so pairs are compared in waves that hold no more than all blocks once, or WAVE elements.

No step gathers a group in one task: what is counted or ranked in a group is counted in parts of it first (graph.totals).
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.llm.common import batch_of, discard, partitions, settle, tidy
from quire.llm.graph import components, in_parts, totals

#: Members of a group that gives all its pairs; elements that a fragment of a bucket holds, about, and pairs round one set
#: that are one bucket's; sets of a crowd's block, and elements that its matrices have at once; elements that are sent to pairs of
#: blocks at once, where the crowds have no more themselves.
LIMIT, FRAGMENT, PAIRS, BLOCK, COLUMNS, WAVE = 48, 500_000, 100_000, 512, 4096, 32_000_000
#: Buckets in which groups are counted to find large ones, and rows that a bucket holds more than four shares, at least.
BUCKETS, HOT = 1 << 16, 1000


def close_in_size(pairs: DataFrame, share: Fraction) -> DataFrame:
    return pairs.where(F.least("na", "nb") * share.denominator >= F.greatest("na", "nb") * share.numerator)


def _ordered(rows: DataFrame, share: Fraction) -> DataFrame:
    """(a, b, na, nb) of rows that hold id, n, id_ and n_."""
    first = F.col("id") < F.col("id_")
    either = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return close_in_size(rows.select(either("id", "id_").alias("a"), either("id_", "id").alias("b"), either("n", "n_").alias("na"), either("n_", "n").alias("nb")), share)


def _met(rows: DataFrame, apart: str, share: Fraction) -> DataFrame:
    other = rows.select(*[F.col(c).alias(f"{c}_") for c in rows.columns])
    p, q = share.numerator, share.denominator
    near = f"least(n, n_) * {q}L >= greatest(n, n_) * {p}L"
    return _ordered(rows.join(other, (F.col("h") == F.col("h_")) & F.expr(apart) & F.expr(near)), share)


def _apart(rows: DataFrame) -> list[int]:
    """Buckets of h that hold far more of the rows than a bucket's share: a quarter of them at most."""
    bound = HOT + 4 * rows.count() // BUCKETS
    per = rows.groupBy(_bucket().alias("bucket")).agg(F.count("*").alias("c"))
    return sorted(r["bucket"] for r in per.where(F.col("c") > bound).collect())


def _bucket() -> Column:
    return F.pmod(F.xxhash64("h"), F.lit(BUCKETS)).cast("int")


def _once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, each id of a group once, with how many there are as g."""
    at = W.partitionBy(*keys).orderBy("id")
    once = rows.withColumn("before", F.lag("id").over(at)).where("before is null or before <> id").drop("before")
    return once.withColumn("g", F.count("*").over(W.partitionBy(*keys)))


def grouped(rows: DataFrame) -> DataFrame:
    """The rows (h, id, n and other columns) of groups h with two members or more, each id once, and the group's size g.

    Groups in buckets that hold far more than their share are counted in parts, and the parts are summed.
    """
    rows = settle(rows)
    apart = _apart(rows)
    if not apart:
        out = settle(_once(rows, ["h"]).where("g > 1"))
        discard(rows)
        return out
    marked = rows.withColumn("bucket", _bucket()).join(F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in apart], "bucket int").withColumn("hot", F.lit(True))), "bucket", "left").drop("bucket")
    cold = _once(marked.where("hot is null").drop("hot"), ["h"]).where("g > 1")
    hot = settle(_once(in_parts(marked.where("hot").drop("hot"), "id"), ["h", "part"]))
    size = totals(hot, ["h"], {"g": F.max("g")}, {"g": F.sum("g")}).where("g > 1")
    out = settle(cold.unionByName(hot.drop("g").join(size, ["h", "part"]).drop("part")))
    discard(rows, hot)
    return out


def candidates(shared: DataFrame, share: Fraction, limit: int, prefixes: bool) -> DataFrame:
    """(a, b, na, nb): the pairs of the groups of up to `limit` sets.

    prefixes: groups are the elements of the sets' prefixes for this threshold. A pair's overlap is then at most the
    elements that meet and what stands behind the prefix of the set whose prefix ends first; pairs that cannot reach the
    threshold by that are left out. (Pairs that meet in larger groups too are of one crowd, and compared there.)
    """
    pairs = _met(shared.where(F.col("g") <= limit).select("h", "id", "n"), "id < id_", share).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"))
    if prefixes:
        p, q = share.numerator, share.denominator
        whole = F.expr(f"(({p}L * (na + nb)) + {p + q - 1}L) div {p + q}L")  # the least overlap that reaches the threshold
        behind = F.expr(f"({p}L * greatest(na, nb) + {q - 1}L) div {q}L - 1")
        pairs = pairs.where(F.col("c") + behind >= whole)
    return pairs.select("a", "b", "na", "nb")


def verified(pairs: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """The pairs (a, b, na, nb) that reach the threshold, with their overlap. sets: id, found (sorted 64-bit elements); rows
    that repeat an id count once."""
    buckets = partitions(pairs.sparkSession) * 4
    # Pairs of a group of candidates are near each other if they are dealt by the least id that meets their first one.
    ends = in_parts(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a")), "v")
    met = totals(ends, ["u"], {"m": F.min("v")}, {"m": F.min("m")})
    labelled = in_parts(pairs.select("a", "b", "na", "nb"), "b").join(met.withColumnRenamed("u", "a"), ["a", "part"]).select("a", "b", "na", "nb", F.least("a", "m").alias("label"))
    labelled = in_parts(labelled, "a")
    many = totals(labelled, ["label"], {"c": F.count("*")}, {"c": F.sum("c")})
    apart = F.pmod(F.xxhash64(F.lit(7), "a"), F.ceil(F.col("c") / PAIRS))
    bucket = F.pmod(F.xxhash64("label", apart), F.lit(buckets)).cast("int")
    dealt = settle(labelled.join(many, ["label", "part"]).select(bucket.alias("bucket"), "a", "b", "na", "nb"))
    members = dealt.select("bucket", F.col("a").alias("id"), F.col("na").alias("n")).union(dealt.select("bucket", "b", "nb")).distinct()
    cuts = settle(members.groupBy("bucket").agg(F.greatest(F.lit(2), F.ceil(F.sum("n") / FRAGMENT)).cast("int").alias("cuts")))
    ddl = "bucket int, fragment int, id long, found binary"

    def cut(batches):
        for batch in batches:
            out = {"bucket": [], "fragment": [], "id": [], "found": []}
            for b, i, f, k in zip(*[batch.column(c).to_pylist() for c in ("bucket", "id", "found", "cuts")], strict=True):
                values = np.frombuffer(f, np.uint64)
                edges = np.searchsorted(values >> np.uint64(32), (np.arange(k + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(k))
                for j in np.flatnonzero(np.diff(edges)).tolist():
                    for c, v in zip(out, (b, j, i, values[edges[j] : edges[j + 1]].tobytes()), strict=True):
                        out[c].append(v)
            yield batch_of(ddl, **out)

    segments = sets.join(members.join(cuts, "bucket"), "id").select("bucket", "id", "found", "cuts").mapInArrow(cut, ddl)
    dealt = dealt.join(cuts, "bucket").select("bucket", F.explode(F.expr("sequence(0, cuts - 1)")).alias("fragment"), "a", "b")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        segment = dict(zip(left.column("id").to_pylist(), (np.frombuffer(x, np.uint64) for x in left.column("found").to_pylist()), strict=True))
        a, b, part = [], [], []
        for x, y in zip(right.column("a").to_pylist(), right.column("b").to_pylist(), strict=True):
            if (u := segment.get(x)) is not None and (v := segment.get(y)) is not None:
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                at[at == len(v)] = 0
                if hits := int((v[at] == u).sum()):
                    a.append(x), b.append(y), part.append(hits)
        return pa.Table.from_batches([batch_of("a long, b long, part long", a=a, b=b, part=part)])

    parts = segments.groupBy("bucket", "fragment").cogroup(dealt.groupBy("bucket", "fragment")).applyInArrow(count, "a long, b long, part long")
    total = parts.groupBy("a", "b").agg(F.sum("part").alias("overlap")).join(pairs, ["a", "b"])
    p, q = share.numerator, share.denominator
    return total.where(F.col("overlap") * q >= (F.col("na") + F.col("nb") - F.col("overlap")) * p).select("a", "b", "na", "nb", "overlap")


def all_links(shared: DataFrame, sets: Callable[[DataFrame], DataFrame], share: Fraction, *, prefixes: bool) -> DataFrame:
    """(a, b, na, nb, overlap): every pair that reaches the threshold."""
    pairs = settle(candidates(shared, share, 1 << 62, prefixes))
    return verified(pairs, settle(sets(_ids(pairs))), share)


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("wanted")).union(pairs.select("b")).distinct()


def near(sets: list[np.ndarray], others: list[np.ndarray], share: Fraction) -> np.ndarray:
    """Which of the sets reach the threshold with which of the others; overlaps are summed over fragments of the elements."""
    sizes, other_sizes = np.array([len(x) for x in sets]), np.array([len(x) for x in others])
    values, codes = np.unique(np.concatenate([*sets, *others]), return_inverse=True)
    times = np.bincount(codes, minlength=len(values))
    column = np.full(len(values), -1)
    column[times > 1] = np.arange(int((times > 1).sum()))
    row = np.repeat(np.arange(len(sets) + len(others)), np.concatenate((sizes, other_sizes)))
    column = column[codes]
    overlap = np.zeros((len(sets), len(others)), np.float32)
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0) :]
    edges = np.searchsorted(column[order], np.arange(0, int(column.max(initial=-1)) + 1 + COLUMNS, COLUMNS))
    for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        fragment = np.zeros((len(sets) + len(others), COLUMNS), np.float32)
        fragment[row[order[a:b]], column[order[a:b]] - k * COLUMNS] = 1
        overlap += fragment[: len(sets)] @ fragment[len(sets) :].T
    both = overlap.astype(np.int64)
    return both * share.denominator >= (sizes[:, None] + other_sizes[None, :] - both) * share.numerator


def joined(ids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The least id of each place's component, for links between places."""
    label = ids.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, rows, label[columns])
        np.minimum.at(new, columns, label[rows])
        if (new == label).all():
            return label
        label = new


def _blocks(large: DataFrame, members: DataFrame) -> DataFrame:
    """(label, id, n, block) of all members of crowds, sorted by size: blocks of BLOCK sets, or twice as many, at most.

    Sizes that many sets of a crowd have are cut into blocks by a hash; the others share blocks with their neighbours.
    """
    light = settle(in_parts(large.select("id", "n").distinct().join(members, "id"), "id"))
    per = totals(light, ["label", "n"], {"c": F.count("*")}, {"c": F.sum("c")})
    order = W.partitionBy("label").orderBy("n").rowsBetween(W.unboundedPreceding, -1)  # of sizes, not of sets
    own = per.groupBy("label", "n").agg(F.first("c").alias("c")).withColumn("k", F.when(F.col("c") >= BLOCK, F.ceil(F.col("c") / BLOCK)).otherwise(0))
    before = own.withColumn("small", F.coalesce(F.sum(F.when(F.col("k") == 0, F.col("c")).otherwise(0)).over(order), F.lit(0)))
    before = before.withColumn("large", F.coalesce(F.sum("k").over(order), F.lit(0))).select("label", "n", "k", "small", "large")
    cut = light.join(per.join(before, ["label", "n"]), ["label", "n", "part"])
    block = F.when(F.col("k") == 0, -1 - F.floor(F.col("small") / BLOCK)).otherwise(F.col("large") + F.pmod(F.xxhash64(F.lit(3), "id"), F.greatest("k", F.lit(1))))
    return cut.select("label", "id", "n", block.cast("long").alias("block"))


def crowds(large: DataFrame, sets: DataFrame, share: Fraction, weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, crowd), (a, b, links)) of all sets that meet in groups of `large` (h, id, n).

    The links (a, b) join components, one row for each set b of two blocks, a may be b itself; `links` adds up the weights
    (id, weight) of all sets there that b is linked with.
    """
    p, q = share.numerator, share.denominator
    large = in_parts(large, "id")
    least = totals(large, ["h"], {"low": F.min("id")}, {"low": F.min("low")})
    members = settle(components(large.join(least, ["h", "part"]).select(F.col("low").alias("a"), F.col("id").alias("b"))))
    blocked = settle(_blocks(large, members).join(sets, "id").dropDuplicates(["label", "id"]).join(weights, "id"))
    spans = blocked.groupBy("label", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.sum("n").alias("all"))
    later = spans.select(F.col("label").alias("label_"), F.col("block").alias("j"), F.col("low").alias("low_"), F.col("high").alias("high_"), F.col("all").alias("all_"))
    met = spans.join(later, (F.col("label") == F.col("label_")) & (F.col("block") <= F.col("j")) & (F.col("high") * q >= F.col("low_") * p) & (F.col("high_") * q >= F.col("low") * p))
    met = settle(met.select("label", F.col("block").alias("i"), "j", (F.col("all") + F.col("all_")).alias("both")))
    held, sent = blocked.agg(F.sum("n")).first()[0] or 0, met.agg(F.sum("both")).first()[0] or 0
    waves = max(1, -(-sent // max(held, WAVE)))

    def compare(rows: pa.Table) -> pa.Table:
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        block = rows.column("block").to_numpy()
        ids = rows.column("id").to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in rows.column("found").to_pylist()]
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        weight = rows.column("weight").to_numpy()
        met = near([found[k] for k in one], [found[k] for k in two], share)
        if i == j:
            np.fill_diagonal(met, False)
        a, b = np.nonzero(met)
        links = np.bincount(one[a], weights=weight[two[b]], minlength=len(ids))
        if i != j:
            links += np.bincount(two[b], weights=weight[one[a]], minlength=len(ids))
        return pa.Table.from_batches([batch_of("a long, b long, links long", a=joined(ids, one[a], two[b]), b=ids, links=links.astype(np.int64))])

    def wave(k: int) -> DataFrame:
        some = met.where(F.pmod(F.xxhash64("label", "i", "j"), F.lit(waves)) == k)
        sides = some.select("label", "i", "j", F.col("i").alias("block")).union(some.select("label", "i", "j", F.col("j").alias("block"))).distinct()
        return settle(blocked.join(sides, ["label", "block"]).groupBy("label", "i", "j").applyInArrow(compare, "a long, b long, links long"))

    compared = []
    for k in range(waves):
        compared.append(wave(k))
        tidy(met.sparkSession)
    return members.withColumnRenamed("label", "crowd"), reduce(DataFrame.union, compared)


def linked(shared: DataFrame, sets: Callable[[DataFrame], DataFrame], share: Fraction, *, prefixes: bool, limit: int = LIMIT, weights: DataFrame | None = None) -> DataFrame:
    """(id, label, links): the component of every set that has a link, and the weights of all sets it is linked with.

    shared: as grouped() gives; sets: from the ids wanted; weights: (id, weight), 1 for each set if none are given.
    """
    pairs = settle(candidates(shared, share, limit, prefixes))
    large = settle(shared.where(F.col("g") > limit).select("h", "id", "n"))
    again = bool(large.head(1))
    wanted = settle(_ids(pairs).union(large.select("id")).distinct() if again else _ids(pairs))
    found = settle(sets(wanted))
    if weights is None:
        weights = wanted.select(F.col("wanted").alias("id"), F.lit(1).cast("long").alias("weight"))
    links = settle(verified(pairs, found, share).select("a", "b"))
    if again:
        members, compared = crowds(large, found, share, weights)
        crowd = lambda c: members.select(F.col("id").alias(c), F.col("crowd").alias(f"crowd_{c}"))
        # Pairs inside one crowd are compared there; counted here too, they would count twice.
        links = links.join(crowd("a"), "a", "left").join(crowd("b"), "b", "left").where("crowd_a is null or crowd_b is null or crowd_a <> crowd_b").select("a", "b")
        links = settle(links)
    discard(found)
    labels = components(links.union(compared.select("a", "b")) if again else links)
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select("b", "a"))
    degrees = both.join(weights.withColumnsRenamed({"id": "other", "weight": "links"}), "other").select("id", "links")
    if again:
        degrees = degrees.union(compared.select("b", "links"))
    return labels.join(degrees.groupBy("id").agg(F.sum("links").alias("links")), "id")
