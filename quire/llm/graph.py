"""Connected components of a table of links, and totals of groups of which a few may be large."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batch_of, discard, partitions, settle

#: Links in a task and file, about, parts into which the rows of one group are dealt, and links that one task joins alone.
TASK, PARTS, ALONE = 200_000, 64, 1_000_000


def in_parts(rows: DataFrame, by: str, name: str = "part") -> DataFrame:
    """rows with the part of its group that each is in, by the column `by`."""
    return rows.withColumn(name, F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int"))


def totals(rows: DataFrame, keys: list[str], first: dict[str, Column], then: dict[str, Column], part: str = "part") -> DataFrame:
    """(keys, names, part): aggregates of each group, one row for each part of it that there is.

    first: aggregates of a part; then: the same of those. Joined back on keys and part, the rows of a large group meet
    their totals in as many tasks as it has parts, and no task gathers a group: of each part there is one row.
    """
    parts = rows.groupBy(*keys, part).agg(*[c.alias(n) for n, c in first.items()])
    whole = parts.groupBy(*keys).agg(*[c.alias(n) for n, c in then.items()], F.collect_list(part).alias("parts"))
    return whole.select(*keys, *then, F.explode("parts").alias(part))


def least_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, least id of each one's component) of the links between u and v."""
    ids, codes = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = codes[: len(u)], codes[len(u) :]
    label = np.arange(len(ids))
    while len(a):
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while ((up := label[label]) != label).any():
            label = up
        a, b = label[a], label[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return ids, ids[label]


def _alone(batches):
    table = pa.Table.from_batches(batches, pa.schema([("u", pa.int64()), ("v", pa.int64())]))
    ids, label = least_labels(table.column("u").to_numpy(), table.column("v").to_numpy())
    for k in range(0, len(ids), TASK):
        yield batch_of("id long, label long", id=ids[k : k + TASK], label=label[k : k + TASK])


def components(links: DataFrame, a: str = "a", b: str = "b", alone: int = ALONE) -> DataFrame:
    """(id, label): each id in a link with the least id of its component.

    Up to `alone` links are joined in one task, in arrays of a bounded size: rounds over so few cost plans and jobs, which
    the driver holds, and not data. More take alternating large-star and small-star steps: every round is two aggregations
    with partial sums and joins back, in which the links of a star's centre are dealt in parts; links are written to the
    shared folder after each round, and nothing but two sums reaches the driver. A link to null or from an id to itself says
    nothing. Rounds end when the links no longer change, after about log2 of the longest path.
    """
    spark = links.sparkSession
    edges = settle(links.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    last = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == last:
            break
        last = state
        if not state["n"]:
            return spark.createDataFrame([], edges.select(F.col("u").alias("id"), F.col("v").alias("label")).schema)
        if state["n"] <= alone:
            out = settle(edges.coalesce(1).mapInArrow(_alone, edges.select(F.col("u").alias("id"), F.col("v").alias("label")).schema))
            discard(edges)
            return out
        tasks = 2 * state["n"] // TASK + 1
        slim = (lambda d: d.coalesce(tasks)) if tasks < partitions(spark) else (lambda d: d)  # noqa: B023  few links, few tasks
        least = lambda rows: slim(totals(rows, ["u"], {"m": F.min("v")}, {"m": F.min("m")}))  # noqa: E731, B023
        # large star: every greater neighbour of u moves to u's least neighbour
        both = in_parts(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "v")
        large = both.where("v > u").join(least(both), ["u", "part"]).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = in_parts(slim(large.distinct()), "v")
        # small star: every lesser neighbour of u, and u itself, moves to the least of them
        low = least(large)
        moved = large.join(low, ["u", "part"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, edges = edges, settle(slim(moved.union(low.select("u", F.col("m").alias("v"))).distinct()))
        discard(old)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
