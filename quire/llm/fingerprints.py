"""Document fingerprints from prefix polynomial hashes.

For a text of code points c, the modular prefix array H[i] = sum of c[j] * B^j below i answers whether any two spans are
equal (one product each), and the longest common extension of two places by binary search over lengths. A fingerprint
holds the hash of the whole text, of prefixes and suffixes of geometrically growing lengths, and the least hashes of
short spans at all places, so two fingerprints alone tell equal texts, about how long their common prefix and
suffix are, and about what share of their spans they have in common.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batch_of, mixed, partitions, small_batches

#: Two prime moduli under 2^31 (their products fit 64 bits), their bases, the spans' code points and how many are held.
MODULI, BASES, SPAN, HELD = (2147483647, 2147483629), (911382323, 972663749), 24, 32


@lru_cache(maxsize=1)
def _held() -> list:
    return []


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(B^i, B^-i) modulo each prime, for i up to n at least; doubled as longer texts come."""
    held = _held()
    if not held or len(held[0][0]) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        held.clear()
        for p, b in zip(MODULI, BASES, strict=True):
            both = []
            for x in (b, pow(b, -1, p)):
                run = np.ones(1, np.uint64)
                while len(run) < size:
                    run = np.concatenate((run, run * np.uint64(pow(x, len(run), p)) % np.uint64(p)))
                both.append(run)
            held.append(tuple(both))
    return held


class Prefixes:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        self.points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.n = len(self.points)
        self.powers = _powers(self.n)
        self.sums = []
        for p, (up, _) in zip(MODULI, self.powers, strict=True):
            run = np.zeros(self.n + 1, np.uint64)
            np.cumsum((self.points + np.uint64(1)) * up[: self.n] % np.uint64(p), out=run[1:])
            run %= np.uint64(p)
            self.sums.append(run)

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of spans, equal for equal spans wherever they stand."""
        parts = [(run[end] + np.uint64(p) - run[begin]) % np.uint64(p) * down[begin] % np.uint64(p) for run, p, (_, down) in zip(self.sums, MODULI, self.powers, strict=True)]
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, begin: int, end: int) -> int:
        return int(self.spans(np.array([begin]), np.array([end]))[0])


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """The length of the longest common extension of place i of a and place j of b."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


@lru_cache(maxsize=1)
def grid() -> np.ndarray:
    """Lengths 1, 2, 3 ... that grow by the fourth root of 2, up to 2^40."""
    return np.unique(np.round(2.0 ** (np.arange(0, 161) / 4)).astype(np.int64))


def least_distinct(values: np.ndarray, n: int) -> np.ndarray:
    """The n least distinct values, in order. Some more than n of the least are looked at first, without sorting the rest."""
    if len(values) > 16 * n:
        found = np.unique(np.partition(values, 4 * n)[: 4 * n])
        if len(found) >= n:
            return found[:n]
    return np.unique(values)[:n]


class Fingerprint:
    def __init__(self, text: str):
        self.prefixes = p = Prefixes(text)
        self.n = p.n
        lengths = grid()[: np.searchsorted(grid(), p.n, "right")]
        self.whole = p.span(0, p.n)
        self.heads = (mixed(p.spans(np.zeros(len(lengths), np.int64), lengths)) & np.uint64(0xFFFFFF)).astype(np.uint32)
        ends = lengths[::2]
        self.tails = (mixed(p.spans(p.n - ends, np.full(len(ends), p.n))) & np.uint64(0xFFFFFF)).astype(np.uint32)
        begins = np.arange(max(0, p.n - SPAN + 1))
        self.least = least_distinct(mixed(p.spans(begins, begins + SPAN)) >> np.uint64(24), HELD)

    def text(self) -> str:
        """The fingerprint as a string: code points, whole hash, then prefix, suffix and span hashes in base 64."""
        b64 = lambda x, size: base64.b64encode(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()).decode()
        return f"{self.n:x}.{self.whole:016x}.{b64(self.heads, 3)}.{b64(self.tails, 3)}.{b64(self.least, 5)}"

    @classmethod
    def parse(cls, said: str) -> Fingerprint:
        n, whole, *arrays = said.split(".")
        out = cls.__new__(cls)
        out.n, out.whole = int(n, 16), int(whole, 16)

        def back(x: str, size: int) -> np.ndarray:
            data = np.frombuffer(base64.b64decode(x), np.uint8).reshape(-1, size)
            return np.pad(data, ((0, 0), (0, 8 - size))).copy().view("<u8").ravel()

        out.heads, out.tails, out.least = back(arrays[0], 3), back(arrays[1], 3), back(arrays[2], 5)
        return out


def _common(a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> int:
    """The greatest grid length at which two rows of hashes agree, by binary search: they agree up to it and not beyond."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return int(lengths[low - 1]) if low else 0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """From 0 to 1 by the fingerprints alone: 1 for equal texts; else the greater of the share that common prefix and
    suffix have in the longer text, and the share of common spans (of the union, estimated from the least hashes)."""
    if (a.n, a.whole) == (b.n, b.whole):
        return 1.0
    lengths = grid()
    ends = _common(a.heads, b.heads, lengths) + _common(a.tails, b.tails, lengths[::2])
    share = min(ends, a.n, b.n) / max(a.n, b.n)
    union = np.union1d(a.least, b.least)[:HELD]
    spans = len(np.intersect1d(np.intersect1d(a.least, b.least, assume_unique=True), union, assume_unique=True)) / max(1, len(union))
    return min(float(max(share, spans)), 0.9999)


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, same_prefix_next long"


def _row(text: str, own: Fingerprint, after: str, next_: Fingerprint) -> tuple:
    half = own.n // 2
    edited = text[: own.n - half] + after[:half]
    changed = Fingerprint(edited)
    return own.n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.text(), changed.text(), likeness(own, changed), likeness(own, next_), common_extension(own.prefixes, 0, next_.prefixes, 0)


def fingerprints(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, same_prefix_next per row.

    The next document is that of the next lower id; ids that repeat follow each other by text, null ids come last, and
    after the last row comes the first. The edited text has the last floor(n / 2) code points replaced by as many of the
    next text, or all it has. A null text is empty; one row alone is its own next. same_prefix_next is the exact length of
    the common prefix with the next text.

    Ids are cut into ranges at quantiles; a range is sorted and read once, with the first row of the range after it as a
    guest at its end, so whole texts move once and neighbours meet without a global order in one task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id].dataType.simpleString()
    ranges = 4 * partitions(spark)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    quantiles = rows.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0] or []
    cuts = sorted(set(quantiles), reverse=True)
    place = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c > F.col("id"))) if cuts else F.lit(0))
    rows = rows.withColumn("range", place.cast("int")).withColumn("guest", F.lit(0))
    heads = sorted(((r["range"], r["top"]) for r in rows.groupBy("range").agg(F.max("id").alias("top")).collect()), key=lambda x: x[0])
    fields = f"{id} {kind}, {RESULT}"
    if not heads:
        return spark.createDataFrame([], fields)
    before = {own: heads[k - 1][0] for k, (own, _) in enumerate(heads)}
    firsts = spark.createDataFrame([(before[own], top) for own, top in heads], f"to int, top {kind}")
    guests = rows.join(F.broadcast(firsts), F.col("id").eqNullSafe(F.col("top"))).select("id", "text", F.col("to").alias("range"), F.lit(1).alias("guest"))
    dealt = rows.union(guests).repartition(partitions(spark), "range").sortWithinPartitions("range", "guest", F.desc_nulls_last("id"), "text")

    def walk(batches):
        held = None  # the row whose next one is awaited: range, id, text, fingerprint
        for batch in batches:
            out = {c: [] for c in [id, *[x.split(" ")[0] for x in RESULT.split(", ")]]}
            for own_id, own_text, own_range, guest in zip(*[batch.column(c).to_pylist() for c in ("id", "text", "range", "guest")], strict=True):
                if guest and (held is None or held[0] != own_range):
                    continue
                own = Fingerprint(own_text)
                if held is not None and held[0] == own_range:
                    for c, v in zip(out, (held[1], *_row(held[2], held[3], own_text, own)), strict=True):
                        out[c].append(v)
                held = None if guest else (own_range, own_id, own_text, own)
            yield batch_of(fields, **out)

    return dealt.mapInArrow(walk, fields)
