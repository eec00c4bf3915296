"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree. DataFrame functions only.

1. Each source's documents lie on a line of words in a hashed order; a block is so many neighbouring words of it, the last
   one of a line may be shorter. A target above the source's size takes blocks of the line a second time.
2. A source's blocks are permuted, and its target is met by the blocks of the first places, of which the last is cut to
   the word. Exact quotas of blocks of each source go down a binary tree of output shards: a node's left half takes a
   multivariate-hypergeometric draw of its blocks, source after source, by inversion of the distribution.
3. Each shard draws its quota of every source as the next places of that source's permutation, so draws never overlap, and
   puts its pieces in a hashed order of its own: mixed_texts writes shard after shard in that order.

Tables that grow with the input are joined by sort and merge; only that of the sources may be broadcast, and then Spark's
own threshold checks its size. The sources themselves are few: one task ranks them, and a node of the tree holds a number
for each.

All draws come from hashes of the seed, node and source: reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.llm.common import settle, unused

#: Weights of the sources in code point order, null last, repeating; share of all words to take; most times of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Levels of the tree between two tables of it, and primes of which one is a permutation's step.
LEVELS, PRIMES = 4, (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)
#: Words in a block, blocks in an output shard, documents in a stretch of a source's line (about), and the seed.
BLOCK_WORDS, SHARD_BLOCKS, STRETCH, SEED = 4096, 512, 2000, 17
WORD, GAP = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]*"


def sized(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    return docs.select(F.col(id).alias("id"), F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text).alias("digest"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, rank, source_size, n_docs, target): one row for each source.

    Targets fill like water: by weight, up to `most` times the source's size; the sources in order of size over weight
    meet that limit first. A source without words has target 0.
    """
    every, order = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy("ratio", "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = per.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())).cast("long"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    per = per.withColumn("level", (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("final", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "rank", "level"))).over(every)["level"])
    return per.select("source", "rank", "source_size", "n_docs", F.least(F.col("most"), F.coalesce(F.col("final") * F.col("weight"), F.col("most"))).alias("target"))


def on_lines(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Each document with its place on its source's line: running sums inside stretches, and of stretches before them."""
    stretch = W.partitionBy("rank", "stretch")
    rows = sizes.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "id", "size"))
    rows = rows.withColumn("stretch", F.pmod(F.shiftright("h", 20), F.ceil(F.col("n_docs") / STRETCH))).withColumn("inner", F.sum("size").over(stretch.orderBy("h", "id", "size", "digest").rowsBetween(W.unboundedPreceding, -1)))
    sums = rows.groupBy("rank", "stretch").agg(F.sum("size").alias("words"))
    sums = sums.select("rank", "stretch", F.coalesce(F.sum("words").over(W.partitionBy("rank").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("outer"))
    return rows.join(sums.hint("merge"), ["rank", "stretch"]).withColumn("start", F.coalesce("inner", F.lit(0)) + F.col("outer")).drop("inner", "outer", "h", "stretch")


class Blocks:
    """Columns about the blocks of a source's line in one pass; rank and source_size are columns of the row."""

    def __init__(self, number: Column, block_words: int, seed: int):
        self.pass_, self.words, self.seed = number, block_words, seed
        self.size = F.col("source_size")
        self.n = F.ceil(self.size / block_words).cast("long")

    def place(self, block: Column) -> Column:
        """The place of a block in the permutation: a walk with a prime step, which no number of blocks shares."""
        h = F.xxhash64(F.lit(self.seed), "rank", self.pass_)
        fit = F.filter(F.array(*[F.lit(p).cast("long") for p in PRIMES]), lambda p: self.n % p != 0)
        step = F.element_at(fit, (F.pmod(h, F.size(fit)) + 1).cast("int"))
        return F.pmod(block * step + F.pmod(F.shiftright(h, 8), self.n), self.n)

    def before(self, place: Column) -> Column:
        """Words in the blocks of the places before this one; only the last block of the line may be short."""
        short = self.n * self.words - self.size
        return place * self.words - F.when(self.place(self.n - 1) < place, short).otherwise(0)

    def rest(self, goal: Column) -> Column:
        """Words that this pass takes."""
        return F.least(F.greatest(goal - self.pass_ * self.size, F.lit(0).cast("long")), self.size)

    def needed(self, goal: Column) -> Column:
        """How many places meet that."""
        rest = self.rest(goal)
        least = F.ceil(rest / self.words).cast("long")
        return F.when(rest <= 0, F.lit(0).cast("long")).when(self.before(least) < rest, least + 1).otherwise(least)


def hypergeometric(total: Column, own: Column, drawn: Column, u: Column) -> Column:
    """How many of `own` among `total` are in `drawn` of them: the quantile u of the exact distribution.

    Its probabilities are walked by their ratios over twelve standard deviations on both sides of the mean, outside of
    which less than 1e-30 lies; the first is set to 1, and neither underflow nor overflow can occur on that range.
    """
    d = lambda c: c.cast("double")
    mean = d(own) * d(drawn) / F.greatest(d(total), F.lit(1.0))
    spread = F.sqrt(F.greatest(mean * (1 - d(own) / F.greatest(d(total), F.lit(1.0))) * (d(total) - d(drawn)) / F.greatest(d(total) - 1, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.lit(0).cast("long"), drawn + own - total, F.floor(mean - 12 * spread - 6).cast("long"))
    high = F.greatest(low, F.least(own, drawn, F.ceil(mean + 12 * spread + 6).cast("long")))

    def step(s: Column, k: Column) -> Column:
        ratio = (d(own) - d(k)) * (d(drawn) - d(k)) / ((d(k) + 1) * (d(total) - d(own) - d(drawn) + d(k) + 1))
        return F.struct((s["w"] * F.greatest(ratio, F.lit(0.0))).alias("w"), (s["sum"] + s["w"]).alias("sum"), F.when((s["at"] < 0) & (s["sum"] + s["w"] >= s["goal"]), k).otherwise(s["at"]).alias("at"), s["goal"].alias("goal"))

    start = lambda goal: F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("at"), goal.alias("goal"))
    whole = F.aggregate(F.sequence(low, high), start(F.lit(float("inf"))), step)["sum"]
    found = F.aggregate(F.sequence(low, high), start(whole * u * (1 - 1e-12)), step)["at"]
    return F.when(own <= 0, F.lit(0).cast("long")).when(drawn <= 0, F.lit(0).cast("long")).when(drawn >= total, own).otherwise(F.when(found < 0, high).otherwise(found))


def split(quotas: DataFrame, seed: int, shard_blocks: int) -> DataFrame:
    """(rank, shard, first, n): each shard's quota of each source's blocks, and where they begin on its line.

    quotas: rank, blocks. The tree's state is one row for each node with an array of (rank, blocks), as long as there are
    sources; its depth is the logarithm of the number of shards.
    """
    top = quotas.where("blocks > 0").agg(F.array_sort(F.collect_list(F.struct("rank", "blocks"))).alias("left"), F.coalesce(F.sum("blocks"), F.lit(0)).alias("all"))
    top = settle(top.select(F.lit(0).cast("long").alias("low"), F.greatest(F.lit(1), F.ceil(F.col("all") / shard_blocks)).cast("long").alias("high"), F.col("left").alias("parts")))
    shards = (top.first() or {"high": 1})["high"]
    nodes = top
    for level in range(max(0, (int(shards) - 1).bit_length())):
        middle = F.shiftright(F.col("low") + F.col("high"), 1)
        total = F.aggregate("parts", F.lit(0).cast("long"), lambda s, x: s + x["blocks"])
        nodes = nodes.withColumn("middle", middle).withColumn("total", total)
        nodes = nodes.withColumn("want", F.floor(F.col("total").cast("double") * (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low"))).cast("long"))

        def draw(s: Column, x: Column) -> Column:
            u = (F.pmod(F.xxhash64(F.lit(seed), F.col("low"), F.col("high"), x["rank"]), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)
            got = hypergeometric(s["total"], x["blocks"], s["want"], u)
            return F.struct((s["total"] - x["blocks"]).alias("total"), (s["want"] - got).alias("want"), F.concat(s["taken"], F.array(F.struct(x["rank"].alias("rank"), got.alias("blocks")))).alias("taken"))

        none = F.expr("cast(array() as array<struct<rank: bigint, blocks: bigint>>)")
        taken = F.aggregate("parts", F.struct(F.col("total").alias("total"), F.col("want").alias("want"), none.alias("taken")), draw)["taken"]
        nodes = nodes.withColumn("taken", F.when(F.col("middle") > F.col("low"), taken).otherwise(none))
        rest = F.transform("parts", lambda x, i: F.struct(x["rank"].alias("rank"), (x["blocks"] - F.get("taken", i)["blocks"]).alias("blocks")))
        halves = F.when(F.col("middle") > F.col("low"), F.array(F.struct("low", F.col("middle").alias("high"), F.col("taken").alias("parts")), F.struct(F.col("middle").alias("low"), "high", rest.alias("parts")))).otherwise(F.array(F.struct("low", "high", "parts")))
        nodes = nodes.select(F.explode(halves).alias("x")).select("x.low", "x.high", "x.parts")
        if level % LEVELS == LEVELS - 1:
            nodes = settle(nodes.repartition("low"))
    leaves = nodes.select(F.col("low").alias("shard"), F.explode("parts").alias("p")).select("shard", "p.rank", F.col("p.blocks").alias("n"))
    return leaves.withColumn("first", F.coalesce(F.sum("n").over(W.partitionBy("rank").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def mix(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).

    documents: id, source, rank, size, digest, source_size, target, start, for every row of docs; start is its place on its line.
    pieces: id, source, rank, size, start, pass, block, shard, from_word, n_words, place: each stretch of a document's words
    that the mix takes; pass is 0 or 1, a source's blocks are numbered on over the passes, from_word counts from 0 in the
    document, place is the order inside its shard. Null and blank texts have size 0 and no piece; a null source is a
    source; ids may be null or repeat. Documents are never cut but where a block ends, and a block's end splits a document
    into pieces of two blocks, each of which the mix may take or not.
    """
    sizes = settle(sized(docs, id, text, source))
    sources = settle(targets(sizes))
    lines = settle(on_lines(sizes, sources, seed))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    passes = [Blocks(F.lit(k).cast("long"), block_words, seed) for k in range(MOST)]
    quotas = sources.where("source_size > 0").select("rank", reduce(lambda a, b: a + b, [p.needed(goal) for p in passes]).alias("blocks"))
    owners = split(quotas, seed, shard_blocks).where("n > 0").select("rank", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("at"))
    own = Blocks(F.col("pass"), block_words, seed)
    cut = lines.where("size > 0").withColumn("pass", F.explode(F.array([F.lit(k).cast("long") for k in range(MOST)]))).withColumn("rest", own.rest(goal)).where("rest > 0")
    cut = cut.withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))))
    cut = cut.withColumn("own", own.place(F.col("b"))).withColumn("most", F.least(F.lit(block_words).cast("long"), F.col("rest") - own.before(F.col("own"))))
    left, right = F.greatest("start", F.col("b") * block_words), F.least(F.col("start") + F.col("size"), F.col("b") * block_words + F.col("most"))
    cut = cut.withColumns({"left": left, "right": right}).where("left < right")
    cut = cut.select("id", "source", "rank", "size", "start", "pass", (F.col("b") + F.col("pass") * own.n).alias("block"), (F.col("own") + F.col("pass") * own.n).alias("at"), (F.col("left") - F.col("start")).alias("from_word"), (F.col("right") - F.col("left")).alias("n_words"))
    pieces = cut.join(owners.hint("merge"), ["rank", "at"]).drop("at").withColumn("place", F.xxhash64(F.lit(seed + 1), "shard", "id", "pass", "block", "from_word"))
    return lines.select("id", "source", "rank", "size", "digest", "source_size", "target", "start"), pieces


def taken(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards: each document with the words that its pieces take, repeats counted,
    and the shards that they are in."""
    per = pieces.groupBy("rank", "start").agg(F.sum("n_words").alias("got"), F.array_sort(F.collect_set("shard")).alias("shards"))
    rows = documents.join(per.hint("merge"), ["rank", "start"], "left")
    some = F.col("size") > 0
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.when(some, F.coalesce("got", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"), F.coalesce(F.when(some, F.col("shards")), F.expr("cast(array() as array<bigint>)")).alias("shards"))


def mixed_texts(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", chars: str = "n_chars", **how) -> DataFrame:
    """docs with each row once for each pass that takes words of it, shard after shard and in each shard's own order; a row
    stands in the shard of its first piece. A text of which a pass takes a part keeps those words and what stands between
    them, and its column `chars`, where there is one, is counted anew.

    Rows alike in id, source and text are alike for the mix too.
    """
    documents, pieces = mix(docs, id=id, text=text, source=source, **how)
    names, hidden = list(docs.columns), {n: unused(docs, f"__{n}") for n in ("size", "key", "copy", "key_", "x", "n", "said", "plan")}
    key = lambda id, source, size, digest: F.xxhash64(id, source, size, digest)
    each = F.struct("from_word", "n_words", "shard", "place")
    per = pieces.groupBy("rank", "start", "pass").agg(F.array_sort(F.collect_list(each)).alias("pieces"))
    slots = documents.where("size > 0").withColumn("key", key("id", "source", "size", "digest"))
    slots = slots.withColumn("copy", F.row_number().over(W.partitionBy("key").orderBy("id", "source", "size", "digest", "start")))
    plans = slots.join(per.hint("merge"), ["rank", "start"]).groupBy("key").agg(F.collect_list(F.struct("copy", "pieces")).alias(hidden["plan"])).withColumnsRenamed({"key": hidden["key_"]})
    tagged = docs.withColumn(hidden["size"], F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")).where(F.col(hidden["size"]) > 0)
    tagged = tagged.withColumn(hidden["key"], key(F.col(id), F.col(source), F.col(hidden["size"]), F.xxhash64(text)))
    tagged = tagged.withColumn(hidden["copy"], F.row_number().over(W.partitionBy(hidden["key"]).orderBy(id, source, hidden["size"], F.xxhash64(text))))
    rows = tagged.join(plans.hint("shuffle_hash"), F.col(hidden["key"]) == F.col(hidden["key_"]))
    rows = rows.withColumn(hidden["x"], F.explode(F.filter(hidden["plan"], lambda x: x["copy"] == F.col(hidden["copy"]))["pieces"]))
    found = F.col(hidden["x"])
    rows = rows.withColumn(hidden["n"], F.aggregate(found, F.lit(0).cast("long"), lambda s, x: s + x["n_words"]))
    words = F.regexp_extract_all(F.col(text), F.lit(f"{WORD}{GAP}"), F.lit(0))
    part = F.array_join(F.transform(found, lambda x: F.array_join(F.slice(words, (x["from_word"] + 1).cast("int"), x["n_words"].cast("int")), "")), "")
    part = F.concat(F.when(found[0]["from_word"] == 0, F.regexp_extract(F.col(text), f"^{GAP}", 0)).otherwise(F.lit("")), part)
    whole = F.col(hidden["n"]) == F.col(hidden["size"])
    rows = rows.withColumn(hidden["said"], F.when(whole, F.col(text)).otherwise(part))
    rows = rows.repartition(found[0]["shard"]).sortWithinPartitions(found[0]["shard"], found[0]["place"])
    said = F.col(hidden["said"])
    counted = F.when(whole, F.col(chars)).otherwise(F.char_length(said).cast("long")) if chars in names else None
    return rows.select(*[said.alias(text) if c == text else counted.alias(c) if c == chars else F.col(c) for c in names])
