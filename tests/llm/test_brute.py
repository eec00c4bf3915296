"""Each operator against a plain version on small texts."""

import collections
import hashlib
import importlib
import math
import pathlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import bpe, fingerprints, jaccard_join, licenses, links, lm_scores, mixing, quality_classifier, quality_rules, substring_dedup, suffix_dedup, suffix_sort
from quire.llm.common import utf8, vocabulary
from quire.llm.common import words as spans_of_words
from tests.llm.conftest import sentence, words


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_words_of_a_step():
    texts = ["", "a", " b\n", "x y", "z", " ", "ü v w"]
    data, at = utf8(pa.array([*texts, None]))
    starts, ends, doc = spans_of_words(data, at)
    got = [(int(d), bytes(data[a:b]).decode()) for a, b, d in zip(starts, ends, doc, strict=True)]
    assert got == [(k, w) for k, t in enumerate(texts) for w in words(t)]


@pytest.mark.parametrize("memory", [1 << 28, 5000, 200])
def test_suffix_arrays(memory):
    rng = random.Random(1)
    for turn in range(60):
        t = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 60))]
        if turn % 3 == 0 and len(t) > 10:
            t[len(t) // 2 : len(t) // 2 + len(t) // 4] = t[: len(t) // 4]
        t.append(0)
        order = sorted(range(len(t)), key=lambda i: t[i:])
        lcp = [0] + [next((k for k in range(len(t)) if t[a + k : a + k + 1] != t[b + k : b + k + 1] or max(a, b) + k >= len(t)), 0) for a, b in zip(order, order[1:], strict=False)]
        scratch = suffix_sort.Scratch(memory)
        got, common = suffix_sort.suffix_array(np.array(t), scratch)
        assert list(got) == order and list(common) == lcp
        scratch.close()


@pytest.mark.parametrize(("memory", "hot", "length"), [(1 << 28, 10_000, 60), (3000, 10_000, 60), (1 << 28, 2, 60), (1 << 28, 2, 110)])
def test_op1_removes_what_repeats(spark, memory, hot, length, monkeypatch):
    rng = random.Random(2)
    shared = [sentence(rng, 30) for _ in range(3)]
    texts = [sentence(rng, rng.randint(5, 60)) for _ in range(25)]
    for k in range(0, 25, 2):
        at = rng.randrange(len(texts[k]))
        texts[k] = texts[k][:at] + rng.choice(shared) + texts[k][at:]
    texts += [texts[0], texts[0][5:200], "ab" * 200, "q" * 61, "q" * 59, "", None, sentence(rng, 20) * 2]
    near = list(texts[2])
    near[50] = "#"
    texts.append("".join(near))
    monkeypatch.setattr(suffix_dedup, "HELD", 100 if memory < 10_000 else 16 << 20)
    count = collections.Counter()
    bodies = [(t or "").encode() for t in texts]
    for b in bodies:
        count.update(b[p : p + length] for p in range(len(b) - length + 1))
    got = {r["doc_id"]: r for r in suffix_dedup.deduplicate(frame(spark, list(enumerate(texts))), length=length, memory=memory, hot=hot, keep_text=True).collect()}
    for k, b in enumerate(bodies):
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        n_spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) == (len(b), int(gone.sum()), n_spans, hashlib.sha256(left).hexdigest(), left), k


def test_op2_is_the_library(spark, awkward):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in awkward.where("doc_id is not null").collect()}
    rows = [(k, x) for k, x in texts.items()] + [(500, "a<|startoftext|>B \u0085c\x0bd don't 12.5% ＡＢ naïve"), (501, "<|STARTOFTEXT|> İK")]
    for r in bpe.round_trip(frame(spark, rows), tokens=True, decoded=True).collect():
        ids = t.encode(dict(rows)[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        assert r["token_ids"] == ids and r["decoded"] == decoded and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_op2_without_the_right_replies():
    listed = [b"alpha", b"beta", b"gamma"]
    path = vocabulary("word_bpe_49k.json")
    empty = pa.table({"bucket": pa.array([], pa.int32()), "check": pa.array([], pa.int64()), "counts": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
    wrong = pa.table({"bucket": pa.array([0, 1], pa.int32()), "check": [1, 2], "counts": [b"", b""], "ids": [b"", b""]})
    expected = bpe.encoded(listed, path)
    for replies in (empty, wrong):
        got = bpe.looked_up(listed, replies, 2, path)
        assert all((a == b).all() for a, b in zip(got, expected, strict=True))


def filled(sizes, weights, share=1.5, most=2):
    total, free = share * sum(sizes.values()), set(sizes)
    while True:
        rest = total - sum(most * sizes[s] for s in sizes if s not in free)
        level = rest / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > most * sizes[s]}
        if not over:
            return {s: level * weights[s] if s in free else most * sizes[s] for s in sizes}
        free -= over


def test_op3_takes_what_targets_say(spark):
    rng = random.Random(4)
    rows = [(k, sentence(rng, rng.randint(0, 900)), rng.choice(["a", "b", "b", "b", "ä", "Z", None])) for k in range(200)] + [(901, "x y", "a"), (901, "x y", "a"), (900, None, "empty")]
    docs = frame(spark, rows, "doc_id long, text string, source string").repartition(3)
    documents, pieces = mixing.mix(docs, block_words=256, shard_blocks=16)
    got = mixing.taken(documents, pieces).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken(*mixing.mix(docs.repartition(5), block_words=256, shard_blocks=16)).collect()))
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    expected = filled(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    source_of = collections.defaultdict(set)
    for k, _, s in rows:
        source_of[k].add(s)
    taken = collections.Counter()
    for r in got:
        [s] = source_of[r["doc_id"]]
        assert r["target"] == pytest.approx(expected[s]) and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - expected[s]) <= 0.5 + 1e-6 for s in sizes)
    per = pieces.groupBy("shard").sum("n_words").collect()
    assert len(per) > 8 and pieces.groupBy("rank", "block").agg({"shard": "approx_count_distinct"}).where("`approx_count_distinct(shard)` > 1").count() == 0
    texts = mixing.mixed_texts(docs, block_words=256, shard_blocks=16).collect()
    assert sum(len(words(r["text"])) for r in texts) == sum(r["taken"] for r in got)


def test_op3_blocks_shards_and_spacing(spark):
    rng = random.Random(24)
    gaps = [" ", "\n", "  ", "\t\n", "\r\n"]
    text = lambda n: rng.choice(["", " ", "\n"]) + "".join(f"w{rng.randrange(10**9)}" + rng.choice(gaps) for _ in range(n)) + f"w{rng.randrange(10**9)}" + rng.choice(["", "\n"])
    rows = [(k, text(rng.choice([5, 40, 300, 900])), "abcd"[k % 4]) for k in range(160)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    how = {"block_words": 128, "shard_blocks": 16}
    documents, pieces = mixing.mix(docs, **how)
    pieces = pieces.cache()
    got = {r["doc_id"]: r["taken"] for r in mixing.taken(documents, pieces).collect()}
    other = {r["doc_id"]: r["taken"] for r in mixing.taken(*mixing.mix(docs, **how, seed=99)).collect()}
    source_of = {k: s for k, _, s in rows}
    totals = [collections.Counter() for _ in range(2)]
    for t, taken_ in zip(totals, (got, other), strict=True):
        for k, n in taken_.items():
            t[source_of[k]] += n
    assert totals[0] == totals[1] and got != other  # another seed takes other words, as many of each source
    each = pieces.collect()
    blocks, shards = collections.defaultdict(set), collections.defaultdict(set)
    for r in each:
        blocks[(r["rank"], r["block"])].add(r["shard"])
        shards[r["shard"]].add((r["rank"], r["block"]))
    assert all(len(x) == 1 for x in blocks.values()) and len(shards) > 4
    sizes = [len(x) for x in shards.values()]
    assert max(sizes) <= 17 and min(sizes) >= 15  # the tree's shards hold so many blocks each
    spread = sum(b + 1 not in {y for r, y in own if r == rank} for own in shards.values() for rank, b in own)
    assert spread > 0.5 * sum(sizes)  # blocks of a shard are not neighbours on a line
    of = {k: t for k, t, _ in rows}
    seen, texts = collections.Counter(), mixing.mixed_texts(docs, **how).collect()
    for r in texts:
        whole, n = of[r["doc_id"]], len(words(r["text"]))
        seen[r["doc_id"]] += n
        if n == len(words(whole)):
            assert r["text"] == whole
        else:
            rest = iter(words(whole))
            assert all(w in rest for w in words(r["text"]))
    assert seen == collections.Counter({k: n for k, n in got.items() if n})
    gap_of = {w.split()[0]: w for _, t, _ in rows for w in re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t)}
    cut = [r for r in texts if len(words(r["text"])) < len(words(of[r["doc_id"]]))]
    assert cut and all(gap_of[w.split()[0]] == w for r in cut for w in re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]+", r["text"])[:-1])
    assert "Broadcast" not in mixing.taken(documents, pieces)._jdf.queryExecution().executedPlan().toString()
    written = [r["doc_id"] for r in texts]
    assert written != sorted(written)


def test_op3_permutation(spark):
    from pyspark.sql import functions as F

    for size, words_ in ((1000, 128), (1024, 128), (5, 128), (129, 128)):
        own = mixing.Blocks(F.lit(0).cast("long"), words_, 5)
        n = -(-size // words_)
        got = spark.range(n).select(F.col("id"), F.lit(2).alias("rank"), F.lit(size).cast("long").alias("source_size")).select("id", own.place(F.col("id")).alias("place"), own.before(own.place(F.col("id"))).alias("before")).collect()
        assert sorted(r["place"] for r in got) == list(range(n))
        total = 0
        for r in sorted(got, key=lambda r: r["place"]):
            assert r["before"] == total
            total += min(words_, size - r["id"] * words_)
        assert total == size


def test_op3_hypergeometric(spark):
    from pyspark.sql import functions as F

    total, own, drawn = 50, 20, 17
    frame_ = spark.range(0, 4000).select(mixing.hypergeometric(F.lit(total).cast("long"), F.lit(own).cast("long"), F.lit(drawn).cast("long"), (F.col("id") + 0.5) / 4000).alias("k"))
    seen = collections.Counter(r["k"] for r in frame_.collect())
    for k in range(18):
        exact = math.comb(own, k) * math.comb(total - own, drawn - k) / math.comb(total, drawn)
        assert abs(seen[k] / 4000 - exact) < 1 / 2000


def test_op4_counts_and_model(spark):
    rng = random.Random(6)
    rows = [(k, sentence(rng, rng.randint(0, 80), 60).upper() if k % 3 else sentence(rng, 40, 60)) for k in range(120)] + [(200, None), (201, "Never seen")]
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in rows}
    tokens = {k: [*words((t or "").lower()), None] for k, t in rows}
    count = collections.Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(count.values()), len(count)
    for r in lm_scores.score_documents(frame(spark, rows)).collect():
        ws = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(count[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def plain_score(tokens, count, w, of, class_n, class_v):
    """log10 of the probability of (spelling, word) tokens, one token after another."""
    e, q, k, v, distance, out, bias = [x.astype(np.float64) for x in w]
    total = 0.0
    for t, (ids, word) in enumerate(tokens):
        first = t // lm_scores.HALF * lm_scores.HALF - lm_scores.HALF - 1
        before = [[lm_scores.START] if j < 0 else tokens[j][0] for j in range(max(-1, first), t)]
        x = np.array([e[y].mean(axis=0) for y in before])
        own = x[-1]
        weight = x @ k @ (own @ q) / math.sqrt(lm_scores.WIDTH) + distance[np.arange(len(x))[::-1]]
        weight = np.exp(weight - weight.max())
        h = own + (weight / weight.sum()) @ (x @ v)
        logits = h @ out + bias
        c = of[ids[0]]
        total += (logits[c] - logits.max() - np.log(np.exp(logits - logits.max()).sum())) / math.log(10)
        total += math.log10((count[word] + 0.5) / (class_n[c] + 0.5 * (class_v[c] + 1)))
    return total


def test_op4_scores_are_the_models(spark, monkeypatch):
    rng = random.Random(26)
    names = [sentence(rng, 1, 5000) for _ in range(80)]
    after = {w: rng.sample(names, 3) for w in names}

    def chain(n):
        out = [rng.choice(names)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return " ".join(out[:n])

    rows = [(k, chain(rng.randint(0, 90))) for k in range(900)] + [(5000, None), (5001, "ünseen wörds \U0001f600 " * 20)]
    seen = {}
    real = lm_scores.train
    monkeypatch.setattr(lm_scores, "train", lambda *a: seen.setdefault("w", real(*a)))
    got = {r["doc_id"]: r for r in lm_scores.score_documents(frame(spark, rows).repartition(3)).collect()}
    spelling = lambda word: [int(x) for x in lm_scores.spelt([word.encode()], vocabulary("word_bpe_49k.json"))[1]] if word is not None else [lm_scores.END]
    tokens = {k: [(spelling(x), x) for x in [*words((t or "").lower()), None]] for k, t in rows}
    count = collections.Counter(x for k, ts in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1 for _, x in ts)
    known = lm_scores.Counts(count[None], np.zeros(lm_scores.NONE + 1, np.int64), np.zeros(lm_scores.NONE + 1, np.int64))
    for word, n in count.items():
        if word is not None:
            known.n[spelling(word)[0]] += n
            known.v[spelling(word)[0]] += 1
    of, class_n, class_v = known.classes()
    assert np.bincount(of, weights=class_n[of] * 0 + 1).sum() == lm_scores.NONE + 1 and of[lm_scores.END] == 0
    for k in [*range(0, 900, 29), 5000, 5001]:
        assert got[k]["score"] == pytest.approx(plain_score(tokens[k], count, seen["w"], of, class_n, class_v), rel=1e-4), k
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 900]
    per = lambda c: sum(r[c] for r in held) / sum(r["n_tokens"] for r in held)
    assert len(held) > 100 and per("score") > per("base_score") + 0.05


def test_op4_gradients_and_causality():
    rng = np.random.default_rng(0)
    w = [x.astype(np.float64) for x in lm_scores.fresh(np.arange(lm_scores.CLASSES))]
    lengths = rng.integers(1, 4, 75)
    ids, at = rng.integers(0, lm_scores.SYMBOLS, int(lengths.sum())), np.array([0, 40, 40, 75])
    tokens = lm_scores.Tokens(ids, lengths, at)
    inputs, targets, doc = tokens.windows()
    assert (targets >= 0).sum() == 75 and list(doc) == [0, 0, 0, 2, 2, 2]
    classes = np.where(targets < 0, -1, tokens.first[targets] % lm_scores.CLASSES)
    spelled = lm_scores.Spelling(tokens, inputs)
    loss = lambda: -lm_scores.log_probs(w, spelled, classes).sum() / 75
    (rows, d_e), *grads = lm_scores.gradients(w, spelled, classes)
    dense = np.zeros_like(w[0])
    dense[rows] = d_e
    assert set(rows.tolist()) <= {*ids.tolist(), lm_scores.START, lm_scores.PAD}
    for x, g in zip(w, [dense, *grads], strict=True):
        place = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = x[place]
        x[place] = old + 1e-5
        up = loss()
        x[place] = old - 1e-5
        down = loss()
        x[place] = old
        assert (up - down) / 2e-5 == pytest.approx(g[place], rel=2e-2)
    before = lm_scores.log_probs(w, spelled, classes)
    changed = ids.copy()
    a, b = tokens.edges[30], tokens.edges[40]
    changed[a:b] = (changed[a:b] + 7) % lm_scores.SYMBOLS
    other = lm_scores.Tokens(changed, lengths, at)
    after = lm_scores.log_probs(w, lm_scores.Spelling(other, other.windows()[0]), classes)
    assert np.allclose(before[:2].ravel()[:31], after[:2].ravel()[:31]) and not np.allclose(before[2], after[2])
    every = np.tile(np.arange(lm_scores.CLASSES)[:, None], (1, lm_scores.HALF))
    tiled = lm_scores.Spelling(tokens, np.tile(inputs[1], (lm_scores.CLASSES, 1)))
    assert np.exp(lm_scores.log_probs(w, tiled, every)).sum(axis=0) == pytest.approx(1)


def test_op4_trains_on_every_window_once(monkeypatch):
    class Rows:
        where = select = groupBy = withColumn = lambda self, *a: self

        def mapInArrow(self, learn, ddl):
            self.out = [r for b in learn([batch]) for r in b.to_pylist()]
            return self

        applyInArrow = lambda self, *a: self
        collect = lambda self: self.out

    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 4, 9000).astype("<u4")
    symbols, cut = rng.integers(0, lm_scores.SYMBOLS, int(lengths.sum())).astype("<u2"), int(lengths[:5000].sum())
    batch = pa.RecordBatch.from_pydict({"symbols": pa.array([symbols[:cut].tobytes(), symbols[cut:].tobytes()], pa.binary()), "lengths": pa.array([lengths[:5000].tobytes(), lengths[5000:].tobytes()], pa.binary())})
    seen, of, spell = collections.Counter(), np.arange(lm_scores.NONE + 1) % lm_scores.CLASSES, lm_scores.Spelling

    class Seen(spell):
        def __init__(self, tokens, inputs):
            seen.update(x.tobytes() for x in inputs)
            super().__init__(tokens, inputs)

    monkeypatch.setattr(lm_scores, "Spelling", Seen)
    monkeypatch.setattr(lm_scores.F, "pmod", lambda *a: None)
    monkeypatch.setattr(lm_scores.F, "spark_partition_id", lambda: None)
    monkeypatch.setattr(lm_scores.F, "lit", lambda x: None)
    w = lm_scores.train(Rows(), of, np.arange(lm_scores.CLASSES))
    assert seen == collections.Counter(x.tobytes() for x in lm_scores._tokens(batch).windows()[0])
    start = lm_scores.fresh(np.arange(lm_scores.CLASSES))
    moved = np.flatnonzero((w[0] != start[0]).any(axis=1))
    assert set(moved.tolist()) <= {*symbols.tolist(), lm_scores.START, lm_scores.PAD} and len(moved) > 5000


def test_op5_fingerprints(spark):
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(0, 60)) for _ in range(40)] + ["", None, "é\U0001f600" * 30, "x"]
    texts[5] = texts[4]
    rows = [(3 * k - 20, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(frame(spark, rows).repartition(3)).collect()}
    order = [k for k, _ in rows][::-1]
    of = {k: t or "" for k, t in rows}
    for place, k in enumerate(order):
        after = of[order[(place + 1) % len(order)]]
        half = len(of[k]) // 2
        edited = of[k][: len(of[k]) - half] + after[:half]
        r = got[k]
        assert r["n_chars"] == len(of[k]) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, other = fingerprints.Fingerprint.parse(r["fingerprint"]), fingerprints.Fingerprint.parse(r["edited_fingerprint"])
        assert fingerprints.likeness(own, other) == r["near_edited"] and 0 <= r["near_next"] <= 1
        assert (r["near_next"] == 1) == (of[k] == after)
        assert r["same_prefix_next"] == next((i for i, (a, b) in enumerate(zip(of[k], after, strict=False)) if a != b), min(len(of[k]), len(after)))
        if len(of[k]) > 60:
            assert 0.4 <= r["near_edited"]
    assert len({r["fingerprint"] for r in got.values()}) == len(set(of.values()))
    [one] = fingerprints.fingerprints(frame(spark, [(1, "abc")])).collect()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"aba").hexdigest()


def test_op5_texts_without_space():
    rng = random.Random(15)
    one, other = ("".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(2000)) for _ in range(2))
    near = one[:5] + "x" + one[6:-5] + "y" + one[-4:]
    like = lambda a, b: fingerprints.likeness(fingerprints.Fingerprint(a), fingerprints.Fingerprint(b))
    assert like(one, near) > 0.7 and like(one, one[:24] + other) < 0.2


def test_op5_least_distinct():
    rng = np.random.default_rng(2)
    for high in (5, 200, 1 << 40):
        for n in (0, 3, 40, 513, 5000):
            x = rng.integers(0, high, n).astype(np.uint64)
            assert (fingerprints.least_distinct(x, 32) == np.unique(x)[:32]).all()


def test_op5_spans_and_extensions():
    a, b = fingerprints.Prefixes("abcabcabx"), fingerprints.Prefixes("zabcabcaby")
    assert a.span(0, 3) == a.span(3, 6) == b.span(1, 4) != a.span(1, 4)
    assert fingerprints.common_extension(a, 0, b, 1) == 8 and fingerprints.common_extension(a, 3, a, 0) == 5


def rule_counts(text):
    ws, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = collections.Counter(tuple(ws[k : k + 8]) for k in range(len(ws) - 7))
    cover = {j for k in range(len(ws) - 7) if count[tuple(ws[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover), len(ws) < 20 or 100 * len(cover) > 30 * len(ws)


def test_op6_counts_and_verdicts(spark, awkward):
    rng = random.Random(8)
    rows = [(r["doc_id"], r["text"]) for r in awkward.where("doc_id between 0 and 8").dropDuplicates(["doc_id"]).collect()]
    rows += [(100, "a b\n\na b\nc\na b"), (101, "a b\na b")] + [(1000 + k, sentence(rng, 60, 300)) for k in range(80)] + [(2000 + k, sentence(rng, 60, 300).upper().replace(" ", "!! ")) for k in range(40)]
    rows.append((1500, " ".join(sentence(rng, 9, 300) for _ in range(1)) + " " + " ".join([sentence(random.Random(1), 10)] * 4)))
    good = frame(spark, [(k, 1) for k in range(1000, 1060)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(frame(spark, rows), good).collect()}
    for k, text in rows:
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == rule_counts(text), k
    assert all(got[1000 + k]["kept"] for k in range(80)) and not any(got[2000 + k]["kept"] for k in range(40)) and not got[1500]["kept"]


def test_op6_ratio():
    good, every = np.array([8, 0, 2]), np.array([10, 10, 20])
    expected = [math.log((g + 10) / (e / 4 + 10)) for g, e in zip(good, every, strict=True)]
    assert quality_rules.log_ratio(good, every) == pytest.approx(expected)
    assert not quality_rules.log_ratio(np.zeros(3), every).any()


def test_op7_learns(spark):
    rng = random.Random(9)
    good = lambda: sentence(rng, rng.randint(30, 90), 300).capitalize() + "."
    bad = lambda: rng.choice([lambda: " ".join(["buy"] * 60), lambda: sentence(rng, 50).upper().replace(" ", "!! "), lambda: sentence(rng, 50).replace(" ", "### ")])()
    rows = [(k, good() if k % 3 else bad()) for k in range(900)]
    labels = frame(spark, [(k, int(k % 3 > 0)) for k in range(900) if k % 5], "doc_id long, quality int")
    got = quality_classifier.classify(frame(spark, rows), labels).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 > 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    flipped = frame(spark, [(r["doc_id"], r["quality"] if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 else 1 - r["quality"]) for r in labels.collect()], "doc_id long, quality int")
    again = {r["doc_id"]: r["score"] for r in quality_classifier.classify(frame(spark, rows), flipped).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"]) for r in got)


def test_op7_isotonic():
    x, y = quality_classifier.isotonic(np.array([0.0, 1, 2, 3]), np.array([1.0, 1, 1, 1]), np.array([0.0, 1, 0, 1]))
    assert list(x) == [0, 1.5, 3] and list(y) == [0, 0.5, 1]


def test_op8_forms(spark):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 500)
    changed = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + mit.upper().replace("NONINFRINGEMENT", "non-infringement").replace("SUBLICENSE", "sublicence").replace(" ", "  \n")
    rows = [(0, mit), (1, changed), (2, mit + " More."), (3, "text\n// Licensed under the Apache Licence, Version 2.0\nmore"), (4, "released under the mit license!!\nLicensed under CC BY-NC 4.0."), (5, None), (6, "Copyright 2020 X")]
    got = {r["doc_id"]: (r["license"], r["n_notices"], r["notices"]) for r in licenses.scan(frame(spark, rows)).collect()}
    assert got == {0: ("MIT", 1, "MIT"), 1: ("MIT", 0, ""), 2: (None, 0, ""), 3: (None, 1, "Apache-2.0"), 4: (None, 2, "CC-BY-NC-4.0,MIT"), 5: (None, 0, ""), 6: (None, 0, "")}


def test_op8_whole_licences(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    expected = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    there = [n for n in expected if (folder / n).exists()]
    if not there:
        pytest.skip("no licence texts on this machine")
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 500)
    rows = [(k, (folder / n).read_text()) for k, n in enumerate(there)]
    rows += [(100 + k, "Copyright (C) 2021 A. Nother\n\n" + t.upper().replace(" ", "\t ")) for k, t in rows] + [(200 + k, t + " and more") for k, t in rows]
    rows += [(300, "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + mit), (301, "MIT Licence\n" + mit)]
    got = {r["doc_id"]: r["license"] for r in licenses.scan(frame(spark, rows)).collect()}
    assert got == {k: expected[n] for k, n in enumerate(there)} | {100 + k: expected[n] for k, n in enumerate(there)} | {200 + k: None for k in range(len(there))} | {300: "MIT", 301: "MIT"}
    assert "BroadcastHashJoin" in licenses.scan(frame(spark, rows))._jdf.queryExecution().toString()


def test_op9_removes_passages(spark):
    rng = random.Random(10)
    text = lambda n: ". ".join(sentence(rng, rng.randint(4, 20), 3000).capitalize() for _ in range(n)) + "."
    docs = {k: text(12) for k in range(30)}
    passage = text(6)
    for k in range(3, 12):
        ws = docs[k].split(" ")
        at = rng.randrange(len(ws))
        docs[k] = " ".join([*ws[:at], passage, *ws[at:]])
    long = sentence(rng, 60, 3000)
    close = long.split(" ")
    close[0], close[-1] = "other", "end"
    docs[20] += "\n" + long + "\n" + text(2)
    docs[21] += "\n" + " ".join(close) + "\n" + text(2)
    docs[25] = docs[24]
    docs[26] += " See you soon."
    docs[27] += " See you soon."
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(frame(spark, list(docs.items())), keep_text=True).collect()}
    assert {k for k, r in got.items() if r["n_removed"]} == {*range(4, 12), 21, 25}
    inner = ". ".join(passage.split(". ")[1:-1])
    assert inner in got[3]["text"] and not any(inner in got[k]["text"] for k in range(4, 12))
    assert got[25]["words_removed"] >= 0.8 * len(words(docs[25])) and " ".join(close) not in got[21]["text"]
    assert all(got[k]["text"] == docs[k] for k in docs if not got[k]["n_removed"])


def test_op9_pairs_of_any_length(spark):
    """All pairs of lines from 5 to 60 words with ends or inner words changed, appended or dropped, against plain Jaccard."""
    rng = random.Random(21)
    sets = lambda ws: {tuple(ws[j : j + 5]) for j in range(len(ws) - 4)}
    filler = lambda: sentence(rng, 40, 90_000)
    docs, pairs, k = {}, [], 0
    for n in range(5, 61):
        for change in ("last", "first", "append", "prepend", "drop", "inner"):
            one = sentence(rng, n, 90_000).split(" ")
            other = list(one)
            if change in ("append", "prepend"):
                other.insert(len(other) if change == "append" else 0, "more")
            elif change == "drop":
                other.pop()
            else:
                other[{"last": -1, "first": 0, "inner": len(one) // 2}[change]] = "changed"
            docs[k], docs[k + 1] = (filler() + "\n" + " ".join(x) + "\n" + filler() for x in (one, other))
            a, b = sets(one), sets(other)
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                pairs.append((k, len(other)))
            k += 2
    assert {n for _, n in pairs} >= {9, 14, 15, 25} and len(pairs) > 200
    got = {r["doc_id"]: r["words_removed"] for r in substring_dedup.deduplicate(frame(spark, list(docs.items())), run=1).collect()}
    found = sum(got[k + 1] == n for k, n in pairs)
    assert found >= 0.99 * len(pairs) and not any(got[k] for k in range(0, len(docs), 2))
    small = [(k, n) for k, n in pairs if n <= 14]
    assert len(small) > 15 and all(got[k + 1] == n for k, n in small)
    whole = {k for k in range(1, len(docs), 2) if len(words(docs[k].split("\n")[1])) <= substring_dedup.WHOLE}  # longer ones have equal pieces
    others = whole - {k + 1 for k, _ in pairs}
    assert len(others) > 50 and not any(got[k] for k in others)


def test_op9_sketches_miss_no_small_pair():
    from fractions import Fraction

    rng = random.Random(4)
    share, tuned, met = Fraction(4, 5), substring_dedup.tuned(), 0
    for turn in range(9000):
        one = [rng.choice("abcdefghijklmnopqrstuvwxyz"[: rng.choice([2, 3, 8, 26])]) + str(rng.choice([0, 0, turn])) for _ in range(rng.randint(5, 18))]
        other = list(one)
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.choice([0, len(other) - 1, rng.randrange(len(other))])
            other[at : at + rng.choice([0, 1, 1, 2])] = rng.choice([[], ["x"], [rng.choice(one)], ["x", "y"]])
        if rng.random() < 0.2:
            cut = rng.randrange(len(other) + 1)
            other = other[cut:] + other[:cut]
        a, b = ({tuple(x[j : j + 5]) for j in range(len(x) - 4)} for x in (one, other))
        if one == other or not b or 5 * len(a & b) < 4 * len(a | b) or min(len(a), len(b)) > substring_dedup.SMALL:
            continue  # the same words are one class
        p = substring_dedup.Paragraphs(*utf8(pa.array([" ".join(one), " ".join(other)])))
        which = p.taking_part
        bounds, found = p.shingles(which)
        own, hashes = substring_dedup.sketches(p, which, bounds, found, share, *tuned)
        assert set(hashes[own == 0]) & set(hashes[own == 1]), (one, other)
        met += 1
    assert met > 500


def test_op9_removes_passages_inside_sentences(spark):
    rng = random.Random(12)
    docs = {k: sentence(rng, 40, 5000) + ". " + sentence(rng, 25, 5000) + "." for k in range(12)}
    passage = sentence(rng, 60, 5000)
    for k in (2, 5, 7):
        ws = docs[k].split(" ")
        at = rng.randrange(5, 35)
        docs[k] = " ".join([*ws[:at], passage, *ws[at:]])
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(frame(spark, list(docs.items())), keep_text=True).collect()}
    assert {k for k, r in got.items() if r["n_removed"]} == {5, 7}
    assert all(got[k]["words_removed"] >= 25 and got[k]["kept_sha256"] == hashlib.sha256(got[k]["text"].encode()).hexdigest() for k in (5, 7))


def test_op9_near_copies_with_inner_edits(spark):
    rng = random.Random(13)
    sets = lambda t: {tuple(w[j : j + 5]) for w in [words(t)] for j in range(len(w) - 4)}
    docs, pairs = {}, []
    for k in range(60):
        if k % 3 == 0:
            one = sentence(rng, rng.randrange(80, 140), 9000)
        elif k % 3 == 1:
            one = " ".join(sentence(rng, 20, 9000) + "." for _ in range(6))
        else:
            one = sentence(rng, rng.randrange(40, 60), 9000) + "."
        ws = one.split(" ")
        for _ in range(rng.choice([1, 1, 2])):
            ws[rng.randrange(3, len(ws) - 3)] = "edited."[: 6 + (k % 3 == 1)]
        docs[2 * k], docs[2 * k + 1] = (sentence(rng, 10, 9000) + "\n" + t + "\n" + sentence(rng, 10, 9000) for t in (one, " ".join(ws)))
        if len(sets(one) & sets(" ".join(ws))) >= 0.8 * len(sets(one) | sets(" ".join(ws))):
            pairs.append((2 * k, " ".join(ws)))
    docs[500] = sentence(rng, 40, 9000) + ". And so.\n" + sentence(rng, 10, 9000)  # a line like its sentence is no copy of it
    assert len(pairs) > 40
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(frame(spark, list(docs.items())), keep_text=True).collect()}
    for k, copy in pairs:
        assert got[k]["n_removed"] == 0 and got[k + 1]["words_removed"] == len(words(copy)), k
    assert got[500]["n_removed"] == 0


def test_op9_exact_repeats_go_whole(spark):
    rng = random.Random(14)
    docs = {k: [sentence(rng, 1, 9000) + rng.choice(["", "", "", ".", "\n"]) for _ in range(rng.randrange(150, 400))] for k in range(40)}
    for k in range(0, 40, 2):
        passage = [sentence(rng, 1, 9000) + ("\n" if k % 3 == 0 and j % 3 == 0 else "") for j in range(rng.randrange(51, 120))]
        for d in (k, k + 1, (k + 7) % 40):
            docs[d].insert(rng.randrange(len(docs[d])), " ".join(passage))
    docs[40] = [*docs[40 - 1][:60], *["one", "two", "three"] * 60]
    docs = {k: " ".join(w) for k, w in docs.items()}
    first, expected = {}, {}
    for k in sorted(docs):
        ws = words(docs[k])
        gone = np.zeros(len(ws), bool)
        for j in range(len(ws) - 49):
            d, q = first.setdefault(tuple(ws[j : j + 50]), (k, j))
            if (d, q) != (k, j):
                gone[max(j, q + 50) if d == k else j : j + 50] = True
        expected[k] = [w for w, x in zip(ws, gone, strict=True) if not x]
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(frame(spark, list(docs.items())), keep_text=True).collect()}
    for k, left in expected.items():
        r = got[k]
        rest = iter(left)  # a sentence that is nearly all passage may go as a near copy
        assert all(w in rest for w in words(r["text"])) and r["words_removed"] == len(words(docs[k])) - len(words(r["text"])), k
        assert r["n_bytes"] - r["n_removed"] == len(r["text"].encode()) and (r["n_spans"] > 0) == (r["n_removed"] > 0)
    assert sum(words(got[k]["text"]) == left for k, left in expected.items()) >= 20 and sum(r["n_spans"] for r in got.values()) > 35


def test_op9_bands_reach_their_recall():
    bands, rows = substring_dedup.tuned()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995
    rng = np.random.default_rng(1)
    hits = 0
    for _ in range(300):
        sets = [np.sort(rng.integers(0, 1 << 62, 45).astype(np.uint64))]
        other = sets[0].copy()
        other[:5] = rng.integers(0, 1 << 62, 5).astype(np.uint64)  # 40 of 50 in common
        a, b = (substring_dedup.signatures(np.array([0, 45]), np.sort(x), bands, rows)[0] for x in (sets[0], other))
        hits += bool((a == b).any())
    assert hits / 300 >= 0.98


@pytest.mark.parametrize("limit", [10_000, 8])
def test_op10_components(spark, monkeypatch, limit):
    rng = random.Random(3)
    vocabulary_ = [f"w{k}" for k in range(300)]
    base = [rng.choice(vocabulary_) for _ in range(120)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary_)
        rows.append((k * 3, " ".join(w[: rng.randrange(100, 120)] if rng.random() < 0.3 else w)))
    rows += [(1000 + k, " ".join(rng.choice(vocabulary_) for _ in range(rng.randrange(0, 60)))) for k in range(30)]
    rows += [(2000, None), (2001, ""), (2002, "a"), (2003, "A"), (2004, "a b"), (2005, "a  B"), (2009, rows[5][1])]
    sets = {}
    for k, text in rows:
        w = words((text or "").lower())
        sets[k] = frozenset(tuple(w[j : j + 3]) for j in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)]) if w else frozenset()
    of = {k: k for k in sets}
    pairs = set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                pairs.add((a, b))
                x, y = of[a], of[b]
                of = {k: min(x, y) if v in (x, y) else v for k, v in of.items()}
    monkeypatch.setitem(links.linked.__kwdefaults__, "limit", limit)
    monkeypatch.setattr(links, "BLOCK", 32)
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    links_of = collections.Counter(k for pair in pairs for k in pair)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"], r["n_links"]) for r in got} == {k: (of[k], len(sets[k]), links_of[k]) for k in sets}
    if limit > 100:
        first = {}
        for k in sorted(sets):
            first.setdefault(sets[k], k)
        found = {(r["a"], r["b"]) for r in jaccard_join.Join(frame(spark, rows)).all_links().collect()}
        assert found == {(a, b) for a, b in pairs if first[sets[a]] == a and first[sets[b]] == b}


def test_pipeline_decisions_take_effect(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    good = {r["doc_id"] for r in quality_classifier.classify(docs, spark.read.parquet(f"{data}/labels.parquet")).where("predicted = 1").collect()}
    one = pipeline.quality(spark, docs, data)
    assert {r["doc_id"] for r in one.collect()} == good
    sets = {}
    for r in one.collect():
        ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(ws[j : j + 5]) for j in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())
    of = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and of[a] != of[b]:
                low, high = sorted((of[a], of[b]))
                of = {k: low if v == high else v for k, v in of.items()}
    two = pipeline.distinct(spark, one, data)
    assert sorted(r["doc_id"] for r in two.collect()) == sorted(set(of.values()))
    left = {r["doc_id"]: r["text"] for r in substring_dedup.deduplicate(two, keep_text=True).collect()}
    three = pipeline.passages(spark, two, data)
    assert {r["doc_id"]: r["text"] for r in three.collect()} == {k: t for k, t in left.items() if words(t)}
    assert all(r["n_chars"] == len(r["text"]) for r in three.collect())
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(*mixing.mix(three)).collect()}
    four = pipeline.mixed(spark, three, data).collect()
    size = collections.Counter()
    for r in four:
        size[r["doc_id"]] += len(words(r["text"]))
    assert dict(size) == {k: n for k, n in taken.items() if n}
    rows = pipeline.run(spark, data).collect()
    assert len(rows) == len(four) and all(r["n_tokens"] == len(r["token_ids"]) for r in rows)


def test_word_hashes_are_those_of_lower_case_words(monkeypatch):
    from quire.llm import common

    rng = random.Random(4)
    texts = ["".join(rng.choice("aB. \n\té") for _ in range(rng.choice([0, 1, 40, 900]))) for _ in range(60)] + ["Z" * 5000, "", " "]
    data, at = utf8(pa.array(texts))
    starts, ends, doc = spans_of_words(data, at)
    want = common.hashed(common.word_array(common.lower_ascii(data), starts, ends))
    assert (doc == np.searchsorted(at, starts, "right") - 1).all()
    for piece in (1, 64, 1 << 17):
        monkeypatch.setattr(common, "PIECE", piece)
        assert (common.word_hashes(data, starts, ends) == want).all()
