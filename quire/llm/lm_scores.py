"""Language-model scores of whole documents from a causal self-attention model over subword ids.

Words of the training documents are counted over the whole corpus, through a table of distinct words as in bpe: each chunk
asks for its words once, buckets add up the counts and encode each distinct word once, and answers go back to the chunks.
A token is spelt by all of its subword ids, and the model reads their mean embedding; nothing is folded. A word's class is
that of its first subword id: frequent ones are classes of their own, the others share classes.

    P(token | before) = P(class | subword ids of the tokens before) * P(token | class)

The first factor is a causal self-attention model in numpy, the second comes from the corpus counts with half added, and
one place for unknown words in each class; so a word's later subwords are scored with it by its count, as a product of
counts of longer and longer beginnings would do. Training goes over every window of every training document: each task
takes its own steps from common weights, and rounds end with the mean of the tasks' weights; of the embeddings only rows
that a task has changed move. Both the counts and the steps grow with the input; the weights have a fixed size. In
scoring, windows overlap by half: the first half is context, and each token is scored once, in the second half, by batched
masked attention.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe import ASKED, body, chunk_words, chunks, dealt, encoded, gather, packed, tokenizer, unpacked
from quire.llm.common import batch_of, crc_of, lower_ascii, mixed, partitions, settle, small_batches, utf8, vocabulary

#: Subword ids (the vocabulary's are less), classes, width of the model, tokens of a half window.
SYMBOLS, CLASSES, WIDTH, HALF = 50_000, 128, 16, 16
#: Rounds, windows in a step, step size, seed.
ROUNDS, BATCH, RATE, SEED = 2, 128, 0.01, 11
#: The end of a text, what stands before it, what fills a window, and a word that the vocabulary has no id for.
END, START, PAD, NONE = SYMBOLS, SYMBOLS + 1, SYMBOLS + 2, SYMBOLS + 3
#: Rows that carry one task's weights, and groups of tasks that are summed before all are.
SLICES, GROUPS = 8, 64


# --- counts ---------------------------------------------------------------------------------------------------------


def _chunked(docs: DataFrame) -> DataFrame:
    """(chunk, body, ends): the rows of each chunk, packed, and how many of its texts train; written once, so that chunks
    are the same however often they are read."""

    def pack(batches):
        for number, rows in chunks(batches, "__text"):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows)
            yield batch_of("chunk long, body binary, ends long", chunk=[number], body=[packed(sink.getvalue().to_pybytes())], ends=[int((crc_of(rows.column("__id")) % 5 != 1).sum())])

    return settle(docs.mapInArrow(pack, "chunk long, body binary, ends long"))


def _asked(chunked: DataFrame, buckets: int) -> DataFrame:
    ddl = ASKED + ", counts binary"

    def ask(batches):
        for batch in batches:
            for number, packed_rows in zip(batch.column("chunk").to_pylist(), batch.column("body").to_pylist(), strict=True):
                rows = body(packed_rows)
                codes, entries, n_words = chunk_words(rows.column("__text"), lower_ascii)
                train = crc_of(rows.column("__id")) % 5 != 1
                counts = np.bincount(codes[np.repeat(train, n_words)], minlength=len(entries))
                listed = entries.to_pylist()
                for b, which in enumerate(dealt(listed, buckets)):
                    if len(which):
                        yield batch_of(ddl, chunk=[number], bucket=[b], words=[packed(b"\n".join([listed[i] for i in which]))], counts=[packed(counts[which].astype("<u4").tobytes())])

    return chunked.mapInArrow(ask, ddl)


ANSWER = "chunk long, bucket int, check long, counts binary, lengths binary, symbols binary, symbol int, n long, v long"


def spelt(listed: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(how many subword ids each word has, all ids); a word without any has NONE."""
    lengths, ids = encoded(listed, path)
    if (none := lengths == 0).any():
        at = np.cumsum(lengths)[none]
        return np.maximum(lengths, 1), np.insert(ids, at, NONE)
    return lengths, ids


def _answered(wanted: DataFrame, path: str) -> DataFrame:
    """For each chunk's words their counts and subword ids; and for each first id (chunk null) its tokens and known words."""

    def answer(rows: pa.Table) -> pa.Table:
        lists = [unpacked(x).split(b"\n") for x in rows.column("words").to_pylist()]
        place = {w: k for k, w in enumerate(dict.fromkeys(w for ws in lists for w in ws))}
        own = [np.fromiter((place[w] for w in ws), np.int64, len(ws)) for ws in lists]
        total = np.zeros(len(place), np.int64)
        for which, counts in zip(own, rows.column("counts").to_pylist(), strict=True):
            total[which] += np.frombuffer(unpacked(counts), "<u4")
        lengths, ids = spelt(list(place), path)
        edges = np.concatenate(([0], np.cumsum(lengths)))
        first = ids[edges[:-1]].astype(np.int64)
        n, v = np.bincount(first, weights=total, minlength=NONE + 1).astype(np.int64), np.bincount(first[total > 0], minlength=NONE + 1)
        full = np.flatnonzero(v)
        lead, none = len(lists), pa.nulls
        as_bytes = lambda x, kind: packed(x.astype(kind).tobytes())
        return pa.Table.from_batches(
            [
                batch_of(ANSWER, chunk=rows.column("chunk").to_pylist(), bucket=rows.column("bucket").to_pylist(), check=[zlib.crc32(b"\n".join(ws)) for ws in lists], counts=[as_bytes(total[w], "<u8") for w in own], lengths=[as_bytes(lengths[w], "<u4") for w in own], symbols=[as_bytes(gather(ids, edges, w), "<u2") for w in own], symbol=none(lead), n=none(lead), v=none(lead)),
                batch_of(ANSWER, chunk=none(len(full)), bucket=none(len(full)), check=none(len(full)), counts=none(len(full)), lengths=none(len(full)), symbols=none(len(full)), symbol=full, n=n[full], v=v[full]),
            ]
        )

    return wanted.groupBy("bucket").applyInArrow(answer, ANSWER)


@dataclass
class Counts:
    """What is known of the training tokens as a whole: of a fixed size."""

    ends: int
    n: np.ndarray
    v: np.ndarray

    @property
    def tokens(self) -> int:
        return int(self.n.sum()) + self.ends

    @property
    def types(self) -> int:
        return int(self.v.sum()) + (self.ends > 0)

    def classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class of each first id and of END, tokens, known words of each class)."""
        order = np.argsort(-self.n, kind="stable")
        alone = CLASSES * 3 // 4
        order = order[order != END]
        of = np.zeros(len(self.n), np.int64)
        of[order[: alone - 1]] = np.arange(1, alone)
        of[order[alone - 1 :]] = alone + np.arange(len(order) - alone + 1) % (CLASSES - alone)
        n, v = self.n.copy(), self.v.copy()
        n[END], v[END] = self.ends, int(self.ends > 0)
        return of, np.bincount(of, weights=n, minlength=CLASSES), np.bincount(of, weights=v, minlength=CLASSES)


def sequences(docs: DataFrame, path: str) -> tuple[DataFrame, Counts]:
    """(id, held_out, n_tokens, n_known, base, within, symbols, lengths) of every text, written to the shared folder; the
    counts. symbols: the subword ids of all tokens; lengths: how many each token has."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    chunked = _chunked(docs)
    replies = settle(_answered(_asked(chunked, buckets), path))
    by_symbol = replies.where("chunk is null").groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    counts = Counts(chunked.agg(F.sum("ends")).first()[0] or 0, np.zeros(NONE + 1, np.int64), np.zeros(NONE + 1, np.int64))
    for r in by_symbol:
        counts.n[r["symbol"]], counts.v[r["symbol"]] = r["n"], r["v"]
    of, class_n, class_v = counts.classes()
    below = np.log10(counts.tokens + 0.5 * (counts.types + 1))
    class_below = np.log10(class_n + 0.5 * (class_v + 1))
    ends = counts.ends
    ddl = f"__id {docs.schema['__id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, within double, symbols binary, lengths binary"

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for packed_rows in left.column("body").to_pylist():
            rows = body(packed_rows)
            codes, entries, n_words = chunk_words(rows.column("__text"), lower_ascii)
            listed = entries.to_pylist()
            by = {b: k for k, b in enumerate(right.column("bucket").to_pylist())}
            c, lengths, parts, order = np.zeros(len(listed), np.int64), np.zeros(len(listed), np.int64), [], []
            for b, which in enumerate(dealt(listed, buckets)):
                if len(which):
                    k = by.get(b)
                    if k is None or right.column("check")[k].as_py() != zlib.crc32(b"\n".join([listed[i] for i in which])):
                        raise RuntimeError("a chunk and the answers to it do not belong together")
                    c[which] = np.frombuffer(unpacked(right.column("counts")[k].as_py()), "<u8")
                    lengths[which] = np.frombuffer(unpacked(right.column("lengths")[k].as_py()), "<u4")
                    parts.append(np.frombuffer(unpacked(right.column("symbols")[k].as_py()), "<u2"))
                    order.append(which)
            order = np.concatenate(order) if order else np.zeros(0, np.int64)
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            edges = np.concatenate(([0], np.cumsum(lengths[order])))
            ids = np.concatenate(parts) if parts else np.zeros(0, "<u2")
            first = ids[edges[back]].astype(np.int64) if len(order) else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(n_words)), n_words)
            n = len(n_words)
            per = lambda x: np.bincount(doc, weights=x, minlength=n)  # noqa: E731, B023
            log_c = np.log10(c + 0.5)
            base = per(log_c[codes] - below) + np.log10(ends + 0.5) - below
            within = per((log_c - class_below[of[first]])[codes]) + np.log10(ends + 0.5) - class_below[0]
            known = per((c > 0)[codes]).astype(np.int64) + (ends > 0)
            word_edges = np.concatenate(([0], np.cumsum(n_words))).tolist()
            symbols, sizes = [], []
            begin = 0
            while begin < n:  # some MB at a time
                end = max(begin + 1, int(np.searchsorted(word_edges, word_edges[begin] + 200_000, "right")) - 1)
                own = codes[word_edges[begin] : word_edges[end]]
                spelled, size = gather(ids, edges, back[own]), lengths[own]
                at = np.concatenate(([0], np.cumsum(size)))
                for a, b in zip(word_edges[begin:end], word_edges[begin + 1 : end + 1], strict=True):
                    a, b = a - word_edges[begin], b - word_edges[begin]
                    symbols.append(spelled[at[a] : at[b]].tobytes() + END.to_bytes(2, "little"))
                    sizes.append(size[a:b].astype("<u4").tobytes() + (1).to_bytes(4, "little"))
                begin = end
            ids_ = rows.column("__id")
            out.append(batch_of(ddl, __id=ids_.combine_chunks() if isinstance(ids_, pa.ChunkedArray) else ids_, held_out=crc_of(ids_) % 5 == 1, n_tokens=n_words + 1, n_known=known, base=base, within=within, symbols=symbols, lengths=sizes))
        none: dict = {f: [] for f in ("__id", "held_out", "n_tokens", "n_known", "base", "within", "symbols", "lengths")}
        return pa.Table.from_batches(out) if out else pa.Table.from_batches([batch_of(ddl, **none)])

    kept = replies.where("chunk is not null").select("chunk", "bucket", "check", "counts", "lengths", "symbols")
    return settle(chunked.select("chunk", "body").groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(join, ddl)), counts


# --- the model ------------------------------------------------------------------------------------------------------


def fresh(class_n: np.ndarray) -> list[np.ndarray]:
    """Embedding, query, key, value, distance bias, output and output bias (the classes' log shares) before training."""
    rng = np.random.default_rng(SEED)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3 / np.sqrt(WIDTH)).astype(np.float32)
    bias = np.log((class_n + 0.5) / (class_n + 0.5).sum()).astype(np.float32)
    return [draw(NONE + 1, WIDTH) * 2, draw(WIDTH, WIDTH), draw(WIDTH, WIDTH), draw(WIDTH, WIDTH) * 3, np.zeros(2 * HALF, np.float32), draw(WIDTH, CLASSES), bias]


_DISTANCE = np.arange(HALF)[:, None] + HALF - np.arange(2 * HALF)[None, :]  # of each key from each query


class Tokens:
    """The tokens of a batch's texts: subword ids, and where each token's begin and each text's tokens do."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, at: np.ndarray):
        # Two tokens follow all texts': what stands before a text, and what fills a window.
        self.ids, self.edges = np.append(ids, [START, PAD]), np.concatenate(([0], np.cumsum(lengths), [len(ids) + 1, len(ids) + 2]))
        self.at, self.n = at, len(lengths)
        self.first = self.ids[self.edges[:-1]]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(inputs, targets, documents), as numbers of tokens: for each half window of targets the tokens before and in it;
        -1 where there is no target."""
        n = np.diff(self.at)
        per = -(-n // HALF)
        doc = np.repeat(np.arange(len(n)), per)
        block = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        place, begin = block[:, None] * HALF + np.arange(HALF), self.at[:-1][doc][:, None]
        targets = np.where(place < n[doc][:, None], begin + place, -1)
        place = block[:, None] * HALF - HALF + np.arange(2 * HALF) - 1  # an input is the token before
        inputs = np.where(place < -1, self.n + 1, np.where(place == -1, self.n, np.minimum(begin + place, max(0, self.n - 1))))
        return inputs, targets, doc

    def classes(self, targets: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.where(targets < 0, -1, of[self.first[targets]])


class Spelling:
    """The tokens of some windows, each a row of its own, and the subword ids that they have."""

    def __init__(self, tokens: Tokens, inputs: np.ndarray):
        flat = inputs.ravel()
        self.lengths = tokens.edges[flat + 1] - tokens.edges[flat]
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.ids = gather(tokens.ids, tokens.edges, flat)
        self.pad = tokens.first[inputs] == PAD

    def embedded(self, e: np.ndarray) -> np.ndarray:
        """The mean embedding of each token's ids."""
        mean = e[self.ids[self.begins]]
        some = np.flatnonzero(self.lengths > 1)
        if len(some):
            edges = np.concatenate(([0], np.cumsum(self.lengths[some])))
            own = gather(self.ids, np.append(self.begins, len(self.ids)), some)
            mean[some] = np.add.reduceat(e[own], edges[:-1], axis=0) / self.lengths[some, None].astype(e.dtype)
        return mean.reshape(*self.pad.shape, e.shape[1])

    def back(self, dx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, gradients) of the embeddings that these tokens have."""
        each = np.repeat(dx.reshape(-1, dx.shape[-1]) / self.lengths[:, None].astype(dx.dtype), self.lengths, axis=0)
        order = np.argsort(self.ids.astype(np.uint16), kind="stable")  # ids are below 2^16, which sort by radix
        found = self.ids[order]
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        return found[first], np.add.reduceat(each[order], first, axis=0)


class Read:
    """Tokens of some windows whose embeddings are known."""

    def __init__(self, tokens: Tokens, inputs: np.ndarray, known: np.ndarray):
        self.inputs, self.known, self.pad = inputs, known, tokens.first[inputs] == PAD

    def embedded(self, _) -> np.ndarray:
        return self.known[self.inputs]


def forward(w: list[np.ndarray], inputs: Spelling | Read) -> tuple:
    """The attention of each query to the inputs up to its own; padding is masked."""
    e, q, k, v, distance, _, _ = w
    x = inputs.embedded(e)
    flat = x.reshape(-1, WIDTH)  # products of all rows at once, not window by window
    queries = (np.ascontiguousarray(x[:, HALF:]).reshape(-1, WIDTH) @ q).reshape(-1, HALF, WIDTH)
    scores = queries @ (flat @ k).reshape(x.shape).transpose(0, 2, 1)
    scores *= np.float32(WIDTH**-0.5)
    scores += np.where(_DISTANCE < 0, np.float32(-1e9), distance[np.clip(_DISTANCE, 0, 2 * HALF - 1)])
    padded = np.flatnonzero(inputs.pad.any(axis=1))
    scores[padded] += np.where(inputs.pad[padded], np.float32(-1e9), np.float32(0))[:, None, :]
    scores -= scores.max(axis=2, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    values = (flat @ v).reshape(x.shape)
    return x, queries, scores, values, x[:, HALF:] + scores @ values


def log_probs(w: list[np.ndarray], inputs: Spelling | Read, classes: np.ndarray) -> np.ndarray:
    """The natural log probability of each target's class; 0 where there is no target (-1)."""
    h = forward(w, inputs)[4].reshape(-1, WIDTH)
    logits = h @ w[5] + w[6]
    logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(h)), np.maximum(classes.ravel(), 0)]
    return np.where(classes.ravel() < 0, 0, own - np.log(np.exp(logits, out=logits).sum(axis=1))).reshape(classes.shape)


def gradients(w: list[np.ndarray], inputs: Spelling, classes: np.ndarray) -> list:
    """Of the mean negative log probability of the targets' classes; of the embeddings as (ids, rows)."""
    x, queries, attention, values, h = forward(w, inputs)
    flat, real = h.reshape(-1, WIDTH), classes.ravel() >= 0
    logits = flat @ w[5] + w[6]
    logits -= logits.max(axis=1, keepdims=True)
    g = np.exp(logits, out=logits)
    share = real.astype(np.float32) / np.float32(max(1, int(real.sum())))
    g *= (share / g.sum(axis=1))[:, None]
    g[np.arange(len(g)), np.maximum(classes.ravel(), 0)] -= share
    d_out, d_bias = flat.T @ g, g.sum(axis=0)
    dh = (g @ w[5].T).reshape(h.shape)
    d_att, d_val = dh @ values.transpose(0, 2, 1), attention.transpose(0, 2, 1) @ dh
    ds = attention * (d_att - (d_att * attention).sum(axis=2, keepdims=True))
    d_distance = np.bincount(np.clip(_DISTANCE, 0, 2 * HALF - 1).ravel(), weights=ds.sum(axis=0).ravel(), minlength=2 * HALF).astype(np.float32)
    ds *= np.float32(WIDTH**-0.5)
    two = lambda y: y.reshape(-1, WIDTH)
    keys = (two(x) @ w[2]).reshape(x.shape)
    dq, dk = ds @ keys, ds.transpose(0, 2, 1) @ queries
    dx = (two(dk) @ w[2].T + two(d_val) @ w[3].T).reshape(x.shape)
    dx[:, HALF:] += (two(dq) @ w[1].T).reshape(dh.shape) + dh
    return [inputs.back(dx), two(x[:, HALF:]).T @ two(dq), two(x).T @ two(dk), two(x).T @ two(d_val), d_distance, d_out, d_bias]


class Adam:
    """Adam's steps; rows of the embeddings move when a step has them, by their own number of steps."""

    def __init__(self, w: list[np.ndarray]):
        self.w, self.m, self.s, self.t = [x.copy() for x in w], [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
        self.times = np.zeros(len(w[0]), np.int64)

    def step(self, grads: list, rate: float) -> None:
        self.t += 1
        ids, rows = grads[0]
        self.times[ids] += 1
        m, s = self.m[0][ids], self.s[0][ids]
        m += np.float32(0.1) * (rows - m)
        s += np.float32(0.01) * (rows * rows - s)
        t = self.times[ids][:, None]
        self.m[0][ids], self.s[0][ids] = m, s
        m *= (rate / (1 - 0.9**t)).astype(m.dtype)
        s *= (1 / (1 - 0.99**t)).astype(s.dtype)
        np.sqrt(s, out=s)
        s += np.float32(1e-6)
        m /= s
        self.w[0][ids] -= m
        for x, m, s, g in zip(self.w[1:], self.m[1:], self.s[1:], grads[1:], strict=True):
            m += np.float32(0.1) * (g - m)
            s += np.float32(0.01) * (g * g - s)
            x -= np.float32(rate) * (m / np.float32(1 - 0.9**self.t)) / (np.sqrt(s / np.float32(1 - 0.99**self.t)) + np.float32(1e-6))


def _tokens(batch: pa.RecordBatch) -> Tokens:
    data, _ = utf8(batch.column("symbols"))
    lengths, at = utf8(batch.column("lengths"))
    return Tokens(np.ascontiguousarray(data).view("<u2").astype(np.int64), np.ascontiguousarray(lengths).view("<u4").astype(np.int64), at // 4)


PART = "slice int, steps double, ids binary, part binary"


def _shares(adam: Adam) -> pa.RecordBatch:
    """A task's weights, times its steps: slice 0 has all but the embeddings, the others those of the ids that it changed."""
    flat = np.concatenate([x.ravel() for x in adam.w[1:]]).astype(np.float64) * adam.t
    out = [(0, float(adam.t), b"", flat.tobytes())]
    ids = np.flatnonzero(adam.times)
    for k in range(1, SLICES):
        own = ids[ids % (SLICES - 1) == k - 1]
        weighted = np.column_stack((adam.times[own], adam.w[0][own] * adam.times[own][:, None])).astype(np.float32)
        out.append((k, 0.0, own.astype("<i4").tobytes(), weighted.tobytes()))
    return batch_of(PART, slice=[r[0] for r in out], steps=[r[1] for r in out], ids=[r[2] for r in out], part=[r[3] for r in out])


def _added(table: pa.Table) -> pa.Table:
    """The sum of the rows of one slice, in an order that does not depend on how they came."""
    rows = sorted(table.select(["slice", "steps", "ids", "part"]).to_pylist(), key=lambda r: (r["part"], r["ids"]))
    number, steps = rows[0]["slice"], sum(r["steps"] for r in rows)
    if number == 0:
        return pa.Table.from_batches([batch_of(PART, slice=[0], steps=[steps], ids=[b""], part=[np.sum([np.frombuffer(r["part"]) for r in rows], axis=0).tobytes()])])
    total = np.zeros((NONE + 1, 1 + WIDTH), np.float64)
    for r in rows:
        total[np.frombuffer(r["ids"], "<i4")] += np.frombuffer(r["part"], np.float32).reshape(-1, 1 + WIDTH)
    ids = np.flatnonzero(total[:, 0])
    return pa.Table.from_batches([batch_of(PART, slice=[number], steps=[steps], ids=[ids.astype("<i4").tobytes()], part=[total[ids].astype(np.float32).tobytes()])])


def train(rows: DataFrame, of: np.ndarray, class_n: np.ndarray) -> list[np.ndarray]:
    """Rounds of local steps, each window in one of them, and the mean of the tasks' weights, by their steps; a row of the
    embeddings counts by the steps that had it. Sums go in two levels, so that no task gathers the weights of all."""
    w = fresh(class_n)
    shapes = [x.shape for x in w[1:]]

    def learn_with(weights: list[np.ndarray], number: int):
        def learn(batches):
            adam = Adam(weights)

            def steps_of(tokens: Tokens, inputs: np.ndarray, classes: np.ndarray):
                order = np.argsort(mixed(np.arange(len(inputs), dtype=np.uint64) + np.uint64(SEED)))
                for k in range(0, len(order), BATCH):
                    which = order[k : k + BATCH]
                    adam.step(gradients(adam.w, Spelling(tokens, inputs[which]), classes[which]), RATE / (1 + adam.t / 300) ** 0.5)

            for batch in batches:
                tokens = _tokens(batch)
                if not tokens.n:
                    continue
                inputs, targets, _ = tokens.windows()
                mark = mixed((tokens.first[inputs[:, HALF:]] * np.arange(1, HALF + 1)).sum(axis=1).astype(np.uint64))
                chosen = mark % np.uint64(ROUNDS) == number
                steps_of(tokens, inputs[chosen], tokens.classes(targets[chosen], of))
            if adam.t:
                yield _shares(adam)

        return learn

    for number in range(ROUNDS):
        parts = rows.where("not held_out").select("symbols", "lengths").mapInArrow(learn_with(w, number), PART)
        parts = parts.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
        got = parts.groupBy("slice", "some").applyInArrow(_added, PART).groupBy("slice").applyInArrow(_added, PART).collect()
        if not got:
            break
        w = [x.copy() for x in w]
        for r in got:
            if r["slice"] == 0:
                flat = np.frombuffer(bytes(r["part"])) / r["steps"]
                w[1:] = [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), shapes, strict=True)]
            else:
                ids, own = np.frombuffer(bytes(r["ids"]), "<i4"), np.frombuffer(bytes(r["part"]), np.float32).reshape(-1, 1 + WIDTH)
                w[0][ids] = own[:, 1:] / own[:, :1]
    return w


def score_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    A text's tokens are its words, A-Z in lower case, and one end; a null text has the end only. Rows whose crc32(id as
    text) mod 5 is 1 are held out, all others train (a null id counts as the empty string). Repeated rows count each time.
    Without any training row, only unknown places are left and scores come from them.
    """
    path = vocabulary_path or vocabulary("word_bpe_49k.json")
    if tokenizer(path).get_vocab_size() > SYMBOLS:
        raise ValueError(f"a vocabulary of more than {SYMBOLS} ids")
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    rows, counts = sequences(plain, path)
    of, class_n, _ = counts.classes()
    weights = train(rows, of, class_n)
    tokens = counts.tokens
    ddl = f"{id} {docs.schema[id].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            read = _tokens(batch)
            inputs, targets, doc = read.windows()
            classes = read.classes(targets, of)
            known = Spelling(read, np.arange(read.n + 2)[:, None]).embedded(weights[0])[:, 0]  # of each token once
            got = np.concatenate([log_probs(weights, Read(read, inputs[k : k + BATCH], known), classes[k : k + BATCH]).sum(axis=1, dtype=np.float64) for k in range(0, len(inputs), BATCH)])
            total = batch.column("within").to_numpy() + np.bincount(doc, weights=got, minlength=batch.num_rows) / np.log(10)
            yield batch_of(ddl, **{id: batch.column("__id"), "held_out": batch.column("held_out"), "n_tokens": batch.column("n_tokens"), "n_known": batch.column("n_known"), "train_tokens": [tokens] * batch.num_rows, "base_score": batch.column("base"), "score": total})

    return rows.mapInArrow(score, ddl)
