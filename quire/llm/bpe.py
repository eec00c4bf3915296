"""BPE encoding and decoding through a table of distinct words.

Texts are split into chunks of some MB. Each chunk's distinct words are dealt by a hash of the word into buckets; a
bucket holds every chunk's copy of its words, so each distinct word of the corpus is encoded once, in one place, and its
ids go back to each chunk that asked. There, ids are joined to words by position, and pieces to ids by number. What
moves is the distinct words of each chunk and their ids, never a row for each word of the text.

Exactness: the vocabulary's splitting never lets a piece cross ASCII white space, and its normaliser does not compose
across it, so the encoding of a text is the encodings of its words one after another. Special tokens written in a text
are found inside their word by the library itself.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_schema, batch_of, distinct_words, partitions, small_batches, steps, utf8, vocabulary, word_array, words

#: Bytes of text in a chunk, about; a chunk ends with the document that reaches it.
CHUNK_BYTES = 12 << 20

ASKED = "chunk long, bucket int, words binary"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def pieces(path: str) -> pa.Array:
    """The piece of each id with a space behind it, as bytes."""
    t = tokenizer(path)
    size = max(t.get_vocab(with_added_tokens=True).values()) + 1
    return pa.array([(x + " ").encode() if (x := t.id_to_token(i)) is not None else b"" for i in range(size)], pa.large_binary())


def packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of chunks; numbers are the same whenever a partition is read again."""
    task = TaskContext.get()
    number, held, size = (task.partitionId() if task else 0) << 24, [], 0
    for batch in steps(batches, text):
        held.append(batch)
        size += int(utf8(batch.column(text))[1][-1])
        if size >= limit:
            yield number, pa.Table.from_batches(held)
            number, held, size = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held)


def chunk_words(texts: pa.ChunkedArray | pa.Array, change=None) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(entry of each word, distinct words, number of words in each document) of a chunk."""
    data, at = utf8(texts)
    if change is not None:
        data = change(data)
    starts, ends, doc = words(data, at)
    codes, entries = distinct_words(word_array(data, starts, ends))
    return codes, entries, np.bincount(doc, minlength=len(at) - 1)


def dealt(entries: list[bytes], buckets: int) -> list[np.ndarray]:
    """The numbers of the entries in each bucket."""
    bucket = np.fromiter((zlib.crc32(w) for w in entries), np.int64, len(entries)) % buckets
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [order[edges[b] : edges[b + 1]] for b in range(buckets)]


def asked(docs: DataFrame, text: str, buckets: int, change=None) -> DataFrame:
    """(chunk, bucket, words): the distinct words of each chunk, packed by bucket."""

    def ask(batches):
        for number, rows in chunks(batches, text):
            _, entries, _ = chunk_words(rows.column(text), change)
            listed = entries.to_pylist()
            for b, which in enumerate(dealt(listed, buckets)):
                if len(which):
                    yield batch_of(ASKED, chunk=[number], bucket=[b], words=[packed(b"\n".join([listed[i] for i in which]))])

    return docs.select(text).mapInArrow(ask, ASKED)


def payload(docs: DataFrame, text: str) -> DataFrame:
    """(chunk, body): the chunk's rows, packed as an Arrow stream."""

    def pack(batches):
        for number, rows in chunks(batches, text):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows)
            yield batch_of("chunk long, body binary", chunk=[number], body=[packed(sink.getvalue().to_pybytes())])

    return docs.mapInArrow(pack, "chunk long, body binary")


def body(packed_rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(unpacked(packed_rows))).read_all()


def encoded(listed: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(how many ids each word has, all ids)."""
    t = tokenizer(path)
    counts, ids = np.zeros(len(listed), np.int64), []
    for begin in range(0, len(listed), 20_000):
        for k, e in enumerate(t.encode_batch_fast([w.decode() for w in listed[begin : begin + 20_000]], add_special_tokens=False), begin):
            own = e.ids
            counts[k] = len(own)
            ids.extend(own)
    return counts, np.array(ids, np.uint32)


def answered(wanted: DataFrame, path: str) -> DataFrame:
    """(chunk, bucket, check, counts, ids): for each chunk's words in their order; each distinct word is encoded once."""

    def answer(rows: pa.Table) -> pa.Table:
        lists = [unpacked(x).split(b"\n") for x in rows.column("words").to_pylist()]
        place = {w: k for k, w in enumerate(dict.fromkeys(w for ws in lists for w in ws))}
        counts, ids = encoded(list(place), path)
        edges = np.concatenate(([0], np.cumsum(counts)))
        out_counts, out_ids, check = [], [], []
        for ws in lists:
            own = np.fromiter((place[w] for w in ws), np.int64, len(ws))
            out_counts.append(packed(counts[own].astype("<u4").tobytes()))
            out_ids.append(packed(gather(ids, edges, own).astype("<u4").tobytes()))
            check.append(zlib.crc32(b"\n".join(ws)))
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket").cast(pa.int32()), "check": pa.array(check, pa.int64()), "counts": pa.array(out_counts, pa.binary()), "ids": pa.array(out_ids, pa.binary())})

    return wanted.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, check long, counts binary, ids binary")


def gather(values: np.ndarray, edges: np.ndarray, which: np.ndarray) -> np.ndarray:
    """values[edges[k]:edges[k + 1]] for each k of which, one after another."""
    lengths = edges[which + 1] - edges[which]
    total = int(lengths.sum())
    if not total:
        return values[:0]
    begins = np.repeat(edges[which] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return values[begins + np.arange(total)]


def looked_up(listed: list[bytes], replies: pa.Table, buckets: int, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(counts, ids) of a chunk's distinct words, from the replies of the buckets. A reply that is missing or belongs to
    other words (the chunk was cut otherwise when it was read again) is made anew here, so results never depend on it."""
    by = {b: k for k, b in enumerate(replies.column("bucket").to_pylist())}
    counts, parts, order = np.zeros(len(listed), np.int64), [], []
    for b, which in enumerate(dealt(listed, buckets)):
        if not len(which):
            continue
        own = [listed[i] for i in which]
        k = by.get(b)
        if k is not None and replies.column("check")[k].as_py() == zlib.crc32(b"\n".join(own)):
            n = np.frombuffer(unpacked(replies.column("counts")[k].as_py()), "<u4").astype(np.int64)
            ids = np.frombuffer(unpacked(replies.column("ids")[k].as_py()), "<u4")
        else:
            n, ids = encoded(own, path)
        counts[which] = n
        order.append(which)
        parts.append(ids)
    if not order:
        return counts, np.zeros(0, np.uint32)
    order = np.concatenate(order)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return counts, gather(np.concatenate(parts), np.concatenate(([0], np.cumsum(counts[order]))), back)


def from_edges(kind: pa.DataType, data: np.ndarray | pa.Buffer, edges: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(kind, len(edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(edges, dtype=np.int64)), pa.py_buffer(data) if isinstance(data, np.ndarray) else data])


def round_trip(docs: DataFrame, id: str = "doc_id", text: str = "text", *, keep: tuple[str, ...] = (), tokens: bool = False, decoded: bool = False, vocabulary_path: str | None = None) -> DataFrame:
    """Encode every whole text and decode its ids: one row for each row of docs.

    Returns id, the columns named in keep, n_tokens, ids_sha256, decoded_sha256, and at wish token_ids and decoded.
    A null or blank text has no ids and decodes to the empty string. Ids may be null or repeat; each row is on its own.
    docs must give the same rows in the same order when read again (a table does; see looked_up for what else happens).
    """
    spark, path = docs.sparkSession, vocabulary_path or vocabulary("word_bpe_49k.json")
    small_batches(spark)
    buckets = partitions(spark)
    kept = list(dict.fromkeys([id, *keep]))
    plain = docs.select(*kept, F.col(text).alias("__text"))
    replies = answered(asked(plain, "__text", buckets), path)
    schema = plain.select(*kept).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * tokens + ", decoded string" * decoded

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for packed_rows in left.column("body").to_pylist():
            rows = body(packed_rows)
            codes, entries, n_words = chunk_words(rows.column("__text"))
            counts, ids = looked_up(entries.to_pylist(), right, buckets, path)
            edges = np.concatenate(([0], np.cumsum(counts)))
            as_bytes = from_edges(pa.large_binary(), ids.astype("<u4").view(np.uint8), edges * 4)
            spelt, spelt_at = utf8(pieces(path).take(pa.array(ids, pa.int64())))
            as_text = from_edges(pa.large_binary(), np.ascontiguousarray(spelt), spelt_at[edges])
            ends = np.concatenate(([0], np.cumsum(n_words)))
            made = {"n": [], "ids": [], "text": [], "tokens": [], "decoded": []}
            begin = 0
            while begin < len(n_words):  # some MB at a time
                end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + 200_000, "right")) - 1)
                own = pa.array(codes[ends[begin] : ends[end]])
                for what, column in (("ids", as_bytes), ("text", as_text)):
                    data, at = utf8(column.take(own))
                    cuts = at[ends[begin : end + 1] - ends[begin]]
                    view = memoryview(np.ascontiguousarray(data))
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        if what == "ids":
                            made["n"].append((b - a) // 4)
                            made["ids"].append(hashlib.sha256(view[a:b]).hexdigest())
                            if tokens:
                                made["tokens"].append(np.frombuffer(view[a:b], "<u4").astype(np.int32))
                        else:
                            made["text"].append(hashlib.sha256(view[a : max(a, b - 1)]).hexdigest())
                            if decoded:
                                made["decoded"].append(bytes(view[a : max(a, b - 1)]).decode())
                begin = end
            columns = {c: rows.column(c) for c in kept} | {"n_tokens": pa.array(made["n"], pa.int64()), "ids_sha256": pa.array(made["ids"], pa.string()), "decoded_sha256": pa.array(made["text"], pa.string())}
            if tokens:
                columns["token_ids"] = pa.array(made["tokens"], pa.list_(pa.int32()))
            if decoded:
                columns["decoded"] = pa.array(made["decoded"], pa.string())
            out.append(pa.table(columns))
        return pa.concat_tables(out) if out else empty

    empty = arrow_schema(fields).empty_table()
    return payload(plain, "__text").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(join, fields)
