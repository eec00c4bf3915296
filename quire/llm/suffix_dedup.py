"""Removal of byte strings that repeat anywhere, by suffix arrays over shards that are sorted externally.

A window is `length` bytes of a text. All windows are dealt so that equal ones meet: each belongs to the least of its
hashed grams (the leftmost of equal ones), and neighbouring windows with the same gram make one fragment of text. Equal
windows have equal grams, so only fragments of a gram that stands anywhere else can hold a repeat. Fragments of equal
bytes are one entry with a weight before anything else moves; entries whose gram occurs once are done. The others' bytes
are dealt by gram into shards, and each shard is sorted by external induction (suffix_sort): a window repeats if its
common prefix with a neighbour in suffix order reaches `length`, or if its entry weighs more than one. Verdicts go back to
all places of an entry and their union is cut out of the texts.

A gram's weight does not count in a shard, only its different surroundings do. A gram that stands in HOT entries or more is
dealt by those surroundings instead: the windows at NEAR distances from it share a core of their bytes, so its fragments
are cut at those distances and each cut goes where its core's hash says. Entries are told apart by gram hash, entry hash,
length and place of the gram, and texts by two hashes of 96 bits: two strings that agree in all of these count as equal.
Texts move packed. A shard holds some MB of text, by its numbers all at once; beyond HELD its texts, and beyond the memory
given the sort's queues, types and strings, turn to files, while seeds, their names and the cores' hashes stay in memory.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe import packed, unpacked
from quire.llm.common import _BYTE, _inverses, _powers, batch_of, discard, mixed, partitions, settle, small_batches, steps, utf8
from quire.llm.graph import in_parts, totals
from quire.llm.suffix_sort import MEMORY, Shard

#: Bytes of a window, of the grams that deal windows out, and of a shard, about.
LENGTH, GRAM, SHARD = 400, 32, 2 << 20
#: Distances from the gram that have one core, bytes of texts that a shard holds before it turns to files, and entries with
#: which a gram is dealt by its surroundings.
NEAR, HELD, HOT = 32, 16 << 20, 10_000
#: Text bytes that fragments are found in at once, or one document: some 90 bytes of arrays stand for each.
STEP = 1 << 20
#: What tells entries apart.
ENTRY = ["gram", "entry", "bytes", "anchor"]


def fragments(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, begin in it, bytes, gram hash, entry hash, place of the gram in it) of the fragments of a step's texts."""
    n, wide = len(data), length - gram + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty, empty
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(n)[:n], dtype=np.uint64)))
    back = _inverses(n + 1)
    grams = mixed((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    places = np.arange(len(grams), dtype=np.uint64)
    key = (grams >> np.uint64(30) << np.uint64(30)) | places  # the leftmost of the least
    fill = -len(key) % wide
    blocks = np.concatenate((key, np.full(fill, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = (np.minimum(behind[:windows], ahead[wide - 1 : wide - 1 + windows]) & np.uint64((1 << 30) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[:windows]
    valid = np.arange(windows) + length <= at[1:][doc]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(begins)
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | begins[1:]
    end = np.flatnonzero(ends) + length
    anchor = grams[least[begin]]
    entry = mixed((sums[end] - sums[begin]) * back[begin] + mixed(anchor) + (end - begin).astype(np.uint64))
    return doc[begin], begin - at[doc[begin]], end - begin, anchor.view(np.int64), entry.view(np.int64), least[begin] - begin


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, as maximal runs; spans that touch are one."""
    if not len(begins):
        return begins, ends
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], begins[1:] > ends[:-1]))
    return begins[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]


def runs(marks: np.ndarray) -> np.ndarray:
    """(begin, end) of the runs of marked places, one after another in one array."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return edges.astype(np.int32)


class Fragments:
    """The entries of a shard: their cores' hashes in memory, their bytes in memory up to a bound and in a file beyond."""

    def __init__(self, length: int, memory: int):
        self.length, self.memory, self.core = length, memory, length - NEAR + 1
        self.rows, self.weights, self.places, self.anchors, self.keys, self.owners, self.blocks = [], [], [], [], [], [], []
        self.held, self.file, self.size = [], None, 0

    def add(self, rows) -> None:
        data, at = utf8(rows.column("body"))
        begin, size = at[:-1], np.diff(at)
        anchor = rows.column("anchor").to_numpy().astype(np.int64) - rows.column("low").to_numpy()
        gram = rows.column("gram").to_numpy().view(np.uint64)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(len(data))[: len(data)], dtype=np.uint64)))
        back = _inverses(len(data) + 1)
        nearest = anchor - (size - self.length)  # the least distance of a window from its gram
        first = sum(map(len, self.weights))
        for block in range((self.length - GRAM) // NEAR + 1):
            own = np.flatnonzero((nearest <= block * NEAR + NEAR - 1) & (anchor >= block * NEAR))
            a = begin[own] + anchor[own] - block * NEAR
            self.keys.append(mixed((sums[a + self.core] - sums[a]) * back[a] + mixed(gram[own] + np.uint64(block))))
            self.owners.append(first + own)
            self.blocks.append(np.full(len(own), block))
        self.rows.append(rows.select([*ENTRY, "low"]))
        self.weights.append(rows.column("n").to_numpy())
        self.anchors.append(anchor)
        self.places.append(self.size + at)
        body = data.tobytes()
        self.size += len(body)
        if self.size > HELD and self.file is None:
            self.file = tempfile.TemporaryFile()
            for x in self.held:
                self.file.write(x)
            self.held = []
        if self.file is None:
            self.held.append(body)
        else:
            self.file.write(body)

    def verdicts(self) -> dict:
        """What tells the entry apart, and found: the runs of its windows that repeat, for each row that has one."""
        weights, anchors = np.concatenate(self.weights), np.concatenate(self.anchors)
        begins, ends = np.concatenate([p[:-1] for p in self.places]), np.concatenate([p[1:] for p in self.places])
        windows = np.maximum(ends - begins - self.length + 1, 0)
        keys, owners, blocks = np.concatenate(self.keys), np.concatenate(self.owners), np.concatenate(self.blocks)
        order = np.argsort(keys, kind="stable")
        equal = np.concatenate(([False], keys[order][1:] == keys[order][:-1], [False]))
        met = order[equal[1:] | equal[:-1]]
        owners, blocks = owners[met], blocks[met]
        low = np.maximum(0, anchors[owners] - blocks * NEAR - NEAR + 1)
        high = np.minimum(windows[owners] - 1, anchors[owners] - blocks * NEAR)
        order = np.lexsort((low, owners))
        owners, low, high = owners[order], low[order], high[order]
        new = np.concatenate((np.ones(min(1, len(low)), bool), (owners[1:] != owners[:-1]) | (low[1:] > high[:-1] + 1)))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new))[: len(first)] - 1
        owners, low, high = owners[first], low[first], high[last]
        if self.file is None:
            data = b"".join(self.held)
            read = lambda a, b: data[a:b]
        else:
            self.file.flush()
            read = lambda a, b: os.pread(self.file.fileno(), b - a, a)
        found: dict[int, list] = {}
        shard = Shard(self.memory)
        try:
            for o, a, b in zip(owners.tolist(), low.tolist(), high.tolist(), strict=True):
                shard.add(read(int(begins[o]) + a, int(begins[o]) + b + self.length))
            for o, a, marks in zip(owners.tolist(), low.tolist(), shard.repeats(self.length) if len(owners) else [], strict=True):
                if weights[o] < 2 and len(r := runs(marks)):
                    found.setdefault(o, []).append(r + np.int32(a))
        finally:
            shard.close()
            if self.file is not None:
                self.file.close()
        for o in np.flatnonzero((weights > 1) & (windows > 0)).tolist():
            found[o] = [np.array([0, windows[o]], np.int32)]
        own = pa.Table.from_batches(self.rows).take(pa.array(list(found), pa.int64()))
        moved = [(np.concatenate(r) + np.int32(low)).tobytes() for r, low in zip(found.values(), own.column("low").to_pylist(), strict=True)]
        return {c: own.column(c).combine_chunks() for c in ENTRY} | {"found": moved}


def by_surroundings(anchor: int, size: int, length: int) -> list[tuple[int, int, int]]:
    """(first window, last window, begin of their core) of a fragment's windows, by their distance from the gram."""
    out = []
    for block in range((length - GRAM) // NEAR + 1):
        core = anchor - block * NEAR
        low, high = max(0, core - NEAR + 1), min(size - length, core)
        if low <= high:
            out.append((low, high, core))
    return out


def _packed_texts(rows: DataFrame) -> DataFrame:
    def pack(batches):
        for batch in steps(batches):
            data, at = utf8(batch.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            yield batch_of("id long, row long, crc long, body binary", id=batch.column("id"), row=batch.column("row"), crc=batch.column("crc"), body=[packed(view[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])

    return rows.mapInArrow(pack, "id long, row long, crc long, body binary")


def removed_spans(rows: DataFrame, length: int, memory: int, hot: int = HOT) -> DataFrame:
    """(row, crc, spans): for the texts with a repeat, what is cut out of each, as packed (begin, end) of maximal runs.

    rows: id, row and crc (together a number of its own for each text), text.
    """
    spark = rows.sparkSession
    ddl = "row long, crc long, gram long, entry long, bytes int, anchor int, n int, begins binary"

    def deal(batches):
        for batch in steps(batches, limit=STEP):
            doc, begin, size, gram, entry, anchor = fragments(*utf8(batch.column("text")), length)
            if not len(doc):
                continue
            order = np.lexsort((begin, anchor, size, gram, entry, doc))  # a text's equal fragments are one row
            doc, begin, size, gram, entry, anchor = (x[order] for x in (doc, begin, size, gram, entry, anchor))
            first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (entry[1:] != entry[:-1]) | (gram[1:] != gram[:-1]) | (size[1:] != size[:-1]) | (anchor[1:] != anchor[:-1]))))
            last = np.append(first[1:], len(doc))
            own = pa.array(doc[first])
            small = begin.astype("<i4").tobytes()
            yield batch_of(ddl, row=batch.column("row").take(own), crc=batch.column("crc").take(own), gram=gram[first], entry=entry[first], bytes=size[first], anchor=anchor[first], n=last - first, begins=[small[4 * a : 4 * b] for a, b in zip(first.tolist(), last.tolist(), strict=True)])

    places = settle(rows.select("row", "crc", "text").mapInArrow(deal, ddl))
    entries = in_parts(places.groupBy(*ENTRY).agg(F.sum("n").alias("n"), F.min(F.struct("row", "crc", "begins")).alias("place")), "entry")
    counted = totals(entries, ["gram"], {"all": F.sum("n"), "kinds": F.count("*")}, {"all": F.sum("all"), "kinds": F.sum("kinds")}).where("all > 1")
    wanted = settle(entries.join(counted, ["gram", "part"]).select(*ENTRY, "n", "place.*", (F.col("kinds") >= hot).alias("hot")))
    shards = max(1, int((wanted.agg(F.sum("bytes")).first()[0] or 0) / SHARD) + 1)
    asked = wanted.groupBy("row", "crc").agg(F.collect_list(F.struct(*ENTRY, "n", "begins", "hot")).alias("asked"))
    texts = _packed_texts(rows.select("id", "row", "crc", "text")).drop("id")
    cut_ddl = "shard int, gram long, entry long, bytes int, anchor int, low int, n long, body binary"

    def cut(batches):
        names = [x.split(" ")[0] for x in cut_ddl.split(", ")]
        for batch in batches:
            out = {c: [] for c in names}
            for body, want in zip(batch.column("body").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                text = unpacked(body)
                for x in want:
                    begin = int(np.frombuffer(x["begins"], "<i4")[0])
                    whole = text[begin : begin + x["bytes"]]
                    parts = [(x["gram"], 0, whole)]
                    if x["hot"]:
                        parts = [(zlib.crc32(whole[core : core + length - NEAR + 1]), low, whole[low : high + length]) for low, high, core in by_surroundings(x["anchor"], x["bytes"], length)]
                    for key, low, own in parts:
                        for c, v in zip(names, (key % shards, *[x[c] for c in ENTRY], low, x["n"], own), strict=True):
                            out[c].append(v)
            yield batch_of(cut_ddl, **out)

    pieces = texts.join(asked.hint("shuffle_hash"), ["row", "crc"]).select("body", "asked").mapInArrow(cut, cut_ddl)

    verdict_ddl = "gram long, entry long, bytes int, anchor int, found binary"

    def judge(batches):  # the rows of a shard follow each other
        current, shard = None, None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)])).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if numbers[a] != current:
                    if shard is not None:
                        yield batch_of(verdict_ddl, **shard.verdicts())
                    current, shard = numbers[a], Fragments(length, memory)
                shard.add(batch.slice(a, b - a))
        if shard is not None:
            yield batch_of(verdict_ddl, **shard.verdicts())

    verdicts = pieces.repartition(partitions(spark), "shard").sortWithinPartitions("shard").mapInArrow(judge, verdict_ddl)
    hits = places.join(verdicts, ENTRY).select("row", "crc", "begins", "found")
    gathered = hits.groupBy("row", "crc").agg(F.collect_list(F.struct("begins", "found")).alias("hits"))

    def unite(batches):
        for batch in batches:
            spans = []
            for hits in batch.column("hits").to_pylist():
                begins, ends = [], []
                for hit in hits:
                    at = np.frombuffer(hit["begins"], "<i4").astype(np.int64)[:, None]
                    found = np.frombuffer(hit["found"], np.int32).astype(np.int64)
                    begins.append((at + found[::2]).ravel())
                    ends.append((at + found[1::2] - 1 + length).ravel())
                b, e = merged(np.concatenate(begins), np.concatenate(ends))
                spans.append(np.column_stack((b, e)).astype("<i8").tobytes())
            yield batch_of("row long, crc long, spans binary", row=batch.column("row"), crc=batch.column("crc"), spans=spans)

    # Written before the texts move again, so that the shuffle files of what led here go first.
    spans = settle(gathered.mapInArrow(unite, "row long, crc long, spans binary"))
    discard(places, wanted)
    return spans


def deduplicate(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = LENGTH, memory: int = MEMORY, hot: int = HOT, keep_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left) for every row of docs.

    Each byte under a string of `length` bytes that starts at another place too, in any text, is removed; strings are
    judged on the input. A null text is empty. Ids may be null or repeat: rows are told apart by id and text, and rows
    alike in both stand for two places. Texts under `length` bytes have no window and stay.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A number of its own for each text: rows alike in id and text share it, and so do their places and verdicts.
    rows = own.withColumns({"row": F.xxhash64("id", F.xxhash64("text")), "crc": F.crc32("text")})
    spans = removed_spans(rows, length, memory, hot)
    ddl = f"{id} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text

    def finish(batches):
        for batch in batches:
            out = {"id": batch.column("id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for body, found in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = unpacked(body)
                cuts = np.frombuffer(found or b"", "<i8").reshape(-1, 2).tolist()
                parts, at = [], 0
                for b, e in cuts:
                    parts.append(data[at:b])
                    at = e
                left = b"".join([*parts, data[at:]])
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(left))
                out["n_spans"].append(len(cuts))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left)
            if not keep_text:
                out.pop("kept")
            out[id] = out.pop("id")
            yield batch_of(ddl, **out)

    return _packed_texts(rows).join(spans.hint("shuffle_hash"), ["row", "crc"], "left").select("id", "body", "spans").mapInArrow(finish, ddl)

