"""Suffix and common-prefix arrays by external induced sorting.

A string's suffixes are of type S or L as they are less or greater than the next one. The leftmost S suffixes of each run
are sorted by recursion on a string of names that is at most half as long; the others are induced: L suffixes in
ascending, S suffixes in descending order. A queue keyed by first symbol carries (suffix, common prefix with the suffix
queued before it); within a symbol it is first in, first out, which is the order of induction. A suffix that stands one
symbol before two sources has one symbol more in common than the least common prefix between the sources, so the values
are induced too; only where the L and the S part of a symbol meet are two suffixes compared.

Queues, types, strings and the names of deeper levels go to files in a scratch folder once they pass the memory given, so
a shard may be far larger than memory; the folder goes with the call. Sources of one symbol are handled as arrays.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

import numpy as np

#: Bytes of arrays that one sort holds before it turns to files.
MEMORY = 128 << 20


class Scratch:
    """Arrays in memory up to a bound, and files beyond it."""

    def __init__(self, memory: int):
        self.memory, self.folder, self.count = memory, None, 0

    def path(self) -> str:
        if self.folder is None:
            self.folder = tempfile.mkdtemp(prefix="suffixes-")
        self.count += 1
        return os.path.join(self.folder, str(self.count))

    def array(self, n: int, dtype) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        return np.empty(n, dtype) if size * 16 <= self.memory else np.memmap(self.path(), dtype, "w+", shape=(n,))

    def close(self) -> None:
        if self.folder is not None:
            shutil.rmtree(self.folder, ignore_errors=True)


class Queue:
    """Pairs of (suffix, common prefix) by symbol, first in first out; all go to a file when they pass the bound."""

    ENTRY = np.dtype([("at", np.int64), ("lcp", np.int64)])

    def __init__(self, scratch: Scratch):
        self.scratch, self.held, self.spilled, self.size, self.file = scratch, {}, {}, 0, None

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self.held.setdefault(symbol, []).append((at, lcp))
        self.size += len(at) * 16
        if self.size * 4 > self.scratch.memory:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = open(self.scratch.path(), "w+b")  # noqa: SIM115
        for symbol, parts in self.held.items():
            entry = np.empty(sum(len(a) for a, _ in parts), self.ENTRY)
            entry["at"], entry["lcp"] = np.concatenate([a for a, _ in parts]), np.concatenate([x for _, x in parts])
            self.file.seek(0, os.SEEK_END)
            self.spilled.setdefault(symbol, []).append((self.file.tell(), len(entry)))
            entry.tofile(self.file)
        self.held, self.size = {}, 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for begin, n in self.spilled.pop(symbol, ()):
            self.file.seek(begin)
            entry = np.fromfile(self.file, self.ENTRY, n)
            parts.append((entry["at"], entry["lcp"]))
        own = self.held.pop(symbol, ())
        self.size -= sum(len(a) for a, _ in own) * 16
        parts.extend(own)
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return (parts[0] if len(parts) == 1 else (np.concatenate([a for a, _ in parts]), np.concatenate([x for _, x in parts])))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _types(t: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Which suffixes are of type S; the last one is."""
    n, block = len(t), 1 << 22
    out = scratch.array(n, bool)
    out[n - 1], after = True, True
    for end in range(n - 1, 0, -block):
        begin = max(0, end - block)
        step = np.sign(np.diff(t[begin : end + 1].astype(np.int64)))
        if step[-1] == 0:
            step[-1] = 1 if after else -1
        marks = np.flatnonzero(step)
        out[begin:end] = np.repeat(step[marks] > 0, np.diff(np.concatenate(([-1], marks))))
        after = bool(out[begin])
    return out


def _common(t: np.ndarray, a: int, b: int) -> int:
    """The common prefix of two suffixes, by comparing."""
    n, k, step = len(t), 0, 64
    while True:
        room = min(step, n - a - k, n - b - k)
        if room <= 0:
            return k
        same = t[a + k : a + k + room] == t[b + k : b + k + room]
        if not same.all():
            return k + int(np.argmin(same))
        k, step = k + room, min(step * 2, 1 << 16)


def _scan(t, fits, at, lcp, since: dict, queue: Queue, symbol: int, carry: bool) -> tuple[np.ndarray, np.ndarray]:
    """Queue the predecessors of the sources `at` that have the type wanted; those of the same symbol are returned.

    since: for each symbol queued from this symbol's sources so far, the least common prefix since its last source.
    """
    before = at - 1
    which = np.flatnonzero(before >= 0)
    which = which[fits[before[which]]]
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    got = none
    least = int(lcp.min()) if carry and len(lcp) else 0
    done = set()
    if len(which):
        before = before[which]
        symbols = t[before]
        order = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[order]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(sorted_symbols)) + 1, [len(order)]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own, to = order[a:b], int(sorted_symbols[a])
            if carry:
                places = which[own]
                cuts = np.empty(len(places) + 1, np.int64)
                cuts[0], cuts[1:] = 0, places + 1
                tail = cuts[-1] < len(lcp)
                mins = np.minimum.reduceat(lcp, cuts if tail else cuts[:-1])
                values = mins[: len(places)] + 1
                values[0] = min(int(values[0]) - 1, since.get(to, 0)) + 1
                since[to] = int(mins[-1]) if tail else 1 << 62
                done.add(to)
            else:
                values = np.zeros(b - a, np.int64)
            if to == symbol:
                got = (before[own], values)
            else:
                queue.push(to, before[own], values)
    if carry:
        for to in since:
            if to not in done and since[to] > least:
                since[to] = least
    return got


def _induce(t: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray | None, scratch: Scratch, out: Callable) -> None:
    """Give all suffixes to out(symbol, suffixes, common prefixes), symbol by symbol in descending order, each ascending.

    seeds: the leftmost S suffixes, grouped by symbol; sorted if seed_lcp is given.
    """
    carry = seed_lcp is not None
    is_l = ~is_s if not isinstance(is_s, np.memmap) else np.logical_not(is_s, out=scratch.array(len(is_s), bool))
    first = t[seeds]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(first)) + 1, [len(first)])) if len(first) else np.array([0])
    seeded = {int(first[a]): (a, b) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)}
    present = sorted({int(x) for begin in range(0, len(t), 1 << 22) for x in np.unique(t[begin : begin + (1 << 22)])})
    queue, lefts = Queue(scratch), Queue(scratch)
    for c in present:
        since: dict[int, int] = {}
        at, lcp = queue.pop(c)
        end = -1
        if len(lcp):
            lcp = lcp.copy()
            lcp[0] = 0
        while len(at):
            lefts.push(c, at, lcp)
            end = int(at[-1])
            at, lcp = _scan(t, is_l, at, lcp, since, queue, c, carry)
        if c in seeded:
            a, b = seeded[c]
            at = seeds[a:b]
            lcp = seed_lcp[a:b].copy() if carry else np.zeros(b - a, np.int64)
            lcp[0] = _common(t, end, int(at[0])) if carry and end >= 0 else 0
            _scan(t, is_l, at, lcp, since, queue, c, carry)
    queue.close()
    queue = Queue(scratch)
    for c in reversed(present):
        since = {}
        at, lcp = queue.pop(c)
        if c == present[0]:
            at, lcp = np.array([len(t) - 1]), np.zeros(1, np.int64)  # the end of the string, which nothing induces
        if len(lcp):
            lcp = lcp.copy()
            lcp[0] = 0
        right = []
        while len(at):
            right.append((at, lcp))
            at, lcp = _scan(t, is_s, at, lcp, since, queue, c, carry)
        left, left_lcp = lefts.pop(c)
        s_at = np.concatenate([a for a, _ in right])[::-1] if right else np.zeros(0, np.int64)
        s_lcp = np.concatenate([x for _, x in right]) if right else np.zeros(0, np.int64)
        s_lcp = np.concatenate((s_lcp[:1], s_lcp[:0:-1]))
        seam = _common(t, int(left[-1]), int(s_at[0])) if carry and len(left) and len(s_at) else 0
        if len(s_lcp):
            s_lcp[0] = seam
        if len(left):
            _scan(t, is_s, left[::-1], np.concatenate(([seam], left_lcp[:0:-1])), since, queue, c, carry)
        out(c, np.concatenate((left, s_at)), np.concatenate((left_lcp, s_lcp)))
    queue.close()
    lefts.close()


def _doubled(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, equal names with the one before) of the suffixes of a string that fits in memory, by prefix doubling."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank], 1
    while int(rank.max()) + 1 < n:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = new
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    equal = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 2, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        equal[1:][same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, equal


def _sorted_seeds(t: np.ndarray, is_s: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """(leftmost S suffixes in order, common prefix of each with the one before)."""
    n = len(t)
    seeds = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    m = len(seeds)
    if m == 1:
        return seeds, np.zeros(1, np.int64)
    place = scratch.array(n, np.int32 if m < 1 << 31 else np.int64)
    place[:] = -1
    place[seeds] = np.arange(m)
    found: list[np.ndarray] = []
    _induce(t, is_s, seeds[np.argsort(t[seeds], kind="stable")], None, scratch, lambda _, at, lcp: found.append(at[place[at] >= 0]))
    rank = place[np.concatenate(found[::-1])].astype(np.int64)  # numbers of the seeds' stretches in order
    ends = np.append(seeds[1:], n - 1)
    a, b = rank[:-1], rank[1:]
    differs = (ends - seeds)[a] != (ends - seeds)[b]
    alive, k = np.flatnonzero(~differs), 0
    while len(alive):
        inside = seeds[a[alive]] + k <= ends[a[alive]]
        alive = alive[inside]
        other = t[seeds[a[alive]] + k] != t[seeds[b[alive]] + k]
        differs[alive[other]] = True
        alive, k = alive[~other], k + 1
    names = scratch.array(m, np.int64)
    names[rank] = np.concatenate(([0], np.cumsum(differs)))
    if m * 160 <= scratch.memory:
        order, equal = _doubled(names)
    else:
        order, equal = suffix_array(names, scratch)
    order = np.asarray(order)
    i, j = order[:-1] + equal[1:], order[1:] + equal[1:]
    lcp = np.zeros(m, np.int64)
    lcp[1:] = seeds[np.minimum(i, m - 1)] - seeds[order[:-1]]
    u, v, alive = seeds[np.minimum(i, m - 1)].copy(), seeds[np.minimum(j, m - 1)].copy(), np.arange(m - 1)
    while len(alive):  # inside the first stretches that differ
        inside = (u[alive] < n) & (v[alive] < n)
        alive = alive[inside]
        alive = alive[t[u[alive]] == t[v[alive]]]
        lcp[1:][alive] += 1
        u[alive] += 1
        v[alive] += 1
    return seeds[order], lcp


def suffixes(t: np.ndarray, out: Callable, scratch: Scratch) -> None:
    """Give the suffixes of t to out(symbol, suffixes, common prefixes); t ends with a symbol that is less than all others."""
    if len(t) == 1:
        out(int(t[0]), np.zeros(1, np.int64), np.zeros(1, np.int64))
        return
    is_s = _types(t, scratch)
    seeds, lcp = _sorted_seeds(t, is_s, scratch)
    _induce(t, is_s, seeds, lcp, scratch, out)


def suffix_array(t: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The whole arrays, in files if they are large."""
    order, lcp, end = scratch.array(len(t), np.int64), scratch.array(len(t), np.int64), len(t)

    def put(_, at, common):
        nonlocal end
        order[end - len(at) : end], lcp[end - len(at) : end] = at, common
        end -= len(at)

    suffixes(t, put, scratch)
    return order, lcp


class Shard:
    """Strings that are sorted together; they go to a file once they pass the memory given."""

    def __init__(self, memory: int = MEMORY):
        self.scratch, self.held, self.sizes, self.waiting, self.file = Scratch(memory), [], [], 0, None

    def add(self, string: bytes) -> None:
        self.held.append(string)
        self.sizes.append(len(string))
        self.waiting += len(string)
        if self.waiting * 16 > self.scratch.memory:
            self._flush()

    def _flush(self) -> None:
        if self.file is None:
            self.file = open(self.scratch.path(), "w+b")  # noqa: SIM115
        for string in self.held:
            symbols = np.frombuffer(string + b"\0", np.uint8).astype(np.uint16) + 2
            symbols[-1] = 1
            symbols.tofile(self.file)
        self.held, self.waiting = [], 0

    def repeats(self, length: int) -> list[np.ndarray]:
        """For each string, which of its starts begin a stretch of `length` bytes that also starts elsewhere in the shard."""
        sizes = np.array(self.sizes, np.int64)
        total = int(sizes.sum()) + len(sizes) + 1
        if self.file is None:
            joined = np.frombuffer(b"\0".join(self.held) + b"\0\0", np.uint8)[:total].astype(np.uint16) + 2
        else:
            self._flush()
            np.zeros(1, np.uint16).tofile(self.file)
            self.file.flush()
            joined = np.memmap(self.file.name, np.uint16, "r+", shape=(total,))
        ends = np.cumsum(sizes + 1) - 1
        joined[ends], joined[total - 1] = 1, 0
        marks = self.scratch.array(total, bool)
        marks[:] = False

        def mark(_, order, lcp):
            room = np.append(ends, total)[np.searchsorted(ends, order)] - order  # bytes up to the end of the string
            common = np.minimum(lcp[1:], np.minimum(room[1:], room[:-1])) >= length
            marks[order[1:][common]] = True
            marks[order[:-1][common]] = True

        suffixes(joined, mark, self.scratch)
        return [np.array(marks[e - n : max(e - n, e - length + 1)]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.scratch.close()


def repeated(strings: list[bytes], length: int, memory: int = MEMORY) -> list[np.ndarray]:
    """repeats() of a shard of these strings."""
    if not strings:
        return []
    shard = Shard(memory)
    try:
        for s in strings:
            shard.add(s)
        return shard.repeats(length)
    finally:
        shard.close()
