"""Suffix and common-prefix arrays by external induced sorting, for one shard.

The text is classified into L and S suffixes; the S suffixes that follow an L one are
sorted by the names of the substrings between them, recursively; one ascending sweep
induces the L suffixes, one descending sweep the S suffixes. A sweep's priority queue
holds suffix tuples (position, common prefix with the tuple before it), keyed by the
suffix's first character and then by the rank of the suffix after it. As that rank only
rises during a sweep, the queue is a bulk queue: one first-in-first-out spool for each
range of characters, extracted a range at a time. Spools beyond the memory limit go to a
file, as do texts, types and orders, so a shard may be far larger than memory.

Common prefixes are counted up to a cap. At the bytes' level every tuple carries its own:
the least one among the suffixes scanned since the last tuple of the same character, plus
one. The recursion's levels, whose characters are names of substrings, sort only; the
sorted S suffixes get their first values by comparing neighbours.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

SENTINEL, SEPARATOR, SHIFT = 0, 1, 2


class Store:
    """The memory limit of one shard and its unnamed scratch file (which goes with the
    task, as Spark's own spill files do)."""

    def __init__(self, memory: int, block: int):
        self.memory, self.block = memory, block
        self.used = self.end = 0
        self.spools: list[Spool] = []
        self._file = None

    def file(self):
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        return self._file

    def write(self, x: np.ndarray) -> tuple[int, int]:
        at = self.end
        self.file().seek(at)
        self.file().write(x.tobytes())
        self.end += x.nbytes
        return at, len(x)

    def read(self, at: int, n: int, dtype: np.dtype) -> np.ndarray:
        self.file().seek(at)
        return np.frombuffer(self.file().read(n * dtype.itemsize), dtype=dtype)

    def array(self, n: int, dtype) -> np.ndarray:
        """In memory if small, else mapped from a file of its own."""
        if n * np.dtype(dtype).itemsize <= self.memory // 16:
            return np.zeros(n, dtype=dtype)
        with tempfile.TemporaryFile() as file:
            return np.memmap(file, dtype=dtype, mode="w+", shape=(n,))

    def spool(self, dtype) -> Spool:
        self.spools.append(Spool(self, np.dtype(dtype)))
        return self.spools[-1]

    def grew(self, nbytes: int) -> None:
        self.used += nbytes
        if self.used > self.memory:
            for spool in self.spools:
                spool.spill()


class Spool:
    """Records in order of arrival."""

    def __init__(self, store: Store, dtype: np.dtype):
        self.store, self.dtype, self.parts = store, dtype, []

    def add(self, x: np.ndarray) -> None:
        if len(x):
            self.parts.append(x)
            self.store.grew(x.nbytes)

    def spill(self) -> None:
        for i, x in enumerate(self.parts):
            if isinstance(x, np.ndarray):
                self.store.used -= x.nbytes
                self.parts[i] = self.store.write(x)

    def _arrays(self, back: bool) -> Iterator[np.ndarray]:
        while self.parts:
            x = self.parts.pop(-1 if back else 0)
            if isinstance(x, np.ndarray):
                self.store.used -= x.nbytes
                yield x
                continue
            at, n = x
            starts = range(0, n, self.store.block)
            for a in reversed(starts) if back else starts:
                yield self.store.read(at + a * self.dtype.itemsize, min(self.store.block, n - a), self.dtype)

    def drain(self, back: bool = False) -> Iterator[np.ndarray]:
        """First in, first out (``back``: last in, first out, each array reversed), in
        arrays of about a block; may grow meanwhile."""
        arrays = self._arrays(back)
        while True:
            taken, size = [], 0
            for x in arrays:
                taken.append(x[::-1] if back else x)
                size += len(x)
                if size >= self.store.block:
                    break
            if not taken:
                return
            if size < self.store.block:
                # What arrives from now on is a new start.
                arrays = self._arrays(back)
            yield np.concatenate(taken) if len(taken) > 1 else taken[0]

    def size(self) -> int:
        return sum(len(x) if isinstance(x, np.ndarray) else x[1] for x in self.parts)

    def whole(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype=self.dtype), *self.drain()])


TUPLE = np.dtype([("pos", np.int64), ("near", np.uint8)])


def tuples(pos: np.ndarray, near=0) -> np.ndarray:
    out = np.empty(len(pos), dtype=TUPLE)
    out["pos"], out["near"] = pos, near
    return out


def types(text: np.ndarray, store: Store) -> np.ndarray:
    """1 for S suffixes (smaller than the next one), 0 for L; the sentinel is S."""
    n = len(text)
    kinds = store.array(n, np.uint8)
    kinds[n - 1] = right = 1
    for end in range(n - 1, 0, -store.block):
        a = max(end - store.block, 0)
        step = text[a + 1 : end + 1].astype(np.int64) - text[a:end].astype(np.int64)
        step = step[::-1]
        at = np.maximum.accumulate(np.where(step != 0, np.arange(len(step)), -1))
        kind = np.where(at >= 0, step[at] > 0, right)
        kinds[a:end] = kind[::-1]
        right = kind[-1]
    return kinds


def star_positions(kinds: np.ndarray, store: Store) -> np.ndarray:
    """S suffixes that follow an L suffix, by position."""
    found = store.spool(np.int64)
    for a in range(1, len(kinds), store.block):
        b = min(a + store.block, len(kinds))
        found.add(a + np.flatnonzero((kinds[a:b] == 1) & (kinds[a - 1 : b - 1] == 0)))
    out = store.array(found.size(), np.int64)
    at = 0
    for x in found.drain():
        out[at : at + len(x)] = x
        at += len(x)
    return out


def _regroup(rank: np.ndarray, subset: Callable[[], Iterator[np.ndarray]], key_of: Callable, bits: int, store: Store) -> None:
    """Splits groups of equal ``rank`` (the number of smaller items) by a further key of
    ``bits`` bits, for the items of ``subset``: an external sort by ranges of the key."""
    sample = [x[:: max(1, len(x) // 64)] for x in subset()]
    if not sample:
        return
    total = sum(map(len, subset()))
    full = np.sort(np.concatenate([key_of(x) for x in sample]))
    parts = total // store.block + 1
    cuts = np.unique(full[np.arange(1, parts) * len(full) // parts] >> np.uint64(bits)) << np.uint64(bits)
    record = np.dtype([("key", np.uint64), ("item", np.int64)])
    spools = [store.spool(record) for _ in range(len(cuts) + 1)]
    for items in subset():
        keys = key_of(items)
        where = np.searchsorted(cuts, keys, side="right")
        for part in np.unique(where):
            own = where == part
            x = np.empty(own.sum(), dtype=record)
            x["key"], x["item"] = keys[own], items[own]
            spools[part].add(x)
    for spool in spools:
        x = spool.whole()
        found, inverse, counts = np.unique(x["key"], return_inverse=True, return_counts=True)
        before = np.cumsum(counts) - counts
        group = found >> np.uint64(bits)
        first = np.searchsorted(group, group)
        rank[x["item"]] = (group.astype(np.int64) + before - before[first])[inverse]
    store.spools = [x for x in store.spools if x not in spools]


def names(text: np.ndarray, kinds: np.ndarray, stars: np.ndarray, alphabet: int, store: Store) -> tuple[np.ndarray, int]:
    """The order-preserving name of the substring from each star to the next one, and
    how many names there are. Substrings compare by (character, type) pairs."""
    n = len(stars)
    width = (2 * alphabet + 1).bit_length()
    rank_bits = max(int(n).bit_length(), 1)
    rank = store.array(n, np.int64)

    def symbols(items: np.ndarray, depth: int, count: int) -> np.ndarray:
        start = np.asarray(stars[items])
        last = np.asarray(stars[np.minimum(items + 1, n - 1)])
        key = np.zeros(len(items), dtype=np.uint64)
        for d in range(depth, depth + count):
            at = np.minimum(start + d, last)
            pair = 2 * text[at].astype(np.uint64) + kinds[at].astype(np.uint64) + np.uint64(1)
            key = (key << np.uint64(width)) | np.where(start + d <= last, pair, np.uint64(0))
        return key

    def chunks(items: np.ndarray) -> Iterator[np.ndarray]:
        for a in range(0, len(items), store.block):
            yield np.asarray(items[a : a + store.block])

    depth, per = 0, max((63 - rank_bits) // width, 1)
    bits = width * per
    # Items that share their name so far with another one, and have more characters.
    active = store.array(n, np.int64)
    for a in range(0, n, store.block):
        active[a : a + store.block] = np.arange(a, min(a + store.block, n))
    sizes = store.array(n, np.int64)
    while len(active):
        key_of = lambda items, d=depth: (rank[items].astype(np.uint64) << np.uint64(bits)) | symbols(items, d, per)
        _regroup(rank, lambda items=active: chunks(items), key_of, bits, store)
        depth += per
        for items in chunks(active):
            np.add.at(sizes, rank[items], 1)
        rest = store.spool(np.int64)
        for items in chunks(active):
            length = stars[np.minimum(items + 1, n - 1)] - stars[items] + 1
            rest.add(items[(length > depth) & (sizes[rank[items]] > 1)])
        for items in chunks(active):
            sizes[rank[items]] = 0
        active, at = store.array(rest.size(), np.int64), 0
        for items in rest.drain():
            active[at : at + len(items)] = items
            at += len(items)
        store.spools.remove(rest)
    used = store.array(n, np.uint8)
    used[rank] = 1
    dense = store.array(n, np.int64)
    dense[:] = np.cumsum(used, dtype=np.int64) - 1
    count = int(dense[-1]) + 1
    rank[:] = dense[rank]
    return rank, count


class Least:
    """Least values of ranges of an array, by doubling."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            x, step = self.rows[-1], 1 << (len(self.rows) - 1)
            if len(x) <= step:
                break
            self.rows.append(np.minimum(x[:-step], x[step:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = np.empty(len(first), dtype=np.uint8)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            row = self.rows[k]
            out[own] = np.minimum(row[first[own]], row[last[own] + 1 - (1 << int(k))])
        return out


class Sweep:
    """One sweep over the characters, up (induces L from stars) or down (S from L)."""

    def __init__(self, text, kinds, alphabet: int, ranges: np.ndarray, up: bool, store: Store, cap: int = 0):
        self.text, self.kinds, self.up, self.store, self.cap = text, kinds, up, store, cap
        self.want = 0 if up else 1
        self.ranges = ranges
        self.first = np.append(np.flatnonzero(np.diff(ranges, prepend=-1)), alphabet)
        self.queue = [store.spool(TUPLE) for _ in range(len(self.first) - 1)]
        self.since = np.full(alphabet, cap, dtype=np.uint8)

    def _push(self, items: np.ndarray, own: int) -> None:
        """Queues the suffixes before ``items`` (in the order of the scan), but for those of
        the range ``own``."""
        pos = items["pos"]
        prev = pos - 1
        char = self.text[np.maximum(prev, 0)]
        ok = (prev >= 0) & (self.kinds[np.maximum(prev, 0)] == self.want)
        if own >= 0:
            ok &= self.ranges[char] != own
        at = np.flatnonzero(ok)
        least = int(items["near"].min()) if self.cap else 0
        if self.cap:
            np.minimum(self.since, least, out=self.since) if not len(at) else None
        if not len(at):
            return
        char = char[at]
        order = np.argsort(char if self.cap else self.ranges[char], kind="stable")
        at, char = at[order], char[order]
        key = char if self.cap else self.ranges[char]
        new = np.append(True, key[1:] != key[:-1])
        ends = np.append(np.flatnonzero(new)[1:], len(at))
        out = tuples(prev[at])
        if self.cap:
            table = Least(np.ascontiguousarray(items["near"]))
            left = np.where(new, 0, np.append(0, at[:-1] + 1))
            near = table.of(left, at)
            near[new] = np.minimum(near[new], self.since[char[new]])
            out["near"] = np.minimum(near, self.cap - 1) + 1
            last = at[ends - 1]
            rest = np.full(len(last), self.cap, dtype=np.uint8)
            more = last + 1 < len(pos)
            rest[more] = table.of(last[more] + 1, np.full(more.sum(), len(pos) - 1))
            np.minimum(self.since, least, out=self.since)
            self.since[char[ends - 1]] = rest
        for a, b in zip(np.flatnonzero(new), ends, strict=True):
            self.queue[self.ranges[char[a]]].add(out[a:b])

    def _run_of(self, pos: int) -> int:
        """How often the first character of the suffix is repeated, up to the cap."""
        part = np.asarray(self.text[pos : pos + self.cap])
        other = np.flatnonzero(part != part[0])
        return int(other[0]) if len(other) else len(part)

    def _one(self, r: int, roots: Iterator[np.ndarray], scanned: Callable) -> None:
        """A range of one character: a first-in-first-out scan, then the roots."""
        last = None
        for items in self.queue[r].drain():
            if self.cap and last is None:
                items = items.copy()
                items["near"][0] = 0
            last = int(items["pos"][-1])
            scanned(r, items, True)
            self._push(items, -1)
        for k, items in enumerate(roots):
            if self.cap and k == 0:
                items = items.copy()
                items["near"][0] = min(self._run_of(last), self._run_of(int(items["pos"][0]))) if last is not None else 0
            scanned(r, items, False)
            self._push(items, -1)

    def _many(self, r: int, roots: Iterator[np.ndarray], scanned: Callable) -> None:
        """A range of several characters with few suffixes: those that are induced within
        the range are found first, then all are dealt to lists by character in one scan."""
        pre = self.queue[r].whole()["pos"]
        root = np.concatenate([np.zeros(0, dtype=np.int64), *(x["pos"] for x in roots)])
        known = len(pre) + len(root)
        if not known:
            return
        parts, children, fresh, count = [], [], np.concatenate([pre, root]), known
        while len(fresh):
            parts.append(fresh)
            prev = np.maximum(fresh - 1, 0)
            ok = (fresh > 0) & (self.kinds[prev] == self.want)
            ok &= self.ranges[self.text[prev]] == r
            fresh = prev[ok]
            children.append(np.where(ok, count - 1 + np.cumsum(ok), -1))
            count += len(fresh)
        pos, child = np.concatenate(parts), np.concatenate(children).tolist()
        char = (self.text[pos].astype(np.int64) * (1 if self.up else -1)).tolist()
        queued: dict[int, list[int]] = {x: [] for x in set(char)}
        given: dict[int, list[int]] = {x: [] for x in queued}
        for i in range(known):
            (queued if i < len(pre) else given)[char[i]].append(i)
        order = []
        for x in sorted(queued):
            own = queued[x]
            for i in own:  # grows meanwhile
                if child[i] >= 0:
                    queued[char[child[i]]].append(child[i])
            order += own
            for i in given[x]:
                if child[i] >= 0:
                    queued[char[child[i]]].append(child[i])
            order += given[x]
        order = np.array(order)
        items = tuples(pos[order])
        scanned(r, items, (order < len(pre)) | (order >= known))
        self._push(items, r)

    def run(self, roots: Callable[[int], Iterator[np.ndarray]], scanned: Callable) -> None:
        """``roots(r)`` gives the given suffixes of a range in the scan's order;
        ``scanned(r, items, induced)`` takes what was scanned, in order."""
        count = len(self.first) - 1
        for r in range(count) if self.up else range(count - 1, -1, -1):
            if self.first[r + 1] - self.first[r] == 1:
                self._one(r, roots(r), scanned)
            else:
                self._many(r, roots(r), scanned)
        self.store.spools = [x for x in self.store.spools if x not in self.queue]


def _ranges(text: np.ndarray, alphabet: int, store: Store) -> np.ndarray:
    """A range for each character: one frequent character, or several with fewer suffixes
    together than a block."""
    counts = np.zeros(alphabet, dtype=np.int64)
    for a in range(0, len(text), store.block):
        counts += np.bincount(text[a : a + store.block], minlength=alphabet)
    size = max(store.block // 16, 2)
    group = (np.cumsum(counts) - counts) // size
    large = counts > size
    cut = np.diff(group, prepend=0) > 0
    cut |= large
    cut[1:] |= large[:-1]
    cut[0] = False
    return np.cumsum(cut)


def sort_suffixes(text: np.ndarray, alphabet: int, ranges: np.ndarray, store: Store, scanned: Callable, cap: int = 0) -> None:
    """Calls ``scanned(items)`` with the suffixes of ``text`` (ending with the one
    sentinel 0), largest first; with a ``cap``, each tuple has the common prefix with
    the suffix before it in this order, up to the cap."""
    if len(text) == 1:
        scanned(tuples(np.array([0])))
        return
    kinds = types(text, store)
    stars = star_positions(kinds, store)
    name, count = names(text, kinds, stars, alphabet, store)
    order = store.array(len(stars), np.int64)
    if count == len(stars):
        order[name] = stars
    else:
        at = len(order)

        def place(items):
            nonlocal at
            order[at - len(items) : at] = stars[items["pos"]][::-1]
            at -= len(items)

        sort_suffixes(name, count, _ranges(name, count, store), store, place)
    left = [store.spool(TUPLE) for _ in range(ranges[-1] + 1)]
    bounds = np.searchsorted(
        ranges, np.arange(ranges[-1] + 2), side="left"
    )  # first character of each range
    heads = _first_places(text, order, bounds, store)

    def star_roots(r: int) -> Iterator[np.ndarray]:
        for a in range(heads[r], heads[r + 1], store.block):
            b = min(a + store.block, heads[r + 1])
            yield tuples(np.asarray(order[a:b]), _neighbours(text, order, a, b, cap) if cap else 0)

    up = Sweep(text, kinds, alphabet, ranges, True, store, cap)
    up.run(star_roots, lambda r, items, induced: left[r].add(items[induced] if induced is not True else items) if induced is not False else None)

    def left_roots(r: int) -> Iterator[np.ndarray]:
        """Largest first; each with the common prefix with the next larger one."""
        near = 0
        for items in left[r].drain(back=True):
            items = items.copy()
            values = items["near"].copy()
            items["near"] = np.append(near, values[:-1])
            near = values[-1]
            yield items

    down = Sweep(text, kinds, alphabet, ranges, False, store, cap)
    down.run(left_roots, lambda r, items, induced: scanned(items))
    scanned(tuples(np.array([len(text) - 1])))
    store.spools = [x for x in store.spools if x not in left]


def _first_places(text: np.ndarray, order: np.ndarray, bounds: np.ndarray, store: Store) -> np.ndarray:
    """For each range the first place in ``order`` of a suffix that starts in it."""
    counts = np.zeros(int(bounds[-1]) + 1, dtype=np.int64)
    for a in range(0, len(order), store.block):
        counts += np.bincount(text[order[a : a + store.block]], minlength=len(counts))
    return np.append(0, np.cumsum(counts))[bounds]


def _neighbours(text: np.ndarray, order: np.ndarray, a: int, b: int, cap: int) -> np.ndarray:
    """Common prefixes of order[a:b] with the suffix before each, up to the cap."""
    x = np.asarray(order[np.maximum(np.arange(a, b) - 1, 0)])
    y = np.asarray(order[a:b])
    near = np.zeros(b - a, dtype=np.int64)
    live = np.arange(b - a) if a else np.arange(1, b - a)
    word = np.arange(8)
    top = len(text) - 1
    while len(live):
        p, q = x[live] + near[live], y[live] + near[live]
        same = text[np.minimum(p[:, None] + word, top)] == text[np.minimum(q[:, None] + word, top)]
        more = np.where(same.all(1), 8, same.argmin(1))
        near[live] += more
        live = live[(more == 8) & (near[live] < cap)]
    return np.minimum(near, cap).astype(np.uint8)


class Packer:
    """Pieces of UTF-8 as one text, each ended by a separator, put together on the go."""

    def __init__(self, store: Store):
        self.store, self.spool, self.lengths = store, store.spool(np.uint8), []

    def add(self, pieces: list[bytes]) -> None:
        # UTF-8 has no byte 255: it stands for the separator.
        part = np.frombuffer(b"\xff".join(pieces) + b"\xff", dtype=np.uint8)
        self.spool.add(np.where(part == 255, np.uint8(SEPARATOR), part + np.uint8(SHIFT)))
        self.lengths.append(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1)

    def text(self) -> tuple[np.ndarray, np.ndarray]:
        """The text, ended by the sentinel, and the start of each piece."""
        lengths = np.concatenate([np.zeros(0, dtype=np.int64), *self.lengths])
        starts = np.cumsum(lengths) - lengths
        text = self.store.array(int(lengths.sum()) + 1, np.uint8)
        at = 0
        for part in self.spool.drain():
            text[at : at + len(part)] = part
            at += len(part)
        text[-1] = SENTINEL
        return text, starts


def byte_suffixes(text: np.ndarray, store: Store, scanned: Callable, cap: int) -> None:
    """``sort_suffixes`` of packed bytes, a range for each byte."""
    sort_suffixes(text, 256, np.arange(256), store, scanned, cap)
