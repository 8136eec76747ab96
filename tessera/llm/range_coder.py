"""A range coder for blocks of token ids, by a mixture of distributions that is fitted to each block.

Three orders give an id its share:

    order 2   after some pairs of ids, one id that is likely
    order 1   after an id, those of its successors that are worth their place in the header
    order 0   all ids of the block, by how often no list has them

The distributions are mixed: a successor's share is the weighted sum of what orders 1 and 0 give it, that of the
likely id after a pair of what order 2 and that mixture give it; what is left of a share leads to the order below.
The weights belong to classes of contexts (the length of a list, the certainty of a pair). They are those by which
the block gets shortest, and are written in its header with the lists, compressed.

A block is cut in lanes of ``LANE`` ids, each a range coder of its own with the block's tables. So lanes of many blocks
are coded side by side with numpy, and a block's bytes don't depend on those beside it. Ranges are
integers below 2**48 in float64, where sums, products and quotients of them are exact.
"""

from __future__ import annotations

import zlib

import numpy as np

LANE = 512
LONGEST = 1 << 20  # ids of a block, as their places are sorted with pairs in 64 bits
_WORD, _LEAST = 65536.0, float(1 << 32)  # a range below the second is renewed by a word of 16 bits
_PAIR_BITS, _TRIPLE_BITS = 20, 14  # what a place in the lists costs
_GRID, _TRIED = 16, (0, 8, 10, 12, 14, 16)  # weights are sixteenths, and these
_CLASSES = 24


def _coarse(n: np.ndarray) -> np.ndarray:
    """Numbers to codes of a byte, three leading bits exact."""
    e = np.maximum(np.frexp(n.astype(np.float64))[1].astype(np.int64) - 3, 0)
    return 4 * e + (n >> e)


def _fine(code: np.ndarray) -> np.ndarray:
    """The middle of a code's numbers."""
    e = np.maximum((code >> 2) - 1, 0)
    m = np.where(code < 8, code, 4 + (code & 3)) << e
    return m + (1 << e) // 2


def _bits(n: np.ndarray) -> np.ndarray:
    return np.frexp(np.asarray(n, dtype=np.float64))[1].astype(np.int64)


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Numbers below 2**32, byte by byte of their lengths and values, compressed."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a, dtype="<u4").view(np.uint8).reshape(-1, 4).T
        width = max([k + 1 for k in range(4) if planes[k].any()], default=0)
        out.append(np.array([len(a), width], dtype="<u4").tobytes() + planes[:width].tobytes())
    return zlib.compress(b"".join(out), 6)


def _unpack(data: bytes) -> list[np.ndarray]:
    data, at, out = zlib.decompress(data), 0, []
    while at < len(data):
        n, width = np.frombuffer(data, dtype="<u4", count=2, offset=at).tolist()
        planes = np.zeros((4, n), dtype=np.uint8)
        planes[:width] = np.frombuffer(data, dtype=np.uint8, count=n * width, offset=at + 8).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64))
        at += 8 + n * width
    return out


class _Model:
    """A block's tables, from what its header holds.

    ids     the distinct ids; below, an id is its number here, and the number after them stands for a lane's start
    often   code of how often order 0 codes an id
    k       how many successors an id's list has; heads and nexts are the pairs of all lists
    share   a successor's by order 1 is between 2**-share and half of that, taken as its middle
    then    the number in nexts' list of the likely id after a pair, from 1 (0: none); sure is its share in sixteenths
    w1, w2  weights of orders 1 and 2 by class
    """

    def __init__(self, ids, often, k, nexts, share, then, sure, w1, w2):
        self.ids, self.often, self.k, self.nexts, self.share, self.then, self.sure, self.w1, self.w2 = ids, often, k, nexts, share, then, sure, w1, w2
        self.heads = np.repeat(np.arange(len(ids)), k)
        self.first = np.cumsum(k) - k
        self.zero()

    def header(self) -> list[np.ndarray]:
        return [np.diff(self.ids, prepend=0), self.often, self.k, self.nexts, self.share, self.then, self.sure, self.w1, self.w2]

    @classmethod
    def read(cls, arrays: list[np.ndarray]) -> "_Model":
        return cls(np.cumsum(arrays[0]), *arrays[1:])

    def zero(self) -> None:
        n = len(self.ids)
        self.bits0 = max(12, int(_bits(n)) + 3)
        often = _fine(self.often).astype(np.float64)
        size = np.floor(often * (((1 << self.bits0) - n) / max(often.sum(), 1.0))).astype(np.int64) + 1
        size[np.argmax(size)] += (1 << self.bits0) - size.sum()
        self.size0, self.start0 = size, np.cumsum(size) - size
        self.p0 = (size / float(1 << self.bits0))[self.nexts]
        self.p1 = 0.75 * 0.5**self.share
        self.m = np.where(self.k > 0, 1 << np.maximum(np.minimum(_bits(self.k) + 4, 12), _bits(self.k) + 1), 1)

    def shares(self, w1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What successors get by weights (a class), and what is left for order 0 after each id."""
        w, n, m = w1[self.classes()][self.heads] / _GRID, len(self.ids), self.m
        mixed = w * self.p1 + (1 - w) * self.p0
        total = np.bincount(self.heads, mixed, minlength=n)
        size = np.floor(mixed * ((m - self.k - 1) / np.maximum(total, 1.0))[self.heads]).astype(np.int64) + 1
        return size, m - np.bincount(self.heads, size, minlength=n).astype(np.int64)

    def classes(self) -> np.ndarray:
        return _bits(self.k)

    def tables(self) -> None:
        """Places: those of the pairs, then what is left after each id, and after a lane's start."""
        n, pairs = len(self.ids), len(self.nexts)
        size, left = self.shares(self.w1)
        size = np.concatenate([size, left, [1]])
        head = np.concatenate([self.heads, np.arange(n + 1)])
        self.total = np.bincount(head, size, minlength=n + 1)
        self.base = (np.cumsum(self.total) - self.total).astype(np.int64)
        order = np.argsort(head, kind="stable")
        self.slots = np.repeat(order, size[order])
        start = np.empty(len(size), dtype=np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        self.size, self.start = size, start - self.base[head]
        self.target = np.where(self.then > 0, self.first[self.nexts] + self.then - 1, 0) if pairs else self.then
        self.two = self.second(self.w2)

    def second(self, w2: np.ndarray) -> np.ndarray:
        """Of 256, what the likely id after a pair gets by weights; 0 if there is none."""
        if not len(self.nexts):
            return self.then
        w, below = w2[self.sure] / _GRID, self.size[self.target] / self.total[self.nexts]
        return np.where(self.then > 0, np.clip(np.floor(256 * (w * self.sure / 16 + (1 - w) * below)), 1, 255), 0).astype(np.int64)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of sorted keys start, and how long they are."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return at, np.diff(at, append=len(keys))


def _fit(block: np.ndarray) -> tuple[_Model, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The model of a block; its ids and those before them by number, each id's pair's place (-1: not listed) and whether order 2 has it (1; 2: another)."""
    n = len(block)
    if n > LONGEST:
        raise ValueError(f"a block has at most {LONGEST} ids")
    if block.max() >> 20:
        ids, x, seen = np.unique(block, return_inverse=True, return_counts=True)
    else:
        seen = np.bincount(block)
        ids = np.flatnonzero(seen)
        number = np.zeros(len(seen), dtype=np.int64)
        number[ids], seen = np.arange(len(ids)), seen[ids]
        x = number[block]
    size, places = len(ids), int(n).bit_length()
    before = np.empty(n, dtype=np.int64)
    before[1:] = x[:-1]
    before[::LANE] = size
    keys = np.sort((before * (size + 1) + x).astype(np.uint64) << np.uint64(places) | np.arange(n, dtype=np.uint64))
    where, keys = (keys & np.uint64((1 << places) - 1)).view(np.int64), (keys >> np.uint64(places)).view(np.int64)
    at, count = _grouped(keys)
    head, tail = np.divmod(keys[at], size + 1)
    heads = np.bincount(before, minlength=size + 1)
    gain = count * np.log2(count * float(n) / (heads[head].astype(np.float64) * seen[tail]))
    listed = (gain > _PAIR_BITS) & (head < size)
    place = np.full(len(at), -1, dtype=np.int64)
    pairs = int(listed.sum())
    place[listed] = np.arange(pairs)
    pair = np.empty(n, dtype=np.int64)
    pair[where] = np.repeat(place, count)
    head, tail, count = head[listed], tail[listed], count[listed]

    # order 2: the most frequent pair after each pair
    last = np.full(n, -1, dtype=np.int64)
    last[1:] = pair[:-1]
    last[::LANE] = -1
    ends = pair[np.append(np.arange(LANE - 1, n - 1, LANE), n - 1)]
    after = count - np.bincount(ends[ends >= 0], minlength=pairs)
    keys = np.sort((last * pairs + pair)[(last >= 0) & (pair >= 0)])
    at, times = _grouped(keys)
    one, two = np.divmod(keys[at], max(pairs, 1))
    ranked = np.sort((one << 21 | LONGEST - times) << 21 | np.arange(len(one)))  # by pair, the most frequent first
    best = ranked[_grouped(ranked >> 42)[0]] & (1 << 21) - 1
    one, two, times = one[best], two[best], times[best]
    share = times / after[one]
    missed = after[one] - times
    gain = times * np.log2(share * heads[head[two]] / count[two]) + missed * np.log2(np.maximum(1 - share, 1e-9))
    good = gain > _TRIPLE_BITS
    one, two = one[good], two[good]
    likely, then, sure = np.full(pairs + 1, -2, dtype=np.int64), np.zeros(pairs, dtype=np.int64), np.zeros(pairs, dtype=np.int64)
    likely[one] = two
    k = np.bincount(head, minlength=size)
    then[one] = two - (np.cumsum(k) - k)[tail[one]] + 1
    sure[one] = np.clip(np.rint(16 * share[good]), 1, 15).astype(np.int64)
    chosen = likely[last]
    second = np.where(chosen == -2, 0, np.where(chosen == pair, 1, 2))

    # what is left to orders 1 and 0
    hit = np.flatnonzero(second == 1)
    left = count - np.bincount(pair[hit], minlength=pairs)
    heads = (heads - np.bincount(before[hit], minlength=size + 1))[:size]
    often = _coarse(seen - np.bincount(tail, count, minlength=size).astype(np.int64))
    share = np.minimum(-np.frexp(np.maximum(left, 0.5) / np.maximum(heads[head], 1))[1], 20).astype(np.int64)
    model = _Model(ids, often, k, tail, np.maximum(share, 0), then, sure, np.full(_CLASSES, _GRID), np.full(_GRID, _GRID))
    classes, escapes = model.classes(), heads - np.bincount(head, left, minlength=size)
    costs = []
    for w in _TRIED:
        sizes, others = model.shares(np.full(_CLASSES, w))
        total = np.log2(others + np.bincount(head, sizes, minlength=size))
        cost = escapes * (total - np.log2(others)) + np.bincount(head, left * (total[head] - np.log2(sizes)), minlength=size)
        costs.append(np.bincount(classes, cost, minlength=_CLASSES))
    model.w1 = np.take(_TRIED, np.argmin(costs, axis=0))
    model.tables()
    hits, all2 = np.bincount(last[hit], minlength=pairs)[one], after[one]
    costs = []
    for w in _TRIED:
        p = model.second(np.full(_GRID, w))[one] / 256
        costs.append(np.bincount(sure[one], -hits * np.log2(p) - (all2 - hits) * np.log2(1 - p), minlength=_GRID))
    model.w2 = np.take(_TRIED, np.argmin(costs, axis=0))
    model.two = model.second(model.w2)
    return model, x, before, pair, second


def _step(start: np.ndarray, size: np.ndarray, bits) -> np.ndarray:
    return start << 29 | size << 5 | bits


def _decisions(block: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """A block's header, its steps (parts of a range of so many bits, from a start) and how many of them each lane has."""
    model, x, before, pair, second = _fit(block)
    pairs, n = len(model.nexts), len(x)
    place = np.where(pair < 0, before + pairs, pair)
    bits = _bits(model.total) - 1
    one = _step(model.start, model.size, np.concatenate([bits[model.heads], bits]))[place]
    zero = _step(model.start0, model.size0, model.bits0)[x]
    has2, has1, has0 = second > 0, (second != 1) & (one & 31 > 0), pair < 0
    ends = np.cumsum(has2.astype(np.int8) + has1 + has0, dtype=np.int64)
    steps = np.empty(int(ends[-1]), dtype=np.int64)
    k = np.flatnonzero(has0)
    steps[ends[k] - 1] = zero[k]
    k = np.flatnonzero(has1)
    steps[ends[k] - 1 - has0[k]] = one[k]
    k = np.flatnonzero(has2)
    size, won = model.two[pair[k - 1]], second[k] == 1
    steps[ends[k] - 1 - has0[k] - has1[k]] = _step(np.where(won, 0, size), np.where(won, size, 256 - size), 8)
    return model.header(), steps, np.diff(ends[np.minimum(np.arange(LANE, n + LANE, LANE), n) - 1], prepend=0)


def _write(steps: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of lanes' steps, one lane after the other, and how many words each has."""
    lanes, longest = len(lengths), int(lengths.max())
    order = np.argsort(-lengths, kind="stable")
    table = np.zeros((lanes, longest), dtype=np.int64)
    table[np.arange(longest) < lengths[:, None]] = steps
    table = np.ascontiguousarray(table[order].T)
    room = int((table & 31).sum(axis=0).max() * 1.01) // 16 + 8  # a step takes hardly more than its bits
    low, wide = np.zeros(lanes), np.full(lanes, _LEAST * _WORD)
    out, at = np.zeros(lanes * room, dtype=np.int64), np.arange(lanes) * room
    share = 0.5 ** np.arange(32)
    for t, m in enumerate(np.searchsorted(-lengths[order], -np.arange(longest), side="left").tolist()):
        s = table[t, :m]
        part = np.floor(wide[:m] * share.take(s & 31))
        low[:m] += part * (s >> 29)
        w = part * (s >> 5 & 0xFFFFFF)
        wide[:m] = w
        k = np.flatnonzero(w < _LEAST)
        while len(k):
            lo, w, to = low[k], wide[k] * _WORD, at[k]
            word = np.floor(lo / _LEAST)
            out[to] = word
            at[k] = to + 1
            low[k] = (lo - word * _LEAST) * _WORD
            wide[k] = w
            k = k[w < _LEAST]
    # two words that any others may follow; a word over 16 bits is a carry to the one before
    end = np.ceil(low / _WORD).astype(np.int64)
    out[at], out[at + 1] = end >> 16, end & 65535
    while True:
        k = np.flatnonzero(out >> 16)
        if not len(k):
            break
        carry = out[k] >> 16
        out[k] &= 65535
        out[k - 1] += carry
    counts = np.empty(lanes, dtype=np.int64)
    counts[order] = at + 2 - np.arange(lanes) * room
    sorted_out = np.empty((lanes, room), dtype="<u2")
    sorted_out[order] = out.reshape(lanes, room)
    return sorted_out[np.arange(room) < counts[:, None]], counts


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """A payload for each block of ids below 2**32."""
    full = [k for k, b in enumerate(blocks) if len(b)]
    out = [b""] * len(blocks)
    if not full:
        return out
    headers, steps, lengths = zip(*(_decisions(np.asarray(blocks[k], dtype=np.int64)) for k in full))
    words, counts = _write(np.concatenate(steps), np.concatenate(lengths))
    lane = at = 0
    for k, header, own in zip(full, headers, lengths):
        count = counts[lane : lane + len(own)]
        head = _pack([*header, count])
        out[k] = len(head).to_bytes(4, "little") + head + words[at : at + count.sum()].tobytes()
        lane, at = lane + len(own), at + int(count.sum())
    return out


class _Reader:
    """Lanes' ranges: code is the place in the range."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words, self.at = np.concatenate([words.astype(np.float64), np.zeros(4)]), np.cumsum(counts) - counts
        self.code, self.wide = np.zeros(len(counts)), np.full(len(counts), _LEAST * _WORD)
        for _ in range(3):
            self.code = self.code * _WORD + self.words.take(self.at, mode="clip")
            self.at += 1

    def narrow(self, k: np.ndarray, code: np.ndarray, wide: np.ndarray) -> None:
        """Lanes k get these; ranges that are small are renewed."""
        self.code[k], self.wide[k] = code, wide
        k = k[wide < _LEAST]
        while len(k):
            w = self.wide[k] * _WORD
            self.code[k] = self.code[k] * _WORD + self.words.take(self.at[k], mode="clip")
            self.wide[k] = w
            self.at[k] += 1
            k = k[(w < _LEAST) & (w > 0)]


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of payloads."""
    full = [k for k, n in enumerate(sizes) if n]
    out = [np.zeros(0, dtype=np.int64)] * len(sizes)
    if not full:
        return out
    models, words, counts, lengths = [], [], [], []
    for k in full:
        data, n = payloads[k], int(sizes[k])
        end = 4 + int.from_bytes(data[:4], "little")
        *header, count = _unpack(data[4:end])
        models.append(_Model.read(header))
        models[-1].tables()
        words.append(np.frombuffer(data, dtype="<u2", offset=end))
        counts.append(count)
        lengths.append(np.minimum(n - np.arange(0, n, LANE), LANE))
    # tables of all blocks one after the other: ids, places and slots are numbered through
    n_ids, n_places, n_slots, n_zero = (np.cumsum([0, *v]) for v in ([len(m.ids) + 1 for m in models], [len(m.size) for m in models], [len(m.slots) for m in models], [1 << m.bits0 for m in models]))
    ids = np.concatenate([np.append(m.ids, 0) for m in models])
    inverse = np.concatenate([1 / m.total for m in models])
    base = np.concatenate([m.base + s for m, s in zip(models, n_slots)])
    slots = np.concatenate([m.slots + p for m, p in zip(models, n_places)]).astype(np.int32)
    span = np.concatenate([np.stack([m.start, m.size], axis=1) for m in models]).astype(np.float64)
    tail = np.concatenate([np.concatenate([m.nexts + i, np.full(len(m.ids) + 1, -1)]) for m, i in zip(models, n_ids)])
    two = np.concatenate([np.concatenate([m.two, np.zeros(len(m.ids) + 1)]) for m in models]).astype(np.float64)
    target = np.concatenate([np.concatenate([m.target + p, np.zeros(len(m.ids) + 1, dtype=np.int64)]) for m, p in zip(models, n_places)])
    zero = np.concatenate([np.repeat(np.arange(len(m.ids)) + i, m.size0) for m, i in zip(models, n_ids)]).astype(np.int32)
    span0 = np.concatenate([np.stack([np.append(m.start0, 0), np.append(m.size0, 0)], axis=1) for m in models]).astype(np.float64)

    lanes_of = [len(v) for v in lengths]
    lengths = np.concatenate(lengths)
    reader = _Reader(np.concatenate(words), np.concatenate(counts))
    order = np.argsort(-lengths, kind="stable")
    lengths, reader.at, reader.code = lengths[order], reader.at[order], reader.code[order]
    block = np.repeat(np.arange(len(full)), lanes_of)[order]
    inverse0, top0, base0 = (np.array(v)[block] for v in ([1.0 / (1 << m.bits0) for m in models], [(1 << m.bits0) - 1.0 for m in models], n_zero[:-1]))
    x, place = n_ids[1:][block] - 1, n_places[1:][block] - 1
    found = np.zeros((int(lengths[0]), len(lengths)), dtype=np.int64)
    for t, m in enumerate(np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist()):
        chance = two.take(place[:m])
        rest = np.arange(m)
        k = np.flatnonzero(chance)
        if len(k):
            part, chance = np.floor(reader.wide[k] * (1 / 256)), chance[k]
            cut = part * chance
            hit = reader.code[k] < cut
            reader.narrow(k, reader.code[k] - np.where(hit, 0, cut), np.where(hit, cut, part * (256 - chance)))
            won = k[hit]
            place[won] = target.take(place[won])
            x[won] = tail.take(place[won])
            other = np.ones(m, dtype=bool)
            other[won] = False
            rest = np.flatnonzero(other)
        now = x[rest]
        share = inverse.take(now)
        part = np.floor(reader.wide[rest] * share)
        code = reader.code[rest]
        y = np.minimum(np.floor(code / part), 1 / share - 1).astype(np.int64)
        p = slots.take(base.take(now) + y)
        own = span.take(p, axis=0)
        reader.narrow(rest, code - part * own[:, 0], part * own[:, 1])
        now = tail.take(p)
        k = np.flatnonzero(now < 0)
        if len(k):
            own = rest[k]
            part = np.floor(reader.wide[own] * inverse0[own])
            code = reader.code[own]
            new = zero.take(base0[own] + np.minimum(np.floor(code / part), top0[own]).astype(np.int64))
            of = span0.take(new, axis=0)
            reader.narrow(own, code - part * of[:, 0], part * of[:, 1])
            now[k] = new
        place[rest], x[rest] = p, now
        found[t, :m] = x[:m]
    found = ids[found].T[np.argsort(order)]
    lane = 0
    for k, n in zip(full, lanes_of):
        out[k] = found[lane : lane + n].reshape(-1)[: sizes[k]] if found.shape[1] == LANE else found[lane, : sizes[k]]
        lane += n
    return out
