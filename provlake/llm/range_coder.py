"""An adaptive context-mixing range coder for token ids, many independent blocks in step.

The distribution of the next id is a mixture of three predictions: the id that followed the last two ids
before (order 2), the one that followed the last id (order 1), and a distribution over all ids (order 0).
The order-0 ids stand in two classes, common and rare ones, so there are four shares: order 2, order 1,
common, rare.  Two adaptive models give the shares, one by how often the two predictions were right
before and whether they agree, one by which shares the last two ids fell to; each block's weight between
the two moves towards the one that gave the coded share more.  Within a class an id takes its part of the
segment's order-0 counts (``Prior``), which stand once in front of the blocks.

Blocks have about BLOCK ids and a CRC-32 of them.  Every block starts from the same state, the prior and
even shares, so any block decodes alone.  numpy runs one step of all blocks of a group at once; nothing is
shared between blocks, so groups may have any size.  The coder has a 64-bit low end with carries into
the words written before, and writes 32 bits at a time.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
LANES = 2048
#: Bits of a class's total; of the shares' total; of the tables of predictions; rate of the shares.
_WIDE, _PART, _H1, _H2, _RATE = 18, 15, 9, 10, 5
#: Four 16-bit shares stand in one 64-bit word: their sum in each model, and its even start.
_SUM = 8064
_EVEN = np.uint64(sum((_SUM // 4) << (16 * i) for i in range(4)))
_GAIN = np.array([(_SUM >> _RATE) << (16 * i) for i in range(4)], np.uint64)


def _u(x: int) -> np.ndarray:
    """An operand without dimensions: numpy takes it faster than a number."""
    return np.array(x, np.uint64)


_KEEP, _ONES, _FIELD = _u(sum((0xFFFF >> _RATE) << (16 * i) for i in range(4))), _u(0x0001000100010001), _u(0xFFFF)
_U2, _U3, _USIZE, _PLACE = _u(2), _u(3), _u(2 + _WIDE), _u((1 << _WIDE) - 1)
_U4, _U5, _U16, _U32, _UPART, _URATE, _LIMIT = _u(4), _u(5), _u(16), _u(32), _u(_PART), _u(_RATE), _u(1 << 32)
_I2, _I3, _I5, _I7, _I12, _I16 = (np.array(i) for i in (2, 3, 5, 7, 12, 16))
_M1, _M2, _MUL = np.array((1 << _H1) - 1), np.array((1 << _H2) - 1), np.array(40503)
_W2, _W3, _W4 = (np.array(i, np.uint32) for i in (2, 3, 4))
#: How often a prediction was right, after it met an id (4: it was wrong).
_NEXT = np.array([1, 2, 3, 3, 0], np.uint32)
#: How far an id's place within its class narrows the range, by share.
_NARROW = np.array([0, 0, _WIDE, _WIDE], np.uint64)
_STEP = 8  # the models' weights move every so many ids


def _turn(rows: np.ndarray) -> np.ndarray:
    """A transposed copy, made in strips that stay in the processor's cache."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for i in range(0, len(rows), 32):
        out[:, i : i + 32] = rows[i : i + 32].T
    return out


class Prior:
    """Order-0 counts of a segment: class, start and size of each id, and the id at each place of a class."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        ids = np.flatnonzero(counts)
        order = ids[np.argsort(-counts[ids], kind="stable")]
        mass = np.cumsum(counts[order])
        half = int(np.searchsorted(mass, mass[-1] / 2)) + 1 if len(order) else 0
        # four tables in one: ids that neither prediction gives, then those of order 1, order 2 and both
        share, start, full = np.repeat([2, 1, 0, 0], 65536), np.zeros(4 * 65536, np.int64), np.ones(4 * 65536, np.int64)
        self.at = np.zeros(2 << _WIDE, np.uint16)
        for k, part in enumerate((np.sort(order[:half]), np.sort(order[half:]))):
            if not len(part):
                continue
            c = counts[part].astype(np.float64)
            size = np.maximum(1, np.floor(c * ((1 << _WIDE) - len(part)) / c.sum())).astype(np.int64)
            size[int(np.argmax(size))] += (1 << _WIDE) - int(size.sum())
            share[part], full[part] = 2 + k, size
            start[part] = np.cumsum(size) - size
            self.at[k << _WIDE : (k + 1) << _WIDE] = np.repeat(part, size)
        # 2 bits of share, then start, then size: one word to look up
        self.word = (share + (start << 2) + (full << (2 + _WIDE))).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Prior:
        return cls(np.bincount(ids, minlength=65536)[:65536])

    def pack(self) -> bytes:
        """Gaps between the ids that occur, then their counts, each in byte planes."""
        ids = np.flatnonzero(self.counts)
        gaps, counts = np.diff(ids, prepend=0).astype("<u4"), self.counts[ids].astype("<u4")
        planes = np.concatenate([x.view(np.uint8).reshape(-1, 4).T.ravel() for x in (gaps, counts)]) if len(ids) else np.zeros(0, np.uint8)
        return zlib.compress(planes.tobytes(), 9)

    @classmethod
    def unpack(cls, data: bytes) -> Prior:
        planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(2, 4, -1)
        gaps, counts = (np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes)
        full = np.zeros(65536, np.int64)
        full[np.cumsum(gaps)] = counts
        return cls(full)


class _Model:
    """Predictions and shares of n blocks; one step for all of them at a time."""

    def __init__(self, n: int) -> None:
        self.lane = np.arange(n)
        self.at1, self.at2 = self.lane << _H1, self.lane << _H2
        both = np.zeros((n << _H1) + (n << _H2), np.uint32)  # in one piece: large ones get large pages
        self.t1, self.t2 = both[: n << _H1], both[n << _H1 :]
        self.a, self.b = np.full(n * 16, _EVEN), np.full(n * 16, _EVEN)
        self.own = self.lane * 16
        self.hash = np.zeros(n, np.int64)
        self.place1, self.place2, self.in_b = self.at1, self.at2, self.own
        self.was, self.t = np.zeros(n, np.int64), 0
        self.score, self.weight, self.other = np.zeros(n, np.int64), np.full(n, 2, np.uint64), np.full(n, 2, np.uint64)

    def predict(self) -> None:
        self.e1, self.e2 = self.t1.take(self.place1, mode="clip"), self.t2.take(self.place2, mode="clip")
        self.in_a = ((self.e1 & _W3) + ((self.e2 & _W3) << _W2)).astype(np.int64)
        self.in_a += self.own
        self.pa, self.pb = self.a.take(self.in_a, mode="clip"), self.b.take(self.in_b, mode="clip")
        self.p = self.pa * self.weight
        self.p += self.pb * self.other
        self.sums = self.p * _ONES

    def bounds(self, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Low end and size of each block's share."""
        self.move = share.view(np.uint64) << _U4
        size = self.p >> self.move
        size &= _FIELD
        low = self.sums >> self.move
        low &= _FIELD
        low -= size
        return low, size

    def update(self, ids: np.ndarray, four: np.ndarray, share: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> None:
        """``four``: ids times four; ``d1``, ``d2``: what sets the predictions' entries apart from it."""
        self.t += 1
        if self.t % _STEP == 0:
            better = (self.pa >> self.move & _FIELD).view(np.int64) - (self.pb >> self.move & _FIELD).view(np.int64)
            self.score += better - (self.score >> _I3)
            self.weight = np.minimum(np.maximum((self.score >> _I12) + _I2, 1), 3).view(np.uint64)
            self.other = _U4 - self.weight
        gain = _GAIN.take(share, mode="clip")
        for table, at, p in ((self.a, self.in_a, self.pa), (self.b, self.in_b, self.pb)):
            loss = p >> _URATE
            loss &= _KEEP
            p -= loss
            p += gain
            table[at] = p
        for table, at, d in ((self.t1, self.place1, d1), (self.t2, self.place2, d2)):
            new = _NEXT.take(np.minimum(d, _W4), mode="clip")
            new += four
            table[at] = new
        own = ids * _MUL
        self.place1 = own >> _I5
        self.place1 &= _M1
        self.place1 += self.at1
        self.hash >>= _I3
        self.hash += own
        self.place2 = self.hash >> _I7
        self.place2 &= _M2
        self.place2 += self.at2
        self.hash = own
        self.was <<= _I2
        self.was &= _I12
        self.was += share
        self.in_b = self.was + self.own


class _Words:
    """The words written by n lanes; the last one of each lane waits here for carries."""

    def __init__(self, n: int, most: int) -> None:
        self.wide = most + 2
        self.flat, self.at = np.zeros(n * self.wide, np.uint32), np.arange(n) * self.wide
        self.last = np.zeros(n, np.uint32)  # at first the word in front of all, which no carry meets

    def carry(self, over: np.ndarray) -> None:
        """Add one to the lanes that are marked."""
        self.last += over.view(np.uint8)
        over = over & (self.last == 0)
        if over.any():  # the word was full: those before it take the carry
            k = self.at[over] - 1
            while len(k):
                self.flat[k] += 1
                k = k[self.flat[k] == 0] - 1

    def put(self, which: np.ndarray, low: np.ndarray) -> None:
        """The upper 32 bits of ``low`` are the next word of lanes ``which``."""
        at = self.at.take(which, mode="clip")
        self.flat[at] = self.last.take(which, mode="clip")
        self.at[which] = at + 1
        self.last[which] = low.take(which, mode="clip") >> _U32

    def of(self, lane: int) -> np.ndarray:
        at = self.at[lane]
        self.flat[at] = self.last[lane]
        return self.flat[lane * self.wide + 1 : at + 1]


def _encode_group(ids: np.ndarray, length: np.ndarray, prior: Prior) -> list[bytes]:
    """ids: lanes x steps; rows end with any id from ``length`` on."""
    n, steps = ids.shape
    m, words = _Model(n), _Words(n, steps)
    low, rng = np.zeros(n, np.uint64), np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    done = [b""] * n
    columns = _turn(ids)
    ends = set(length.tolist())
    for t in range(steps):
        x = columns[t].astype(np.int64)
        four = columns[t].astype(np.uint32) << _W2
        m.predict()
        d1, d2 = m.e1 ^ four, m.e2 ^ four
        kind = (d2 < _W4).view(np.uint8) << 1
        kind |= (d1 < _W4).view(np.uint8)
        place = kind.astype(np.int64)
        place <<= _I16
        place += x
        word = prior.word.take(place, mode="clip")
        share = (word & _U3).view(np.int64)
        a, size = m.bounds(share)
        r = rng >> _UPART
        rng = r * size
        a *= r
        r = rng >> _NARROW.take(share, mode="clip")
        start = word >> _U2
        start &= _PLACE
        start *= r
        a += start
        word >>= _USIZE
        rng = r * word
        low += a
        words.carry(low < a)
        small = rng < _LIMIT
        words.put(np.flatnonzero(small), low)
        shift = small.astype(np.uint64)
        shift <<= _U5
        low <<= shift
        rng <<= shift
        m.update(x, four, share, d1, d2)
        if t + 1 in ends:  # these lanes end here: two words fix their state
            for i in np.flatnonzero(length == t + 1).tolist():
                done[i] = words.of(i).astype("<u4").tobytes() + np.array([low[i] >> _U32, low[i] & (_LIMIT - _u(1))], "<u4").tobytes()
    return done


def _decode_group(data: list[bytes], length: np.ndarray, prior: Prior) -> np.ndarray:
    n, steps = len(data), int(length.max(initial=0))
    m = _Model(n)
    wide = max((len(d) for d in data), default=0) // 4 + 2
    words = np.zeros((n, wide), np.uint32)
    for i, d in enumerate(data):
        words[i, : len(d) // 4] = np.frombuffer(d, "<u4")
    flat, at, end = words.reshape(-1), m.lane * wide + 2, (m.lane + 1) * wide - 1
    rng = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    code = words[:, 0].astype(np.uint64) << _U32 | words[:, 1]  # less the low end, from here on
    out = np.zeros((steps, n), np.uint16)
    top = _u((1 << _WIDE) - 1)
    for t in range(steps):
        m.predict()
        r = rng >> _UPART
        v = code // r
        which = (v >= (m.sums & _FIELD)).view(np.uint8)
        which += (v >= (m.sums >> _U16 & _FIELD)).view(np.uint8)
        which += (v >= (m.sums >> _U32 & _FIELD)).view(np.uint8)
        share = which.astype(np.int64)
        a, size = m.bounds(share)
        a *= r
        code -= a
        rng = r * size
        r = rng >> _NARROW.take(share, mode="clip")
        # a share of class 0 or 1 leaves a place in the class, one of a prediction its id
        v = np.minimum(code // np.maximum(r, _u(1)), top).view(np.int64)
        v += (share & 1) << _WIDE
        x = prior.at.take(v, mode="clip").astype(np.int64)
        hit = which < 2
        place = hit.astype(np.int64)
        place <<= 17
        i = np.flatnonzero(hit)
        x[i] = np.where(which.take(i, mode="clip") == 0, m.e2.take(i, mode="clip"), m.e1.take(i, mode="clip")) >> _W2
        place += x
        word = prior.word.take(place, mode="clip")
        start = word >> _U2
        start &= _PLACE
        start *= r
        code -= start
        word >>= _USIZE
        rng = r * word
        small = rng < _LIMIT
        shift = small.astype(np.uint64)
        shift <<= _U5
        rng <<= shift
        code <<= shift
        i = np.flatnonzero(small)
        k = at.take(i, mode="clip")
        at[i] = k + 1
        code[i] |= flat.take(np.minimum(k, end.take(i, mode="clip")), mode="clip")
        four = x.astype(np.uint32) << _W2
        m.update(x, four, share, m.e1 ^ four, m.e2 ^ four)
        out[t] = x
    return _turn(out)


def _groups(blocks: int):
    count = -(-blocks // LANES)
    cuts = [blocks * i // count for i in range(count + 1)] if count else [0]
    return zip(cuts, cuts[1:])


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, list[bytes], list[int], list[int]]:
    """The packed prior, and payload, number of ids and CRC-32 of each block of ``ids`` (0 to 65535)."""
    n = len(ids)
    if n and (int(ids.max()) > 0xFFFF or int(ids.min()) < 0):
        raise ValueError("ids must lie in 0 .. 65535")
    prior = Prior.of(ids)
    blocks = -(-n // block)
    cuts = [n * i // blocks for i in range(blocks + 1)] if blocks else [0]
    length = np.diff(np.array(cuts, np.int64))
    out: list[bytes] = []
    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
    for a, b in _groups(blocks):
        rows = np.zeros((b - a, int(length[a:b].max())), np.uint16)
        for i in range(a, b):
            rows[i - a, : length[i]] = ids[cuts[i] : cuts[i + 1]]
        out += _encode_group(rows, length[a:b], prior)
    return prior.pack(), out, length.tolist(), sums


def decode(prior: bytes, payload: list[bytes], length: list[int], sums: list[int]) -> np.ndarray:
    """The ids of the blocks, one after the other; a block with a wrong checksum is an error."""
    out, known = [], Prior.unpack(prior)
    for a, b in _groups(len(payload)):
        size = np.array(length[a:b], np.int64)
        got = _decode_group(payload[a:b], size, known)
        for i in range(b - a):
            ids = got[i, : size[i]].astype("<u4")
            if zlib.crc32(ids.tobytes()) != sums[a + i]:
                raise ValueError(f"block {a + i}: wrong checksum")
            out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, "<u4")
