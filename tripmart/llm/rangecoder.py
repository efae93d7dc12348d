"""An adaptive range coder for token ids, in independent blocks.

Each id is predicted in three ways: the id that followed the last two ids (order 2), the one that followed the last id
(order 1), and a frequency table (order 0). Their distributions are mixed into one: the two predicted ids get shares by
how often predictions of that confidence were right so far, the table gets the rest. The mixed distribution drives one
arithmetic-coding step per id. Everything is learned within a block and starts anew in the next, so that blocks can be
read alone; each names the ids that it has, which alone have a place in its table, and carries checksums.

The ids of a block are dealt to lanes that are coded side by side under one model, and blocks are coded many at a time,
which lets every step work on arrays.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"TID3"
BLOCK_IDS = 1 << 16
LANE_IDS, MAX_LANES = 128, 512
#: Blocks coded together; this bounds the memory, not the result.
GROUP = 32
#: Slots for the contexts of order 1 and 2.
CONTEXTS = 1 << 14, 1 << 16
_TOTAL_BITS = 24
_TOTAL = 1 << _TOTAL_BITS
#: An interval narrower than ``_NARROW`` is widened by a digit; it is then never too narrow again, nor above 52 bits.
_DIGIT_BITS = 24
_DIGIT = (1 << _DIGIT_BITS) - 1
_NARROW = 1 << 28
_STEP = 12
_CONFIDENCE = 16
_ID_BITS = 20
#: Counts that share an entry of the decoder's jump table, as a power of two.
_JUMP_BITS = 4
_ID_MASK = (1 << _ID_BITS) - 1
_STATES = 2 * _CONFIDENCE * _CONFIDENCE
_HEADER = struct.Struct("<4sIIIIII")


class BlockError(ValueError):
    """A block that is damaged."""


def _trusts() -> np.ndarray:
    """For each state and outcome, what each of the two slots holds above its id from now on, as a pair in one number;
    below 0: it takes the new id."""
    state, outcome = np.divmod(np.arange(_STATES * 4), 4)
    same, held = state & 1, ((state >> 1) & (_CONFIDENCE - 1), state >> 5)
    hits = (outcome == 2) | ((outcome == 0) & (same == 1)), outcome == 0
    after = (np.where(hit, np.minimum(t + 1, _CONFIDENCE - 1), t >> 1) << _ID_BITS for t, hit in zip(held, hits, strict=True))
    pair = [np.where(hit | (t > 1), a, -1 << 31).astype(np.int32) for t, hit, a in zip(held, hits, after, strict=True)]
    return np.stack(pair, axis=1).view(np.int64).reshape(-1)


_TRUSTS = _trusts()


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values[at]`` for places that are known to be there; twice as fast as a checked one."""
    return values.take(at, mode="clip")


def _chosen(mask: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``one`` where the mask is -1, ``other`` where it is 0; four times as fast as ``np.where`` if they alternate at random."""
    return other ^ ((one ^ other) & mask)


class _Model:
    """The predictions for a group of blocks with ``held`` symbols each. ``block`` is the block of each lane; symbols and
    counts fit 32 bits.

    A context's slot holds the predicted id and, above ``_ID_BITS``, how far it is trusted. Shares and counts are taken
    up by ``refresh`` only, so a step is a few lookups and two stores.
    """

    def __init__(self, held: list[int], block: np.ndarray, searched: bool = False):
        blocks, symbols = len(held), max(held)
        self.blocks, self.symbols, self.searched = blocks, symbols, searched
        self.row = symbols + (1 << _JUMP_BITS)
        # One piece of memory: numpy asks the system for large pages, in which places at random are found sooner.
        ends = np.cumsum([blocks * n for n in (*CONTEXTS, 2 * self.row)])
        *self.slots, tables = np.split(np.zeros(ends[-1], dtype=np.int32), ends[:-1])
        self.counts, self.sums = tables.reshape(2, blocks, self.row)
        self.counts += np.arange(self.row) < np.array(held)[:, None]
        #: Sums of counts; what follows a block's last is above every count.
        self.sums[:, 1:] = 1 << 30
        self.flat_sums = self.sums.reshape(-1)
        self.right = [np.full(blocks * _STATES, 0.4) for _ in range(2)]
        self.tried = [np.full(blocks * _STATES, 1.0) for _ in range(2)]
        self.at_one, self.at_two, self.at_state = (block * n for n in (*CONTEXTS, _STATES))
        self.block, self.at_sum = block, block * self.row
        #: Since the last refresh: places in the table of ids that were not predicted, and states with their outcomes.
        self.missed: list[np.ndarray] = []
        self.seen: list[np.ndarray] = []
        self.refresh()

    def refresh(self) -> None:
        """Takes what was seen since the last time into the table and the shares."""
        if self.seen:
            np.add.at(self.counts.reshape(-1), np.concatenate(self.missed), np.int32(_STEP))
            outcome = np.concatenate(self.seen)
            self.missed, self.seen = [], []
            by = np.bincount(outcome, minlength=self.blocks * _STATES * 4).reshape(-1, 4)
            self.tried[1] += by.sum(axis=1)
            self.right[1] += by[:, 0]
            self.tried[0] += by[:, 2] + by[:, 3]
            self.right[0] += by[:, 2]
        np.cumsum(self.counts[:, : self.symbols], axis=1, out=self.sums[:, 1 : self.symbols + 1])
        size = self.sums[:, self.symbols].astype(np.int64)
        if self.searched:
            # For each run of counts, the last sum that is not above its begin; the blocks' runs follow each other.
            runs = (size >> _JUMP_BITS) + 2
            ends = np.cumsum(runs)
            self.at_jump = _take(ends - runs, self.block)
            run = ((self.sums + ((1 << _JUMP_BITS) - 1)) >> _JUMP_BITS) + (ends - runs)[:, None]
            run = np.minimum(run, ends[:, None] - 1)
            self.jumps = np.cumsum(np.bincount(run.reshape(-1), minlength=ends[-1]), dtype=np.int32)
            self.jumps -= 1
        second, first = (np.minimum(self.right[k] / self.tried[k], 0.875) for k in (1, 0))
        share2 = (second * _TOTAL).astype(np.int64)
        # Neither share is ever empty, and the table keeps at least a sixteenth, more than it has counts.
        share1 = np.minimum((first * (_TOTAL - share2)).astype(np.int64), _TOTAL * 15 // 16 - share2)
        share1[1::2] = 0
        both = share2 + share1
        self.shares = both << _TOTAL_BITS | share2
        #: What a count of the table is worth.
        self.worth = (_TOTAL - both) / np.repeat(size, _STATES)

    def predict(self, k: int, last: np.ndarray, before: np.ndarray):
        """For the first ``k`` lanes: slots, predicted ids and whether they are one, state, and where their shares end."""
        one = self.at_one[:k] + (last & (CONTEXTS[0] - 1))
        two = self.at_two[:k] + (((last * 40503 + before * 60493) ^ (before >> 4)) & (CONTEXTS[1] - 1))
        held1, held2 = _take(self.slots[0], one), _take(self.slots[1], two)
        guess1, guess2 = held1 & _ID_MASK, held2 & _ID_MASK
        same = guess1 == guess2
        state = self.at_state[:k] + (((held2 >> _ID_BITS) << 5) | ((held1 >> _ID_BITS) << 1) | same)
        shares = _take(self.shares, state)
        return one, two, guess1, guess2, same, state, shares & (_TOTAL - 1), shares >> _TOTAL_BITS

    def place(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The place in ``flat_sums`` of the last count that is not above the target, in the blocks of the lanes ``at``.

        A run of counts begins with a known symbol and has at most as many symbols as counts.
        """
        place = _take(self.jumps, _take(self.at_jump, at) + (target >> _JUMP_BITS)).astype(np.int64)
        target = target.astype(np.int32)
        half = 1 << (_JUMP_BITS - 1)
        while half:
            place += (_take(self.flat_sums, place + half) <= target) * np.int64(half)
            half //= 2
        return place

    def spans(self, place: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the symbols at these places of ``flat_sums`` begin and end in the table's share."""
        begin, end = _take(self.flat_sums, place) * worth, _take(self.flat_sums, place + 1) * worth
        return begin.astype(np.int64), end.astype(np.int64)

    def symbols_at(self, at: np.ndarray, rest: np.ndarray, above: np.ndarray, worth: np.ndarray):
        """Of the lanes ``at``, whose values are ``rest`` beyond ``above``: where the symbol begins and ends, and its place."""
        place = self.place(at, ((rest + 1) / worth).astype(np.int64))
        while True:
            begin, end = self.spans(place, worth)
            # The quotient is rounded, so the symbol may be a neighbour.
            moves = (rest >= end).view(np.int8) - (rest < begin).view(np.int8)
            if not moves.any():
                return above + begin, above + end, place
            place += moves

    def update(self, ids: np.ndarray, found, hit2: np.ndarray, hit1: np.ndarray, missed: np.ndarray) -> None:
        """``hit2``: the first prediction was right; ``hit1``: the second was, and the first was not; ``missed``: the places of
        the other ids."""
        one, two, guess1, guess2, same, state, _, _ = found
        # 0: first right; 1: first wrong and the second the same; 2: second right; 3: both wrong.
        outcome = (~hit2).view(np.int8) * (3 - hit1.view(np.int8) - 2 * same.view(np.int8))
        seen = (state << 2) + outcome
        trusts = _take(_TRUSTS, seen & (4 * _STATES - 1)).view(np.int32).reshape(-1, 2)
        for slots, trust, at, guess in zip(self.slots, trusts.T, (one, two), (guess1, guess2), strict=True):
            slots[at] = _chosen(trust >> 31, ids, guess) | (trust & ~(-1 << 31))
        self.seen.append(seen)
        self.missed.append(missed)


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a // b`` of whole numbers from 0, below 2 ** 53 in sum. The quotient as a double is then never rounded up to the next
    whole number, and is much faster than a division of integers."""
    return (a / b).astype(np.int64)


def _refresh_due(step: int) -> bool:
    return step in (1, 4, 16) or step % 32 == 0 < step


@dataclass
class _Lanes:
    """Which ids of which block each lane holds, longest first."""

    block: np.ndarray
    start: np.ndarray
    length: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, sizes: list[int], lanes: list[int]) -> _Lanes:
        block = np.repeat(np.arange(len(sizes)), lanes)
        number = np.concatenate([np.arange(n) for n in lanes])
        size, many = np.array(sizes)[block], np.array(lanes)[block]
        length = size // many + (number < size % many)
        start = number * (size // many) + np.minimum(number, size % many)
        order = np.argsort(-length, kind="stable")
        return cls(block[order], start[order], length[order], order)

    def active(self) -> list[int]:
        """How many lanes have an id at each step."""
        return np.searchsorted(-self.length, -np.arange(self.length[0]), "left").tolist()


def lanes_for(size: int) -> int:
    return max(1, min(MAX_LANES, size // LANE_IDS))


def encode_blocks(blocks: list[np.ndarray], symbols: int) -> list[bytes]:
    """The blocks as bytes. A block holds 1 to ``BLOCK_IDS`` ids below ``symbols``."""
    return [out for k in range(0, len(blocks), GROUP) for out in _encode_group(blocks[k : k + GROUP], symbols)]


def _numbered(block: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Which ids the block has, and the block in numbers of these: a block has far fewer than there are, so that its tables
    are small and give no share to the others."""
    there = np.zeros(symbols, dtype=bool)
    there[block] = True
    return there, _take(np.cumsum(there, dtype=np.int32) - np.int32(1), block)


def _encode_group(blocks: list[np.ndarray], symbols: int) -> list[bytes]:
    sizes = [len(b) for b in blocks]
    many = [lanes_for(n) for n in sizes]
    lanes = _Lanes.of(sizes, many)
    kept, numbered = zip(*(_numbered(block, symbols) for block in blocks), strict=True)
    flat = np.concatenate(numbered)
    first = np.concatenate([[0], np.cumsum(sizes)])[lanes.block] + lanes.start
    n, steps = len(lanes.block), int(lanes.length[0])
    # A row for each step; lanes that have ended are not looked at.
    dealt = flat.take(first + np.arange(steps)[:, None], mode="clip")
    model = _Model([int(k.sum()) for k in kept], lanes.block)
    low, width = np.zeros(n, dtype=np.int64), np.full(n, 1 << 2 * _DIGIT_BITS, dtype=np.int64)
    # Digits may hold a carry until the end; those that are not marked do not count.
    digits, marked = np.zeros((steps + 2, n), dtype=np.int32), np.zeros((steps + 2, n), dtype=bool)
    last, before = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    for step, k in enumerate(lanes.active()):
        if _refresh_due(step):
            model.refresh()
        ids = dealt[step, :k]
        found = model.predict(k, last[:k], before[:k])
        guess1, guess2, _, state, share2, both = found[2:]
        hit2 = ids == guess2
        hit1 = (ids == guess1) & ~hit2
        first2 = -hit2.astype(np.int64)
        begin, end = share2 & ~first2, _chosen(first2, share2, both)
        other = np.flatnonzero(~(hit2 | hit1))
        above, worth = _take(both, other), _take(model.worth, _take(state, other))
        place = _take(model.at_sum[:k] + ids, other)
        begin[other], end[other] = (above + x for x in model.spans(place, worth))
        unit = width[:k] >> _TOTAL_BITS
        low[:k] += unit * begin
        unit *= end - begin
        due = np.less(unit, _NARROW, out=marked[step, :k]).astype(np.int64)
        shift = due * _DIGIT_BITS
        np.right_shift(low[:k], _DIGIT_BITS, out=digits[step, :k], casting="unsafe")
        low[:k] = (low[:k] & ((due - 1) | _DIGIT)) << shift
        np.left_shift(unit, shift, out=width[:k])
        model.update(ids, found, hit2, hit1, place)
        before[:k], last[:k] = last[:k], ids
    digits[steps], digits[steps + 1] = low >> _DIGIT_BITS, low & _DIGIT
    marked[steps:] = True
    # In the order of the blocks and their lanes, without gaps. A lane's first digit has no carry.
    back = np.argsort(lanes.order)
    counted = marked[:, back]
    filled = counted.sum(axis=0)
    packed = digits[:, back].T[counted.T]
    while (packed > _DIGIT).any():
        carry = packed[1:] >> _DIGIT_BITS
        packed &= _DIGIT
        packed[:-1] += carry
    octets = packed.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    out = []
    lane, digit = 0, 0
    for block, n_lanes, there in zip(blocks, many, kept, strict=True):
        held = filled[lane : lane + n_lanes]
        alphabet = zlib.compress(np.packbits(there).tobytes())
        body = alphabet + held.astype("<u2").tobytes() + octets[digit : digit + int(held.sum())].tobytes()
        lane, digit = lane + n_lanes, digit + int(held.sum())
        raw = zlib.crc32(block.astype("<u4").tobytes())
        out.append(_HEADER.pack(MAGIC, len(block), n_lanes, symbols, len(alphabet), raw, zlib.crc32(body)) + body)
    return out


def decode_blocks(payloads: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ``BlockError`` for a damaged one."""
    return [out for k in range(0, len(payloads), GROUP) for out in _decode_group(payloads[k : k + GROUP])]


def _decode_group(payloads: list[bytes]) -> list[np.ndarray]:
    heads, bodies = [], []
    for payload in payloads:
        head, body = _HEADER.unpack_from(payload), payload[_HEADER.size :]
        if head[0] != MAGIC or zlib.crc32(body) != head[6]:
            raise BlockError("a block does not match its checksum")
        heads.append(head)
        bodies.append(body)
    alphabets = [
        np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(body[: head[4]]), dtype=np.uint8), count=head[3])).astype(np.int32)
        for head, body in zip(heads, bodies, strict=True)
    ]
    bodies = [body[head[4] :] for head, body in zip(heads, bodies, strict=True)]
    sizes, many = [h[1] for h in heads], [h[2] for h in heads]
    lanes = _Lanes.of(sizes, many)
    counts = [np.frombuffer(b, dtype="<u2", count=m).astype(np.int64) for b, m in zip(bodies, many, strict=True)]
    octets = [np.frombuffer(b, dtype=np.uint8, offset=2 * m).reshape(-1, 3) for b, m in zip(bodies, many, strict=True)]
    octets = np.concatenate([*octets, np.zeros((1, 3), dtype=np.uint8)])
    digits = np.zeros((len(octets), 4), dtype=np.uint8)
    digits[:, :3] = octets
    digits = digits.view("<u4").reshape(-1).astype(np.int64)
    every = np.concatenate(counts)
    place = (np.cumsum(every) - every)[lanes.order]
    n, steps = len(lanes.block), int(lanes.length[0])
    model = _Model([len(a) for a in alphabets], lanes.block, searched=True)
    code = digits[place] << _DIGIT_BITS | digits[place + 1]
    place += 2
    width = np.full(n, 1 << 2 * _DIGIT_BITS, dtype=np.int64)
    last, before = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    result = np.zeros((steps, n), dtype=np.int32)
    for step, k in enumerate(lanes.active()):
        if _refresh_due(step):
            model.refresh()
        found = model.predict(k, last[:k], before[:k])
        guess1, guess2, _, state, share2, both = found[2:]
        unit = width[:k] >> _TOTAL_BITS
        value = np.minimum(_divided(code[:k], unit), _TOTAL - 1)
        hit2 = value < share2
        hit1 = (value < both) & ~hit2
        first2 = -hit2.astype(np.int64)
        begin, end = share2 & ~first2, _chosen(first2, share2, both)
        ids = _chosen(first2.astype(np.int32), guess2, guess1)
        other = np.flatnonzero(value >= both)
        above, worth = _take(both, other), _take(model.worth, _take(state, other))
        begin[other], end[other], missed = model.symbols_at(other, _take(value, other) - above, above, worth)
        ids[other] = missed - _take(model.at_sum, other)
        code[:k] -= unit * begin
        unit *= end - begin
        due = (unit < _NARROW).astype(np.int64)
        shift = due * _DIGIT_BITS
        code[:k] = (code[:k] << shift) | (_take(digits, place[:k]) & -due)
        place[:k] += due
        np.left_shift(unit, shift, out=width[:k])
        model.update(ids, found, hit2, hit1, missed)
        before[:k], last[:k] = last[:k], ids
        result[step, :k] = ids
    out = []
    back = np.argsort(lanes.order)
    ends = np.cumsum(many)
    for number, head in enumerate(heads):
        rows = back[ends[number] - many[number] : ends[number]]
        held = np.arange(steps)[None, :] < lanes.length[rows][:, None]
        ids = alphabets[number].take(result[:, rows].T[held])
        if zlib.crc32(ids.astype("<u4").tobytes()) != head[5]:
            raise BlockError("a block's ids do not match their checksum")
        out.append(ids)
    return out
