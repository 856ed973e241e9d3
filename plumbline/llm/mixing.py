"""Logistic mixing of hashed-context bit predictors over the bytes of texts.

A text is coded bit by bit: its words, each with a blank behind it, and a line feed for its end. Each
predictor counts zeros and ones after a context, hashed into a table whose size is chosen in steps by
the number of distinct words: no context, one to four bytes before, the word before with the word so
far, and the word so far. Contexts of bytes run over word borders; none reaches across the start of a
text. One more input is the bit that followed the same bytes where they last stood in the same text.

The predictors' log odds are combined by weights which a gate (place of the byte in the word, how
often the word so far was seen) selects; weights are learned online, first by blocks of bytes, then by
groups of rows, one occurrence of what is coded left out of the counts. A row are the bytes of some
texts that are equal in all but the word before and the repetition. A last table refines the mixed probability by what followed
it before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from plumbline.llm.tokens import Powers, mixed

BITS = (8, 16, 18, 20, 20, 20, 20)
#: The predictor that knows the word before, and the others.
BEFORE = 5
OTHERS = [i for i in range(len(BITS)) if i != BEFORE]
OFFSETS = np.concatenate(([0], np.cumsum([1 << b for b in BITS])))
SLOTS = int(OFFSETS[-1])
#: Slots of the first two predictors, whose trees are of whole bytes.
WHOLE = int(OFFSETS[2])
#: Steps by which the tables of longer contexts double, each with its number of slots.
LARGEST = 2
#: Slots of the word's table for each distinct word, at least, until the last step.
SLOTS_A_WORD = 4
TRUST = 8
GATES, STEPS = 4 * TRUST, 33
PRIOR, RATE = 0.1, 0.5
#: Bytes that are learned from together, bytes that are coded together, and bytes that must agree
#: before a text is expected to go on as it did.
TOGETHER, CODED, MATCHED = 1 << 11, 1 << 11, 6

END = b"\n"
_BLANK = 32
#: Blocks of a mixer that it learns from one by one, blocks after which a step is half as large, and how much larger
#: steps are for whole rows, which have more bytes and are dealt at random.
ALONE, HALF, LARGER = 64, 200, 4
#: Rows of equal contexts that are read together and that are added together, and numbers that are mixed together.
ROWS, ADDED, MIXED = 1 << 12, 1 << 13, 1 << 14
#: Bytes of a processor's line of cache, or of two; tables begin there, so that half a byte's slots fill whole lines.
LINE = 128
#: Steps of the mixed log odds between which a code's length is not told apart, up to the greatest.
GRID, GREATEST = 128, 12
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_UPPER = np.uint64(1 << 48)
_NODES = np.arange(256, dtype=np.uint64) * _GOLDEN
#: Of each byte its bits, the nodes of the tree of bits that they leave, the nodes within a half of the byte,
#: and the hashes of what stands before each half.
_BIT = (np.arange(256)[:, None] >> (7 - np.arange(8))) & 1
_NODE = (1 << np.arange(8)) | (np.arange(256)[:, None] >> (8 - np.arange(8)))
_WITHIN = np.where(np.arange(8) < 4, _NODE, _NODE & ((1 << np.arange(8) % 4) - 1) | 1 << np.arange(8) % 4)
_SPREAD = _NODES[_NODE[:, [0, 4]]]
#: The halves themselves.
_HALF = np.stack((np.arange(256) >> 4, np.arange(256) & 15), axis=1)
#: The same nodes for tables of two numbers, by the bit.
_JUDGED = 2 * _WITHIN + _BIT
#: Bits as 1 and -1, and up to which bit two bytes agree, by their difference.
_SIGN = (2 * _BIT - 1).astype(np.float32)
_AGREE = (_NODE == 1 << np.arange(8)).astype(np.float32)


def sizes_of(step: int) -> tuple[int, ...]:
    """The tables' sizes in bits; the first three predictors have few contexts."""
    return (*BITS[:3], *(b + step for b in BITS[3:]))


def slots_of(step: int) -> int:
    return sum(1 << b for b in sizes_of(step))


def step_for(distinct: int) -> int:
    """The step of table size for so many distinct words."""
    step = 0
    while step < LARGEST and distinct * SLOTS_A_WORD > 1 << (BITS[-1] + step):
        step += 1
    return step


def step_of(tables: np.ndarray) -> int:
    """The step that tables were made with."""
    return next(e for e in range(LARGEST + 1) if slots_of(e) == tables.shape[-1])


@dataclass
class Events:
    """Bits of some texts: slots by predictor, the bit, the gate, the text it belongs to, and the bit
    that is expected by repetition as 1 or -1, 0 for none."""

    slots: np.ndarray
    bit: np.ndarray
    place: np.ndarray
    word: np.ndarray
    match: np.ndarray


@dataclass
class Stream:
    """Bytes of some texts. Equal bytes behind the same four bytes and the same word so far are one row with the
    hashes of its contexts: row ``r`` are the bytes ``order[starts[r]:starts[r + 1]]``."""

    data: np.ndarray
    text: np.ndarray
    #: Of each byte the hash of the word before.
    prior: np.ndarray
    order: np.ndarray
    starts: np.ndarray
    value: np.ndarray
    place: np.ndarray
    before: np.ndarray
    contexts: np.ndarray
    #: Of each word its first byte, its size and its hash.
    first: np.ndarray
    length: np.ndarray
    whole: np.ndarray
    expected: np.ndarray
    sizes: tuple[int, ...]

    def slots(self, i: int, rows: np.ndarray | slice, judged: bool = False) -> np.ndarray:
        """Slots of predictor ``i`` at rows; in tables of two numbers by the bit, those of its own bits."""
        byte = self.value[rows]
        if i >= 2:
            return _hashed(self.contexts[min(i, BEFORE) - 2][rows], byte, self.sizes, i, judged)
        slots = _NODE.take(byte, axis=0)
        if i == 1:
            slots += ((self.before[rows] << 8) + (1 << self.sizes[0]))[:, None]
        if judged:
            slots *= 2
            slots += _BIT.take(byte, axis=0)
        return slots

    def slots_before(self, at: np.ndarray, rows: np.ndarray, judged: bool = False) -> np.ndarray:
        """Slots of the predictor that knows the word before, at bytes and their rows."""
        context = self.prior.take(at)
        context += self.contexts[-1].take(rows)
        return _hashed(_mix(context), self.value.take(rows), self.sizes, BEFORE, judged)

    def matched(self, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some bytes were expected to be any, and their bits that were."""
        expected = self.expected.take(at)
        some = np.flatnonzero(expected >= 0)
        own = expected.take(some)
        return some, _SIGN.take(own, axis=0) * _AGREE.take(own ^ self.value.take(rows.take(some)), axis=0)

    @cached_property
    def row(self) -> np.ndarray:
        """The row of each byte."""
        row = np.empty(len(self.order), dtype=np.int64)
        row[self.order] = np.repeat(np.arange(len(self.value)), np.diff(self.starts))
        return row

    def events(self, a: int, b: int) -> Events:
        """The bits of bytes ``a`` to ``b``."""
        at, rows = np.arange(a, b), self.row[a:b]
        slots = [self.slots_before(at, rows) if i == BEFORE else self.slots(i, rows) for i in range(len(self.sizes))]
        match = np.zeros((b - a, 8), dtype=np.float32)
        some, expected = self.matched(at, rows)
        match[some] = expected
        return Events(
            np.stack(slots).reshape(len(self.sizes), -1),
            _BIT.take(self.data[a:b], axis=0).reshape(-1),
            np.repeat(self.place.take(rows), 8),
            np.repeat(self.text[a:b], 8),
            match.reshape(-1),
        )

    def blocks(self, most: int) -> Iterator[Events]:
        for a in range(0, len(self.data), most):
            yield self.events(a, min(a + most, len(self.data)))

    def groups(self, start: int = 0) -> Iterator[tuple[slice, list[tuple[np.ndarray, np.ndarray]]]]:
        """Rows that fit the cache together, with the bytes from ``start`` on that are theirs and the rows of these,
        some bytes at a time."""
        for low in range(0, len(self.value), ROWS):
            high = min(low + ROWS, len(self.value))
            at = self.order[self.starts[low] : self.starts[high]]
            rows = np.repeat(np.arange(low, high), np.diff(self.starts[low : high + 1]))
            if start:
                kept = at >= start
                at, rows = at[kept], rows[kept]
            yield slice(low, high), [(at[a : a + CODED], rows[a : a + CODED]) for a in range(0, len(at), CODED)]


def _in_order(key: np.ndarray) -> np.ndarray:
    """What a stable argsort gives, by two sorts that are much faster together."""
    order = np.argsort(key)
    ranks = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0) << 32
    ranks |= order
    ranks.sort()
    return ranks & ((1 << 32) - 1)


def in_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a stable argsort gives, and which of the sorted keys are not equal to the one before.

    The upper bits of keys sort together with their numbers, unless different keys share them."""
    bits = np.uint64(len(key).bit_length())
    packed = key >> bits << bits
    packed |= np.arange(len(key), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    packed >>= bits
    new = np.ones(len(key), dtype=bool)
    found = key.take(order)
    new[1:] = found[1:] != found[:-1]
    if (new[1:] != (packed[1:] != packed[:-1])).any():
        order = _in_order(key)
        new[1:] = np.diff(key.take(order)) != 0
    return order, new


def _halves(context: np.ndarray, byte: np.ndarray, sizes: tuple[int, ...], i: int, judged: bool = False) -> np.ndarray:
    """Where the slots of each half of a byte begin, which lie side by side."""
    hashed = context[:, None] + _SPREAD.take(byte, axis=0)
    hashed >>= np.uint64(64 - sizes[i] + 4)
    hashed <<= np.uint64(4 + judged)
    hashed += np.uint64(sum(1 << n for n in sizes[:i]) << judged)
    return hashed.view(np.int64)


def _hashed(context: np.ndarray, byte: np.ndarray, sizes: tuple[int, ...], i: int, judged: bool = False) -> np.ndarray:
    """Slots of predictor ``i`` for contexts and their bytes."""
    slots = np.repeat(_halves(context, byte, sizes, i, judged).reshape(-1), 4).reshape(-1, 8)
    slots += (_JUDGED if judged else _WITHIN).take(byte, axis=0)
    return slots


def _mix(x: np.ndarray) -> np.ndarray:
    """:func:`plumbline.llm.tokens.mixed` in place, some numbers at a time, which stay in the cache."""
    for a in range(0, len(x), MIXED):
        own = x[a : a + MIXED]
        upper = own >> np.uint64(33)
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            own ^= upper
            own *= np.uint64(factor)
            np.right_shift(own, np.uint64(33), out=upper)
        own ^= upper
    return x


def _expected(data: np.ndarray, four: np.ndarray, start: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of each byte the one that came where the same bytes stood last in the same text, -1 without. ``four`` are the
    four bytes before each byte."""
    expected = np.full(len(data), -1, dtype=np.int16)
    if len(data) <= MATCHED:
        return expected
    enough = np.ones(len(data), dtype=bool)
    early = (start[:, None] + np.arange(MATCHED)).reshape(-1)
    enough[early[early < len(data)]] = False
    some = np.flatnonzero(enough)
    # The six bytes before and the text; products with an odd number are as different as their factors.
    key = (four[2:-2] >> np.uint32(16)).astype(np.uint64) << np.uint64(32)
    key |= four[4:]
    key *= _GOLDEN
    if start.size >> 16:
        key = mixed(key)
        key += text[4:].astype(np.uint64) * _GOLDEN
    else:
        key += text[4:].astype(np.uint64) * _UPPER
    order, new = in_order(key.take(some - 4))
    order = some.take(order)
    later = np.flatnonzero(~new)
    expected[order.take(later)] = data.take(order.take(later - 1))
    return expected


def _four(data: np.ndarray) -> np.ndarray:
    """The four bytes before each byte, the last of them lowest, whatever text they are of."""
    two = np.zeros(len(data), dtype=np.uint16)
    two[1:] = data[:-1]
    two[2:] |= data[:-2].astype(np.uint16) << np.uint16(8)
    four = two.astype(np.uint32)
    four[2:] |= two[:-2].astype(np.uint32) << np.uint32(16)
    return four


def stream(texts: list[bytes], powers: Powers, step: int = 0, repeats: bool = True) -> Stream:
    """Texts end with a line feed; a word alone gets its blank. Without ``repeats`` no byte is expected."""
    coded = [t if t.endswith(END) else t + b" " for t in texts]
    data = np.frombuffer(b"".join(coded), dtype=np.uint8)
    sizes = np.array([len(t) for t in coded], dtype=np.int64)
    n = len(data)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    start = np.cumsum(sizes) - sizes
    up, down = powers.upto(n + 1)
    coefficients = data.astype(np.uint64)
    coefficients += np.uint64(1)
    coefficients *= up[:n]
    running = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(coefficients, out=running[1:])
    opens = np.zeros(n, dtype=bool)
    opens[1:] = data[:-1] == _BLANK
    opens[start] = True
    first = np.flatnonzero(opens)
    length = np.diff(first, append=n)
    behind, back = running[first], down[first]
    whole = (running[first + length] - behind) * back
    last = np.zeros(len(first), dtype=np.uint64)
    last[1:] = whole[:-1]
    last[first == start[text[first]]] = 0
    place = np.full(n, 3, dtype=np.int8)
    for k in (2, 1, 0):
        place[first[length > k] + k] = k
    four = _four(data)
    expected = _expected(data, four, start, text) if repeats else np.full(n, -1, dtype=np.int16)
    # The four bytes before each byte, as far as they are of its text.
    before = four
    for k in range(4):
        early = start + k
        before[early[early < n]] &= np.uint32((1 << 8 * k) - 1)
    sofar = running[:-1] - np.repeat(behind, length)
    sofar *= np.repeat(back, length)
    key = data.astype(np.uint64)
    key <<= np.uint64(32)
    key |= before
    _mix(key)
    key += np.multiply(sofar, _GOLDEN, out=coefficients)
    order, new = in_order(key)
    starts = np.flatnonzero(new)
    own = order[starts]
    before, sofar = before[own].astype(np.uint64), sofar[own]
    contexts = np.stack(
        (
            mixed(before & np.uint64((1 << 16) - 1) | np.uint64(1 << 32)),
            mixed(before & np.uint64((1 << 24) - 1) | np.uint64(2 << 32)),
            mixed(before | np.uint64(4 << 32)),
            mixed(sofar + np.uint64(3 << 32)),
        )
    )
    return Stream(
        data,
        text,
        np.repeat(mixed(last + np.uint64(5 << 32)), length),
        order,
        np.append(starts, n),
        data[own].astype(np.int64),
        place[own].astype(np.int64),
        (before & np.uint64(255)).astype(np.int64),
        contexts,
        first,
        length,
        whole,
        expected,
        sizes_of(step),
    )


def events(texts: list[bytes], powers: Powers, step: int = 0) -> Events:
    found = stream(texts, powers, step)
    return found.events(0, len(found.data))


def gathered(texts: list[bytes], counts: np.ndarray, leaves: np.ndarray, powers: Powers) -> None:
    """Add texts, each as often as it was counted, to the leaves of all predictors: a whole byte for the first two,
    half a byte for the others. A leaf lies in the slots of its tree, see :func:`nodes_of`."""
    found = stream(texts, powers, step_of(leaves), repeats=False)
    sizes = found.sizes
    weights = None if (counts == 1).all() else counts.astype(np.float64)[found.text[found.first]]

    def add(context: np.ndarray, byte: np.ndarray, n: np.ndarray, i: int) -> None:
        cells = _halves(context, byte, sizes, i) + _HALF.take(byte, axis=0)
        np.add.at(leaves, cells.reshape(-1), np.repeat(n, 2).astype(leaves.dtype))

    def sums(order: np.ndarray, starts: np.ndarray, of: np.ndarray | None) -> np.ndarray:
        return np.diff(starts, append=len(order)) if of is None else np.add.reduceat(of[order], starts)

    # A byte is added for each context that it has, as often as it follows that.
    n = sums(found.order, found.starts[:-1], None if weights is None else np.repeat(weights, found.length))
    times = np.bincount(found.before << 8 | found.value, n, 1 << 16)
    leaves[:256] += times.reshape(256, 256).sum(axis=0).astype(leaves.dtype)
    leaves[256:WHOLE] += times.astype(leaves.dtype)
    for a in range(0, len(n), ADDED):
        rows = slice(a, a + ADDED)
        for i in OTHERS[2:]:
            add(found.contexts[min(i, BEFORE) - 2][rows], found.value[rows], n[rows], i)
    # A word that comes again behind the same word is added once.
    order, new = in_order(found.prior[found.first] + mixed(found.whole))
    starts = np.flatnonzero(new)
    first, length = found.first[order[starts]], found.length[order[starts]]
    often = np.repeat(sums(order, starts, weights), length)
    at = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(len(often))
    for a in range(0, len(at), ADDED):
        own = at[a : a + ADDED]
        rows = found.row.take(own)
        context = mixed(found.prior.take(own) + found.contexts[-1].take(rows))
        add(context, found.value.take(rows), often[a : a + ADDED], BEFORE)


def nodes_of(leaves: np.ndarray, first: int = 0) -> np.ndarray:
    """Zeros and ones by slot, of leaves from slot ``first`` on that are whole trees: a slot has the leaves below it."""
    nodes = np.zeros((2, len(leaves)), dtype=leaves.dtype)
    whole = min(max(WHOLE - first, 0), len(leaves))
    for low, high, width in ((0, whole, 256), (whole, len(leaves), 16)):
        level = leaves[low:high].reshape(-1, width)
        own = nodes[:, low:high].reshape(2, -1, width)
        while width > 1:
            width //= 2
            own[0, :, width : 2 * width], own[1, :, width : 2 * width] = level[:, ::2], level[:, 1::2]
            level = level[:, ::2] + level[:, 1::2]
    return nodes


def counted(texts: list[bytes], counts: np.ndarray, tables: np.ndarray, powers: Powers) -> None:
    """Add texts, each as often as it was counted, to the zeros and ones of all predictors."""
    leaves = np.zeros(tables.shape[1], dtype=tables.dtype)
    gathered(texts, counts, leaves, powers)
    tables += nodes_of(leaves)


def _trust(seen: np.ndarray) -> np.ndarray:
    """Steps of the logarithm of how often a context was seen."""
    return np.minimum(np.log2(seen + 1), TRUST - 1).astype(np.int64)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


class Mixer:
    """Weights by gate and the refining table, over fixed predictors."""

    def __init__(self):
        # The more often the word so far was seen, the more its own predictor counts at first.
        own = np.tile(np.linspace(0.2, 0.6, TRUST), 4)[:, None]
        others = np.array([0, 0.05, 0.15, 0.2, 0.3, 0.3])
        self.weights = np.concatenate(((1 - own) * others, own, 0 * own, 0.5 + 0 * own), axis=1)
        grid = _squash(np.linspace(-8, 8, STEPS))
        self.ones = np.tile(grid * 4, (GATES, 1))
        self.total = np.full((GATES, STEPS), 4.0)
        self.learned = 0
        self.costs = None

    def _mixed(self, odds: np.ndarray, gate: np.ndarray, match: np.ndarray | None = None) -> np.ndarray:
        weights = np.ascontiguousarray(self.weights.T, dtype=np.float32)
        total = weights[len(BITS)].take(gate)
        for i in range(len(BITS)):
            total += weights[i].take(gate) * odds[i]
        if match is not None:
            total += weights[-1].take(gate) * match
        return total

    def _refined(self, mix: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The mean of the mixed probability and of what the table makes of it."""
        at = (np.clip(mix, -7.999, 7.999) + 8) * (STEPS - 1) / 16
        low = at.astype(np.int64)
        share = at - low
        table = (self.ones / self.total).astype(np.float32).reshape(-1)
        cell = gate * STEPS + low
        refined = table.take(cell) * (1 - share) + table.take(cell + 1) * share
        return np.clip((_squash(mix) + refined) / 2, 1e-5, 1 - 1e-5)

    def _step(self, step: np.ndarray, norm: np.ndarray, rate: float = RATE) -> None:
        """``step`` are sums of errors by inputs, ``norm`` sums of squares of inputs."""
        self.weights += rate / (1 + self.learned / HALF) * step / (1 + norm)
        self.learned += 1

    def _gathered(self, cells: np.ndarray) -> np.ndarray:
        """Add to the refining table what came, by gate, step and bit; how much that is by gate."""
        came = cells.reshape(GATES, STEPS, 2)
        self.total += came.sum(axis=2)
        self.ones += came[..., 1]
        return came.sum(axis=(1, 2))

    def learn(self, texts: list[bytes], counts: np.ndarray, tables: np.ndarray | tuple, powers: Powers) -> np.ndarray:
        """One pass over texts, online; each is judged by the counts without one of its occurrences. The first
        ``ALONE`` blocks are learned from one by one, all bytes behind them by groups of rows of equal contexts.
        Returns how much was learned by gate."""
        left, steps = tables if isinstance(tables, tuple) else (paired(tables), steps_left(tables))
        left, steps = left.view(np.float32), steps.reshape(-1)
        # A row of zeros and ones has two numbers here, by the bit that is judged.
        step = step_of(left[::2])
        found, seen = stream(texts, powers, step), np.zeros(GATES)
        roots = None if (counts == 1).all() else np.sqrt(counts)
        end = min(len(found.data), max(0, ALONE - self.learned) * TOGETHER)
        for a in range(0, end, TOGETHER):
            seen += self._alone(found.events(a, min(a + TOGETHER, end)), roots, left, steps)
        if end < len(found.data):
            seen += self._together(found, end, roots, left, steps)
        return seen

    def _alone(self, part: Events, roots: np.ndarray | None, left: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """A step for a block."""
        weight = np.ones(len(part.bit)) if roots is None else roots[part.word]
        own = len(left) - len(steps)
        cells = part.slots * 2 + part.bit
        gate = part.place * TRUST + steps.take(cells[-1] - own)
        inputs = np.empty((len(BITS) + 2, len(part.bit)), dtype=np.float32)
        left.take(cells, out=inputs[: len(BITS)])
        inputs[-2], inputs[-1] = 1, part.match
        mix = self._mixed(inputs, gate, part.match)
        off = (part.bit - _squash(mix)) * weight
        self._step(*_sums(inputs, gate, off.astype(np.float32), weight.astype(np.float32)))
        cell = (gate * (2 * STEPS) + (STEPS - 1) + part.bit).astype(np.float32)
        return self._gathered(np.bincount(_near(mix, cell), weight, 2 * GATES * STEPS))

    def _together(
        self, found: Stream, start: int, roots: np.ndarray | None, left: np.ndarray, steps: np.ndarray
    ) -> np.ndarray:
        """Steps for all bytes from ``start`` on, group by group of rows, which their keys deal at random: what does
        not change with the word before is read once a row."""
        came = np.zeros(2 * GATES * STEPS)
        columns = [*OTHERS, len(BITS)]
        for group, parts in found.groups(start):
            weights = np.ascontiguousarray(self.weights.T, dtype=np.float32)
            step, norm = np.zeros((2, *self.weights.shape))
            value, rows = found.value[group], group.stop - group.start
            inputs = np.empty((len(columns), rows, 8), dtype=np.float32)
            inputs[-1] = 1
            for i, k in enumerate(OTHERS):
                cells = found.slots(k, group, judged=True)
                left.take(cells, out=inputs[i], mode="clip")
            gate = steps.take(cells - (len(left) - len(steps))) + (found.place[group] * TRUST)[:, None]
            base = np.zeros((rows, 8), dtype=np.float32)
            for i, k in enumerate(columns):
                base += weights[k].take(gate) * inputs[i]
            before = weights[BEFORE].take(gate)
            bits = _BIT.take(value, axis=0).astype(np.float32)
            cell = (gate * (2 * STEPS) + (STEPS - 1) + bits).astype(np.float32)
            held, off_sums = np.zeros(rows), np.zeros(rows * 8)
            for at, row in parts:
                own = row - group.start
                odds = left.take(found.slots_before(at, row, judged=True), mode="clip")
                mix = before.take(own, axis=0)
                mix *= odds
                mix += base.take(own, axis=0)
                some, match = found.matched(at, row)
                gates = gate.take(own.take(some), axis=0)
                mix[some] += weights[-1].take(gates) * match
                off = bits.take(own, axis=0)
                off -= _squash(mix)
                weight = None if roots is None else np.repeat(roots[found.text[at]], 8)
                if weight is not None:
                    off *= weight.reshape(-1, 8)
                came += np.bincount(_near(mix, cell.take(own, axis=0)), weight, len(came))
                # Errors and weights add up by row, which is read once; those of the word before by gate.
                low, flat = int(own[0]), gate.take(own, axis=0).reshape(-1)
                own -= low
                sums = np.bincount(((own * 8)[:, None] + np.arange(8)).reshape(-1), off.reshape(-1))
                off_sums[low * 8 : low * 8 + len(sums)] += sums
                times = np.bincount(own, None if weight is None else weight[::8])
                held[low : low + len(times)] += times
                step[:, BEFORE] += np.bincount(flat, (off * odds).reshape(-1), GATES)
                odds *= odds
                norm[:, BEFORE] += np.bincount(flat, odds.reshape(-1) if weight is None else odds.reshape(-1) * weight, GATES)
                if len(some):
                    flat = gates.reshape(-1)
                    step[:, -1] += np.bincount(flat, (off.take(some, axis=0) * match).reshape(-1), GATES)
                    match *= match
                    if weight is not None:
                        match *= weight.reshape(-1, 8)[some]
                    norm[:, -1] += np.bincount(flat, match.reshape(-1), GATES)
            step[:, columns], norm[:, columns] = _sums(
                inputs.reshape(len(columns), -1),
                gate.reshape(-1),
                off_sums.astype(np.float32),
                np.repeat(held, 8).astype(np.float32),
            )
            self._step(step, norm, RATE * LARGER)
        return self._gathered(came)

    def _costs(self) -> np.ndarray:
        """Bits of the code of a bit by gate, bit, and mixed log odds in steps of the grid."""
        mix = np.arange(-GRID * GREATEST, GRID * GREATEST + 1) / GRID
        gate = np.repeat(np.arange(GATES), len(mix))
        one = self._refined(np.tile(mix, GATES), gate).reshape(GATES, 1, -1)
        return -np.log2(np.concatenate((1 - one, one), axis=1)).astype(np.float32)

    def lengths(self, texts: list[bytes], odds: np.ndarray, trust: np.ndarray, powers: Powers) -> np.ndarray:
        """Bits of each text's code; ``odds`` are the predictors' log odds by slot, ``trust`` the
        steps of the last predictor's counts."""
        if not texts:
            return np.zeros(0)
        if self.costs is None:
            self.costs = self._costs()
        costs, middle = self.costs.reshape(-1), GRID * GREATEST
        found = stream(texts, powers, step_of(odds))
        own_slot = slots_of(step_of(odds)) - len(trust)
        weights = np.ascontiguousarray(self.weights.T, dtype=np.float32)
        out, eight = np.empty(len(found.data), dtype=np.float32), np.ones(8, dtype=np.float32)
        for group, parts in found.groups():
            # The last predictor's slots tell the gate.
            slots = found.slots(OTHERS[-1], group)
            gate = trust.take(slots - own_slot) + (found.place[group] * TRUST)[:, None]
            base = weights[-2].take(gate)
            for k in OTHERS:
                base += weights[k].take(gate) * odds.take(slots if k == OTHERS[-1] else found.slots(k, group), mode="clip")
            before = weights[BEFORE].take(gate)
            cost = ((gate * 2 + _BIT.take(found.value[group], axis=0)) * self.costs.shape[-1] + middle).astype(np.int32)
            for at, row in parts:
                own = row - group.start
                mix = before.take(own, axis=0)
                mix *= odds.take(found.slots_before(at, row), mode="clip")
                mix += base.take(own, axis=0)
                some, match = found.matched(at, row)
                mix[some] += weights[-1].take(gate.take(own.take(some), axis=0)) * match
                mix *= GRID
                np.clip(mix, -middle, middle, out=mix)
                near = np.rint(mix, out=mix).astype(np.int32)
                near += cost.take(own, axis=0)
                out[at] = costs.take(near, mode="clip") @ eight
        return np.add.reduceat(out, np.flatnonzero(np.diff(found.text, prepend=-1)), dtype=float)


def _near(mix: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Cells of the refining table, from those of the bit and gate at even odds."""
    near = np.clip(mix, -8, 8)
    near *= (STEPS - 1) / 16
    np.rint(near, out=near)
    near *= 2
    near += cell
    return near.reshape(-1).astype(np.int64)


def _sums(
    inputs: np.ndarray, gate: np.ndarray, off: np.ndarray, held: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """By gate and input, the sums of errors times inputs and of weights times their squares. Events of a gate are
    laid side by side, so that its sums are products of its own events only."""
    order = np.argsort(gate.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(gate, minlength=GATES))
    grouped, off, held = inputs.take(order, axis=1), off.take(order), held.take(order)
    squares = grouped * grouped
    step, norm = np.zeros((2, GATES, len(inputs)))
    for g in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        own = slice(ends[g - 1] if g else 0, ends[g])
        step[g] = grouped[:, own] @ off[own]
        norm[g] = squares[:, own] @ held[own]
    return step, norm


def in_lines(slots: int, dtype: type) -> np.ndarray:
    """Zeros that begin where a line does."""
    size = slots * np.dtype(dtype).itemsize
    room = np.zeros(size + LINE, dtype=np.uint8)
    start = -room.ctypes.data % LINE
    return room[start : start + size].view(dtype)


def paired(tables: np.ndarray) -> np.ndarray:
    """Log odds of a slot without the zero or without the one that is judged, side by side, as
    :meth:`Mixer.learn` reads them."""
    if tables.ndim == 1:
        return tables
    tables = tables.astype(np.float32, copy=False)
    zeros, ones = tables + np.float32(PRIOR)
    less = np.maximum(tables - 1, 0)
    less += np.float32(PRIOR)
    pairs = np.empty((len(zeros), 2), dtype=np.float32)
    pairs[:, 0] = np.log(ones / less[0])
    pairs[:, 1] = np.log(less[1] / zeros)
    return pairs.view(np.complex64).reshape(-1)


def steps_left(tables: np.ndarray) -> np.ndarray:
    """Steps of the last predictor's counts without the zero or without the one that is judged."""
    return trust_left(tables[:, -own_slots(tables.shape[1]) :])


def trust_left(own: np.ndarray) -> np.ndarray:
    """:func:`steps_left` of the last predictor's counts."""
    less = np.maximum(own - np.float32(1), 0)
    return np.stack((_trust(less[0] + own[1]), _trust(own[0] + less[1])), axis=1).astype(np.int8)


def own_slots(slots: int) -> int:
    """How many of the tables' slots are the last predictor's."""
    return 1 << sizes_of(next(e for e in range(LARGEST + 1) if slots_of(e) == slots))[-1]


def odds_and_trust(tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    odds = np.log((tables[1] + PRIOR) / (tables[0] + PRIOR)).astype(np.float32)
    return odds, _trust(tables.sum(axis=0)).astype(np.int8)


def log_odds(tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What :meth:`Mixer.lengths` needs to know of the counts."""
    odds, trust = odds_and_trust(tables)
    return odds, trust[-own_slots(tables.shape[1]) :]
