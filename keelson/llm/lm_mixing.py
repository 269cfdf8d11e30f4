"""Language-model scoring by online logistic context mixing.

A text is its words, lower-cased (A-Z), each followed by a space, and an end
byte.  Every byte is coded bit by bit, in groups of four.  Each of several
hashed contexts predicts the bit from how often it was 0 or 1 after that
context in the training texts.  A context is the last two or four
bytes or all of them, back to the space before the word; for a word's first
byte, back to the beginning of the previous word.  So the contexts of a byte
follow from its word, or from the previous word, and are looked up once for
each word of a block of documents, not for each occurrence.

The predictions, as log odds, are mixed twice.  First by gated weights: the
gate tells how well the longest contexts are known, and each gate's weights
are fitted by Newton steps to all training occurrences, each taken out of the
counts that predict it: the last step, which gives one set of weights for the
corpus, adds up what all blocks found, those before are each block's own.
Then the mix and two of the contexts
are mixed again under weights that start at the first mix alone and are
refined, text by text, after each short run along the gradient of the
coding cost.

Contexts are told apart by a hash whose bits grow with the corpus, so that
two of them meet about once in 2**SPARE; no task holds them all.  Blocks of documents send their cells (a context, the
groups that went before and a group's value) with their counts to buckets of
contexts and get back how often each of a cell's bits was seen, and its
opposite.  Word counts, for the base score, go the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_text, partitions_for, pieces, row_key, table, texts, whole_text

# Bytes coded by one group (the 16th value is the escape), and
# by one more; all others take the two escapes and their two halves.
ONE_GROUP = b" etaoinsrhldcum"
TWO_GROUPS = b"pgwfbvyk,.\nxjqz"
#: The contexts: so many last bytes, or all (WORD).  A slot, a context with
#: the groups that went before, has 16 cells, one for each value of a group.
WORD = 0
CONTEXTS = (2, 4, WORD)
#: The contexts that the second mix sees beside the first, and the one whose counts open its gates beside the longest.
AGAIN = (1, 2)
NEAR = 1
#: Added to each count of a bit.
SMOOTH = 0.2
#: What the mix counts beside the words seen after the previous one: so much, times the root of their number.
PRIOR = 8.0
#: Least counts, of the whole context and of the nearest but one, of each gate but the first.
KNOWN = (1, 2, 4, 8, 32)
KNOWN_NEAR = (1, 16)
#: Weight of each context before any training, what holds the fit near it, and Newton steps.
WEIGHT = 0.3
RIDGE = 1.0
STEPS = 5
#: The rate at which the second weights move; it falls with the run's length to this power.
RATE = 0.006
SLOWER = 0.6
#: Groups after which these weights move: the first runs of a text, then the last of these.
RUNS = (16, 16, 32, 64, 128, 256)
#: Bytes scored at a time, and of text in a block of documents.
CHUNK = 1 << 19
BLOCK_BYTES = 8 << 20
#: Bits of a context's hash: so many more than the size of the corpus has, and at least.  The last of a slot's
#: bits tell which groups went before: the slots of a context follow each other.  A slot's bits at most.
SPARE, LEAST_BITS = 14, 40
WENT_BITS = 5
MOST_BITS = 60
END = b"\n"
#: Slots counted, and groups mixed, at a time.
SLOTS = 1 << 14
GROUPS = 1 << 17
#: Texts whose inputs are read at a time.
TEXTS = 64


def _codes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: how many groups, their values, and for each a number that
    tells which groups went before."""
    count, value, before = np.full(256, 4, np.int64), np.zeros((256, 4), np.uint64), np.zeros((256, 4), np.uint64)
    for b in range(256):
        value[b], before[b] = (15, 15, b >> 4, b & 15), (1, 2, 3, 4 + (b >> 4))
    for k, b in enumerate(TWO_GROUPS):
        count[b], value[b, 1] = 2, k
    for k, b in enumerate(ONE_GROUP):
        count[b], value[b, 0] = 1, k
    return count, value, before


_COUNT, _VALUE, _BEFORE = _codes()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = 0xD1342543DE82EF95


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit values, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


#: Stands for each byte in the hash of a word.
_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


#: What tells apart the groups of a slot's context: the groups before, and the value.
_LOW = (_BEFORE << np.uint64(4) | _VALUE).ravel()
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def ordered(keys: np.ndarray) -> np.ndarray:
    """The order that sorts 64-bit keys, equal ones as they come: numbers of
    the upper bits and the place are sorted, which is faster than places are."""
    n = len(keys)
    place = max(n - 1, 0).bit_length()
    low = max(int(keys.max()).bit_length() + place - 64, 0) if n else 0
    packed = keys >> np.uint64(low) << np.uint64(place)
    packed |= np.arange(n, dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << place) - 1)
    order = packed.view(np.int64)
    if low:
        found = keys[order]
        if (found[1:] < found[:-1]).any():
            order = order[np.argsort(found, kind="stable")]
    return order


def distinct(keys: np.ndarray, first: bool = False) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted; where each is first, if asked for; and for all keys which one they are."""
    order = ordered(keys)
    found, which = keys[order], np.empty(len(keys), np.int32)
    new = np.append(True, found[1:] != found[:-1])[:len(found)]
    which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return (found[new], order[new], which) if first else (found[new], which)


def within(many: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of some numbers."""
    return np.arange(many.sum(), dtype=np.int32) - np.repeat((np.cumsum(many) - many).astype(np.int32), many)


def last_bytes(data: np.ndarray, least: np.ndarray, ends: np.ndarray, symbol: np.ndarray, k: int) -> np.ndarray:
    """Numbers that are equal when the last ``k`` bytes from ``least`` to ``ends`` are, and the symbol (``k`` is six at most)."""
    size = np.minimum(ends - least, k)
    out = (size << 8 | symbol).astype(np.uint64)
    for i in range(1, k + 1):
        out <<= np.uint64(8)
        out |= np.where(i <= size, data[ends - np.minimum(i, size)], np.uint8(0))
    return out


def tokens(found: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct tokens of some texts, the end first and the words sorted; the
    tokens of all texts in a row, each text closed by an end; and how many each text has."""
    data = np.frombuffer(b"".join([t + END for t in found]).lower(), np.uint8)
    letter = ~_SPACE[data]
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1 if len(data) else np.empty(0, np.int64)
    if len(data) and letter[0]:
        start = np.append(0, start)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    sizes = np.diff(np.searchsorted(start, ends), prepend=0) + 1
    offsets = np.append(np.cumsum(letter)[start] - 1, np.count_nonzero(letter))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[letter])]).dictionary_encode()
    order = pc.array_sort_indices(words.dictionary)
    rank = np.empty(len(order), np.int32)
    rank[np.asarray(order)] = np.arange(1, len(order) + 1)
    ids = np.zeros(int(sizes.sum()), np.int32)
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(sizes) - 1] = False
    ids[inner] = rank[np.asarray(words.indices)]
    known = words.dictionary.take(order)
    cut, joined = np.frombuffer(known.buffers()[1], np.int64)[:len(known) + 1].tolist(), known.buffers()[2].to_pybytes()
    return [END, *[joined[a:b] for a, b in zip(cut, cut[1:], strict=False)]], ids, sizes


class Block:
    """The words of a block's texts and all groups that code them.

    ``words`` are the distinct tokens, the end first; ``ids`` the tokens of
    all texts in a row, each text closed by an end; ``sizes`` the tokens of
    each text.  A symbol is a byte to code under its contexts: every byte of
    a word but the first (one symbol for all occurrences), and the first
    byte of a word after a previous word (one for each such pair).
    """

    def __init__(self, found: list[bytes], bits: int = MOST_BITS) -> None:
        self.words, self.ids, self.sizes = tokens(found)
        size = np.fromiter(map(len, self.words), np.int64, len(self.words))
        data = np.frombuffer(b" " + b"  ".join(self.words) + b" ", np.uint8)
        start = np.cumsum(size + 2) - size - 2
        # hashes of runs of bytes: differences of prefix sums
        power = np.cumprod(np.full(len(data), _FACTOR, np.uint64), dtype=np.uint64)
        inverse = np.cumprod(np.full(len(data) + 1, pow(_FACTOR, -1, 1 << 64), np.uint64), dtype=np.uint64)
        prefix = np.append(np.uint64(0), np.cumsum(_LETTER[data] * power, dtype=np.uint64))
        del power
        # bytes of words behind the first, the space after it included; none of the end
        n = np.where(np.arange(len(size)) == 0, 0, size)
        word = np.repeat(np.arange(len(size), dtype=np.int32), n)
        depth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        later = depth + start[word] + 2
        # words are sorted, so those that begin alike follow each other among the words of a length: one symbol for all
        order = np.argsort(depth.astype(np.uint16) if n.max() < 1 << 16 else depth, kind="stable")
        alike = ((prefix[later + 1] - prefix[start[word]]) * inverse[start[word]])[order]
        new = np.append(True, (alike[1:] != alike[:-1]) | (depth[order][1:] != depth[order][:-1]))[:len(order)]
        self.symbol = np.empty(len(order), np.int32)  # of each byte behind a word's first
        self.symbol[order] = np.cumsum(new) - 1
        later_of = later[order][new]
        least_of = start[word[order][new]]
        del depth, later, alike, order
        # words after words, and first bytes after words
        shift = np.uint64(len(self.words).bit_length())
        before = np.append(np.int32(0), self.ids[:-1]) if len(self.ids) else self.ids
        followed, self.link = distinct(before.astype(np.uint64) << shift | self.ids.astype(np.uint64))
        follows, followed = (followed >> shift).astype(np.int64), (followed & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
        pairs = follows << 8 | data[start[followed] + 1]
        new = np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]
        self.pair = (np.cumsum(new, dtype=np.int32) - np.int32(1))[self.link]
        pairs = pairs[new]
        previous = pairs >> 8
        ends = np.concatenate([later_of, (start + size + 2)[previous]])
        least = np.concatenate([least_of, start[previous] + 1])
        symbol = np.concatenate([data[later_of], (pairs & 255).astype(np.uint8)])
        self.later = len(later_of)
        del before, new, pairs, previous, later_of, least_of
        #: Bytes that code each word: its own and a space; of the end, itself.
        self.bytes = np.where(np.arange(len(size)) == 0, 1, size + 1)

        def slots(h: np.ndarray) -> np.ndarray:
            return h >> np.uint64(64 - bits + WENT_BITS) << np.uint64(WENT_BITS + 4)

        def keys(k: int, of: np.ndarray | slice) -> np.ndarray:
            """The cells of some symbols' groups in the context ``k``."""
            end, first = ends[of], least[of]
            if k != WORD:
                first = np.maximum(first, end - k)
            h = mixed((prefix[end] - prefix[first]) * inverse[first] + np.uint64((CONTEXTS.index(k) + 1) * int(_ODD) % (1 << 64)))
            many = _COUNT[symbol[of]]
            code = np.repeat(symbol[of].astype(np.int32) << 2, many) + within(many)
            return np.repeat(slots(h), many) | np.take(_LOW, code)

        # bytes after the same last bytes are one symbol to a short context; the shorter follows from the longer
        alike, near = {}, np.arange(len(symbol))
        number = np.arange(len(symbol), dtype=np.int32)
        for k in sorted(set(CONTEXTS) - {WORD}, reverse=True):
            _, found_at, own = distinct(last_bytes(data, least[near], ends[near], symbol[near], k), True)
            near, number = near[found_at], own[number]
            alike[k] = near, number
        # a word and the previous one: a slot of one cell
        whole = mixed((prefix[start + size + 2] - prefix[start]) * inverse[start])
        link = slots(mixed(whole[follows] * _ODD + whole[followed]))
        del follows, followed, whole, near, number
        every = [*[keys(k, alike[k][0] if k in alike else slice(None)) for k in CONTEXTS], link]
        del inverse, prefix, ends, least, link, data
        at = np.cumsum([0, *map(len, every)])
        every = np.concatenate(every)
        self.cells, at_cell = distinct(every)
        del every
        many = _COUNT[symbol]
        self.begin = np.append(0, np.cumsum(many))  # the groups of each symbol
        self.of = np.repeat(np.arange(len(symbol), dtype=np.int32), many)
        #: The cell (an index into ``cells``) of each context and group, and of each word after a previous one.
        self.cell, self.link_cell = np.empty((len(CONTEXTS), len(self.of)), np.int32), at_cell[at[-2]:].copy()
        for i, k in enumerate(CONTEXTS):
            if k in alike:
                of, number = alike[k]
                first = np.cumsum(_COUNT[symbol[of]]) - _COUNT[symbol[of]] + at[i]
                np.take(at_cell, np.repeat(first[number] - self.begin[:-1], many) + np.arange(len(self.of)), out=self.cell[i], mode="clip")
            else:
                self.cell[i] = at_cell[at[i]:at[i + 1]]
        self.word_of, self.n = word, n
        self.at = np.append(0, np.cumsum(n))  # the later bytes of each word

    def times(self, training: np.ndarray) -> np.ndarray:
        """How often each group occurs in the training texts."""
        t, symbols = np.repeat(training, self.sizes), len(self.begin) - 1
        of_word = np.bincount(self.ids[t], minlength=len(self.words))
        times = np.bincount(self.symbol, weights=of_word[self.word_of], minlength=symbols)
        return (times + np.bincount(self.pair[t] + self.later, minlength=symbols))[self.of]

    def groups(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The groups that code tokens ``a`` to ``b``, in their order, and how many each token has."""
        return self.groups_of(self.ids[a:b], self.pair[a:b])

    def groups_of(self, ids: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of any tokens, given with their part of ``pair``."""
        spelled, at = self.spelled
        first = pair + self.later
        # of each token, a run of groups for its first byte and one for all others
        begin = np.stack([self.begin[first] + at[-1], at[ids]], axis=1).ravel()
        many = np.stack([self.begin[first + 1] - self.begin[first], at[ids + 1] - at[ids]], axis=1).ravel()
        total = np.cumsum(many)
        rows = spelled[np.repeat(begin - total + many, many) + np.arange(total[-1])]
        return rows, many[::2] + many[1::2]

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The groups of all words' later bytes, then all groups once; and where each word's begin."""
        begin, many = self.begin[self.symbol], np.diff(self.begin)[self.symbol]
        total = np.append(0, np.cumsum(many))
        rows = np.repeat((begin - total[:-1]).astype(np.int32), many) + np.arange(total[-1], dtype=np.int32)
        return np.concatenate([rows, np.arange(self.begin[-1], dtype=np.int32)]), total[self.at]

    def cell_counts(self, training: np.ndarray) -> np.ndarray:
        """How often each cell occurs in the training texts."""
        n, out = self.times(training), np.zeros(len(self.cells))
        for cell in self.cell:
            out += np.bincount(cell, weights=n, minlength=len(self.cells))
        out[self.link_cell] += np.bincount(self.link[np.repeat(training, self.sizes)], minlength=len(self.link_cell))
        return out.astype(np.int64)


def added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of ``n``."""
    order = ordered(keys)
    keys, n = keys[order], n[order]
    first = np.nonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])[0]
    return keys[first], np.add.reduceat(n, first) if len(n) else n


def hash_bits(size: int) -> int:
    return min(max(size.bit_length() + SPARE, LEAST_BITS) + WENT_BITS, MOST_BITS)


def cell_cuts(cells: np.ndarray, buckets: int, bits: int) -> list[int]:
    """Where each bucket's cells begin among sorted ones: a bucket has a range
    of hashes, so all cells of a slot."""
    return np.searchsorted(cells, np.array([(b << bits) // buckets << 4 for b in range(buckets)], np.uint64)).tolist() + [len(cells)]


#: A count in one byte: itself up to 127, then 16 steps for each doubling (the step at or below it).
_SEEN = np.append(np.arange(128.0), np.rint(128 * 2 ** (np.arange(128) / 16)))


def code_of(n: np.ndarray) -> np.ndarray:
    """The codes of whole numbers."""
    code = np.minimum(n, 127).astype(np.uint8)
    many = np.flatnonzero(n > 127)
    code[many] = np.searchsorted(_SEEN, n[many], side="right") - 1
    return code


def cell_bits(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For sorted distinct cells that hold whole slots: how often, in that
    slot after the cell's bits before, each of its four bits was seen, and
    its opposite (eight codes of _SEEN, as one 64-bit number)."""
    slots = keys >> np.uint64(4)
    new = np.append(True, slots[1:] != slots[:-1])[:len(slots)]
    alone = new & np.append(new[1:], True)[:len(slots)]
    # the only cell of a slot: all bits were seen alike, and no opposite
    bits = code_of(n).astype(np.uint64) * np.uint64(0x0001000100010001)
    others = np.flatnonzero(~alone)
    slot, value, n = np.cumsum(new[others], dtype=np.int64) - 1, (keys[others] & np.uint64(15)).astype(np.int64), n[others]
    out = np.empty((len(others), 8), np.uint8)
    for at in range(0, int(slot[-1]) + 1 if len(slot) else 0, SLOTS):
        a, b = np.searchsorted(slot, [at, at + SLOTS])
        cell, v = slot[a:b] - at, value[a:b]
        node = np.bincount(cell * 16 + v, weights=n[a:b], minlength=(int(slot[b - 1]) - at + 1) * 16)
        for bit in range(3, -1, -1):
            side = (cell << bit + 1) + (v >> 3 - bit)
            out[a:b, 2 * bit], out[a:b, 2 * bit + 1] = code_of(node[side]), code_of(node[side ^ 1])
            node = node[::2] + node[1::2]
    bits[others] = out.view("<u8").ravel()
    return bits


#: For each pair of codes (of a bit and, times 256, of its opposite): the log
#: odds, the same with the bit taken out once, and how often both were seen.
_PAIR = np.arange(1 << 16)
_ODDS = np.log((_SEEN[_PAIR & 255] + SMOOTH) / (_SEEN[_PAIR >> 8] + SMOOTH))
_LESS = np.log((np.maximum(_SEEN[_PAIR & 255] - 1, 0) + SMOOTH) / (_SEEN[_PAIR >> 8] + SMOOTH))
#: The gate of a bit: the sum of what its longest context and its nearest but one give.
GATES = (len(KNOWN) + 1) * (len(KNOWN_NEAR) + 1)


def _steps(known: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    return np.searchsorted(least, known, side="right").astype(np.uint8)


def _gates(less: int) -> tuple[np.ndarray, np.ndarray]:
    known = np.maximum(_SEEN[_PAIR & 255] - less, 0) + _SEEN[_PAIR >> 8]
    return _steps(known, KNOWN) * np.uint8(len(KNOWN_NEAR) + 1), _steps(known, KNOWN_NEAR)


_GATE, _GATE_LESS = _gates(0), _gates(1)
#: Bits of a pair of codes, and of the times that stand beside the pairs of all contexts and the gate in 64 bits.
PAIR_BITS = 16
TIMES_BITS = 64 - 5 - PAIR_BITS * len(CONTEXTS)


class Evidence:
    """What the training occurrences of a block say about the first weights:
    each distinct combination of a bit's counts, sorted by its gate, with how
    often it occurs.  None is left out."""

    def __init__(self, block: Block, pairs: np.ndarray, training: np.ndarray) -> None:
        n = block.times(training).astype(np.int64)
        groups = np.nonzero(n)[0]
        few = (1 << TIMES_BITS) - 1
        packed, counted, more, times = [], [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for at in range(0, len(groups), GROUPS):
            own = groups[at:at + GROUPS]
            p = pairs[block.cell[:, own]]
            key = (_GATE_LESS[0][p[-1]] + _GATE_LESS[1][p[NEAR]]).astype(np.uint64)
            for x in p:
                key = key << np.uint64(PAIR_BITS) | x
            # equal ones are added up at once, so that few are held
            some = (key << np.uint64(TIMES_BITS) | (n[own] & few).astype(np.uint64)[:, None]).ravel()
            some.sort()
            same = some >> np.uint64(TIMES_BITS)
            first = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
            packed.append(same[first])
            counted.append(np.add.reduceat((some & np.uint64(few)).astype(np.int64), first))
            many = n[own] > few
            more.append(key[many].ravel())
            times.append(np.repeat(n[own][many] & ~few, 4))
        keys, self.times = added(np.concatenate([*packed, *more]), np.concatenate([*counted, *times]))
        self.pairs = [(keys >> np.uint64(PAIR_BITS * i)).astype(np.uint16) for i in range(len(CONTEXTS))][::-1]
        self.cuts = np.searchsorted(keys >> np.uint64(PAIR_BITS * len(CONTEXTS)), np.arange(GATES + 1)).tolist()

    def slopes(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log probability of all occurrences, at each gate's weights: the slope, and the curvature (its sign turned)."""
        k = len(CONTEXTS)
        slope, curve = np.zeros((GATES, k)), np.zeros((GATES, k, k))
        for g, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            for at in range(a, b, GROUPS):
                end = min(at + GROUPS, b)
                x = np.stack([_LESS[p[at:end]] for p in self.pairs])
                miss = 1 / (1 + np.exp(np.clip(weights[g] @ x, -30, 30)))
                missed = self.times[at:end] * miss
                slope[g] += x @ missed
                curve[g] += (x * (missed * (1 - miss))) @ x.T
        return slope, curve


def moved(weights: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """The weights after a Newton step."""
    k = len(CONTEXTS)
    step = np.linalg.solve(curve + np.eye(k) * RIDGE, (slope - RIDGE * (weights - WEIGHT))[..., None])[..., 0]
    return weights + np.clip(step, -0.5, 0.5)


def fitted(evidence: Evidence) -> np.ndarray:
    """All Newton steps but the last on a block's training occurrences, and
    what the last needs of them: numbers that blocks add up (see weights_of)."""
    weights = np.full((GATES, len(CONTEXTS)), WEIGHT)
    for _ in range(STEPS - 1):
        weights = moved(weights, *evidence.slopes(weights))
    slope, curve = evidence.slopes(weights)
    bent = (curve @ weights[..., None])[..., 0]
    return np.concatenate([[1.0], weights.ravel(), slope.ravel(), bent.ravel(), curve.ravel()])


def weights_of(sums: np.ndarray) -> np.ndarray:
    """The last Newton step, from the sums over all blocks: from the mean of
    their weights, by curvature, along the slope there of all occurrences
    (each block's carried over by its curvature)."""
    k = len(CONTEXTS)
    blocks, (weights, slope, bent), curve = sums[0], sums[1:1 + 3 * GATES * k].reshape(3, GATES, k), sums[1 + 3 * GATES * k:].reshape(GATES, k, k)
    mean = np.linalg.solve(curve + np.eye(k) * RIDGE * blocks, (bent + RIDGE * weights)[..., None])[..., 0]
    return moved(mean, slope + bent - (curve @ mean[..., None])[..., 0], curve)


class Model:
    """Log odds of all groups of a block from the counts of its cells
    (``bits``, see cell_bits), and the first mix of them.  ``weights`` (see
    weights_of) come from all blocks; without them the block's training
    occurrences are all there are."""

    def __init__(self, block: Block, bits: np.ndarray, training: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.block = block
        self.pairs = bits.view("<u2").reshape(-1, 4)
        self.weights = weights_of(fitted(Evidence(block, self.pairs, training))) if weights is None else weights
        total = block.cell.shape[1]
        #: What the second mix sees: for each group, input and bit.
        self.inputs = np.zeros((total + 1, 1 + len(AGAIN), 4), np.float32)
        for at in range(0, total, GROUPS):
            end = min(at + GROUPS, total)
            p = self.pairs[block.cell[:, at:end]]
            x, gate = [_ODDS[q] for q in p], _GATE[0][p[-1]] + _GATE[1][p[NEAR]]
            self.inputs[at:end, 0] = sum(x[k] * self.weights[:, k][gate] for k in range(len(CONTEXTS)))
            for i, k in enumerate(AGAIN, 1):
                self.inputs[at:end, i] = x[k]
        np.clip(self.inputs, -30, 30, out=self.inputs)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """log10 probability of each text of the block, given the training
        counts of its words."""
        block = self.block
        ends = np.cumsum(block.sizes)
        starts = ends - block.sizes
        n_bytes = np.add.reduceat(block.bytes[block.ids], starts)
        out, order = np.zeros(len(ends)), np.argsort(n_bytes, kind="stable")
        previous = np.append(0, block.ids[:-1])
        root = PRIOR * np.sqrt(counts + 1)
        with np.errstate(divide="ignore"):
            after = np.log(_SEEN[self.pairs[block.link_cell, 0] & 255])
        for x, y in pieces(n_bytes[order].tolist(), CHUNK):
            own = order[x:y]
            n = block.sizes[own]
            first = np.cumsum(n) - n
            token = np.repeat(starts[own] - first, n) + np.arange(n.sum())
            rows, n = block.groups_of(block.ids[token], block.pair[token])
            mix = np.add.reduceat(self.cost(rows, np.add.reduceat(n, first)), np.cumsum(n) - n) * -np.log(2)
            prior = root[previous[token]]
            of = np.logaddexp(after[block.link[token]], np.log(prior) + mix) - np.log(counts[previous[token]] + prior)
            out[own] = np.add.reduceat(of, first) / np.log(10)
        return out

    def costs(self, found: list[np.ndarray]) -> list[np.ndarray]:
        """Bits that each group of some texts costs, given its rows."""
        sizes = np.array(list(map(len, found)))
        return np.split(self.cost(np.concatenate(found), sizes), np.cumsum(sizes)[:-1])

    def seen(self, own: np.ndarray) -> np.ndarray:
        """The inputs of some rows, as (input, bit, *rows)."""
        x = np.empty((*self.inputs.shape[1:], *own.shape), np.float32)
        for at in range(0, len(own), TEXTS):
            x[:, :, at:at + TEXTS] = np.take(self.inputs, own[at:at + TEXTS], axis=0, mode="clip").transpose(2, 3, 0, 1)
        return x

    def cost(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same for the rows of all texts in a row, each of so many: the second mix."""
        order = np.argsort(-sizes, kind="stable")
        first, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        weights = np.zeros((self.inputs.shape[1], 4, len(order), 1), np.float32)
        weights[0] = 1
        cost, at, run = np.zeros(len(rows) + 1), 0, 0
        rows = np.append(rows, len(self.inputs) - 1).astype(np.intp)
        while at < sizes[0]:
            width = RUNS[min(run, len(RUNS) - 1)]
            rate = np.float32(RATE * (RUNS[0] / width) ** SLOWER)
            live = int(np.searchsorted(-sizes, -at, side="left"))  # texts longer than at
            step = at + np.arange(width)
            index = np.where(step < sizes[:live, None], first[:live, None] + step, len(rows) - 1)
            x = self.seen(np.take(rows, index))
            z = x[0] * weights[0, :, :live]
            for a, w in zip(x[1:], weights[1:], strict=True):
                z += a * w[:, :live]
            np.clip(z, -40, 40, out=z)
            odds = np.exp(np.negative(z, out=z), out=z)
            above = odds + np.float32(1)
            miss = np.divide(odds, above, out=odds)  # 1 - probability of the bit
            two = above[:2] * above[2:]  # at most (1 + exp(40)) ** 2, which is a float32
            cost[index] = np.log2(two, out=two).sum(axis=0)
            for a, w in zip(x, weights, strict=True):
                w[:, :live] += rate * np.matmul(miss[:, :, None, :], a[:, :, :, None])[..., 0]
            at, run = at + width, run + 1
        return cost[:-1]


def word_keys(words: list[bytes]) -> np.ndarray:
    """128-bit hashes of words: they stand for the words when counts of
    different blocks are added."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2).astype("<u8")


def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, id, training, text) to a row for each block of a batch: lists
    of ids, of ``training`` and of the texts' sizes, and the texts,
    compressed together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = np.asarray(batch.column(0))
        order = np.argsort(block, kind="stable")
        first = np.nonzero(np.append(True, np.diff(block[order])))[0]
        found, at = batch.take(pa.array(order)), pa.array(np.append(first, len(order)), pa.int32())
        own = texts(found, 3)
        joined = [zstandard.ZstdCompressor(level=3).compress(b"".join(own[a:b])) for a, b in zip(first, [*first[1:], len(own)], strict=True)]
        lists = [pa.ListArray.from_arrays(at, x) for x in (found.column(1), found.column(2), pa.array(list(map(len, own)), pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(block[order][first]), *lists, pa.array(joined, pa.binary())], ["block", "id", "training", "size", "text"])


def flat(column: pa.ChunkedArray) -> pa.ChunkedArray:
    return pa.chunked_array([c.flatten() for c in column.chunks], column.type.value_type)


def read_block(found: pa.Table, bits: int) -> tuple[Block, np.ndarray]:
    """A block of documents (see pack_rows), and which of them are learned from."""
    text, sizes = b"".join(map(zstandard.ZstdDecompressor().decompress, found.column("text").to_pylist())), flat(found.column("size")).to_pylist()
    ends = np.cumsum(sizes).tolist()
    return Block([text[e - n:e] for e, n in zip(ends, sizes, strict=True)], bits), np.array(flat(found.column("training")).to_pylist(), bool)


def cuts(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(buckets + 1))


def squeezed(a: np.ndarray, sorted_: bool = False) -> bytes:
    """An array of whole numbers, compressed byte plane by byte plane; of a
    sorted one the steps."""
    if sorted_ and len(a):
        a = np.diff(a, prepend=a.dtype.type(0))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def spread(raw: bytes, dtype: type, sorted_: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(dtype).itemsize
    a = np.ascontiguousarray(planes.reshape(width, len(planes) // width).T).view(dtype).ravel()
    return np.cumsum(a, dtype=dtype) if sorted_ else a


def squeezed_cells(cells: np.ndarray) -> bytes:
    """Sorted cells, compressed: the steps between their contexts, which of
    them begin a context, and what tells the cells of a context apart."""
    own = np.uint64(WENT_BITS + 4)
    top = cells >> own
    new = np.append(True, top[1:] != top[:-1])[:len(top)]
    low = squeezed((cells & np.uint64((1 << WENT_BITS + 4) - 1)).astype(np.uint16))
    return len(cells).to_bytes(8, "little") + len(low).to_bytes(8, "little") + np.packbits(new).tobytes() + low + squeezed(top[new], True)


def spread_cells(raw: bytes) -> np.ndarray:
    n, size = (int.from_bytes(raw[at:at + 8], "little") for at in (0, 8))
    at = 16 + -(-n // 8)
    new = np.unpackbits(np.frombuffer(raw[16:at], np.uint8), count=n)
    top = spread(raw[at + size:], np.uint64, True)
    return (top[np.cumsum(new, dtype=np.int64) - 1] << np.uint64(WENT_BITS + 4) | spread(raw[at:at + size], np.uint16)) if n else top


def first_of(cells: np.ndarray | None, n: int) -> list[np.ndarray]:
    """For each bit of sorted cells: which are the first of their slot after
    the bits before, so that others follow from them (without cells: all)."""
    if cells is None:
        return [np.ones(n, bool)] * 4
    steps = cells[1:] ^ cells[:-1]
    return [np.append(True, steps >> np.uint64(4 - bit) != 0)[:n] for bit in range(4)]


def squeezed_bits(bits: np.ndarray, cells: np.ndarray | None = None) -> bytes:
    """What cell_bits gives for sorted distinct ``cells``, compressed.  What
    cells of a slot share travels once.  Of most cells all bits were seen
    alike and no opposite: their first code, and a mark, tell the rest.  Of
    others the opposites follow, and what each code lacks to the one before
    less its opposite (nothing, when counts are small)."""
    codes = bits.view(np.uint8).reshape(-1, 4, 2)
    first, mark = first_of(cells, len(codes)), np.zeros(len(codes), bool)
    own, opposite = (np.ascontiguousarray(codes[:, :, side].T) for side in (0, 1))
    lacks = own[:-1] - own[1:] - opposite[1:]
    for bit in range(4):
        mark |= first[bit] & (opposite[bit] != 0 if not bit else opposite[bit] | lacks[bit - 1] != 0)
    planes = [own[0][first[0]], np.packbits(mark)]
    for bit in range(4):
        told = np.flatnonzero(first[bit] & mark)
        planes += [opposite[bit][told], *([lacks[bit - 1][told]] if bit else [])]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x.tobytes() for x in planes))


def spread_bits(raw: bytes, n: int, cells: np.ndarray | None = None) -> np.ndarray:
    """The ``n`` numbers that squeezed_bits has compressed."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    first = first_of(cells, n)
    at = np.count_nonzero(first[0])
    start, codes = planes[:at], np.empty((n, 4, 2), np.uint8)
    mark = np.unpackbits(planes[at:at + -(-n // 8)], count=n).astype(bool)
    at += -(-n // 8)
    for bit in range(4):
        new = np.flatnonzero(first[bit])
        told = np.flatnonzero(mark[new])
        opposite = np.zeros(len(new), np.uint8)
        opposite[told] = planes[at:at + len(told)]
        own = codes[new, bit - 1, 0] - opposite if bit else start
        if bit:
            own[told] -= planes[at + len(told):at + 2 * len(told)]
        at += len(told) * (2 if bit else 1)
        codes[new, bit, 0], codes[new, bit, 1] = own, opposite
        if len(new) < n:
            again = np.flatnonzero(~first[bit])
            leader = np.searchsorted(new, again) - 1
            other = (cells[again] ^ cells[new[leader]]) >> np.uint64(3 - bit) & np.uint64(1) != 0
            a, b = own[leader], opposite[leader]
            codes[again, bit, 0], codes[again, bit, 1] = np.where(other, b, a), np.where(other, a, b)
    return codes.reshape(n, 8).view(np.uint64).ravel()


def word_order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a block's words travel, sorted in each bucket, and the cuts at its buckets."""
    bucket = (keys[:, 1] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, cuts(bucket[order], buckets)


def send_counts(buckets: int, bits: int) -> Callable:
    """A block's rows to (bucket, block, words, n, cells, times): its words
    and its cells, with their counts; a row for every bucket."""
    def run(found: pa.Table) -> pa.Table:
        own, training = read_block(found, bits)
        keys, n = word_keys(own.words), np.bincount(own.ids[np.repeat(training, own.sizes)], minlength=len(own.words))
        order, words_at = word_order(keys, buckets)
        words, n = [own.words[i] for i in order], n[order]
        cells, cells_at = own.cells, cell_cuts(own.cells, buckets, bits)
        times = own.cell_counts(training).astype(np.uint32)
        pack = zstandard.ZstdCompressor(level=3).compress
        rows = [(pack(b" ".join(words[a:b])), squeezed(n[a:b]), squeezed_cells(cells[c:d]), squeezed(times[c:d]))
                for a, b, c, d in zip(words_at, words_at[1:], cells_at, cells_at[1:], strict=False)]
        return pa.table({"bucket": pa.array(range(buckets), pa.int64()), "block": pa.array([found.column("block")[0].as_py()] * len(rows), pa.int64()),
                         **{name: pa.array([r[i] for r in rows], pa.binary()) for i, name in enumerate(("words", "n", "cells", "times"))}})
    return run


def add_counts(found: pa.Table) -> pa.Table:
    """A bucket's rows to (block, bucket, counts over all blocks, training
    tokens, distinct training words, bits): the bucket's tokens and distinct
    words in each of its rows; counts and bits in the order sent."""
    each = [spread(r, np.int64) for r in found.column("n").to_pylist()]
    n, ends = np.concatenate(each), np.cumsum(list(map(len, each)))
    words = (zstandard.ZstdDecompressor().decompress(r) for r in found.column("words").to_pylist())
    keys = np.concatenate([word_keys(w.split(b" ") if len(x) else []) for w, x in zip(words, each, strict=True)])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ordered = keys[order]
    new = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))[:len(n)]
    total = np.add.reduceat(n[order], np.nonzero(new)[0]) if len(n) else n
    c = np.empty(len(n), np.int64)
    c[order] = total[np.cumsum(new) - 1]
    sent = [spread_cells(r) for r in found.column("cells").to_pylist()]
    at = np.cumsum([0, *map(len, sent)])
    cells, which = distinct(np.concatenate(sent))
    del sent
    times = np.bincount(which, weights=np.concatenate([spread(r, np.uint32) for r in found.column("times").to_pylist()]), minlength=len(cells))
    bits = cell_bits(cells, times)
    return pa.table({"block": found.column("block"), "bucket": found.column("bucket"),
                     "counts": pa.array([squeezed(c[e - len(x):e]) for e, x in zip(ends, each, strict=True)], pa.binary()),
                     "tokens": pa.array([int(n.sum())] * len(each), pa.int64()),
                     "distinct": pa.array([int((total > 0).sum())] * len(each), pa.int64()),
                     "bits": pa.array([squeezed_bits(bits[which[a:b]], cells[which[a:b]]) for a, b in zip(at, at[1:], strict=False)], pa.binary())})


def held_out(id_col: str = "doc_id") -> Column:
    """The contract's held-out rows: not learned from."""
    return crc_text(F.col(f"`{id_col}`")) % 7 == 2


def score_documents(docs: DataFrame, training: Column, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``training``, ``n_bytes`` (of
    what is coded), ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` (log10) and ``bits_per_byte``.

    Learns from the rows where ``training`` holds (null: it does not).
    Null text counts as empty: the end alone is scored.  Null ids and
    repeated rows are scored like any other, and counted as often as they
    occur.  Without training rows every table is empty and every bit costs
    one.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    key = row_key(id_col, text)
    rows = docs.select(key[0], F.coalesce(training, F.lit(False)).alias("training"), whole_text(F.col(f"`{text}`")).alias("text"), key[1])
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, round(size / BLOCK_BYTES))
    n = partitions_for(spark, blocks, 1)
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.select(F.pmod(F.xxhash64("id", "th"), F.lit(blocks)).alias("block"), "id", "training", "text")
    dealt = dealt.mapInArrow(pack_rows, f"block long, id array<{kind}>, training array<boolean>, size array<long>, text binary").repartition(n, "block")
    buckets, width = max(12, blocks), hash_bits(size)
    sent = dealt.groupBy("block").applyInArrow(send_counts(buckets, width), "bucket long, block long, words binary, n binary, cells binary, times binary")
    # a bucket gets each word and each cell once from every block at most, and answers every block
    known = sent.repartition(n, "bucket").groupBy("bucket").applyInArrow(add_counts, "block long, bucket long, counts binary, tokens long, distinct long, bits binary")

    def answers_to(known: pa.Table, own: Block) -> tuple[list[tuple], np.ndarray]:
        """What the buckets answered, in their order, and the bits of the block's cells."""
        answers = sorted(zip(*[known.column(c).to_pylist() for c in ("bucket", "counts", "tokens", "distinct", "bits")], strict=True))
        if [a[0] for a in answers] != list(range(buckets)):
            raise ValueError("a block has not got one answer from every bucket")
        at = cell_cuts(own.cells, buckets, width)
        return answers, np.concatenate([spread_bits(a[4], y - x, own.cells[x:y]) for a, x, y in zip(answers, at, at[1:], strict=False)])

    def fit_block(found: pa.Table, known: pa.Table) -> pa.Table:
        own, training = read_block(found, width)
        return pa.table({"sums": pa.array([fitted(Evidence(own, answers_to(known, own)[1].view("<u2").reshape(-1, 4), training))], pa.list_(pa.float64()))})

    def score_block(found: pa.Table, known: pa.Table) -> pa.Table:
        own, training = read_block(found, width)
        answers, bits = answers_to(known, own)
        all_tokens, distinct = sum(a[2] for a in answers), sum(a[3] for a in answers)
        c = np.empty(len(own.words), np.int64)
        c[word_order(word_keys(own.words), buckets)[0]] = np.concatenate([spread(a[1], np.int64) for a in answers])
        starts, have = np.cumsum(own.sizes) - own.sizes, c[own.ids]
        n_known = np.add.reduceat((have > 0).astype(np.int64), starts)
        base = np.add.reduceat(np.log10(have + 1.0), starts) - own.sizes * np.log10(all_tokens + distinct + 1)
        n_bytes = np.add.reduceat(own.bytes[own.ids], starts)
        score = Model(own, bits, training, weights_of(np.array(known.column("sums")[0].as_py()))).scores(c)
        return pa.table({"id": flat(found.column("id")), "training": flat(found.column("training")), "n_bytes": n_bytes, "n_tokens": own.sizes,
                         "n_known": n_known, "train_tokens": pa.array([all_tokens] * len(base), pa.int64()), "base_score": base,
                         "score": score, "bits_per_byte": -score / np.log10(2) / n_bytes})

    schema = f"id {kind}, training boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    known = known.repartition(n, "block")
    sums = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(fit_block, "sums array<double>").select(F.posexplode("sums"))
    sums = sums.groupBy("pos").agg(F.sum("col").alias("sum")).agg(F.array_sort(F.collect_list(F.struct("pos", "sum")))["sum"].alias("sums"))
    return dealt.groupBy("block").cogroup(known.crossJoin(F.broadcast(sums)).groupBy("block")).applyInArrow(score_block, schema)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score_documents(docs, ~held_out())
    return found.select(F.col("id").alias("doc_id"), (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
