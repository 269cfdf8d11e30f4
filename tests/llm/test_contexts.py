"""The scoring model's contexts are told apart at any size of the corpus."""
import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from keelson.llm import lm_mixing


def brute_cells(texts):
    """(context, bytes before, groups before, value) of every group, and every word with the previous one."""
    out = collections.Counter()
    for t in texts:
        previous = b"\n"
        for w in [*t.lower().split(), b"\n"]:
            out["after", previous, w] += 1
            body = w if w == b"\n" else w + b" "
            for i, b in enumerate(body):
                n = int(lm_mixing._COUNT[b])
                values = [int(v) for v in lm_mixing._VALUE[b][:n]]
                whole = b" " + body[:i] if i else previous + b" "
                for k in lm_mixing.CONTEXTS:
                    for g in range(n):
                        out[k, whole if k == lm_mixing.WORD else whole[-k:], tuple(values[:g]), values[g]] += 1
            previous = w
    return out


def some_texts():
    rnd = random.Random(4)
    return [("".join(rnd.choice("ab eéQ.\0\x1f ") for _ in range(rnd.randint(0, 300)))).encode() for _ in range(40)]


def test_cells_are_exact():
    texts = some_texts()
    block = lm_mixing.Block(texts)
    n = block.cell_counts(np.ones(len(texts), bool))
    want = brute_cells(texts)
    assert len(block.cells) == len(want) and sorted(n.tolist()) == sorted(want.values())
    half = np.arange(len(texts)) % 2 == 0
    assert sorted(block.cell_counts(half)[block.cell_counts(half) > 0].tolist()) == sorted(brute_cells([t for t, h in zip(texts, half, strict=True) if h]).values())
    assert (lm_mixing.Block(texts[::-1]).cells == block.cells).all()


def test_groups_spell_the_texts():
    texts = some_texts()
    block = lm_mixing.Block(texts)
    value = block.cells[block.cell[0]] & np.uint64(15)
    ends = np.cumsum(block.sizes)
    for i, t in enumerate(texts):
        coded = b"".join(w + b" " for w in t.lower().split()) + b"\n"
        groups, each = block.groups(ends[i] - block.sizes[i], ends[i])
        assert value[groups].tolist() == [int(lm_mixing._VALUE[b][g]) for b in coded for g in range(int(lm_mixing._COUNT[b]))]
        assert len(each) == block.sizes[i] and each.sum() == len(groups)


def test_bits_of_cells():
    rnd = random.Random(3)
    counts = {rnd.randrange(1 << 60) << 4 | rnd.randrange(16): rnd.choice([1, 2, 100, 1000, 10 ** 7]) for _ in range(60)}
    slot = rnd.randrange(1 << 59) << 4
    counts |= {slot | v: v + 1 for v in range(16)}
    keys = np.array(sorted(counts), np.uint64)
    got = lm_mixing.cell_bits(keys, np.array([counts[int(x)] for x in keys])).view(np.uint8).reshape(-1, 4, 2)
    for x, row in zip(keys.tolist(), got, strict=True):
        for bit in range(4):
            side = (x & 15) >> (3 - bit)
            for of, code in zip((side, side ^ 1), row[bit], strict=True):
                n = sum(c for y, c in counts.items() if y >> 4 == x >> 4 and (y & 15) >> (3 - bit) == of)
                assert lm_mixing._SEEN[code] <= n and (code == 255 or n < lm_mixing._SEEN[code + 1])


def test_more_contexts_than_any_fixed_table(spark, monkeypatch):
    """Counts over many blocks equal those of one exact model in memory, with
    more contexts than a table of 2**18 slots could hold apart."""
    rnd = random.Random(6)
    rows = [(i, " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(100))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = np.array([i % 5 != 0 for i, _ in rows])
    block = lm_mixing.Block([t.encode() for _, t in rows])
    assert len(np.unique(block.cells >> np.uint64(4))) > 1 << 18
    counts = np.bincount(block.ids[np.repeat(training, block.sizes)], minlength=len(block.words))
    want = lm_mixing.Model(block, lm_mixing.cell_bits(block.cells, block.cell_counts(training)), training).scores(counts)
    found = lambda: {r["id"]: r["score"] for r in lm_mixing.score_documents(docs, F.col("doc_id") % 5 != 0).collect()}
    one = found()
    assert all(one[i] == pytest.approx(want[i], rel=1e-4) for i, _ in rows)
    monkeypatch.setattr(lm_mixing, "BLOCK_BYTES", 200_000)  # each block fits its own first weights
    many = found()
    assert all(many[i] == pytest.approx(want[i], rel=0.02) for i, _ in rows)


def plain_weights(block, bits, training):
    """Newton steps on every training occurrence of every group, one by one."""
    m, n = lm_mixing, block.times(training).astype(int)
    groups = np.repeat(np.nonzero(n)[0], n[n > 0])
    seen = m._SEEN[bits.view(np.uint8).reshape(-1, 4, 2)[block.cell[:, groups]]].reshape(len(m.CONTEXTS), -1, 2)
    yes, no = np.maximum(seen[..., 0] - 1, 0), seen[..., 1]
    x, known = np.log((yes + m.SMOOTH) / (no + m.SMOOTH)), yes + no
    gate = sum(known[-1] >= v for v in m.KNOWN) * (len(m.KNOWN_NEAR) + 1) + sum(known[m.NEAR] >= v for v in m.KNOWN_NEAR)
    out = []
    for g in range((len(m.KNOWN) + 1) * (len(m.KNOWN_NEAR) + 1)):
        own, w = x[:, gate == g], np.full(len(x), m.WEIGHT)
        for _ in range(m.STEPS):
            miss = 1 / (1 + np.exp(np.clip(w @ own, -30, 30)))
            curve = (own * (miss * (1 - miss))) @ own.T + np.eye(len(x)) * m.RIDGE
            w = w + np.clip(np.linalg.solve(curve, own @ miss - m.RIDGE * (w - m.WEIGHT)), -0.5, 0.5)
        out.append(w)
    return np.array(out)


def test_first_weights_come_from_every_training_occurrence():
    """Of more than 2**17 groups none is left out, however often one occurs."""
    rnd = random.Random(8)
    some = ["".join(rnd.choice("abcdefghéQ.") for _ in range(rnd.randint(1, 6))) for _ in range(4000)]
    texts = [" ".join(rnd.choice(some[:3] if rnd.random() < 0.3 else some) for _ in range(200)).encode() for _ in range(150)]
    block, training = lm_mixing.Block(texts), np.arange(150) % 7 != 2
    assert block.times(training).sum() > 1 << 17 and block.times(training).max() > 1 << lm_mixing.TIMES_BITS
    bits = lm_mixing.cell_bits(block.cells, block.cell_counts(training))
    assert np.allclose(lm_mixing.Model(block, bits, training).weights, plain_weights(block, bits, training), atol=1e-9)


def test_blocks_share_their_first_weights(spark, monkeypatch):
    """The weights come from the training occurrences of all blocks: scores
    hardly depend on how documents are dealt."""
    rnd = random.Random(6)
    some = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]
    rows = [(i, " ".join(rnd.choice(some) if i % 2 else some[int(rnd.random() ** 3 * 300)] for _ in range(100))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lambda: {r["id"]: r["score"] for r in lm_mixing.score_documents(docs, F.col("doc_id") % 5 != 0).collect()}
    one = found()
    monkeypatch.setattr(lm_mixing, "BLOCK_BYTES", 60_000)
    many = found()
    assert all(many[i] == pytest.approx(one[i], rel=0.001) for i, _ in rows)


def test_weights_of_a_gate_that_each_block_sees_once():
    """Added up over blocks, the last step holds the weights near their start once, not once a block."""
    k, n = len(lm_mixing.CONTEXTS), 10_000
    slope, curve = np.full((lm_mixing.GATES, k), 0.001), np.zeros((lm_mixing.GATES, k, k))
    weights = np.full((lm_mixing.GATES, k), lm_mixing.WEIGHT)
    one = np.concatenate([[1.0], weights.ravel(), slope.ravel(), np.zeros(weights.size), curve.ravel()])
    assert np.allclose(lm_mixing.weights_of(one * n) - lm_mixing.WEIGHT, 0.5)  # the slope of all is ten: the step is as long as steps may be


def test_what_blocks_and_buckets_send_is_small_and_whole(documents):
    """Cells, their bits, words and texts travel packed; none is lost."""
    m = lm_mixing
    texts = [(t or "").encode() for t in documents.values()]
    block = m.Block(texts, m.hash_bits(sum(map(len, texts))))
    times = block.cell_counts(np.arange(len(texts)) % 7 != 2)
    bits = m.cell_bits(block.cells, times)
    assert (m.spread_cells(m.squeezed_cells(block.cells)) == block.cells).all()
    assert (m.spread_bits(m.squeezed_bits(bits), len(bits)) == bits).all()
    assert len(m.squeezed_cells(block.cells)) < 0.9 * len(m.squeezed(block.cells, True))
    assert len(m.squeezed_bits(bits)) < 0.7 * len(m.squeezed(bits))
    any_bits = np.frombuffer(random.Random(7).randbytes(8 * 1001), np.uint64)
    assert (m.spread_bits(m.squeezed_bits(any_bits), 1001) == any_bits).all()
    nothing = np.empty(0, np.uint64)
    assert len(m.spread_cells(m.squeezed_cells(nothing))) == len(m.spread_bits(m.squeezed_bits(nothing), 0)) == 0
    rows = pa.RecordBatch.from_pydict({"block": pa.array([i % 3 for i in range(len(texts))], pa.int64()), "id": [None if i % 5 == 0 else f"d{i}" for i in range(len(texts))],
                                       "training": [i % 7 != 2 for i in range(len(texts))], "text": [t.decode() for t in texts]})
    packed = pa.Table.from_batches(m.pack_rows(iter([rows, rows.slice(0, 0)])))
    assert packed.column("block").to_pylist() == [0, 1, 2] and sum(map(len, packed.column("text").to_pylist())) < 0.7 * sum(map(len, texts))
    for b in range(3):
        own, want = packed.slice(b, 1), rows.take(pa.array(range(b, len(texts), 3)))
        assert m.flat(own.column("id")).to_pylist() == want.column("id").to_pylist()
        read, training = m.read_block(own, m.MOST_BITS)
        assert training.tolist() == want.column("training").to_pylist()
        assert (read.cells == m.Block(texts[b::3]).cells).all() and (read.ids == m.Block(texts[b::3]).ids).all()
        sent = m.send_counts(4, m.MOST_BITS)(own)
        words = [w for r in sent.column("words").to_pylist() for w in zstandard.ZstdDecompressor().decompress(r).split(b" ")]
        assert sorted(words) == sorted(read.words)
        assert sum(map(len, sent.column("words").to_pylist())) < 0.6 * 16 * len(words)


def peak(run):
    """The most bytes held at a time by a run, and what it returns."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_block_takes_little_memory():
    """An executor holds two blocks beside its heap: what is made of one on the way is small."""
    m, rnd = lm_mixing, random.Random(6)
    some = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(20_000)]
    texts = [" ".join(rnd.choices(some, k=500)).encode() for _ in range(400)]
    m.Block(texts[:2])  # what is imported at first use does not count
    assert peak(lambda: m.Block(texts))[1] < 26 * sum(map(len, texts))


@pytest.mark.parametrize("numbers", [[], [5], [1 << 63, 0, 1 << 63, (1 << 63) + 1], [(1 << 64) - 1 - i % 7 for i in range(3000)]])
def test_the_order_of_64_bit_numbers(numbers):
    """Equal ones as they come, whatever the upper bits are."""
    keys = np.array(numbers, np.uint64)
    assert lm_mixing.ordered(keys).tolist() == np.argsort(keys, kind="stable").tolist()
    found, first, which = lm_mixing.distinct(keys, True)
    assert found.tolist() == sorted(set(numbers)) and found[which].tolist() == numbers
    assert first.tolist() == [numbers.index(x) for x in found.tolist()]


def test_what_cells_of_a_slot_share_travels_once():
    rnd = random.Random(9)
    cells = np.array(sorted({rnd.randrange(1 << 12) << 30 | rnd.randrange(16) for _ in range(40_000)}), np.uint64)
    bits = lm_mixing.cell_bits(cells, np.array([rnd.choice([0, 1, 1, 2, 9, 300, 10 ** 6]) for _ in cells.tolist()]))
    raw = lm_mixing.squeezed_bits(bits, cells)
    assert (lm_mixing.spread_bits(raw, len(cells), cells) == bits).all()
    assert len(raw) < 0.6 * len(lm_mixing.squeezed_bits(bits))
    some = np.array([rnd.random() < 0.3 for _ in cells.tolist()])  # a block asks for some of a slot's cells
    assert (lm_mixing.spread_bits(lm_mixing.squeezed_bits(bits[some], cells[some]), some.sum(), cells[some]) == bits[some]).all()
    nothing = cells[:0]
    assert len(lm_mixing.spread_bits(lm_mixing.squeezed_bits(nothing, nothing), 0, nothing)) == 0
