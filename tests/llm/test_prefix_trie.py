"""Prefix trie of rebuilt conversations against a plain version."""
import collections
import hashlib
import random
import zlib

from keelson.llm import prefix_trie as T
from keelson.llm import queries as Q
from keelson.llm.common import table

from .conftest import CLASHING, SF, bag

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    """All prefixes spelled out."""
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    return collections.Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                                hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))


def drawn(seed, k):
    rnd = random.Random(seed)
    word = lambda: (rnd.choice(["user", "assistant", None, ""]), rnd.choice(["hi", "é", "", None, "long " * 50]))
    return [(c, i, *word()) for c in rnd.sample(range(k), k // 2) for i in range(rnd.choice([0, 1, 2, 3, 9, 12]))]


def test_drawn_conversations(spark):
    rows = drawn(0, 120)
    assert bag(T.prefix_trie(conversations(spark, rows)), *COLUMNS) == plain_trie(rows)


def test_edge_cases(spark):
    rows = [(0, None, "user", "first"), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "b"), (1, 5, None, None), (2, 0, "us", "er a"), (3, 0, "user", " a"),
            (None, 0, "user", "no conversation"), (-3, 0, "user", "negative"), (-5, 0, "user", "base"), (7, 0, "", ""), (7, 0, "", ""), (9, 2, "user", "x"), (9, None, "user", "y")]
    got = T.prefix_trie(conversations(spark, rows))
    assert got.columns == COLUMNS and bag(got, *COLUMNS) == plain_trie(rows)
    assert T.prefix_trie(conversations(spark, rows).limit(0)).count() == 0


def test_one_conversation_over_many_slices_and_many_copies(spark, monkeypatch):
    """A conversation with most of the turns, and one that is repeated: both
    are cut, and the joined ids need many pieces."""
    monkeypatch.setattr(T, "CHUNK", 10)
    long = [(5, i, "user", f"t{i % 7}") for i in range(1500)] + [(c, i, "user", f"t{i % 7}") for c in (6, 8) for i in range(700)]
    copies = [(10 * c, i, "user", "same") for c in range(100, 500) for i in range(2)]
    rows = long + copies
    want = plain_trie(rows)
    assert bag(T.prefix_trie(conversations(spark, rows)), *COLUMNS) == want


def test_products_compose():
    """A product does not depend on where a sequence is cut."""
    f = T.FACTORS[0][0]
    mul = lambda x, y: ((x[0] * y[1] + y[0]) % T.PRIME, x[1] * y[1] % T.PRIME)
    rnd = random.Random(1)
    turns = [(rnd.randrange(1, T.PRIME), f) for _ in range(30)]
    fold = lambda xs: __import__("functools").reduce(mul, xs, (0, 1))
    for cut in range(31):
        assert mul(fold(turns[:cut]), fold(turns[cut:])) == fold(turns)


def test_clashing_fingerprints_draw_new_factors(spark, monkeypatch):
    """With the factor 1 a product is a sum, and turns in another order clash."""
    rows = [(0, 0, "user", "a"), (0, 1, "user", "b"), (10, 0, "user", "b"), (10, 1, "user", "a")]
    monkeypatch.setattr(T, "FACTORS", [(1, 1), *T.FACTORS])
    assert bag(T.prefix_trie(conversations(spark, rows)), *COLUMNS) == plain_trie(rows)


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert bag(Q.QUERIES["op13_prefix_trie"](spark, SF), *COLUMNS) == plain_trie(rows)
