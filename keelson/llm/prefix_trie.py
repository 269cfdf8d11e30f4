"""Prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation is the head of another one followed by its own later
turns.  No rebuilt text is ever made.  Each turn is an element of a monoid,
the pair (hash, factor) under

    (h1, f1) * (h2, f2) = (h1 * f2 + h2, f1 * f2)      modulo 2^61 - 1,

so a prefix's fingerprint is the product of its turns', a conversation's
turns need one scan, and what follows a head is combined with it by one
multiplication: with P the original conversation's products, H the head's
product and h the turns that the head replaces,

    product(head, turns h+1..j) = (H - P[h]) * factor^(j - h) + P[j].

Two such products (122 bits) and the depth name a node.  Equality does not
rest on them: the texts of equal turn digests are compared as bytes, and all
members of a node must agree in the digest of their last turn (a reference to
the stored turn) and in the parent node, which settles the whole prefix by
induction.  A clash draws new factors.

A conversation's turns may be a third of all: they are range-partitioned by
(conversation, turn), each slice is scanned alone, and the slices' products
are combined, two rows of each slice.

A node belongs to its smallest member.  The nodes that a conversation owns
are the lower end of its own path, so a sum over a subtree is the sum, over
the node's members, of all that they own, less what the owner owns above the
node: no level-by-level walk, however deep the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators.sequences import ordered_scan

from .common import stored, table, whole_text

#: Every so many conversations, one is the base of all up to the next.
STEP = 5
#: A head has fewer than so many turns.
HEADS = 9
#: The modulus of the fingerprints, a Mersenne prime.
PRIME = (1 << 61) - 1
#: Fixed factors of the two fingerprints, for each attempt.
FACTORS = [(0x1B873593CC9E2D51 % PRIME, 0x0F58476D1CE4E5B9 % PRIME), (0x14D049BB133111EB % PRIME, 0x1E3779B97F4A7C15 % PRIME),
           (0x0B55A4F09B97F4A7 % PRIME, 0x165667B19E3779F9 % PRIME)]
#: Bytes of joined ids that one row of a slice holds at most.
CHUNK = 1 << 16


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn; the role's length keeps role and text apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def element(digest: str, half: int) -> int:
    """The hash of a turn's element: half a digest, never zero."""
    return int(digest[16 * half: 16 * half + 15], 16) % (PRIME - 1) + 1


def scan(factors: tuple[int, int]):  # noqa: ANN201
    """Rows of a slice, sorted, to products from the slice's or the
    conversation's start: ``ord`` and, for both factors, ``p`` (with the
    row), ``q`` (before it) and ``m`` (the factor to the power ``ord - 1``)."""
    fa, fb = factors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, pa_, pb, ma, mb = None, 0, 0, 0, 1, 1
        for b in batches:
            convs, digests = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[tuple] = []
            for c, d in zip(convs, digests, strict=True):
                if c != conv:
                    conv, at, pa_, pb, ma, mb = c, 0, 0, 0, 1, 1
                qa, qb = pa_, pb
                pa_, pb = (pa_ * fa + element(d, 0)) % PRIME, (pb * fb + element(d, 1)) % PRIME
                at += 1
                out.append((at, pa_, pb, qa, qb, ma, mb))
                ma, mb = ma * fa % PRIME, mb * fb % PRIME
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(7)]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, "ord", "pa", "pb", "qa", "qb", "ma", "mb"])
    return run


def modulo(c: Column) -> Column:
    return F.pmod(c.cast("decimal(38,0)"), F.lit(PRIME).cast("decimal(38,0)")).cast("long")


def times(a: Column, b: Column, plus: Column | None = None) -> Column:
    """a * b (+ plus) modulo the prime: 122 bits fit a decimal."""
    product = a.cast("decimal(19,0)") * b.cast("decimal(19,0)")
    return modulo(product if plus is None else product.cast("decimal(38,0)") + plus.cast("decimal(19,0)"))


def carried(last: DataFrame, factors: tuple[int, int]) -> DataFrame:
    """``slice``, ``conv``: products of a conversation's turns in all earlier
    slices.  ``last`` has one row for each conversation that begins or ends a
    slice with turns: at most two for each slice."""
    fa, fb = factors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, ha, hb = None, 0, 0, 0
        for b in batches:
            out: list[tuple] = []
            for c, s, k, la, lb in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                if c != conv:
                    conv, n, ha, hb = c, 0, 0, 0
                out.append((c, s, n, ha, hb, pow(fa, n, PRIME), pow(fb, n, PRIME)))
                ha, hb, n = (ha * pow(fa, k, PRIME) + la) % PRIME, (hb * pow(fb, k, PRIME) + lb) % PRIME, n + k
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(7)], names=["conv", "slice", "n0", "ha", "hb", "fa", "fb"])

    # ordered in one task: its rows are bounded by the number of slices
    one = last.select("conv", "slice", "n", "la", "lb").coalesce(1).sortWithinPartitions("conv", "slice")
    return one.mapInArrow(run, "conv long, slice long, n0 long, ha long, hb long, fa long, fb long")


def products(turns: DataFrame, factors: tuple[int, int]) -> DataFrame:
    """``conv``, ``digest``, ``size``, ``ord`` (from 1), ``pa pb`` (products of
    the conversation up to the turn), ``qa qb`` (before it), ``ma mb``
    (factor to the power ord - 1).  A range partition of the turns, sorted,
    is a slice; it is scanned where it is sorted."""
    spark = turns.sparkSession
    schema = "conv long, digest string, size long, slice long, ord long, pa long, pb long, qa long, qb long, ma long, mb long"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    cut = turns.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv", "digest", "size", F.spark_partition_id().cast("long").alias("slice"))
    sliced = stored(spark, cut.mapInArrow(scan(factors), schema), "products")
    ends = sliced.groupBy("slice").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    ends = ends.select("slice", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv"))
    last = (sliced.join(F.broadcast(ends), ["slice", "conv"]).groupBy("conv", "slice")
            .agg(F.max("ord").alias("n"), F.max_by("pa", "ord").alias("la"), F.max_by("pb", "ord").alias("lb")))
    before = stored(spark, carried(last, factors).where("n0 > 0"), "carried")
    rows = sliced.join(F.broadcast(before), ["slice", "conv"], "left").fillna({"n0": 0, "ha": 0, "hb": 0, "fa": 1, "fb": 1})
    head = F.col("n0") > 0

    def after(p: str, f: str, h: str, m: str, factor: int) -> Column:
        # earlier slices' product times the factor of what this slice adds, plus its own
        power = times(F.col(m), F.lit(factor)) if p[0] == "p" else F.col(m)
        return F.when(head, times(F.col(h), power, F.col(p))).otherwise(F.col(p)).alias(p)

    fa, fb = factors
    return rows.select(
        "conv", "digest", "size", (F.col("ord") + F.col("n0")).alias("ord"),
        after("pa", "fa", "ha", "ma", fa), after("pb", "fb", "hb", "mb", fb), after("qa", "fa", "ha", "ma", fa), after("qb", "fb", "hb", "mb", fb),
        F.when(head, times(F.col("ma"), F.col("fa"))).otherwise(F.col("ma")).alias("ma"), F.when(head, times(F.col("mb"), F.col("fb"))).otherwise(F.col("mb")).alias("mb"))


def positions(own: DataFrame, factors: tuple[int, int]) -> DataFrame:
    """One row for each conversation and depth of its rebuilt form, root
    included: ``conv``, ``depth``, ``a b`` (fingerprint), ``ua ub`` (parent's),
    ``digest``, ``size`` (of the last turn), ``last`` (it is the whole)."""
    spark = own.sparkSession
    counts = own.groupBy("conv").agg(F.max("ord").alias("n"))
    # at most HEADS - 1 turns of a base
    heads = own.where(F.col("ord") < HEADS).select(F.col("conv").alias("base"), "ord", "pa", "pb", "qa", "qb", "digest", "size")
    asked = counts.select("conv", "n", (F.col("conv") - F.col("conv") % STEP).alias("base"),
                                                      (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h"))
    head = asked.join(heads, (asked["base"] == heads["base"]) & (F.col("ord") <= F.col("h"))).select(
        "conv", F.col("ord").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("qa").alias("ua"), F.col("qb").alias("ub"), "digest", "size")
    head = stored(spark, head, "heads")
    reach = head.groupBy("conv").agg(F.max("depth").alias("k"), F.max_by("a", "depth").alias("xa"), F.max_by("b", "depth").alias("xb"))
    skipped = (own.where(F.col("ord") < HEADS).join(asked.select("conv", "h"), "conv").where("ord = h")
               .select("conv", F.col("pa").alias("sa"), F.col("pb").alias("sb")))
    # (head - what it replaces) over factor^h: one number for all of a conversation's own turns
    back = [F.element_at(F.array(*[F.lit(pow(f, -i, PRIME)) for i in range(HEADS)]), (F.col("h") + 1).cast("int")) for f in factors]
    zero = F.lit(0).cast("long")
    info = asked.join(reach, "conv", "left").join(skipped, "conv", "left").fillna({"k": 0, "xa": 0, "xb": 0, "sa": 0, "sb": 0})
    info = stored(spark, info.select("conv", "n", "h", "k", *[times(modulo(F.col(f"x{s}").cast("decimal(20,0)") - F.col(f"s{s}")), inv).alias(f"d{s}") for s, inv in zip("ab", back, strict=True)],
                                     (F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)).alias("total")), "rebuilt")
    tail = own.join(info.drop("n", "total"), "conv").where("ord > h")
    up = [times(F.col(f"m{s}"), F.lit(f)) for s, f in zip("ab", factors, strict=True)]
    tail = tail.select("conv", (F.col("k") + F.col("ord") - F.col("h")).alias("depth"),
                       *[times(F.col(f"d{s}"), u, F.col(f"p{s}")).alias(s) for s, u in zip("ab", up, strict=True)],
                       *[times(F.col(f"d{s}"), F.col(f"m{s}"), F.col(f"q{s}")).alias(f"u{s}") for s in "ab"], "digest", "size")
    root = info.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("ua"), zero.alias("ub"), F.lit("").alias("digest"), zero.alias("size"))
    ends = info.select("conv", F.col("total").alias("depth"), F.lit(True).alias("last"))
    rows = root.unionByName(head).unionByName(tail)
    return stored(spark, rows.join(ends, ["conv", "depth"], "left").withColumn("last", F.col("last").isNotNull()), "positions")


def joined_ids(members: DataFrame) -> DataFrame:
    """``node``, ``sha``: SHA-256 of each node's ids (``conv``), ascending and
    comma-joined.  Ids are sorted and joined by slices, so a node's may lie in
    many; the digest itself runs through a node's pieces in order and holds
    one of them at a time."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([first], pa.int64()), pa.array([",".join(ids)])], names=["node", "first", "ids"])
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != node or size > CHUNK:
                    if ids:
                        yield piece()
                    node, first, ids, size = k, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
        done: list[tuple[str, str]] = []
        for node, ids in groupby(pieces, key=lambda x: x[0]):
            h, comma = hashlib.sha256(), b""
            for _, x in ids:
                h.update(comma + x.encode())
                comma = b","
            done.append((node, h.hexdigest()))
            if len(done) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done])], names=["node", "sha"])
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done])], names=["node", "sha"])

    parts = (members.select("node", "conv").repartitionByRange(n, "node", "conv").sortWithinPartitions("node", "conv")
             .mapInArrow(join, "node string, first long, ids string"))
    return parts.repartition(n, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node string, sha string")


def own_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns without their texts: ``conv``, ``turn``, ``role``, ``digest``,
    ``size``; texts of equal digests are compared here."""
    q = lambda c: F.col(f"`{c}`")
    rows = (conversations.where(q(conv_id).isNotNull())
            .select(q(conv_id).cast("long").alias("conv"), q(turn).alias("turn"), whole_text(q(role)).alias("role"), whole_text(q(text)).alias("text")))
    digests = rows.withColumn("digest", turn_digest(F.col("role"), F.col("text")))
    # copies are added up map-side
    clash = digests.groupBy("digest", "role", "text").agg(F.lit(1).alias("one")).groupBy("digest").count().where("count > 1")
    if clash.limit(1).count():
        raise ValueError("two different turns have the same MD5 digest")
    return digests.select("conv", "turn", "role", "digest", F.octet_length("text").cast("long").alias("size"))


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns go by ``turn``, null first; turns that tie go by role, then by the
    digest of role and text.  Null role or text counts as empty; rows with a
    null conversation id belong to none and are left out.  Repeated rows are
    turns of their own.  Other columns are not read.  An empty table has no
    nodes.
    """
    spark = conversations.sparkSession
    turns = own_turns(conversations, conv_id, turn, role, text)
    key = ["depth", "a", "b"]
    for factors in FACTORS:
        rows = positions(products(turns, factors), factors)
        nodes = stored(spark, rows.groupBy(*key).agg(
            F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.max("ua").alias("ua"), F.max("ub").alias("ub"),
            ((F.min("digest") == F.max("digest")) & (F.min("ua") == F.max("ua")) & (F.min("ub") == F.max("ub"))).alias("same")), "nodes")
        if not nodes.where("not same").limit(1).count():
            break
    else:
        raise ValueError("prefixes clash in all fingerprints")
    # a node's children, counted at their parent
    under = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(under, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = stored(spark, nodes.withColumn("weight", (F.col("n") - 1) * F.col("size")).drop("same"), "weighed")
    # what a conversation owns: the weight of its nodes, and its leaf if it has one
    owned = nodes.groupBy("owner").agg(F.sum("weight").alias("weight"), F.count_if(F.col("n_children") == 0).alias("leaves"), F.min("depth").alias("top"))
    owned = stored(spark, owned, "owned")
    per_member = rows.select("conv", *key).join(owned.select(F.col("owner").alias("conv"), "weight", "leaves"), "conv")
    below = per_member.groupBy(*key).agg(F.sum("weight").alias("all_weight"), F.sum("leaves").alias("n_leaves"))
    upto = ordered_scan(nodes.select("owner", *key, "weight"), ["owner"], ["depth"], running_sum={"upto": F.col("weight")}).select(
        *key, (F.col("upto") - F.col("weight")).alias("above"))
    # a parent has the same owner, except above the top of what an owner has
    tops = nodes.join(owned.select("owner", "top"), "owner").where("depth = top and depth > 0").select("owner", (F.col("depth") - 1).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b"))
    parents = tops.join(nodes.select(*key, F.col("owner").alias("parent")), key).select("owner", (F.col("depth") + 1).alias("depth"), "parent")
    node = F.concat_ws(".", *key).alias("node")
    ends = joined_ids(rows.where("last").select(node, "conv"))
    out = (nodes.join(below, key).join(upto, key).join(parents, ["owner", "depth"], "left")
           .select(F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"),
                   F.col("n").alias("n_convs"), "n_children", F.col("n_leaves").cast("long").alias("n_leaves"),
                   (F.col("all_weight") - F.col("above")).cast("long").alias("saved_tokens"), node))
    nothing = hashlib.sha256(b"").hexdigest()
    return out.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(nothing))).drop("node", "sha")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
