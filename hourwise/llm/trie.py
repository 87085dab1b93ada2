"""Prefix trie of conversations, from vertical bitmaps.

1. Turns are numbered within their conversation: a range-partitioned sort by (conv_id, turn, digest), positions inside
   a partition and the counts of lower partitions, so that no task holds a whole long conversation. The text is only
   digested (SHA-256) and measured; it is never shuffled. Then the conversations are rebuilt.
2. A node is named by its depth and the exclusive or of SHA-256 parts of its (position, turn) pairs, so names of
   prefixes add up over parts of a conversation. Conversations are cut into parts of ``PART`` turns.
3. A shard holds ``SHARD`` neighbouring conversation ids of one part number. In it, every (position, turn) is
   indexed to the bitset of the shard's conversations that have it; a depth-first walk intersects the parent's bitset
   with the postings of the next position, which gives the children; popcounts, first members and the lists of
   conversations that end are read off the bitsets. At the top of a shard stand the prefixes at which its parts begin.
4. Nodes of all shards are merged in name order, shard by shard, so the ids that end at a node come in order and are hashed as
   they stream by.
5. The first depth at which a conversation is the smallest member is the first of its own nodes; every turn before it is
   saved. With these, a second walk sums over each node's members the code points saved from its depth on, and the members
   that own a childless node; both sums add up over shards and give the values of whole subtrees without
   visiting ancestors.

Defined cases: turns are ordered by turn, null first, ties by the digest of role and text; equal rows count each.
Null role or text is empty. Rows without a conv_id belong to no conversation. An empty table has no conversation and no
node, not even the root. A conversation may have any number of turns and a turn any length; a conversation of
which no turn is left is a member of the root. Only conv_id, turn, role and text are read; other columns, whatever their names, are not looked
at. conv_id must be an integer.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwise.llm.common import fresh_join, running_offsets, travels
from hourwise.session import discard, materialize

travels(__name__)

#: Turns of a conversation that one walk sees.
PART_BITS = 5
PART = 1 << PART_BITS
#: Neighbouring conversation ids of a shard.
SHARD_BITS = 7
SHARD = 1 << SHARD_BITS
#: Parts whose carries are added up first.
WIDTH = 512
#: Most turns taken from the base conversation, and how ids are grouped under it.
HEADS, FAMILY = 6, 100
NODE = "ka long, kb long, depth long"


def _parts_of(digest):
    """Two numbers of 60 bits each of a hexadecimal digest."""
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "a"), (16, "b"))]


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((conv_id, pos, a, b, n) of every turn, pos from 1, (conv_id, n_own), the written table behind both)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    t = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("d"), F.length(text).cast("long").alias("n"))
         .filter("conv_id is not null").select("conv_id", "turn", *_parts_of("d"), "n"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "a", "b"]
    # equal rows may go to several partitions: their order does not matter
    at = F.monotonically_increasing_id()
    s = materialize(t.repartitionByRange(*order, F.xxhash64(at)).sortWithinPartitions(*order).drop("turn").withColumn("at", at),
                    "trie_turns").withColumn("bucket", F.shiftright("at", 33))
    heads = s.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = running_offsets(heads, "conv_id", "bucket", "n").filter("before > 0")  # one conversation a bucket at most
    w = Window.partitionBy("conv_id", "bucket").orderBy("at")
    rows = s.withColumn("place", F.row_number().over(w))
    return (rows.join(before, ["conv_id", "bucket"], "left")
            .select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "a", "b", "n"),
            heads.groupBy("conv_id").agg(F.sum("n").alias("n_own")), s)


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, ka, kb, n, total), conversations of no turn): the first turns of the base conversation, then the
    conversation's own turns after as many."""
    c = convs.withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % HEADS, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    sizes = convs.select(F.col("conv_id").alias("base"), F.least("n_own", F.lit(HEADS - 1)).alias("n_base"))
    c = (c.join(sizes, "base", "left")
         .withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
         .withColumn("total", F.col("taken") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))))
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    taken = (c.filter("taken > 0").join(first, "base").filter("pos <= taken")
             .select("conv_id", "pos", "a", "b", "n", "total"))
    own = turns.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % HEADS).filter("pos > h")
    own = (fresh_join(own, c.select("conv_id", "taken", "total"), ["conv_id"])
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "n", "total"))
    digest = F.sha2(F.concat_ws(":", "pos", "a", "b"), 256)
    named = (taken.unionByName(own).withColumn("d", digest)
             .select("conv_id", "pos", *[x.alias("k" + name) for x, name in zip(_parts_of("d"), "ab")], "n", "total"))
    return named, c.filter("total = 0").select("conv_id")


def _carried(parts: DataFrame, values: list[str], add, down: bool = False) -> DataFrame:
    """(conv_id, seg, values): ``add`` of each value over the lower (``down``: the higher) parts of the conversation, in two levels."""
    order = lambda c: F.col(c).desc() if down else F.col(c)
    over = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    p = parts.select("conv_id", "seg", F.floor(F.col("seg") / WIDTH).alias("sup"), *values)
    inner = over(Window.partitionBy("conv_id", "sup").orderBy(order("seg")))
    near = p.select("conv_id", "seg", "sup", *[add(v).over(inner).alias(v) for v in values])
    outer = over(Window.partitionBy("conv_id").orderBy(order("sup")))
    far = p.groupBy("conv_id", "sup").agg(*[add(v).alias(v) for v in values]).select(
        "conv_id", "sup", *[add(v).over(outer).alias(f"far_{v}") for v in values])
    both = near.join(far, ["conv_id", "sup"])
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = (lambda v: zero(v).bitwiseXOR(zero(f"far_{v}"))) if add is F.bit_xor else (lambda v: zero(v) + zero(f"far_{v}"))
    return both.select("conv_id", "seg", *[joined(v).alias(v) for v in values])


def conversation_parts(named: DataFrame, bare: DataFrame) -> DataFrame:
    """(shard, seg, conv_id, ka, kb, last, turns): parts of PART turns with the name of the prefix before them."""
    p = (named.groupBy("conv_id", F.shiftright(F.col("pos") - 1, PART_BITS).alias("seg"))
         .agg(F.sort_array(F.collect_list(F.struct("pos", "ka", "kb", "n"))).alias("turns"), F.bit_xor("ka").alias("ka"),
              F.bit_xor("kb").alias("kb"), F.first("total").alias("total")))
    p = p.withColumn("last", F.shiftright(F.col("total") - 1, PART_BITS) == F.col("seg"))
    entry = _carried(p.filter("total > %d" % PART), ["ka", "kb"], F.bit_xor)
    begun = (p.filter("total > %d" % PART).drop("ka", "kb").join(entry, ["conv_id", "seg"])
             .unionByName(p.filter("total <= %d" % PART).withColumns({"ka": F.lit(0).cast("long"), "kb": F.lit(0).cast("long")})))
    none = bare.select("conv_id", F.lit(0).cast("long").alias("seg"), F.lit(0).cast("long").alias("ka"),
                       F.lit(0).cast("long").alias("kb"), F.lit(True).alias("last"),
                       F.array().cast(p.schema["turns"].dataType).alias("turns"))
    cols = ["conv_id", F.col("seg").cast("long").alias("seg"), "ka", "kb", "last", "turns"]
    return begun.select(*cols).unionByName(none.select(*cols)).withColumn("shard", F.shiftright("conv_id", SHARD_BITS))


# ---------------------------------------------------------------- the walk of a shard

def _bits(x: int):
    """Places of the bits of a bitset."""
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def walk(convs: list[tuple]):
    """Nodes of a shard: (bitset of members, depth in the part, names of the node and its parent, length of its last text, bitset of
    the members that end). ``convs``, by conversation id: (conv_id, (ka, kb), last, [(pos, ka, kb, n)])."""
    postings: dict[tuple, int] = {}
    longer: list[int] = []   # by depth: the conversations with more turns in this part
    ending: list[int] = [0] * (PART + 1)
    tops: dict[tuple, int] = {}
    for i, (_, top, last, turns) in enumerate(convs):
        tops[top] = tops.get(top, 0) | 1 << i
        for d, (_, ka, kb, _) in enumerate(turns):
            if d == len(longer):
                longer.append(0)
            longer[d] |= 1 << i
            postings[d, ka, kb] = postings.get((d, ka, kb), 0) | 1 << i
        if last:
            ending[len(turns)] |= 1 << i
    stack = [(bits, 0, top, None, 0) for top, bits in tops.items()]
    while stack:
        bits, d, name, parent, n = stack.pop()
        yield bits, d, name, parent, n, bits & ending[d]
        rest = bits & longer[d] if d < len(longer) else 0
        while rest:
            _, ka, kb, n = convs[(rest & -rest).bit_length() - 1][3][d]
            child = rest & postings[d, ka, kb]
            rest ^= child
            stack.append((child, d + 1, (name[0] ^ ka, name[1] ^ kb), name, n))


def _convs(table: pa.Table):
    t = table.sort_by("conv_id")
    cols = [t.column(c).to_pylist() for c in ("conv_id", "ka", "kb", "last", "turns")]
    return [(c, (ka, kb), last, [(x["pos"], x["ka"], x["kb"], x["n"]) for x in turns]) for c, ka, kb, last, turns in zip(*cols)]


_NODES = NODE + ", pa long, pb long, shard long, n_convs long, conv_id long, n long, n_ends long, ends string"


def _shard_nodes(key, table):
    seg, shard, convs, out = key[0].as_py(), key[1].as_py(), _convs(table), []
    for bits, d, name, parent, n, ends in walk(convs):
        if d == 0 and seg > 0:
            continue  # the end of the part before
        ids = [convs[i][0] for i in _bits(ends)]
        out.append((*name, seg * PART + d, *(parent or (None, None)), shard, bits.bit_count(),
                    convs[(bits & -bits).bit_length() - 1][0], n, len(ids), ",".join(map(str, ids))))
    return _table(out, _NODES)


_SUMS = NODE + ", n_leaves long, saved long"


def _shard_sums(key, table):
    """Sums over each node's members; the table also has own (the first depth that the conversation owns, or null), leaf and after."""
    seg, t, out = key[0].as_py(), table.sort_by("conv_id"), []
    convs = _convs(t)
    leaf = t.column("leaf").to_pylist()
    saved = []  # by conversation: the code points saved from each depth of the part on
    for (_, _, _, turns), own, after in zip(convs, t.column("own").to_pylist(), t.column("after").to_pylist()):
        sums = [after]
        for pos, _, _, n in reversed(turns):
            sums.append(sums[-1] + (n if own is None or pos < own else 0))
        saved.append(sums[::-1])
    for bits, d, name, _, _, _ in walk(convs):
        if d == 0 and seg > 0:
            continue
        # a node of depth d saves from its own last turn on, the root from the first turn on
        i = list(_bits(bits))
        out.append((*name, seg * PART + d, sum(leaf[k] for k in i), sum(saved[k][max(0, d - 1)] for k in i)))
    return _table(out, _SUMS)


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    fields = [f.split() for f in ddl.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


_MERGED = NODE + ", pa long, pb long, n_convs long, conv_id long, n_ends long, ends_sha256 string"


def _merge(batches):
    """Sums the shards' rows of each node, which come one after another in the order of their shards; ids are hashed as they come."""
    state, hashed = None, None
    out: list[tuple] = []
    close = lambda: out.append((*state, hashed.hexdigest()))
    for batch in batches:
        for ka, kb, depth, pa_, pb, _, n, low, _, n_ends, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or (ka, kb, depth) != state[:3]:
                if state:
                    close()
                state, hashed = (ka, kb, depth, pa_, pb, 0, low, 0), hashlib.sha256()
            if n_ends:
                hashed.update((("," if state[7] else "") + ends).encode())
            state = (*state[:5], state[5] + n, min(state[6], low), state[7] + n_ends)
        if out:
            yield from _table(out, _MERGED).to_batches()
            out.clear()
    if state:
        close()
        yield from _table(out, _MERGED).to_batches()


# ---------------------------------------------------------------- the trie

def trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)."""
    turns, convs, sorted_turns = numbered_turns(conversations)
    parts = materialize(conversation_parts(*rebuilt(turns, convs)), "trie_parts")
    discard(sorted_turns)
    shards = parts.groupBy("seg", "shard").applyInArrow(_shard_nodes, _NODES)
    nodes = materialize(shards.repartition("ka", "kb", "depth").sortWithinPartitions("ka", "kb", "depth", "shard")
                        .mapInArrow(_merge, _MERGED), "trie_nodes")
    own = nodes.groupBy("conv_id").agg(F.min("depth").alias("own"), F.max((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("leaf"))
    p = fresh_join(parts, own, ["conv_id"], "left").withColumn("leaf", F.coalesce("leaf", F.lit(0)))
    early = F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + F.when(
        F.col("own").isNull() | (t["pos"] < F.col("own")), t["n"]).otherwise(0))
    long = p.filter(~F.col("last") | (F.col("seg") > 0))
    after = _carried(long.withColumn("after", early).select("conv_id", "seg", "after"), ["after"], F.sum, down=True)
    p = (long.join(after, ["conv_id", "seg"], "left").unionByName(
        p.filter(F.col("last") & (F.col("seg") == 0)).withColumn("after", F.lit(0).cast("long"))))
    sums = (p.groupBy("seg", "shard").applyInArrow(_shard_sums, _SUMS))
    key = ["ka", "kb", "depth"]
    fill = lambda df, **own_cols: df.select(*key, *[(own_cols[c] if c in own_cols else F.lit(None)).cast(k).alias(c) for c, k in (
        ("pa", "long"), ("pb", "long"), ("n_convs", "long"), ("conv_id", "long"), ("ends_sha256", "string"), ("n_children", "long"),
        ("n_leaves", "long"), ("saved", "long"))])
    c = F.col
    children = nodes.filter("depth > 0").groupBy(c("pa").alias("ka"), c("pb").alias("kb"), (c("depth") - 1).alias("depth")).count()
    sums = sums.groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    rows = (fill(nodes, pa=c("pa"), pb=c("pb"), n_convs=c("n_convs"), conv_id=c("conv_id"), ends_sha256=c("ends_sha256"))
            .unionByName(fill(children, n_children=c("count"))).unionByName(fill(sums, n_leaves=c("n_leaves"), saved=c("saved"))))
    whole = rows.groupBy(*key).agg(*[F.max(x).alias(x) for x in ("pa", "pb", "n_convs", "conv_id", "ends_sha256", "n_children",
                                                                "n_leaves", "saved")])
    up = nodes.select(c("ka").alias("pa"), c("kb").alias("pb"), (c("depth") + 1).alias("depth"), c("conv_id").alias("parent_conv_id"))
    out = materialize(fresh_join(whole, up, ["pa", "pb", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"), "ends_sha256"), "trie")
    discard(parts, nodes)
    return out
