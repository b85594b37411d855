"""Conversation prefix trie: double-array tries per prefix shard, shared upper nodes merged globally.

A node of depth d is a distinct sequence of the first d turns; its members are
the conversations that start with it.  Equal sequences are collapsed first.
Sequences are dealt to shards by the shortest prefix whose sequences hold few
enough turns, so a shard's task always fits in memory; the longer, hot
prefixes are the *upper* nodes that several shards share.  Each task numbers
its turns densely, packs them into BASE and CHECK arrays, walks every sequence
through the arrays and returns its nodes: finished ones below the shard's
prefix, additive parts for upper nodes, which one aggregate then merges.  A
single sequence that is longer than a shard has no branches left and becomes
a chain of rows without a trie.

Texts stay where they are read: a turn travels as two 64-bit hashes of role
and text and its length.

Defined results: rows with a NULL id belong to no conversation and are left
out; a NULL turn comes first, equal turns follow in the order of the two
content hashes; NULL role and text are empty; an empty table gives no nodes;
other columns are ignored.  The digest of a node's ends is taken from a sorted
stream of joined ids, so no task holds a list of all members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm import common

# Turns of distinct sequences that one task packs into its arrays, about.
SHARD_TURNS = 200_000
# Ids joined to one text before they are hashed.
CHUNK = 10_000

_PART = ("upper boolean, depth long, p1 long, p2 long, q1 long, q2 long, size long, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved long, end_id long")


class DoubleArray:
    """Static double-array trie: the child of node ``s`` by id ``i`` is slot ``base[s] + i`` where ``check`` is ``s``."""

    ROOT = 0

    def __init__(self, sequences: list[list[int]]):
        """``sequences``: distinct lists of ids from 0, in lexicographic order."""
        self.base, self.check = [0], [-2]
        self.order = [self.ROOT]  # slots, parents before children
        self._free = 1
        queue = [(self.ROOT, 0, len(sequences), 0)]
        for node, lo, hi, depth in queue:
            if lo < hi and len(sequences[lo]) == depth:
                lo += 1  # the sequence that ends here sorts first
            runs = []
            while lo < hi:
                turn, start = sequences[lo][depth], lo
                while lo < hi and sequences[lo][depth] == turn:
                    lo += 1
                runs.append((turn, start, lo))
            if not runs:
                continue
            base = self._place([turn for turn, _, _ in runs])
            self.base[node] = base
            for turn, start, end in runs:
                slot = base + turn
                self.check[slot] = node
                self.order.append(slot)
                queue.append((slot, start, end, depth + 1))

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = size - len(self.check)
            self.base.extend([0] * more)
            self.check.extend([-1] * more)

    def _place(self, turns: list[int]) -> int:
        """The base at which all ``turns`` (ascending) fall on free slots; may be negative."""
        check = self.check
        while self._free < len(check) and check[self._free] != -1:
            self._free += 1
        first, span = turns[0], turns[-1] - turns[0]
        slot, tries = self._free, 16 if len(turns) > 1 else 1
        for _ in range(tries):
            self._grow(slot + span + 1)
            if all(check[slot + t - first] == -1 for t in turns):
                return slot - first
            slot += 1
        slot = len(check)  # nothing near: a fresh stretch at the end
        self._grow(slot + span + 1)
        return slot - first

    def child(self, node: int, turn: int) -> int:
        slot = self.base[node] + turn
        return slot if 0 < slot < len(self.check) and self.check[slot] == node else -1


def _shard_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one shard's rows ``(sid, pos, k1, k2, size, p1, p2, q1, q2, copies, root)``."""
    col = {n: table.column(n).to_numpy() for n in table.column_names if n != "shard"}
    rows = np.lexsort((col["pos"], col["sid"]))
    col = {n: v[rows] for n, v in col.items()}
    keys = np.stack([col["k1"], col["k2"]], axis=1)
    ids = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
    # dense ids by (depth, first use): the children of a node get close ids
    first = np.full(ids.max() + 1, len(ids))
    byplace = np.lexsort((np.arange(len(ids)), col["pos"]))
    np.minimum.at(first, ids[byplace], np.arange(len(ids)))
    rank = np.empty(len(first), dtype=np.int64)
    rank[np.argsort(first, kind="stable")] = np.arange(len(first))
    ids = rank[ids].tolist()
    starts = np.flatnonzero(np.r_[True, col["sid"][1:] != col["sid"][:-1]]).tolist()
    ends = [*starts[1:], len(ids)]
    spans = sorted(zip(starts, ends), key=lambda s: ids[s[0]:s[1]])
    trie = DoubleArray([ids[a:b] for a, b in spans])

    n = len(trie.check)
    members, least, at, end_id = [0] * n, [None] * n, [-1] * n, [None] * n
    upper, depth_of = [False] * n, [0] * n
    sid, copies, root = col["sid"].tolist(), col["copies"].tolist(), col["root"].tolist()
    for a, b in spans:
        node, who, count, light = DoubleArray.ROOT, sid[a], copies[a], root[a]
        for depth in range(b - a + 1):
            if depth:
                node = trie.child(node, ids[a + depth - 1])
                if node < 0:
                    raise RuntimeError("a packed sequence is missing from its arrays")
                at[node] = a + depth - 1
            members[node] += count
            least[node] = who if least[node] is None else min(least[node], who)
            upper[node] = depth < light
            depth_of[node] = depth
        end_id[node] = who
    size = col["size"].tolist()
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in reversed(trie.order):
        if not upper[node]:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * size[at[node]]
        above = trie.check[node]
        if node:
            leaves[above] += leaves[node]
            saved[above] += saved[node]
            kids[above] += not upper[node]
    key = {c: col[c].tolist() for c in ("p1", "p2", "q1", "q2")}
    out = []
    for node in trie.order:
        row, above = at[node], trie.check[node]
        own = [key[c][row] for c in ("p1", "p2", "q1", "q2")] if node else [0, 0, 0, 0]
        inside = node and not upper[node] and not upper[above]
        out.append((upper[node], depth_of[node], *own, size[row] if node else 0, least[node],
                    least[above] if inside else None, members[node], kids[node], leaves[node], saved[node], end_id[node]))
    kinds = [pa.bool_(), *[pa.int64()] * 13]
    names = [f.split()[0] for f in _PART.split(", ")]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _id_chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """``(p1, p2, n, first, several, ids)``: sorted ids joined by commas, up to ``chunk`` of one sequence a row."""
    names = ["p1", "p2", "n", "first", "several", "ids"]
    kinds = [*[pa.int64()] * 4, pa.bool_(), pa.string()]
    key, ids, done = None, [], []

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    for batch in batches:
        for *this, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if this != key or len(ids) == chunk:
                if ids:
                    done.append((*key, ids[0], len(ids) > 1, ",".join(map(str, ids))))
                key, ids = this, []
            ids.append(conv)
        if done:
            yield give()
            done = []
    if ids:
        done.append((*key, ids[0], len(ids) > 1, ",".join(map(str, ids))))
        yield give()


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(end_id, digest)`` of every sequence with several conversations; chunks come sorted by sequence and first id."""
    key = digest = low = None
    many = False

    def give(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()),
                                           pa.array([d[1] for d in done], pa.string())], ["end_id", "digest"])

    for batch in batches:
        done = []
        for p1, p2, n, first, several, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (p1, p2, n) == key:
                digest.update(b"," + ids.encode())
                many = True
                continue
            if many:
                done.append((low, digest.hexdigest()))
            key, low, many, digest = (p1, p2, n), first, several, hashlib.sha256(ids.encode())
        if done:
            yield give(done)
    if many:
        yield give([(low, digest.hexdigest())])


def end_digests(whole: DataFrame) -> DataFrame:
    """``(end_id, digest)`` for the sequences of ``whole(conv_id, n, p1, p2)`` that several conversations share.

    Ids are sorted and joined range by range, so a hot sequence is spread; its
    one last task only feeds finished chunks to SHA-256, in order.
    """
    by, chunk = ["p1", "p2", "n"], CHUNK
    chunks = whole.select(*by, "conv_id").repartitionByRange(*by, "conv_id").sortWithinPartitions(*by, "conv_id").mapInArrow(
        lambda batches: _id_chunks(batches, chunk), "p1 long, p2 long, n long, first long, several boolean, ids string")
    return chunks.repartition(*by).sortWithinPartitions(*by, "first").mapInArrow(_end_digests, "end_id long, digest string")


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos from 1, k1, k2, size)`` of every turn: its place, content hashes and code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("k1"),
        F.xxhash64(F.lit("second"), text, role).alias("k2"), F.length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "k1", "k2")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "k1", "k2", "size")


def borrowed(rows: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the start of another one, and all their ids.

    Conversation c takes the first h turns of conversation ``c - c % every``
    (fewer if it has fewer, none if it is absent) and its own turns after the
    first h, where h is the unsigned crc32 of c in decimal modulo ``most``.
    """
    c = F.col("conv_id")
    convs = rows.select("conv_id").distinct().select("conv_id", (c - c % every).alias("of"),
                                                     (F.crc32(c.cast("string")) % most).alias("h"))
    heads = rows.where((c % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "of")
    lent = convs.join(heads, "of").where(F.col("pos") <= F.col("h"))
    count = heads.groupBy("of").agg(F.max("pos").alias("has"))
    kept = rows.join(convs.join(count, "of", "left"), "conv_id").where(F.col("pos") > F.col("h"))
    start = F.least("h", F.coalesce("has", F.lit(0).cast("long"))) - F.col("h")
    both = lent.select("conv_id", "pos", "k1", "k2", "size").unionByName(
        kept.select("conv_id", (F.col("pos") + start).alias("pos"), "k1", "k2", "size"))
    return both, convs.select("conv_id")


def _chains(lone: DataFrame) -> DataFrame:
    """Nodes and upper parts of sequences that have no branch from depth ``root`` on, without a trie."""
    pos, root, n, sid = F.col("pos"), F.col("root"), F.col("n"), F.col("sid")
    below = F.sum("size").over(Window.partitionBy("sid").orderBy(pos.desc()).rowsBetween(Window.unboundedPreceding, 0))
    tail = F.sum(F.when(pos >= root, F.col("size")).otherwise(0)).over(
        Window.partitionBy("sid").orderBy(pos.desc()).rowsBetween(Window.unboundedPreceding, 0))
    upper, none = pos < root, F.lit(None).cast("long")
    rows = lone.withColumns({"_below": below, "_tail": tail})
    extra = F.col("copies") - 1
    nodes = rows.select(
        upper.alias("upper"), pos.alias("depth"), "p1", "p2", "q1", "q2", "size", sid.alias("conv_id"),
        F.when(pos > root, sid).alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        F.when(upper, (pos == root - 1).cast("long")).otherwise((pos < n).cast("long")).alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        (extra * F.when(upper, F.col("_tail")).otherwise(F.col("_below"))).alias("saved"),
        F.when(pos == n, sid).alias("end_id"))
    zero = F.lit(0).cast("long")
    top = rows.where(pos == 1).select(
        F.lit(True).alias("upper"), zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"),
        zero.alias("size"), sid.alias("conv_id"), none.alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        (root == 1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        (extra * F.col("_tail")).alias("saved"), none.alias("end_id"))
    return nodes.unionByName(top)


def nodes(rows: DataFrame, members: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie over ``rows(conv_id, pos, k1, k2, size)``; ``members(conv_id)`` also names turnless ones.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.
    """
    pos = F.col("pos")
    here = Window.partitionBy("conv_id").orderBy("pos")
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    # a prefix is known by its depth and two xors of hashes of (place, turn)
    keyed = rows.withColumns({
        "p1": F.bit_xor(F.xxhash64("pos", "k1", "k2")).over(upto),
        "p2": F.bit_xor(F.xxhash64(F.lit("second"), "pos", "k2", "k1")).over(upto)})
    zero = F.lit(0).cast("long")
    keyed = common.staged(keyed.withColumns({"q1": F.lag("p1", 1, 0).over(here), "q2": F.lag("p2", 1, 0).over(here)}),
                          "trie-turns")
    last = keyed.groupBy("conv_id").agg(F.max(F.struct("pos", "p1", "p2")).alias("last"))
    whole = members.join(last, "conv_id", "left").select(
        "conv_id", *(F.coalesce(F.col(f"last.{c}"), zero).alias(n) for c, n in (("pos", "n"), ("p1", "p1"), ("p2", "p2"))))
    whole = common.staged(whole, "trie-sequences")
    seqs = whole.groupBy("n", "p1", "p2").agg(F.min("conv_id").alias("sid"), F.count("*").alias("copies"))
    told = seqs.select(F.col("sid").alias("conv_id"), "copies", "n")
    reps = common.staged(keyed.join(told, "conv_id").withColumnRenamed("conv_id", "sid"), "trie-distinct")

    total = reps.count()
    limit = max(1, shard_turns // 4)
    shards = max(1, -(-total // shard_turns))
    level, depth, rooted = reps.where(pos == 1), 1, []
    while True:
        # prefixes of this depth with too many turns below them go one turn deeper
        found = level.groupBy("p1", "p2").agg(F.sum("n").alias("_turns"), F.count("*").alias("_seqs"))
        found = common.staged(found, "trie-prefixes")
        hot = found.where((F.col("_turns") > limit) & (F.col("_seqs") > 1))
        rooted.append(level.join(found.where((F.col("_turns") <= limit) | (F.col("_seqs") == 1)), ["p1", "p2"]).select(
            "sid", F.lit(depth).cast("long").alias("root"), (F.col("_turns") > limit).alias("lone"),
            F.pmod(F.xxhash64("p1", "p2"), F.lit(shards)).alias("shard")))
        if hot.isEmpty():
            break
        depth += 1
        above = hot.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        level = reps.where(pos == depth).join(above, ["q1", "q2"], "left_semi")
    roots = rooted[0]
    for more in rooted[1:]:
        roots = roots.unionByName(more)
    placed = reps.join(roots, "sid", "left").withColumns({
        "root": F.coalesce("root", F.col("n") + 1), "lone": F.coalesce("lone", F.lit(False)),
        "shard": F.coalesce("shard", F.pmod(F.xxhash64("sid"), F.lit(shards)))})
    if depth > 1 or shards > 1:
        placed = common.staged(placed, "trie-placed")
    packed = (placed.where(~F.col("lone"))
              .select("shard", "sid", "pos", "k1", "k2", "size", "p1", "p2", "q1", "q2", "copies", "root")
              .groupBy("shard").applyInArrow(_shard_nodes, _PART))
    silent = seqs.where(F.col("n") == 0).select(
        F.lit(True).alias("upper"), *(zero.alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "size")),
        F.col("sid").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        *(zero.alias(c) for c in ("n_children", "n_leaves", "saved")), F.col("sid").alias("end_id"))
    parts = common.staged(packed.unionByName(_chains(placed.where("lone"))).unionByName(silent), "trie-parts")

    # upper nodes: parts of all shards are added up, then their own figures go to all upper nodes above
    key = ["depth", "p1", "p2"]
    merged = parts.where("upper").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        *(F.max(c).alias(c) for c in ("q1", "q2", "size", "end_id")))
    merged = common.staged(merged, "trie-upper")
    kids = merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"),
                                             F.col("q2").alias("p2")).agg(F.count("*").alias("_kids"))
    own = merged.join(kids, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("_kids", zero)).withColumns({
        "_saved": (F.col("n_convs") - 1) * F.col("size"), "_leaf": (F.col("n_children") == 0).cast("long")})
    line = reps.select(F.col("sid").alias("conv_id"), pos.alias("_at"), F.col("p1").alias("_p1"), F.col("p2").alias("_p2"))
    down = own.select("conv_id", "depth", "_saved", "_leaf")
    above = down.join(line, "conv_id").where(F.col("_at") < F.col("depth")).select(
        F.col("_at").alias("depth"), F.col("_p1").alias("p1"), F.col("_p2").alias("p2"), "_saved", "_leaf")
    top = down.where("depth > 0").select(*(zero.alias(c) for c in key), "_saved", "_leaf")
    under = above.unionByName(top).groupBy(*key).agg(F.sum("_saved").alias("_more"), F.sum("_leaf").alias("_leaves"))
    parent = merged.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                           F.col("conv_id").alias("_parent"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "end_id"]
    uppers = (own.join(under, key, "left").join(parent, ["depth", "q1", "q2"], "left")
              .withColumns({"saved": F.col("saved") + F.col("_saved") + F.coalesce("_more", zero),
                            "n_leaves": F.col("n_leaves") + F.col("_leaf") + F.coalesce("_leaves", zero),
                            "parent_conv_id": F.col("_parent")}).select(*out))
    lower = parts.where(~F.col("upper"))
    inner = lower.where(F.col("parent_conv_id").isNotNull()).select(*out)
    outer = lower.where(F.col("parent_conv_id").isNull()).join(parent, ["depth", "q1", "q2"], "left").withColumn(
        "parent_conv_id", F.col("_parent")).select(*out)

    text = F.coalesce(F.col("end_id").cast("string"), F.lit(""))
    return (inner.unionByName(outer).unionByName(uppers).join(end_digests(whole), "end_id", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("digest", F.sha2(text.cast("binary"), 256)).alias("ends_sha256")))
