"""A trie of conversations by their turns: z-fast tries built in tasks, merged by the digests of their nodes.

A task inserts its distinct conversations in batches into a compacted trie. Each compacted node is hashed under its handle,
the digest of its prefix at the two-fattest depth of its edge, so the node where a conversation leaves the trie is
found by a fat binary search over depths, in as many steps as the length has bits. What is found is split or
given a child. A trie that holds enough turns is expanded into a row for each depth of each edge and begun anew, so a
task's memory is bounded; rows of one prefix from several tries are added up by Spark, whatever conversations stood where.

Two passes give all figures by sums. The first counts members and finds each node's smallest one, its owner. As members
only leave on the way down, a conversation owns the end of its path or nothing of it; so sums over a node's subtree are
sums over its members' own parts, which the second pass adds up in the same way.
"""

from __future__ import annotations

import hashlib
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helio.llm.common import cut

#: Hex digits of a turn's digest in a sequence, and bytes of a node's digest.
TURN, NODE = 32, 16
#: A task's trie is expanded when its conversations have so many turns.
MOST_TURNS = 200_000
#: Ids are joined to texts of about so many before they are hashed one text behind another.
CHUNK = 400


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] with the most zeros at its end in binary."""
    return high & (-1 << (low ^ high).bit_length() - 1)


class Node:
    """An edge from depth ``low`` down to ``high`` on the path of a conversation (its prefix digests and running text lengths)."""

    __slots__ = ("high", "kids", "low", "owned", "leaves", "members", "parent", "path", "since", "smallest", "total", "turns", "until")

    def __init__(self, low: int, high: int, parent: Node | None, turns: bytes, path: list[bytes], until: list[int]) -> None:
        self.low, self.high, self.parent, self.turns, self.path, self.until, self.kids = low, high, parent, turns, path, until, {}
        self.members, self.smallest, self.total, self.owned, self.leaves, self.since = 0, None, 0, 0, 0, None

    def handle(self) -> bytes:
        return self.path[two_fattest(self.low, self.high)]

    def key(self, depth: int) -> bytes:
        """The turn after ``depth``, by which the edge hangs at a node of that depth."""
        return self.turns[depth * TURN : (depth + 1) * TURN]

    def add(self, members: int, smallest: int, total: int, owned: int, leaves: int, since: int | None) -> None:
        self.members, self.total, self.owned, self.leaves = self.members + members, self.total + total, self.owned + owned, self.leaves + leaves
        self.smallest = smallest if self.smallest is None else min(self.smallest, smallest)
        if since is not None:
            self.since = since if self.since is None else min(self.since, since)


class ZFastTrie:
    def __init__(self) -> None:
        self.root, self.handles, self.size = Node(-1, 0, None, b"", [prefix_digests(b"")[0]], [0]), {}, 0

    def exit_node(self, path: list[bytes]) -> Node:
        """The deepest node whose handle is a prefix of the sequence, by fat binary search."""
        low, high, node = 0, len(path) - 1, self.root
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(path[depth])
            if found is None:
                high = depth - 1
            else:
                node, low = found, found.high
        return node

    def _hang(self, node: Node) -> Node:
        node.parent.kids[node.key(node.low)] = node
        self.handles[node.handle()] = node
        return node

    def insert(self, turns: bytes, lengths: list[int]) -> tuple[Node, list[int]]:
        """The node that ends where the sequence does, made if need be, and the running lengths of the sequence."""
        path, until = prefix_digests(turns), [0]
        for n in lengths:
            until.append(until[-1] + n)
        size = len(path) - 1
        self.size += size + 1
        node = self.exit_node(path)
        while True:
            common = _common(node, path)
            if common < node.high:  # it leaves inside the edge, which is split there
                del self.handles[node.handle()]
                upper = self._hang(Node(node.low, common, node.parent, node.turns, node.path, node.until))
                node.low, node.parent = common, upper
                self._hang(node)
                node = upper
            if size == node.high:
                return node, until
            kid = node.kids.get(turns[node.high * TURN : (node.high + 1) * TURN])
            if kid is None:
                return self._hang(Node(node.high, size, node, turns, path, until)), until
            node = kid

    def expand(self):
        """(digest, parent's digest, depth, members, smallest, saved, leaves) for each depth of each edge; sums over this trie's conversations."""
        order = [self.root]
        for node in order:
            order.extend(node.kids.values())
        for node in reversed(order):
            if node.parent is not None:
                node.parent.add(node.members, node.smallest, node.total, node.owned, node.leaves, node.since)
            for depth in range(node.low + 1, node.high + 1):
                above = node.until[depth - 1] if depth else 0
                owned = node.owned
                if node.since is not None and node.since <= depth:  # the owner of this very node counts from here on
                    owned -= above - (node.until[node.since - 1] if node.since else 0)
                yield node.path[depth], node.path[depth - 1] if depth else None, depth, node.members, node.smallest, node.total - node.members * above - owned, node.leaves


def prefix_digests(turns: bytes) -> list[bytes]:
    """Digests of the first 0, 1, 2, ... turns."""
    state, out = hashlib.sha256(), []
    out.append(state.digest()[:NODE])
    for i in range(0, len(turns), TURN):
        state.update(turns[i : i + TURN])
        out.append(state.digest()[:NODE])
    return out


def _common(node: Node, path: list[bytes]) -> int:
    """Depth down to which the node's edge and the sequence go together: a binary search over prefix digests."""
    low, high = max(node.low, 0), min(node.high, len(path) - 1)
    while low < high:
        middle = (low + high + 1) // 2
        if node.path[middle] == path[middle]:
            low = middle
        else:
            high = middle - 1
    return low


def conversation_turns(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """conv_id, _pos (from 0), _turn (digest of role and text, null as empty), _length (code points), in the order of turn (null first), ties by digest; rows without an id belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, TURN)
    rows = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col("turn").alias("_no"), digest.alias("_turn"), F.char_length(text).cast("long").alias("_length"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_no"), "_turn")) - 1
    return rows.withColumn("_pos", place).drop("_no")


def branched(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations with shared beginnings: the first h turns of conversation c - c % ``group``, then c's own after its first h, h being crc32(c) % ``most``.

    Rows as from ``conversation_turns``, where _pos orders the turns but may have gaps, and a row of nulls for each conversation, also those left without turns.
    """
    h = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(most))
    convs = turns.select("conv_id").distinct()
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("_pos") < most - 1)).withColumnRenamed("conv_id", "_base")
    taken = convs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % group).join(heads, "_base").where(F.col("_pos") < h("conv_id"))
    own = turns.where(F.col("_pos") >= h("conv_id"))
    columns = ["conv_id", "_turn", "_length", "_pos"]
    return own.select(columns).unionAll(taken.select(columns)).unionByName(convs, allowMissingColumns=True)


def _tries(most: int):
    """Local tries of sequences with their weights, each expanded when it holds ``most`` turns."""
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("saved_tokens", pa.int64()), ("n_leaves", pa.int64())])

    def expanded(trie: ZFastTrie):
        rows = trie.expand()
        while held := list(islice(rows, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        trie = ZFastTrie()
        for batch in batches:
            names = ("_seq", "_lengths", "_n", "_conv", "_since", "_leaf")
            for seq, lengths, n, conv, since, leaf in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                node, until = trie.insert(seq.encode(), lengths)
                owned = 0 if since is None else until[-1] - (until[since - 1] if since else 0)
                node.add(n, conv, n * until[-1], owned, leaf or 0, since)
                if trie.size >= most:
                    yield from expanded(trie)
                    trie = ZFastTrie()
        if trie.size:
            yield from expanded(trie)

    return run


_TRIE = "node binary, parent binary, depth long, n_convs long, conv_id long, saved_tokens long, n_leaves long"


def end_digests(ends: DataFrame) -> DataFrame:
    """node and ends_sha256 from rows (node, conv_id): the digest of each node's ids, ascending and joined by commas.

    Ids are dealt over ranges by node and id and joined there, so many ids of one node are spread; its texts are then hashed one behind
    another without being held.
    """

    def join(batches):
        node, ids = None, []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "_first", "_ids"])

        for batch in batches:
            for key, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (key != node or len(ids) >= CHUNK):
                    yield row()
                    ids = []
                node = key
                ids.append(conv)
        if ids:
            yield row()

    def digest(batches):
        node, state, done = None, None, ([], [])
        for batch in batches:
            for key, text in zip(batch.column("node").to_pylist(), batch.column("_ids").to_pylist(), strict=True):
                if key != node:
                    if state is not None:
                        done[0].append(node)
                        done[1].append(state.hexdigest())
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["node", "ends_sha256"])
            done = ([], [])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    texts = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(join, "node binary, _first long, _ids string")
    return texts.repartition("node").sortWithinPartitions("node", "_first").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """A row for each distinct sequence of first turns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv_id, _pos, _turn, _length as from ``conversation_turns``; a conversation whose rows all have a null _pos has
    no turns and is a member of the root alone. Turns that are equal in role and text are one, so repeated conversations
    are members of the same nodes; turns that are repeated within a conversation count each. No conversation, no row.
    A conversation's digests (some 50 bytes a turn) have to fit in a task.
    """
    turn = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_turn", "_length"))
    convs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_t"))
    convs = convs.select("conv_id", F.array_join("_t._turn", "").alias("_seq"), F.col("_t._length").alias("_lengths"))
    convs = cut(convs.withColumn("node", F.substring(F.unhex(F.sha2(F.col("_seq").cast("binary"), 256)), 1, NODE)))
    distinct = convs.groupBy("node").agg(F.first("_seq").alias("_seq"), F.first("_lengths").alias("_lengths"), F.count(F.lit(1)).alias("_n"), F.min("conv_id").alias("_conv"))
    # Neighbours share beginnings, so their trie is small; the digest spreads those that share a long one.
    distinct = distinct.repartitionByRange(F.substring("_seq", 1, 8 * TURN), "node")
    own = [F.lit(None).cast("long").alias("_since"), F.lit(None).cast("long").alias("_leaf")]
    columns = ["_seq", "_lengths", "_n", "_conv"]
    first = distinct.select(*columns, *own).mapInArrow(_tries(most_turns), _TRIE)
    nodes = first.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    kids = nodes.groupBy(F.col("parent").alias("_of")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(kids, F.col("node") == F.col("_of"), "left").select("node", "parent", "depth", "n_convs", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children")))
    deepest = F.max(F.struct("depth", (F.col("n_children") == 0).cast("long").alias("leaf")))
    owners = nodes.groupBy(F.col("conv_id").alias("_owner")).agg(F.min("depth").alias("_since"), deepest.alias("_last")).select("_owner", "_since", F.col("_last.leaf").alias("_leaf"))
    second = distinct.join(owners, F.col("_conv") == F.col("_owner"), "left").select(*columns, "_since", "_leaf").mapInArrow(_tries(most_turns), _TRIE)
    sums = second.select("node", "saved_tokens", "n_leaves").unionByName(end_digests(convs.select("node", "conv_id")), allowMissingColumns=True)
    sums = sums.groupBy(F.col("node").alias("_node")).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"), F.max("ends_sha256").alias("_ends"))
    parents = nodes.select(F.col("node").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, F.col("node") == F.col("_node")).join(parents, F.col("parent") == F.col("_parent"), "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("_ends", F.lit(none)).alias("ends_sha256"))
