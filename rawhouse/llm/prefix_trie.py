"""Prefix trie of conversations by adaptive radix trees.

A turn becomes a fixed-width big-endian id (the first 16 bytes of the SHA-256 of
its role and text), so a conversation is a byte string and conversations with a
common beginning are strings with a common prefix.  Equal conversations are
merged first; the distinct strings are range-partitioned and sorted, and each task
puts its strings, in chunks of bounded bytes, into adaptive radix trees: nodes
grow through layouts for 4, 16, 48 and 256 children, and a run of bytes without a
branch is one compressed path.  Only byte depths that are whole turns emit nodes.

Everything emitted for a node is a sum or a minimum over its members, so a node
that several chunks or tasks share is merged by its id (the hash of its prefix)
with partial aggregation.  What neighbouring chunks counted twice is known from
the last string of one and the first of the next (their common prefix) and is taken
off by correction rows; between tasks these come from one row a task.  A first
turn, or a whole conversation, that a third of all rows share thus never lands in
one task.  The ids that end at a node are joined into pieces in a range-sorted
pass and digested from the pieces.

Defined results: a null role or text is empty; turns stand by number, null first,
repeated numbers by the id of their turn, and repeated rows stay; rows without a
conversation id belong to no conversation; texts of any length are hashed whole;
a table without conversations has no nodes; other columns of any name are ignored.
One conversation's ids (16 bytes a turn) must fit in a task, as one text must.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawhouse.session import materialize

WIDTH = 16  # bytes of a turn id
CHUNK_BYTES = 2 << 20  # of strings in one tree
PIECE_IDS = 1_000  # conversation ids in one piece of a node's list

# --- adaptive radix tree ----------------------------------------------------


class Branch:
    """A radix node: a compressed path, then up to 256 children by the next byte.

    Layouts: up to 4 and up to 16 children keep their bytes in order beside the
    children; up to 48 keep an index by byte; beyond that children stand by byte.
    """

    __slots__ = ("path", "room", "bytes", "kids", "end")

    def __init__(self, path: bytes, end: int | None = None) -> None:
        self.path, self.end = path, end
        self.room, self.bytes, self.kids = 4, bytearray(), []

    def find(self, byte: int) -> Branch | None:
        if self.room <= 16:
            at = self.bytes.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.room == 48:
            at = self.bytes[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, child: Branch) -> None:
        """Add a child, or replace the one at its byte."""
        if self.room <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.kids[at] = child
                return
            if len(self.kids) == self.room:
                self._grow()
                self.put(byte, child)
                return
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.kids.insert(at, child)
        elif self.room == 48:
            if self.bytes[byte]:
                self.kids[self.bytes[byte] - 1] = child
            elif len(self.kids) == 48:
                self._grow()
                self.kids[byte] = child
            else:
                self.kids.append(child)
                self.bytes[byte] = len(self.kids)
        else:
            self.kids[byte] = child

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.bytes):
                index[byte] = at + 1
            self.room, self.bytes = 48, index
        else:
            kids: list[Branch | None] = [None] * 256
            for byte in range(256):
                if self.bytes[byte]:
                    kids[byte] = self.kids[self.bytes[byte] - 1]
            self.room, self.bytes, self.kids = 256, bytearray(), kids

    def children(self) -> list[Branch]:
        """Children by byte."""
        if self.room <= 16:
            return self.kids
        if self.room == 48:
            return [self.kids[at - 1] for at in self.bytes if at]
        return [kid for kid in self.kids if kid is not None]


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Branch | None, key: bytes, number: int) -> Branch:
    """Insert a key with its number; returns the root."""
    if root is None:
        return Branch(key, number)
    above, taken, node, at = None, 0, root, 0
    while True:
        if key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                node.end = number
                return root
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Branch(key[at + 1 :], number))
                return root
            above, taken, node, at = node, key[at], child, at + 1
            continue
        same = common_length(node.path, key[at : at + len(node.path)])
        split = Branch(node.path[:same])
        split.put(node.path[same], node)
        node.path = node.path[same + 1 :]
        if at + same == len(key):
            split.end = number
        else:
            split.put(key[at + same], Branch(key[at + same + 1 :], number))
        if above is None:
            return split
        above.put(taken, split)
        return root


# --- nodes of one chunk -----------------------------------------------------


def node_ids(key: bytes, width: int = WIDTH) -> list[bytes]:
    """Ids of the prefixes of 0, 1, 2, ... turns: hashes of the prefix."""
    running = hashlib.sha256()
    out = [running.digest()[:WIDTH]]
    for at in range(0, len(key), width):
        running.update(key[at : at + width])
        out.append(running.copy().digest()[:WIDTH])
    return out


Row = tuple  # node, parent, depth, n, low, kids, leaves, saved


def chunk_nodes(keys: list[bytes], sizes: list[list[int]], counts: list[int], lows: list[int], width: int = WIDTH) -> Iterator[Row]:
    """The nodes of the trie over distinct keys: how many conversations start with
    each, the smallest of them, children, leaves and saved bytes of its subtree."""
    root = None
    for number, key in enumerate(keys):
        root = insert(root, key, number)
    if root is None:
        return
    ids: dict[int, list[bytes]] = {}
    # A frame: node, first byte depth on its edge, children left, and what its subtree
    # sums to: n, low, nodes without one between, leaves, saved, a key below.
    stack = [[root, 0, iter(root.children()), 0, None, 0, 0, 0, None]]
    while stack:
        frame = stack[-1]
        node, start = frame[0], frame[1]
        child = next(frame[2], None)
        if child is not None:
            stack.append([child, start + len(node.path) + 1, iter(child.children()), 0, None, 0, 0, 0, None])
            continue
        stack.pop()
        _, _, _, n, low, kids, leaves, saved, one = frame
        if node.end is not None:
            ids.pop(one, None)
            n, low, one = n + counts[node.end], _least(low, lows[node.end]), node.end
        if one not in ids:
            ids[one] = node_ids(keys[one], width)
        names = ids[one]
        stop = start + len(node.path)
        for depth in range(stop // width, (start + width - 1) // width - 1, -1):
            if not kids:
                leaves = 1
            if depth:
                saved += (n - 1) * sizes[one][depth - 1]
            yield names[depth], names[depth - 1] if depth else None, depth, n, low, kids, leaves, saved
            kids = 1
        if stack:
            above = stack[-1]
            above[3] += n
            above[4] = _least(above[4], low)
            above[5] += kids
            above[6] += leaves
            above[7] += saved
            if above[8] is None:
                above[8] = one
            else:
                ids.pop(one, None)  # another key names what lies above


def _least(a: int | None, b: int) -> int:
    return b if a is None or b < a else a


def overlap_rows(last: bytes, first: bytes, sizes: list[int], width: int = WIDTH) -> Iterator[Row]:
    """What two neighbouring chunks counted twice: ``last`` ends one, ``first``
    (with its turns' sizes) begins the next.  Their common nodes were children
    twice, their bytes were kept twice, and an end that goes on was no leaf."""
    shared = common_length(last, first) // width
    goes_on = len(last) // width == shared
    names = node_ids(first[: shared * width], width)
    twice = 0
    for depth in range(shared, -1, -1):
        if depth:
            twice += sizes[depth - 1]
        yield names[depth], None, None, 0, None, -1 if depth < shared else 0, -1 if goes_on else 0, twice


_NODE = "node binary, parent binary, depth long, n long, low long, kids long, leaves long, saved long"
_NODE_TYPES = [pa.binary(), pa.binary(), *[pa.int64()] * 6]
_EDGE = "first binary, sizes array<long>, last binary"
_EDGE_TYPES = [pa.binary(), pa.list_(pa.int64()), pa.binary()]


def _batches(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


# --- operators --------------------------------------------------------------


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns) of every conversation: its turns in order as (id, bytes)."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    number = F.col(f"`{turn_col}`").cast("long")
    turns = df.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"),
        F.struct(
            number.isNotNull().alias("numbered"),
            number.alias("number"),
            F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * WIDTH).alias("id"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("turn"),
    ).where(F.col("conv").isNotNull())
    gathered = turns.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return gathered.select("conv", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def grafted(convs: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin as their group's head does: of conversation c the
    first h turns are those of conversation c - c % ``every`` (all it has, if fewer;
    none, if there is no such conversation), then its own after its first h; h is the
    CRC-32 of c in decimal modulo ``most``."""
    conv = F.col("conv")
    h = (F.crc32(conv.cast("string").cast("binary")) % most).cast("int")
    heads = convs.where(conv % every == 0).select(conv.alias("head"), F.slice("turns", 1, max(most - 1, 1)).alias("start"))
    joined = convs.join(heads, conv - conv % every == F.col("head"), "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("start", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    return joined.select("conv", turns.alias("turns"))


def prefix_trie(convs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The nodes of the trie over conversations as :func:`conversations` gives them
    (one row a conversation, no null id): (node, conv, depth, parent_conv, n, kids,
    leaves, saved, ends_sha256).

    ``conv`` is the smallest member (``parent_conv`` the parent's), ``n`` members,
    ``kids`` children, ``leaves`` childless nodes in the subtree, ``saved`` the bytes
    that storing each node's turn once saves in the subtree, ``ends_sha256`` the digest
    of the members that end there, ascending, comma-joined.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    strings = materialize(convs.select("conv", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "trie-strings")
    distinct = strings.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("low"), F.first("sizes").alias("sizes"))
    ordered = distinct.select("key", "sizes", "n", "low").repartitionByRange("key").sortWithinPartitions("key")
    names = [c.split()[0] for c in f"{_NODE}, {_EDGE}".split(", ")]

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank, bare = (None,) * len(_EDGE_TYPES), (None,) * len(_NODE_TYPES)

        def rows() -> Iterator[tuple]:
            held: list[tuple] = []
            used, first, last = 0, None, None

            def chunk() -> Iterator[tuple]:
                if last is not None:
                    yield from overlap_rows(last, held[0][0], held[0][1])
                yield from chunk_nodes(*map(list, zip(*held)))

            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    if held and used + len(row[0]) > chunk_bytes:
                        yield from (r + blank for r in chunk())
                        last, held, used = held[-1][0], [], 0
                    if first is None:
                        first = row[:2]
                    held.append(row)
                    used += len(row[0]) + WIDTH
            if held:
                yield from (r + blank for r in chunk())
                yield bare + (first[0], first[1], held[-1][0])

        yield from _batches(rows(), names, _NODE_TYPES + _EDGE_TYPES)

    found = materialize(ordered.mapInArrow(trees, f"{_NODE}, {_EDGE}"), "trie-chunks")
    # One row a task: each meets the last string of the task before it.
    edges = found.where(F.col("node").isNull()).select("first", "sizes", "last")
    edges = edges.withColumn("before", F.lag("last").over(Window.orderBy("first"))).where(F.col("before").isNotNull())

    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sizes, before in zip(*(batch.column(i).to_pylist() for i in range(3))):
                yield from _batches(overlap_rows(before, first, sizes), names[: len(_NODE_TYPES)], _NODE_TYPES)

    parts = found.where(F.col("node").isNotNull()).select(*names[: len(_NODE_TYPES)])
    parts = parts.unionByName(edges.select("first", "sizes", "before").mapInArrow(twice, _NODE))
    sums = [F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")]
    nodes = parts.groupBy("node").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("low").alias("conv"), *sums)
    nodes = materialize(nodes, "trie-nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    ends = strings.select(F.unhex(F.substring(F.sha2("key", 256), 1, 2 * WIDTH)).alias("node"), "conv")
    nodes = nodes.join(above, "parent", "left").join(digests(ends, "node", "conv"), "node", "left")
    empty = hashlib.sha256().hexdigest()
    return nodes.select(
        "node", "conv", "depth", "parent_conv", "n", "kids", "leaves", "saved", F.coalesce("sha256", F.lit(empty)).alias("ends_sha256")
    )


def digests(df: DataFrame, key_col: str, id_col: str, piece_ids: int = PIECE_IDS) -> DataFrame:
    """(key, sha256) of each key's ids, ascending, in decimal and comma-joined.

    The rows are range-sorted by key and id, so a key with very many ids spreads over
    tasks that join pieces of them; a digest then reads its key's pieces in order, one
    at a time.
    """
    ordered = df.select(F.col(key_col).alias("k"), F.col(id_col).alias("i")).repartitionByRange("k", "i").sortWithinPartitions("k", "i")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, held = None, []
            for batch in batches:
                for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if held and (k != now or len(held) == piece_ids):
                        yield now, held[0], ",".join(map(str, held))
                        held = []
                    now = k
                    held.append(i)
            if held:
                yield now, held[0], ",".join(map(str, held))

        yield from _batches(rows(), ["k", "i", "piece"], [pa.binary(), pa.int64(), pa.string()], 500)

    joined = ordered.mapInArrow(pieces, "k binary, i long, piece string").repartition("k").sortWithinPartitions("k", "i")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, running = None, None
            for batch in batches:
                for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    if running is None or k != now:
                        if running is not None:
                            yield now, running.hexdigest()
                        now, running = k, hashlib.sha256(piece.encode())
                    else:
                        running.update(b"," + piece.encode())
            if running is not None:
                yield now, running.hexdigest()

        yield from _batches(rows(), ["k", "sha256"], [pa.binary(), pa.string()])

    return joined.mapInArrow(digest, "k binary, sha256 string").withColumnRenamed("k", key_col)


__all__ = ["Branch", "chunk_nodes", "conversations", "digests", "grafted", "insert", "node_ids", "overlap_rows", "prefix_trie"]
