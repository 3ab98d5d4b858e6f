"""A trie of conversation prefixes: which conversations share their first turns, and what sharing saves.

A node is a distinct sequence of first turns. Turns are known by 128 bits of a hash of role
and text; texts do not move. Equal conversations are added up first, then their sequences are
put in order and dealt out by range, so that a task sees neighbours. Each range numbers its
turns in a dictionary and keeps its sequences in a ternary search tree over these numbers; the
median goes in first, then the medians of both halves, which balances the tree. One pass over
the nodes, children before parents, adds up members, leaves and savings.

Only prefixes of the first and the last sequence of a range can go on in its neighbours. Their
counts, two paths a range, are merged in order with a stack of one path.

Turns are ordered by number, null first; turns of one number, by the hash of role and text.
Null role or text is empty, and repeated rows are turns of their own. Rows without a key belong to no
conversation. Texts of any length count; a conversation's turns, 24 bytes each, fit into a row. An empty table gives no nodes. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presscheck.llm.tables import materialise

TURNS = "ids array<binary>, chars array<long>"
# Turns of distinct conversations in one range, about 1 kB each in its tree.
RANGE_TURNS = 150_000
# Keys are joined to text in blocks of their values, so that no group is gathered whole.
BLOCK = 256
# Most merged nodes to send to every task, of about 100 bytes each.
BROADCAST_NODES = 500_000
NODE = (
    "key binary, conv_id long, depth long, parent_key binary, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
PATH = (
    "array<struct<id:binary,chars:long,members:long,first:long,children:long,leaves:long,saved:long,ends:string>>"
)


def turn_lists(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv_id, ids, chars)``: the turns of each conversation in order."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    # The length in front keeps role and text apart.
    whole = F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said)
    digest = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)
    entry = F.struct(F.col(turn).alias("turn"), digest.alias("id"), F.length(said[1]).cast("long").alias("chars"))
    ordered = turns.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("conv_id"))
    ordered = ordered.agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    return ordered.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))


def with_head(lists: DataFrame, head_of: Column, length: Column, longest: int) -> DataFrame:
    """Conversations whose first ``length`` turns are those of conversation ``head_of``.

    ``length`` is at most ``longest``. A head that does not exist is empty; one that is
    shorter gives what it has.
    """
    heads = lists.select(
        F.col("conv_id").alias("_head"),
        F.slice("ids", 1, longest).alias("_ids"),
        F.slice("chars", 1, longest).alias("_chars"),
    )
    both = lists.withColumns({"_head": head_of, "_n": length.cast("int")}).join(heads, "_head", "left")

    def rebuilt(kind: str) -> Column:
        head = F.coalesce(F.slice(f"_{kind}", F.lit(1), F.col("_n")), F.slice(kind, 1, 0))
        own = F.slice(kind, F.col("_n") + 1, F.greatest(F.size(kind) - F.col("_n"), F.lit(0)))
        return F.concat(head, own).alias(kind)

    return both.select("conv_id", rebuilt("ids"), rebuilt("chars"))


def _tree():
    """Functions of the range tasks, nested so that they travel by value."""
    import hashlib

    def sequences(batches):
        """``(ids, chars, members, first, ends)`` of the distinct sequences, which come in order."""
        now = None
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("ids", "chars", "members", "first", "keys")]
            for ids, chars, members, first, keys in zip(*columns):
                if now is not None and now[0] == ids:
                    now[2] += members
                    now[3] = min(now[3], first)
                    now[4].update(b"," + keys.encode())
                else:
                    if now is not None:
                        yield now
                    now = [ids, chars, members, first, hashlib.sha256(keys.encode())]
        if now is not None:
            yield now

    class Tree:
        """Node 0 is the root. ``parent`` and the sums go by trie node; low, equal, high are the search tree."""

        def __init__(self):
            self.code, self.parent, self.depth, self.chars = [-1], [-1], [0], [0]
            self.low, self.equal, self.high = [-1], [-1], [-1]
            self.members, self.first, self.ends = [0], [None], [None]

        def add(self, codes, chars, members, first, ends):
            at = 0
            for code, n in zip(codes, chars):
                before, link = at, self.equal
                at = link[before]
                while at >= 0 and self.code[at] != code:
                    before, link = at, self.low if code < self.code[at] else self.high
                    at = link[before]
                if at < 0:
                    at = link[before] = len(self.code)
                    # Up the search tree, siblings have the same trie parent.
                    above = before if link is self.equal else self.parent[before]
                    for column, value in (
                        (self.code, code), (self.parent, above), (self.depth, self.depth[above] + 1),
                        (self.chars, n), (self.low, -1), (self.equal, -1), (self.high, -1),
                        (self.members, 0), (self.first, None), (self.ends, None),
                    ):
                        column.append(value)
            self.members[at], self.first[at], self.ends[at] = members, first, ends
            return at

        def path(self, node):
            found = []
            while node >= 0:
                found.append(node)
                node = self.parent[node]
            return found[::-1]

    def build(rows):
        """The tree of a range in order, and the ends of its first and last sequence."""
        number = {t: i for i, t in enumerate(sorted({t for row in rows for t in row[0]}))}
        tree, ends, waiting = Tree(), {}, [(0, len(rows))]
        while waiting:
            start, stop = waiting.pop()
            middle = (start + stop) // 2
            ids, chars, members, first, digest = rows[middle]
            at = tree.add([number[t] for t in ids], chars, members, first, digest.hexdigest())
            if middle in (0, len(rows) - 1):
                ends[middle] = at
            waiting += [half for half in ((middle + 1, stop), (start, middle)) if half[0] < half[1]]
        return tree, sorted(number, key=number.get), ends

    return sequences, build


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished nodes of a range, and the paths of its first and last sequence with their open counts."""
    import hashlib

    sequences, build = _tree()
    rows = list(sequences(batches))
    if not rows:
        return
    tree, ids, ends = build(rows)
    size = len(tree.code)
    first_path, last_path = tree.path(ends[0]), tree.path(ends[len(rows) - 1])
    keys = {0: b""}
    for node in [*first_path[1:], *last_path[1:]]:
        keys[node] = hashlib.sha256(keys[tree.parent[node]] + ids[tree.code[node]]).digest()[:16]
    members, first = tree.members, tree.first
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    # Parents have smaller numbers, so this comes to children first.
    for node in range(size - 1, -1, -1):
        up = tree.parent[node]
        if node not in keys:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.chars[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if up >= 0:
            members[up] += members[node]
            first[up] = first[node] if first[up] is None else min(first[up], first[node])
    done = [node for node in range(size) if node not in keys]

    def entry(node, whole):
        own = (members[node], first[node], children[node], leaves[node], saved[node], tree.ends[node])
        names = ("members", "first", "children", "leaves", "saved", "ends")
        values = own if whole else (0, first[node], 0, 0, 0, None)
        return {"id": ids[tree.code[node]] if node else b"", "chars": tree.chars[node]} | dict(zip(names, values))

    paths = [[entry(node, True) for node in first_path]]
    if len(rows) > 1:
        seen = set(first_path)
        paths.append([entry(node, node not in seen) for node in last_path])
    schema = _arrow_schema()
    for start in range(0, len(done), 20_000):
        part = done[start : start + 20_000]
        up = [tree.parent[node] for node in part]
        columns = [
            [None] * len(part), [first[n] for n in part], [tree.depth[n] for n in part], [keys.get(u) for u in up],
            [None if u in keys else first[u] for u in up], [members[n] for n in part], [children[n] for n in part],
            [leaves[n] for n in part], [saved[n] for n in part], [tree.ends[n] for n in part], [None] * len(part),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    columns = [[None] * len(paths)] * (len(schema) - 1) + [paths]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow_schema() -> pa.Schema:
    long, binary, text = pa.int64(), pa.binary(), pa.string()
    kinds = [("key", binary), ("conv_id", long), ("depth", long), ("parent_key", binary), ("parent_conv_id", long)]
    kinds += [(c, long) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")] + [("ends_sha256", text)]
    entry = [("id", binary)] + [(c, long) for c in ("chars", "members", "first", "children", "leaves", "saved")]
    return pa.schema([*kinds, ("path", pa.list_(pa.struct([*entry, ("ends", text)])))])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes on the paths of all ranges; paths come in order, so one path is open at a time."""
    import hashlib

    schema = pa.schema(list(_arrow_schema())[:-1])
    open_: list[dict] = []
    done: list[list] = []

    def close():
        node = open_.pop()
        node["leaves"] += not node["children"]
        node["saved"] += (node["members"] - 1) * node["chars"]
        parent = open_[-1] if open_ else None
        if parent is not None:
            parent["leaves"] += node["leaves"]
            parent["saved"] += node["saved"]
        counts = [node[c] for c in ("members", "children", "leaves", "saved", "ends")]
        done.append([node["key"], node["first"], len(open_), parent and parent["key"], None, *counts])

    def flush():
        columns = [pa.array(c, f.type) for c, f in zip(zip(*done), schema)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        for path in batch["path"]:
            path = path.as_py()
            common = 0
            while common < min(len(path), len(open_)) and open_[common]["id"] == path[common]["id"]:
                common += 1
            while len(open_) > common:
                close()
            for node, more in zip(open_, path):
                for count in ("members", "children", "leaves", "saved"):
                    node[count] += more[count]
                node["first"] = min(node["first"], more["first"])
                node["ends"] = node["ends"] or more["ends"]
            for more in path[common:]:
                more["key"] = hashlib.sha256(open_[-1]["key"] + more["id"]).digest()[:16] if open_ else b""
                if open_:
                    open_[-1]["children"] += 1
                open_.append(more)
            if len(done) >= 20_000:
                yield flush()
    while open_:
        close()
    if done:
        yield flush()


def nodes(lists: DataFrame) -> DataFrame:
    """The nodes of the trie over ``(conv_id, ids, chars)``, one row per conversation."""
    block = F.floor(F.col("conv_id") / BLOCK).alias("block")
    keys = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = lists.groupBy("ids", block).agg(
        F.first("chars").alias("chars"),
        F.count(F.lit(1)).alias("members"),
        F.min("conv_id").alias("first"),
        F.array_join(keys, ",").alias("keys"),
    )
    # Stored, as the bounds of the ranges are drawn from it.
    pieces = materialise(pieces, "sequences")
    turns = pieces.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).head()[0]
    ranges = pieces.repartitionByRange(max(1, -(-turns // RANGE_TURNS)), "ids").sortWithinPartitions("ids", "block")
    made = materialise(ranges.mapInArrow(_ranges, f"{NODE}, path {PATH}"), "nodes")
    paths = made.where(F.col("path").isNotNull()).select("path")
    # Two paths a range, in the order of their turns.
    ordered = paths.repartition(1).sortWithinPartitions(F.col("path.id"))
    merged = materialise(ordered.mapInArrow(_merge, NODE), "nodes")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    if merged.count() <= BROADCAST_NODES:
        parents = F.broadcast(parents)
    own = made.where(F.col("path").isNull()).drop("path").unionByName(merged)
    return own.join(parents, "parent_key", "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
