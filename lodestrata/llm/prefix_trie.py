"""Prefix trie of conversations: which beginnings are shared, by how many, and what sharing saves.

1. Each turn becomes a token of fixed width: a digest of role and text, and the length of the
   text.  From then on only tokens move.
2. Equal conversations are combined: one path with its number, its least id, and the digest of its
   ids.  A path that a third of all conversations share is one row from here on.
3. Paths are dealt to prefix shards by their first turn; a shard with too many turns is split by its
   first two, four, eight turns, and so on.  Paths differ, so any shard ends up small.
4. Each task packs its shards, a bounded number of turns at a time, into a double array over the dense
   ids of their turns: the child of a node by a turn is at ``BASE[node] + turn`` if ``CHECK``
   there names the node.  Walking all paths through it gives the nodes.
5. A node as deep as the prefix that its shard was dealt by has all its conversations in that shard
   and is complete.  The few nodes above are shared between shards; what each
   shard knows of them is added up over all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import column_bytes, stored

TOKEN_BYTES = 20            # 16 of the digest, 4 of the length
ID_BITS = 12                # ids of one path are joined in ranges of 2^12 ids
SHARD_TURNS = 200_000       # turns of a shard beyond which it is split
CHUNK_TURNS = 200_000       # turns of shards that share a double array


def paths_of(conversations: DataFrame) -> DataFrame:
    """``conv_id path``: the tokens of each conversation in order, as hexadecimal texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256)
    token = F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text)), 8, "0"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), token.alias("token")
    )
    return turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct(
            # Null turns first.
            F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            "role", "token",
        ))), lambda x: x["token"],
    ).alias("path"))


def with_shared_starts(paths: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first turns replaced by those of the one that opens its hundred.

    How many is the checksum of its id modulo ``most``.
    """
    taken = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most
    openers = paths.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("opener"), F.slice("path", 1, most - 1).alias("opening")
    )
    marked = paths.withColumns({"opener": F.col("conv_id") - F.col("conv_id") % every, "taken": taken.cast("int")})
    own = F.when(
        F.size("path") > F.col("taken"), F.slice("path", F.col("taken") + 1, F.size("path"))
    ).otherwise(F.array().cast("array<string>"))
    start = F.coalesce(F.slice("opening", F.lit(1), F.col("taken")), F.array().cast("array<string>"))
    return marked.join(openers, "opener", "left").select("conv_id", F.concat(start, own).alias("path"))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """``path n least ends``: each path once, with the number, the least and the digest of its conversations' ids.

    Ids of a path are joined in ranges, by which they are dealt, too; the digest is then taken over the ranges
    in order, in a stream.
    """
    path = F.unhex(F.array_join("path", ""))
    ranges = paths.select("conv_id", path.alias("path")).select(
        "conv_id", "path", F.sha2("path", 256).alias("key"), F.shiftright("conv_id", ID_BITS).alias("range")
    ).groupBy("key", "range").agg(
        F.any_value("path").alias("path"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found, digest = None, [], None

        def out() -> pa.RecordBatch:
            path, n, least, ends = zip(*found)
            return pa.RecordBatch.from_arrays([
                pa.array(path, pa.binary()), pa.array(n, pa.int64()), pa.array(least, pa.int64()), pa.array(ends, pa.string())
            ], ["path", "n", "least", "ends"])

        for batch in batches:
            for key, path, n, least, ids in zip(*(batch[x].to_pylist() for x in ("key", "path", "n", "least", "ids"))):
                if key == last:
                    digest.update(b",")
                    found[-1][1] += n
                else:
                    if digest is not None:
                        found[-1][3] = digest.hexdigest()
                    if len(found) >= 1000:
                        yield out()
                        found.clear()
                    last, digest = key, hashlib.sha256()
                    found.append([path, n, least, None])
                digest.update(ids.encode())
        if found:
            found[-1][3] = digest.hexdigest()
            yield out()

    return ranges.repartition("key").sortWithinPartitions("key", "range").mapInArrow(
        run, "path binary, n long, least long, ends string"
    )


def turns_in(path: str | Column) -> Column:
    return (F.octet_length(path) / TOKEN_BYTES).cast("long")


def sharded(paths: DataFrame, most: int = SHARD_TURNS) -> DataFrame:
    """``paths`` with their ``shard`` and the number of turns it is dealt by (``depth``).

    A path that is shorter than the prefixes of its round goes by all of it.
    """
    rest, done, depth = paths, None, 1
    while True:
        named = rest.withColumn("shard", F.xxhash64(F.lit(depth), F.substring("path", 1, depth * TOKEN_BYTES)))
        # At most as many as the turns of all paths divided by ``most``.
        large = stored(named.groupBy("shard").agg(F.sum(turns_in("path")).alias("turns"), F.count("*").alias("paths")).filter(
            (F.col("turns") > most) & (F.col("paths") > 1)).select("shard"), "large-shards")
        none = large.isEmpty()
        fits = named if none else named.join(large, "shard", "left_anti")
        fits = fits.withColumn("depth", F.lit(depth)).select(*paths.columns, "shard", "depth")
        done = fits if done is None else done.unionByName(fits)
        if none:
            return done
        rest = named.join(large, "shard", "left_semi").select(*paths.columns)
        depth *= 2


class DoubleArray:
    """A trie as the arrays BASE and CHECK, filled level by level."""

    def __init__(self, turns: int):
        self.turns = turns
        self.base = np.zeros(turns + 1, np.int64)
        self.check = np.full(turns + 1, -1, np.int64)
        self.check[0] = 0           # the root; no child is put there
        self.end = 1                # slots from here on are free
        self.used = 1

    def _room(self, slots: int) -> None:
        if slots > len(self.check):
            more = max(slots, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def add(self, nodes: np.ndarray, turns: np.ndarray) -> None:
        """Put in the children of nodes that have none yet; pairs are distinct and sorted by node, then turn."""
        new = np.ones(len(nodes), bool)
        new[1:] = nodes[1:] != nodes[:-1]
        first = np.flatnonzero(new)
        number = np.diff(np.append(first, len(nodes)))
        low = 1                     # slots below have been tried
        for i in np.argsort(-number, kind="stable").tolist():
            if number[i] == 1:
                break
            codes = turns[first[i]: first[i] + number[i]]
            apart = codes - codes[0]
            free = low + np.flatnonzero(self.check[low: self.end] < 0)[:32]
            for slot in [*free.tolist(), self.end]:
                self._room(slot + int(apart[-1]) + 1)
                if (self.check[slot + apart] < 0).all():
                    break
                low = max(low, slot)
            self._put(int(nodes[first[i]]), slot - int(codes[0]), slot + apart)
        # A node with one child takes any free slot.
        single = first[number == 1]
        if len(single):
            gaps = self.check[1: self.end] < 0 if self.used < self.end else np.zeros(0, bool)
            free = np.flatnonzero(gaps)[: len(single)] + 1
            more = len(single) - len(free)
            free = np.concatenate([free, self.end + np.arange(more)])
            self._room(int(free[-1]) + 1)
            self.base[nodes[single]] = free - turns[single]
            self.check[free] = nodes[single]
            self.end = max(self.end, int(free[-1]) + 1)
            self.used += len(free)

    def _put(self, node: int, base: int, slots: np.ndarray) -> None:
        self.base[node] = base
        self.check[slots] = node
        self.end = max(self.end, int(slots[-1]) + 1)
        self.used += len(slots)

    def step(self, nodes: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of nodes by turns, -1 for none."""
        slots = self.base[nodes] + turns
        inside = (slots > 0) & (slots < self.end)
        slots = np.where(inside, slots, 0)
        return np.where(inside & (self.check[slots] == nodes), slots, -1)


NODE_DDL = (
    "key binary, parent_key binary, above array<binary>, complete boolean, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string"
)
NO_IDS = hashlib.sha256().hexdigest()
ROOT = b""


def chunk_nodes(path: pa.Array, n: np.ndarray, least: np.ndarray, ends: list[str], deal: np.ndarray) -> pa.RecordBatch:
    """The nodes of some whole shards; of those above what the shards are dealt by, what is known here."""
    data, offsets = column_bytes(path)
    tokens = data.reshape(-1, TOKEN_BYTES)
    size, start = np.diff(offsets) // TOKEN_BYTES, offsets[:-1] // TOKEN_BYTES
    row = np.repeat(np.arange(len(size)), size)
    level = np.arange(len(tokens)) - start[row]
    # Dense ids in the order in which turns are met, level by level, so that siblings are close together.
    whole = np.ascontiguousarray(tokens).view(f"V{TOKEN_BYTES}").ravel()
    order = np.lexsort((row, level))
    _, at, code = np.unique(whole[order], return_index=True, return_inverse=True)
    rank = np.empty(len(at), np.int64)
    rank[np.argsort(at)] = np.arange(len(at))
    turn = np.empty(len(tokens), np.int64)
    turn[order] = rank[code]
    chars = np.ascontiguousarray(tokens[:, 16:]).view(">u4").ravel().astype(np.int64)

    trie = DoubleArray(len(at))
    slots, depths, owners = ([np.zeros(1, np.int64)] for _ in range(3))
    here = np.zeros(len(size), np.int64)
    steps = [here.copy()]
    rows = np.arange(len(size))
    for depth in range(int(size.max(initial=0))):
        rows = rows[size[rows] > depth]
        pairs = np.stack([here[rows], turn[start[rows] + depth]])
        order = np.lexsort((pairs[1], pairs[0]))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(pairs[:, order]) != 0).any(0)
        trie.add(*pairs[:, order[new]])
        here[rows] = trie.step(*pairs)
        found, first = np.unique(here[rows], return_index=True)
        slots.append(found)
        depths.append(np.full(len(found), depth + 1))
        owners.append(rows[first])
        steps.append(here[rows])
    # What the walk has passed: for each node its slot, depth and a path that owns it.
    slot, depth, owner = (np.concatenate(x) for x in (slots, depths, owners))
    node = np.full(trie.end, -1)
    node[slot] = np.arange(len(slot))
    count, smallest = np.zeros(len(slot), np.int64), np.full(len(slot), np.iinfo(np.int64).max)
    rows = np.arange(len(size))
    for k, passed in enumerate(steps):
        rows = rows[size[rows] >= k]
        np.add.at(count, node[passed], n[rows])
        np.minimum.at(smallest, node[passed], least[rows])
    digest = np.full(len(slot), NO_IDS, object)
    digest[node[here]] = ends
    parent = node[trie.check[slot]]
    parent[0] = -1
    last = np.where(depth > 0, chars[np.minimum(start[owner] + np.maximum(depth, 1) - 1, max(len(chars) - 1, 0))]
                    if len(chars) else 0, 0)
    complete = (depth >= deal[owner]) & (depth > 0)
    children = np.bincount(parent[1:][complete[1:]], minlength=len(slot)) if len(slot) > 1 else np.zeros(1, np.int64)
    # Sums over subtrees, from the deepest level up; nodes that are not complete add nothing of their own.
    leaves = (complete & (children == 0)).astype(np.int64)
    saved = np.where(complete, (count - 1) * last, 0)
    bounds = np.searchsorted(depth, np.arange(int(depth[-1]) + 2))
    for k in range(int(depth[-1]), 0, -1):
        level = slice(bounds[k], bounds[k + 1])
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    # Shared nodes are known by the digest of their path.
    names: dict[int, bytes] = {0: ROOT}
    for x in np.flatnonzero(~complete)[1:].tolist():
        begin = int(offsets[owner[x]])
        names[x] = hashlib.sha256(data[begin: begin + int(depth[x]) * TOKEN_BYTES]).digest()

    def above(x: int) -> list[bytes]:
        found = []
        while x > 0:
            x = int(parent[x])
            found.append(names[x])
        return found

    key = [names.get(x) for x in range(len(slot))]
    parents = [names.get(x) for x in parent.tolist()]
    known = parent >= 0
    return pa.RecordBatch.from_arrays([
        pa.array(key, pa.binary()), pa.array(parents, pa.binary()),
        pa.array([above(x) if key[x] is not None else None for x in range(len(slot))], pa.list_(pa.binary())),
        pa.array(complete), pa.array(smallest), pa.array(depth),
        pa.array(smallest[parent], mask=~known), pa.array(count), pa.array(children.astype(np.int64)),
        pa.array(leaves), pa.array(saved), pa.array(last), pa.array(digest.tolist(), pa.string()),
    ], [x.strip().split(" ")[0] for x in NODE_DDL.split(", ")])


def shard_nodes(shards: DataFrame, most: int = CHUNK_TURNS) -> DataFrame:
    """The nodes of all shards, a bounded number of turns at a time; no shard is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, last = [], 0, None

        def flush() -> pa.RecordBatch:
            table = pa.concat_batches(held)
            return chunk_nodes(
                table["path"], table["n"].to_numpy(), table["least"].to_numpy(), table["ends"].to_pylist(),
                table["depth"].to_numpy(),
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch["shard"].to_numpy()
            turns = np.diff(column_bytes(batch["path"])[1]) // TOKEN_BYTES
            # Where a shard begins, a chunk may end.
            new = np.ones(len(shard), bool)
            new[1:] = shard[1:] != shard[:-1]
            new[0] = shard[0] != last
            last, at = shard[-1], 0
            for begin in np.flatnonzero(new).tolist():
                if total + int(turns[at:begin].sum()) >= most:
                    held.append(batch.slice(at, begin - at))
                    yield flush()
                    held, total, at = [], 0, begin
            held.append(batch.slice(at))
            total += int(turns[at:].sum())
        if held:
            yield flush()

    return shards.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(run, NODE_DDL)


RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def trie_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """All nodes of the trie of ``conv_id path`` (tokens as hexadecimal texts)."""
    once = stored(distinct_paths(paths), "paths")
    nodes = stored(shard_nodes(sharded(once, shard_turns), chunk_turns), "nodes")
    # Shared nodes: what the shards know of each, added up.  A node has the same depth, length and nodes above in all.
    parts = nodes.filter("not complete").groupBy("key").agg(
        F.any_value("parent_key").alias("parent_key"), F.any_value("above").alias("above"),
        F.min("conv_id").alias("conv_id"), F.any_value("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("whole_children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.any_value("chars").alias("chars"),
        # Only one shard has the path that ends here.
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_IDS, F.col("ends_sha256"))), F.lit(NO_IDS)).alias("ends_sha256"),
    )
    parts = stored(parts, "shared-nodes")
    shared_children = parts.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(
        F.count("*").alias("shared_children")
    )
    shared = parts.join(shared_children, "key", "left").withColumn(
        "n_children", F.col("whole_children") + F.coalesce("shared_children", F.lit(0))
    )
    # Each shared node's own share goes to itself and to all above it.
    own = shared.select(
        F.explode(F.concat(F.array("key"), "above")).alias("key"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saving"),
    ).groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    shared = stored(shared.join(own, "key").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", "n_children",
        (F.col("leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved") + F.col("saving")).alias("saved_tokens"),
        "ends_sha256",
    ), "shared-sums")
    # Nodes below a shared one take its id from the sums; the root's is one value.
    root = paths.agg(F.min("conv_id").alias("least")).first()["least"]
    below = nodes.filter("complete").select(*RESULT, "parent_key").unionByName(
        shared.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*RESULT, "parent_key")
    )
    at_root = F.col("parent_key") == F.lit(ROOT)
    plain = below.filter(F.col("parent_key").isNull() | at_root).withColumn(
        "parent_conv_id", F.when(at_root, F.lit(root).cast("long")).otherwise(F.col("parent_conv_id"))
    ).select(RESULT)
    names = shared.filter("depth > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    deeper = below.filter(F.col("parent_key").isNotNull() & ~at_root).join(names, "parent_key").withColumn(
        "parent_conv_id", F.col("found")
    ).select(RESULT)
    return plain.unionByName(deeper)


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """The nodes of the trie of all conversations, with shared starts put in.

    Turns go by ``turn``, null first, ties by role and then by the digest of the turn;
    repeated rows are turns of their own.  Null roles and texts are empty.  Rows without a ``conv_id`` take
    no part.  Other columns are left out.  An empty table has no nodes, not even a root.
    """
    paths = stored(with_shared_starts(paths_of(conversations)), "rebuilt")
    return trie_nodes(paths, shard_turns, chunk_turns)


def op13_prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The prefix trie of all conversations."""
    return conversation_trie(conversations)


# Checksums by table; a node is known by the digests of its turns.
OP13_SQL = r"""
WITH table8 AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i)
), convs AS (
  SELECT conv_id, list(md5(coalesce(role, '') || chr(10) || coalesce(text, '')) || ':' || length(coalesce(text, ''))
    ORDER BY turn NULLS FIRST, role, text) AS path
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
  SELECT conv_id, path, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda i: ord(substr(conv_id::VARCHAR, i::int, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 6 AS h
  FROM convs, table8
), rebuilt AS MATERIALIZED (
  SELECT t.conv_id, list_concat(coalesce(o.path, [])[1:t.h], t.path[t.h + 1:]) AS path
  FROM taken AS t LEFT JOIN convs AS o ON o.conv_id = t.conv_id - t.conv_id % 100
), marked AS (
  SELECT conv_id, len(path) AS size, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt
), members AS (
  SELECT conv_id, size, depth, md5(array_to_string(path[1:depth], ',')) AS node,
    CASE WHEN depth > 0 THEN md5(array_to_string(path[1:depth - 1], ',')) END AS parent,
    CASE WHEN depth > 0 THEN split_part(path[depth], ':', 2)::BIGINT ELSE 0 END AS chars,
    list_transform(range(depth + 1), lambda d: md5(array_to_string(path[1:d], ','))) AS above
  FROM marked
), nodes AS MATERIALIZED (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(chars) AS saving, any_value(above) AS above,
    sha256(coalesce(string_agg(CASE WHEN size = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), children AS MATERIALIZED (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), subtree AS (
  SELECT unnest(n.above) AS node, unnest(range(n.depth + 1)) AS depth, n.saving, c.node IS NULL AS leaf
  FROM nodes AS n LEFT JOIN children AS c ON c.node = n.node AND c.depth = n.depth
), sums AS (
  SELECT node, depth, count_if(leaf)::BIGINT AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM subtree GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes AS n JOIN sums AS s ON s.node = n.node AND s.depth = n.depth
LEFT JOIN children AS c ON c.node = n.node AND c.depth = n.depth
LEFT JOIN nodes AS p ON p.node = n.parent AND p.depth = n.depth - 1
"""
