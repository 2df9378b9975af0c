"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard similarity of at least `percent` / 100 link, exactly.

1. A map hashes each whole text to its set of shingles. Documents of a batch with equal sets are one node, named by the smallest of them. The nodes'
   shingles go, packed, to shards by hash. A group of exact copies, however large, costs one node a batch.
2. A shard counts in how many nodes a shingle is and drops those of a single node: they are in nobody's intersection, and the size of the set is
   kept. The rest go back, packed, to their batches. The global order of shingles is by (document frequency, rarest first, then hash).
3. A batch orders each node's shingles. Only a node with a shared shingle among its first |x| - ceil(t |x|) + 1 can link. For each of these shingles
   its nodes, ordered by size, are chained wherever two sizes in a row can reach the similarity; what a task chains goes on as one interval,
   so a shingle in a third of all nodes is one record a task. The components of the chains are clusters: every link lies within one.
4. Clusters are joined by prefix tree (`TreeJoin`): the ordered sets are stored in a tree, traversed with the partial overlap that the sets of a
   subtree have in common, and subtrees are pruned by the overlap that their remaining length can still give. Nodes of a component that has
   taken in most of a cluster are not compared with each other again.
5. A cluster of over `most_tokens` shingles is cut into blocks: by classes of set size, so that what links lies in one class or in two that
   follow each other, and by a hash within a class. Blocks are joined one by one; then some members of the largest component of each block are
   joined, so that the blocks of a large group of near copies become one component; then pairs of blocks of the same or the next class, except those
   that lie in a single component by then. The components of all links are the result.

Sizes of batches and shards are bounded, and their number follows the input. A batch sends a row to each shard that it has shingles for, so rows hold
about BATCH_BYTES * SHARD_BYTES / (6 * input) shingles: raise both with the memory of the executors where the input is beyond tens of terabytes.
Batches are those of the input's partitions, so the input must be read the same way again if an executor is lost, as files are.

Links: 100 |x and y| >= percent |x or y|, in integers, over shingles that travel as 40 bits beside their shard. In a shard of a million shingles about one
pair in two million million is taken for one, so the sizes of a few intersections are off by one; the sizes of the sets are those of 64-bit hashes.

Defined results: a null, empty or wordless text has an empty set and links with nothing; a text of fewer words than `k` is one shingle of all
its words; repeated rows are one node; rows with one doc_id but different texts are judged by their own texts; a null doc_id gets a null
component unless it is linked with a document that has an id; other columns are not returned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_column, dropped, in_groups, in_parts, pack, pieces_for, ranges, release, segment_starts, written
from .components import UnionFind, components
from .perfect_hash import mix
from .shingles import WordHashes, set_key, shingle_set

#: Stands for a null doc_id; larger than any other.
NO_ID = np.iinfo(np.int64).max
SHARD_BYTES = 8 << 20
#: Documents below 2^16: nodes are numbered by two bytes within a batch.
BATCH_DOCS, BATCH_BYTES = 4096, 8 << 20
#: How many members of a block's largest component are held against those of other blocks.
SPOKESMEN = 8
ROWS = "kind int, shard long, batch long, a binary, b binary, c binary, d binary"
NAMES = ["kind", "shard", "batch", "a", "b", "c", "d"]
DOCS, TOKENS, NODES = 0, 1, 2


class TreeJoin:
    """Links of sets within one cluster. tokens: arrays in global order, of the shared tokens only; sizes: of the whole sets.

    Sets are stored in a prefix tree with compressed paths, most frequent shingle first, so that sets have as long a path in common as can be. On
    the way down a path its partial overlap with every listed set is carried along: it is counted once for all sets below, from the lists of the
    sets that hold a shingle. A subtree is pruned where the overlap so far and all that is left below are too few for every listed set.

    Links go to the union-find `joined`. Once a component holds most of the listed sets, its members are taken off the lists: a pair with one
    of them is met from the other set's side, as the member is stored itself and each pair of components has a set that is still listed.
    """

    def __init__(self, sizes: np.ndarray, tokens: list[np.ndarray], percent: int, joined: UnionFind):
        self.sizes, self.percent, self.joined = np.asarray(sizes, np.int64), percent, joined
        lengths = np.array([len(t) for t in tokens], np.int64)
        flat = np.concatenate(tokens) if len(tokens) else np.zeros(0, np.uint64)
        ranks, local = np.unique(flat, return_inverse=True)
        self.n_tokens = len(ranks)
        # the most frequent comes first
        self.sets = [x[::-1] for x in np.split((self.n_tokens - 1 - local).astype(np.int32), np.cumsum(lengths)[:-1])] if len(tokens) else []

    def run(self, stored: list[int], listed: list[int]) -> None:
        """Links each stored set with the listed sets."""
        if not stored or not listed:
            return
        self.listed = np.array(listed)
        self.active = np.ones(len(listed), bool)
        self.absorbed: int | None = None
        both = set(listed) <= set(stored)
        self._fill_lists()
        listed_sizes = self.sizes[self.listed]
        stack = [(node, np.zeros(len(listed), np.int64)) for node in self._tree(stored)]
        while stack and self.active.any():
            (source, first, end, children, members, rest, smallest), counts = stack.pop()
            path = self.sets[source][first:end]
            at = ranges(self.starts[path], self.lengths[path])
            counts = counts + np.bincount(self.holders[at], minlength=len(counts))
            if not (self.active & (counts + rest >= self._needed(listed_sizes, smallest))).any():
                continue
            for y in members:
                hits = np.flatnonzero(self.active & (counts >= self._needed(listed_sizes, self.sizes[y])))
                for x in self.listed[hits].tolist():
                    self.joined.union(x, y)
                if both and 2 * len(hits) > self.active.sum():
                    self._take_off(y)
            stack.extend((child, counts) for child in children)

    def _needed(self, sizes: np.ndarray, size: int) -> np.ndarray:
        return -(-self.percent * (sizes + size) // (100 + self.percent))

    def _fill_lists(self) -> None:
        """For each token the places of the active listed sets that hold it."""
        on = np.flatnonzero(self.active)
        token = np.concatenate([self.sets[i] for i in self.listed[on]]) if len(on) else np.zeros(0, np.int32)
        holder = np.repeat(on, [len(self.sets[i]) for i in self.listed[on]])
        order = np.argsort(token, kind="stable")
        self.holders = holder[order]
        self.lengths = np.bincount(token, minlength=self.n_tokens)
        self.starts = segment_starts(self.lengths)

    def _take_off(self, y: int) -> None:
        """Takes the sets of y's component off the lists, if it is the one that was taken off before, or the first."""
        root = self.joined.find(y)
        if self.absorbed is not None and self.joined.find(self.absorbed) != root:
            return
        self.absorbed = y
        for i in np.flatnonzero(self.active):
            if self.joined.find(int(self.listed[i])) == root:
                self.active[i] = False
        self._fill_lists()

    def _tree(self, stored: list[int]) -> list[tuple]:
        """The children of the root: (a set with this path, first, end, children, sets that end here, longest rest below, smallest size)."""
        order = sorted(stored, key=lambda i: self.sets[i].astype(">u4").tobytes())
        root: list = [0, 0, 0, [], []]
        path, before = [root], None
        for i in order:
            own = self.sets[i]
            common = 0
            if before is not None:
                n = min(len(own), len(before))
                apart = np.flatnonzero(own[:n] != before[:n])
                common = int(apart[0]) if len(apart) else n
            last = None
            while path[-1][2] > common:
                last = path.pop()
            if path[-1][2] < common:
                between = [last[0], last[1], common, [last], []]
                path[-1][3][-1] = between
                last[1] = common
                path.append(between)
            if path[-1][2] == len(own):
                path[-1][4].append(i)
            else:
                leaf = [i, common, len(own), [], [i]]
                path[-1][3].append(leaf)
                path.append(leaf)
            before = own
        done: dict[int, tuple] = {}
        todo = [(root, False)]
        while todo:
            node, ready = todo.pop()
            if not ready:
                todo.append((node, True))
                todo.extend((child, False) for child in node[3])
                continue
            children = [done.pop(id(child)) for child in node[3]]
            rest = max((c[2] - c[1] + c[5] for c in children), default=0)
            smallest = min([*(c[6] for c in children), *(int(self.sizes[i]) for i in node[4])], default=0)
            done[id(node)] = (node[0], node[1], node[2], children, node[4], rest, smallest)
        return done[id(root)][3]


def _encode(k: int, shards: int):
    """Batches of documents -> packed rows of their nodes and documents, and of the shingles of the nodes by shard."""

    def encode() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        hashes = WordHashes()

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            nodes: dict[tuple[int, int], int] = {}
            sets, of = [], np.empty(len(ids), np.int64)
            for i, text in enumerate(batch.column("text")):
                tokens = shingle_set(text.as_py(), k, hashes)
                key = set_key(tokens) if len(tokens) else (0, 0)
                at = nodes.setdefault(key, len(sets))
                of[i] = at
                if at == len(sets):
                    sets.append(tokens)
            least = np.full(len(sets), NO_ID, np.int64)
            np.minimum.at(least, of, ids)
            sizes = np.array([len(s) for s in sets], np.int64)
            keys = np.array([a ^ b for a, b in nodes], np.uint64)
            # rows with one id but different texts are different nodes
            names = mix(least.view(np.uint64) ^ keys, 3).view(np.int64)
            # nodes are numbered by their place in the batch: the same nodes in another order are another batch
            batch_key = int(mix(names.view(np.uint64) ^ mix(np.arange(len(names)), 6), 4).sum(dtype=np.uint64).view(np.int64))
            yield _node_rows(batch_key, ids, of, names, least, sizes, shards)
            if sizes.sum():
                tokens = np.concatenate(sets)
                sets.clear()
                yield _token_rows(batch_key, tokens, sizes, shards)

        return part

    return in_parts(encode, "text", BATCH_DOCS, BATCH_BYTES)


def _node_rows(batch_key, ids, of, names, least, sizes, shards) -> pa.RecordBatch:
    """A row of the batch's documents and one of its nodes; the shard only passes them on."""
    shard = batch_key % shards
    documents = (ids, names[of], np.where(sizes[of] > 0, least[of], ids), sizes[of])
    columns = [binary_column([pack(x), pack(y)]) for x, y in zip(documents, (names, least, sizes, sizes[:0]), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([DOCS, NODES], pa.int32()), pa.array([shard] * 2, pa.int64()), pa.array([batch_key] * 2, pa.int64()), *columns], names=NAMES)


def _five(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :5]


def _from_five(data: bytes) -> np.ndarray:
    five = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(five), 8), np.uint8)
    out[:, :5] = five
    return out.view(np.uint64).ravel()


def _token_rows(batch_key, tokens, sizes, shards) -> pa.RecordBatch:
    """A row a shard: 40 bits of each token, and for each node of the batch that has any its number and how many they are."""
    node = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    shard = (tokens % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    shard, node, packed = shard[order], node[order], _five(tokens[order] >> np.uint64(24))
    cut = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
    out: list[list] = [[] for _ in range(4)]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        who, runs = _runs(node[a:b])
        for column, x in zip(out, (int(shard[a]), pack(packed[a:b]), pack(who.astype(np.uint16)), pack(runs.astype(np.int32))), strict=True):
            column.append(x)
    n = len(out[0])
    return pa.RecordBatch.from_arrays([pa.array([TOKENS] * n, pa.int32()), pa.array(out[0], pa.int64()), pa.array([batch_key] * n, pa.int64()), *map(binary_column, out[1:]), binary_column([b""] * n)], names=NAMES)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the runs of equal values, and their lengths."""
    start = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[start], np.diff(np.append(start, len(values)))


def _count(table: pa.Table) -> pa.Table:
    """All rows of a shard -> the tokens of two nodes at least, with a code of their frequency, by batch; rows of nodes and documents pass."""
    kinds = table.column("kind").to_numpy()
    passed = table.filter(pa.array(kinds != TOKENS))
    mine = table.filter(pa.array(kinds == TOKENS))
    if not mine.num_rows:
        return passed
    shard, keys = mine.column("shard")[0].as_py(), mine.column("batch").to_pylist()
    token = _from_five(b"".join(mine.column("a").to_pylist()))
    numbers, runs = ([np.frombuffer(x, t) for x in mine.column(c).to_pylist()] for c, t in (("b", np.uint16), ("c", np.int32)))
    row = np.repeat(np.arange(len(runs), dtype=np.int32), [int(r.sum()) for r in runs])
    node = np.repeat(np.concatenate(numbers), np.concatenate(runs))
    order = np.argsort(token, kind="stable").astype(np.int32)
    often = _runs(token[order])[1]
    coded = np.where(often >= 2, np.minimum(255, np.floor(8 * np.log2(often))), 0).astype(np.uint8)
    code = np.empty(len(token), np.uint8)
    code[order] = np.repeat(coded, often)
    del order, often, coded
    keep = code > 0
    token, node, row, code = token[keep], node[keep], row[keep], code[keep]
    cut = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row)) if len(row) else np.zeros(1, np.int64)
    out: list[list] = [[] for _ in range(5)]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        who, lengths = _runs(node[a:b])
        for column, x in zip(out, (keys[row[a]], pack(_five(token[a:b])), pack(code[a:b]), pack(who), pack(lengths.astype(np.int32))), strict=True):
            column.append(x)
    n = len(out[0])
    mine = pa.table([pa.array([TOKENS] * n, pa.int32()), pa.array([shard] * n, pa.int64()), pa.array(out[0], pa.int64()), *map(binary_column, out[1:])], names=NAMES)
    return pa.concat_tables([passed.cast(mine.schema), mine])


SETS = "name long, least long, size int, n_first int, tokens binary"


def _sets(percent: int, shards: int):
    """All rows of a batch -> the nodes that can link, with their shared tokens in global order (as 64-bit ranks: code above, token below)."""

    def build(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        known, mine = table.filter(pa.array(kinds == NODES)), table.filter(pa.array(kinds == TOKENS))
        # rows of a batch that came twice are the same rows
        names, least, sizes = (np.frombuffer(known.column(c)[0].as_py(), np.int64) for c in "abc")
        join = lambda c, t: np.frombuffer(b"".join(mine.column(c).to_pylist()), t)
        token, code, node = _from_five(b"".join(mine.column("a").to_pylist())), join("b", np.uint8), np.repeat(join("c", np.uint16), join("d", np.int32))
        shard = np.repeat(mine.column("shard").to_numpy(), [len(x) for x in mine.column("b").to_pylist()]).astype(np.uint64)
        rank = (code.astype(np.uint64) << np.uint64(56)) | ((token * np.uint64(shards) + shard) & np.uint64((1 << 56) - 1))
        order = np.lexsort((rank, node))
        rank, node = rank[order], node[order]
        fresh = np.append(True, (rank[1:] != rank[:-1]) | (node[1:] != node[:-1])) if len(rank) else np.zeros(0, bool)
        rank, node = rank[fresh], node[fresh]
        who, length = _runs(node)
        start, size = segment_starts(length) if len(length) else length, sizes[who]
        n_first = size - -(-percent * size // 100) + 1 - (size - length)
        keep = n_first > 0
        tokens = [pack(rank[s : s + n]) for s, n in zip(start[keep], length[keep], strict=True)]
        who = who[keep]
        return pa.table([pa.array(names[who]), pa.array(least[who]), pa.array(sizes[who].astype(np.int32)), pa.array(np.minimum(n_first, length)[keep].astype(np.int32)), binary_column(tokens)], names=["name", "least", "size", "n_first", "tokens"])

    return in_groups(build)


def _chains(token: np.ndarray, low: np.ndarray, high: np.ndarray, name: np.ndarray, percent: int):
    """Chains intervals of sizes within each token: links (a, b) of names, and for each chain (token, low, high, name)."""
    order = np.lexsort((high, low, token))
    token, low, high, name = token[order], low[order], high[order], name[order]
    n = len(token)
    if not n:
        return np.zeros((0, 2), np.int64), (token, low, high, name)
    first = np.append(True, token[1:] != token[:-1])
    # the largest size so far within the token: sizes are below 2^40
    group = np.cumsum(first) - 1
    reach = np.maximum.accumulate(group.astype(np.int64) << 40 | high) & ((1 << 40) - 1)
    broken = first.copy()
    broken[1:] |= 100 * reach[:-1] < percent * low[1:]
    start = np.flatnonzero(broken)
    chain = np.cumsum(broken) - 1
    links = np.stack((name[~broken], name[start][chain][~broken]), axis=1)
    return links, (token[start], low[start], np.maximum.reduceat(high, start), name[start])


def _forest(links: np.ndarray) -> np.ndarray:
    """Fewer links (a, b) with the same components."""
    if not len(links):
        return links
    nodes, at = np.unique(links, return_inverse=True)
    joined = UnionFind(len(nodes))
    for a, b in at.reshape(-1, 2).tolist():
        joined.union(a, b)
    root = np.array([joined.find(i) for i in range(len(nodes))])
    keep = root != np.arange(len(nodes))
    return np.stack((nodes[keep], nodes[root[keep]]), axis=1)


CHAINED = "shard long, token binary, low binary, high binary, name binary, a binary, b binary"
CHAINED_NAMES = ["shard", "token", "low", "high", "name", "a", "b"]


def _local_chains(percent: int, shards: int):
    """Batches of sets -> the chains of their first tokens by shard, and the links within the batch."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_first = batch.column("n_first").to_numpy().astype(np.int64)
            token = np.concatenate([np.frombuffer(t, np.uint64)[:n] for t, n in zip(batch.column("tokens").to_pylist(), n_first, strict=True)]) if len(n_first) else np.zeros(0, np.uint64)
            size, name = (np.repeat(batch.column(c).to_numpy().astype(np.int64), n_first) for c in ("size", "name"))
            links, (token, low, high, name) = _chains(token, size, size, name, percent)
            links = _forest(links)
            shard = (mix(token, 5) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            shard = shard[order]
            cut = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)) if len(shard) else np.zeros(1, np.int64)
            rows = [[] for _ in CHAINED_NAMES]
            for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                mine = order[a:b]
                for column, x in zip(rows, (int(shard[a]), pack(token[mine]), pack(low[mine]), pack(high[mine]), pack(name[mine]), pack(links[:, 0]) if not i else b"", pack(links[:, 1]) if not i else b""), strict=True):
                    column.append(x)
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *map(binary_column, rows[1:])], names=CHAINED_NAMES)
        release()

    return chain


def _shard_links(percent: int):
    def link(table: pa.Table) -> pa.Table:
        join = lambda c, t: np.frombuffer(b"".join(table.column(c).to_pylist()), t)
        links, _ = _chains(join("token", np.uint64), join("low", np.int64), join("high", np.int64), join("name", np.int64), percent)
        links = _forest(np.concatenate((links, np.stack((join("a", np.int64), join("b", np.int64)), axis=1))))
        return pa.table([pa.array(links[:, 0], pa.int64()), pa.array(links[:, 1], pa.int64())], names=["a", "b"])

    return in_groups(link)


def _join_groups(percent: int, outer_col: str | None = None):
    """The sets of a bin -> (name, root): each set with the first set of its component in its group.

    outer_col: of two blocks, only links between them are looked for; known components are in `known`.
    """

    def join(table: pa.Table) -> pa.Table:
        group, name, size = (table.column(c).to_numpy() for c in ("cluster", "name", "size"))
        tokens = table.column("tokens")
        known = table.column("known").to_numpy() if outer_col else None
        side = table.column(outer_col).to_numpy() if outer_col else None
        order = np.lexsort((name, group))
        cut = np.append(np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])), len(order))
        names, roots = [], []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            mine = order[a:b]
            joined = UnionFind(len(mine))
            if known is not None:
                seen: dict[int, int] = {}
                for i, c in enumerate(known[mine].tolist()):
                    joined.union(seen.setdefault(c, i), i)
            tree = TreeJoin(size[mine], [np.frombuffer(tokens[int(i)].as_py(), np.uint64) for i in mine], percent, joined)
            if side is None:
                tree.run(list(range(len(mine))), list(range(len(mine))))
            else:
                tree.run(np.flatnonzero(side[mine] == 0).tolist(), np.flatnonzero(side[mine] == 1).tolist())
            names += name[mine].tolist()
            roots += name[mine[[joined.find(i) for i in range(len(mine))]]].tolist()
        return pa.table([pa.array(names, pa.int64()), pa.array(roots, pa.int64())], names=["name", "root"])

    return in_groups(join)


def _linked(roots: DataFrame) -> DataFrame:
    return roots.where("name <> root").select(F.col("name").alias("a"), F.col("root").alias("b"))


def _joined_in_blocks(sets: DataFrame, percent: int, most_tokens: int) -> DataFrame:
    """(name, root) for the sets of large clusters; see 5. above."""
    # sizes that can link are less than a whole class apart
    cls = F.floor(F.log(F.col("size").cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).cast("int")
    sets = sets.withColumn("cls", cls)
    weigh = sets.groupBy("cluster", "cls").agg(F.ceil(F.sum("n") / most_tokens).cast("long").alias("blocks"))
    sets = written(sets.join(weigh, ["cluster", "cls"]).withColumn("part", F.pmod(F.xxhash64("name"), "blocks")))
    links = written(_linked(sets.groupBy("cluster", "cls", "part").applyInArrow(_join_groups(percent), "name long, root long")))
    within = components(links)
    own = sets.join(within.withColumnRenamed("node", "name"), "name").select("cluster", "cls", "part", "component", "name")
    largest = own.groupBy("cluster", "cls", "part", "component").count().groupBy("cluster", "cls", "part").agg(F.max_by("component", F.struct("count", "component")).alias("component"))
    speak = own.join(largest, ["cluster", "cls", "part", "component"])
    speak = speak.withColumn("place", F.row_number().over(Window.partitionBy("component").orderBy("name"))).where(F.col("place") <= SPOKESMEN).select("name")
    met = written(_linked(sets.join(speak, "name").groupBy("cluster").applyInArrow(_join_groups(percent), "name long, root long")))
    found = components(links.unionByName(met))
    placed = written(sets.join(found.withColumnRenamed("node", "name"), "name", "left").withColumn("known", F.coalesce("component", "name")).drop("component"))
    blocks = placed.groupBy("cluster", "cls", "part").agg(F.min("known").alias("low"), F.max("known").alias("high")).withColumn("block", F.xxhash64("cluster", "cls", "part"))
    near = blocks.select("cluster", F.explode(F.array(F.col("cls"), F.col("cls") + 1)).alias("cls"), F.col("cls").alias("cls2"), F.col("block").alias("block2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    apart = ~((F.col("low") == F.col("high")) & (F.col("low2") == F.col("high2")) & (F.col("low") == F.col("low2")))
    once = (F.col("cls2") < F.col("cls")) | (F.col("block2") < F.col("block"))
    pairs = written(blocks.join(near, ["cluster", "cls"]).where(once & apart).select("block", "block2").withColumn("pair", F.xxhash64("block", "block2")))
    sides = pairs.select("block", "pair", F.lit(0).alias("side")).unionByName(pairs.select(F.col("block2").alias("block"), "pair", F.lit(1).alias("side")))
    crossed = placed.withColumn("block", F.xxhash64("cluster", "cls", "part")).join(sides, "block").select(F.col("pair").alias("cluster"), "name", "size", "tokens", "known", "side")
    more = _linked(crossed.groupBy("cluster").applyInArrow(_join_groups(percent, "side"), "name long, root long"))
    every = written(links.unionByName(met).unionByName(more))
    dropped(sets, placed, links, met, pairs)
    return components(every).select(F.col("node").alias("name"), F.col("component").alias("root"))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75, most_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the size of its set and the smallest doc_id that it reaches by links."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = pieces_for(docs, SHARD_BYTES, 8)
    rows = texts.mapInArrow(_encode(k, shards), ROWS)
    counted = written(rows.groupBy("shard").applyInArrow(in_groups(_count), ROWS))
    sets = written(counted.where(F.col("kind") != DOCS).groupBy("batch").applyInArrow(_sets(percent, shards), SETS))
    chained = sets.mapInArrow(_local_chains(percent, shards), CHAINED).groupBy("shard").applyInArrow(_shard_links(percent), "a long, b long")
    clusters = components(chained).select(F.col("node").alias("name"), F.col("component").alias("cluster"))
    placed = written(sets.join(clusters, "name").withColumn("n", (F.octet_length("tokens") / 8).cast("long")))
    large = written(placed.groupBy("cluster").agg(F.sum("n").alias("weight")).where(F.col("weight") > most_tokens).select("cluster"))
    some_large = large.limit(1).count() > 0
    small = placed.join(large, "cluster", "left_anti") if some_large else placed
    roots = small.withColumn("bin", F.pmod(F.xxhash64("cluster"), F.lit(8 * shards))).groupBy("bin").applyInArrow(_join_groups(percent), "name long, root long")
    if some_large:
        roots = roots.unionByName(_joined_in_blocks(placed.join(large, "cluster"), percent, most_tokens))
    roots = written(roots)
    # a text that is in two batches under one id comes twice
    pairs = roots.where("name <> root").distinct()
    linked = pairs.unionByName(pairs.select(F.col("root").alias("name"), "root").distinct())
    # names are hashes; the component is called by the smallest document
    least = linked.join(placed.select("name", "least"), "name").groupBy("root").agg(F.min("least").alias("component_id"))
    of = linked.join(least, "root").select("name", "component_id")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64)) for c in "abcd"], names=["id", "name", "least", "n_shingles"])

    rows = counted.where(F.col("kind") == DOCS).select("a", "b", "c", "d").mapInArrow(documents, "id long, name long, least long, n_shingles long")
    out = rows.join(of, "name", "left").select("id", "n_shingles", F.coalesce("component_id", "least").alias("component_id"))
    out = written(out.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif("component_id", F.lit(NO_ID)).alias("component_id")))
    dropped(counted, sets, placed, large, roots)
    return out


#: The rows of jaccard_components() with 5 words and 75 percent, for DuckDB over `documents`.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS p FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + 4], ' ')) AS t FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM x JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * c >= 75 * (u.n + v.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(other) FROM r WHERE r.doc_id = d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)
"""
