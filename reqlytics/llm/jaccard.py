"""Near-duplicate join on word 5-grams: a MinHash LSH forest finds candidates, exact Jaccard decides.

1. *Copies.* A text is its words (letters, digits, all beyond ASCII; A-Z as a-z). Texts of equal words share a
   digest and are one representative from then on, with a count; copies are never paired.
2. *Forest.* A representative has ``TREES`` signatures of ``LONGEST`` MinHash values, one per tree. Sorted, the signatures of a
   tree are a prefix trie: texts that share a prefix stand side by side. Only nodes of several texts at :func:`floor_length`,
   the shortest prefix that is ever needed, are kept, with their texts' whole signatures.
3. *Prefix lengths.* Each text is first matched by its longest prefix. What it meets there, and how alike that is by a sketch of all
   its values, tells how many links of each similarity it has (a link of similarity s is met in TREES * s^LONGEST trees) and
   so the recall at every shorter prefix. Its prefix is shortened until that recall reaches the target; a text
   that met nothing is shortened to the floor, where the least similar link reaches it.
4. *Candidate links.* Below the node of its own prefix length a text is compared by sketch with all texts there; those that
   are clearly less alike than asked are no candidates, however many share the node. Connected candidates make a group.
   Nodes of more than ``NODE_TEXTS`` texts are cut into blocks and compared block by block.
5. *Verification.* A group is cut into blocks by size, and a pair of blocks is the unit of work. Within it all pairs of texts
   are compared exactly, with counts of common 5-grams from products of incidence matrices. Only sums per text
   and one spanning link per text leave the task, never the pairs.
6. *Classes.* Connected components of the verified links.

What is lost: a link of exactly the asked similarity shares no prefix at the floor in any tree with probability 6e-5, and its
sketches seem less alike than ``SKETCHED`` with probability 1e-5 (five standard deviations).

Results: one row per document with ``class_id`` (smallest doc_id of the class), ``n_links`` (other documents of
similarity at or above the limit, copies included) and ``class_size``. A text of one to four words is one
shingle of all its words; a text without words (null, empty, marks only) is like nothing and a class of its own.
Very long texts are cut whole, one at a time. Repeated rows are copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reqlytics.llm import scan
from reqlytics.llm.common import mapped, materialise, with_columns
from reqlytics.sources.warehouse import materialise_counted

SHINGLE = 5
SIMILARITY = 0.8
TREES = 32
LONGEST = 10
#: Share of the links of each text that its prefixes are to meet.
TARGET = 0.9999
#: How far below the asked similarity two sketches of TREES * LONGEST bits may seem: five standard deviations.
SKETCH_SLACK = 5 * 2 * (0.09 / (TREES * LONGEST)) ** 0.5
#: Texts of a node that are compared in one task.
NODE_TEXTS = 1 << 17
#: Bounds of one block of a candidate group.
BLOCK_SHINGLES = 1 << 17
BLOCK_TEXTS = 512
#: Rows of a lookup that may be broadcast (about 40 bytes each); beyond that the join is a shuffle.
BROADCAST_ROWS = 500_000
#: Columns of an incidence matrix held at once.
COLUMNS = 4096


def expected_recall(trees: int, length: int, similarity: float) -> float:
    return 1 - (1 - similarity**length) ** trees


def floor_length(trees: int, longest: int, similarity: float, target: float) -> int:
    """The longest prefix by which links of the least similarity reach the target recall: none is ever shorter."""
    return max((k for k in range(1, longest + 1) if expected_recall(trees, k, similarity) >= target), default=1)


def shingles(found: scan.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of each text of a slice, and the place of each text's first, and the end."""
    firsts, n = found.firsts, len(found.hashes)
    counts = np.where(found.counts >= size, found.counts - size + 1, np.minimum(found.counts, 1))
    places = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(places[-1]), np.uint64)
    full = scan.runs(found.hashes, size)
    if len(full):
        owner = found.texts[: len(full)]
        inside = np.flatnonzero(np.arange(len(full)) + size <= firsts[owner + 1])
        long = np.repeat(found.counts >= size, counts)
        out[long] = full[inside]
    for text in np.flatnonzero((found.counts > 0) & (found.counts < size)).tolist():
        out[places[text]] = scan.runs(found.hashes[firsts[text] : firsts[text + 1]], int(found.counts[text]))[0]
    return out, places


def tree_values(grams: np.ndarray, places: np.ndarray, trees: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with shingles, and the first ``length`` MinHash values of each in each tree."""
    full = np.flatnonzero(np.diff(places))
    values = np.zeros((len(full), trees, length), np.uint32)
    if len(full):
        starts = places[:-1][full]
        low = (grams >> np.uint64(32)).astype(np.uint32)
        buffer = np.empty_like(low)
        seeds = scan.mix(np.arange(1, 2 * trees * LONGEST + 1, dtype=np.uint64)).astype(np.uint32)
        for tree in range(trees):
            for k in range(length):
                at = 2 * (tree * LONGEST + k)
                np.multiply(low, seeds[at] | np.uint32(1), out=buffer)
                buffer ^= buffer >> np.uint32(15)
                buffer *= seeds[at + 1] | np.uint32(1)
                values[:, tree, k] = np.minimum.reduceat(buffer, starts)
    return full, values


def node_keys(values: np.ndarray) -> np.ndarray:
    """A key per text and tree: the tree and the values of its prefix."""
    total = np.broadcast_to(scan.mix(np.arange(1, values.shape[1] + 1, dtype=np.uint64)), values.shape[:2]).copy()
    for k in range(values.shape[2]):
        total = scan.mix(total ^ values[:, :, k].astype(np.uint64))
    return total


def digests_of(found: scan.Words) -> list[bytes | None]:
    firsts = found.firsts.tolist()
    return [
        hashlib.blake2b(found.hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
        for a, b in zip(firsts, firsts[1:])
    ]


def signatures(
    docs: DataFrame, keep: list[str], text: str, trees: int = TREES, length: int = 1, with_keys: bool = True
) -> DataFrame:
    """``keep``, with ``digest`` (null without words), ``n_grams`` and the ``keys`` of its nodes at that prefix length."""

    def compute(batch: pa.RecordBatch) -> dict:
        digests: list[bytes | None] = []
        n_grams, keys = [], []
        for found in scan.words(batch.column(0), scan.ALNUM):
            digests += digests_of(found)
            if with_keys:
                grams, places = shingles(found)
                n_grams.append(np.diff(places))
                full, values = tree_values(grams, places, trees, length)
                some = np.zeros((len(places) - 1, trees), np.uint64)
                some[full] = node_keys(values)
                keys.append(some.view(np.int64))
        made = {"digest": pa.array(digests, pa.binary())}
        if with_keys:
            flat = np.concatenate(keys).ravel() if keys else np.zeros(0, np.int64)
            offsets = pa.array(np.arange(len(digests) + 1, dtype=np.int32) * trees)
            made |= {
                "n_grams": pa.array(np.concatenate(n_grams) if n_grams else [], pa.int64()),
                "keys": pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
            }
        return made

    added = [T.StructField("digest", T.BinaryType())]
    if with_keys:
        added += [T.StructField("n_grams", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    return with_columns(docs, {"text": text}, keep, T.StructType(added), compute)


# ------------------------------------------------------------------------------------------------ the forest
def whole_signatures(docs: DataFrame, keep: list[str], text: str, trees: int) -> DataFrame:
    """``keep``, with the digest, all values (two bytes each, tree by tree) and the ``sketch``, a bit of each value."""

    def compute(batch: pa.RecordBatch) -> dict:
        digests, signed, sketches = [], [], []
        for found in scan.words(batch.column(0), scan.ALNUM):
            digests += digests_of(found)
            grams, places = shingles(found)
            full, values = tree_values(grams, places, trees, LONGEST)
            flat = values.reshape(len(full), trees * LONGEST)
            rows, bits = flat.astype(">u2"), np.packbits((flat >> np.uint32(7)).astype(np.uint8) & 1, axis=1)
            at = dict(zip(full.tolist(), range(len(full))))
            signed += [rows[at[i]].tobytes() if i in at else None for i in range(len(places) - 1)]
            sketches += [bits[at[i]].tobytes() if i in at else None for i in range(len(places) - 1)]
        return {"digest": pa.array(digests, pa.binary()), "signed": pa.array(signed, pa.binary()), "sketch": pa.array(sketches, pa.binary())}

    added = T.StructType([T.StructField(c, T.BinaryType()) for c in ("digest", "signed", "sketch")])
    return with_columns(docs, {"text": text}, keep, added, compute)


@dataclass
class Node:
    """Texts of one tree that share the floor's prefix, sorted by signature."""

    rids: np.ndarray
    values: np.ndarray  # texts x LONGEST
    sketches: np.ndarray  # texts x words of 64 bits
    depths: np.ndarray
    bits: int

    @classmethod
    def of(cls, rows: list[tuple], bits: int) -> Node:
        by_rid = {r[0]: r for r in rows}  # repeated documents bring the same text again
        rows = sorted(by_rid.values(), key=lambda r: (r[1], r[0]))
        values = np.frombuffer(b"".join(r[1] for r in rows), ">u2").reshape(len(rows), -1)
        wide = -(-len(rows[0][2]) // 8) * 8
        sketches = np.frombuffer(b"".join(r[2].ljust(wide, b"\0") for r in rows), np.uint64).reshape(len(rows), -1)
        return cls(np.array([r[0] for r in rows], np.int64), values, sketches, np.array([r[3] for r in rows], np.int64), bits)

    def alike(self, one: int, others: np.ndarray) -> np.ndarray:
        """Jaccard similarity as the sketches tell it: two values have the same bit with probability (1 + s) / 2."""
        apart = np.bitwise_count(self.sketches[others] ^ self.sketches[one]).sum(axis=1)
        return 1 - 2 * apart / self.bits

    def runs(self, depth: int) -> list[tuple[int, int]]:
        """Places of the trie's nodes at a prefix length that hold several texts: equal prefixes stand together."""
        new = np.ones(len(self.rids) + 1, bool)
        new[1:-1] = (self.values[1:, :depth] != self.values[:-1, :depth]).any(axis=1)
        at = np.flatnonzero(new)
        several = np.flatnonzero(np.diff(at) > 1)
        return list(zip(at[several].tolist(), at[several + 1].tolist()))

    def met(self, weights: np.ndarray) -> np.ndarray:
        """For each text the summed ``weights`` (a row per number of sketch bits that differ) of those with its whole signature."""
        sums = np.zeros((len(self.rids), weights.shape[1]))
        for a, b in self.runs(self.values.shape[1]):
            for one in range(a, b):
                apart = np.bitwise_count(self.sketches[a:b] ^ self.sketches[one]).sum(axis=1)
                apart[one - a] = self.bits  # not itself
                sums[one] = np.bincount(apart, minlength=self.bits + 1) @ weights
        return sums

    def links(self, floor: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
        """Candidate links, enough of them to connect all that are connected: below its own prefix length each text is
        compared with all others there that it is not connected with yet."""
        label = np.arange(len(self.rids))
        for depth in range(self.values.shape[1], floor - 1, -1):
            asks = self.depths == depth
            if not asks.any():
                continue
            for a, b in self.runs(depth):
                if not asks[a:b].any():
                    continue
                rest = np.arange(a, b)
                while len(rest) > 1:
                    queue, rest = [int(rest[0])], rest[1:]
                    while queue and len(rest):
                        one = queue.pop()
                        near = self.alike(one, rest) >= similarity - SKETCH_SLACK
                        if near.any():
                            hit, rest = rest[near], rest[~near]
                            queue += hit.tolist()
                            joined = np.unique(label[[one, *hit.tolist()]])
                            label[np.isin(label, joined)] = joined[0]
        linked = np.flatnonzero(label != np.arange(len(label)))
        return self.rids[linked], self.rids[label[linked]]


def _by_node(rows: DataFrame, found: Callable[[Node], pa.RecordBatch | None], schema: T.StructType, bits: int) -> DataFrame:
    """Work on one node, or one pair of a large node's blocks, at a time; its texts come sorted by signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for here, row in zip(zip(*columns[:3]), zip(*columns[3:])):
                if here != key:
                    if len(held) > 1 and (made := found(Node.of(held, bits))) is not None:
                        yield made
                    key, held = here, []
                held.append(row)
        if len(held) > 1 and (made := found(Node.of(held, bits))) is not None:
            yield made

    dealt = rows.repartition("node", "first", "second").sortWithinPartitions("node", "first", "second", "values")
    return mapped(dealt.select("node", "first", "second", "rid", "values", "sketch", "depth"), run, schema)


def prefix_lengths(rows: DataFrame, floor: int, trees: int, similarity: float, target: float, bits: int) -> DataFrame:
    """``rid`` and ``depth`` of the texts whose links are met at a longer prefix than the floor's.

    A pair of similarity s shares the longest prefix in trees * s^LONGEST trees on average, so each meeting stands for the
    inverse of that many links, of which (1 - s^k)^trees are missed at prefix length k.
    """
    lengths = list(range(floor + 1, LONGEST + 1))
    schema = T.StructType([T.StructField("rid", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in ["all", *[f"m{k}" for k in lengths]]])

    s = 1 - 2 * np.arange(bits + 1) / bits
    near, s = s >= similarity - SKETCH_SLACK, np.clip(s, similarity, 1)
    stands_for = np.where(near, 1 / (trees * s**LONGEST), 0)
    weights = np.stack([stands_for, *[stands_for * (1 - s**k) ** trees for k in lengths]], axis=1)

    def found(node: Node) -> pa.RecordBatch | None:
        sums = node.met(weights)
        some = np.flatnonzero(sums[:, 0])
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays([pa.array(node.rids[some]), *[pa.array(x) for x in sums[some].T]], names=schema.names)

    met = _by_node(rows, found, schema, bits).groupBy("rid").agg(*[F.sum(f.name).alias(f.name) for f in schema.fields[1:]])
    depth = F.lit(floor)
    for k in lengths:
        depth = F.when(F.col(f"m{k}") <= (1 - target) * F.col("all"), k).otherwise(depth)
    return met.select("rid", depth.cast("long").alias("depth")).where(F.col("depth") > floor)


def candidate_links(rows: DataFrame, floor: int, similarity: float, bits: int) -> DataFrame:
    """Links (a, b) between texts that share a node and look alike enough to be verified."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def found(node: Node) -> pa.RecordBatch | None:
        a, b = node.links(floor, similarity)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=schema.names) if len(a) else None

    return _by_node(rows, found, schema, bits)


def candidate_groups(docs: DataFrame, texts: DataFrame, trees: int, floor: int, similarity: float, target: float) -> DataFrame:
    """``rid`` and ``group`` of the texts that have candidates."""
    nodes = texts.select("rid", F.posexplode("keys").alias("tree", "node"))
    full = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = full.select("node", F.ceil(F.col("n") / NODE_TEXTS).cast("int").alias("blocks"))
    shared = materialise(nodes.join(full, "node"), "nodes")
    members, n = materialise_counted(shared.select("rid").distinct().join(texts.select("rid", "digest", "min_id"), "rid"), "node_members")
    asked = members.withColumnRenamed("digest", "want")
    signed = docs.join(F.broadcast(asked) if n <= BROADCAST_ROWS else asked, F.col("doc_id").eqNullSafe(F.col("min_id")))
    signed = whole_signatures(signed, ["rid", "want"], "text", trees).where("digest = want").select("rid", "signed", "sketch")
    signed = materialise(signed.dropDuplicates(["rid"]), "signed")
    width = 2 * LONGEST
    rows = shared.join(signed, "rid").select(
        "rid", "node", "blocks", F.substring(F.col("signed"), F.col("tree") * width + 1, F.lit(width)).alias("values"), "sketch"
    )
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "rid", "node", "values", "sketch", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second")
    )
    rows, bits = materialise(rows, "trie"), trees * LONGEST
    lengths, n = materialise_counted(
        prefix_lengths(rows.withColumn("depth", F.lit(LONGEST).cast("long")), floor, trees, similarity, target, bits), "prefix_lengths"
    )
    lengths = F.broadcast(lengths) if n <= BROADCAST_ROWS else lengths
    deep = rows.join(lengths, "rid", "left").withColumn("depth", F.coalesce("depth", F.lit(floor).cast("long")))
    found = components(candidate_links(deep, floor, similarity, bits))
    return found.select(F.col("node").alias("rid"), F.col("root").alias("group"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): ``node`` and its ``root``, for every node that has a link.

    Each round gives every node the smallest of its neighbours as parent and continues with the links between
    parents; links within a parent vanish. Stars take one round, chains shrink by half or more. Each round is
    written, so a lost executor costs at most one round.
    """
    links, n = materialise_counted(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    parents: list[DataFrame] = []
    while n or not parents:
        both = links.select(F.col("a").alias("node"), "b").union(links.select(F.col("b").alias("node"), F.col("a")))
        near = both.groupBy("node").agg(F.min("b").alias("b"))
        parent = materialise(near.select("node", F.least("node", "b").alias("parent")), "parents")
        parents.append(parent)
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = links.join(left, "a").join(right, "b").where("pa <> pb")
        moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        links, n = materialise_counted(moved, "links")
    out = parents[0].withColumnRenamed("parent", "root")
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("root"), "parent")
        out = out.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
    return out


def common_counts(grams: list[np.ndarray]) -> np.ndarray:
    """Number of common members of every two of these sorted sets."""
    n = len(grams)
    lengths = np.fromiter(map(len, grams), np.int64, n)
    owner = np.repeat(np.arange(n), lengths)
    _, gram = np.unique(np.concatenate(grams), return_inverse=True)
    shared = np.bincount(gram) > 1
    keep = shared[gram]
    owner, gram = owner[keep], (np.cumsum(shared) - 1)[gram[keep]]
    counts = np.zeros((n, n), np.float64)
    counts[np.arange(n), np.arange(n)] = lengths
    if not len(gram):
        return counts
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    total = np.zeros((n, n), np.float64)
    most = int(gram[-1]) + 1
    for first in range(0, most, COLUMNS):
        a, b = np.searchsorted(gram, [first, first + COLUMNS])
        part = np.zeros((n, min(COLUMNS, most - first)), np.float32)
        part[owner[a:b], gram[a:b] - first] = 1
        total += part @ part.T
    np.fill_diagonal(total, lengths)
    return total


def verify(
    grams: list[np.ndarray], weights: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of texts of one block with those of another (or the same): weight linked to each, and a label
    that is the smallest place each can reach."""
    limit = Fraction(similarity).limit_denominator(1000)
    counts = common_counts(grams)
    lengths = np.diag(counts)
    union = lengths[:, None] + lengths[None, :] - counts
    linked = counts * limit.denominator >= limit.numerator * union
    linked &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    np.fill_diagonal(linked, False)
    total = linked @ weights
    label = np.arange(len(grams))
    if linked.any():
        while True:
            seen = np.where(linked, label[None, :], len(grams)).min(axis=1)
            new = np.minimum(label, seen)
            new = new[new]
            if (new == label).all():
                break
            label = new
    return total, label


def block_links(payload: DataFrame, similarity: float) -> DataFrame:
    """``rid``, ``links`` and ``root`` of the texts of each pair of blocks that have a link there."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("rid", "links", "root")])

    def judged(rows: list[tuple]) -> pa.RecordBatch | None:
        by_rid = {r[3]: r for r in rows}  # repeated documents bring the same text again
        rows = [by_rid[r] for r in sorted(by_rid)]
        if len(rows) < 2:
            return None
        own = np.array([r[4] for r in rows])
        weights = np.array([r[5] for r in rows], np.int64)
        grams = [np.frombuffer(r[6], np.uint64) for r in rows]
        total, label = verify(grams, weights, own == rows[0][1], own == rows[0][2], similarity)
        at = np.flatnonzero(total)
        if not len(at):
            return None
        rids = np.array([r[3] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(rids[at]), pa.array(total[at].astype(np.int64)), pa.array(rids[label[at]])], names=schema.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if rows and row[:3] != rows[0][:3]:
                    made = judged(rows)
                    if made is not None:
                        yield made
                    rows = []
                rows.append(row)
        if rows and (made := judged(rows)) is not None:
            yield made

    dealt = payload.repartition("group", "first", "second").sortWithinPartitions("group", "first", "second")
    return mapped(dealt.select("group", "first", "second", "rid", "own", "n_docs", "grams"), run, schema)


def sorted_grams(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep``, with the digest and the sorted distinct shingles of each text, 8 bytes each."""

    def compute(batch: pa.RecordBatch) -> dict:
        digests, grams = [], []
        for found in scan.words(batch.column(0), scan.ALNUM):
            digests += digests_of(found)
            every, places = shingles(found)
            grams += [np.unique(every[a:b]).tobytes() for a, b in zip(places, places[1:])]
        return {"digest": pa.array(digests, pa.binary()), "grams": pa.array(grams, pa.binary())}

    added = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("grams", T.BinaryType())])
    return with_columns(docs, {"text": text}, keep, added, compute)


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    trees: int = TREES,
    target: float = TARGET,
) -> DataFrame:
    """One row per document: ``doc_id``, ``digest``, ``class_id``, ``class_size``, ``n_links``, ``keeper``.

    ``keeper`` is the digest of the row that stands for the class (with its ``class_id``).
    """
    length = floor_length(trees, LONGEST, similarity, target)
    docs = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    signed = materialise(signatures(docs, ["doc_id"], "text", trees, length), "signatures")
    texts = signed.where("digest IS NOT NULL")
    texts = texts.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.min("doc_id").alias("min_id"),
        F.first("n_grams").alias("n_grams"),
        F.first("keys").alias("keys"),
    )
    texts = materialise(texts.withColumn("rid", F.monotonically_increasing_id()), "texts")

    groups = candidate_groups(docs, texts, trees, length, similarity, target)
    members = groups.join(texts.select("rid", "digest", "min_id", "n_docs", "n_grams"), "rid")
    members, n_members = materialise_counted(members, "members")
    sizes = members.groupBy("group").agg(
        F.greatest(
            F.ceil(F.sum("n_grams") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS)
        ).cast("int").alias("blocks")
    )
    asked = members.select("rid", "group", "digest", "min_id", "n_docs").join(sizes, "group")
    asked = asked.withColumnRenamed("digest", "want")
    few = n_members <= BROADCAST_ROWS
    found = docs.join(F.broadcast(asked) if few else asked, F.col("doc_id").eqNullSafe(F.col("min_id")))
    found = sorted_grams(found, ["rid", "group", "n_docs", "blocks", "want"], "text").where("digest = want")
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    found = found.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = found.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
    links = materialise(block_links(found, similarity), "verified")

    counts = links.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    linked = counts.join(roots.withColumnRenamed("node", "rid"), "rid", "left")
    known = texts.select("rid", "digest", "min_id", "n_docs").join(linked, "rid", "left").select(
        "digest",
        "min_id",
        "n_docs",
        F.coalesce("root", "rid").alias("root"),
        (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    known = materialise(known, "known")
    whole = known.groupBy("root").agg(
        F.min("min_id").alias("class_id"), F.sum("n_docs").alias("class_size"),
        F.min_by("digest", F.struct("min_id", "digest")).alias("keeper"),
    )
    named = known.select("digest", "root", "n_links").join(whole, "root").drop("root")
    out = signed.select("doc_id", "digest").join(named, "digest", "left")
    alone = F.col("digest").isNull()
    return out.select(
        "doc_id",
        "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "keeper",
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: that of the smallest doc_id. Texts without words all stay."""
    found = materialise(classes(docs, doc_id, text), "classes")
    names = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    signed = signatures(plain, plain.columns, names[text], with_keys=False)
    rows = found.where("digest IS NOT NULL").groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("keeper"))).alias("stays"),
    )
    rows = materialise(rows, "rows")
    dropped, n = materialise_counted(rows.where("NOT stays").select("doc_id", F.col("digest").alias("known")), "dropped")
    dropped = F.broadcast(dropped) if n <= BROADCAST_ROWS else dropped
    same = signed[names[doc_id]].eqNullSafe(dropped["doc_id"]) & (signed["digest"] == dropped["known"])
    out = signed.join(dropped, same, "left_anti")
    if rows.where("stays AND n > 1").limit(1).count():  # the keeper itself stands in the table more than once
        repeated = out.where("digest IS NOT NULL").dropDuplicates([names[doc_id], "digest"])
        out = repeated.unionByName(out.where("digest IS NULL"))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
