"""SimHash near duplicates: fingerprints meet at the anchor points of a covering code.

1. *Fingerprints.* Words are runs without white space, A-Z as a-z; each run of three words (repeats included; fewer
   words: all of them) is hashed with XXH64, seed 42. A bit is 1 where over half the hashes have it.
   Rows of equal fingerprints are one from then on, with their smallest id.
2. *Anchors.* The code is the product of two binary Golay codes over bits 0-22 and 23-45: 2^24 anchors. Each half is
   perfect with covering radius 3, so every fingerprint has exactly one home, the anchor within 3 bits in both.
3. *Replicas.* A fingerprint is copied to every anchor within covering radius plus threshold. The radius holds
   in each half and the threshold is shared by them: what its distances exceed 3 by may sum up to 3. If
   x and y differ in at most 3 bits, y differs from x's home by at most 3 plus those bits in each half, so y is there.
4. *Comparison.* Each anchor compares its homes with all that came to it, exactly, over 64 bits. The rows that
   travel go to a cell, which is all anchors of one first half (71 copies a fingerprint); the second half is
   expanded where they arrive. A cell that holds far more rows than others deals its homes out to several tasks.
5. *Components* of the links; each task sends a link per fingerprint to the smallest it reaches there, never pairs.

The number of copies is that of the code and does not depend on the data: about 71 rows of 9 bytes per distinct
fingerprint are shuffled, and memory is that of one cell, a 58th of the distinct fingerprints or a task's share of it.

Results (:func:`components`): one row per input row with ``doc_id``, ``fingerprint`` and ``component_id``. A text without
words (null, empty, white space) has fingerprint zero and links like any other. Very long texts are hashed in
portions. Repeated rows share a component. A null id never names a component while another id is there. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh64_digest

from reqlytics.llm import jaccard
from reqlytics.llm.common import mapped, materialise, with_columns
from reqlytics.operators.joins import lookup_join
from reqlytics.sources.warehouse import materialise_counted

SHINGLE = 3
THRESHOLD = 3
SEED = 42
#: Hashes of a text whose bits are counted at once.
PORTION = 1 << 15
#: A cell of more rows than this, and of more than four times the mean, is dealt out to several tasks.
CELL_ROWS = 1 << 16
#: Pairs compared at once.
PAIRS = 1 << 21
#: A fingerprint is hot where it stands for more than one of so many rows; so there are never more hot ones.
HOT_SHARE = 10_000

# The binary Golay code of 23 bits, its generator polynomial, and its covering radius.
LENGTH, GENERATOR, RADIUS = 23, 0b110001110101, 3
INFORMATION = 12
BLOCK = (1 << LENGTH) - 1


# ------------------------------------------------------------------------------------------------ fingerprints
def fingerprint(text: bytes | None) -> int:
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    runs = zip(*[words[k:] for k in range(SHINGLE)]) if len(words) >= SHINGLE else iter([words])
    digests = map(xxh64_digest, map(b" ".join, runs), repeat(SEED))
    ones, n = np.zeros(64, np.int64), 0
    while held := b"".join(islice(digests, PORTION)):
        bits = np.unpackbits(np.frombuffer(held, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(bits)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, with the fingerprint as the ``bits`` of a long."""

    def compute(batch: pa.RecordBatch) -> dict:
        column = batch.column(0).cast(pa.large_binary())
        found = np.array([fingerprint(t.as_py()) for t in column], np.uint64)
        return {"bits": pa.array(found.view(np.int64))}

    return with_columns(docs, {"text": text}, keep, T.StructType([T.StructField("bits", T.LongType())]), compute)


# ------------------------------------------------------------------------------------------------ the code
class Golay:
    """The words within 3 + ``THRESHOLD`` bits of a word, that are in the code, by how far beyond 3 they are."""

    def __init__(self) -> None:
        high = np.arange(1 << INFORMATION, dtype=np.uint32) << np.uint32(LENGTH - INFORMATION)
        for bit in range(LENGTH - 1, LENGTH - INFORMATION - 1, -1):
            high ^= ((high >> np.uint32(bit)) & np.uint32(1)) * np.uint32(GENERATOR << (bit - (LENGTH - INFORMATION)))
        self.rests = high  # remainder of the upper 12 bits by the generator
        errors = [0]
        for weight in range(1, RADIUS + THRESHOLD + 1):
            errors += [sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)]
        errors = np.array(errors, np.uint32)
        beyond = np.maximum(np.bitwise_count(errors).astype(np.int64) - RADIUS, 0)
        kind = self.syndromes(errors).astype(np.int64) * (THRESHOLD + 2) + beyond
        order = np.argsort(kind, kind="stable")
        self.errors, self.beyond = errors[order], beyond[order]
        self.bounds = np.searchsorted(kind[order], np.arange((THRESHOLD + 2) << (LENGTH - INFORMATION)))

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        low = words & np.uint32((1 << (LENGTH - INFORMATION)) - 1)
        return low ^ self.rests[words >> np.uint32(LENGTH - INFORMATION)]

    def near(self, words: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code words at most ``RADIUS + most`` from each word: its place, the code word's upper 12 bits, the excess."""
        first = self.syndromes(words).astype(np.int64) * (THRESHOLD + 2)
        starts, ends = self.bounds[first], self.bounds[first + most + 1]
        counts = ends - starts
        place = np.repeat(np.arange(len(words)), counts)
        at = np.arange(len(place)) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
        code = (words[place] ^ self.errors[at]) >> np.uint32(LENGTH - INFORMATION)
        return place, code, self.beyond[at]


_golay: list[Golay] = []


def golay() -> Golay:
    if not _golay:
        _golay.append(Golay())
    return _golay[0]


def half(bits: np.ndarray, which: int) -> np.ndarray:
    return ((bits >> np.uint64(LENGTH * which)) & np.uint64(BLOCK)).astype(np.uint32)


def replicas(distinct: DataFrame) -> DataFrame:
    """Rows of a ``cell``: packed ``bits`` of ``n`` fingerprints and by how much each ``exceeds`` the radius."""
    schema = T.StructType(
        [T.StructField("cell", T.IntegerType()), T.StructField("n", T.LongType()),
         T.StructField("exceeds", T.BinaryType()), T.StructField("bits", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            place, cell, beyond = golay().near(half(bits, 0), np.full(len(bits), THRESHOLD))
            order = np.argsort(cell, kind="stable")
            cell, beyond, copied = cell[order], beyond[order].astype(np.uint8), bits[place[order]]
            firsts = np.flatnonzero(np.diff(cell, prepend=np.uint32(1 << 31)))
            ends = np.append(firsts[1:], len(cell))
            spans = list(zip(firsts.tolist(), ends.tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell[firsts].astype(np.int32)),
                    pa.array(ends - firsts),
                    pa.array([beyond[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([copied[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=schema.names,
            )

    return mapped(distinct.select("bits"), run, schema)


# ------------------------------------------------------------------------------------------------ comparison
class Labels:
    """Smallest place reachable by links, for places 0 .. n."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.of[a], self.of[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.of, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                step = self.of[self.of]
                if (step == self.of).all():
                    break
                self.of = step


def compared(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers ``i`` and the places ``starts[i] .. ends[i]`` of each, about ``PAIRS`` at a time."""
    counts = ends - starts
    upto = np.cumsum(counts)
    first = 0
    while first < len(counts):
        done = upto[first] - counts[first]
        last = max(first + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
        some = counts[first:last]
        row = np.repeat(np.arange(first, last), some)
        at = np.arange(len(row)) + np.repeat(starts[first:last] - (np.cumsum(some) - some), some)
        yield row, at
        first = last


def cell_links(bits: np.ndarray, exceeds: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of one cell that link to homes of ``part``, each with the smallest that it reaches so."""
    order = np.argsort(bits)
    bits, exceeds = bits[order], exceeds[order].astype(np.int64)
    place, anchor, more = golay().near(half(bits, 1), THRESHOLD - exceeds)
    at_home = (exceeds[place] + more) == 0
    if parts > 1:
        at_home &= (jaccard.scan.mix(bits[place]) % np.uint64(parts)) == np.uint64(part)
    order = np.argsort(anchor, kind="stable")
    place, anchor, at_home = place[order], anchor[order], at_home[order]
    homes = np.flatnonzero(at_home)
    starts, ends = np.searchsorted(anchor, anchor[homes]), np.searchsorted(anchor, anchor[homes], side="right")
    labels = Labels(len(bits))
    for row, at in compared(starts, ends):
        mine, other = place[homes[row]], place[at]
        near = np.flatnonzero(np.bitwise_count(bits[mine] ^ bits[other]) <= THRESHOLD)
        mine, other = mine[near], other[near]
        labels.link(mine, other)
    linked = np.flatnonzero(labels.of != np.arange(len(bits)))
    return bits[linked], bits[labels.of[linked]]


def links(rows: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints of the replicas' cells, enough of them to join all that differ little."""
    sizes = rows.groupBy("cell").agg(F.sum("n").alias("n"))
    spread = {r["cell"]: r["n"] for r in sizes.collect()}  # at most 4096 cells
    usual = max(CELL_ROWS, 4 * sum(spread.values()) // max(1, len(spread)))
    busy = {cell: -(-n // usual) for cell, n in spread.items() if n > usual}
    parts = F.lit(1)
    if busy:
        parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in busy.items() for x in kv]), F.col("cell")), F.lit(1))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def judged(key: tuple, held: list[tuple]) -> pa.RecordBatch:
        bits = np.frombuffer(b"".join(r[0] for r in held), np.uint64)
        exceeds = np.frombuffer(b"".join(r[1] for r in held), np.uint8)
        a, b = cell_links(bits, exceeds, key[1], key[2])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            cells, part, of, exceeds, bits = (batch.column(i) for i in range(5))
            for i, here in enumerate(zip(cells.to_pylist(), part.to_pylist(), of.to_pylist())):
                if here != key and held:
                    yield judged(key, held)
                    held = []
                key = here
                held.append((bits[i].as_py(), exceeds[i].as_py()))
        if held:
            yield judged(key, held)

    dealt = rows.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part")
    return mapped(dealt.select("cell", "part", "parts", "exceeds", "bits"), run, schema)


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable over links)."""
    plain = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    signed, n = materialise_counted(fingerprints(plain, ["doc_id"]), "fingerprints")
    distinct = signed.groupBy("bits").agg(F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("n"))
    distinct = materialise(distinct, "distinct")
    found = materialise(links(materialise(replicas(distinct), "replicas")), "links")
    roots = jaccard.components(found).withColumnRenamed("node", "bits")
    members = materialise(distinct.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")), "members")
    named = members.groupBy("root").agg(F.min("min_id").alias("component_id"), F.sum("n").alias("rows"))
    shared = named.where("rows > 1")  # all others are alone, and named after themselves
    shared = members.select("bits", "root").join(shared.select("root", "component_id"), "root").select("bits", "component_id")
    hot_rows = max(100, n // HOT_SHARE)
    out = lookup_join(signed, shared, "bits", spread_by=F.col("doc_id"), small=False, hot_rows=hot_rows)
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))
