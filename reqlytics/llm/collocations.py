"""Phrases whose words stand together more often than their parts do, counted exactly in quotient filters.

Texts, A-Z as a-z, are parted at ``.,;:!?`` and line ends, the pieces into words at spaces and tabs. Per language, a
phrase is 2 to 4 words within a piece that occur at least ``least`` times. Its score is the lowest over its cuts in
two of floor(2,000,000 a / (l + r)): a, l, r count the phrase and the two parts. A phrase inside a longer one that
occurs at least 0.8 times as often is dropped.

1. *Shards.* Each task cuts its texts into shards of about a million words, numbers a shard's words (the frequent ones
   first) and writes the numbers, and each word once with its count.
2. *Words.* Counts are added up over all shards. Words below ``least`` cannot be in a phrase; all others get an id,
   unique over all languages. Each shard is given the ids of its own words only: no vocabulary is broadcast.
3. *Filters.* First pairs are counted, then runs of 3 and 4 whose pairs all occur often enough (a bit table of bounded size
   tells; it may let others through, which are then counted for nothing). A shard's n-grams, four ids of b bits with 0 for none, are packed into two halves and permuted by a Feistel
   network, which can be undone. The upper bits are a quotient, all others the remainder, kept in full: a
   counting quotient filter (:class:`Filter`) of runs of remainders per quotient with counters in further slots, without
   loss. A filter covers a range of quotients, so equal n-grams of all shards come to one task.
4. *Merge.* Filters are sorted, and are merged into one as they come; what then occurs often enough is a phrase.
5. *Cuts.* Counts of parts are joined by ids, the largest count of a longer phrase is aggregated over the phrases inside it.
   Words are joined to the phrases that can be among the first only.

Memory is that of a shard or of one range of quotients (:data:`RANGE`); a text longer than a shard is a shard.

Results (:func:`mined`): ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (all words of the language), ``score``; each language's
first ``top``. Null texts are empty, a null language is ``und``. Repeated rows count as often as they stand. Ties in
score go by a, then by the phrase's UTF-8 bytes; ties between cuts to the shortest first part. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from reqlytics.llm.common import mapped, materialise
from reqlytics.llm.scan import mix
from reqlytics.operators.joins import lookup_join
from reqlytics.sources.warehouse import materialise_counted

LONGEST = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
#: Percent of a phrase's count that a longer one needs to replace it.
COVERED = 80
SHARD_WORDS = 1 << 20
#: N-grams that a range of quotients is meant to hold as they come.
RANGE = 1 << 20
ROUNDS = 3
SALTS = 16

# A-Z become a-z; . , ; : ! ? and \n \v \f \r end a piece; space and tab part words.
_ENDS = b".,;:!?\n\v\f\r"
_CUT = bytes(10 if b in _ENDS else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_END, _NONE = b"\n", b""


# ------------------------------------------------------------------------------------------------ shards
class Numbers(dict):
    """A number per word, in order of arrival; 0 is the end of a piece, 1 is nothing."""

    def __init__(self) -> None:
        super().__init__({_END: 0, _NONE: 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def planes(numbers: np.ndarray) -> bytes:
    """Four bytes a number, all lowest bytes first: the upper ones are mostly zero and take little room once written."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(held: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Shard:
    """The words of some texts of several languages: numbers from 1 by falling count, 0 between pieces."""

    def __init__(self) -> None:
        self.numbers: dict[str, Numbers] = {}
        self.texts: dict[str, list[np.ndarray]] = {}
        self.words = 0

    def add(self, lang: str, text: bytes) -> None:
        numbers = self.numbers.setdefault(lang, Numbers())
        said = text.translate(_CUT).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(numbers.__getitem__, said), np.uint32, len(said))
        found = np.append(found[found != 1], np.uint32(0))
        self.texts.setdefault(lang, []).append(found)
        self.words += len(found)

    def rows(self, shard: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        """Per language a row with the numbers of its texts, and one per word with its number and count."""
        for lang, texts in self.texts.items():
            found = np.concatenate(texts)
            counts = np.bincount(found, minlength=len(self.numbers[lang]))
            order = np.argsort(-counts[2:], kind="stable") + 2
            place = np.zeros(len(counts), np.uint32)
            place[order] = np.arange(1, len(order) + 1)
            words = list(self.numbers[lang])
            size = len(order) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, shard), pa.int64()),
                    pa.array([lang] * size, pa.string()),
                    pa.array([None, *(words[k] for k in order.tolist())], pa.binary()).cast(pa.string()),
                    pa.array(np.arange(size), pa.int64()),
                    pa.array(np.append(0, counts[order]), pa.int64()),
                    pa.array([planes(place[found]), *[None] * (size - 1)], pa.binary()),
                ],
                names=names,
            )


def shards(docs: DataFrame) -> DataFrame:
    """``shard``, ``lang``, ``word``, its ``number`` there and count ``n``; number 0: the ``texts`` of that language."""
    schema = T.StructType(
        [T.StructField("shard", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()),
         T.StructField("number", T.LongType()), T.StructField("n", T.LongType()), T.StructField("texts", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = Shard(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                held.add(lang, text.as_py())
                if held.words >= SHARD_WORDS:
                    yield from held.rows(shard, schema.names)
                    held, shard = Shard(), shard + 1
        yield from held.rows(shard, schema.names)

    lang = F.coalesce(docs["`lang`"].cast("string"), F.lit("und"))
    text = F.coalesce(docs["`text`"].cast("string"), F.lit(""))
    return mapped(docs.select(lang.alias("lang"), text.alias("text")), run, schema)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with an ``id`` from 1, without gaps: one record per partition is enough to number them all."""
    held = materialise(words.withColumn("place", F.monotonically_increasing_id()), "words")
    sizes = held.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    upto, firsts = 1, {}
    for part, n in sorted(tuple(r) for r in sizes):  # one per partition of the table
        firsts[part], upto = upto, upto + n
    first = F.lit(0)
    if firsts:
        first = F.element_at(F.create_map(*[F.lit(x) for kv in firsts.items() for x in kv]), F.shiftright("place", 33))
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn("id", first.cast("long") + inside).drop("place")


# ------------------------------------------------------------------------------------------------ filters
def permuted(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network over two halves of ``bits`` bits."""
    mask = np.uint64((1 << bits) - 1)
    for k in range(1, ROUNDS + 1):
        left, right = right, left ^ (mix(right + np.uint64(k << 56)) & mask)
    return left, right


def restored(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    for k in range(ROUNDS, 0, -1):
        left, right = right ^ (mix(left + np.uint64(k << 56)) & mask), left
    return left, right


def _to_bytes(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(values).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]


def _from_bytes(held: np.ndarray) -> np.ndarray:
    full = np.zeros((len(held), 8), np.uint8)
    full[:, 8 - held.shape[1] :] = held
    return full.view(">u8").ravel().astype(np.uint64)


@dataclass
class Filter:
    """Counted keys of ``2 * bits`` bits, given as two halves, in order; all share the upper ``skip`` bits.

    As bytes it is a counting quotient filter. The ``q`` bits after ``skip`` are a key's quotient; a bit per quotient
    tells which have a run of slots, a bit per slot where a run ends. A slot holds a remainder, that is all further bits
    of the key; a count above 1 follows in slots of its own, as digits, the lowest first, told by a third
    bit per slot. Nothing is rounded or hashed together, so keys and counts come back as they were.
    """

    bits: int
    skip: int
    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    @classmethod
    def of(cls, bits: int, skip: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> Filter:
        """From keys in any order, with repeats."""
        if 2 * bits - skip <= 64:  # one word holds what keys differ in
            low = left & np.uint64((1 << (bits - skip)) - 1)
            order = np.argsort((low << np.uint64(bits)) | right, kind="stable")
        else:
            order = np.lexsort((right, left))
        left, right = left[order], right[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        firsts = np.flatnonzero(new)
        if counts is None:
            counts = np.diff(np.append(firsts, len(left)))
        else:
            counts = np.add.reduceat(counts[order], firsts) if len(firsts) else np.zeros(0, np.int64)
        return cls(bits, skip, left[firsts], right[firsts], counts)

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        """One filter of several sorted ones over the same range: equal keys' counts are added."""
        if len(filters) == 1:
            return filters[0]
        joined = [np.concatenate([getattr(f, c) for f in filters]) for c in ("left", "right", "counts")]
        return cls.of(filters[0].bits, filters[0].skip, *joined)

    def ranges(self, parts: int) -> Iterator[tuple[int, Filter]]:
        """The filter in ``2 ** parts`` pieces by the uppermost bits, without the empty ones."""
        part = self.left >> np.uint64(self.bits - parts)
        edges = np.searchsorted(part, np.arange((1 << parts) + 1, dtype=np.uint64))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[k], edges[k + 1]
            yield k, Filter(self.bits, parts, self.left[a:b], self.right[a:b], self.counts[a:b])

    def _shape(self, n: int) -> tuple[int, int, int]:
        """Bits of the quotient, and bytes of what remains of both halves."""
        q = min(self.bits - self.skip, max(1, n.bit_length() - 1))
        return q, -(-(self.bits - self.skip - q) // 8), -(-self.bits // 8)

    def to_bytes(self) -> bytes:
        n = len(self)
        q, wide, narrow = self._shape(n)
        rest = np.uint64(self.bits - self.skip - q)
        low = self.left & np.uint64((1 << (self.bits - self.skip)) - 1)
        quotient = low >> rest
        width = wide + narrow
        digits, left_over = np.zeros(n, np.int64), np.where(self.counts > 1, self.counts, 0)
        while left_over.any():
            digits += left_over > 0
            left_over = left_over >> (8 * min(width, 7))
        slots = np.zeros((n + int(digits.sum()), width), np.uint8)
        at = np.arange(n) + np.cumsum(digits) - digits
        slots[at, :wide] = _to_bytes(low & ((np.uint64(1) << rest) - np.uint64(1)), wide)
        slots[at, wide:] = _to_bytes(self.right, narrow)
        counter = np.ones(len(slots), bool)
        counter[at] = False
        for k in range(int(digits.max(initial=0))):
            some = np.flatnonzero(digits > k)
            digit = (self.counts[some] >> (8 * min(width, 7) * k)) & ((1 << (8 * min(width, 7))) - 1)
            slots[at[some] + 1 + k, width - min(width, 7) :] = _to_bytes(digit.astype(np.uint64), min(width, 7))
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        ends = np.zeros(len(slots), bool)
        last = np.append(quotient[1:] != quotient[:-1], True)
        ends[(at + digits)[last]] = True
        head = np.array([n, len(slots), self.bits, self.skip], "<i8").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in (occupied, ends, counter)) + slots.tobytes()

    @classmethod
    def from_bytes(cls, held: bytes, above: int) -> Filter:
        """``above``: the upper bits that all keys share."""
        n, size, bits, skip = np.frombuffer(held, "<i8", 4).tolist()
        made = cls(bits, skip, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64))
        q, wide, narrow = made._shape(n)
        place, flags = 32, []
        for length in (1 << q, size, size):
            taken = -(-length // 8)
            flags.append(np.unpackbits(np.frombuffer(held, np.uint8, taken, place), count=length).astype(bool))
            place += taken
        occupied, ends, counter = flags
        slots = np.frombuffer(held, np.uint8, offset=place).reshape(size, wide + narrow)
        run = np.cumsum(ends) - ends  # runs before this slot: its quotient is that many occupied ones further
        at = np.flatnonzero(~counter)
        quotient = np.flatnonzero(occupied).astype(np.uint64)[run[at]]
        rest = np.uint64(bits - skip - q)
        left = (np.uint64(above) << np.uint64(bits - skip)) | (quotient << rest) | _from_bytes(slots[at, :wide])
        counts = np.ones(n, np.int64)
        digits = np.diff(np.append(at, size)) - 1
        step = min(wide + narrow, 7)
        for k in range(int(digits.max(initial=0))):
            some = np.flatnonzero(digits > k)
            digit = _from_bytes(slots[at[some] + 1 + k, wide + narrow - step :]).astype(np.int64)
            counts[some] = digit if k == 0 else counts[some] + (digit << (8 * step * k))
        return cls(bits, skip, left, _from_bytes(slots[at, wide:]), counts)


class Pairs:
    """A bit table of the pairs that occur often enough: all of them, and a few that share a bit.

    A longer phrase cannot occur more often than the pairs in it, so n-grams with another pair need not be counted.
    The table has at most ``MOST`` bits, whatever the number of pairs; with more pairs it only turns fewer n-grams away.
    """

    LEAST, MOST = 15, 28

    def __init__(self, bits: int, held: np.ndarray):
        self.bits, self.held = bits, held

    @staticmethod
    def place(first: np.ndarray, bits: int) -> np.ndarray:
        return mix(first + np.uint64(1)) & np.uint64((1 << bits) - 1)

    @classmethod
    def of(cls, pairs: DataFrame, n: int, bits: int) -> Pairs:
        size = min(cls.MOST, max(cls.LEAST, (16 * n).bit_length()))
        schema = T.StructType([T.StructField("place", T.LongType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                one, two = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.uint64) for k in (0, 1))
                place = cls.place((one << np.uint64(bits)) | two, size)
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64) + 1)], names=schema.names)

        places = mapped(pairs.select("w1", "w2"), run, schema)
        parts = places.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("held")
        )
        table = np.zeros(1 << (size - 3), np.uint8)
        for row in parts.collect():  # 4 KB each, 32 MB at most
            first = (row["part"] - 1) << 12
            table[first : first + 4096] = np.frombuffer(row["held"], np.uint8)
        return cls(size, table)

    def hold(self, first: np.ndarray) -> np.ndarray:
        at = self.place(first, self.bits)
        return (self.held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def grams(ids: np.ndarray, bits: int, pairs: Pairs | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids without a 0, packed in two halves of two ids each: every pair, or the runs of 3 and 4 of known ``pairs``."""
    wide, n = np.uint64(bits), len(ids)
    words = np.append(ids, [0] * LONGEST).astype(np.uint64)
    whole = (words[:-1] > 0) & (words[1:] > 0)
    first = (words[:-1] << wide) | words[1:]
    if pairs is None:
        at = np.flatnonzero(whole[:n])
        return first[at], np.zeros(len(at), np.uint64)
    whole[whole] = pairs.hold(first[whole])
    three = np.flatnonzero(whole[:n] & whole[1 : n + 1])
    four = three[whole[three + 2]]
    left = np.concatenate([first[three], first[four]])
    right = np.concatenate([words[three + 2] << wide, (words[four + 2] << wide) | words[four + 3]])
    return left, right


def dealt_texts(encoded: DataFrame, ids: DataFrame) -> DataFrame:
    """``number``, ``id`` of the words of a shard and language, then its ``texts``: shards go to tasks, a few to each."""
    texts = encoded.where("number = 0").select("shard", "lang", "number", F.lit(0).cast("long").alias("id"), "texts")
    words = ids.select("shard", "lang", "number", "id", F.lit(None).cast("binary").alias("texts"))
    both = words.unionByName(texts).repartition(max(1, texts.count() // 4), "shard", "lang")
    return both.sortWithinPartitions("shard", "lang", F.desc("number")).select("number", "id", "texts")


def in_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The words of each shard and language as ids, 0 for those that are too rare and between pieces."""
    places: list[np.ndarray] = []
    known: list[np.ndarray] = []
    for batch in batches:
        number, given = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        last = 0
        for at in np.flatnonzero(number == 0).tolist():  # after the words of its shard and language
            place, mine = np.concatenate([*places, number[last:at]]), np.concatenate([*known, given[last:at]])
            places, known, last = [], [], at + 1
            words = from_planes(batch.column(2)[at].as_py())
            names = np.zeros(int(max(words.max(initial=0), place.max(initial=0))) + 1, np.int64)
            names[place] = mine
            yield names[words]
        places.append(number[last:])
        known.append(given[last:])


def filters(texts: DataFrame, bits: int, parts: int, pairs=None) -> DataFrame:
    """``range`` and ``held``: a filter per shard, language and range of quotients; ``pairs`` is a broadcast table."""
    schema = T.StructType([T.StructField("range", T.LongType()), T.StructField("held", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if pairs is None else pairs.value
        for words in in_ids(batches):
            left, right = grams(words, bits, known)
            if not len(left):
                continue
            made = list(Filter.of(2 * bits, 0, *permuted(left, right, 2 * bits)).ranges(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in made], pa.int64()), pa.array([f.to_bytes() for _, f in made], pa.binary())],
                names=schema.names,
            )
            del words, left, right, made
        pa.default_memory_pool().release_unused()

    return mapped(texts, run, schema)


def phrases(made: DataFrame, bits: int, parts: int, least: int) -> DataFrame:
    """``w1`` .. ``w4`` and ``a`` of all n-grams that occur at least ``least`` times, from their filters."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("w1", "w2", "w3", "w4", "a")])

    def told(whole: Filter) -> pa.RecordBatch:
        often = np.flatnonzero(whole.counts >= least)
        left, right = restored(whole.left[often], whole.right[often], 2 * bits)
        low, wide = np.uint64((1 << bits) - 1), np.uint64(bits)
        words = [left >> wide, left & low, right >> wide, right & low]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(w.astype(np.int64)) for w in words], pa.array(whole.counts[often], pa.int64())], names=schema.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, waiting = None, [], 0
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k != key and held:
                    yield told(Filter.merged(held))
                    held, waiting = [], 0
                key = k
                held.append(Filter.from_bytes(blob.as_py(), k))
                waiting += len(held[-1])
                if waiting > RANGE and waiting > 2 * len(held[0]):
                    held, waiting = [Filter.merged(held)], 0
        if held:
            yield told(Filter.merged(held))

    dealt = made.repartition(1 << parts, "range").sortWithinPartitions("range")
    return mapped(dealt, run, schema)


# ------------------------------------------------------------------------------------------------ phrases
WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _part(first: int, last: int):
    """Words ``first`` .. ``last`` (from 1) of a phrase as the fields of a phrase of its own."""
    inside = [F.col(f"w{k}") for k in range(first, last + 1)]
    return [*inside, *[F.lit(0).cast("long")] * (LONGEST - len(inside))]


def _parts(pieces: list, condition) -> list:
    return [
        F.when(condition, F.struct(F.lit(role).alias("role"), *[c.alias(f"p{k}") for k, c in enumerate(_part(a, b), 1)]))
        for role, a, b in pieces
    ]


def _exploded(found: DataFrame, pieces: dict[int, list[tuple[str, int, int]]], keep: list[str]) -> DataFrame:
    """A row per part of each phrase: by the phrase's length, (role, first word, last word)."""
    made = [c for size, some in pieces.items() for c in _parts(some, F.col("size") == size)]
    listed = found.select(*keep, F.explode(F.filter(F.array(*made), lambda p: p.isNotNull())).alias("part"))
    return listed.select(*keep, "part.*")


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with the counts ``l``, ``r`` of the parts of their lowest cut, and ``score``."""
    counts = found.select(*[F.col(w).alias(f"p{k}") for k, w in enumerate(WORDS, 1)], F.col("a").alias("f"))
    alone = words.select(F.col("id").alias("p1"), *[F.lit(0).cast("long").alias(f"p{k}") for k in (2, 3, 4)], F.col("f"))
    known = materialise(counts.unionByName(alone), "counts")
    cuts = {m: [p for k in range(1, m) for p in ((f"l{k}", 1, k), (f"r{k}", k + 1, m))] for m in range(2, LONGEST + 1)}
    parts = materialise(_exploded(found, cuts, [*WORDS, "a"]), "parts")
    keys = [f"p{k}" for k in range(1, LONGEST + 1)]
    told = lookup_join(parts, known, keys, "inner", spread_by=F.struct(*WORDS, "role"), small=False, hot_rows=1 << 14)
    sides = [f"{side}{k}" for k in range(1, LONGEST) for side in "lr"]
    wide = told.groupBy(*WORDS, "a").agg(*[F.max(F.when(F.col("role") == s, F.col("f"))).alias(s) for s in sides])
    above = F.lit(SCALE).cast("decimal(10,0)") * F.col("a").cast("decimal(19,0)")
    options = []
    for k in range(1, LONGEST):
        total = (F.col(f"l{k}") + F.col(f"r{k}")).cast("decimal(20,0)")
        score = F.call_function("div", above, total)
        one = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        options.append(F.when(F.col(f"l{k}").isNotNull(), one))
    lowest = F.array_min(F.filter(F.array(*options), lambda c: c.isNotNull()))
    return wide.select(*WORDS, "a", lowest.alias("cut")).select(*WORDS, "a", "cut.l", "cut.r", "cut.score")


def standing(found: DataFrame, candidates: DataFrame) -> DataFrame:
    """``candidates`` that no longer phrase of ``found`` replaces."""
    inner = {m: [("in", a, a + n - 1) for n in range(2, m) for a in range(1, m - n + 2)] for m in range(3, LONGEST + 1)}
    covers = _exploded(found.where("size > 2").withColumnRenamed("a", "longer"), inner, ["longer"])
    most = covers.groupBy(*[f"p{k}" for k in range(1, LONGEST + 1)]).agg(F.max("longer").alias("longer"))
    most = most.select(*[F.col(f"p{k}").alias(w) for k, w in enumerate(WORDS, 1)], "longer")
    kept = candidates.join(most, WORDS, "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a"))).drop("longer")


def mined(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs`` (text, lang)."""
    encoded = materialise(shards(docs), "shards")
    counts = encoded.where("number > 0").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    counts = materialise(counts, "word_counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = materialise(numbered(counts.where(F.col("f") >= least)), "vocabulary")
    size, spoken = words.agg(F.max("id"), F.sum("f")).first()
    bits = max(2, int(size or 0).bit_length())
    ids = encoded.where("number > 0").select("shard", "lang", "word", "number")
    ids = ids.join(words.select("lang", "word", "id"), ["lang", "word"]).select("shard", "lang", "number", "id")
    texts = dealt_texts(encoded, materialise(ids, "ids"))

    def counted(occurrences: int, known=None) -> tuple[DataFrame, int]:
        parts = min(bits, max(3, (occurrences // RANGE).bit_length()))
        return materialise_counted(phrases(filters(texts, bits, parts, known), bits, parts, least), "phrases")

    pairs, n = counted(int(spoken or 0))
    known = docs.sparkSession.sparkContext.broadcast(Pairs.of(pairs, n, bits))
    longer, _ = counted(2 * int(pairs.agg(F.sum("a")).first()[0] or 0), known)
    length = F.lit(2) + (F.col("w3") > 0).cast("int") + (F.col("w4") > 0).cast("int")
    found = pairs.unionByName(longer).withColumn("size", length)

    left = standing(found, scored(found, words))
    langs = words.select(F.col("id").alias("w1"), "lang")
    left = lookup_join(left, langs, "w1", "inner", spread_by=F.struct(*WORDS), small=False, hot_rows=1 << 14)
    # a phrase with more than `top` better ones in its share of the language cannot be among the first
    share = Window.partitionBy("lang", "salt").orderBy(F.desc("score"), F.desc("a"))
    salted = left.withColumn("salt", F.pmod(F.xxhash64(*WORDS), F.lit(SALTS))).withColumn("at", F.rank().over(share))
    best = materialise(salted.where(F.col("at") <= top).drop("salt", "at"), "best")
    spelled = best.select("lang", *WORDS, F.posexplode(F.array(*WORDS)).alias("at", "id")).where("id > 0")
    spelled = lookup_join(spelled, words.select("id", "word"), "id", "inner", spread_by=F.struct(*WORDS), small=False, hot_rows=1 << 14)
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    spelled = spelled.groupBy("lang", *WORDS).agg(phrase.alias("phrase"))
    ranked = best.join(spelled, ["lang", *WORDS])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
