"""Language model scoring with a hashed maximum-entropy model and a class-factored softmax.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z as a-z, then one end. A token's probability has
three factors: its class given the context, its member given class and context, and the token given its class
and member.

* A word's class comes from its last letters, its member from its hash; the end has a class of its own.
* Class and member are softmax choices over sums of weights. The features are hashed: the word before
  (n-gram), the word before that (skip), and both together.
* The third factor is the token's smoothed share among the training tokens of its class and member,
  (c + 1) / (N_b + V_b + 1), with counts of all training tokens.

Training is distributed: every shard of documents makes gradient updates on its own copy of the weights, each
weight row moves by its own step size, and the shards' rows are averaged by how often a row was used. Scoring
works on slices of a few thousand tokens as arrays.

Counts are a table that grows with the corpus: it is never collected. The ``HEAD`` most frequent words are
broadcast (a bound, whatever the corpus), and the counts of all rarer words are joined, word by word.

Documents whose crc32(doc_id as text) mod 7 is 2 are held out of counts and training. Results: a null text is
empty and has its end only; a null doc_id counts as the text ""; repeated rows are scored each; with nothing
to train on all counts are 0 and all classes are equally likely. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reqlytics.llm import scan
from reqlytics.llm.common import mapped, materialise

CLASSES, MEMBERS = 32, 32
BUCKETS = CLASSES * MEMBERS
#: Rows of weights: one kind of feature after the other, and one row that is always on.
BEFORE, SKIP, BOTH, MEMBER_BEFORE = 2048, 2048, 4096, 512
CLASS_ROWS, MEMBER_ROWS = BEFORE + SKIP + BOTH + 1, MEMBER_BEFORE + 1
#: Words whose counts are broadcast at most.
HEAD = 1 << 18
#: Training tokens of a shard, about; tokens of one gradient update.
SHARD_TOKENS, BATCH = 4_000_000, 8192
RATE = 0.5
END, START = scan.mixed(101), scan.mixed(102)
BLOCK_ROWS = 64

_PAIRS = np.arange(65536, dtype=np.uint64)
_CLASS_OF = (scan.mix(_PAIRS + np.uint64(7)) % np.uint64(CLASSES - 1)).astype(np.int64) + 1
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


class Tokens:
    """Tokens of a slice of texts in order, each text's end included."""

    def __init__(self, found: scan.Words):
        n_texts = len(found.counts)
        self.firsts = found.firsts + np.arange(n_texts + 1)
        n = int(self.firsts[-1])
        ends = self.firsts[1:] - 1
        word = np.ones(n, bool)
        word[ends] = False
        self.hashes = np.full(n, END, np.uint64)
        self.hashes[word] = found.hashes
        self.bucket = np.zeros(n, np.int64)
        last = _LOWER[found.data[found.ends - 1]] if len(found.ends) else np.zeros(0, np.int64)
        previous = found.ends - 2
        second = np.where(previous >= found.starts, _LOWER[found.data[np.maximum(previous, 0)]], 0) if len(last) else last
        member = (found.hashes >> np.uint64(40)) % np.uint64(MEMBERS)
        self.bucket[word] = _CLASS_OF[last * 256 + second] * MEMBERS + member.astype(np.int64)
        self.texts = np.repeat(np.arange(n_texts), np.diff(self.firsts))
        before = np.empty(n, np.uint64)
        before[1:] = self.hashes[:-1]
        before[self.firsts[:-1]] = START
        skip = np.empty(n, np.uint64)
        skip[2:] = self.hashes[:-2]
        skip[self.firsts[:-1]] = START
        later = self.firsts[:-1] + 1
        skip[later[later < self.firsts[1:]]] = START
        a = (before >> np.uint64(8)) % np.uint64(BEFORE)
        b = (skip >> np.uint64(20)) % np.uint64(SKIP)
        both = scan.mix(before ^ (skip * np.uint64(3))) % np.uint64(BOTH)
        self.rows = np.stack(
            [a.astype(np.int64), b.astype(np.int64) + BEFORE, both.astype(np.int64) + BEFORE + SKIP,
             np.full(n, CLASS_ROWS - 1)]
        )
        self.member_row = (before >> np.uint64(8)).astype(np.int64) % MEMBER_BEFORE

    def __len__(self) -> int:
        return len(self.hashes)


def token_slices(column: pa.Array) -> Iterator[tuple[int, Tokens]]:
    for found in scan.words(column, scan.SOLID):
        yield found.first, Tokens(found)


class Weights:
    """Class weights (row, class) and member weights (row, class, member)."""

    def __init__(self, classes: np.ndarray | None = None, members: np.ndarray | None = None):
        self.classes = np.zeros((CLASS_ROWS, CLASSES), np.float32) if classes is None else classes
        self.members = np.zeros((MEMBER_ROWS, CLASSES, MEMBERS), np.float32) if members is None else members

    @staticmethod
    def of_shares(sizes: np.ndarray) -> Weights:
        """Weights that give every class and member its share of the counts, whatever the context: the start."""
        out, table = Weights(), sizes.reshape(CLASSES, MEMBERS)
        out.classes[-1] = np.log(table.sum(1) / table.sum())
        out.members[-1] = np.log(table / table.sum(1, keepdims=True))
        return out

    def choices(self, tokens: Tokens, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class and member of tokens a..b, and the probabilities of all classes, and members of that class."""
        rows = tokens.rows[:, a:b]
        z = self.classes[rows[0]]
        for r in rows[1:-1]:
            z += self.classes[r]
        z += self.classes[CLASS_ROWS - 1]
        cls, member = np.divmod(tokens.bucket[a:b], MEMBERS)
        y = self.members[tokens.member_row[a:b], cls]
        y += self.members[MEMBER_ROWS - 1, cls]
        return cls, member, softmax(z), softmax(y)

    def log_probabilities(self, tokens: Tokens, a: int, b: int) -> np.ndarray:
        """log10 of the first two factors; the end has no member to choose."""
        cls, member, p, q = self.choices(tokens, a, b)
        at = np.arange(b - a)
        chosen = np.log10(np.maximum(p[at, cls], 1e-30).astype(np.float64))
        inner = np.log10(np.maximum(q[at, member], 1e-30).astype(np.float64))
        return chosen + np.where(cls > 0, inner, 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    np.clip(z, -60, 60, out=z)  # weights stay far below; no exponential can overflow
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], np.float32))[:, None]
    return z


class Trainer:
    """Gradient updates on one shard, with a step size for each row of weights."""

    def __init__(self, weights: Weights, rate: float = RATE):
        self.w, self.rate = Weights(weights.classes.copy(), weights.members.copy()), rate
        self.class_power = np.full(CLASS_ROWS, 1e-6, np.float32)
        self.member_power = np.full((MEMBER_ROWS, CLASSES), 1e-6, np.float32)
        self.class_used = np.zeros(CLASS_ROWS)
        self.member_used = np.zeros((MEMBER_ROWS, CLASSES))

    def learn(self, tokens: Tokens) -> None:
        for a in range(0, len(tokens), BATCH):
            b = min(a + BATCH, len(tokens))
            cls, member, p, q = self.w.choices(tokens, a, b)
            at = np.arange(b - a)
            p[at, cls] -= 1
            q[at, member] -= 1
            for rows in tokens.rows[:-1, a:b]:
                self._step(self.w.classes, self.class_power, self.class_used, rows, p)
            always = np.array([CLASS_ROWS - 1]), np.zeros(1, np.int64), np.array([b - a])
            self._move(self.w.classes, self.class_power, self.class_used, *always, p)
            q[cls == 0] = 0  # the end has no member to learn
            members = self.w.members.reshape(-1, MEMBERS)
            power, used = self.member_power.reshape(-1), self.member_used.reshape(-1)
            for rows in (tokens.member_row[a:b], MEMBER_ROWS - 1):
                self._step(members, power, used, rows * CLASSES + cls, q)

    def _step(self, weights: np.ndarray, power: np.ndarray, used: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        """Move the rows by the gradients of their tokens."""
        order = np.argsort(rows.astype(np.int16), kind="stable")  # all row numbers are below 2^15: a radix sort
        rows = rows[order]
        firsts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        counts = np.diff(np.append(firsts, len(rows)))
        self._move(weights, power, used, rows[firsts], firsts, counts, gradient[order])

    def _move(self, weights, power, used, at, firsts, counts, gradient) -> None:
        step = np.add.reduceat(gradient, firsts, axis=0)
        step /= np.sqrt(counts)[:, None].astype(np.float32)
        power[at] += np.einsum("ij,ij->i", step, step) / np.float32(weights.shape[1])
        used[at] += counts
        step *= (self.rate / np.sqrt(power[at] * weights.shape[1]))[:, None]
        weights[at] -= step

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """Used rows, multiplied by their use, and the uses, in numbered blocks."""
        for number, used, values in flat_blocks(
            self.class_used, self.w.classes, self.member_used.reshape(-1), self.w.members.reshape(-1, MEMBERS)
        ):
            if used.any():
                yield number, np.concatenate([used[:, None], values * used[:, None]], 1).astype(np.float32).tobytes()


def flat_blocks(class_used, classes, member_used, members) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    number = 0
    for used, values in ((class_used, classes), (member_used, members)):
        for a in range(0, len(used), BLOCK_ROWS):
            yield number, used[a : a + BLOCK_ROWS], values[a : a + BLOCK_ROWS]
            number += 1


def merged(start: Weights, sums: dict[int, bytes]) -> Weights:
    """Weights whose used rows are the mean over shards."""
    out = Weights(start.classes.copy(), start.members.copy())
    blank = flat_blocks(
        np.zeros(CLASS_ROWS), out.classes, np.zeros(MEMBER_ROWS * CLASSES), out.members.reshape(-1, MEMBERS)
    )
    for number, _, values in blank:
        if number in sums:
            got = np.frombuffer(sums[number], np.float32).reshape(len(values), -1)
            used = got[:, 0] > 0
            values[used] = got[used, 1:] / got[used, :1]
    return out


def train_round(docs: DataFrame, text: str, start: Weights, shards: int) -> Weights:
    """One pass over the training documents: updates within shards, then the mean of the shards."""
    sent = docs.sparkSession.sparkContext.broadcast(start)
    one = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("part", T.BinaryType())])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = Trainer(sent.value), False
        for batch in batches:
            for _, tokens in token_slices(batch.column(0)):
                trainer.learn(tokens)
                seen = True
        shard = TaskContext.get().partitionId()
        for number, part in trainer.blocks() if seen else ():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([shard], pa.int32()), pa.array([part], pa.binary())], names=one.names
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(part, np.float32).astype(np.float64)
                sums[number] = sums[number] + values if number in sums else values
        if sums:
            parts = [s.astype(np.float32).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())], names=["block", "part"])

    rows = mapped(docs.select(docs[f"`{text}`"]).coalesce(shards), learn, one)
    dealt = rows.repartition("block").sortWithinPartitions("block", "shard").select("block", "part")
    sums = mapped(dealt, add, T.StructType([one["block"], one["part"]])).collect()  # the model's size at most
    sent.unpersist()
    return merged(start, {r["block"]: bytes(r["part"]) for r in sums})


def count_tokens(docs: DataFrame, text: str) -> DataFrame:
    """``word`` (hash), ``bucket`` and ``n`` of all tokens, added up within tasks before the shuffle."""
    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list) -> pa.RecordBatch:
            words, buckets, counts = (np.concatenate(x) for x in zip(*held))
            keys, first, place = np.unique(words, return_index=True, return_inverse=True)
            total = np.bincount(place, weights=counts).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(buckets[first].astype(np.int32)), pa.array(total)], names=schema.names
            )

        held, size = [], 0
        for batch in batches:
            for _, tokens in token_slices(batch.column(0)):
                keys, first, counts = np.unique(tokens.hashes, return_index=True, return_counts=True)
                held.append((keys, tokens.bucket[first], counts))
                size += len(keys)
                if size > 1 << 21:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    found = mapped(docs.select(docs[f"`{text}`"]), run, schema)
    return found.groupBy("word").agg(F.first("bucket").alias("bucket"), F.sum("n").alias("n"))


def head_of(counts: DataFrame, most: int = HEAD) -> tuple[int, np.ndarray, np.ndarray]:
    """The least count of the head, and its words and counts: all words of that count or more, ``most`` at
    most. Found from the number of words of each count."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(most).collect()
    least, total = None, 0
    for row in sizes:
        if total + row["words"] > most:
            break
        least, total = row["n"], total + row["words"]
    if least is None:
        return 1 << 62, np.zeros(0, np.uint64), np.zeros(0)
    rows = counts.where(F.col("n") >= least).select("word", "n").toArrow()
    words = rows.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return least, words[order], rows.column("n").to_numpy()[order]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = 1) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    docs = docs.select(
        docs[f"`{doc_id}`"].alias("doc_id"), held_out(docs[f"`{doc_id}`"]).alias("held_out"), docs[f"`{text}`"].alias("text")
    )
    training = docs.where(~F.col("held_out"))
    counts = materialise(count_tokens(training, "text"), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    inside = np.ones(BUCKETS)
    for r in counts.groupBy("bucket").agg((F.sum("n") + F.count(F.lit(1)) + 1).alias("size")).collect():
        inside[r["bucket"]] = r["size"]
    weights = Weights.of_shares(inside)
    for _ in range(rounds if total["n"] else 0):
        weights = train_round(training, "text", weights, max(1, math.ceil(total["n"] / SHARD_TOKENS)))
    least, words, numbers = head_of(counts)
    model = spark.sparkContext.broadcast((weights, np.log10(inside), words, np.log10(numbers + 1)))
    rows = scored_rows(docs, model)
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("t"))
    tail = tail.select("row", F.col("t.words").alias("word"), F.col("t.times").alias("times"))
    rare = counts.where(F.col("n") < least).select("word", "n")
    found = tail.join(rare, "word").groupBy("row").agg(
        F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("tail_log")
    )
    whole = rows.drop("words", "times").join(found, "row", "left")
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(total["n"] + total["v"] + 1)).alias("base_score"),
        (logs + F.col("model_log")).alias("score"),
    )


def scored_rows(docs: DataFrame, model) -> DataFrame:
    """What a task can tell by itself: the model's part, and counts of frequent words; rarer words are listed."""
    schema = T.StructType(
        [docs.schema["doc_id"], docs.schema["held_out"]]
        + [T.StructField("n_tokens", T.LongType()), T.StructField("head_known", T.LongType())]
        + [T.StructField("head_log", T.DoubleType()), T.StructField("model_log", T.DoubleType())]
        + [T.StructField("words", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, inside, words, logs = model.value
        head = scan.HashSet(words)
        for batch in batches:
            for first, tokens in token_slices(batch.column(2)):
                n = len(tokens.firsts) - 1
                own = np.empty(len(tokens))
                for a in range(0, len(tokens), BATCH):
                    b = min(a + BATCH, len(tokens))
                    own[a:b] = weights.log_probabilities(tokens, a, b) - inside[tokens.bucket[a:b]]
                places, at = head.find(tokens.hashes)
                texts = tokens.texts
                rest = np.ones(len(tokens), bool)
                rest[places] = False
                # rarer words, each once per text
                order = np.lexsort((tokens.hashes[rest], texts[rest]))
                word, text = tokens.hashes[rest][order], texts[rest][order]
                new = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (text[1:] != text[:-1])])) if len(word) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(word)))
                offsets = pa.array(np.searchsorted(text[new], np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(1).slice(first, n),
                        pa.array(np.diff(tokens.firsts)),
                        pa.array(np.bincount(texts[places], minlength=n)),
                        pa.array(np.bincount(texts[places], weights=logs[at], minlength=n).astype(np.float64)),
                        pa.array(np.bincount(texts, weights=own, minlength=n)),
                        pa.ListArray.from_arrays(offsets, pa.array(word[new].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    names=schema.names,
                )

    return mapped(docs.select("doc_id", "held_out", "text"), run, schema)
