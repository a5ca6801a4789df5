"""How far the sources of a language differ in what they say: exact sums over all kept terms, by a term-row tree.

Terms are runs of letters and of all beyond ASCII, A-Z as a-z. A language keeps the V terms that stand in at least
``least`` of its rows. A source gives each kept term the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)),
N being its number of kept terms with repeats; z is the share of a term that the source does not have.

1. *Counts.* Tasks count terms per (lang, source) and send each once per portion of texts; Spark adds them up.
2. *Term rows.* A kept term is one row: its sources with a nonzero count, in a fixed order, each with p and z.
   Equal rows become one with a multiplicity. Sources of few words come first: their counts are small and often
   alike, so rows share long beginnings.
3. *Tree.* Rows, sorted and dealt out by range, are inserted into a frequent-pattern tree per task. A node is an
   item (source, p) after a path; its multiplicity is that of all rows through it. Where two sources both
   have a term, their difference is the sum of the one-sided ones and a correction that hangs on the
   two items alone, so each node adds it once per ancestor, times its multiplicity.
4. *Sums.* |p - q| over all kept terms of sources s, t is V |z_s - z_t|, and what s changes against z_t, and what t
   changes against z_s (both from the counted distinct p of a source), and the corrections.

Only sums per pair of sources leave a tree. A row holds at most one item per source; nothing is broadcast or collected.

Results (:func:`audit`): ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Nulls in text, lang and source
are ''. Very long texts are cut into terms whole, one text at a time. Repeated rows count as often as they stand.
Equal values are ranked by the item's UTF-8 bytes. A source without terms has shares of z alone; a language without
kept terms gives value 0 for its pairs and no term rows. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from reqlytics.llm.common import mapped, materialise

LEAST_ROWS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
#: Distinct (lang, source, term) that a task counts before it sends them on.
COUNTED_AT_ONCE = 1 << 18
#: Pair sums that a tree holds before it sends them on.
SUMS_AT_ONCE = 1 << 18

#: Fixed value: letters and all beyond ASCII stay, A-Z become a-z, every other byte parts terms.
_LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``rows`` that hold it, of every text in full."""
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in ("lang", "source", "term")]
        + [T.StructField(c, T.LongType()) for c in ("n", "rows")]
    )

    def told(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (found, holders) in groups.items():
            size = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(list(found), pa.binary()).cast(pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                    pa.array(list(holders.values()), pa.int64()),
                ],
                names=schema.names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                found, holders = groups.setdefault((lang, source), (Counter(), Counter()))
                words = text.as_py().translate(_LETTERS).split()
                held -= len(found)
                found.update(words)
                holders.update(dict.fromkeys(words).keys())  # in order, so that both counters have their terms in one order
                held += len(found)
                if held >= COUNTED_AT_ONCE:
                    yield from told(groups)
                    groups, held = {}, 0
        yield from told(groups)

    plain = [F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    # by term alone, so that the sources of a term meet without a second shuffle; adding up in the task before it costs more
    # than the third of the rows that it saves
    counted = mapped(docs.select(*plain), run, schema).repartition("lang", "term")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), exact beyond 64 bits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (F.col(n) if isinstance(n, str) else n).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above + F.lit(5 * SCALE), (F.col(total) + 5 * F.col(terms)).cast("decimal(20,0)"))


class Tree:
    """A frequent-pattern tree fed with sorted rows: only the path of the latest row is held.

    A node is left when a row takes another turn; its multiplicity is complete then.
    """

    def __init__(self) -> None:
        self.places: list[int] = []
        self.shares: list[int] = []
        self.zeros: list[int] = []
        self.times: list[int] = []
        self.sums: dict[tuple[int, int], int] = {}
        self.nodes = 0

    def insert(self, items: list[tuple[int, int, int]], times: int) -> None:
        """Items (place of the source, p, z) in order of place."""
        depth = 0
        while depth < min(len(items), len(self.places)) and items[depth][:2] == (self.places[depth], self.shares[depth]):
            depth += 1
        self.leave(depth)
        for place, p, z in items[depth:]:
            self.places.append(place)
            self.shares.append(p)
            self.zeros.append(z)
            self.times.append(0)
        if items:
            self.times[-1] += times

    def leave(self, depth: int) -> None:
        """Leave all nodes below ``depth``, the lowest first: each adds its corrections once per ancestor."""
        if len(self.places) <= depth:
            return
        p, z = np.array(self.shares, np.int64), np.array(self.zeros, np.int64)
        for at in range(len(self.places) - 1, depth - 1, -1):
            times, place = self.times.pop(), self.places.pop()
            if at:
                self.times[at - 1] += times
                above, mine = slice(0, at), slice(at, at + 1)
                corrections = (
                    np.abs(p[above] - p[mine]) - np.abs(p[above] - z[mine]) - np.abs(z[above] - p[mine]) + np.abs(z[above] - z[mine])
                )
                for other, more in zip(self.places, corrections.tolist()):
                    if more:
                        self.sums[other, place] = self.sums.get((other, place), 0) + times * more
            self.nodes += 1
        del self.shares[depth:], self.zeros[depth:]


def pair_corrections(rows: DataFrame) -> DataFrame:
    """``lang``, ``a`` < ``b`` (places of sources) and the ``more`` that terms of both add; from sorted term rows."""
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
         T.StructField("more", T.LongType())]
    )

    def told(lang: str, tree: Tree) -> pa.RecordBatch:
        pairs = list(tree.sums)
        made = [
            pa.array([lang] * len(pairs), pa.string()),
            pa.array([a for a, _ in pairs], pa.int32()),
            pa.array([b for _, b in pairs], pa.int32()),
            pa.array(list(tree.sums.values()), pa.int64()),
        ]
        tree.sums = {}
        return pa.RecordBatch.from_arrays(made, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, tree = None, Tree()
        for batch in batches:
            for said, items, times in zip(*[c.to_pylist() for c in batch.columns]):
                if said != lang:
                    tree.leave(0)
                    yield told(lang, tree)
                    lang, tree = said, Tree()
                tree.insert([(i["place"], i["p"], i["z"]) for i in items], times)
                if len(tree.sums) >= SUMS_AT_ONCE:
                    yield told(lang, tree)
        tree.leave(0)
        yield told(lang, tree)

    several = rows.where(F.size("items") > 1).groupBy("lang", "items").agg(F.count(F.lit(1)).alias("times"))
    dealt = several.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    made = mapped(dealt.select("lang", "items", "times"), run, schema)
    return made.where("lang IS NOT NULL").groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))


def audit(docs: DataFrame, least: int = LEAST_ROWS, top: int = TOP_TERMS) -> DataFrame:
    """``docs`` (text, lang, source): part ``pair`` ranks the other sources of the language by distance, part
    ``term`` the ``top`` terms that a source says more often than its language."""
    counts = term_counts(docs)
    named = [F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    groups = docs.select(*named).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")).drop("rows")

    # one row per kept term: how often each source says it
    terms = counts.groupBy("lang", "term").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("all_n"), F.collect_list(F.struct("source", "n")).alias("said")
    )
    terms = materialise(terms.where(F.col("rows") >= least).drop("rows"), "terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("lang_total"))
    spoken = terms.select("lang", "term", "all_n", F.explode("said").alias("s")).select("lang", "term", "all_n", "s.*")
    totals = spoken.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    by_size = Window.partitionBy("lang").orderBy("total", "source")
    zero = F.when(F.col("terms") > 0, share(F.lit(0), "total", "terms")).otherwise(F.lit(0))
    groups = materialise(groups.withColumn("z", zero).withColumn("place", F.row_number().over(by_size)), "groups")

    known = groups.select("lang", "source", "place", "total", "terms", "lang_total", "z")
    shares = spoken.join(known, ["lang", "source"]).withColumn("p", share("n", "total", "terms"))
    shares = materialise(shares.withColumn("q", share("all_n", "lang_total", "terms")), "shares")

    items = F.array_sort(F.collect_list(F.struct("place", "p", "z")))
    rows = shares.groupBy("lang", "term").agg(items.alias("items")).select("lang", "items")
    corrections = materialise(pair_corrections(rows), "corrections")

    # what a source's own terms change against the others' z, from its distinct shares
    distinct = shares.groupBy("lang", "place", "p").agg(F.count(F.lit(1)).alias("times"))
    distinct = distinct.groupBy("lang", "place").agg(F.collect_list(F.struct("p", "times")).alias("shares"))
    sides = groups.join(distinct, ["lang", "place"], "left").select("lang", "source", "place", "terms", "z", "shares")
    left = sides.select("lang", "source", F.col("place").alias("a"), "terms", F.col("z").alias("za"), "shares")
    right = sides.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("z").alias("zb"))
    apart = F.abs(F.col("za") - F.col("zb"))
    own = F.aggregate(
        F.coalesce("shares", F.array().cast(left.schema["shares"].dataType)),
        F.lit(0).cast("long"),
        lambda sum_, x: sum_ + x["times"] * (F.abs(x["p"] - F.col("zb")) - apart),
    )
    sided = left.join(right, "lang").where("a <> b").select("lang", "source", "item", "a", "b", "terms", apart.alias("apart"), own.alias("own"))
    first, second = F.least("a", "b"), F.greatest("a", "b")
    halves = sided.groupBy("lang", first.alias("a"), second.alias("b")).agg(
        F.max("terms").alias("terms"), F.max("apart").alias("apart"), F.sum("own").alias("own"),
        F.collect_list(F.struct("source", "item")).alias("names"),
    )
    whole = halves.join(corrections, ["lang", "a", "b"], "left")
    value = F.col("terms") * F.col("apart") + F.col("own") + F.coalesce("more", F.lit(0))
    pairs = whole.select("lang", value.cast("long").alias("value"), F.explode("names").alias("n"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "n.source", F.lit("pair").alias("part"), "n.item", "value").withColumn("rank", F.row_number().over(best))

    above = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    above = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.unionByName(above)
