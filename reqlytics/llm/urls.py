"""URL filter: host and path words from Viterbi segmentation, judged by multinomial naive Bayes.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z as a-z. Path: from there up to
``?``, ``#`` or the end. A rule names a host and the beginning of a path; it fits the host, its subdomains and
the paths that begin so, and the longest that fits decides. Pages that no rule fits get the method's verdict:

1. *Lexicon.* The most frequent words of the pages' texts, at most ``LEXICON`` of them, with their counts.
2. *Segmentation.* Names in hosts and paths are split into the most probable sequence of lexicon words
   (unigram Viterbi; a part that is in no lexicon costs more the longer it is).
3. *Naive Bayes.* The tokens of all pages that a rule judges are counted per verdict, in ``BUCKETS`` hash
   buckets, so the model's size does not depend on the data.

Results: a null url, or one without ``://``, has an empty host and path, no rule, and no tokens: the priors
decide. Equal scores allow; without any judged page all others are allowed. Repeated pages repeat their
result. Rules are compared without letter case in the host only.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reqlytics.llm.common import mapped, materialise, with_columns

LEXICON = 50_000
#: Longest word that is looked for inside a name.
LONGEST = 24
BUCKETS = 1 << 15
SMOOTHING = 1.0
#: The rules (host, beginning of path) and their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        out = F.when(fits(rule, host, path), F.lit(rule)).otherwise(out)
    return out


def lexicon(pages: DataFrame, html: str = "html", most: int = LEXICON) -> dict[str, int]:
    """The most frequent words of the pages' texts, with counts over all pages: all words of some count or
    more, ``most`` at most. That count is found from the number of words of each count."""
    text = F.regexp_replace(F.coalesce(F.col(f"`{html}`"), F.lit("")), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(text), r"[^a-z0-9]+")).alias("word"))
    words = words.where((F.length("word") > 0) & (F.length("word") <= LONGEST))
    counted = materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "lexicon")
    least, total = None, 0
    for row in counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(most).collect():
        if total + row["words"] > most:
            break
        least, total = row["n"], total + row["words"]
    return {r["word"]: r["n"] for r in counted.where(F.col("n") >= least).collect()} if total else {}


class Segmenter:
    """The most probable split of a name into words of a lexicon."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.unknown = math.log(total) + 1
        self.longest = max(map(len, counts), default=1)
        self.memo: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        if name not in self.memo:
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[name] = self._split(name)
        return self.memo[name]

    def _split(self, name: str) -> list[str]:
        best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for start in range(max(0, end - self.longest), end):
                cost = self.cost.get(name[start:end])
                cost = best[start] + (self.unknown + 2 * (end - start) if cost is None else cost)
                if cost < best[end]:
                    best[end], back[end] = cost, start
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]


#: Names longer than this are split piece by piece: the work per letter stays the same for any url.
PIECE = 200


def tokens_of(host: str, path: str, segmenter: Segmenter) -> list[str]:
    out = []
    for mark, text in (("h:", host), ("p:", path)):
        for name in re.findall(r"[a-z0-9]+|[^\x00-\x7f]+", text.lower()):
            if name.isdigit():
                out.append(f"{mark}#")
                continue
            for place in range(0, len(name), PIECE):
                out += [mark + w for w in segmenter.split(name[place : place + PIECE])]
    return out


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def count_tokens(judged: DataFrame, segmenter) -> DataFrame:
    """``verdict``, ``bucket`` (-1: pages) and ``n``, added up within tasks before anything is shuffled."""
    schema = T.StructType(
        [T.StructField("verdict", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())]
    )

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for host, path, verdict in zip(*[c.to_pylist() for c in batch.columns]):
                counts[verdict, -1] += 1
                counts.update((verdict, bucket(t)) for t in tokens_of(host, path, segmenter.value))
        if counts:
            rows = [(v, b, n) for (v, b), n in counts.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64()))], names=schema.names
            )

    return mapped(judged.select("host", "path", "verdict"), run, schema).groupBy("verdict", "bucket").agg(F.sum("n").alias("n"))


def log_odds(rows: list) -> tuple[float, np.ndarray]:
    """Prior and per-bucket log odds of "block"."""
    pages = {v: 0 for v in ("block", "allow")}
    counts = {v: np.zeros(BUCKETS) for v in pages}
    for r in rows:
        if r["bucket"] < 0:
            pages[r["verdict"]] = r["n"]
        else:
            counts[r["verdict"]][r["bucket"]] = r["n"]
    if not pages["block"] or not pages["allow"]:
        # one verdict only: nothing to tell apart
        return (1.0 if pages["block"] else -1.0), np.zeros(BUCKETS)
    used = max(1, int(((counts["block"] + counts["allow"]) > 0).sum()))
    share = {v: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * used)) for v, c in counts.items()}
    return math.log(pages["block"] / pages["allow"]), share["block"] - share["allow"]


def judge(
    pages: DataFrame, rules: dict[str, str] = RULES, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``odds`` (of block) and ``words`` (segmented)."""
    spark = pages.sparkSession
    parts = pages.select(
        pages[f"`{page_id}`"].alias("page_id"),
        host_of(pages[f"`{url}`"]).alias("host"),
        path_of(pages[f"`{url}`"]).alias("path"),
    )
    parts = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, said in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(said)).otherwise(verdict)
    parts = parts.withColumn("verdict", verdict)
    segmenter = spark.sparkContext.broadcast(Segmenter(lexicon(pages, html)))  # LEXICON words at most
    counts = count_tokens(parts.where("verdict IS NOT NULL"), segmenter)
    model = spark.sparkContext.broadcast(log_odds(counts.collect()))  # 2 * (BUCKETS + 1) rows at most

    def compute(batch: pa.RecordBatch) -> dict:
        prior, odds = model.value
        scores, said = [], []
        for host, path in zip(*[c.to_pylist() for c in batch.columns]):
            found = tokens_of(host, path, segmenter.value)
            scores.append(prior + float(sum(odds[bucket(t)] for t in found)))
            said.append(" ".join(t[2:] for t in found if t.startswith("h:")))
        return {"odds": scores, "words": said}

    added = T.StructType([T.StructField("odds", T.DoubleType()), T.StructField("words", T.StringType())])
    inputs = {"host": parts["host"], "path": parts["path"]}
    scored = with_columns(parts, inputs, parts.columns, added, compute)
    own = F.when(F.col("odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("verdict", own))
