"""Quality classifier by co-training of two views.

The text view sees what is written: shares of kinds of characters, lengths and variety of words, hashed words.
The page view sees what is known about the page and its layout: source, language, size, lines and how often
they repeat. Both start from the same labelled documents. In each round a view labels those unlabelled
documents it is sure of, and the other view learns from them; a view never learns from its own guesses. Then
each view is calibrated on labelled documents that it did not learn from, and a line through both calibrated
log odds gives the score of every document.

Fitting uses a bounded sample (``LABELLED`` labelled and ``UNLABELLED`` other documents, chosen by a hash of
their id, the same on every run); scoring covers all documents, in one pass without a shuffle.

Results: null texts are empty and are scored like others; null metadata are values of their own. Of repeated
labels the mean decides, null labels are none. Without labels of both kinds there is nothing to learn: every
document gets the share of good labels (1 without any). Documents at or above ``THRESHOLD`` are accepted.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reqlytics.llm import scan
from reqlytics.llm.common import chosen, free_name, with_columns
from reqlytics.llm.linear import Linear, calibrate, fit, log_odds, logistic

LABELLED = 4000
UNLABELLED = 4000
ROUNDS = 4
#: A pseudo-label needs this probability, and a round takes at most this many of them per kind and view.
CONFIDENT = 0.95
PER_ROUND = 400
THRESHOLD = 0.5
#: Calibrated log odds count up to this when views are combined: no view alone outvotes the other at will.
SURE = 5.0
WORD_BUCKETS, SOURCE_BUCKETS, LANG_BUCKETS = 256, 64, 16

_KINDS = np.zeros(256, np.uint8)  # 0: other
for _kind, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b".,;:'\"()-", b"!?",
     b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(128, 256))), start=1
):
    _KINDS[list(_bytes)] = _kind
N_KINDS = 9
N_TEXT = N_KINDS + 4 + WORD_BUCKETS
N_PAGE = 6 + SOURCE_BUCKETS + LANG_BUCKETS
NOT_LINE_END = np.array([b not in (10, 13) for b in range(256)])


def distinct_share(found: scan.Words) -> np.ndarray:
    """Share of different words (or lines) of each text; 1 for none."""
    n = len(found.counts)
    texts = found.texts
    keys = found.hashes ^ scan.mix(texts.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(keys, return_index=True)
    return np.where(found.counts > 0, np.bincount(texts[first], minlength=n) / np.maximum(found.counts, 1), 1.0)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_features(column: pa.Array) -> np.ndarray:
    out = []
    for found in scan.words(column, scan.ALNUM):
        n = len(found.counts)
        size = np.maximum(np.diff(found.offsets), 1)
        kinds = _KINDS[found.data]
        shares = np.stack([sums(kinds == k, found.offsets) / size for k in range(N_KINDS)], 1)
        count = np.maximum(found.counts, 1)
        length = np.bincount(found.texts, weights=found.ends - found.starts, minlength=n) / count
        place = found.texts * WORD_BUCKETS + (found.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
        words = np.bincount(place, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS) / count[:, None]
        rest = [length / 10, distinct_share(found), np.log1p(found.counts) / 10, found.counts / size]
        out.append(np.concatenate([shares, np.stack(rest, 1), np.sqrt(words)], 1))
    return np.concatenate(out) if out else np.zeros((0, N_TEXT))


def page_features(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    layout = []
    for found in scan.words(text, NOT_LINE_END):
        n = len(found.counts)
        count = np.maximum(found.counts, 1)
        mean = np.bincount(found.texts, weights=found.ends - found.starts, minlength=n) / count
        stop = np.bincount(found.texts, weights=found.data[found.ends - 1] == ord("."), minlength=n) / count
        layout.append(np.stack([np.log1p(found.counts), np.log1p(mean), distinct_share(found), stop], 1))
    size = np.nan_to_num(n_chars.fill_null(0.0).to_numpy(zero_copy_only=False))
    known = np.zeros((len(size), SOURCE_BUCKETS + LANG_BUCKETS))
    for at, (l, s) in enumerate(zip(lang.to_pylist(), source.to_pylist())):
        known[at, zlib.crc32(repr(s).encode()) % SOURCE_BUCKETS] = 1
        known[at, SOURCE_BUCKETS + zlib.crc32(repr(l).encode()) % LANG_BUCKETS] = 1
    lines = np.concatenate(layout) if layout else np.zeros((0, 4))
    return np.concatenate([lines, np.log1p(np.abs(size))[:, None], (size == 0)[:, None], known], 1)


def inputs(docs: DataFrame) -> dict[str, Column | str]:
    """The columns the views read; one that is missing reads as null."""
    def column(name: str, kind: str) -> Column | str:
        if name in docs.columns and docs.schema[name].dataType.simpleString() == kind:
            return name
        return docs[f"`{name}`"].cast(kind) if name in docs.columns else F.lit(None).cast(kind)

    return {
        "text": column("text", "string"),
        "lang": column("lang", "string"),
        "source": column("source", "string"),
        "n_chars": column("n_chars", "double"),
    }


@dataclass
class Model:
    text: Linear
    page: Linear
    text_line: Linear
    page_line: Linear
    both: Linear

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = self.text_line.margin(self.text.margin(text)[:, None])
        b = self.page_line.margin(self.page.margin(page)[:, None])
        both = np.clip(np.stack([a, b], 1), -SURE, SURE)
        return logistic(a), logistic(b), logistic(self.both.margin(both))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels (1, 0, nan: none) and both views' features of a bounded sample."""
    judged = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    judged = judged.where("quality IS NOT NULL")
    some = chosen(judged, "doc_id", LABELLED)
    rest = docs.select("doc_id").where("doc_id IS NOT NULL").join(labels.select("doc_id"), "doc_id", "left_anti")
    rest = chosen(rest.select("doc_id", F.lit(None).cast("double").alias("quality")), "doc_id", UNLABELLED)
    picked = some.union(rest).select(F.col("doc_id").alias("picked_id"), (F.col("quality") >= 0.5).cast("double").alias("picked"))
    name = free_name(docs, "doc_id_of_sample")
    asked = F.broadcast(picked.withColumnRenamed("picked_id", name))  # LABELLED + UNLABELLED rows at most
    rows = docs.join(asked, docs["doc_id"] == asked[name])

    def compute(batch: pa.RecordBatch) -> dict:
        text = text_features(batch.column(0)).astype(np.float32)
        page = page_features(*batch.columns).astype(np.float32)
        return {"views": [r.tobytes() for r in np.concatenate([text, page], 1)]}

    added = T.StructType([T.StructField("views", T.BinaryType())])
    found = with_columns(rows, inputs(rows), [name, "picked"], added, compute).collect()
    found = {r[0]: r for r in sorted(found, key=lambda r: (r[0], r[2]))}  # of repeated documents one
    y = np.array([np.nan if r[1] is None else r[1] for r in found.values()])
    x = np.array([np.frombuffer(r[2], np.float32) for r in found.values()], np.float64).reshape(len(y), N_TEXT + N_PAGE)
    return y, x[:, :N_TEXT], x[:, N_TEXT:]


def co_train(y: np.ndarray, text: np.ndarray, page: np.ndarray, rounds: int = ROUNDS) -> Model:
    known = np.flatnonzero(~np.isnan(y))
    pool = np.flatnonzero(np.isnan(y))
    held = known[::4]  # every fourth, for calibration
    learned = np.setdiff1d(known, held)
    if len(np.unique(y[learned])) < 2 or len(np.unique(y[held])) < 2:
        held = learned = known
    views, models = [text, page], []
    lessons = [(learned, y[learned]), (learned, y[learned])]
    for number in range(rounds + 1):
        models = [fit(v[at], labels) for v, (at, labels) in zip(views, lessons)]
        if number == rounds or not len(pool):
            break
        lines = [calibrate(m.margin(v[held]), y[held]) for m, v in zip(models, views)]
        for me, other in ((0, 1), (1, 0)):
            free = np.setdiff1d(pool, lessons[other][0])
            sure = logistic(lines[me].margin(models[me].margin(views[me][free])[:, None]))
            new, given = [], []
            for label, p in ((1.0, sure), (0.0, 1 - sure)):
                order = np.argsort(-p, kind="stable")[:PER_ROUND]
                order = order[p[order] >= CONFIDENT]
                new.append(free[order])
                given.append(np.full(len(order), label))
            at, labels = lessons[other]
            lessons[other] = np.concatenate([at, *new]), np.concatenate([labels, *given])
    lines = [calibrate(m.margin(v[held]), y[held]) for m, v in zip(models, views)]
    margins = [line.margin(m.margin(v[held])[:, None]) for line, m, v in zip(lines, models, views)]
    return Model(*models, *lines, calibrate(np.clip(np.stack(margins, 1), -SURE, SURE), y[held]))


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or the share of good labels where there is nothing to learn from."""
    y, text, page = sample(docs, labels)
    known = y[~np.isnan(y)]
    if len(np.unique(known)) < 2:
        return float(known.mean()) if len(known) else 1.0
    return co_train(y, text, page)


def score(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` of every document with ``p_text``, ``p_page`` and ``p_good``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def compute(batch: pa.RecordBatch) -> dict:
        if isinstance(model.value, float):
            same = np.full(len(batch), model.value)
            return dict.fromkeys(("p_text", "p_page", "p_good"), pa.array(same))
        text, page = text_features(batch.column(0)), page_features(*batch.columns)
        return {n: pa.array(p) for n, p in zip(("p_text", "p_page", "p_good"), model.value.scores(text, page))}

    added = T.StructType([T.StructField(c, T.DoubleType()) for c in ("p_text", "p_page", "p_good")])
    return with_columns(docs, inputs(docs), docs.columns if keep is None else keep, added, compute)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    names = {c: free_name(docs, f"kept_{c}") if c.lower() in ("p_text", "p_page", "p_good") else c for c in docs.columns}
    plain = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    scored = score(plain, labels)
    return scored.where(F.col("p_good") >= THRESHOLD).select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])
