"""Benchmark decontamination: windows of benchmark words, looked up in whole documents.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z. A window is ten consecutive
words of a benchmark item; an item of fewer words, but not none, is one window. The hashes of a block of
windows go to every task as a set; a task hashes all windows of its documents, looks them up, and compares
the words of each hit, so a chance match of hashes is no hit.

The benchmark is cut into blocks of bounded size by a hash of the item. One block (the usual case) is one
pass over the documents. Further blocks are further passes, each adding its hits to those so far, so no
size of benchmark is out of reach and no task ever holds more than one block.

Results: null and empty texts have no words, no hits and are clean. Repeated items count as one id; a null
id counts as the text ``null``. Repeated documents give repeated results. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reqlytics.llm import scan
from reqlytics.llm.common import free_name, materialise, with_columns, with_replaced

WINDOW = 10
#: Text of benchmark items in one block, at most (but for one item that alone is longer).
BLOCK_BYTES = 16 << 20
#: Bytes of a hit's span and item list between two passes are kept in these columns.
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class Windows:
    """Windows of a block of items: their hashes by length, and the items that hold each."""

    def __init__(self, ids: list, texts: list[str | None], length: int = WINDOW):
        self.names = ["null" if i is None else str(i) for i in ids]
        self.items: dict[bytes, list[int]] = {}  # words of a window, joined
        hashes: dict[int, list[np.ndarray]] = {}
        for item, text in enumerate(texts):
            found = whole(text or "")
            n = len(found.hashes)
            size = min(length, n)
            if not n:
                continue
            hashes.setdefault(size, []).append(scan.runs(found.hashes, size))
            for place in range(n - size + 1):
                own = self.items.setdefault(joined(found, place, size), [])
                if not own or own[-1] != item:
                    own.append(item)
        self.by_size = {size: scan.HashSet(np.concatenate(parts)) for size, parts in hashes.items()}


def whole(text: str) -> scan.Words:
    return next(scan.words(pa.array([text]), scan.ALNUM, 1 << 62))


def joined(found: scan.Words, place: int, size: int) -> bytes:
    """The words of a window with one space between."""
    held, s, e = found.data, found.starts[place : place + size], found.ends[place : place + size]
    return b" ".join([held[a:b].tobytes().lower() for a, b in zip(s.tolist(), e.tolist())])


def hits(found: scan.Words, windows: Windows) -> tuple[np.ndarray, list[set[int]]]:
    """Which words of a slice lie in a window, and the items seen in each text."""
    covered = np.zeros(len(found.hashes) + 1, np.int64)
    seen: list[set[int]] = [set() for _ in found.counts]
    if not len(found.hashes):
        return covered[:-1] > 0, seen
    firsts = found.firsts
    texts = found.texts
    for size, keys in windows.by_size.items():
        places, _ = keys.find(scan.runs(found.hashes, size))
        for place in places[places + size <= firsts[texts[places] + 1]].tolist():
            items = windows.items.get(joined(found, place, size))
            if items is not None:
                covered[place] += 1
                covered[place + size] -= 1
                seen[texts[place]].update(items)
    return np.cumsum(covered[:-1]) > 0, seen


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in parts of bounded size: a share of the hashes of its items each."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(64)), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.where(part == k) for k in range(n)] if n > 1 else [items]


def scan_documents(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    length: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``n_words``, ``n_hit``, ``item_ids`` and, as word ranges, ``spans``.

    ``items`` has item_id and text. Each block of items is one pass; a pass adds to the spans so far.
    """
    spark = docs.sparkSession
    wanted = docs.columns if keep is None else keep
    parts = blocks(items.select("item_id", "text"), block_bytes)
    renamed = {c: free_name(docs, f"kept_{c}") for c in wanted}
    state = docs.select(
        *[docs[f"`{c}`"].alias(n) for c, n in renamed.items()],
        docs[f"`{text}`"].alias("scanned"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    for k, part in enumerate(parts):
        rows = part.collect()  # one block: bounded by block_bytes
        windows = spark.sparkContext.broadcast(Windows([r[0] for r in rows], [r[1] for r in rows], length))
        state = _one_pass(state, windows, list(renamed.values()), with_text=k + 1 < len(parts))
        if k + 1 < len(parts):  # a written table between passes; the block then leaves the executors
            state = materialise(state, "decontaminate")
            windows.unpersist()
    return state.select(
        *[F.col(n).alias(c) for c, n in renamed.items()],
        "n_words",
        "n_hit",
        F.array_sort("item_ids").alias("item_ids"),
        "spans",
    )


def _one_pass(state: DataFrame, windows, keep: list[str], with_text: bool) -> DataFrame:
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("spans", SPANS),
    ]

    def compute(batch: pa.RecordBatch) -> dict:
        known_spans, known_items = batch.column(1), batch.column(2)
        n_words, n_hit, item_ids, spans = [], [], [], []
        names = windows.value.names
        for found in scan.words(batch.column(0), scan.ALNUM):
            covered, seen = hits(found, windows.value)
            firsts = found.firsts.tolist()
            touched = np.add.reduceat(np.append(covered, False), firsts[:-1]) if len(firsts) > 1 else []
            for i, (a, b) in enumerate(zip(firsts, firsts[1:])):
                n_words.append(b - a)
                old = known_spans[found.first + i].as_py()
                if a == b or (not touched[i] and not old):
                    n_hit.append(0)
                    item_ids.append([])
                    spans.append([])
                    continue
                mask = covered[a:b].copy()
                for s in old:
                    mask[s["start"] : s["end"]] = True
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()
                spans.append([{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2])])
                n_hit.append(int(mask.sum()))
                item_ids.append(sorted({names[j] for j in seen[i]} | set(known_items[found.first + i].as_py())))
        return {"n_words": n_words, "n_hit": n_hit, "item_ids": item_ids, "spans": spans}

    return with_columns(
        state,
        {c: c for c in ("scanned", "spans", "item_ids")},
        [*keep, "scanned"] if with_text else keep,
        T.StructType(added),
        compute,
    )


def cut(found: scan.Words, spans: list[tuple[int, int]]) -> str:
    """The text of a slice without these ranges of words and what stands between their words."""
    held, out, place = found.data, [], 0
    for a, b in spans:
        out.append(held[place : found.starts[a]].tobytes())
        place = int(found.ends[b - 1])
    out.append(held[place:].tobytes())
    return b" ".join(out).decode()


def without_spans(text: str, windows: Windows) -> str:
    """The text without the words of any window and what stands between them; looked through again until
    nothing is found, since words that come to stand side by side could make a window."""
    while True:
        found = whole(text)
        covered, _ = hits(found, windows)
        if not covered.any():
            return text
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))).tolist()
        text = cut(found, list(zip(edges[::2], edges[1::2])))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the hit words of ``text`` removed; a hit document that has no word left goes.

    All columns stay; other texts stay as they are, nulls and texts without words included. With several
    blocks, the hits of all are found in the same text before anything is cut, so the result is that of one block.
    """
    parts = blocks(items.select("item_id", "text"), block_bytes)
    if len(parts) > 1:
        return _clean_rounds(docs, items, text, block_bytes)
    rows = parts[0].collect()  # one block: bounded by block_bytes
    windows = docs.sparkSession.sparkContext.broadcast(Windows([r[0] for r in rows], [r[1] for r in rows]))
    return _clean_pass(docs, windows, text)


def _clean_rounds(docs: DataFrame, items: DataFrame, text: str, block_bytes: int) -> DataFrame:
    """Rounds over all blocks; a round goes on with the texts that the one before has cut."""
    names = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    own = names[text]
    others = [n for n in names.values() if n != own]
    added = T.StructType([T.StructField("new", docs.schema[text].dataType), T.StructField("gone", T.BooleanType())])

    def compute(batch: pa.RecordBatch) -> dict:
        given = []
        for value, spans in zip(batch.column(0), batch.column(1).to_pylist()):
            given.append(cut(whole(value.as_py()), [(s["start"], s["end"]) for s in spans]))
        return {"new": given, "gone": [not len(scan.word_hashes(t.encode(), scan.ALNUM)) for t in given]}

    left = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    out = None
    while True:
        found = scan_documents(left, items, own, block_bytes=block_bytes).select(*names.values(), "spans")
        found = materialise(found, "decontaminate")
        done = found.where(F.size("spans") == 0).drop("spans")
        out = done if out is None else out.unionByName(done)
        hit = found.where(F.size("spans") > 0)
        if not hit.limit(1).count():
            return out.select(*[F.col(n).alias(c) for c, n in names.items()])
        made = with_columns(hit, {"value": own, "spans": "spans"}, others, added, compute).where("NOT gone")
        left = made.select(*[F.col("new" if n == own else n).alias(n) for n in names.values()])


def _clean_pass(docs: DataFrame, windows, text: str) -> DataFrame:
    gone = free_name(docs, "gone")

    def compute(batch: pa.RecordBatch) -> dict:
        column = batch.column(0)
        texts: dict[int, str] = {}
        for found in scan.words(column, scan.ALNUM):
            covered, _ = hits(found, windows.value)
            for i in np.unique(found.texts[covered]).tolist():
                texts[found.first + i] = without_spans(column[found.first + i].as_py(), windows.value)
        if not texts:
            return {"new": column, gone: [False] * len(column)}
        given = [texts.get(i, v.as_py() if i not in texts else None) for i, v in enumerate(column)]
        empty = [i in texts and not len(scan.word_hashes(texts[i].encode(), scan.ALNUM)) for i in range(len(column))]
        return {"new": pa.array(given, pa.string()), gone: empty}

    made = with_replaced(docs, text, compute, T.StructType([T.StructField(gone, T.BooleanType())]))
    return made.where(~F.col(gone)).drop(gone)


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan_documents(docs, items, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
