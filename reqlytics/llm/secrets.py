"""Secret scan: candidates by their shape, false positives removed by a random forest.

A candidate is a run of at least 16 letters, digits and ``+ / _ = -``, without a leading ``name=`` and without the
words of a path around it, or a value of at least 8 that is assigned to a key word. The forest looks at its length, changes between kinds of characters, how usual its letter pairs are in prose,
how much of it dictionary words cover, whether it is part of a path, and at the words around it.

Training takes labelled findings: texts with the place of a candidate and whether it is a secret. Without
findings of one's own, :func:`findings` writes them from lists of kinds and contexts into prose of the corpus.
The prose comes from a bounded sample (``PROSE_DOCS`` documents); training rows are what the scan's own
candidates are in the whole sentence. The letter pairs and the dictionary are counted over all documents; the
dictionary that is sent out has the ``DICTIONARY`` most frequent words.
Scanning covers whole texts in one pass without a shuffle.

Results: null and empty texts have no candidates; repeated rows repeat their result; a score of exactly
``THRESHOLD`` counts as a secret; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reqlytics.llm.common import chosen, materialise, with_columns, with_replaced

PROSE_DOCS = 400
DICTIONARY = 20_000
THRESHOLD = 0.5
TREES, DEPTH, LEAST = 40, 9, 4
N_FINDINGS = 4000
MASK = "[secret]"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}")
#: Words that stand before secrets, and words that stand before what only looks like one.
KEY_WORDS = {"token", "secret", "key", "apikey", "api_key", "password", "passwd", "pwd", "auth", "bearer", "credential",
             "access", "private", "client_secret", "access_key", "secret_key"}
OTHER_WORDS = {"commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "build", "revision", "uuid", "id",
               "card", "order", "invoice", "isbn", "example", "sample", "dummy", "placeholder", "test"}
#: What stands before the value in a run, and the words of a path before and after it.
NAME = re.compile(r".*=(?=[^=])")
PATH = re.compile(r"/*(?:[A-Za-z]?[a-z_\-]{2,}/+)+")
SEGMENT = re.compile(r"[A-Za-z]?[a-z_\-]{2,}")
#: A shorter value, by what assigns it.
SHORT = re.compile(
    r"(?i)(?:%s)[\"']?\s*[=:]\s*[\"']?(?P<said>[A-Za-z0-9+/_\-]{8,15}(?![A-Za-z0-9+/_\-]))"
    % "|".join(sorted(KEY_WORDS, key=lambda w: (-len(w), w)))
)
LEAST_RUN = 16
FEATURES = ["length", "changes", "digits", "capitals", "marks", "entropy", "pairs", "dictionary", "path", "key_word",
            "other_word", "assigned", "quoted", "hex", "numeric"]
AROUND = 48


def without_path_end(said: str) -> int:
    """Where the words of a path begin that a run ends with; each segment is looked at once, from the right."""
    end = len(said)
    while True:
        last = len(said[:end].rstrip("/")) if end == len(said) else end
        slash = said.rfind("/", 0, last)
        if slash < 0 or not SEGMENT.fullmatch(said, slash + 1, last):
            return end
        while slash and said[slash - 1] == "/":
            slash -= 1
        end = slash


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of candidates, in code points; the time is that of the text's length, whatever it holds."""
    out = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        said = m.group()
        if not any(c.isalnum() for c in said):
            continue
        if name := NAME.match(said):
            start += name.end()
        if end - start >= LEAST_RUN:
            a, b = start, end
            if path := PATH.match(text, a, b):
                a = path.end()
            b = a + without_path_end(text[a:b])
            # a run that is nothing but a path is judged as it stands
            out.append((a, b) if b - a >= LEAST_RUN else (start, end))
    if "=" in text or ":" in text:
        more, at = [], 0
        for m in SHORT.finditer(text):  # both in order: one look at each
            span = m.span("said")
            while at < len(out) and out[at][1] <= span[0]:
                at += 1
            if at == len(out) or out[at][0] >= span[1]:
                more.append(span)
        out = sorted(out + more)
    return out


@dataclass
class Prose:
    """What usual text looks like: its words and its letter pairs."""

    words: set[str]
    pairs: dict[str, float]
    rare: float
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.words), default=0)

    @staticmethod
    def of(texts: list[str]) -> Prose:
        words: Counter = Counter()
        for t in texts:
            words.update(w for w in re.findall(r"[a-z]+", t.lower()) if 3 <= len(w) <= 24)
        pairs: Counter = Counter()
        for w, n in words.items():
            for a, b in zip(w, w[1:]):
                pairs[a + b] += n
        return Prose.counted(sorted(words, key=lambda w: (-words[w], w))[:DICTIONARY], pairs)

    @staticmethod
    def counted(words: list[str], pairs: dict[str, int]) -> Prose:
        total = sum(pairs.values()) + 36 * 36
        return Prose(set(words), {p: math.log((n + 1) / total) for p, n in pairs.items()}, math.log(1 / total))

    @staticmethod
    def of_all(docs: DataFrame, text: str = "text") -> Prose:
        """From all documents, with counts added up within tasks. Words of equal count at the dictionary's end
        are taken by their hash."""
        cut = F.explode(F.split(F.lower(docs[f"`{text}`"]), "[^a-z]+"))
        words = docs.select(cut.alias("word")).where("length(word) BETWEEN 3 AND 24")
        words = materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "prose")
        two = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2))
        pairs = words.select(F.explode(two).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()  # 26 * 26
        least, total = None, 0
        sizes = words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(DICTIONARY)
        for row in sizes.collect():
            least = row["n"]
            if total + row["words"] > DICTIONARY:
                break
            total += row["words"]
        else:
            least = 0  # all words that there are, or as many as there is room for
            if total == DICTIONARY:
                least = row["n"] - 1
        top = [r["word"] for r in words.where(F.col("n") > least).select("word").collect()]  # DICTIONARY at most
        if least and len(top) < DICTIONARY:
            same = words.where(F.col("n") == least).select("word")
            top += [r["word"] for r in chosen(same, "word", DICTIONARY - len(top)).collect()]
        return Prose.counted(top, {r["pair"]: r["n"] for r in pairs})

    def coverage(self, said: str) -> float:
        """Share of the characters that dictionary words cover, longest word first from the left."""
        said, place, covered = said.lower(), 0, 0
        while place < len(said):
            for size in range(min(self.longest, len(said) - place), 2, -1):
                if said[place : place + size] in self.words:
                    covered += size
                    place += size
                    break
            else:
                place += 1
        return covered / max(1, len(said))


def kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, prose: Prose) -> list[float]:
    said = text[start:end]
    n = len(said)
    kinds = [kind(c) for c in said]
    counts = Counter(said)
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    left = re.findall(r"[a-z0-9_]+", before.lower())[-3:]
    near = left + re.findall(r"[a-z0-9_]+", after.lower())[:1]
    lowered = said.lower()
    pairs = [prose.pairs.get(a + b, prose.rare) for a, b in zip(lowered, lowered[1:])]
    url = before.rsplit(None, 1)[-1] if before and not before[-1].isspace() else ""
    return [
        math.log(n),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / (n - 1),
        kinds.count(2) / n,
        kinds.count(1) / n,
        kinds.count(3) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(pairs) / len(pairs),
        prose.coverage(said),
        float("/" in url or "." in url or said.count("/") >= 2 or after[:1] in ("/", ".") and after[1:2].isalnum()),
        float(any(w in KEY_WORDS for w in left)),
        float(any(w in OTHER_WORDS for w in near)),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(before[-1:] in ("'", '"') and after[:1] == before[-1:]),
        float(all(c in "0123456789abcdef" for c in lowered)),
        float(said.isdigit()),
    ]


# ---------------------------------------------------------------------------------------- labelled findings
def findings(texts: list[str], n: int = N_FINDINGS, seed: int = 20240) -> list[tuple[str, int, int, bool]]:
    """Labelled findings in the corpus's own prose: (text, start, end, is a secret); the same on every run."""
    r = np.random.default_rng(seed)
    prose = [w for t in texts for w in t.split()] or ["text"]

    def some(letters: str, size: int) -> str:
        return "".join(letters[i] for i in r.integers(0, len(letters), size))

    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed, hexes = low + low.upper() + digits, digits + "abcdef"

    def hex_key() -> str:
        key = some(hexes, int(r.choice([32, 40, 40, 64])))
        return key.upper() if r.random() < 0.3 else key

    def words(k: int) -> list[str]:
        return [prose[i] for i in r.integers(0, len(prose), k)]

    def simple(k: int) -> list[str]:
        return [re.sub(r"[^a-z]", "", w.lower()) or "part" for w in words(k)]

    secret_kinds = [
        hex_key, hex_key, lambda: some(mixed, int(r.integers(20, 48))), lambda: "AKIA" + some(low.upper() + digits, 16),
        lambda: "ghp_" + some(mixed, 36), lambda: "sk-" + some(mixed, 40), lambda: some(mixed + "+/", 40) + "=",
        lambda: "eyJ" + some(mixed, 60) + "_" + some(mixed, 40), lambda: "AKIA" + some(low.upper(), 16),
        lambda: some(mixed, int(r.integers(8, 16))),
    ]
    secret_contexts = [
        'token = "{}"', 'token = "{}"', "token={}", 'api_key: "{}"', "password = '{}'", "secret {}", "Authorization Bearer {}",
        'client_secret="{}"', "access_key = {}", "key: {}", "TOKEN = \"{}\"", '"token": "{}"', "API_KEY={}", "export ACCESS_KEY={}", "https://example.org/get?token={}", "{}",
    ]
    other_kinds = [
        lambda: some(digits, 16), lambda: some(digits, 16), lambda: some(digits, int(r.integers(16, 24))), hex_key,
        lambda: "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)),
        lambda: "-".join([*simple(3), some(digits, 4)]), lambda: "_".join([*simple(3), some(digits, 2)]),
        lambda: "".join(w.capitalize() for w in simple(4)) + some(digits, 1), lambda: "/".join([*simple(3), some(digits, 6)]),
        lambda: "your-api-key-goes-here-" + some(digits, 2), lambda: "x" * int(r.integers(16, 30)) + "1",
        lambda: "".join(simple(4)), lambda: simple(1)[0][:15],
    ]
    any_context = ["{}", "{}", "{}", "{},", "({})", '"{}"', "id = {}"]
    hash_context = ["commit {}", "sha256 {}", "checksum: {}", "md5 {}", "build {}", "https://example.org/files/{}", "/var/lib/{}/data"]
    out = []
    while len(out) < n:
        is_secret = bool(r.random() < 0.5)
        if is_secret:
            k = int(r.integers(0, len(secret_kinds)))
            # a plain hex or mixed string is a secret by its context; those with a known beginning stand anywhere
            said = secret_kinds[k]()
            choice = secret_contexts if k in (3, 4, 5, 7, 8) else secret_contexts[:-1]
        else:
            k = int(r.integers(0, len(other_kinds)))
            said = other_kinds[k]()
            choice = hash_context if k == 3 else any_context + hash_context
            if k in (9, 12):
                choice = secret_contexts[:-1]
        context = choice[int(r.integers(0, len(choice)))]
        left, right = " ".join(words(8)), " ".join(words(5))
        text = f"{left} {context.format(said)} {right}"
        start = len(left) + 1 + context.index("{}")
        end = start + len(said)
        out += [(text, a, b, is_secret) for a, b in candidates(text) if a < end and start < b]
    return out


# ---------------------------------------------------------------------------------------- the forest
@dataclass
class Forest:
    """Trees as arrays, all in one: feature (-1: leaf), limit, children, share of secrets."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        at = np.repeat(self.roots[None, :], len(x), 0)
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH + 1):
            feature = self.feature[at]
            below = x[row, np.maximum(feature, 0)] <= self.limit[at]
            at = np.where(feature < 0, at, np.where(below, self.left[at], self.right[at]))
        return self.share[at].mean(1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 7) -> Forest:
    """A random forest: each tree sees a sample with repetition, each split a part of the features."""
    r = np.random.default_rng(seed)
    nodes: list[list[float]] = []
    some = max(1, int(math.sqrt(x.shape[1])) + 1)

    def split(rows: np.ndarray, depth: int) -> int:
        own = len(nodes)
        share = float(y[rows].mean())
        nodes.append([-1, 0.0, own, own, share])
        if depth >= DEPTH or len(rows) < 2 * LEAST or share in (0.0, 1.0):
            return own
        best = None
        for f in r.choice(x.shape[1], some, replace=False):
            order = np.argsort(x[rows, f], kind="stable")
            values, hits = x[rows[order], f], np.cumsum(y[rows[order]])
            n = np.arange(1, len(rows))
            a, b = hits[:-1] / n, (hits[-1] - hits[:-1]) / (len(rows) - n)
            impurity = n * a * (1 - a) + (len(rows) - n) * b * (1 - b)
            open_ = (values[1:] > values[:-1]) & (n >= LEAST) & (len(rows) - n >= LEAST)
            if open_.any():
                k = int(np.argmin(np.where(open_, impurity, np.inf)))
                if best is None or impurity[k] < best[0]:
                    best = (impurity[k], int(f), values[k])
        if best is None:
            return own
        below = x[rows, best[1]] <= best[2]
        nodes[own][:2] = [best[1], best[2]]
        nodes[own][2] = split(rows[below], depth + 1)
        nodes[own][3] = split(rows[~below], depth + 1)
        return own

    roots = [split(r.integers(0, len(y), len(y)), 0) for _ in range(trees)]
    table = np.array(nodes)
    return Forest(
        np.array(roots), table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]
    )


@dataclass
class Model:
    prose: Prose
    forest: Forest

    def found(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of candidates, and the secrets among them."""
        places = candidates(text)
        if not places:
            return 0, []
        scores = self.forest.scores(np.array([features(text, a, b, self.prose) for a, b in places]))
        return len(places), [(a, b, float(s)) for (a, b), s in zip(places, scores) if s >= THRESHOLD]


def sample_of_prose(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    some = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    return [r["text"] for r in chosen(some.where("text IS NOT NULL"), "doc_id", PROSE_DOCS).collect()]


def train(docs: DataFrame, labelled: list[tuple[str, int, int, bool]] | None = None, **columns: str) -> Model:
    """The model, from labelled findings (text, start, end, is a secret) and the words of all documents."""
    texts = sample_of_prose(docs, **columns)
    rows = findings(texts) if labelled is None else labelled
    prose = Prose.of_all(docs, columns.get("text", "text"))
    x = np.array([features(t, a, b, prose) for t, a, b, _ in rows])
    return Model(prose, grow(x, np.array([float(s) for *_, s in rows])))


SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
)


def scan(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` of every document, with ``n_candidates``, ``n_secrets`` and ``secrets`` (places in code points)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> dict:
        n_candidates, secrets = [], []
        for value in batch.column(0):
            n, found = sent.value.found(value.as_py() or "")
            n_candidates.append(n)
            secrets.append([{"start": a, "end": b, "score": s} for a, b, s in found])
        return {"n_candidates": n_candidates, "n_secrets": [len(s) for s in secrets], "secrets": secrets}

    added = [T.StructField("n_candidates", T.LongType()), T.StructField("n_secrets", T.LongType()), T.StructField("secrets", SPANS)]
    return with_columns(docs, {"text": text}, keep, T.StructType(added), compute)


def masked(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by a mark; all rows and columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def hidden(value: str | None) -> str | None:
        if value is None:
            return None
        place, out = 0, []
        for a, b, _ in sent.value.found(value)[1]:
            out += [value[place:a], MASK]
            place = b
        return "".join([*out, value[place:]]) if out else value

    return with_replaced(docs, text, lambda batch: {"new": [hidden(v.as_py()) for v in batch.column(0)]})
