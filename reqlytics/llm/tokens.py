"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a block of texts are laid out as one array of symbols with links to the left and right
neighbour. An index maps each mergeable pair to all its places in the block. A heap holds the ranks of the
pairs that have places; the lowest is applied to all its places at once, and the pairs that the merge makes
are entered in the index under their own ranks. No word is looked at twice for the same rank, and the number
of Python steps is that of active ranks, not of words.

Applying a rank to all places before the next lower new rank equals the usual order word by word as long as
no merge makes a pair of a lower rank than its own; :class:`Vocabulary` tests that on loading.

Results: a null text is the empty text, which has no tokens; repeated rows give repeated results; an empty
table gives an empty table.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import json
import unicodedata
from dataclasses import dataclass
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from reqlytics.llm.common import free_name, with_columns

#: Words laid out in one index at most, in bytes; more are done in further blocks.
BLOCK_SYMBOLS = 1 << 20
#: Bytes of the memo of encoded pieces, and letters of the longest that is kept. It is emptied beyond that, and longer
#: pieces are forgotten at once, which costs time only.
MEMO_BYTES, MEMO_LETTERS = 48 << 20, 64
#: Characters of the white space at which texts may be cut before anything else; all is done alike between.
CONTROL = regex.compile(r"[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


#: Capitals that Unicode 16 and 17 added, whose small letters Python does not know yet.
NEWER_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
_NEWER = regex.compile("[" + "".join(map(chr, NEWER_CAPITALS)) + "]")


def small(text: str) -> str:
    """Lower case letter by letter: a capital sigma at a word's end is no special case."""
    if not text.isascii():
        text = text.replace("Σ", "σ")
        if _NEWER.search(text):
            text = text.translate(NEWER_CAPITALS)
    return text.lower()


#: Letters that the regex module knows and Unicode 16, which the library follows, does not.
LATER_LETTERS = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3"
    r"\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    r"\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    r"\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5"
    r"\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    r"\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
#: Marks newer than Unicode 9, whose NFC the library applies: neither ordered nor composed.
LATER_MARKS = (
    r"\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c"
    r"\U00010d24-\U00010d27\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85"
    r"\U00011070\U0001133b\U0001145e\U00011839-\U0001183a\U00011930\U0001193d-\U0001193e\U00011943\U000119e0"
    r"\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44-\U00011d45\U00011d97\U00011f41-\U00011f42"
    r"\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef"
)
_MARKS = regex.compile(f"([{LATER_MARKS}]+)")


def composed(text: str) -> str:
    """NFC with the library's tables."""
    if text.isascii() or unicodedata.is_normalized("NFC", text):
        return text
    if _MARKS.search(text):
        parts = _MARKS.split(text)  # every second part holds marks
        parts[::2] = [unicodedata.normalize("NFC", part) for part in parts[::2]]
        return "".join(parts)
    return unicodedata.normalize("NFC", text)


LETTERS = rf"[\p{{L}}--[{LATER_LETTERS}]]"


@dataclass
class Vocabulary:
    """A public tokenizer file of the kind "words with an end mark", read once per worker."""

    tokens: list[str]
    special: dict[str, int]
    first: np.ndarray  # id of each byte's symbol inside a word
    final: np.ndarray  # id of each byte's symbol at a word's end
    merges: dict[int, tuple[int, int]]  # left << 32 | right -> rank, merged id
    pairs: list[tuple[int, int, int]]  # by rank: left, right, merged
    pattern: regex.Pattern
    specials: regex.Pattern | None

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read the file; the pattern's letters are those of the Unicode version the library has."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        ids = dict(model["vocab"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = [""] * (max([*ids.values(), *special.values()]) + 1)
        for name, i in [*ids.items(), *special.items()]:
            names[i] = name
        symbols = byte_symbols()
        pairs, merges = [], {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, made = ids[left], ids[right], ids[left + right]
            pairs.append((a, b, made))
            merges[a << 32 | b] = (rank, made)
        last = {}
        for rank, (_, _, made) in enumerate(pairs):
            last[made] = rank
        if any(max(last.get(a, -1), last.get(b, -1)) > rank for rank, (a, b, _) in enumerate(pairs)):
            raise ValueError("a merge makes a pair of a lower rank: this order of work would not be exact")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{LATER_LETTERS}])"
        split = split.replace(r"[^\s\p{L}\p{N}]", other).replace(r"[\p{L}]", LETTERS)
        return Vocabulary(
            names,
            special,
            np.array([ids[s] for s in symbols], np.int64),
            np.array([ids[s + end] for s in symbols], np.int64),
            merges,
            pairs,
            regex.compile(split, regex.V1),
            regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None,
        )

    def words_of(self, piece: str) -> list[str | int]:
        """Words of a piece of text; a special token's string is its id."""
        out: list[str | int] = []
        place = 0
        for m in self.specials.finditer(piece) if self.specials else ():
            out += self._plain(piece[place : m.start()])
            out.append(self.special[m.group()])
            place = m.end()
        return out + self._plain(piece[place:])

    def _plain(self, piece: str) -> list[str]:
        if not piece:
            return []
        piece = small(composed(piece))
        if piece.isalpha():  # letters of Python's Unicode 15 are letters of the library's: one word
            return [piece]
        if piece[-1] in ",." and piece[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.pattern.findall(piece)

    # ------------------------------------------------------------------ the pair occurrence index
    def encode_words(self, given: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers, block by block."""
        out: list[bytes] = []
        first = 0
        while first < len(given):
            last, size = first, 0
            while last < len(given) and (last == first or size + len(given[last]) <= BLOCK_SYMBOLS):
                size += len(given[last])
                last += 1
            out += self._encode_block(given[first:last])
            first = last
        return out

    def _encode_block(self, given: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, given), np.int64, len(given))
        data = np.frombuffer(b"".join(given), np.uint8)
        n = len(data)
        if not n:
            return [b"" for _ in given]
        ends = np.cumsum(lengths)
        symbol = self.first[data]
        used = ends[lengths > 0] - 1
        symbol[used] = self.final[data[used]]
        word_start = np.zeros(n + 1, bool)
        word_start[ends - lengths] = True
        # neighbours; n stands for "none" and holds a symbol that no pair has
        symbol = np.append(symbol, -1)
        after = np.arange(1, n + 2)
        after[used] = n
        after[n] = n
        before = np.append(np.arange(-1, n - 1), n)
        before[:n][word_start[:n]] = n

        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Enter the pairs that begin at these places."""
            nxt = after[at]
            real = nxt < n
            at, nxt = at[real], nxt[real]
            if not len(at):
                return
            keys = symbol[at] << 32 | symbol[nxt]
            order = np.argsort(keys, kind="stable")
            keys, at = keys[order], at[order]
            bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
            for x, y in zip(bounds, bounds[1:]):
                known = self.merges.get(int(keys[x]))
                if known is None:
                    continue
                rank = known[0]
                if rank in places:
                    places[rank].append(at[x:y])
                else:
                    places[rank] = [at[x:y]]
                    heapq.heappush(heap, rank)

        enter(np.arange(n))
        alive = np.ones(n, bool)
        while heap:
            rank = heapq.heappop(heap)
            listed = places.pop(rank)
            left, right, made = self.pairs[rank]
            at = listed[0] if len(listed) == 1 else np.unique(np.concatenate(listed))
            at = at[alive[at]]
            at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
            if left == right and len(at) > 1:
                at = self._from_left(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = made
            alive[gone] = False
            after[at] = after[gone]
            before[after[at]] = at
            before[n] = n
            prior = before[at]
            enter(np.unique(np.concatenate([at, prior[prior < n]])))
        kept = np.flatnonzero(alive)
        ids = symbol[kept].astype("<u4").tobytes()
        bounds = [0, *(4 * np.searchsorted(kept, ends)).tolist()]
        return [ids[x:y] for x, y in zip(bounds, bounds[1:])]

    @staticmethod
    def _from_left(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of places whose pairs share a symbol (aaa), those that are merged from the left on."""
        follows = np.concatenate([[False], after[at[:-1]] == at[1:]])
        index = np.arange(len(at))
        run = np.maximum.accumulate(np.where(follows, 0, index))
        return at[(index - run) % 2 == 0]


class Encoder:
    """Encodes texts; pieces between white space are remembered within a worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that the memo lacks, all their distinct words in one index."""
        words_of = self.vocabulary.words_of
        special = self.vocabulary.specials
        plain = self.vocabulary._plain
        cut = [plain(p) if special is None or not special.search(p) else words_of(p) for p in pieces]
        distinct = list(dict.fromkeys(itertools.chain.from_iterable(cut)))
        texts = [w for w in distinct if isinstance(w, str)]
        known: dict[str | int, bytes] = dict(zip(texts, self.vocabulary.encode_words([w.encode() for w in texts])))
        known |= {i: np.array([i], "<u4").tobytes() for i in self.vocabulary.special.values()}
        for piece, ws in zip(pieces, cut):
            self.memo[piece] = ids = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])
            self.held += getsizeof(piece) + getsizeof(ids) + 100  # and its place in the memo

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        cut = [SPACE.split(t) if CONTROL.search(t) else t.split() for t in (t or "" for t in texts)]
        missing = set().union(*cut) - self.memo.keys()
        if missing:
            self._learn(list(missing))
        out = [b"".join(map(self.memo.__getitem__, ps)) for ps in cut]
        for piece in missing:
            if len(piece) > MEMO_LETTERS:
                ids = self.memo.pop(piece)
                self.held -= getsizeof(piece) + getsizeof(ids) + 100
        return out


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """The text that token ids stand for: the tokens' strings with a space between."""
    names = vocabulary.tokens
    return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        gc.set_threshold(200_000, 20, 20)  # many small lists live at once here; none of them is a cycle
        _loaded[path] = Encoder(Vocabulary.load(path))
    return _loaded[path]


def portions(column: pa.Array, most: int = 1 << 22):
    """The texts of a column, a few megabytes at a time."""
    part: list[str | None] = []
    size = 0
    for value in column:
        text = value.as_py()
        part.append(text)
        size += len(text or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with the token ids of a text column: little-endian unsigned 32-bit integers.

    ``path`` is the vocabulary file, at the same place on every machine. A column of ``df`` that is named
    like ``ids`` stays, and the new one gets underscores in front.
    """
    name = free_name(df, ids)

    def compute(batch: pa.RecordBatch) -> dict:
        coder = encoder(path)
        return {name: [x for part in portions(batch.column(0)) for x in coder.encode(part)]}

    return with_columns(df, {"text": text}, df.columns, T.StructType([T.StructField(name, T.BinaryType())]), compute)


def decode_ids(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that a column of token ids stands for; null ids give the empty text."""
    name = free_name(df, text)

    def compute(batch: pa.RecordBatch) -> dict:
        vocabulary = encoder(path).vocabulary
        return {name: [decode(vocabulary, v.as_py() or b"") for v in batch.column(0)]}

    return with_columns(df, {"ids": ids}, df.columns, T.StructType([T.StructField(name, T.StringType())]), compute)


def digests(
    df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """Number of tokens, and digests of ids and decoded text: each batch is encoded, and its ids decoded.

    The same steps as :func:`encode` and :func:`decode_ids` in one pass, so that ids and decoded texts, which
    are several times as long as the texts, never leave the task.
    """
    import hashlib

    def compute(batch: pa.RecordBatch) -> dict:
        coder = encoder(path)
        counts, ids_digests, text_digests, coded = [], [], [], []
        for part in portions(batch.column(0), 1 << 20):
            for ids in coder.encode(part):
                counts.append(len(ids) // 4)
                if with_ids:
                    coded.append(ids)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(decode(coder.vocabulary, ids).encode()).hexdigest())
        return {"n_tokens": counts, "ids_sha256": ids_digests, "decoded_sha256": text_digests, "token_ids": coded}

    added = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        added.append(T.StructField("token_ids", T.BinaryType()))
    return with_columns(df, {"text": text}, list(keep), T.StructType(added), compute)
