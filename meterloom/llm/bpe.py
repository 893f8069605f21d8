"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that can be the last of its encoding.
The tokens that end at a position are found by an automaton over the vocabulary with suffix
links, longest first; the one wanted is compatible with the last token of the prefix before
it: merging the bytes of the two together gives just these two again.
Following the last tokens back from the end gives the ids that the merges would give.

Words are what the pattern of the vocabulary splits a text into; a word is encoded once per
task and then looked up. The tables are made on the driver from the tokenizer's JSON (a file
of fixed size, a few MB) and broadcast. Letters and numbers are those of the `regex` module,
whose Unicode tables may be a version newer than another library's.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meterloom.llm.shared import freed, received, send, sliced, text_bytes, with_columns

# The splitting pattern of byte-level vocabularies. The commonest alternative comes first:
# no other can start with a letter, or with a space before one.
PATTERN = (
    r" ?\p{L}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
)
CACHED_WORDS = 200_000
SHORT_WORD = 256
TOGETHER = 4096  # words
SEEN_BITS = 20
_FOREVER = 1 << 30


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable, else 256 + n."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and the automaton of a byte-level BPE file in JSON."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        if spec.get("normalizer") or model["type"] != "BPE":
            raise ValueError("only byte-level BPE without a normalizer is read")
        letters = byte_letters()
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()
        }
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len)[::-1])) + ")")
            if self.special
            else None
        )
        self.pattern = regex.compile(PATTERN)
        ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for at, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.rank.setdefault(pair, at)
            if whole not in self.parts:
                self.parts[whole], self.made_at[whole] = pair, at
        self._fits: dict[int, bool] = {}
        self._build({i: self.bytes_of[i] for i in ids.values()})

    def _build(self, tokens: dict[int, bytes]) -> None:
        """The automaton: a state is a token's prefix, the longest that ends where we stand.

        ``longest`` has the longest token that ends a state's string, ``shorter`` the next
        shorter token that ends a token: following it gives all tokens that end here.
        """
        whole = [
            i for i in tokens
            if i not in self.parts or not self._clash(*self.parts[i], self.made_at[i])
        ]
        self.step: dict[int, int] = {}
        self.size = {i: len(tokens[i]) for i in whole}
        self.whole = {tokens[i]: i for i in whole}
        own: list[int | None] = [None]
        for i in whole:
            state = 0
            for byte in tokens[i]:
                key = state << 8 | byte
                state = self.step.get(key, 0)
                if not state:
                    state = self.step[key] = len(own)
                    own.append(None)
            own[state] = i
        self.fall = [0] * len(own)
        self.longest: list[int | None] = list(own)
        self.shorter: dict[int, int | None] = {}
        below: dict[int, list[tuple[int, int]]] = {}
        for key, state in self.step.items():
            below.setdefault(key >> 8, []).append((key & 255, state))
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for byte, state in below.get(parent, ()):
                    deeper.append(state)
                    at = self.fall[parent]
                    while at and (at << 8 | byte) not in self.step:
                        at = self.fall[at]
                    if parent:
                        self.fall[state] = self.step.get(at << 8 | byte, 0)
                    ending = self.longest[self.fall[state]]
                    if own[state] is None:
                        self.longest[state] = ending
                    else:
                        self.shorter[own[state]] = ending
            level = deeper
        self._pack(max(tokens) + 1)

    def _pack(self, n: int) -> None:
        """The same as arrays, for many words at a time."""
        self.step_table = HashTable(self.step)
        self.rank_table = HashTable({a << 32 | b: r for (a, b), r in self.rank.items()})
        self.fall_of = np.array(self.fall, np.int64)
        self.longest_of = np.array([-1 if t is None else t for t in self.longest], np.int64)
        self.shorter_of = np.full(n, -1, np.int64)
        self.size_of = np.ones(n, np.int64)
        self.made_of = np.full(n, -1, np.int64)
        self.left_of, self.right_of = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i, size in self.size.items():
            shorter = self.shorter.get(i)
            self.size_of[i], self.shorter_of[i] = size, -1 if shorter is None else shorter
        for i, (left, right) in self.parts.items():
            self.made_of[i], self.left_of[i], self.right_of[i] = self.made_at[i], left, right
        self._forget()

    # What only single long words need; made again from the arrays where one turns up.
    _SCALAR = ("step", "rank", "parts", "made_at", "size", "whole", "fall", "longest", "shorter", "_fits",
               "seen", "seen_fits")

    def __getstate__(self) -> dict:
        return {n: v for n, v in self.__dict__.items() if n not in self._SCALAR}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        # Answers already found, at the slot of a pair's hash; a newer pair takes the slot.
        self.seen = np.full(1 << SEEN_BITS, -1, np.int64)
        self.seen_fits = np.zeros(1 << SEEN_BITS, bool)

    def _unpack(self) -> None:
        def items(table: HashTable) -> dict[int, int]:
            there = table.keys != -1
            return dict(zip(table.keys[there].tolist(), table.values[there].tolist()))

        self.step = items(self.step_table)
        self.rank = {(k >> 32, k & 0xFFFFFFFF): r for k, r in items(self.rank_table).items()}
        made = np.flatnonzero(self.made_of >= 0).tolist()
        self.made_at = {i: int(self.made_of[i]) for i in made}
        self.parts = {i: (int(self.left_of[i]), int(self.right_of[i])) for i in made}
        self.size = dict(enumerate(self.size_of.tolist()))
        self.fall, self.longest = self.fall_of.tolist(), self.longest_of.tolist()
        self.shorter = dict(enumerate(self.shorter_of.tolist()))
        self._fits = {}

    def _clash(self, a: int, b: int, until: int = _FOREVER) -> bool:
        """Whether the merges, before the one of rank ``until``, join something across a|b.

        A piece x at the end of a and a piece y at the start of b stand side by side until
        one of them is merged into the next larger piece of its own side. Their own merge
        comes first if it ranks before both; of equal ranks the left one comes first.
        """
        x, y, x_until, y_until = a, b, until, until
        while True:
            rank = self.rank.get((x, y), _FOREVER)
            if rank < x_until and rank <= y_until and rank < until:
                return True
            x_made, y_made = self.made_at.get(x, -1), self.made_at.get(y, -1)
            if x_made < 0 and y_made < 0:
                return False
            # Go back over the later of the two merges. Of the same rank, the left came first.
            if x_made > y_made:
                x, x_until = self.parts[x][1], x_made
            else:
                y, y_until = self.parts[y][0], y_made

    def fits(self, pair: int) -> bool:
        """Whether the tokens a and b of ``pair`` = a << 32 | b may follow each other."""
        if len(self._fits) > 5 * CACHED_WORDS:
            self._fits.clear()
        found = self._fits[pair] = not self._clash(pair >> 32, pair & 0xFFFFFFFF)
        return found

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of one word."""
        if "step" not in self.__dict__:
            self._unpack()
        # last: the last token of each prefix, by the prefix's length.
        last: list = [None] * (len(word) + 1)
        step, fall, longest, shorter, size = (
            self.step.get, self.fall, self.longest, self.shorter, self.size
        )
        known, fits = self._fits.get, self.fits
        state = 0
        for end, byte in enumerate(word, 1):
            there = step(state << 8 | byte)
            while there is None:
                state = fall[state]
                there = step(state << 8 | byte)
            state = there
            token = longest[state]
            while True:
                before = end - size[token]
                if not before:
                    break
                pair = last[before] << 32 | token
                good = known(pair)
                if good or good is None and fits(pair):
                    break
                token = shorter[token]
            last[end] = token
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= size[last[at]]
        return out[::-1]


    def all_fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`fits` for many pairs."""
        pairs = a << 32 | b
        slots = _hashed(pairs, SEEN_BITS)
        new = np.flatnonzero(self.seen[slots] != pairs)
        good = self.seen_fits[slots]
        if len(new):
            good[new] = ~self._all_clash(a[new], b[new])
            self.seen[slots[new]] = pairs[new]
            # Two new pairs may share a slot: only the one that holds it says what it fits.
            held = new[self.seen[slots[new]] == pairs[new]]
            self.seen_fits[slots[held]] = good[held]
        return good

    def _all_clash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`_clash` for many pairs: the same walk, those that are decided drop out."""
        clash = np.zeros(len(a), bool)
        left = np.arange(len(a))
        x, y = a.copy(), b.copy()
        x_until, y_until = np.full(len(a), _FOREVER), np.full(len(a), _FOREVER)
        while len(left):
            rank = self.rank_table.get(x << 32 | y, _FOREVER)
            hit = (rank < x_until) & (rank <= y_until) & (rank < _FOREVER)
            clash[left[hit]] = True
            x_made, y_made = self.made_of[x], self.made_of[y]
            go = ~hit & ((x_made >= 0) | (y_made >= 0))
            left, x, y, x_until, y_until = left[go], x[go], y[go], x_until[go], y_until[go]
            x_made, y_made = x_made[go], y_made[go]
            back = x_made > y_made
            x_until = np.where(back, x_made, x_until)
            y_until = np.where(back, y_until, y_made)
            x, y = np.where(back, self.right_of[x], x), np.where(back, y, self.left_of[y])
        return clash

    def many_word_ids(self, words: list[bytes]) -> list[bytes]:
        """:meth:`word_ids` of many short words, as little-endian bytes.

        All words advance by one byte at a time; the dynamic programme is the same.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        raw = np.frombuffer(b"".join(words), np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        last = np.full((longest + 1, len(words)), -1, np.int64)
        state = np.zeros(len(words), np.int64)
        for end in range(1, longest + 1):
            n = int(np.searchsorted(-sizes, -end, side="right"))
            byte = raw[starts[:n] + end - 1].astype(np.int64)
            at = state[:n].copy()
            there = self.step_table.get(at << 8 | byte, -1)
            while len(lost := np.flatnonzero(there < 0)):
                at[lost] = self.fall_of[at[lost]]
                there[lost] = self.step_table.get(at[lost] << 8 | byte[lost], -1)
            state[:n] = there
            token = self.longest_of[there]
            row = np.arange(n)
            while len(row):
                before = end - self.size_of[token[row]]
                good = before == 0
                rest = np.flatnonzero(~good)
                good[rest] = self.all_fit(last[before[rest], row[rest]], token[row[rest]])
                row = row[~good]
                token[row] = self.shorter_of[token[row]]
            last[end, :n] = token
        back, at, row = [], sizes.copy(), np.arange(len(words))
        counts = np.zeros(len(words), np.int64)
        while len(row):
            token = last[at[row], row]
            back.append((row, token))
            counts[row] += 1
            at[row] -= self.size_of[token]
            row = row[at[row] > 0]
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, "<u4")
        for k, (row, token) in enumerate(back, 1):
            flat[ends[row] - k] = token
        out: list[bytes] = [b""] * len(words)
        ids, cuts = flat.tobytes(), (4 * ends).tolist()
        for i, a, b in zip(order.tolist(), [0, *cuts], cuts):
            out[i] = ids[a:b]
        return out


def _hashed(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


class HashTable:
    """An integer map of fixed content, looked up for many keys at a time."""

    def __init__(self, items: dict[int, int]) -> None:
        self.bits = max(4, (3 * len(items)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        keys = np.fromiter(items.keys(), np.int64, len(items))
        values = np.fromiter(items.values(), np.int64, len(items))
        slots = _hashed(keys, self.bits)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == -1)
            self.keys[slots[free]] = keys[free]
            self.values[slots[free]] = values[free]
            # Of those that share a slot the last one written has it; the others go on.
            held = self.keys[slots] == keys
            self.values[slots[held]] = values[held]
            keys, values = keys[~held], values[~held]
            slots = (slots[~held] + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray, otherwise: int) -> np.ndarray:
        slots = _hashed(keys, self.bits)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], otherwise)
        row = np.flatnonzero((found != keys) & (found != -1))
        slots = slots[row]
        while len(row):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots]
            same = found == keys[row]
            out[row[same]] = self.values[slots[same]]
            on = ~same & (found != -1)
            row, slots = row[on], slots[on]
        return out


class _Words(dict):
    """Word to its ids as little-endian bytes; never many more than CACHED_WORDS words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def learn(self, words: list[str]) -> None:
        """Encode the words of a slice that are new, together."""
        if len(self) >= CACHED_WORDS:
            self.clear()
        new = [w for w in set(words).difference(self) if len(w) <= SHORT_WORD // 4]
        # Some at a time, of like length: the table of prefixes is as wide as the longest.
        new.sort(key=len)
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            self.update(zip(some, self.vocabulary.many_word_ids([w.encode() for w in some])))

    def __missing__(self, word: str) -> bytes:
        """A long word: encoded alone, and not kept."""
        return np.array(self.vocabulary.word_ids(word.encode()), dtype="<u4").tobytes()


def encode_texts(vocabulary: Vocabulary, words: _Words, texts: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    special = vocabulary.special
    found = vocabulary.pattern.findall
    cut: list[list[list[str] | bytes]] = []
    for text in texts:
        if any(s in text for s in special):
            cut.append([
                np.array([special[part]], dtype="<u4").tobytes() if part in special else found(part)
                for part in vocabulary.split_special.split(text)
            ])
        else:
            cut.append([found(text)])
    words.learn([w for parts in cut for part in parts if isinstance(part, list) for w in part])
    return [
        b"".join(
            part if isinstance(part, bytes) else b"".join(map(words.__getitem__, part))
            for part in parts
        )
        for parts in cut
    ]


def _texts(array: pa.Array) -> Iterator[str]:
    data, ends = text_bytes(array)
    raw = data.tobytes()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield raw[a:b].decode("utf-8", "replace")


def _read(df: DataFrame, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as file:
        return send(df.sparkSession, Vocabulary(file.read()))


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the token ids of ``text``, as bytes of little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of the JSON file on the driver. Null and empty texts give no
    ids; bytes that are not UTF-8 are read as U+FFFD. Texts are encoded whole, in slices of
    rows; equal rows give equal ids, an empty table gives an empty table. A column that is
    called ``ids`` already is replaced.
    """
    spec = _read(df, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = received(spec)
        words = _Words(vocabulary)
        for batch in sliced(batches, text):
            rows = encode_texts(vocabulary, words, list(_texts(batch.column(text))))
            yield with_columns(batch, **{ids: pa.array(rows, pa.binary())})

    return df.mapInArrow(freed(run), _schema(df, ids, T.BinaryType()))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the text of ``ids``, special tokens included; null ids give "".

    Bytes that are not UTF-8 come out as U+FFFD. A column of that name is replaced.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = send(df.sparkSession, Vocabulary(file.read()).bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(spec)
        for batch in sliced(batches, ids):
            data, ends = text_bytes(batch.column(ids))
            flat = list(map(table.__getitem__, data.view("<u4").tolist())) if len(data) else []
            cuts = (ends // 4).tolist()
            rows = [
                b"".join(flat[a:b]).decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])
            ]
            yield with_columns(batch, **{text: pa.array(rows, pa.string())})

    return df.mapInArrow(freed(run), _schema(df, text, T.StringType()))


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*fields, T.StructField(name, kind)])
