"""Byte-level BPE by prefix-sharing traversal of a trie of the distinct words.

The last token of a prefix's encoding decides the encoding: it is the one token that ends the
prefix, and whose place after the encoding of what precedes it is stable, that is, no merge joins
the two sides. So one last token per trie node is enough, and a prefix that many words share is
encoded once. Sorted words are the trie in depth-first order; what a word shares with the one
before it is the path kept on the stack.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from oreworks.llm.shared import row_schema, text_slices, whole_row

#: Words and pairs of tokens whose encoding a task keeps.
KEPT_WORDS, KEPT_PAIRS = 100_000, 200_000

# The pattern that splits text before the merges, in full and for texts of ASCII and
# Latin letters only, where Python's own regular expressions give the same words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_LATIN = re.compile(f"[\x00-\x1b\x20-\x7f{_LETTER}]*")
_LATIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\t-\r {_LETTER}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)


def split_words(text: str) -> list[str]:
    return (_LATIN_WORDS if _LATIN.fullmatch(text) else WORDS).findall(text)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves; the others take letters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens of a byte-level BPE file of the tokenizers library, and which may stand side by side."""

    def __init__(self, spec: dict) -> None:
        letter = _byte_letters()
        ids = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(letter[c] for c in t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.rank[a, b] = rank
            if whole not in self.halves:
                self.halves[whole], self.made_at[whole] = (a, b), rank
        self._whole: dict[int, bool] = {}
        plain = self.token_bytes.keys() - self.special.values()
        self.by_bytes = {self.token_bytes[i]: i for i in plain if self.whole(i)}
        self.longest = max(map(len, self.by_bytes))
        self.lengths = {t: len(b) for t, b in self.token_bytes.items()}
        self.packed = {t: t.to_bytes(4, "little") for t in self.token_bytes}
        self.known_stable: dict[tuple[int, int], bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            return cls(json.load(file))

    def stable(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens side by side encode to those two tokens.

        While both are built, the parts next to the border are the last part of the left token and
        the first of the right one. Their history is followed backwards, taking apart what was
        merged last. A merge over the border takes place where it comes before the merges that
        absorb either part; the same merge twice goes to the left place first.
        """
        never = len(self.rank)
        a, b, a_until, b_until = left, right, never, never
        answer = True
        while True:
            crossing = self.rank.get((a, b), never)
            if crossing < a_until and (crossing < b_until or crossing == b_until != never):
                answer = False
                break
            a_made, b_made = self.made_at.get(a, -1), self.made_at.get(b, -1)
            if a_made < 0 and b_made < 0:
                break
            if a_made >= b_made:
                a, a_until = self.halves[a][1], a_made
            else:
                b, b_until = self.halves[b][0], b_made
        self.known_stable[left, right] = answer
        return answer

    def whole(self, token: int) -> bool:
        """Whether the bytes of a token encode to it alone."""
        known = self._whole.get(token)
        if known is None:
            halves = self.halves.get(token)
            if halves is None:
                known = len(self.token_bytes[token]) == 1
            else:
                known = all(map(self.whole, halves)) and self._joined(*halves)
            self._whole[token] = known
        return known

    def _joined(self, left: int, right: int) -> bool:
        """Whether the first merge over the border of two built tokens is that of the two."""
        wanted, never = self.rank[left, right], len(self.rank)
        a, b, a_until, b_until = left, right, never, never
        while True:
            a_made, b_made = self.made_at.get(a, -1), self.made_at.get(b, -1)
            if a_made < 0 and b_made < 0:
                return max(self.made_at.get(left, -1), self.made_at.get(right, -1)) < wanted
            if a_made >= b_made:
                a, a_until = self.halves[a][1], a_made
            else:
                b, b_until = self.halves[b][0], b_made
            crossing = self.rank.get((a, b), never)
            if crossing < a_until and (crossing < b_until or crossing == b_until != never):
                return False


class PrefixEncoder:
    """Encodings of words as little-endian unsigned 32-bit ids."""

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT_WORDS) -> None:
        self.vocabulary = vocabulary
        self.kept = kept
        self.known: dict[str, bytes] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that aren't known yet, in the depth-first order of their trie."""
        voc = self.vocabulary
        token_at, longest, stable, settled = voc.by_bytes.get, voc.longest, voc.stable, voc.known_stable.get
        lengths, packed = voc.lengths, voc.packed
        path = b""  # bytes from the root to the node
        last: list[int] = [-1]  # last token of the prefix at each depth of the path
        for raw, word in sorted((w.encode(), w) for w in words):
            shared = len(commonprefix((path, raw)))
            del last[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                # Mostly the last token grows by the byte, or the byte is a token; then try all.
                grown = end - 1 - lengths[last[-1]] if end > 1 else 0
                for start in chain((grown, end - 1), range(max(0, end - longest), end - 1)):
                    token = token_at(raw[start:end])
                    if token is None:
                        continue
                    if start:
                        fits = settled((last[start], token))
                        if fits is None:
                            fits = stable(last[start], token)
                        if not fits:
                            continue
                    last.append(token)
                    break
                else:
                    raise ValueError(f"no token ends {raw[:end]!r}")
            path = raw
            ids, end = [], len(raw)
            while end:
                token = last[end]
                ids.append(packed[token])
                end -= lengths[token]
            self.known[word] = b"".join(ids[::-1])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Strings of special tokens are those tokens."""
        special = self.vocabulary.special
        cut = re.compile("|".join(f"({re.escape(s)})" for s in sorted(special, key=len, reverse=True))) if special else None
        split: list[list[str]] = []
        for text in texts:
            if cut is None or not cut.search(text):
                split.append(split_words(text))
                continue
            words: list[str] = []
            at = 0
            for found in cut.finditer(text):
                words += [*split_words(text[at : found.start()]), f"\0{found.group()}"]
                at = found.end()
            split.append(words + split_words(text[at:]))
        marked = {f"\0{s}": self.vocabulary.packed[i] for s, i in special.items()}
        wanted = set().union(*split) if split else set()
        if len(self.known) > self.kept:
            self.known = {w: self.known[w] for w in wanted if w in self.known}
        if len(self.vocabulary.known_stable) > KEPT_PAIRS:
            self.vocabulary.known_stable.clear()
        self.learn(w for w in wanted if w not in self.known and w not in marked)
        get = {**self.known, **marked}.__getitem__ if wanted & marked.keys() else self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become the replacement character."""
        tokens = self.vocabulary.token_bytes
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _mapped(docs: DataFrame, path: str, text_col: str, columns: dict[str, pa.DataType], make: Callable) -> DataFrame:
    """``row`` and what ``make`` gives for each text. The vocabulary file is read by the driver only."""
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = PrefixEncoder(Vocabulary(json.loads(spec.value)))
        for batch in batches:
            for part, raw in text_slices(batch, text_col):
                ids = own.encode([t.decode() for t in raw])
                made = [make(own, i) for i in ids]
                arrays = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(columns.values())]
                yield pa.RecordBatch.from_arrays([part.column("row"), *arrays], ["row", *columns])

    kinds = {pa.binary(): "binary", pa.string(): "string", pa.int64(): "bigint"}
    schema = ", ".join(f"{name} {kinds[kind]}" for name, kind in columns.items())
    return docs.select(whole_row(docs)).mapInArrow(run, row_schema(docs, schema))


def encode_texts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``row`` (the input's columns), ``ids`` and ``decoded`` for every row.

    ``ids`` are the token ids of the whole text as little-endian unsigned 32-bit integers in one
    binary value, ``decoded`` the text that they decode to. A null text is an empty one. Rows stay
    where they are; nothing is shuffled, and a row's result depends on its text alone.
    """
    columns = {"ids": pa.binary(), "decoded": pa.string()}
    return _mapped(docs, path, text_col, columns, lambda own, ids: (ids, own.decode(ids)))


def encode_digests(docs: DataFrame, path: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``row``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if wanted, ``ids`` of every row.

    The digests are those of what ``encode_texts`` gives; decoded texts don't leave the task.
    """

    def digests(own: PrefixEncoder, ids: bytes) -> tuple[int, str, str, bytes]:
        decoded = own.decode(ids).encode()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest(), ids

    columns = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if with_ids:
        columns["ids"] = pa.binary()
    return _mapped(docs, path, text_col, columns, digests)
