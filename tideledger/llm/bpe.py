"""Byte pair encoding of whole texts with a public vocabulary, by traversal of a trie of words.

The encoding of a word ends in exactly one token, and what stands before that token is the encoding
of a shorter prefix. So a trie of the distinct words needs one state for each node: the last token
of its prefix. A depth-first walk fills the states, each from the states above it, and words that
share a prefix share the work; sorted words are the trie in that order, so it need not be built. A token may follow another if no merge crosses their border before
both are complete, which the merge ranks decide.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tideledger.llm.text import prepared, texts_of

NEVER = 1 << 60
CACHE_WORDS = 500_000
# Characters handled at a time inside a batch.
CHUNK_CHARS = 2_000_000
# White space as the vocabulary's pattern means it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACES = re.compile(f"[{SPACE}]+")
ODD_SPACE = re.compile("[\\x1c-\\x1f]")  # white space to str.split, but not here
TAIL = 3  # bytes at the end of a prefix that tell how long its last token can be

PIECE = f"'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{SPACE}\\p{{L}}\\p{{N}}]+"


def later_letters() -> str:
    """Letters and digits that only a newer Unicode table than the interpreter's knows."""
    unassigned = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    return "".join(regex.findall(r"[\p{L}\p{N}]", unassigned))


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def reach(tokens: Iterable[bytes]) -> dict[bytes, int]:
    """By its last TAIL bytes, the length of the longest such token; tokens without an entry are shorter."""
    longest: dict[bytes, int] = {}
    for token in tokens:
        if len(token) >= TAIL:
            longest[token[-TAIL:]] = max(longest.get(token[-TAIL:], 0), len(token))
    return longest


class WordBpe:
    """A vocabulary with word ends: pieces of text to ids and back."""

    def __init__(self, spec: dict):
        model, letters = spec["model"], byte_letters()
        to_byte = {c: b for b, c in letters.items()}
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(self.ids[a], self.ids[b]): i for i, (a, b) in enumerate(merges)}
        made = {self.ids[a + b]: (self.ids[a], self.ids[b], i) for i, (a, b) in enumerate(merges)}
        written = {i: t.encode() for t, i in [*self.ids.items(), *self.special.items()]}
        self.shown = [written.get(i, b"") for i in range(max(written) + 1)]
        self.length: dict[int, int] = {}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        # The tokens on each side of a token from its outermost symbol up to itself, each with the
        # rank of the merge that takes it up into the next.
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        sound: set[int] = set()
        base = [i for i in self.ids.values() if i not in made]
        for i in [*base, *sorted(made, key=lambda t: made[t][2])]:
            if i in made:
                a, b, r = made[i]
                self.right[i] = [*self.right[b][:-1], (b, r), (i, NEVER)]
                self.left[i] = [*self.left[a][:-1], (a, r), (i, NEVER)]
                if a in sound and b in sound and self.apart(a, b, r):
                    sound.add(i)
            else:
                self.right[i] = self.left[i] = [(i, NEVER)]
                sound.add(i)
        for t, i in self.ids.items():
            ends = t.endswith("</w>") and len(t) > 4
            plain = t[:-4] if ends else t
            if i in sound and all(c in to_byte for c in plain):
                raw = bytes(to_byte[c] for c in plain)
                self.length[i] = len(raw)
                (self.final if ends else self.inner)[raw] = i
        self.inner_reach, self.final_reach = reach(self.inner), reach(self.final)
        self.may_follow: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.special_in = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.piece = regex.compile(PIECE)
        later = later_letters()
        self.later = frozenset(later)
        # Such letters are other characters; noncharacters stand in for them while text is cut.
        self.as_other = dict.fromkeys(map(ord, later), "\ufdd0")

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """No merge of rank below ``until`` crosses the border between tokens a and b."""
        xs, ys = self.right[a], self.left[b]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = xs[i], ys[j]
            crossing = self.rank.get((x, y), NEVER)
            # Of two merges of one rank the left one comes first.
            if crossing < min(x_ends, until) and crossing <= y_ends:
                return False
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def last_token(
        self, path: bytes, lasts: list[int], tokens: dict[bytes, int], reach: dict[bytes, int]
    ) -> int:
        """Last token of the encoding of ``path``, given those of all shorter prefixes."""
        depth = len(path)
        if (token := tokens.get(path)) is not None:
            return token
        may_follow = self.may_follow
        for start in range(max(1, depth - reach.get(path[-TAIL:], TAIL - 1)), depth):
            if (token := tokens.get(path[start:])) is not None:
                pair = (lasts[start], token)
                if (ok := may_follow.get(pair)) is None:
                    ok = may_follow[pair] = self.apart(*pair)
                if ok:
                    return token
        raise ValueError(f"no encoding for {path!r}")

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words: walk the trie of them depth first, which is their order."""
        inner, final, length, known = self.inner, self.final, self.length, self.known
        # The states of the word before, by depth; those of a prefix in common hold for the next word.
        lasts = [0]
        before = b""
        for word in sorted(words):
            path = word.encode()
            depth = len(path)
            shared, most = 0, min(len(before), depth)
            while shared < most and before[shared] == path[shared]:
                shared += 1
            del lasts[shared + 1 :]
            for d in range(len(lasts), depth):
                lasts.append(self.last_token(path[:d], lasts, inner, self.inner_reach))
            token = self.last_token(path, lasts, final, self.final_reach)
            out, at = [token], depth - length[token]
            while at > 0:
                token = lasts[at]
                out.append(token)
                at -= length[token]
            known[word] = struct.pack(f"<{len(out)}I", *out[::-1])
            before = path
        if len(self.may_follow) > 4 * CACHE_WORDS:
            self.may_follow.clear()

    def pieces(self, text: str) -> list[str]:
        """Normalised text cut into the pieces that are encoded one by one."""
        if text.isascii():
            return self.piece.findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Letter by letter where the whole text's rules would look at a letter's neighbours.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        if self.later.isdisjoint(text):
            return self.piece.findall(text)
        spans = [m.span() for m in self.piece.finditer(text.translate(self.as_other))]
        return [text[a:b] for a, b in spans]

    def learn_runs(self, runs: set[str]) -> None:
        """Encode what stands between white space: special tokens, and pieces of the rest."""
        known, special, pieces = self.known, self.special, self.pieces
        marked = [run for run in runs if "<|" in run]
        cut = {run: pieces(run) for run in runs.difference(marked)}
        split = {
            run: [p for part in self.special_in.split(run) for p in ([part] if part in special else pieces(part))]
            for run in marked
        }
        self.learn(set().union(*cut.values(), *split.values()) - known.keys() - special.keys())
        of = known.__getitem__
        self.runs.update({
            run: of(parts[0]) if len(parts) == 1 else b"".join(map(of, parts)) for run, parts in cut.items()
        })
        for run, parts in split.items():
            self.runs[run] = b"".join(
                [struct.pack("<I", special[p]) if p in special else known[p] for p in parts]
            )

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit numbers.

        No piece reaches over white space, so runs between white space are kept with their ids.
        """
        if len(self.runs) > CACHE_WORDS:
            self.runs.clear()
            self.known.clear()
        parts = [t.split() if ODD_SPACE.search(t) is None else SPACES.split(t) for t in texts]
        new = set().union(*parts) - self.runs.keys()
        if new:
            self.learn_runs(new)
        return [b"".join(map(self.runs.__getitem__, own)) for own in parts]

    def decode(self, packed: bytes) -> bytes:
        """The tokens as written in the vocabulary, with a blank between them."""
        shown = self.shown
        return b" ".join([shown[i] for i in np.frombuffer(packed, "<u4").tolist()])


@lru_cache(maxsize=2)
def vocabulary(text: str) -> WordBpe:
    return WordBpe(json.loads(text))


def in_chunks(rows: list, size) -> Iterator[tuple[int, int]]:
    """Ranges of rows of some CHUNK_CHARS each."""
    start = total = 0
    for i, row in enumerate(rows):
        total += size(row)
        if total >= CHUNK_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(rows):
        yield start, len(rows)


def encoded(docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids of each row's whole text.

    ``ids`` is binary: one little-endian unsigned 32-bit number for each token. A null text counts
    as empty, an empty one has no tokens. Special tokens written in a text are encoded as such.
    The vocabulary is read once on the driver (it is small and of fixed size) and sent to the tasks.
    """
    spark = prepared(docs.sparkSession)
    spec = spark.sparkContext.broadcast(Path(vocabulary_file).read_text(encoding="utf-8"))

    def work(batches):
        bpe = vocabulary(spec.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in in_chunks(texts, len):
                packed = bpe.encode_all(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     pa.array([len(p) // 4 for p in packed], pa.int64()),
                     pa.array(packed, pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    return texts_of(docs, id_col, text_col).mapInArrow(work, "doc_id long, n_tokens long, ids binary")


def decoded(rows: DataFrame, vocabulary_file: str) -> DataFrame:
    """``rows(doc_id, n_tokens, ids)`` with a fourth column: the decoded text."""
    spec = rows.sparkSession.sparkContext.broadcast(Path(vocabulary_file).read_text(encoding="utf-8"))

    def work(batches):
        bpe = vocabulary(spec.value)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            for a, b in in_chunks(ids, len):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).slice(a, b - a) for n in ("doc_id", "n_tokens", "ids")]
                    + [pa.array([bpe.decode(p) for p in ids[a:b]], pa.binary()).cast(pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids binary, decoded string")
