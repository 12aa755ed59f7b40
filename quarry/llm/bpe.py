"""Byte-pair encoding as a tokenization automaton, and decoding by its arc labels.

A deterministic automaton whose arcs are tokens is compiled from the merge list. It begins with one state and an arc
back to it for each symbol. Each merge (u, v) -> uv then puts a gadget in: the state that all arcs u lead to is copied
without its arc v, the arcs u are led to the copy, and wherever an arc u was, an arc uv leads to where v led. What
comes of all merges accepts exactly one path for each word, its encoding, and so one path for each of its beginnings.
A copy differs by one arc from its original, so the transition table has one entry for each merge: the token whose
arcs lead to the copy, the arc that it lost, and since when. Words are encoded from left to right: each place has the
one state that it can be reached in, whose arcs are read off the table.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for the end-of-word suffix inside the automaton; no mapped byte is this character.
END = ""
_NEVER = 1 << 60
#: Bound of a worker's memory for words; it is refilled after it is emptied.
WORDS_KEPT = 600_000


def byte_chars() -> list[str]:
    """The printable character for each byte that byte-level vocabularies use."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class MergeAutomaton:
    """Deterministic automaton over the tokens of a merge list. All arcs of a token lead to one state, which has the token's name; -1 is the first state."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        made = {u + v for u, v in merges}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token")
        if not made <= vocab.keys():
            raise ValueError("a merge makes no token of the vocabulary")
        n = max(vocab.values(), default=0) + 1
        #: Of a made token its parts and the merge that makes it; symbols have been there before.
        self.left, self.right, self.made = [-1] * n, [-1] * n, [-1] * n
        #: The merge at which the state of u was copied without its arc v, by u << shift | v.
        self.shift, self.lost = n.bit_length(), {}
        there = {i for t, i in vocab.items() if t not in made}
        for r, (u, v) in enumerate(merges):
            self._gadget(r, vocab.get(u), vocab.get(v), vocab[u + v], there)
        #: Tokens with arcs, and every prefix of one, with the token where the prefix is one, else -1.
        known = {t: i for t, i in vocab.items() if i in there}
        self.reading = {t[:n]: -1 for t in known for n in range(1, len(t))} | known

    def _gadget(self, r: int, u: int | None, v: int | None, uv: int, there: set[int]) -> None:
        """Put in merge r, unless no path has u before v by then; there: tokens with arcs."""
        if u in there and v in there and self.arc(u, v):
            self.left[uv], self.right[uv], self.made[uv] = u, v, r
            self.lost[u << self.shift | v] = r
            there.add(uv)

    def arc(self, state: int, token: int) -> bool:
        """Whether the state that a token leads to has an arc for another, in the automaton as it is.

        By until the state is followed back: its copies from then on don't count. A copy has its original's arcs but
        the one it lost; a token made later has an arc where its left part had one by then; and the arcs of a made
        token led at first to where its right part did.
        """
        left, right, made, lost, shift, until = self.left, self.right, self.made, self.lost, self.shift, _NEVER
        while True:
            at = lost.get(state << shift | token)
            if at is not None and at < until:
                return False
            own, new = made[state], made[token]
            if new >= 0 and new >= own:
                token = left[token]
                if new < until:
                    until = new + 1
            elif own >= 0:
                state, until = right[state], own
            else:
                return True

    def encode(self, word: str) -> list[int]:
        """Token ids of a word of mapped bytes whose last character is END, if the vocabulary has word ends."""
        reading, arc, n = self.reading, self.arc, len(word)
        state = [-1] * (n + 1)
        last = [0] * (n + 1)
        for at in range(n):
            here = state[at]
            if here < 0 and at:
                continue
            to = at + 1
            while to <= n and (token := reading.get(word[at:to])) is not None:
                if token >= 0 and state[to] < 0 and (here < 0 or arc(here, token)):
                    state[to], last[to] = token, at
                to += 1
            if state[n] >= 0:
                break
        if n and state[n] < 0:
            raise ValueError(f"the vocabulary cannot spell {word!r}")
        out: list[int] = []
        while n:
            out.append(state[n])
            n = last[n]
        return out[::-1]


class WordTokenizer:
    """A tokenizer file with NFC, lower case, a splitting pattern, byte level and word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        marked = lambda t: t[: -len(suffix)] + END if suffix and t.endswith(suffix) else t
        self.automaton = MergeAutomaton({marked(t): i for t, i in model["vocab"].items()}, [(marked(u), marked(v)) for u, v in model["merges"]])
        self.end = END if suffix else ""
        self.labels = [""] * (max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for t, i in [*model["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]:
            self.labels[i] = t
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        chars = byte_chars()
        self.mapped = str.maketrans({chr(b): c for b, c in enumerate(chars)})
        self.known: dict[str, bytes] = {}
        self.path, self._library, self._plain = path, None, set()

    def _odd(self, part: str) -> bool:
        """Whether a character has no meaning in Python's tables; the library's may be of a later version."""
        new = set(part) - self._plain
        odd = {c for c in new if unicodedata.category(c) == "Cn"}
        self._plain |= new - odd
        return bool(odd)

    def _by_library(self, part: str) -> bytes:
        """The ids of a text with characters that Python's tables don't know: the file's own library splits it."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        out: list[int] = []
        for word, _ in self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(part)):
            out += self.automaton.encode(word + self.end)
        return struct.pack(f"<{len(out)}I", *out)

    def _packed(self, chunk: str) -> bytes:
        """The ids of a run without white space, or of any text, as little-endian 32-bit numbers."""
        out: list[int] = []
        for word in (chunk,) if chunk.isalpha() else self.pattern.findall(chunk):
            out += self.automaton.encode(word.encode().decode("latin-1").translate(self.mapped) + self.end)
        packed = struct.pack(f"<{len(out)}I", *out)
        if len(self.known) >= WORDS_KEPT:
            self.known.clear()
        if len(chunk) <= 64:
            self.known[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        found: list[bytes] = []
        for part in self.cut.split(text) if self.cut and "<" in text else (text,):
            if part in self.added:
                found.append(np.array([self.added[part]], "<u4").tobytes())
                continue
            if not part.isascii() and self._odd(part):
                found.append(self._by_library(part))
                continue
            if not unicodedata.is_normalized("NFC", part):
                part = unicodedata.normalize("NFC", part)
            part = part.replace("Σ", "σ").lower()  # the file's lower case knows no final sigma
            if _SEPARATORS.search(part):  # str.split() takes these for white space, the pattern doesn't
                found.append(self._packed(part))
                continue
            known = self.known
            found += [known.get(c) or self._packed(c) for c in part.split()]
        return b"".join(found)

    def decode(self, packed: bytes) -> str:
        """The labels of the arcs, with spaces between: the file has no decoder."""
        labels = self.labels
        return " ".join([labels[i] for i in np.frombuffer(packed, "<u4").tolist()])


_SEPARATORS = re.compile("[\x1c-\x1f]")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each whole text's token ids as packed little-endian unsigned 32-bit numbers.

    A null text counts as empty and has no ids. Repeated rows are encoded each for itself; other columns are ignored.
    """

    def run(batches):
        t = tokenizer(path)
        for b in batches:
            ids = [t.encode(x or "") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, ids binary")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): bpe_encode(), and the text that its ids decode to, in one pass over the texts."""

    def run(batches):
        t = tokenizer(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = [t.encode(x or "") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([t.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) from packed ids; null ids count as none."""

    def run(batches):
        t = tokenizer(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t.decode(x or b"") for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "decoded"])

    taken = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, decoded string")
