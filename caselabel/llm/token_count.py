"""Token counts by compiled finite-state transducers.

A tokenizer file of the word-end BPE kind is compiled into two deterministic
transducers whose transitions carry emitted-token counts.

* **Splitter.**  It reads character classes and emits the places where a word
  piece begins; it has nine states.  A chunk of text maps every entry state to an
  exit state.  All chunks of a batch are run in parallel from all states, their
  state maps are composed by a parallel prefix scan, and a second run from the
  true entry states yields the places.
* **Merger.**  It reads the bytes of a piece.  Byte-pair merging has this
  property: the last token of a prefix is the longest token that ends there and
  is compatible with the last token before it, two tokens being compatible when
  merging their symbols gives just these two.  So what the future can depend on
  is bounded: the suffix that may still grow into a token, with the last token
  and the relative count at each place in it.  That is the transducer's state.
  States and transitions are made when first met and kept; a transition emits
  the change of the prefix's token count, and the sum along a piece is its count.

Equal pieces of a batch are counted once, and counts of frequent ones are kept.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.llm import chars
from caselabel.llm import words as wd

LIMIT = 2048
CHUNK = 64
#: Merger states and remembered pieces of a worker; beyond them the tables start anew.
MAX_STATES, MAX_PIECES = 200_000, 500_000

#: White space as the tokenizer's pattern has it.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WORD_END = "</w>"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Character classes of the splitter.
SPACE, LETTER, ENDS, R, V, L, E, NUMBER, QUOTE, OTHER = range(10)
# Its states: after a space, inside letters, after a number, inside other signs, after a quote that may start a
# contraction, after 'r 'v and 'l, after a contraction.
START, WORD, DIGIT, SIGNS, MAYBE, MAYBE_R, MAYBE_V, MAYBE_L, SHORT = range(9)
_LETTERS = (LETTER, ENDS, R, V, L, E)
STATES, CLASSES = 9, 10


@cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """``next[class, state]`` and ``begins[class, state]``: bit 1, a piece begins here; bit 2, one began at the last place."""
    follow, begins = np.zeros((CLASSES, STATES), np.uint8), np.zeros((CLASSES, STATES), np.uint8)
    for state in range(STATES):
        for c in range(CLASSES):
            late, at = 0, state
            if state in (MAYBE_R, MAYBE_V, MAYBE_L):
                if c == {MAYBE_R: E, MAYBE_V: E, MAYBE_L: L}[state]:
                    follow[c, state] = SHORT
                    continue
                late, at = 2, WORD  # the quote stood alone and its letter began a word
            if c == SPACE:
                to, new = START, 0
            elif at == MAYBE and c in (ENDS, R, V, L):
                to, new = {ENDS: SHORT, R: MAYBE_R, V: MAYBE_V, L: MAYBE_L}[c], 0
            elif c in _LETTERS:
                to, new = WORD, int(at != WORD)
            elif c == NUMBER:
                to, new = DIGIT, 1
            elif at in (SIGNS, MAYBE):
                to, new = SIGNS, 0
            else:
                to, new = (MAYBE if c == QUOTE else SIGNS), 1
            follow[c, state], begins[c, state] = to, new | late
    return follow, begins


@cache
def class_table() -> np.ndarray:
    table = np.full(chars.POINTS, OTHER, np.uint8)
    table[chars.letters()] = LETTER
    table[chars.numbers()] = NUMBER
    table[_SPACES] = SPACE
    for letters, kind in (("stmd", ENDS), ("r", R), ("v", V), ("l", L), ("e", E), ("'", QUOTE)):
        table[[ord(x) for x in letters]] = kind
    return table


def scan_states(kinds: np.ndarray) -> np.ndarray:
    """State before each place, by chunk state maps and their parallel prefix scan."""
    follow, _ = splitter()
    n = len(kinds)
    chunks = -(-n // CHUNK)
    padded = np.zeros(chunks * CHUNK, np.uint8)
    padded[:n] = kinds
    grid = padded.reshape(chunks, CHUNK)
    flat = follow.reshape(-1).astype(np.intp)
    offset = grid.astype(np.intp).T * STATES
    maps = np.broadcast_to(np.arange(STATES), (chunks, STATES)).copy()
    for step in range(CHUNK):
        maps = flat[offset[step][:, None] + maps]
    # Inclusive scan by doubling: map i becomes the composition of all maps up to i.
    reach = 1
    while reach < chunks:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    state = np.zeros(chunks, np.intp)
    state[1:] = maps[:-1, START]
    out = np.empty((CHUNK, chunks), np.uint8)
    for step in range(CHUNK):
        out[step] = state
        state = flat[offset[step] + state]
    return out.T.reshape(-1)[:n]


def pieces(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every piece of some code points, the last of which must be a space."""
    _, begins = splitter()
    kinds = class_table()[points]
    marks = begins[kinds, scan_states(kinds)]
    first = (marks & 1).astype(bool)
    first[:-1] |= (marks[1:] & 2).astype(bool)
    start = np.flatnonzero(first)
    stops = first | (kinds == SPACE)
    ends = np.flatnonzero(stops)
    return start, ends[np.searchsorted(ends, start, side="right")]


class Merger:
    """Transducer from the bytes of a piece to its token count."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.rank = {pair: i for i, pair in enumerate(map(tuple, merges))}
        byte = _byte_names()
        self.byte = [byte[b] for b in range(256)]
        # Tokens as tuples of symbols; the last byte of a piece is a symbol of its own.
        self.parts: dict[str, tuple[str, ...]] = {}
        for token in vocab:
            end = token.endswith(_WORD_END) and len(token) > len(_WORD_END)
            letters = token[: -len(_WORD_END)] if end else token
            self.parts[token] = (*letters[:-1], letters[-1] + _WORD_END) if end else tuple(letters)
        self.whole = {self.parts[t]: t for t in vocab if self._merge(self.parts[t]) == [t]}
        self.growing = {p[:n] for p in self.whole for n in range(1, len(p) + 1)}
        self.fits: dict[tuple[str, str], bool] = {}
        self._clear()

    def _clear(self) -> None:
        # A state: the suffix that may grow, and for each place from its start to here (last token, count relative to here).
        self.states: list[tuple[tuple[str, ...], tuple[tuple[str | None, int], ...]]] = [((), ((None, 0),))]
        self.number = {self.states[0]: 0}
        self.next: dict[int, int] = {}
        self.emit: dict[int, int] = {}
        self.final: dict[int, int] = {}

    def _merge(self, symbols: tuple[str, ...]) -> list[str]:
        parts = list(symbols)
        while len(parts) > 1:
            ranked = [(self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best, _ = min(ranked)
            if best == 1 << 60:
                break
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and self.rank.get((parts[i], parts[i + 1])) == best:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def _compatible(self, before: str | None, token: str) -> bool:
        if before is None:
            return True
        known = self.fits.get((before, token))
        if known is None:
            known = self._merge(self.parts[before] + self.parts[token]) == [before, token]
            if len(self.fits) > 4 * MAX_STATES:
                self.fits.clear()
            self.fits[before, token] = known
        return known

    def _last(self, suffix: tuple[str, ...], trail: tuple[tuple[str | None, int], ...]) -> tuple[str, int]:
        """Last token of the prefix that ends with ``suffix``, and its count; ``trail`` ends one place before."""
        for begin in range(len(suffix)):
            token = self.whole.get(suffix[begin:])
            if token is not None:
                before, count = trail[begin]
                if self._compatible(before, token):
                    return token, count + 1
        raise ValueError(f"no token ends with {suffix[-1]!r}")

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        suffix, trail = self.states[state]
        suffix = (*suffix, self.byte[byte])
        token, count = self._last(suffix, trail)
        trail = (*trail, (token, count))
        skip = 0
        while suffix[skip:] and suffix[skip:] not in self.growing:
            skip += 1
        made = (suffix[skip:], tuple((t, c - count) for t, c in trail[skip:]))
        to = self.number.get(made)
        if to is None:
            to = self.number[made] = len(self.states)
            self.states.append(made)
        return to, count

    def count(self, piece: bytes) -> int:
        """Tokens of a piece that is not empty."""
        if len(self.states) > MAX_STATES:
            self._clear()
        state, total = 0, 0
        for byte in piece[:-1]:
            key = state << 8 | byte
            to = self.next.get(key)
            if to is None:
                to, self.emit[key] = self._step(state, byte)
                self.next[key] = to
            total += self.emit[key]
            state = to
        key = state << 8 | piece[-1]
        last = self.final.get(key)
        if last is None:
            suffix, trail = self.states[state]
            _, last = self._last((*suffix, self.byte[piece[-1]] + _WORD_END), trail)
            self.final[key] = last
        return total + last


def _byte_names() -> dict[int, str]:
    """Printable name of every byte in the file's vocabulary: its own character, or the next unused one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Tokenizer:
    """Compiled form of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        steps = [x.get("type") for x in data["normalizer"]["normalizers"]]
        split = data["pre_tokenizer"]["pretokenizers"][0]
        if model.get("end_of_word_suffix") != _WORD_END or steps != ["NFC", "Replace", "Lowercase"] or split["pattern"].get("Regex") != _SPLIT:
            raise ValueError(f"{path} is not of the word-end BPE kind that is compiled here")
        self.merger = Merger(model["vocab"], model["merges"])
        special = [x["content"] for x in data["added_tokens"] if x["special"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[int, int] = {}

    def _normal(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # the library folds letter by letter, without final forms
        return text.lower()

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        extra = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            if self.special is not None and "<|" in text and self.special.search(text):
                cut = self.special.split(text)
                extra[i] = len(cut) - 1
                parts += map(self._normal, cut)
                owner += [i] * len(cut)
            else:
                parts.append(self._normal(text))
                owner.append(i)
        points, first = chars.code_points(parts, "\n")
        if not len(points):
            return extra
        start, end = pieces(points)
        if not len(start):
            return extra
        # Pieces are told apart by the hash of their UTF-8 form.
        utf8 = np.frombuffer("\n".join([*parts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        low, high = place[start], place[end]
        hashes = wd.span_hashes(utf8, low, high)
        values, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > MAX_PIECES:
            self.known.clear()
        number = np.empty(len(values), np.int64)
        whole = utf8.tobytes()
        for i, (value, j) in enumerate(zip(values.tolist(), at.tolist(), strict=True)):
            count = self.known.get(value)
            if count is None:
                count = self.known[value] = self.merger.count(whole[low[j] : high[j]])
            number[i] = count
        part = np.searchsorted(first, start, side="right") - 1
        per_part = np.bincount(part, number[back], minlength=len(parts)).astype(np.int64)
        return extra + np.bincount(owner, per_part, minlength=len(texts)).astype(np.int64)


@cache
def compiled(path: str) -> Tokenizer:
    """One compiled tokenizer per worker."""
    return Tokenizer(path)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    _, offsets = wd.buffers(batch.column(1))
    for a, b in wd.slices(offsets):
        yield batch.slice(a, b - a), np.diff(offsets[a : b + 1])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``docs`` (``doc_id, text``).

    ``path`` is the tokenizer file on every worker.  Counts are those of its
    library for whole texts: without begin, end or added special tokens, special
    strings inside a text being one token each.  Null and empty texts have no
    bytes and no tokens; other columns are ignored.
    """

    def count(batches):
        tokenizer = compiled(path)
        for batch in batches:
            for piece, size in _texts(batch):
                tokens = tokenizer.counts([t or "" for t in piece.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
