"""Token counts by a finite-state tokenizer.

A byte-level BPE tokenizer is compiled into two deterministic transducers.

The first cuts text into pieces. It reads classes of characters and marks where a piece starts.
A batch is cut into chunks; for each chunk the map from every entry state to its exit state is
computed, all chunks in step, and a prefix scan composes these maps, which gives each chunk its
true entry state.

The second reads the bytes of a piece and emits a change of the token count on each transition.
After i bytes it knows, for each earlier position from which a token may still run on, the last
token of the encoding up to there. The last token up to position i + 1 is the one token t that
ends there and may follow the last token before t, that is, whose two tokens BPE leaves as they
are. States are made when text first reaches them and kept in a table of bounded size. All pieces
of a batch run in step; each starts in the first state, so no chunk map is needed.

Defined cases: a null text has no bytes and no tokens, as the empty text. A special token's string
inside a text is that one token, as the library's default has it. Texts of any length are whole.
Rows are independent, so ties and repeated rows each get their own count; an empty table gives an
empty result. Extra columns of the input are not read.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.batches import Texts, map_texts

# Classes of characters. END stands after each text; SPECIAL is a special token's string.
LETTER, CLOSES, OPENS, E_LETTER, L_LETTER, DIGIT, BLANK, SPACE, QUOTE, OTHER, END, SPECIAL, MORE = range(13)
N_CLASSES = 13
# States of the first transducer.
(START, IN_LETTERS, IN_DIGITS, IN_OTHER, ONE_BLANK, ONE_SPACE, ENDS_BLANK, ENDS_SPACE, AFTER_QUOTE,
 AFTER_OPENS, AFTER_L, CLOSED, IN_SPECIAL) = range(13)
N_STATES = 13
# What a transition marks: a piece starts here, a piece started one character before.
HERE, BEFORE = 1, 2

CHUNK = 1024
WARM_UP = 8


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for contractions, runs of letters, digits, others, and white space.

    A run of white space leaves its last character to what follows: a blank joins the next run,
    any other stands alone.
    """
    to, marks = np.zeros((N_STATES, N_CLASSES), np.uint8), np.zeros((N_STATES, N_CLASSES), np.uint8)
    letters = (LETTER, CLOSES, OPENS, E_LETTER, L_LETTER)
    fresh = {c: IN_LETTERS for c in letters} | {
        DIGIT: IN_DIGITS, BLANK: ONE_BLANK, SPACE: ONE_SPACE, QUOTE: AFTER_QUOTE,
        OTHER: IN_OTHER, END: START, SPECIAL: IN_SPECIAL, MORE: IN_SPECIAL}
    for s in range(N_STATES):
        for c, state in fresh.items():
            to[s, c], marks[s, c] = state, HERE
        marks[s, MORE] = 0
    joins = {c: IN_LETTERS for c in letters} | {DIGIT: IN_DIGITS, OTHER: IN_OTHER, QUOTE: IN_OTHER}
    for c in letters:
        marks[IN_LETTERS, c] = 0
    marks[IN_DIGITS, DIGIT] = 0
    for s in (IN_OTHER, AFTER_QUOTE):
        for c in (OTHER, QUOTE):
            to[s, c], marks[s, c] = IN_OTHER, 0
    for c, state in ((CLOSES, CLOSED), (OPENS, AFTER_OPENS), (L_LETTER, AFTER_L)):
        to[AFTER_QUOTE, c], marks[AFTER_QUOTE, c] = state, 0
    for s, last in ((AFTER_OPENS, E_LETTER), (AFTER_L, L_LETTER)):
        to[s], marks[s] = to[IN_LETTERS], marks[IN_LETTERS] | BEFORE
        to[s, last], marks[s, last] = CLOSED, 0
    for c, state in joins.items():
        to[ONE_BLANK, c], marks[ONE_BLANK, c] = state, 0
        to[ENDS_BLANK, c], marks[ENDS_BLANK, c] = state, BEFORE
        marks[ENDS_SPACE, c] = HERE | BEFORE
    for s in (ONE_BLANK, ONE_SPACE, ENDS_BLANK, ENDS_SPACE):
        to[s, BLANK], marks[s, BLANK] = ENDS_BLANK, 0
        to[s, SPACE], marks[s, SPACE] = ENDS_SPACE, 0
    return to, marks


def _class_of(c: str) -> int:
    if c in "stmd":
        return CLOSES
    if c in "rv":
        return OPENS
    if c == "e":
        return E_LETTER
    if c == "l":
        return L_LETTER
    if c == "'":
        return QUOTE
    if c == " ":
        return BLANK
    if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
        return SPACE
    kind = unicodedata.category(c)[0]
    return LETTER if kind == "L" else DIGIT if kind == "N" else OTHER


@functools.cache
def character_classes() -> np.ndarray:
    return np.fromiter((_class_of(chr(i)) for i in range(0x110000)), np.uint8, 0x110000)


class Splitter:
    """The first transducer, run over all chunks of an array of classes in step."""

    def __init__(self):
        self.to, self.marks = _transitions()
        self.flat = (self.to.astype(np.uint16) * N_CLASSES).ravel()

    def chunk_maps(self, grid: np.ndarray) -> np.ndarray:
        """Exit state of each chunk (a row of `grid`) for each entry state."""
        n = len(grid)
        states = np.tile(np.arange(N_STATES, dtype=np.uint16) * N_CLASSES, (n, 1))
        for k in range(min(WARM_UP, grid.shape[1])):
            states = self.flat[states + grid[:, k, None]]
        # Most chunks forget their entry state in a few characters and need one run from then on.
        same = (states == states[:, :1]).all(axis=1)
        for rows, width in ((np.flatnonzero(same), 1), (np.flatnonzero(~same), N_STATES)):
            run, columns = states[rows, :width], grid[rows]
            for k in range(WARM_UP, grid.shape[1]):
                run = self.flat[run + columns[:, k, None]]
            states[rows] = run
        return states // N_CLASSES

    @staticmethod
    def entry_states(maps: np.ndarray, first: int = START) -> np.ndarray:
        """Entry state of each chunk: the maps before it, composed by a prefix scan."""
        scan = maps.astype(np.intp)
        step = 1
        while step < len(scan):
            scan[step:] = np.take_along_axis(scan[step:], scan[:-step].copy(), axis=1)
            step *= 2
        return np.concatenate([[first], scan[:-1, first]])

    def piece_starts(self, classes: np.ndarray) -> np.ndarray:
        """For each character whether a piece starts there."""
        n = len(classes)
        rows = -(-n // CHUNK)
        grid = np.full(rows * CHUNK, END, np.uint8)
        grid[:n] = classes
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK))
        entry = self.entry_states(self.chunk_maps(grid)) if rows > 1 else np.zeros(1, np.intp)
        state = entry.astype(np.uint16) * N_CLASSES
        flat_marks, out = self.marks.ravel(), np.empty((CHUNK, rows), np.uint8)
        columns = np.ascontiguousarray(grid.T)
        for k in range(CHUNK):
            at = state + columns[k]
            out[k] = flat_marks[at]
            state = self.flat[at]
        marked = np.ascontiguousarray(out.T).ravel()[:n]
        starts = (marked & HERE) != 0
        starts[:-1] |= (marked[1:] & BEFORE) != 0
        return starts


class Full(Exception):
    """The table of states has no room left."""


class CountMachine:
    """The second transducer. Its states are made when needed, at most `limit` of them.

    An entry of its table holds the next state and the change of the count, in a field that is wide
    enough for the longest token: between two places that one token spans, the counts differ by
    less than its bytes.
    """

    MISSING = -1

    def __init__(self, tokens: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int],
                 limit: int = 1 << 17):
        self.ranks, self.limit = ranks, limit
        self.bytes_of = {i: t for t, i in tokens.items()}
        self.child: dict[int, int] = {}
        self.token_at, self.inner = [-1], [False]
        for token, number in tokens.items():
            node = 0
            for b in token:
                key = node << 8 | b
                if (below := self.child.get(key)) is None:
                    below = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = below
            self.token_at[node] = number
        self.fits: dict[tuple[int, int], bool] = {}
        self.bias = max(map(len, tokens), default=1)
        self.width = (2 * self.bias).bit_length()
        self.reset()

    def reset(self) -> None:
        first = ((-1, 0, 0),)
        self.states, self.keys = {first: 0}, [first]
        kind = np.int32 if self.limit << max(self.width, 8) < 1 << 31 else np.int64
        self.table = np.full((min(1024, self.limit), 256), self.MISSING, kind)

    def merged(self, text: bytes) -> list[bytes]:
        """Plain BPE of a short text."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1),
                       key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def may_follow(self, last: int, token: int) -> bool:
        known = self.fits.get((last, token))
        if known is None:
            own = self.bytes_of[token]
            before = [] if last < 0 else [self.bytes_of[last]]
            known = self.merged(b"".join(before) + own) == before + [own]
            if len(self.fits) >= 1 << 20:
                self.fits.clear()
            self.fits[(last, token)] = known
        return known

    def make(self, state: int, byte: int) -> int:
        """Work out one transition."""
        live, found = [], None
        for last, node, count in self.keys[state]:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            token = self.token_at[below]
            if found is None and token >= 0 and self.may_follow(last, token):
                found = (token, count + 1)
            if self.inner[below]:
                live.append((last, below, count))
        if found is None:
            raise ValueError("no token ends here; the vocabulary lacks a byte")
        token, change = found
        key = (*((last, node, count - change) for last, node, count in live), (token, 0, 0))
        to = self.states.get(key)
        if to is None:
            to = len(self.keys)
            if to >= self.limit:
                raise Full
            if to >= len(self.table):
                more = np.full((min(len(self.table) * 2, self.limit), 256), self.MISSING,
                               self.table.dtype)
                more[:len(self.table)] = self.table
                self.table = more
            self.states[key] = to
            self.keys.append(key)
        self.table[state, byte] = entry = to << self.width | (change + self.bias)
        return entry

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        while True:
            try:
                return self._counts(data, starts, lengths)
            except Full:
                # Begin anew with an empty table; one that a single slice fills must grow.
                if len(self.keys) == getattr(self, "stuck", None):
                    self.limit *= 2
                self.stuck = len(self.keys)
                self.reset()

    def _counts(self, data, starts, lengths):
        order = np.argsort(-lengths, kind="stable")
        at, lengths = starts[order], lengths[order]
        total = np.zeros(len(order), np.int32)
        state = np.zeros(len(order), self.table.dtype)
        change = (1 << self.width) - 1
        steps = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        for k, n in enumerate(active.tolist()):
            key = (state[:n] << 8) | data[at[:n] + k]
            entry = self.table.ravel()[key]
            missing = entry < 0
            if missing.any():
                for pair in np.unique(key[missing]).tolist():
                    self.make(pair >> 8, pair & 255)
                entry = self.table.ravel()[key]
            total[:n] += (entry & change) - self.bias
            state[:n] = entry >> self.width
        out = np.empty(len(order), np.int64)
        out[order] = total
        self.stuck = None
        return out


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class FiniteStateTokenizer:
    """Both transducers of a byte-level BPE tokenizer file (.json of `tokenizers`)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = _byte_letters()
        plain = lambda token: bytes(letters[c] for c in token)
        special = [t["content"] for t in content["added_tokens"]]
        vocabulary = {plain(t): i for t, i in content["model"]["vocab"].items() if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, (left, right) in enumerate(pairs):
            ranks.setdefault((plain(left), plain(right)), rank)
        self.special = re.compile("|".join(
            re.escape(s) for s in sorted(special, key=len, reverse=True)).encode()) if special else None
        self.splitter, self.machine = Splitter(), CountMachine(vocabulary, ranks)
        self.classes = character_classes()

    def count(self, texts: Texts) -> np.ndarray:
        """Tokens of each row."""
        data, n = texts.data, len(texts)
        if not len(data):
            return np.zeros(n, np.int64)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kinds = self.classes[code]
        if self.special and b"<" in (raw := data.tobytes()):
            ends = set(texts.offsets.tolist())
            for m in self.special.finditer(raw):
                if not any(m.start() < e < m.end() for e in ends & set(range(m.start(), m.end()))):
                    low, high = np.searchsorted(heads, [m.start(), m.end()])
                    kinds[low:high] = MORE
                    kinds[low] = SPECIAL
        # An END after each text: what follows is not seen from within it.
        row_starts = np.searchsorted(heads, texts.offsets)
        shift = np.repeat(np.arange(n), np.diff(row_starts))
        where = np.arange(len(kinds)) + shift
        stream = np.full(len(kinds) + n, END, np.uint8)
        stream[where] = kinds
        starts = self.splitter.piece_starts(stream)[where]
        at = heads[starts]
        kind = kinds[starts]
        rows = shift[starts]
        lengths = np.diff(np.append(at, len(data)))
        ordinary = kind != SPECIAL
        tokens = np.ones(len(at), np.int64)
        tokens[ordinary] = self.machine.counts(data, at[ordinary], lengths[ordinary])
        return texts.row_sums(tokens, rows)


@functools.cache
def tokenizer(path: str) -> FiniteStateTokenizer:
    """One per process and file."""
    return FiniteStateTokenizer(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens and over_limit (more than `limit` tokens) of each row's text.

    `path` names the tokenizer's file on each executor. One pass without a shuffle.
    """
    def work(slices):
        machine = tokenizer(path)
        for t in slices:
            counts = machine.count(t)
            yield pa.RecordBatch.from_arrays(
                [t.values("_key"), pa.array(np.diff(t.offsets)), pa.array(counts)],
                ["_key", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    counted = map_texts(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text",
                        f"_key {kind}, n_bytes bigint, n_tokens bigint", work)
    return counted.select(F.col("_key").alias(key), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
