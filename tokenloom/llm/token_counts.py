"""Operator 7, token counts: the tokenizer compiled into finite-state transducers.

Two deterministic transducers stand in for the library. The splitter reads character classes and
has a dozen states; its transitions are annotated with the pre-token boundaries that they settle.
The counter reads the bytes of a pre-token, and each of its transitions is annotated with the
change in the number of emitted tokens (a change may be negative: a byte can complete a token that
replaces several). Its states are the part of the encoding so far that a later token can still
reach back to; they are compiled when first met and held in a table of bounded size.

A batch of texts is one stream of characters cut into blocks. Every block is run from every state
of the splitter at once, which gives the block's map from entry to exit state; the maps are
composed by a parallel prefix scan, and with its entry state known each block emits its
boundaries. Pre-tokens then run through the counter in lockstep, and their annotations add up.

Defined results: NULL is an empty text (no bytes, no tokens); rows are counted row by row, so
repeated rows and equal or NULL ids do no harm; an empty table gives an empty table; only ``key``
and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches, text_column

#: Characters of a block of the prefix scan.
BLOCK = 64
#: States of the counter that are held; beyond it the table starts anew with those in use.
MAX_STATES = 100_000
#: Pre-tokens that are counted together, and so states in use at once.
TOGETHER = 49_152
#: Most tokens of a text that is not over the limit.
TOKEN_LIMIT = 512

# Classes of characters: the letters that contractions end in have classes of their own.
SPACE, BLANK, APOSTROPHE, SHORT, R, V, E, L, LETTER, NUMBER, OTHER, END = range(12)
CLASSES = 12
# States of the splitter: before a token; after one blank or several, the last a space or not;
# in letters, numbers or others; after an apostrophe that begins a token, and after its r, v or l.
START, ONE_SPACE, ONE_BLANK, SPACES, BLANKS, LETTERS, NUMBERS, OTHERS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
STATES = 12
# What a transition settles: a boundary before the character read, and one before the character before it.
HERE, BACK = 1, 2

LETTER_CLASSES = (SHORT, R, V, E, L, LETTER)


def _begin(kind: int) -> int:
    """State after the first character of a token."""
    if kind == SPACE:
        return ONE_SPACE
    if kind == BLANK:
        return ONE_BLANK
    if kind == APOSTROPHE:
        return QUOTE
    if kind in LETTER_CLASSES:
        return LETTERS
    return {NUMBER: NUMBERS, OTHER: OTHERS, END: START}[kind]


def _after_space(kind: int) -> int:
    """State after a space and a character that takes it into its token."""
    return LETTERS if kind in LETTER_CLASSES else NUMBERS if kind == NUMBER else OTHERS


def splitter_step(state: int, kind: int) -> tuple[int, int]:
    """(next state, boundaries settled) of the split pattern."""
    blank = kind in (SPACE, BLANK)
    if state == START:
        return _begin(kind), HERE
    if state in (ONE_SPACE, ONE_BLANK, SPACES, BLANKS):
        if blank:
            return SPACES if kind == SPACE else BLANKS, 0
        if kind == END:
            return START, HERE
        # A run of blanks gives up its last one: a space joins the next token, another blank stands alone.
        back = BACK if state in (SPACES, BLANKS) else 0
        if state in (ONE_SPACE, SPACES):
            return _after_space(kind), back
        return _begin(kind), back | HERE
    if state == QUOTE:
        if kind == SHORT:
            return START, 0
        if kind in (R, V, L):
            return {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind], 0
        if kind in (OTHER, APOSTROPHE):
            return OTHERS, 0
        return _begin(kind), HERE
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        if kind == (L if state == QUOTE_L else E):
            return START, 0
        # No contraction: the apostrophe was a token, and a letter run has begun.
        return (LETTERS, BACK) if kind in LETTER_CLASSES else (_begin(kind), BACK | HERE)
    inside = kind in LETTER_CLASSES if state == LETTERS else kind == NUMBER if state == NUMBERS else kind in (OTHER, APOSTROPHE)
    return (state, 0) if inside else (_begin(kind), HERE)


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    following, marks = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    for state in range(STATES):
        for kind in range(CLASSES):
            following[state, kind], marks[state, kind] = splitter_step(state, kind)
    return following.reshape(-1), marks.reshape(-1)


def class_table() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110001, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        found = "".join(regex.findall(pattern, points)).encode("utf-32-le")
        table[np.frombuffer(found, np.uint32)] = kind
    table[ord(" ")], table[ord("'")], table[0x110000] = SPACE, APOSTROPHE, END
    for characters, kind in (("stmd", SHORT), ("r", R), ("v", V), ("e", E), ("l", L)):
        for character in characters:
            table[ord(character)] = kind
    return table


class Splitter:
    """Pre-token boundaries of a stream of code points, by block maps and a prefix scan."""

    def __init__(self) -> None:
        self.following, self.marks = splitter_tables()
        self.classes = class_table()

    def entries(self, blocks: np.ndarray) -> np.ndarray:
        """State at the begin of every block (a row of classes)."""
        maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(blocks), 1))
        for i in range(blocks.shape[1]):
            # 16-bit keys suffice: states times classes are few.
            maps = self.following.take(maps.astype(np.uint16) * CLASSES + blocks[:, i, None])
        step = 1
        while step < len(maps):
            # Compose each map with the one that ends ``step`` blocks before: it is applied first.
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
            step *= 2
        return np.concatenate(([START], maps[:-1, START])).astype(np.uint8)

    def boundaries(self, points: np.ndarray) -> np.ndarray:
        """Whether a token begins at each character; END characters begin one too."""
        kinds = self.classes[points]
        count = -(-len(kinds) // BLOCK)
        padded = np.full(count * BLOCK, END, np.uint8)
        padded[: len(kinds)] = kinds
        blocks = padded.reshape(count, BLOCK)
        state = self.entries(blocks)
        marks = np.zeros((count, BLOCK), np.uint8)
        for i in range(BLOCK):
            key = state.astype(np.uint16) * CLASSES + blocks[:, i]
            marks[:, i] = self.marks.take(key)
            state = self.following.take(key)
        flat = marks.reshape(-1)
        begins = (flat & HERE).astype(bool)
        begins[:-1] |= (flat[1:] & BACK).astype(bool)
        return begins[: len(kinds)]


class Counter:
    """Transducer from the bytes of a pre-token to changes of its token count, compiled as it is used.

    The encoding of a prefix is known by its last token and the encoding before that token. So a
    state is: for every place that a later token may begin at (the text from there is a proper
    prefix of a token), the last token before the place and the count there, relative to now.
    Exactly one token may end at a new byte: the one that the pair rule allows after the last
    token before it.
    """

    def __init__(self, tokens: dict[bytes, int], merges: dict[tuple[bytes, bytes], int]):
        self.merges = merges
        self.prefixes = {token[:i] for token in tokens for i in range(1, len(token))}
        self.allowed: dict[tuple[bytes, bytes], bool] = {}
        self.tokens = {token for token in tokens if len(token) == 1 or self.encode(token) == [token]}
        self._restart()

    def _restart(self) -> None:
        # A state is a tuple of (text from a place to here, last token before the place, relative count).
        start = ((b"", b"", 0),)
        self.number = {start: 0}
        self.states = [start]
        self.table = np.full((256, 256), -1, np.int32)

    def encode(self, text: bytes) -> list[bytes]:
        """Tokens of a short text by the merges themselves."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.merges.get((parts[i], parts[i + 1]))
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: bytes, right: bytes) -> bool:
        """Whether both tokens stay as they are when they stand side by side."""
        key = (left, right)
        if key not in self.allowed:
            if len(self.allowed) > 2_000_000:
                self.allowed.clear()
            self.allowed[key] = not left or self.encode(left + right) == [left, right]
        return self.allowed[key]

    def _step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        added, places, last, change = bytes((byte,)), [], None, 0
        for text, before, count in state:
            longer = text + added
            if last is None and longer in self.tokens and self.may_follow(before, longer):
                last, change = longer, count + 1
            if longer in self.prefixes:
                places.append((longer, before, count))
        return tuple([*((text, before, count - change) for text, before, count in places), (b"", last, 0)]), change

    def _number(self, state: tuple) -> int:
        """The number of a state, which gets a row of the table if it is new."""
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            if len(self.states) > len(self.table):
                more = np.full((len(self.table), 256), -1, np.int32)
                self.table = np.concatenate((self.table, more))
        return self.number[state]

    def compile(self, keys: np.ndarray) -> None:
        """Fill the table for keys of state * 256 + byte."""
        for key in keys.tolist():
            state, change = self._step(self.states[key >> 8], key & 255)
            number = self._number(state)
            self.table[key >> 8, key & 255] = number << 8 | (change + 128)

    def count(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token raw[begin:end]; all run in lockstep, byte by byte."""
        counts = np.zeros(len(begins), np.int64)
        for start in range(0, len(begins), TOGETHER):
            part = slice(start, start + TOGETHER)
            counts[part] = self._lockstep(raw, begins[part], ends[part])
        return counts

    def _lockstep(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(begins), np.int64)
        active = np.flatnonzero(ends > begins)
        at, stop = begins[active], ends[active]
        state = np.zeros(len(active), np.int64)
        while len(active):
            keys = state * 256 + raw[at]
            moved = self.table.reshape(-1).take(keys)
            missing = np.unique(keys[moved < 0])
            if len(missing):
                if len(self.states) + len(missing) > MAX_STATES:
                    state = self._keep(state)
                    keys = state * 256 + raw[at]
                    missing = np.unique(keys)
                self.compile(missing)
                moved = self.table.reshape(-1).take(keys)
            counts[active] += (moved & 255) - 128
            at = at + 1
            going = at < stop
            active, at, stop, state = active[going], at[going], stop[going], (moved >> 8)[going]
        return counts

    def _keep(self, used: np.ndarray) -> np.ndarray:
        """Forget all states but the start and those in use; gives their new numbers."""
        numbers, place = np.unique(used, return_inverse=True)
        held = [self.states[number] for number in numbers.tolist()]
        self._restart()
        renamed = [self._number(state) for state in held]
        return np.array(renamed, np.int64)[place]


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int]]:
    """Tokens and merges of a byte-level vocabulary file, as bytes."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # The file writes a byte as a character: printable ones as they are, the others from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    to_byte = {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}

    def raw(token: str) -> bytes:
        return bytes(to_byte[character] for character in token)

    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
    merges = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
    tokens = {raw(token): number for token, number in model["vocab"].items() if all(c in to_byte for c in token)}
    return tokens, merges


class TokenCounter:
    """Both transducers of one vocabulary file; one per worker process."""

    _held: dict[str, TokenCounter] = {}

    def __init__(self, path: str):
        self.splitter = Splitter()
        self.counter = Counter(*read_vocabulary(path))
        with open(path, encoding="utf-8") as file:
            self.specials = [token["content"] for token in json.load(file).get("added_tokens", [])]

    @classmethod
    def of(cls, path: str) -> TokenCounter:
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The text cut at the special strings that the file adds, and how many there are: each is one token."""
        parts, found = [text], 0
        for special in self.specials:
            if special in text:
                cut = [part.split(special) for part in parts]
                found += sum(len(x) - 1 for x in cut)
                parts = [x for pieces in cut for x in pieces]
        return parts, found

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, tokens) of each text."""
        parts, owner, tokens = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own, found = self.pieces(text)
            tokens[i] += found
            parts += own
            owner += [i] * len(own)
        points = np.frombuffer("\0".join([*parts, ""]).encode("utf-32-le"), np.uint32).copy()
        if not len(points):
            return np.zeros(len(texts), np.int64), tokens
        lengths = np.array([len(part) for part in parts], np.int64)
        stops = np.cumsum(lengths + 1) - 1
        points[stops] = 0x110000
        begins = np.flatnonzero(self.splitter.boundaries(points))
        # The stream of bytes has a zero byte for each END; the place of a character in it follows from the widths.
        raw = np.frombuffer("\0".join([*parts, ""]).encode("utf-8"), np.uint8)
        ends_here = points == 0x110000
        widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        widths[ends_here] = 1
        places = np.concatenate(([0], np.cumsum(widths)))
        stop = np.append(begins[1:], len(points))
        real = ~ends_here[begins]
        begins, stop = begins[real], stop[real]
        counts = self.counter.count(raw, places[begins], places[stop])
        part_of = np.searchsorted(stops, begins)
        np.add.at(tokens, np.array(owner, np.int64)[part_of], counts)
        sizes = np.array([len(text.encode("utf-8")) for text in texts], np.int64)
        return sizes, tokens


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """Rows (key, n_bytes, n_tokens, over_limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.of(path)
        for batch in small_batches(batches, "text", 2 << 20):
            sizes, tokens = counter.count(text_column(batch))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes), pa.array(tokens)], names=["key", "n_bytes", "n_tokens"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op7_token_counts")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(documents(spark, folder), default_vocabulary())
