"""Token ids of whole texts by a serialized tokenizer, with a memory of words.

Texts are taken together: their bytes are cut into the words of the tokenizer's own
rule, Arrow finds the distinct words, each new one is encoded by the tokenizer's model,
and Arrow puts the ids in the places of the words. Words behind a blank are encoded many
in a row, as byte-level BPE never joins text across the start of a blank-led word.
Characters whose class could differ between the rule's tables and those of this
interpreter are not cut by it: what lies between the blanks around them goes to the
tokenizer as it is. So do whole texts if the tokenizer has another rule, and texts that
hold a token added to the vocabulary, which it finds before it looks for words.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Bytes of the words and ids in a worker's memory. Of a full one, the words of the texts at
#: hand are kept. Only speed depends on it.
MEMORY_BYTES = 8 << 20
#: Words that the model encodes in one call.
ROW_WORDS = 64
#: What stands for a blank in a byte-level vocabulary.
BLANK = "\u0120"
#: Characters whose class has long been settled: Latin ones and marks of punctuation.
SETTLED = "\t\n\r -~\xa1-\u024f\u2010-\u2027\u2030-\u205e"
#: Classes of characters; those from ``STRANGE`` on are not settled.
END, SPACE, WHITE, LETTER, NUMBER, MARK, STRANGE, STRANGE_WHITE = range(8)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each character; ``END`` is not among them."""
    out = np.full(0x110000, STRANGE, dtype=np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for at, c in enumerate(map(chr, range(0x3001))):
        settled = re.fullmatch(f"[{SETTLED}]", c)
        if c.isspace():
            out[at] = SPACE if c == " " else WHITE if settled else STRANGE_WHITE
        elif settled:
            out[at] = kinds.get(unicodedata.category(c)[0], MARK)
    return out


def classes_of(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of valid UTF-8 belongs to."""
    table = classes()
    out = table[:256][data]
    rest = data & 0x3F
    for first, last, more, bits in ((0xC0, 0xDF, 1, 0x1F), (0xE0, 0xEF, 2, 0x0F), (0xF0, 0xFF, 3, 0x07)):
        lead = np.flatnonzero((data >= first) & (data <= last))
        point = (data[lead] & bits).astype(np.int32)
        for i in range(1, more + 1):
            point = point << 6 | rest[lead + i]
        kind = table[point]
        for i in range(more + 1):
            out[lead + i] = kind
    return out


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start in the UTF-8 bytes of texts, each with one byte behind it (at ``ends``).

    The rule of byte-level BPE: endings behind an apostrophe; letters, numbers or marks with
    or without a blank before them; runs of white space, less the last before something
    visible. Also whether a word is a blank and settled visible characters, and whether it
    holds characters that are not settled. The bytes behind the texts are words.
    """
    kind = classes_of(data)
    kind[ends] = END
    before = np.concatenate(([np.uint8(END)], kind[:-1]))
    after = np.concatenate((kind[1:], [np.uint8(END)]))
    white, white_before = (kind == SPACE) | (kind == WHITE), (before == SPACE) | (before == WHITE)
    start = np.where(white, ~white_before | (after >= LETTER), (before != SPACE) & (before != kind))
    # endings: an apostrophe that starts a word, and the letters behind it
    marks = np.flatnonzero((data == ord("'")) & start)
    one, two = (data[np.minimum(marks + i, len(data) - 1)] for i in (1, 2))
    short = np.isin(one, list(b"stmd"))
    long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e"))
    long |= (one == ord("l")) & (two == ord("l"))
    start[marks[short | long] + 1] = False
    start[np.concatenate((marks[short] + 2, marks[long] + 3))] = True
    start[ends] = True
    start[0] = True
    start[ends[:-1] + 1] = True
    strange = np.flatnonzero(kind >= STRANGE)
    if len(strange):
        # no cuts but those before blanks that follow something visible
        cut = (kind == SPACE) & ~white_before & (before != STRANGE_WHITE)
        cut[ends] = cut[0] = True
        cut[ends[:-1] + 1] = True
        at = np.flatnonzero(cut)
        held = np.zeros(len(at), dtype=bool)
        held[np.searchsorted(at, strange, "right") - 1] = True
        inside = np.repeat(held, np.diff(np.append(at, len(data))))
        start &= cut | ~inside
        starts = np.flatnonzero(start)
        odd = inside[starts]
    else:
        starts = np.flatnonzero(start)
        odd = np.zeros(len(starts), dtype=bool)
    follows = after[starts]
    return starts, (kind[starts] == SPACE) & (follows >= LETTER) & (follows <= MARK) & ~odd, odd


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible
    Latin-1 characters for themselves, the others are counted on from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]


def binaries(ends: np.ndarray, data: bytes | np.ndarray) -> pa.Array:
    """Values that lie one behind the other in ``data``; ``ends`` begins with 0."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(ends, dtype=np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def ends_of(values: pa.Array) -> np.ndarray:
    """Where binaries start in their buffer, and the end of the last."""
    return np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]


class Encoder:
    """``encode(texts)``: the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenize = self.model.tokenize
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.points = np.array([ord(c) for c in self.letters], dtype="<u4")
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        words, model = rules.get("pre_tokenizer") or {}, rules["model"]
        plain = rules.get("normalizer") is None and words.get("type") == "ByteLevel"
        plain = plain and words.get("use_regex", True) and not words.get("add_prefix_space")
        #: whether the model's own words are those of this module
        self.direct = bool(plain and model.get("type") == "BPE" and not model.get("dropout"))
        self.direct = self.direct and all(c in model["vocab"] for c in self.letters)
        if self.direct:
            byte = {c: b for b, c in enumerate(self.letters)}
            inside = [t for t in model["vocab"] if BLANK in t[1:] and t.strip(BLANK) and set(t) <= byte.keys()]
            texts = [bytes(byte[c] for c in t).decode(errors="ignore") for t in inside]
            #: whether each token with a blank inside also holds what no word in a row does
            self.in_rows = all(any(classes()[ord(c)] >= STRANGE for c in t) for t in texts)
            #: whether an id begins with a blank
            self.led = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
            self.led[[i for t, i in model["vocab"].items() if t[:1] == BLANK]] = True
        self.forget()

    def forget(self) -> None:
        #: words, and their ids in the same order
        self.words = pa.array([], pa.large_binary())
        self.memory = pa.array([], pa.large_binary())

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        """Ids of one word by the model alone."""
        found = self.tokenize("".join([self.letters[b] for b in word]))
        return array("I", [t.id for t in found]).tobytes()

    def _rows(self, words: pa.Array) -> pa.Array:
        """Ids of words that are a blank and visible characters, many encoded in a row."""
        ends = ends_of(words)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        spelled = self.points[data].tobytes().decode("utf-32-le")
        cuts = [*(ends[:-1:ROW_WORDS] - ends[0]).tolist(), len(spelled)]
        tokenize = self.tokenize
        ids = np.array([t.id for a, b in zip(cuts, cuts[1:]) for t in tokenize(spelled[a:b])], dtype="<u4")
        starts = np.flatnonzero(self.led[ids]) if len(ids) else np.empty(0, np.int64)
        if len(starts) != len(words):
            raise ValueError("words in a row were not encoded one by one")
        return binaries(4 * np.append(starts, len(ids)), ids.tobytes())

    def _new(self, words: pa.Array, odd: np.ndarray) -> pa.Array:
        """Ids of words one by one; ``odd`` ones hold characters that are not settled."""
        out = []
        for word, strange in zip(words.to_numpy(zero_copy_only=False), odd.tolist(), strict=True):
            text = word.decode() if strange else ""
            out.append(self._plain(text) if text and not text.removeprefix(" ").isalpha() else self._word(word))
        return pa.array(out, pa.large_binary())

    def _distinct(self, words: pa.Array, row: np.ndarray, odd: np.ndarray) -> pa.Array:
        """Ids of distinct words, from the memory or encoded now."""
        at = pc.index_in(words, value_set=self.words)
        row = row & self.in_rows
        new = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        rows, others = np.flatnonzero(new & row), np.flatnonzero(new & ~row)
        at[rows] = len(self.words) + np.arange(len(rows))
        at[others] = len(self.words) + len(rows) + np.arange(len(others))
        led, rest = words.take(pa.array(rows)), words.take(pa.array(others))
        known = pa.concat_arrays([self.memory, self._rows(led), self._new(rest, odd[others])])
        out = known.take(pa.array(at))
        self.words, self.memory = pa.concat_arrays([self.words, led, rest]), known
        if self.words.nbytes + self.memory.nbytes > MEMORY_BYTES:
            self.words, self.memory = words, out
            if words.nbytes + out.nbytes > MEMORY_BYTES:
                self.forget()
        return out

    def _together(self, texts: list[str]) -> list[bytes]:
        parts = [t.encode() for t in texts]
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        joined = b"\0".join([*parts, b""])
        starts, row, odd = words_of(np.frombuffer(joined, np.uint8), ends)
        words = binaries(np.append(starts, len(joined)), joined)
        # the bytes behind the texts are no words
        stops = np.searchsorted(starts, ends)
        keep = np.ones(len(starts), dtype=bool)
        keep[stops] = False
        places = words.dictionary_encode()
        index = places.indices.to_numpy()
        kinds = np.zeros((2, len(places.dictionary)), dtype=bool)
        kinds[0, index], kinds[1, index] = row, odd
        ids = self._distinct(places.dictionary, *kinds).take(pa.array(index[keep]))
        at = ends_of(ids)[np.concatenate(([0], stops - np.arange(len(stops))))].tolist()
        view = memoryview(ids.buffers()[2] or b"")
        return [bytes(view[a:b]) for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [not self.direct or any(a in t for a in self.added) for t in texts]
        together = [t for t, alone in zip(texts, whole, strict=True) if not alone]
        found = iter(self._together(together) if together else ())
        return [self._plain(t) if alone else next(found) for t, alone in zip(texts, whole, strict=True)]


@contextmanager
def borrowed(path: str) -> Iterator[Encoder]:
    """The worker's encoder for one task; the words it remembers go with the task."""
    one = encoder(path)
    try:
        yield one
    finally:
        one.forget()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
