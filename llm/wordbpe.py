"""Encoding with a ``tokenizers`` file, remembering words.

The tokenizer's pre-tokens never cross a space or a line feed, so a text's ids are those of its chunks between them, one
after the other.  A chunk of plain Latin characters is cut further into the tokenizer's own pre-tokens, by numpy over the bytes
of many texts at once.  All units (pre-tokens, and the other chunks whole) are dictionary encoded by Arrow, so each
different one is looked up once a slice, and new ones alone reach the library; the id runs are then gathered by numpy.
Chunks with apostrophes (contractions), control strings, other scripts or combining marks are units of their own.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa

ID = "<u4"                        # ids as little-endian unsigned 32-bit integers
KEEP_UNITS = 1_000_000            # entries of the memory in a task (about 200 bytes each)
REST_UNITS = 250_000              # and between tasks, as a pool may hold more workers than run
KEEP_SHARE, LONGEST = 0.4, 48     # share that stays when it is full, bytes of an entry
SLICE_BYTES = 4 << 20             # bytes of text encoded at once (one text at least)

# --- fixed values: the file's pre-token pattern for lower-case Latin text without white space ---
LETTERS = "a-zß-öø-ÿ"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+"
PLAIN = "[!-~À-ÖØ-öø-ÿ]+"
#: the byte-level alphabet: printable Latin-1 bytes are their own letters, the others follow from 256 on in order
OWN_LETTERS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# ------------------------------------------------------------------------------------------------


BYTE_LETTERS = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(OWN_LETTERS)))}

GAP, LETTER, DIGIT, OTHER, ODD = range(5)
LEAD = 0xC3                       # the first byte of the Latin-1 letters; their second one is that of the character less 0x40


def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: its kind, and its lower-case form; by second byte after ``LEAD``: whether it is a letter."""
    kind, low = np.full(256, ODD, np.uint8), np.arange(256, dtype=np.uint8)
    kind[0x21:0x7F] = OTHER
    for c in range(0x21, 0x7F):
        if chr(c).isalpha():
            kind[c], low[c] = LETTER, ord(chr(c).lower())
        elif chr(c).isdigit():
            kind[c] = DIGIT
    kind[[ord(" "), ord("\n")]] = GAP
    letter = np.zeros(256, bool)
    for c in range(0xC0, 0x100):
        letter[c - 0x40] = chr(c).isalpha()
    return kind, low, letter


KIND, LOW, SECOND = _kinds()


def _thinned(memory: dict[bytes, bytes], most: int, share: float | None = None) -> dict[bytes, bytes]:
    """A full memory keeps its oldest entries: frequent words are met early."""
    return memory if len(memory) <= most else dict(islice(memory.items(), int(most * (KEEP_SHARE if share is None else share))))


def units(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in a row, cut into units: their bytes without gaps (lower case in plain chunks), where each unit
    begins there, and the number of units before each text.  ``ends``: where each text begins, and the end."""
    kind, low = KIND[data], LOW[data]
    lead = np.flatnonzero(data == LEAD)
    lead = lead[lead + 1 < len(data)]
    lead = lead[SECOND[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = LETTER
    second = data[lead + 1]
    low[lead + 1] = np.where(second < 0x9F, second + 0x20, second)      # capitals come 0x20 before their letters
    word = kind != GAP
    fresh = np.empty(len(data), bool)                                   # after a gap, or a text's first byte
    fresh[1:] = ~word[:-1]
    fresh[ends[:-1][ends[:-1] < len(data)]] = True
    start = np.flatnonzero(word & fresh)
    if not len(start):
        return data[:0], start, np.zeros(len(ends), np.int64)
    odd = (kind == ODD) | (data == ord("'"))
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    strange = np.add.reduceat(odd, start, dtype=np.int64) > 0
    turn = np.empty(len(data), bool)                                    # a pre-token begins inside a plain chunk
    turn[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    turn[0] = False
    inner = np.flatnonzero(turn & word & ~fresh)
    inner = inner[~strange[np.searchsorted(start, inner, "right") - 1]]
    begin = np.sort(np.concatenate([start, inner]), kind="stable")
    before = np.cumsum(word, dtype=np.int32) - word                     # bytes kept before each
    size = np.diff(np.append(before[start], before[-1] + word[-1]))
    kept = np.where(np.repeat(strange, size), data[word], low[word])
    return kept, before[begin], np.searchsorted(begin, ends)


class WordEncoder:
    """``column(texts)`` gives all ids of an Arrow column and where each text's end, equal to the library's on the whole text."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.known: dict[bytes, bytes] = {}
        self.plain = re.compile(PLAIN).fullmatch
        self.split = re.compile(PIECES).findall

    def whole(self, text: str) -> bytes:
        """The library's ids of a text."""
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, ID).tobytes()

    def _piece(self, piece: str) -> list[int]:
        """A pre-token straight through the library's merge model, in the model's letters for bytes."""
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.model.tokenize(letters)]

    def _ids(self, unit: bytes) -> bytes:
        text = unit.decode("utf-8", "replace")
        if text.isascii() and text.isalpha():
            ids = [t.id for t in self.model.tokenize(text.lower())]
        elif "<|" in text or not self.plain(text):
            return self.whole(text)
        else:
            ids = [i for piece in self.split(text.lower()) for i in self._piece(piece)]
        return array("I", ids).tobytes()

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (null texts: none), and the number of ids up to the end of each text."""
        if texts.null_count:
            texts = texts.fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        kept, begin, before = units(data, ends - ends[0])
        if not len(begin):
            return np.empty(0, ID), np.zeros(len(texts), np.int64)
        offsets = np.append(begin, len(kept)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
        different, known = coded.dictionary.to_pylist(), self.known
        ids = list(map(known.get, different))
        for k, found in enumerate(ids):
            if found is None:
                unit = different[k]
                ids[k] = self._ids(unit)
                if len(unit) <= LONGEST:
                    known[unit] = ids[k]
        self.known = _thinned(known, KEEP_UNITS)
        flat = np.frombuffer(b"".join(ids), ID)
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, at = np.cumsum(n) - n, coded.indices.to_numpy()
        runs = n[at]
        total = np.concatenate([[0], np.cumsum(runs)])
        out = flat[np.repeat(first[at] - total[:-1], runs) + np.arange(total[-1])]
        return out, total[before[1:]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The id bytes of each text (null: none)."""
        ids, ends = self.column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def rest(self) -> None:
        """At the end of a task: an idle worker keeps only its oldest entries."""
        self.known = _thinned(self.known, REST_UNITS, 1)


def ended(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text, and where each text then ends."""
    return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    return WordEncoder(path)


def slices(texts: list, most: int = 4 << 20):
    """``(start, end)`` of runs of texts of about ``most`` characters together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size > most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def column_slices(texts: pa.Array, most: int = SLICE_BYTES):
    """``(start, end)`` of runs of texts of a column of at most ``most`` bytes together (one text at least)."""
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, int(ends[a]) + most, "right")) - 1)
        yield a, b
        a = b
