"""Token ids by public tokenizers, each distinct piece encoded once per worker.

Both vocabularies cut a text into pieces that no merge crosses. Where the cuts
can be told from plain characters the pieces are looked up in a bounded memory
of this worker; any other text is encoded whole. Either way the ids are those of
the tokenizer for the whole text, which the tests compare.

Plain characters are one byte each in Latin-1. Byte pieces are cut there by array
operations over many texts at once, and each distinct one is looked up once.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from stormledger.llm.common import remember

# A task has one core; the library would otherwise start threads of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 800_000
#: Letters that the quick cut knows: ASCII, and Latin letters that stay one letter when folded or composed.
LATIN = "a-zA-ZÀ-ÖØ-öø-ÿ"
#: Texts of these characters only are cut here.
PLAIN = re.compile(rf"[{LATIN}0-9\x20\n!-/:-@\[-`{{-~]*+\Z")
#: A word piece: contractions first, then letters, one digit, or anything else but space.
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^\s{LATIN}0-9]+")
#: A byte piece: one space may lead; of a run of white space all but the last goes first.
BYTE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")
#: What ends each of several texts that are cut together; no plain text holds it.
END = b"\0"
SPACE, LETTER, DIGIT, OTHER, BETWEEN = range(5)
#: Characters of texts that are cut together; a longer text is cut alone.
CUT_TOGETHER = 1 << 20


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"[ \n]"), (LETTER, f"[{LATIN}]"), (DIGIT, "[0-9]"), (BETWEEN, END.decode())):
        kinds[[ord(c) for c in map(chr, range(256)) if re.match(pattern, c)]] = kind
    return kinds


KINDS = _kinds()
PLAIN_BYTES = bytes(b for b in range(256) if PLAIN.match(chr(b)))


def byte_starts(raw: bytes) -> np.ndarray:
    """Where the pieces of ``BYTE`` start in plain texts, each ended by ``END``, which is a piece of its own."""
    c = np.frombuffer(raw + END * 3, np.uint8)
    kind = KINDS[c]
    starts = np.r_[True, kind[1:] != kind[:-1]] | (kind == BETWEEN)
    # The last of a run of white space goes with what follows if it is a space, else alone.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != BETWEEN))
    starts[last] = True
    starts[last[c[last] == ord(" ")] + 1] = False
    quote = np.flatnonzero((c == ord("'")) & starts)
    a, b = c[quote + 1], c[quote + 2]
    one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    starts[quote[one | two] + 1] = False
    behind = np.r_[quote[one] + 2, quote[two] + 3]
    starts[behind[kind[behind] == LETTER]] = True
    return np.flatnonzero(starts[: len(raw)])


def _shown() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(others)}


class Memory(dict):
    """Ids of a piece as 16-bit little-endian bytes, encoded on first sight by the tokenizer's model; anew when there are too many.

    A piece needs no more cutting, so the model alone gives its ids, in about half the time of a whole call.
    """

    SHOWN = _shown()

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize

    def __missing__(self, piece: str | bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        text = piece if isinstance(piece, str) else piece.decode("latin-1")
        shown = text.encode().decode("latin-1").translate(self.SHOWN)
        ids = self[piece] = array("H", [token.id for token in self.tokenize(shown)]).tobytes()
        return ids


class Encoder:
    """Ids of whole texts by one tokenizer file."""

    def __init__(self, path: str, cut: re.Pattern, fold: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.cut, self.fold = Tokenizer.from_file(path), cut, fold
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids beyond 16 bits")
        self.memory = Memory(self.tokenizer)

    def pieces(self, text: str) -> list[str] | None:
        """The pieces of a text that can be cut here, else None."""
        if "<|" in text or not PLAIN.match(text):
            return None
        return self.cut.findall(text.lower() if self.fold else text)

    def _cut_together(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts in Latin-1."""
        raw = END.join([*texts, b""])
        at = byte_starts(raw)
        offsets = np.append(at, len(raw)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        # Through NumPy, as to_pylist takes longer than the lookups.
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [b"" if piece == END else self.memory[piece] for piece in distinct]
        taken = pa.array(known, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[1 : len(at) + 1] // 2
        ids = np.frombuffer(taken.buffers()[2] or b"", "<u2")[: int(ends[-1])]
        return np.split(ids, ends[np.frombuffer(raw, np.uint8)[at] == END[0]])[: len(texts)]

    def _stream_together(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for text in texts:
            text = text or ""
            raw = text.encode("latin-1", "replace")
            # What Latin-1 lacks became a question mark, so the text would not read back.
            if "<|" in text or raw.translate(None, PLAIN_BYTES) or raw.decode("latin-1") != text:
                yield from self._cut_together(held) if held else ()
                held, size = [], 0
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")
                continue
            held.append(raw)
            size += len(raw)
            if size >= CUT_TOGETHER:
                yield from self._cut_together(held)
                held, size = [], 0
        yield from self._cut_together(held) if held else ()

    def stream(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Little-endian 16-bit ids of each text, without special tokens; null counts as empty."""
        remember(self.memory)
        if self.cut is BYTE:
            yield from self._stream_together(texts)
            return
        known = self.memory.__getitem__
        for text in texts:
            text = text or ""
            pieces = self.pieces(text)
            if pieces is None:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")
            else:
                yield np.frombuffer(b"".join(map(known, pieces)), "<u2")

    def ids(self, text: str) -> np.ndarray:
        return next(self.stream([text]))


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(name: str, cut: re.Pattern, fold: bool) -> Encoder:
    key = (name, fold)
    if key not in _ENCODERS:
        path = name
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _ENCODERS[key] = Encoder(path, cut, fold)
    return _ENCODERS[key]


def word_encoder(name: str = "word_bpe_49k.json") -> Encoder:
    """The lower-casing vocabulary that drops white space."""
    return _encoder(name, WORD, True)


def byte_encoder(name: str = "byte_bpe_50k.json") -> Encoder:
    return _encoder(name, BYTE, False)
