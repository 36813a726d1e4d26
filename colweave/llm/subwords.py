"""Subword ids of whole text columns from a public byte-level BPE file.

Every distinct piece of text between two pre-token boundaries is encoded once by the tokenizers
library and remembered by its bytes; boundaries are found for a whole column at once. Ids equal
those of `Tokenizer.encode(text, add_special_tokens=False)`. Texts with characters whose class is
not plain here (other than ASCII, Latin letters with accents and a few signs), or with the text of
a special token, go through the library whole.
"""

from __future__ import annotations

import numpy as np

from colweave.llm import textops as T

SPACE, LETTER, DIGIT, OTHER, PLAIN_ONLY = 0, 1, 2, 3, 4
_CLASS = np.full(256, PLAIN_ONLY, np.uint8)
_CLASS[0x21:0x7F] = OTHER
_CLASS[[0x20, 9, 10, 13]] = SPACE
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[ord("A") : ord("Z") + 1] = LETTER
_CLASS[ord("a") : ord("z") + 1] = LETTER
_CLASS[0x80:0xC0] = LETTER  # continues a letter, or is set anew below
_CLASS[[0xC2, 0xC3, 0xC4, 0xC5]] = LETTER
_CLASS_C2 = np.full(256, PLAIN_ONLY, np.uint8)
_CLASS_C2[[0xA1, 0xA7, 0xA9, 0xAB, 0xB0, 0xB7, 0xBB, 0xBF]] = OTHER
#: The sign by which the vocabulary writes each byte: printable Latin-1 as it is, others from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SIGNS = np.arange(256, dtype="<u2")
BYTE_SIGNS[sorted({*range(256)} - {*_SHOWN})] = np.arange(0x100, 0x200 - len(_SHOWN))
#: Distinct pieces, and their bytes, that a worker remembers before the ones not met since are dropped.
#: Twice as many are held at most, which is about 70 MB.
MOST_PIECES, MOST_PIECE_BYTES = 160_000, 16 << 20


class Encoder:
    """One per Python worker and tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        """Drops the remembered pieces."""
        self.known: dict[bytes, bytes] = {}  # ids as 32-bit numbers
        self.before: dict[bytes, bytes] = {}
        self.held = 0

    def _learn(self, pieces: list[bytes], got: list[bytes | None]) -> None:
        """Fills in the ids of the pieces that have None, all signs written at once."""
        new = [i for i, ids in enumerate(got) if ids is None]
        signs = BYTE_SIGNS[np.frombuffer(b"".join([pieces[i] for i in new]), np.uint8)].tobytes().decode("utf-16-le")
        tokenize, at, flat, ends = self.model.tokenize, 0, [], []
        for i in new:
            to = at + len(pieces[i])
            flat += [t.id for t in tokenize(signs[at:to])]
            ends.append(4 * len(flat))
            at = to
        raw, at = np.array(flat, np.int32).tobytes(), 0
        for i, to in zip(new, ends, strict=True):
            got[i] = raw[at:to]
            self._remember(pieces[i], got[i])
            at = to

    def _remember(self, piece: bytes, ids: bytes) -> None:
        if len(self.known) >= MOST_PIECES or self.held > MOST_PIECE_BYTES:
            self.known, self.before, self.held = {}, self.known, 0
        self.known[piece] = ids
        self.held += len(piece) + len(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and where each row's ids begin (one more than rows)."""
        data = np.ascontiguousarray(data)
        kind, odd = _classes(data, offsets)
        raw = data.tobytes()
        for special in self.specials:
            at = raw.find(special)
            while at >= 0:
                odd[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(special, at + 1)
        starts = _starts(data, offsets, kind)
        bounds = T.per_row(starts, offsets)
        ends = np.append(starts[1:], len(data))
        rows = T.rows_of(bounds)
        if odd.any():
            plain = ~odd[rows]
            starts, ends, rows = starts[plain], ends[plain], rows[plain]
        ids, lengths = self._pieces(raw, data, starts, ends)
        counts = np.bincount(rows, lengths, len(offsets) - 1).astype(np.int64)
        if odd.any():
            ids, counts = self._whole(raw, offsets, odd, ids, counts)
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def _pieces(self, raw: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        found = T.cut_out(data, starts, ends).dictionary_encode()
        pieces, number = found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False)
        got = list(map(self.known.get, pieces))
        if None in got:
            if self.before:
                for i, ids in enumerate(got):
                    if ids is None and (ids := self.before.get(pieces[i])) is not None:
                        got[i] = ids
                        self._remember(pieces[i], ids)
            self._learn(pieces, got)
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        flat = np.frombuffer(b"".join(got), np.int32)
        begin = np.cumsum(size) - size
        lengths = size[number]
        before = np.cumsum(lengths) - lengths
        return flat[np.repeat(begin[number] - before, lengths) + np.arange(lengths.sum())], lengths

    def _whole(self, raw: bytes, offsets: np.ndarray, odd: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        rows = np.flatnonzero(odd)
        strings = [raw[offsets[r] : offsets[r + 1]].decode() for r in rows]
        got = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in strings]
        cuts = (np.cumsum(counts) - counts)[rows]
        parts, at = [], 0
        for cut, x in zip(cuts, got, strict=True):
            parts += [ids[at:cut], np.array(x, np.int32)]
            at = cut
        counts[rows] = [len(x) for x in got]
        return np.concatenate([*parts, ids[at:]]), counts


def _classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte, and which rows have characters without one."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data == 0xC2)
    kind[lead] = kind[lead + 1] = _CLASS_C2[data[lead + 1]]
    lead = np.flatnonzero(data == 0xC3)
    sign = lead[(data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7)]
    kind[sign] = kind[sign + 1] = OTHER
    odd = np.zeros(len(offsets) - 1, bool)
    odd[np.searchsorted(offsets, np.flatnonzero(kind == PLAIN_ONLY), "right") - 1] = True
    return kind, odd


def _starts(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pieces begin: a run of letters, digits or signs takes one blank before it; of white
    space before it the last character is a piece of its own, else the run is one."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    last = np.append(first[1:], True)
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = data[:-1] == 0x20
    blank_before &= ~first
    space = kind == SPACE
    start = change & (space | ~blank_before)
    start[:-1] |= space[:-1] & ~last[:-1] & ~space[1:]
    quotes = np.flatnonzero((data == 0x27) & start)
    if len(quotes):
        begin = np.append(offsets[1:], n)[np.searchsorted(offsets[1:], quotes, "right")]
        one, two = data[np.minimum(quotes + 1, n - 1)], data[np.minimum(quotes + 2, n - 1)]
        pair = lambda a, b: (one == ord(a)) & (two == ord(b)) & (quotes + 2 < begin)
        long = pair("r", "e") | pair("v", "e") | pair("l", "l")
        short = np.isin(one, list(b"stmd")) & (quotes + 1 < begin)
        for hit, k in ((quotes[short], 2), (quotes[long & ~short], 3)):
            start[hit + 1] = False
            after = hit[hit + k < n] + k
            start[after] |= ~first[after] & (kind[after] == LETTER)
    return np.flatnonzero(start)
