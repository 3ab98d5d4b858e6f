"""Token ids of whole texts, by a tokenizer of the ``tokenizers`` library.

A tokenizer spends its time on words it has met before. Texts are therefore cut at
blanks, where no token crosses, and each piece is encoded once per worker as long as
it stays in a bounded store. New words of Latin letters go straight to the tokenizer's model, as
what comes before it is known for them; other new pieces are encoded many at a time, as
one text with a mark between them. The ids equal those of the whole text.

Null is an empty text. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable
from typing import TYPE_CHECKING

from presscheck.llm.tables import text_bytes
from presscheck.llm.worker import kept as kept_by_worker

if TYPE_CHECKING:
    import numpy as np

# Pieces that a worker keeps, of about 200 bytes each.
PIECES = 700_000
# New pieces that are encoded as one text.
TOGETHER = 2_000
END_ID = 1
# Characters other than blank and line end that are white space, beyond the first 128.
WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# A piece with a blank at its head at most: a line end before and after it is a token of its own.
PLAIN = re.compile(r" ?\S+")

# Words of letters that are one code point each, composed and in lower case too.
WORD = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _byte_characters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary."""
    import numpy as np

    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    characters = np.zeros(256, "<u4")
    characters[own] = own
    others = np.setdiff1d(np.arange(256), own)
    characters[others] = 256 + np.arange(len(others))
    return characters


def _punctuation() -> np.ndarray:
    """True for the bytes of ASCII punctuation."""
    import numpy as np

    table = np.zeros(256, bool)
    for first, last in ("!/", ":@", "[`", "{~"):
        table[ord(first) : ord(last) + 1] = True
    return table


def _character(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the characters begin that hold the bytes at ``at``."""
    import numpy as np

    for _ in range(3):
        at = np.where((data[at] & 0xC0) == 0x80, at - 1, at)
    return at


def _is_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the characters that begin at ``at`` are white space."""
    import numpy as np

    lead = data[at]
    space = (lead == 32) | (lead >= 9) & (lead <= 13) | (lead >= 28) & (lead <= 31)
    two, three = np.flatnonzero(lead == 0xC2), np.flatnonzero((lead >= 0xE1) & (lead <= 0xE3))
    space[two] = np.isin(data[at[two] + 1], [x for x in WIDE_SPACES if x < 0x100])
    a, b, c = (data[at[three] + k].astype(np.int64) & 63 for k in range(3))
    space[three] = np.isin((a & 15) << 12 | b << 6 | c, WIDE_SPACES)
    return space


def _ends_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the bytes at ``at`` end a letter of those in ``WORD``."""
    import numpy as np

    last, before = data[at], data[np.maximum(at - 1, 0)]
    small = last | 0x20
    wide = (last >= 0x80) & (last < 0xC0) & (before >= 0xC3) & (before <= 0xC5)
    wide &= ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7)) | (before == 0xC4) & (last == 0xB0))
    return (small >= 0x61) & (small <= 0x7A) | wide


class Encoder:
    """Ids as bytes, four per id and little-endian, with ``END_ID`` at each text's end.

    With ``blanks`` a token may begin with a blank, and only single blanks between two
    other characters are cut at. Without, the tokenizer drops white space, and every
    blank or line end is a cut.
    """

    def __init__(self, path: str, blanks: bool, pieces: int = PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.blanks, self.pieces = blanks, pieces
        # Two halves of the store: pieces of this turn and of the turn before.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.end = _packed([END_ID])
        # The mark is one token, and only its own character makes that token.
        self.mark = "\n" if blanks else " \x01 "
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.model, self.characters = self.tokenizer.model, _byte_characters()
        # How words are folded before the model, or none if the model does not get them as they are.
        self.fold = next((fold for fold in (str, str.lower) if self._takes_words(fold)), None)

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where pieces begin, the bytes of all pieces one after the other, and where each lies in these."""
        import numpy as np

        begins = np.zeros(len(data) + 1, bool)
        begins[bounds] = True
        blank = np.flatnonzero((data == 32) | (data == 10))
        if self.blanks:
            # Single ones between two other characters of a text.
            at = blank[~begins[blank] & ~begins[blank + 1]]
            at = at[~(_is_space(data, at + 1) | _is_space(data, _character(data, at - 1)))]
        # No token holds a Latin letter and then ASCII punctuation.
        mark = np.flatnonzero(_punctuation()[data])
        mark = mark[~begins[mark]]
        begins[mark[_ends_letter(data, mark - 1)]] = True
        if self.blanks:
            begins[at] = True
            begins[at[data[at] == 10] + 1] = True
            start = np.flatnonzero(begins[:-1])
            return start, data, np.append(start, len(data))
        begins[blank + 1] = True
        begins[blank] = False
        start = np.flatnonzero(begins[:-1])
        kept = np.delete(data, blank)
        return start, kept, np.append(start - np.searchsorted(blank, start), len(kept))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, ends = self.encode_flat(texts)
        packed, ends = ids.tobytes(), (ends * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text ends.

        Equal pieces are found on Arrow's side, so only different ones become strings here.
        """
        import numpy as np
        import pyarrow as pa

        data, bounds = text_bytes(pa.array(texts, pa.large_string()))
        start, kept, offsets = self._pieces(data, bounds)
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept)]
        coded = pa.Array.from_buffers(pa.large_string(), len(start), buffers).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self._lookup(pieces)
        found.append(self.end)

        last = np.searchsorted(start, bounds[1:])
        codes = np.insert(coded.indices.to_numpy(zero_copy_only=False), last, len(found) - 1)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        each = sizes[codes]
        stop = np.cumsum(each)
        # Id by id: its place in ``flat``.
        places = np.repeat(first[codes] - (stop - each), each)
        places += np.arange(len(places))
        return flat[places], stop[last + np.arange(len(texts))] if len(texts) else last

    def _lookup(self, pieces: list[str]) -> list[bytes]:
        found = list(map(self.known.get, pieces))
        new = [piece for piece, ids in zip(pieces, found) if ids is None]
        if not new:
            return found
        if 2 * (len(self.known) + len(new)) > self.pieces:
            # Pieces that do not come up again go with the next turn.
            self.before, self.known = self.known, {}
        self._learn(self._unknown(new))
        known = self.known
        return [known[piece] if ids is None else ids for piece, ids in zip(pieces, found)]

    def _unknown(self, pieces: list[str]) -> list[str]:
        """Those of the pieces that are not in the older half of the store either; the others are taken over."""
        found = list(map(self.before.get, pieces))
        self.known.update((piece, ids) for piece, ids in zip(pieces, found) if ids is not None)
        return [piece for piece, ids in zip(pieces, found) if ids is None]

    def _learn(self, missing: list[str]) -> None:
        if self.fold:
            words = list(filter(WORD.fullmatch, missing))
            self.known.update(zip(words, self._by_model(words, self.fold), strict=True))
            missing = list(set(missing).difference(words))
        if self.blanks:
            plain = [p for p in missing if PLAIN.fullmatch(p)]
        else:
            plain = [p for p in missing if "\x01" not in p]
        for start in range(0, len(plain), TOGETHER):
            some = plain[start : start + TOGETHER]
            self.known.update(zip(some, self._together(some), strict=True))
        other = list(set(missing).difference(plain)) if len(plain) < len(missing) else []
        found = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        self.known.update(zip(other, [_packed(e.ids) for e in found]))

    def _by_model(self, words: list[str], fold: Callable[[str], str]) -> list[bytes]:
        """The ids of words that are one piece for the model each."""
        import numpy as np

        if not words:
            return []
        # A line end is one byte and in no word.
        data = np.frombuffer(fold("\n".join(words)).encode(), np.uint8)
        spelled = self.characters[data].tobytes().decode("utf-32-le").split(chr(self.characters[10]))
        tokenize = self.model.tokenize
        return [_packed([token.id for token in tokenize(word)]) for word in spelled]

    def _takes_words(self, fold: Callable[[str], str]) -> bool:
        """Whether the model alone gives the ids of words, tried on every letter and on all of them in one word."""
        if any(WORD.fullmatch(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()):
            return False
        letters = [c for c in map(chr, range(0x180)) if WORD.fullmatch(c)]
        words = [*letters, *[f"a{c}e" for c in letters], "".join(letters)]
        if self.blanks:
            words += [f" {word}" for word in words]
        whole = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return self._by_model(words, fold) == [_packed(e.ids) for e in whole]

    def _together(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces without a mark in them."""
        import numpy as np

        (found,) = self.tokenizer.encode_batch_fast([self.mark.join(pieces)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        packed, marks = ids.tobytes(), (np.flatnonzero(ids == self.mark_id) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *[m + 4 for m in marks]], [*marks, len(packed)])]


def encoder(path: str, blanks: bool) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept_by_worker(f"encoder {path} {blanks}", lambda: Encoder(path, blanks))
