"""Token ids of whole texts by a byte-level BPE file, fast enough for a corpus.

A text is cut at single spaces where the pre-tokenizer's pattern cuts in any case, and each distinct
piece is encoded once per worker (a table of bounded size). Pieces of ASCII and Latin letters are
encoded many at a time by a second library that holds the same vocabulary; all others, one
by one, by the library that the file belongs to. The ids are those of that library for the whole text.
"""

from __future__ import annotations

import json
from functools import cached_property

import numpy as np

from reviewmill.llm import arrays
from reviewmill.llm.arrays import U64

SPACES = (*range(9, 14), *range(28, 33))


def _is(*values: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


_SPACE = _is(*SPACES)
# Second-last bytes of the white space characters beyond ASCII; and their first bytes.
_MAYBE_SPACE_BEFORE = _is(0xC2, 0x80, 0x81, 0x9A)
_MAYBE_SPACE_AFTER = _is(0xC2, 0xE1, 0xE2, 0xE3)
FIRST_OTHER_BYTE = 0xCA  # first bytes from here on start characters above U+027F


def cuts(data: np.ndarray, bounds: np.ndarray):
    """Starts and ends of the pieces, and each row's first piece (one more entry than rows).

    A piece starts at a row's start and at each single space between two characters that are no
    white space by any definition; where that is in doubt there is no cut.
    """
    spaces = np.flatnonzero(data == 32)
    spaces = spaces[(spaces > 0) & (spaces < len(data) - 1)]
    before, after = data[spaces - 1], data[spaces + 1]
    far = data[np.maximum(spaces - 2, 0)]
    sure = ~_SPACE[before] & ~_SPACE[after] & ~_MAYBE_SPACE_AFTER[after]
    sure &= (before < 128) | ~_MAYBE_SPACE_BEFORE[far]
    spaces = spaces[sure]
    row_starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    # A space that starts or ends a row is no cut.
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    spaces = spaces[~edge[spaces] & ~edge[spaces + 1]]
    starts = np.sort(np.concatenate([row_starts, spaces]))
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, bounds)


class Coder:
    """Encodes slices of texts; keeps the ids of the pieces it has met."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model.get("added_tokens", ())}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in model["model"]["vocab"].items()
            if token not in special
        }
        self.latin = tiktoken.Encoding(
            "file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.starts_word = np.zeros(max(model["model"]["vocab"].values()) + 1, dtype=bool)
        self.starts_word[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.known = arrays.Numbering(20)
        self._clear()

    @cached_property
    def whole(self):
        """The file's own library; loaded for the first piece that needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def _clear(self) -> None:
        self.known.clear()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.offsets = np.zeros(1 << 16, np.int32)
        self.lengths = np.zeros(1 << 16, np.int32)

    def _learn(self, hashes, pieces: list[np.ndarray]) -> None:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self._store(hashes, np.concatenate(pieces), lengths)

    def _store(self, hashes, ids, lengths) -> None:
        n, used = self.known.size, self.used
        self.known.add(hashes)
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.lengths) < n + len(lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        self.ids[used : used + len(ids)] = ids
        self.lengths[n : n + len(lengths)] = lengths
        self.offsets[n : n + len(lengths)] = used + np.cumsum(lengths) - lengths
        self.used = used + len(ids)

    def _encode_new(self, data, starts, ends, hashes) -> None:
        """Encode pieces with distinct, unknown hashes."""
        view = memoryview(np.ascontiguousarray(data))
        spaces = np.concatenate([[0], np.cumsum(data == 32)])
        others = np.concatenate([[0], np.cumsum(data >= FIRST_OTHER_BYTE)])
        last, far = data[ends - 1], data[np.maximum(ends - 2, 0)]
        latin = others[ends] == others[starts]
        plain = latin & (data[starts] == 32) & (spaces[ends] - spaces[starts] == 1)
        plain &= ~_SPACE[last] & ((last < 128) | ~_MAYBE_SPACE_BEFORE[far])
        many = np.flatnonzero(plain)
        if len(many):
            text = b"".join(
                [view[s:e] for s, e in zip(starts[many].tolist(), ends[many].tolist())]
            ).decode()
            ids = np.asarray(self.latin.encode_ordinary(text), np.uint32)
            first = np.flatnonzero(self.starts_word[ids])
            if len(first) == len(many):
                self._store(hashes[many], ids, np.diff(np.append(first, len(ids))))
            else:
                plain[:] = False
        one_by_one = np.flatnonzero(~plain)
        if len(one_by_one):
            pieces = []
            for i in one_by_one:
                text = bytes(view[starts[i] : ends[i]]).decode()
                ids = (
                    self.latin.encode_ordinary(text)
                    if latin[i]
                    else self.whole.encode(text, add_special_tokens=False).ids
                )
                pieces.append(np.asarray(ids, np.uint32))
            self._learn(hashes[one_by_one], pieces)

    def encode(self, data: np.ndarray, bounds: np.ndarray):
        """All ids of the rows, one after the other, and where each row's ids start and end."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        starts, ends, first = cuts(data, bounds)
        hashes = arrays.Rolling(data).of(starts, ends)
        numbers = self.known.find(hashes)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if self.known.full(len(new)):
                self._clear()
                new = np.arange(len(hashes))
            distinct, where = np.unique(hashes[new], return_index=True)
            if self.known.full(len(distinct)):
                # More distinct pieces than the table holds: a row of its own, encoded directly.
                return self._directly(data, bounds)
            at = new[where]
            self._encode_new(data, starts[at], ends[at], distinct)
            numbers = self.known.find(hashes)
        lengths = self.lengths[numbers].astype(np.int64)
        ids = self.ids[arrays.gathered(self.offsets[numbers].astype(np.int64), lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, total[first]

    def _directly(self, data, bounds):
        rows = [
            np.asarray(
                self.whole.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids,
                np.uint32,
            )
            for a, b in zip(bounds[:-1], bounds[1:])
        ]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes.

    Printable bytes stand for themselves, the others for the letters from U+0100 on, in order.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def coder(path: str, pattern: str) -> Coder:
    """One coder per file and worker process."""
    kept = arrays.process_cache()
    if ("coder", path, pattern) not in kept:
        kept["coder", path, pattern] = Coder(path, pattern)
    return kept["coder", path, pattern]
