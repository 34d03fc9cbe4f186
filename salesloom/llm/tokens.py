"""Token ids from a tokenizer file, with a bounded cache of pieces of text in each Python worker.

A byte-level tokenizer never joins what stands before a white-space run with what follows, nor an ASCII letter with
ASCII punctuation beside it (but for apostrophes). Texts are cut at such places, and a piece that was seen before
costs a look-up instead of an encoding. Texts with white space other than single blanks and newlines, or with the
text of an added token, are encoded in one piece.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from salesloom.llm.words import groups, segment_hashes

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = True
BLANK = np.isin(np.arange(256), [0x20, 0x0A])
CONTROL = np.isin(np.arange(256), [*range(0x09), *range(0x0B, 0x20), 0x7F])  # white space among them
LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])                  # of all other white space in UTF-8
# UTF-8 of white space beyond ASCII, as leading bytes and last bytes.
WIDE_SPACE = {(0xC2, None): [0x85, 0xA0], (0xE1, 0x9A): [0x80], (0xE1, 0xA0): [0x8E],
              (0xE2, 0x80): [*range(0x80, 0x8C), 0xA8, 0xA9, 0xAF], (0xE2, 0x81): [0x9F], (0xE3, 0x80): [0x80]}
SLOTS = 1 << 20        # of the cache
AT_ONCE = 1000         # pieces given to the tokenizer
MOST_IDS = 1 << 23     # kept; the cache starts anew beyond
LONGEST = 64           # bytes of a piece that is kept


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.model.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(SLOTS, np.uint64)
        self.check = np.zeros(SLOTS, np.uint32)
        self.start = np.zeros(SLOTS, np.uint32)
        self.count = np.zeros(SLOTS, np.uint8)  # 0: the slot is free
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _fresh(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and how many each has."""
        found = []
        for i in range(0, len(texts), AT_ONCE):  # the tokenizer's own records are much larger than the ids
            batch = self.model.encode_batch_fast([t.decode() for t in texts[i:i + AT_ONCE]], add_special_tokens=False)
            found += [e.ids for e in batch]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def _append(self, ids: np.ndarray) -> int:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _odd(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which rows must be encoded in one piece."""
        blank = BLANK[data]
        bad = CONTROL[data]
        bad[1:] |= blank[1:] & blank[:-1]
        lead = np.flatnonzero(LEADS[data[:-1]]) if len(data) else np.zeros(0, np.int64)
        for (one, two), last in WIDE_SPACE.items():
            at = lead[data[lead] == one]
            if two is not None:
                at = at[at + 2 < len(data)]
                at = at[data[at + 1] == two] + 1
            bad[at[np.isin(data[at + 1], last)]] = True
        odd = np.diff(np.concatenate([[0], np.cumsum(bad)])[bounds]) > 0
        text = data.tobytes()
        for token in self.added:
            at = text.find(token)
            while at >= 0:
                odd[np.searchsorted(bounds, at, side="right") - 1] = True
                at = text.find(token, at + 1)
        return odd

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of each row."""
        if self.used > MOST_IDS:
            self._clear()
        odd = self._odd(data, bounds)
        letter, mark = LETTER[data], PUNCTUATION[data]
        cut = BLANK[data]
        cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        rows = np.flatnonzero(bounds[:-1] < bounds[1:])
        for row in np.flatnonzero(odd):
            cut[bounds[row]:bounds[row + 1]] = False
        cut[bounds[rows]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        values = data.astype(np.uint64) + np.uint64(1)
        h = segment_hashes(values, starts, 1)
        check = segment_hashes(values, starts, 2).astype(np.uint32)
        first, count = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        missing = np.ones(len(h), bool)
        for shift in (44, 22):  # two slots for each piece
            slot = (h >> np.uint64(shift)) & np.uint64(SLOTS - 1)
            hit = missing & (self.key[slot] == h) & (self.check[slot] == check) & (self.count[slot] > 0)
            first[hit], count[hit] = self.start[slot[hit]], self.count[slot[hit]]
            missing &= ~hit
        lost = np.flatnonzero(missing)
        if len(lost):
            _, one, back = np.unique(h[lost] ^ (check[lost].astype(np.uint64) << np.uint64(7)),
                                     return_index=True, return_inverse=True)
            new = lost[one]
            text = data.tobytes()
            ids, n = self._fresh([text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            at = self._append(ids) + np.cumsum(n) - n
            first[lost], count[lost] = at[back], n[back]
            keep = (n > 0) & (n < 256) & (ends[new] - starts[new] <= LONGEST)
            new, at, n = new[keep], at[keep], n[keep]
            slot = (h[new] >> np.uint64(44)) & np.uint64(SLOTS - 1)
            slot = np.where(self.count[slot] > 0, (h[new] >> np.uint64(22)) & np.uint64(SLOTS - 1), slot)
            # of pieces that want the same slot the last stays, in all four arrays
            _, last = np.unique(slot[::-1], return_index=True)
            last = len(slot) - 1 - last
            slot, new = slot[last], new[last]
            self.key[slot], self.check[slot] = h[new], check[new]
            self.start[slot], self.count[slot] = at[last], n[last]
        total = int(count.sum())
        behind = np.cumsum(count)
        ids = self.ids[np.repeat(first - behind + count, count) + np.arange(total)]
        pieces = np.searchsorted(starts, bounds)
        row_ends = np.concatenate([[0], behind])[pieces]
        for a, b in zip(row_ends[:-1].tolist(), row_ends[1:].tolist()):
            yield ids[a:b]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(path)


def encoded(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids (uint32) of each text of a string column, in order; null texts are empty."""
    one = encoder(path)
    for data, bounds in groups(column):
        yield from one.encode(data, bounds)
