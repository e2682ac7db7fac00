"""Token ids of many texts at once, from a table of the pieces seen.

A space and the letters after it are a piece of byte-level BPE whatever stands
before them, if an ASCII character that is no letter, or the end, follows. Texts
are cut around these words; each word, and what stands between two words, is
encoded by itself. All steps but the encoding of new pieces work on arrays, and
pieces are known by their bytes, not by a hash of them.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a piece that the table takes; longer ones are encoded each time.
WIDTH = 24

#: Bytes of a text beyond which it is encoded by itself, and of texts that are taken at once.
LONG_TEXT, AT_ONCE = 4 << 20, 1 << 18

#: Places that are looked at for a piece, and what is put in a row for one call of the tokenizer.
PROBES, ROW = 12, 64

_BYTES = np.arange(256, dtype=np.uint8)
_ASCII_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128)
_LEAD = (_BYTES >= 0xC3) & (_BYTES <= 0xC5)  # of the letters from U+00C0 to U+017F, and of the signs × and ÷ between them
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Pieces:
    """Ids of texts as `encode` (one text) gives them, remembering at most `most` pieces: some 80 bytes each."""

    def __init__(self, tokenizer, encode, added: list[str], joinable: bool, most: int):
        self.tokenizer, self.encode, self.added, self.joinable, self.most = tokenizer, encode, added, joinable, most
        self.bits = max(8, (2 * most - 1).bit_length())
        self.table = np.zeros((1 << self.bits, 4), np.uint64)  # three words of bytes; 256 * number + bytes
        self.remembered = 0
        self.begin, self.n = np.zeros(1024, np.int64), np.zeros(1024, np.int64)  # of each numbered piece: where its ids are
        self.ids, self.used = np.zeros(4096, "<u4"), 0

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of `texts` (none null) one after another, and the edges between texts."""
        texts = texts.cast(pa.large_string())
        edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        if edges[-1] == edges[0]:
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        out, ends, first = [], [np.zeros(1, np.int64)], 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + AT_ONCE, "right")) - 1)
            ids, own = self._some(texts.slice(first, last - first), edges[first : last + 1])
            out.append(ids)
            ends.append(ends[-1][-1] + own)
            first = last
        return np.concatenate(out), np.concatenate(ends)

    def _some(self, texts: pa.Array, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a few texts, and the end of each."""
        whole = np.diff(edges) > LONG_TEXT if self.joinable else np.ones(len(texts), bool)
        for content in self.added:
            whole = whole | pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        low, size = int(edges[0]), int(edges[-1] - edges[0])
        data = np.zeros(size + WIDTH + 8, np.uint8)
        data[:size] = np.frombuffer(texts.buffers()[2], np.uint8, size, low)
        edges = edges - low
        cuts = np.sort(np.concatenate([edges, *self._words(data, size, edges, whole)]), kind="stable")
        lengths = np.diff(cuts)
        starts, lengths = cuts[:-1][lengths > 0], lengths[lengths > 0]
        numbers = self._numbers(data, starts, lengths)
        sizes = self.n[numbers]
        after = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[numbers] - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0)]
        return ids, np.append(0, after)[np.searchsorted(starts, edges[1:])]

    def _words(self, data: np.ndarray, size: int, edges: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words that the table takes begin, with their space, and where they end."""
        text = data[:size]
        letter = _ASCII_LETTER[text]
        lead = np.flatnonzero(_LEAD[text])
        letter[lead] = True
        letter[lead + 1] = (text[lead] != 0xC3) | ((text[lead + 1] != 0x97) & (text[lead + 1] != 0xB7))
        stops = np.flatnonzero(~letter)
        space = text[stops] == 32
        starts, ends = stops[space], np.append(stops[1:], size)[: len(stops)][space]
        within = np.searchsorted(starts, edges) - 1  # the last word that begins before each edge goes no further
        np.minimum.at(ends, within[within >= 0], edges[within >= 0])
        edge = np.zeros(size + 1, bool)
        edge[edges] = True
        taken = (ends - starts > 1) & (ends - starts <= WIDTH) & (edge[ends] | (data[ends] < 128))
        if whole.any():
            taken &= ~whole[np.searchsorted(edges, starts, "right") - 1]
        return starts[taken], ends[taken]

    def _numbers(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each piece; new ones are encoded, and remembered while there is room."""
        at = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        keys = np.empty((len(starts), 4), np.uint64)
        for k in range(3):
            keys[:, k] = at[starts + 8 * k] & _MASKS[np.clip(lengths - 8 * k, 0, 8)]
        keys[:, 3] = lengths
        mixed = (keys * _MIX).sum(axis=1, dtype=np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX[0]
        slots = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        numbers = self._found(keys, slots, lengths <= WIDTH)
        missing = np.flatnonzero(numbers < 0)
        if not len(missing):
            return numbers
        raw, first = data.tobytes(), {}
        names = [raw[a:b] for a, b in zip(starts[missing].tolist(), (starts + lengths)[missing].tolist(), strict=True)]
        for k, name in enumerate(names):
            first.setdefault(name, k)
        names_once = sorted(first, key=lambda name: len(name) > WIDTH)
        kept = min(self.most - self.remembered, sum(len(name) <= WIDTH for name in names_once))
        ids = self._learn(names_once)
        own = {name: self.remembered + k for k, name in enumerate(names_once)}
        numbers[missing] = [own[name] for name in names]

        # the ids of pieces that aren't kept stand behind the others until the next texts come
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.begin, self.n = (_room(x, self.remembered + len(n)) for x in (self.begin, self.n))
        self.begin[self.remembered : self.remembered + len(n)] = self.used + np.cumsum(n) - n
        self.n[self.remembered : self.remembered + len(n)] = n
        self.ids = _room(self.ids, self.used + int(n.sum()))
        self.ids[self.used : self.used + int(n.sum())] = np.frombuffer(b"".join(ids), "<u4")
        if kept:
            rows = missing[[first[name] for name in names_once[:kept]]]
            self._keep(keys[rows], slots[rows])
            self.used += int(n[:kept].sum())
        return numbers

    def _found(self, keys: np.ndarray, slots: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """The numbers of those of the pieces that the table holds, else -1."""
        numbers, left = np.full(len(keys), -1, np.int64), np.flatnonzero(asked)
        for probe in range(PROBES):
            rows = self.table[(slots[left] + probe) & (len(self.table) - 1)]
            same = ((rows[:, :3] == keys[left, :3]).all(axis=1)) & ((rows[:, 3] & np.uint64(255)) == keys[left, 3])
            numbers[left[same]] = (rows[same, 3] >> np.uint64(8)).astype(np.int64)
            left = left[~same & (rows[:, 3] != 0)]
            if not len(left):
                break
        return numbers

    def _keep(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Put pieces that the table doesn't hold into free places."""
        keys[:, 3] |= np.arange(self.remembered, self.remembered + len(keys)).astype(np.uint64) << np.uint64(8)
        self.remembered += len(keys)
        left = np.arange(len(keys))
        for probe in range(PROBES):
            place = (slots[left] + probe) & (len(self.table) - 1)
            free = self.table[place, 3] == 0
            self.table[place[free]] = keys[left[free]]  # of several at one place the last stays
            left = left[self.table[place, 3] != keys[left, 3]]
            if not len(left):
                break

    def _learn(self, names: list[bytes]) -> list[bytes]:
        """Ids of pieces, nearly all in one call: words, and what begins and ends so that a word before and after it stands apart."""
        out: list[bytes] = [b""] * len(names)
        row, of, joined = [], [], self.joinable
        for k, name in enumerate(names):
            piece = name.decode()
            if not joined or len(name) > LONG_TEXT or _ASCII_LETTER[name[0]] or name[0] > 127 or piece[-1].isspace() or any([content in piece for content in self.added]):
                out[k] = self.encode(piece)
            elif name[0] == 32 and name[1:].isalpha():
                row.append(piece)
                of.append(k)
            else:
                row += (" a", piece)
                of += (-1, k)
        for a in range(0, len(row), ROW):
            part = row[a : a + ROW]
            found = self.tokenizer.encode("".join(part), add_special_tokens=False)
            raw = np.array(found.ids, "<u4").tobytes()
            begins = np.fromiter([begin for begin, _ in found.offsets], np.int64, len(found))
            edges = begins.searchsorted(list(accumulate(map(len, part), initial=0))).tolist()
            for k, low, high in zip(of[a : a + ROW], edges[:-1], edges[1:], strict=True):
                if k >= 0:
                    out[k] = raw[4 * low : 4 * high]
        return out


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """`values` with place for `n`, more than needed where it grows."""
    return values if n <= len(values) else np.concatenate([values, np.zeros(n + n // 2 - len(values), values.dtype)])
