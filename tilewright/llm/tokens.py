"""Texts to token ids with a tokenizer file, remembering the words seen.

Byte-level BPE works on pieces that its pattern cuts a text into. A space that is
directly followed by a non-space always starts a new piece, so a text may be cut
there and each part encoded by itself. Parts repeat, hence the memory.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tilewright.llm import memory
from tilewright.llm.pieces import Pieces

#: Pieces that `many` remembers, and entries of each memory of single calls; once full, they take no more (common words come early).
MOST_PIECES, MOST_PARTS, MOST_WORDS = 1_000_000, 300_000, 600_000

#: Longer parts are encoded each time.
LONGEST = 64

_CUT = re.compile(r" (?=\S)")
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ſ]+)([!-/:-@\[-`{-~]*)")


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, as the tokenizers library gives them.

    No special tokens are added; where a text holds an added token's string, that token stands there.
    """

    def __init__(self, path: str, remembered: int | None = None):
        self.most_parts, self.most_words = (MOST_PARTS, MOST_WORDS) if remembered is None else (remembered, remembered)
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        #: where texts are cut at added tokens; none if some take part in what stands beside them
        self.cut_added = None
        if not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            longest_first = sorted(self.added, key=lambda content: (-len(content), content))
            self.cut_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        self.most_pieces = MOST_PIECES if remembered is None else remembered
        self.pieces: Pieces | None = None
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {"": b""}

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if any(content in text for content in self.added):
            if self.cut_added is None:
                return self._plain(text)
            cut = self.cut_added.split(text)  # texts between and added tokens in turn
            return b"".join(self._plain(part) if k % 2 else self._joined(part.split(" "), part) for k, part in enumerate(cut) if part)
        return self._joined(text.split(" "), text)

    def many(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all `texts` (none null), as calls with one text give them, each with `end_id` last, and the edges between texts."""
        if self.pieces is None:
            joinable = self.cut_added is not None and not any(" " in content for content in self.added)
            self.pieces = Pieces(self.tokenizer, self, self.added, joinable, self.most_pieces)
        ids, edges = self.pieces.many(texts)
        return np.insert(ids, edges[1:], end_id), edges + np.arange(len(edges))

    def _joined(self, parts: list[str], text: str | None) -> bytes:
        """Ids of parts with a space between; `text` is given if they were cut at every space, whatever follows it."""
        known = list(map(self.parts.get, parts[1:]))
        if None in known:
            missing = {part for part, ids in zip(parts[1:], known, strict=True) if ids is None}
            if text is not None and any(not part or part[0].isspace() for part in missing):
                return self._joined(_CUT.split(text), None)
            learnt = self._learn(missing)
            known = [learnt[part] if ids is None else ids for part, ids in zip(parts[1:], known, strict=True)]
        return self._plain(parts[0]) + b"".join(known)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if text else b""

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts, each with a space before it."""
        out, shaped = {}, {}
        for part in parts:
            if (m := _WORD.fullmatch(part)) and len(part) <= LONGEST:
                shaped[part] = m.groups()
            else:
                out[part] = self._plain(f" {part}")
        words = self._words({word for word, _ in shaped.values()})
        for part, (word, end) in shaped.items():
            if end not in self.ends:
                ids = self._plain(end)
                if len(self.ends) < self.most_parts:
                    self.ends[end] = ids
            else:
                ids = self.ends[end]
            out[part] = words[word] + ids
        for part, ids in out.items():
            if len(self.parts) >= self.most_parts:
                break
            if 0 < len(part) <= LONGEST and not part[0].isspace():  # such parts always tell where a text was cut wrongly
                self.parts[part] = ids
        return out

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words of letters, each with a space before it: new ones in one call."""
        out = {word: self.words[word] for word in words if word in self.words}
        if new := [word for word in words if word not in out]:
            found = self.tokenizer.encode(" " + " ".join(new), add_special_tokens=False)
            ids, at = np.array(found.ids, "<u4"), np.array(found.word_ids)
            edges = np.searchsorted(at, np.arange(len(new) + 1))
            for k, word in enumerate(new):
                out[word] = ids[edges[k] : edges[k + 1]].tobytes()
                if len(self.words) < self.most_words:
                    self.words[word] = out[word]
        return out


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """One encoder per worker process: its memories, of `remembered` entries each at most, outlive a task."""
    return memory.held(f"encoder {path} {remembered}", lambda: Encoder(path, remembered))


def default_path() -> str:
    """The vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
