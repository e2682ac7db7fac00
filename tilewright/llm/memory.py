"""What a Python worker remembers between texts: one operator's memory at a time.

Worker processes outlive stages and serve one operator after another, so what an
earlier operator remembered would only add up.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa
import xxhash

#: Words whose hashes are remembered: some 200 bytes each. Once full, a memory takes no more (common words come early).
MOST_HASHES = 150_000

_held: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """What this process remembers under `name`; whatever it held under other names goes."""
    if name not in _held:
        if _held:
            _held.clear()
            _give_back()
        _held[name] = make()
    return _held[name]


def _give_back() -> None:
    """Free memory goes back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def word_hashes(words: list[str]) -> list[int]:
    """The XXH64 of each word."""
    known = held("word hashes", dict)
    out = list(map(known.get, words))
    if None in out:
        for k, h in enumerate(out):
            if h is None:
                out[k] = h = xxhash.xxh64_intdigest(words[k])
                if len(known) < MOST_HASHES:
                    known[words[k]] = h
    return out
