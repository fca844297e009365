"""Word shingles as 64-bit hashes, over whole Arrow batches at a time.

Words are the runs of bytes other than white space (0x20, 0x09-0x0D), A-Z in
lower case. A text of ``K`` words or more has the set of its ``K``-word
shingles, a shorter one the sequence of all its words, an empty one nothing.
"""

from __future__ import annotations

import numpy as np

from ledgerlens.llm.common import mix64
from ledgerlens.llm.wordids import hashed, word_bounds

K = 5
_PLACE = mix64(np.arange(1, K + 1, dtype=np.uint64)) | np.uint64(1)  # a factor for each place


def shingle_sets(raw: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    start, end = word_bounds(raw, bounds)
    words, upto = hashed(raw, start, end), np.searchsorted(start, bounds)
    n = max(0, len(words) - K + 1)
    rows = np.zeros(n, np.uint64)
    for k in range(K):
        rows += words[k : k + n] * _PLACE[k]
    rows = mix64(rows)
    out = []
    for lo, hi in zip(upto[:-1], upto[1:], strict=True):
        if hi - lo >= K:
            out.append(np.unique(rows[lo : hi - K + 1]))
        elif hi > lo:
            short = (words[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(mix64(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
