"""Words of many texts at once, cut and lower-cased byte by byte in flat arrays.

All bytes of a character outside ASCII are 0x80 or more, so a class of bytes that holds all of those never cuts a character.
"""

import numpy as np
import pyarrow as pa

from rateflow.llm.wordhash import LOWER, NOT_BLANK

#: Bytes of letters: ASCII letters and everything outside ASCII.
LETTERS = np.arange(256) >= 0x80
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = True
#: Letters and ASCII digits.
LETTERS_DIGITS = LETTERS.copy()
LETTERS_DIGITS[0x30:0x3A] = True
#: Everything but ASCII white space.
CHUNKS = NOT_BLANK


def runs(texts, inside, lower=True):
    """The maximal runs of `inside` bytes of every text as one binary array, and the number of runs of each text.

    `texts` is an Arrow array of bytes without nulls; A-Z become a-z if asked for.
    """
    texts = texts.cast(pa.binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    first, last = (offsets[0], offsets[-1]) if len(texts) else (0, 0)
    data = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - first
    taken = inside[data]
    begins = taken.copy()
    begins[1:] &= ~taken[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = taken[edges]
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(begins)])
    starts = np.flatnonzero(begins[taken]).astype(np.int32)
    kept = data[taken]
    ends = np.append(starts, np.int32(len(kept)))
    words = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[kept] if lower else kept)])
    return words, np.diff(before[offsets])
