"""Vectorised views of Arrow text columns for Python tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tessera.llm.common import slices


def text_slices(batches, text_field: str = "text", max_bytes: int = 1 << 20):
    """(slice, its texts as a string array without nulls), slice by slice."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_field)), 0).to_numpy(zero_copy_only=False)
        for part in slices(batch, sizes, max_bytes):
            yield part, pc.fill_null(part.column(text_field).cast(pa.large_string()), "")


def ragged(lists) -> tuple[pa.Array, np.ndarray]:
    """Flat values of a list array and its offsets, counted from 0."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each flat value the number of the list that holds it."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def codes_of(values) -> tuple[np.ndarray, list]:
    """Codes of the values and the distinct values in the order of their codes."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values``; 0 for an empty run."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def gather_ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[starts[i] : starts[i] + lengths[i]]`` for all i, one after the other."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(ends[-1] if len(ends) else 0) + shift]
