"""Ids of text units remembered over the batches of a worker, looked up by distinct unit and expanded by arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from venturelens.llm.common import ranges

UNITS = 1 << 19  # units remembered before those that weren't used lately go
UNIT_BYTES = 32 << 20


class UnitMemory:
    """``encode(units)`` gives (number of ids of each unit, all ids); it is asked only for units that aren't remembered.

    Units and ids lie in flat arrays, in the order of their first use.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], units: int = UNITS) -> None:
        self.encode, self.units = encode, units
        self.names = pa.array([], pa.binary())
        self.length, self.flat, self.used = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool)

    def _forget(self) -> None:
        """Leaves the units used since the last time, or none if those are too many as well."""
        if 2 * int(self.used.sum()) > self.units or self.names.nbytes > 2 * UNIT_BYTES:
            self.used[:] = False
        start = np.cumsum(self.length) - self.length
        length = self.length[self.used]
        self.flat = self.flat[np.repeat(start[self.used], length) + ranges(length)]
        self.names, self.length = self.names.filter(pa.array(self.used)), length
        self.used = np.zeros(len(length), bool)

    def take(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of the units (binary), and all their ids."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary
        if not len(distinct):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        if len(self.names) > self.units or self.names.nbytes > UNIT_BYTES:
            self._forget()
        at = pa.compute.fill_null(pa.compute.index_in(distinct, value_set=self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = at < 0
        if missing.any():
            new = distinct.filter(pa.array(missing))
            length, flat = self.encode(new.to_pylist())
            at[missing] = len(self.names) + np.arange(len(new))
            self.names = pa.concat_arrays([self.names, new])
            self.length, self.flat = np.concatenate([self.length, length]), np.concatenate([self.flat, flat.astype(np.int32)])
            self.used = np.concatenate([self.used, np.zeros(len(new), bool)])
        self.used[at] = True
        wanted = at[coded.indices.to_numpy(zero_copy_only=False)]
        start = np.cumsum(self.length) - self.length
        length = self.length[wanted]
        return length, self.flat[np.repeat(start[wanted], length) + ranges(length)]
