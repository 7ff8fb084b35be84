"""A lazy, memoised mapping from table name to DataFrame."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping):
    """Name -> DataFrame, each built on first access and then reused.

    Building a DataFrame only creates a logical plan, so an operator that
    touches three tables never plans (or lists files for) the other six.
    Builders that write (staged tables) run once even when several threads
    query the same mapping.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        # one lock per table: different tables may be built concurrently
        self._locks = {name: threading.Lock() for name in self._builders}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            with self._locks[name]:
                if name not in self._built:
                    self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replace(self, **frames: DataFrame) -> "Tables":
        """A view with some tables swapped for the given frames.

        Every other table is fetched from this mapping (built once, here), so a
        builder with side effects — a staged write — never runs twice.
        """
        b = {k: (lambda k=k: self[k]) for k in self._builders if k not in frames}
        b.update({k: (lambda d=df: d) for k, df in frames.items()})
        return Tables(b)
