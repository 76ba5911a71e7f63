"""Reading ahead without losing the place: what counts is what has been consumed, not what has been read."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Generic, TypeVar

T = TypeVar("T")
S = TypeVar("S")
_END = object()


class Prefetch(Generic[T, S]):
    """Batches of an iterator of (batch, state after it), read ahead by one thread, `depth` at most.

    `committed` is the state after the last batch that was taken and done with: taking the next one says so. Reading ahead
    never shows in it, so a state saved from it resumes where consuming stopped. An error of the source is raised where its
    batch would have come, after all batches before it, and again whenever more is asked for; so is the end. `close` stops
    reading ahead.
    """

    def __init__(self, source: Iterator[tuple[T, S]], start: S, depth: int = 4):
        self._source, self._taken, self.committed = iter(source), start, start
        self._reader = ThreadPoolExecutor(1)
        self._ahead: deque[Future] = deque()
        for _ in range(max(1, depth)):
            self._more()

    def _more(self) -> None:
        # One thread runs these in order, so results come in order.
        self._ahead.append(self._reader.submit(next, self._source, _END))

    def __iter__(self) -> Prefetch[T, S]:
        return self

    def __next__(self) -> T:
        self.committed = self._taken
        if self._ahead[0].exception() is not None or self._ahead[0].result() is _END:
            found = self._ahead[0]
            self.close()
            raise found.exception() or StopIteration
        batch, self._taken = self._ahead.popleft().result()
        self._more()
        return batch

    def close(self) -> None:
        for f in list(self._ahead)[1:]:
            f.cancel()
        self._reader.shutdown(wait=False)
