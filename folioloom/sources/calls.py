"""Calls to services and stores from inside tasks: several in flight, at a bounded rate, tried again when they fail."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor


class Bucket:
    """Tokens that refill at ``rate`` a second, at most ``burst`` of them; ``take`` waits for one. Safe to share by threads."""

    def __init__(self, rate: float, burst: float = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.then, self.lock = burst, clock(), threading.Lock()

    def take(self) -> None:
        with self.lock:  # tokens may go below zero: whoever comes later waits longer
            now = self.clock()
            self.tokens = min(self.burst, self.tokens + (now - self.then) * self.rate) - 1
            self.then, wait = now, max(0.0, -self.tokens / self.rate)
        if wait:
            self.sleep(wait)


def tried[T](call: Callable[[], T], waits: Sequence[float], sleep: Callable[[float], None] = time.sleep) -> T:
    """The call's result; after each failure but the last it waits and tries again, and the last one raises."""
    for wait in waits:
        try:
            return call()
        except Exception:
            sleep(wait)
    return call()


def backoff(attempts: int, first: float = 0.1, most: float = 20.0) -> list[float]:
    """Waits between ``attempts`` tries, each twice the one before."""
    return [min(most, first * 2**k) for k in range(attempts - 1)]


def in_flight[A, B](call: Callable[[A], B], items: Iterable[A], most: int) -> Iterator[tuple[A, B]]:
    """Each item with its result, in order, with at most ``most`` calls begun and not yet taken."""
    with ThreadPoolExecutor(most) as pool:
        begun: deque[tuple[A, Future]] = deque()
        try:
            for item in items:
                if len(begun) >= most:
                    first, future = begun.popleft()
                    yield first, future.result()
                begun.append((item, pool.submit(call, item)))
            while begun:
                first, future = begun.popleft()
                yield first, future.result()
        finally:
            for _, future in begun:
                future.cancel()
