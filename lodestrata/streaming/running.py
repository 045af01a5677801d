"""Streams that run at the same time until they are stopped."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery


class Running:
    """Started queries, each added after those whose tables it reads."""

    def __init__(self) -> None:
        self.queries: list[StreamingQuery] = []

    def add(self, query: StreamingQuery) -> StreamingQuery:
        self.queries.append(query)
        return query

    def catch_up(self) -> None:
        """Wait until all that lies in the sources now has gone through every query, and raise a query's error."""
        for query in self.queries:
            query.processAllAvailable()

    def wait_until(self, reached: Callable[[], bool], seconds: float = 300.0) -> None:
        """Wait for a state of the queries; raises their errors, and a timeout."""
        end = time.monotonic() + seconds
        while not reached():
            for query in self.queries:
                if query.exception() is not None:
                    raise query.exception()
            if time.monotonic() > end:
                raise TimeoutError(f"not reached in {seconds} s")
            time.sleep(0.05)

    def stop(self) -> None:
        """Stop all, readers before those they read. A micro-batch under way is given up, and done anew at the next start."""
        for query in reversed(self.queries):
            query.stop()
        self.queries.clear()

    def __enter__(self) -> Running:
        return self

    def __exit__(self, *_) -> None:
        self.stop()
