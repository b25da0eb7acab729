"""Run one stream per table, each on its own."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping

from pyspark.sql.streaming import StreamingQuery

logger = logging.getLogger(__name__)


def drain_all(starts: Mapping[str, Callable[[], StreamingQuery]],
              at_once: int = 8) -> dict[str, Exception | None]:
    """Start every stream, at most ``at_once`` together, and wait for all of them.

    Returns each table's error, or None when its stream finished. Only the queries started
    here are awaited, and one that fails leaves the others running.
    """
    def drain(table: str) -> Exception | None:
        try:
            starts[table]().awaitTermination()
        except Exception as error:  # a bad table must not stop the others
            logger.exception("stream of %s failed", table)
            return error
        return None

    if not starts:
        return {}
    with ThreadPoolExecutor(max_workers=min(at_once, len(starts))) as pool:
        return dict(zip(starts, pool.map(drain, starts)))


def finished(outcomes: Mapping[str, Exception | None]) -> list[str]:
    return [table for table, error in outcomes.items() if error is None]
