"""Keep a streaming query running: restart it from its checkpoint after a failure.

The serving consumers retry forever, 5 s apart; a failed micro-batch is
replayed from the checkpoint on restart, and the sinks here are replay-safe,
so a restart neither loses nor duplicates output.
"""

from __future__ import annotations

import logging
import time
from typing import Callable

# Fixed value: pause between restarts.
RETRY_SECONDS = 5.0

log = logging.getLogger(__name__)


def supervise(start: Callable[[], object], retry_seconds: float = RETRY_SECONDS,
              max_restarts: int | None = None):
    """Run ``start()`` (which returns a started ``StreamingQuery``) until it ends without error."""
    restarts = 0
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except Exception as exc:  # noqa: BLE001 - any failure of the query restarts it
            release = getattr(q, "release_catalogue", None)    # what the failed query held (news job)
            if release is not None:
                release()
            restarts += 1
            if max_restarts is not None and restarts > max_restarts:
                raise
            log.warning("stream failed (%s); restart %d in %.1fs", exc, restarts, retry_seconds)
            time.sleep(retry_seconds)
