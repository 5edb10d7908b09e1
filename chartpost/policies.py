"""Retry and breaker settings, turned into literals of column expressions."""

from __future__ import annotations

from dataclasses import dataclass

# Seconds to wait after the first, second, ... failed attempt, the most that
# a job waits, how often each job tries again, and the breaker's limits.
WAITS = (1.0, 2.0, 4.0, 8.0, 16.0, 30.0)
JOB_WAIT = 5.0
DEFAULT_TIMES, BATCH_TIMES, REPROCESS_TIMES = 3, 2, 1
BREAKER_LIMIT, BREAKER_REST = 5, 60.0


@dataclass(frozen=True)
class Retries:
    """How often a failed request is sent again, and the wait before each time.

    The last wait holds for all further ones.  ``statuses`` are the HTTP statuses worth
    another attempt (transport errors always are); None stands for every failure.
    """

    times: int = DEFAULT_TIMES
    waits: tuple[float, ...] = WAITS
    statuses: frozenset[int] | None = None

    def wait_after(self, attempt: int) -> float:
        return self.waits[min(attempt, len(self.waits) - 1)]

    def schedule(self) -> list[float]:
        """One wait per further attempt."""
        return [self.wait_after(attempt) for attempt in range(self.times)]

    def again(self, status: int | None) -> bool:
        """Whether an answer with ``status`` (None: no answer) is worth another attempt."""
        return status is None or self.statuses is None or status in self.statuses


@dataclass(frozen=True)
class Breaker:
    """Failures in a row that stop sending to an endpoint, and the seconds it then rests.

    ``shared``: tasks that send at once count together, exchanging their counts at least
    every ``round_seconds``.  An exchange takes about a second, and a lost task repeats the
    requests of its whole wave instead of its own, so it is asked for.
    """

    limit: int = BREAKER_LIMIT
    rest_seconds: float = BREAKER_REST
    shared: bool = False
    round_seconds: float = 10.0


JOB_WAITS = tuple(min(wait, JOB_WAIT) for wait in WAITS)
BATCH_RETRY = Retries(BATCH_TIMES, JOB_WAITS)
REPROCESS_RETRY = Retries(REPROCESS_TIMES, JOB_WAITS)
