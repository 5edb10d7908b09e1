"""The one step with a side effect: send requests, return one row per attempt."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartpost.operators.outcomes import CIRCUIT_OPEN
from chartpost.policies import Breaker, Retries
from chartpost.schemas import ATTEMPT_LOG
from chartpost.session import ship_package

# send(url, headers, body) -> (http status, response body); raises when nothing came back.
Send = Callable[[str, dict[str, str], str], tuple[int, str]]
OpenTransport = Callable[[], Send]

ATTEMPT_COLUMNS = [f for f in ATTEMPT_LOG.fields if f.name not in ("batch_id", "wave")]
ATTEMPT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ATTEMPT_COLUMNS)
_ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp": pa.timestamp("us", tz="UTC"),
}
_ARROW_SCHEMA = pa.schema(
    [(f.name, _ARROW_TYPES[f.dataType.simpleString()]) for f in ATTEMPT_COLUMNS]
)

REQUEST_COLUMNS = (
    "idempotency_key",
    "ehr_system",
    "api",
    "endpoint",
    "effective_date",
    "url",
    "headers",
    "request_id",
    "request_body",
    "returns_id",
    "circuit_failures",
    "circuit_last_failure_at",
)


@dataclass
class EndpointHealth:
    """Failures since the last success, as one task sees them.

    ``agreed`` and ``agreed_at`` are the failures and the time of the last one that all
    tasks knew of at their last exchange; ``last_ok`` and ``failed`` (after it) are this
    task's own since then.
    """

    agreed: int
    agreed_at: float
    last_ok: float | None = None
    failed: list[float] = field(default_factory=list)

    @property
    def failures(self) -> int:
        return len(self.failed) + (self.agreed if self.last_ok is None else 0)

    def is_open(self, policy: Breaker, now: float) -> bool:
        last_failure = self.failed[-1] if self.failed else self.agreed_at
        return self.failures >= policy.limit and now - last_failure < policy.rest_seconds

    def record(self, ok: bool, now: float) -> None:
        if ok:
            self.last_ok = now
            self.failed = []
        else:
            self.failed.append(now)


def merged_health(seen: list[EndpointHealth]) -> EndpointHealth:
    """What tasks know together: failures of any of them after the last success of any."""
    last_ok = max((h.last_ok for h in seen if h.last_ok is not None), default=None)
    failed = [at for h in seen for at in h.failed if last_ok is None or at > last_ok]
    agreed = max(h.agreed for h in seen) if last_ok is None else 0
    return EndpointHealth(agreed + len(failed), max([*failed, *(h.agreed_at for h in seen)]))


class SharedBreaker:
    """One breaker over all tasks of a barrier stage.

    ``gather`` takes a message and returns those of all tasks, when all have come.
    Between two exchanges a task may add failures up to its part of what is left to the
    limit, at least one; so a dead endpoint gets fewer than limit + tasks requests before
    every task knows.  A task that has nothing left to send goes on answering.
    """

    def __init__(self, gather: Callable[[str], list[str]], tasks: int, policy: Breaker, now: float):
        self.gather, self.tasks, self.policy = gather, tasks, policy
        self.started = now

    def exchange(self, health: dict[str, EndpointHealth], now: Callable[[], float], done: bool = False) -> bool:
        """Make ``health`` what all tasks know; whether all of them are done."""
        own = {name: asdict(h) for name, h in health.items()}
        answers = [json.loads(m) for m in self.gather(json.dumps({"done": done, "health": own}))]
        for name in {n for answer in answers for n in answer["health"]}:
            seen = [EndpointHealth(**a["health"][name]) for a in answers if name in a["health"]]
            health[name] = merged_health(seen)
        self.started = now()
        return all(answer["done"] for answer in answers)

    def is_due(self, state: EndpointHealth, now: float) -> bool:
        part = max(1, (self.policy.limit - state.agreed) // self.tasks)
        return len(state.failed) >= part or now - self.started >= self.policy.round_seconds


def breaker_tasks(spark: SparkSession, max_concurrency: int, policy: Breaker | None) -> tuple[int, bool]:
    """How many tasks send at once, and whether they share a breaker.

    Sharing needs all tasks to run together, so there are no more of them than cores, and
    none where executors come and go by dynamic allocation (barrier stages cannot run
    there): then each task has a breaker of its own.  A breaker that never rests is
    never open, and one task has nobody to share with.
    """
    if policy is None or not policy.shared or policy.rest_seconds <= 0:
        return max_concurrency, False
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return max_concurrency, False
    tasks = min(max_concurrency, spark.sparkContext.defaultParallelism)
    return tasks, tasks > 1


def _accepted(status: int, body: str | None, returns_id: bool) -> bool:
    if not 200 <= status <= 299:
        return False
    if not returns_id:
        return True
    try:
        return isinstance(json.loads(body or ""), dict)
    except ValueError:
        return False


# Attempts, with the bodies of their answers, that a task holds before it hands them on.
LOGGED_ROWS = 500

# What an attempt takes over from its request as it is.
_PASSED = ("idempotency_key", "ehr_system", "api", "endpoint", "effective_date")
_LOGGED = [name for name in _ARROW_SCHEMA.names if name not in _PASSED]


def _plain(column: pa.Array) -> list:
    """The column's values; ``to_pylist`` would make an Arrow scalar of each first."""
    return column.to_numpy(zero_copy_only=False).tolist()


class AttemptRows:
    """Attempts at the requests of one batch, each with its request's place in the batch.

    Requests and attempts stay columns, so an attempt costs a task little beside sending.
    """

    def __init__(self, seq: int):
        self.seq = seq
        self.rows: list[tuple] = []

    def add(self, place: int, attempt: int, now: float, status=None, body=None, error=None, ok=False, gated=False):
        self.seq += 1
        self.rows.append((place, attempt, self.seq, round(now * 1_000_000), status, body, error, ok, gated))

    def flush(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        places, *logged = zip(*self.rows)
        self.rows = []
        taken = pa.array(places, pa.int64())
        columns = {name: batch.column(name).take(taken) for name in _PASSED}
        columns |= dict(zip(_LOGGED, logged))

        def shaped(field: pa.Field) -> pa.Array:
            column = columns[field.name]
            if isinstance(column, pa.Array):
                return column.cast(field.type)
            if pa.types.is_timestamp(field.type):
                return pa.array(column, pa.int64()).cast(field.type)
            return pa.array(column, field.type)

        return pa.RecordBatch.from_arrays([shaped(f) for f in _ARROW_SCHEMA], schema=_ARROW_SCHEMA)


def deliver(
    requests: DataFrame,
    open_transport: OpenTransport,
    retry: Retries = Retries(),
    circuit: Breaker | None = Breaker(),
    token: str | Callable[[], str] = "",
    sleep: Callable[[float], None] = time.sleep,
    clock: Callable[[], float] = time.time,
    shared: bool = False,
) -> DataFrame:
    """Send every row, with inline retries; the result must be written exactly once.

    Each task opens one transport and sends one request at a time, so the number of
    partitions is the number of requests in flight.  The circuit is tracked per
    endpoint, starting from the state the rows bring along: by each task alone, or, when
    ``shared``, by all of them together.  They then are a barrier stage, which is
    repeated as a whole (with all its requests) when a task is lost, and which a
    shuffle of the attempts follows, as Spark gives up on barrier tasks that write.
    A token provider is asked on the executor before each request, so that it may
    renew what expires.
    """
    delays = retry.schedule()
    ship_package(requests.sparkSession)

    def send_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = open_transport()
        health: dict[str, EndpointHealth] = {}
        context = TaskContext.get()
        breaker = None
        if shared:
            barrier = BarrierTaskContext.get()
            breaker = SharedBreaker(barrier.allGather, len(barrier.getTaskInfos()), circuit, clock())
        log = AttemptRows((context.partitionId() if context else 0) << 33)

        def state_of(name: str, batch: pa.RecordBatch, place: int) -> EndpointHealth:
            if name not in health:
                known = batch.column("circuit_last_failure_at")[place].as_py()
                failures = batch.column("circuit_failures")[place].as_py()
                health[name] = EndpointHealth(failures or 0, known.timestamp() if known else 0.0)
            return health[name]

        def send_one(place: int, name: str, url: str, headers: dict, body: str, returns_id: bool) -> None:
            for attempt in range(retry.times + 1):
                bearer = token() if callable(token) else token
                if bearer:
                    headers["Authorization"] = f"Bearer {bearer}"
                status, answer, error = None, None, None
                try:
                    status, answer = send(url, headers, body)
                except Exception as exc:  # any failure to answer is this row's failure only
                    error = str(exc) or type(exc).__name__
                ok = status is not None and _accepted(status, answer, returns_id)
                now = clock()
                # Looked up each time, as an exchange replaces it.
                health[name].record(ok, now)
                if breaker and breaker.is_due(health[name], now):
                    breaker.exchange(health, clock)
                log.add(place, attempt, now, status, answer, error, ok)
                if ok or attempt == retry.times:
                    return
                if not retry.again(status):
                    return
                sleep(delays[attempt])
                if circuit and health[name].is_open(circuit, clock()):
                    return

        for batch in batches:
            sent = ("endpoint", "url", "request_id", "request_body", "returns_id")
            rows = zip(*[_plain(batch.column(c)) for c in sent])
            maps = batch.column("headers")
            starts, names, values = (_plain(c) for c in (maps.offsets, maps.keys, maps.items))
            for place, (name, url, request_id, body, returns_id) in enumerate(rows):
                state = state_of(name, batch, place)
                if circuit and state.is_open(circuit, clock()):
                    log.add(place, 0, clock(), error=CIRCUIT_OPEN, gated=True)
                else:
                    part = slice(starts[place], starts[place + 1])
                    headers = dict(zip(names[part], values[part]))
                    headers["X-Request-Id"] = request_id
                    send_one(place, name, url, headers, body, returns_id)
                if len(log.rows) >= LOGGED_ROWS:
                    yield log.flush(batch)
            if log.rows:
                yield log.flush(batch)
        while breaker and not breaker.exchange(health, clock, done=True):
            pass

    attempts = requests.select(*REQUEST_COLUMNS).mapInArrow(send_partition, ATTEMPT_DDL, barrier=shared)
    return attempts.repartition("idempotency_key") if shared else attempts


# Rows of a wave per file, so that many tasks build the requests that few may send.
ROWS_PER_FILE = 25_000


def split_waves(rows: DataFrame, count: int, rows_per_wave: int) -> DataFrame:
    """Number the rows in ``wave``, oldest first, in ranges of about equal size.

    A wave is sent and logged as a whole.  Few requests may be in flight at once, so
    without waves a large batch would be a few endless tasks, and losing one of them
    would repeat everything it had sent.  A large wave is several consecutive ranges, each
    written and read by a task of its own.
    """
    waves = max(1, -(-count // rows_per_wave))
    ranges = max(1, -(-count // (waves * ROWS_PER_FILE)))
    return rows.repartitionByRange(
        waves * ranges, "queued_at", "effective_datetime", "idempotency_key"
    ).withColumn("wave", F.floor(F.spark_partition_id() / ranges).cast("int"))


def hold_back(requests: DataFrame) -> DataFrame:
    """Attempts of rows that an open circuit keeps from being sent, logged as a sender would."""
    return requests.select(
        *_PASSED,
        F.lit(0).alias("attempt"),
        (F.monotonically_increasing_id() + 1).alias("seq"),
        F.current_timestamp().alias("attempted_at"),
        F.lit(None).cast("int").alias("http_status"),
        F.lit(None).cast("string").alias("body"),
        F.lit(CIRCUIT_OPEN).alias("transport_error"),
        F.lit(False).alias("ok"),
        F.lit(True).alias("gated"),
    )


def spread_requests(requests: DataFrame, max_concurrency: int) -> DataFrame:
    """As many partitions as requests may be in flight, filled evenly by key hash.

    Keys are unique here.  Hashing (instead of round robin) puts a row back into the
    same partition when a task is repeated.
    """
    return requests.repartition(max_concurrency, "idempotency_key").sortWithinPartitions(
        "queued_at", "effective_datetime", "idempotency_key"
    )


def http_transport(timeout_seconds: float = 30.0) -> OpenTransport:
    """POST over the standard library; error statuses are answers, not exceptions."""

    def open_transport() -> Send:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        def send(url: str, headers: dict[str, str], body: str) -> tuple[int, str]:
            request = Request(url, data=body.encode(), headers=headers, method="POST")
            try:
                with urlopen(request, timeout=timeout_seconds) as response:
                    return response.status, response.read().decode()
            except HTTPError as answer:
                return answer.code, answer.read().decode(errors="replace")

        return send

    return open_transport
