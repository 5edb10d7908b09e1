"""One breaker over all tasks that send at once."""

import json
import os
import random
import threading
from datetime import datetime, timedelta, timezone

import pytest

from chartpost.operators.delivery import (
    EndpointHealth,
    SharedBreaker,
    breaker_tasks,
    merged_health,
)
from chartpost.operators.outcomes import CIRCUIT_OPEN
from chartpost.plans.jobs import Endpoint, run_delivery_batch
from chartpost.policies import Breaker, Retries
from chartpost.schemas import READY
from chartpost.sources.tables import append_rows, read_table

AT = datetime(2025, 6, 15, 10, 30, tzinfo=timezone.utc)


@pytest.mark.parametrize("seed", range(20))
def test_tasks_know_together_what_one_would(seed):
    """Events dealt to tasks, merged round by round, count like one sequence."""
    rng = random.Random(seed)
    tasks = [EndpointHealth(3, 0.5) for _ in range(4)]
    failures, at = 3, 0.5
    for now in range(1, 60):
        ok = rng.random() < 0.15
        failures, at = (0, at) if ok else (failures + 1, float(now))
        tasks[rng.randrange(4)].record(ok, float(now))
        if rng.random() < 0.3:
            merged = merged_health(tasks)
            assert merged.failures == failures and (failures == 0 or merged.agreed_at == at)
            tasks = [merged_health(tasks) for _ in tasks]
            tasks = [EndpointHealth(t.agreed, t.agreed_at) for t in tasks]


@pytest.mark.parametrize("limit, n", [(5, 5), (5, 2), (12, 5), (1, 4), (100, 3)])
def test_a_dead_endpoint_gets_fewer_than_limit_and_tasks_requests(limit, n):
    """Tasks as threads: every request fails until the breaker is open."""
    policy, meeting, board = Breaker(limit=limit), threading.Barrier(n), [""] * n
    sent, final = [0] * n, [None] * n

    def task(i):
        def gather(message):
            board[i] = message
            meeting.wait(20)
            seen = list(board)
            meeting.wait(20)
            return seen

        health = {"e": EndpointHealth(0, 0.0)}
        breaker = SharedBreaker(gather, n, policy, 0.0)
        while not health["e"].is_open(policy, 1.0):
            sent[i] += 1
            health["e"].record(False, 1.0)
            if breaker.is_due(health["e"], 1.0):
                breaker.exchange(health, lambda: 1.0)
        while not breaker.exchange(health, lambda: 1.0, done=True):
            pass
        final[i] = health["e"].failures

    threads = [threading.Thread(target=task, args=(i,)) for i in range(n)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(30)
    assert limit <= sum(sent) < limit + n
    assert set(final) == {sum(sent)}


def test_who_shares(spark):
    assert breaker_tasks(spark, 5, Breaker(shared=True)) == (5, True)
    assert breaker_tasks(spark, 500, Breaker(shared=True)) == (8, True)
    assert breaker_tasks(spark, 1, Breaker(shared=True)) == (1, False)
    for policy in (None, Breaker(), Breaker(rest_seconds=0.0, shared=True)):
        assert breaker_tasks(spark, 500, policy) == (500, False)


def ready(spark, workspace, n):
    rows = [
        (f"P{i}", None, "59408-5", None, "SpO2", 42.0, None, None, "%", AT, None, None, AT + timedelta(seconds=i), AT.date())
        for i in range(n)
    ]
    append_rows(spark.createDataFrame(rows, READY), workspace, "observations_ready")


def target(calls, answer, break_once=None, **settings):
    """``answer(patient)`` is the status; the first task to send fails where a file is named."""

    def open_transport():
        def send(url, headers, body):
            patient = json.loads(body)["subject"]["reference"].split("/")[1]
            with open(calls, "a") as log:
                log.write(f"{patient}\n")
            return answer(patient), json.dumps({"id": f"fhir-{patient}"})

        if break_once:
            try:
                os.close(os.open(break_once, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return send
            raise RuntimeError("lost")
        return send

    defaults = {"retry": Retries(times=1), "circuit": Breaker(shared=True), "sleep": lambda seconds: None}
    return Endpoint("generic_fhir", "fhir", "https://fhir.example", open_transport, **{**defaults, **settings})


def test_five_tasks_leave_a_dead_endpoint_alone(spark, workspace, tmp_path):
    ready(spark, workspace, 60)
    calls = str(tmp_path / "calls")
    row = run_delivery_batch(spark, workspace, target(calls, lambda p: 503), "b1").first()
    assert row.dead_lettered == 60
    n = len(open(calls).readlines())
    assert 5 <= n <= 10
    log = read_table(spark, workspace, "attempt_log")
    assert log.where("not gated").count() == n
    gated = read_table(spark, workspace, "delivery_ledger").where(f"error_message = '{CIRCUIT_OPEN}'")
    assert gated.count() == 60 - log.where("not gated").select("idempotency_key").distinct().count()


def test_refused_rows_among_good_ones_open_nothing(spark, workspace, tmp_path):
    """Fewer rows than tasks, some refused: every task goes on until all are done."""
    calls = str(tmp_path / "calls")
    ready(spark, workspace, 3)
    some = target(calls, lambda p: 503 if p == "P1" else 201)
    row = run_delivery_batch(spark, workspace, some, "b1").first()
    assert (row.succeeded, row.dead_lettered) == (2, 1)
    assert len(open(calls).readlines()) == 4


def test_a_lost_task_repeats_the_stage_and_logs_once(spark, workspace, tmp_path):
    ready(spark, workspace, 20)
    calls, flag = str(tmp_path / "calls"), str(tmp_path / "flag")
    row = run_delivery_batch(spark, workspace, target(calls, lambda p: 201, break_once=flag), "b1").first()
    assert row.succeeded == 20 and os.path.exists(flag)
    assert read_table(spark, workspace, "attempt_log").count() == 20
    assert set(open(calls).read().split()) == {f"P{i}" for i in range(20)}
