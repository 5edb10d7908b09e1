"""Order-dependent operators against plain sequential code, also with one hot group."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chartpost.operators import circuit, dead_letters, dedup, ledger, readback, skew
from chartpost.policies import Breaker
from chartpost.schemas import DEAD_LETTER_EVENTS, LEDGER

START = datetime(2025, 1, 1, tzinfo=timezone.utc)
POLICY = Breaker(limit=3, rest_seconds=20.0)


class Breaker:
    """Sequential circuit: failures since the last success and the last failure time."""

    def __init__(self):
        self.failures, self.last = 0, None

    def state(self, now):
        if self.failures < POLICY.limit:
            return "closed"
        waited = (now - self.last).total_seconds()
        return "open" if waited < POLICY.rest_seconds else "half_open"

    def record(self, ok, now):
        if ok:
            self.failures = 0
        else:
            self.failures, self.last = self.failures + 1, now


def random_log(seed, n=2000):
    """Two thirds of all attempts go to one endpoint; many share an instant."""
    rng, rows, now = random.Random(seed), [], START
    for seq in range(n):
        now += timedelta(seconds=rng.choice([0, 0, 1, 5, 25]))
        endpoint = rng.choice(["hot", "hot", "hot", "hot", "a", "b"])
        rows.append((endpoint, now, seq, rng.random() < 0.4))
    return rows


@pytest.mark.parametrize("seed,chunks", [(1, 1), (2, 7), (3, 16)])
def test_circuit_history(spark, seed, chunks):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, "endpoint STRING, attempted_at TIMESTAMP, seq BIGINT, ok BOOLEAN")
    got = {
        r.seq: (r.state_before, r.failures_before)
        for r in circuit.circuit_history(log.repartition(5), POLICY, chunks).collect()
    }
    breakers = {}
    for endpoint, now, seq, ok in rows:
        breaker = breakers.setdefault(endpoint, Breaker())
        assert got[seq] == (breaker.state(now), breaker.failures)
        breaker.record(ok, now)
    assert len(got) == len(rows)

    as_of = rows[-1][1] + timedelta(seconds=10)
    now = circuit.circuit_state(log, F.lit(as_of), POLICY).collect()
    assert {r.endpoint: (r.failures, r.state) for r in now} == {
        e: (b.failures, b.state(as_of)) for e, b in breakers.items()
    }


def test_circuit_advances_batch_by_batch(spark):
    rows = random_log(9, 300)
    schema = "endpoint STRING, attempted_at TIMESTAMP, seq BIGINT, ok BOOLEAN"
    counts = spark.createDataFrame(
        [], "endpoint STRING, failures BIGINT, last_failure_at TIMESTAMP"
    )
    for start in range(0, 300, 60):
        counts = circuit.advance_circuit(
            counts, spark.createDataFrame(rows[start : start + 60], schema)
        )
    whole = circuit.circuit_state(spark.createDataFrame(rows, schema), F.lit(START), POLICY)
    want = {r.endpoint: (r.failures, r.last_failure_at if r.failures else None) for r in whole.collect()}
    got = {r.endpoint: (r.failures, r.last_failure_at if r.failures else None) for r in counts.collect()}
    assert got == want


def ledger_frame(spark, rows):
    full = [
        (k, "p", "c", "s", "a", f"r{seq}", status, at, None, seq % 4, seq, "b", at.date())
        for k, at, seq, status in rows
    ]
    return spark.createDataFrame(full, LEDGER)


@pytest.mark.parametrize("chunks", [1, 5, 16])
def test_change_feed_and_current_view(spark, chunks):
    rng = random.Random(4)
    rows = [
        (
            rng.choice(["hot", "hot", *"abcdefgh"]),
            START + timedelta(seconds=rng.randint(0, 50)),
            seq,
            rng.choice(["success", "dead_lettered"]),
        )
        for seq in range(600)
    ]
    events = ledger_frame(spark, rows).repartition(6)
    want, last = [], {}
    for key, at, seq, status in sorted(rows, key=lambda r: (r[1], r[2])):
        if key in last:
            want += [("update_preimage", key, last[key]), ("update_postimage", key, seq)]
        else:
            want.append(("insert", key, seq))
        last[key] = seq
    got = ledger.change_feed(events, chunks).collect()
    assert sorted((r.change_type, r.idempotency_key, r.seq) for r in got) == sorted(want)
    current = ledger.current_ledger(events).collect()
    assert {r.idempotency_key: r.seq for r in current} == last


def keyed_frame(spark, rows):
    return spark.createDataFrame(
        [(k, "s", "a", START + timedelta(seconds=t), src) for k, t, src in rows],
        "idempotency_key STRING, ehr_system STRING, api STRING, queued_at TIMESTAMP, "
        "source_system STRING",
    )


def test_one_winner_per_key_and_nothing_lost(spark):
    rng = random.Random(5)
    rows = [("hot", 3, "x")] * 900 + [
        (f"k{rng.randint(0, 40)}", rng.randint(0, 5), rng.choice("xyz")) for _ in range(900)
    ]
    rng.shuffle(rows)
    batch = keyed_frame(spark, rows).repartition(7)
    flagged = dedup.flag_winners(batch)
    assert flagged.count() == len(rows)
    winners = {
        r.idempotency_key: (r.queued_at, r.source_system)
        for r in flagged.where("is_winner").collect()
    }
    keys = {k for k, _, _ in rows}
    assert len(winners) == flagged.where("is_winner").count() == len(keys)
    folded = {
        r.idempotency_key: ((r.queued_at, r.source_system), r.occurrences)
        for r in dedup.fold_batch(batch).collect()
    }
    for key in keys:
        mine = sorted((t, s) for k, t, s in rows if k == key)
        want = ((START + timedelta(seconds=mine[0][0])).replace(tzinfo=None), mine[0][1])
        assert winners[key] == want
        assert folded[key] == (want, len(mine))


def test_every_row_in_exactly_one_class(spark):
    rows = [("hot", 1, "x")] * 50 + [("done", 2, "x")] * 7 + [("one", 3, "x")]
    folded = dedup.fold_batch(keyed_frame(spark, rows))
    delivered = folded.where("idempotency_key = 'done'").select("idempotency_key", "ehr_system", "api")
    classes = dedup.batch_partition(dedup.classify(folded, delivered)).collect()
    assert {(r.idempotency_key, r.outcome): r.occurrences for r in classes} == {
        ("hot", "new"): 1,
        ("hot", "duplicate_in_batch"): 49,
        ("done", "already_delivered"): 7,
        ("one", "new"): 1,
    }


@pytest.mark.parametrize("n", [0, 1, 37, 200, 500])
def test_first_rows_both_ways(spark, n):
    rng = random.Random(n)
    values = [(rng.randint(0, 20), i) for i in range(300)]
    df = spark.createDataFrame(values, "a INT, b INT").repartition(5)
    want = sorted(values)[:n]
    for bound in (10_000, 0):
        got = skew.first_rows(df, ["a", "b"], n, max_top_rows=bound)
        assert sorted(map(tuple, got.collect())) == want


def test_only_the_dates_of_the_batch_are_read(spark):
    rows = [(str(n), START + timedelta(days=n), n, "success") for n in range(40)]
    events = ledger_frame(spark, rows)
    assert ledger.prune_dates(events, events.where("seq < 30")).count() == 30
    assert ledger.prune_dates(events, events.where("seq < 0")).count() == 0


def test_delivered_keys(spark):
    rows = [("a", START, 1, "success"), ("b", START, 2, "success"), ("c", START, 3, "success")]
    rows.append(("b", START + timedelta(seconds=1), 4, "dead_lettered"))
    events = ledger_frame(spark, rows)
    batch = events.where("idempotency_key <> 'c'")

    def found():
        kept = ledger.delivered_keys(events, batch).join(batch, "idempotency_key", "left_semi")
        return {r.idempotency_key for r in kept.collect()}

    assert found() == {"a"}


def test_pending_letters_and_flags(spark):
    def event(kind, key, second):
        at = START + timedelta(seconds=second)
        return (kind, key, "p", "c", "s", "a", "{}", "err", 3, 4, at, second, "b", at.date())

    events = spark.createDataFrame(
        [
            event("dead_lettered", "once", 1),
            event("dead_lettered", "marked", 2),
            event("reprocessed", "marked", 3),
            event("dead_lettered", "again", 4),
            event("reprocessed", "again", 5),
            event("dead_lettered", "again", 6),
            event("reprocessed", "stray", 7),
        ],
        DEAD_LETTER_EVENTS,
    )
    assert [r.idempotency_key for r in dead_letters.pending_letters(events).collect()] == [
        "once",
        "again",
    ]
    states = dead_letters.letter_states(events).collect()
    assert sorted((r.idempotency_key, r.dead_lettered_at.second, r.reprocessed) for r in states) == [
        ("again", 4, True),
        ("again", 6, False),
        ("marked", 2, True),
        ("once", 1, False),
    ]


def test_reconcile_keeps_rows_without_id(spark):
    schema = (
        "ehr_resource_id STRING, code_system STRING, code STRING, value_num DOUBLE, "
        "value_str STRING, value_bool BOOLEAN, unit STRING, patient_id STRING"
    )
    base = ("l", "c", 97.5, None, None, "%", "p")
    left = spark.createDataFrame([("1", *base), ("2", *base), (None, *base), (None, *base)], schema)
    other = ("l", "c", 97.5, None, None, "mmHg", "p")
    right = spark.createDataFrame([("1", *base), ("2", *other), ("3", *base)], schema)
    got = sorted(
        (r.ehr_resource_id or "", r.verdict, r.differing_fields)
        for r in readback.reconcile(left, right).collect()
    )
    assert got == [
        ("", "not_stored", ""),
        ("", "not_stored", ""),
        ("1", "equal", ""),
        ("2", "different", "unit"),
        ("3", "not_sent", ""),
    ]
