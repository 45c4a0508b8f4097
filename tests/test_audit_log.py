"""Compaction of the audit log: the same current state, whatever breaks it off."""

import datetime as dt
import random

import pytest

from feedlens import schemas
from feedlens.operators import audit
from feedlens.sinks import audit_log, tables as sinks
from feedlens.sinks.audit_log import AuditLog


def events_of(spark, rng, first, n):
    return spark.createDataFrame([(rng.choice([1, 2, 3, None]), dt.date(2024, 3, 26), dt.datetime(2024, 3, 26, rng.randrange(3)), first + k,
                                   rng.choice(["Started", "Success", "Failed"]), rng.choice([None, f"e{k}"]), "me", None) for k in range(n)],
                                 schemas.DATASET_AUDIT)


def state(df):
    return sorted(map(tuple, df.select("dataset_id", "batch_ts", "business_date", "status", "error_message", "seq", "n_events").collect()), key=repr)


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(audit_log, "BUCKETS", 4)


def test_compaction_keeps_the_state_and_empties_the_log(spark, tmp_path, few):
    rng, log = random.Random(1), AuditLog(spark, str(tmp_path / "audit"), schemas.DATASET_AUDIT)
    log.compact()  # nothing yet
    assert log.current().count() == 0
    written = None
    for k in range(4):
        more = events_of(spark, rng, 100 * k, 20)
        written = more if written is None else written.unionByName(more)
        sinks.write_events(more, log.path, f"w{k}")
        assert state(log.current()) == state(audit.current(written))
        if k != 2:
            log.compact()
            assert state(log.current()) == state(audit.current(written))
            assert log.unfolded().count() == 0 and log._snapshot().count() == len(state(log.current()))
    # a folded writer that writes its events again doesn't count again
    sinks.write_events(events_of(spark, random.Random(9), 300, 20), log.path, "w3")
    assert state(log.current()) == state(audit.current(written))
    log.compact()
    assert state(log.current()) == state(audit.current(written))


def test_only_ranges_with_new_events_are_rewritten(spark, tmp_path, few):
    rng, log = random.Random(2), AuditLog(spark, str(tmp_path / "audit"), schemas.DATASET_AUDIT)
    sinks.write_events(events_of(spark, rng, 0, 60), log.path, "w0")
    log.compact()
    assert {r["through"] for r in log._snapshot().collect()} == {1}
    one = log.current().limit(1).collect()[0]
    sinks.write_events(spark.createDataFrame([(one["dataset_id"], one["business_date"], one["batch_ts"], 999, "Validated", None, "me", None)],
                                             schemas.DATASET_AUDIT), log.path, "w1")
    log.compact()
    rows = log._snapshot().collect()
    assert len({r["bucket"] for r in rows if r["through"] == 2}) == 1 and len({r["bucket"] for r in rows}) > 1
    assert {r["bucket"] for r in rows if r["through"] == 2}.isdisjoint({r["bucket"] for r in rows if r["through"] == 1})


@pytest.mark.parametrize("step", range(4))
def test_a_compaction_that_was_broken_off_is_run_again(spark, tmp_path, few, monkeypatch, step):
    """Broken off before its first note, before the ranges, after some of the ranges, and before its last note."""
    rng, log = random.Random(step), AuditLog(spark, str(tmp_path / "audit"), schemas.DATASET_AUDIT)
    first, second, late = (events_of(spark, rng, 100 * k, 30) for k in range(3))
    sinks.write_events(first, log.path, "w0")
    log.compact()
    sinks.write_events(second, log.path, "w1")
    real, calls = sinks.write_partitions, []

    def failing(df, path, by, *rest):
        calls.append(path)
        if len(calls) == (1, 2, 2, 3)[step]:
            if step == 2:  # some ranges are there already
                real(df.filter("bucket < 2"), path, by, *rest)
            raise OSError("broken off")
        real(df, path, by, *rest)

    monkeypatch.setattr(sinks, "write_partitions", failing)
    with pytest.raises(OSError):
        log.compact()
    monkeypatch.setattr(sinks, "write_partitions", real)
    sinks.write_events(late, log.path, "w2")
    log.compact()
    log.compact()
    want = state(audit.current(first.unionByName(second).unionByName(late)))
    assert state(log.current()) == want and log.unfolded().count() == 0
