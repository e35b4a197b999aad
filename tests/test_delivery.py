"""Delivery: one send per deliverable payload, ledger read back without
re-sending, undeliverables flagged, re-runs skip what was delivered."""

import os
import sys

from pyspark import cloudpickle

from lifeline.config import SyncConfig
from lifeline.operators import delivery, payload
from lifeline.plans import state_job
from lifeline.sources.inputs import load_testdata
from folders import SF_SMALL

CFG = SyncConfig(send_partitions=3)


class FileCountingTransport:
    """Appends one line per send to a file (works across Python workers)."""

    def __init__(self, path):
        self.path = path

    def open(self):
        self.fh = open(self.path, "a")

    def send(self, url, body, headers):
        assert headers["Content-Length"] == str(len(body))
        assert "api_secret=" in url
        self.fh.write(url + "\n")
        return 204

    def close(self):
        self.fh.close()


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_each_payload_sent_once(spark, tmp_path):
    log = tmp_path / "sent.log"
    batches = state_job.state_batches(load_testdata(spark, SF_SMALL), CFG)
    ledger = delivery.deliver(
        batches, payload.STATE_PAYLOAD_SCHEMA, CFG, FileCountingTransport(str(log)),
        ledger_path=str(tmp_path / "ledger"),
    )
    n = ledger.count()
    n_sent = ledger.where("sent").count()
    ledger.orderBy("batch_id").take(20)
    assert ledger.count() == n  # reading the ledger again sends nothing
    sent_lines = log.read_text().splitlines() if log.exists() else []
    assert len(sent_lines) == n_sent
    assert n == batches.agg({"n_payloads": "sum"}).first()[0]
    undeliverable = ledger.where("not deliverable")
    assert undeliverable.where("sent or status_code != 0").count() == 0

    # re-run against the first ledger: nothing left to send
    log2 = tmp_path / "sent2.log"
    again = delivery.deliver(
        batches, payload.STATE_PAYLOAD_SCHEMA, CFG, FileCountingTransport(str(log2)),
        ledger_path=str(tmp_path / "ledger2"), skip_delivered=ledger,
    )
    assert again.where("sent").count() == 0
    assert not log2.exists() or log2.read_text() == ""
    assert os.path.isdir(tmp_path / "ledger")


def test_urllib_transport_retries_without_network(monkeypatch):
    """Retry policy only; the POST itself is replaced (no socket opened)."""
    t = delivery.UrllibTransport({"secret-web": "v"}.__getitem__, retries=2, backoff=0)
    answers = iter([503, 429, 204])
    seen = []

    def fake(url, body, headers):
        seen.append(url)
        return next(answers)

    monkeypatch.setattr(t, "_post_once", fake)
    assert t.send("https://x.invalid/mp?measurement_id=G-1&api_secret=secret-web", b"{}", {}) == 204
    assert len(seen) == 3 and all(u.endswith("api_secret=v") for u in seen)
    t2 = delivery.UrllibTransport(retries=2, backoff=0)
    monkeypatch.setattr(t2, "_post_once", lambda *a: 400)
    assert t2.send("https://x.invalid/mp", b"{}", {}) == 400


class FailingTransport(FileCountingTransport):
    """Fails for good after some sends of a process."""

    def send(self, url, body, headers):
        self.n = getattr(self, "n", 0) + 1
        if self.n > 3:
            self.fh.flush()
            raise RuntimeError("endpoint gone")
        return super().send(url, body, headers)


def test_resume_sends_the_rest_only(spark, tmp_path):
    import pytest
    from lifeline.plans import daily

    cfg = SyncConfig(send_partitions=1, send_record_every=2, target_batch_size=5)
    inputs = load_testdata(spark, SF_SMALL, cfg)
    out, log = str(tmp_path / "out"), tmp_path / "sent.log"
    with pytest.raises(Exception, match="endpoint gone"):
        daily.run_state_sync(spark, inputs, cfg, out, FailingTransport(str(log)))
    before = spark.read.parquet(f"{out}/state_ledger").where("sent").count() if os.path.isdir(f"{out}/state_ledger") else 0
    rest = tmp_path / "rest.log"
    res = daily.run_state_sync(spark, inputs, cfg, out, FileCountingTransport(str(rest)), resume=True)
    assert res.ledger.count() == res.ledger.select("payload_id").distinct().count()
    assert len(rest.read_text().splitlines()) == res.ledger.where("sent").count() - before
    again = tmp_path / "again.log"
    daily.run_state_sync(spark, inputs, cfg, out, FileCountingTransport(str(again)), resume=True)
    assert not again.exists() or again.read_text() == ""


def test_payload_ids_do_not_depend_on_the_batches(spark):
    from dataclasses import replace

    ids = []
    for size in (29, 7):
        cfg = replace(CFG, target_batch_size=size)
        batches = state_job.state_batches(load_testdata(spark, SF_SMALL, cfg), cfg)
        rows = delivery.payload_wire_rows(batches, payload.STATE_PAYLOAD_SCHEMA, cfg)
        ids.append(sorted(r.payload_id for r in rows.select("payload_id").collect()))
    assert ids[0] == ids[1]


def test_day_states_written_twice_stay_the_same(spark, tmp_path):
    from lifeline.operators.identity import day_states, read_day_states, write_day_states

    analytics = load_testdata(spark, SF_SMALL).analytics
    path = str(tmp_path / "days")
    for _ in range(2):
        write_day_states(day_states(analytics.between("20240110", "20240115")), path)
    n = read_day_states(spark, path).count()
    write_day_states(day_states(analytics.between("20240115", "20240116")), path)
    states = read_day_states(spark, path)
    assert states.select("user_id", "suffix").distinct().count() == states.count() > n > 0


def test_secrets_are_resolved_where_they_are_used(monkeypatch):
    monkeypatch.setenv("LIFELINE_SECRET_WEB", "hush-value")
    t = delivery.UrllibTransport(retries=0)
    seen = []
    monkeypatch.setattr(t, "_post_once", lambda url, *_: seen.append(url) or 204)
    t.send("https://x.invalid/mp?measurement_id=G-1&api_secret=secret-web", b"{}", {})
    assert seen == ["https://x.invalid/mp?measurement_id=G-1&api_secret=hush-value"]
    plain = delivery.UrllibTransport()
    plain._secret("secret-web")
    assert b"hush-value" not in cloudpickle.dumps(plain)


def test_senders_follow_from_payloads_and_rate():
    cfg = SyncConfig(sends_per_second=10, send_seconds=60, max_senders=50)
    assert [delivery.senders(n, cfg) for n in (0, 1, 600, 601, 29_999, 10**9)] == [1, 1, 1, 2, 50, 50]


class KilledTransport(FileCountingTransport):
    """The process dies (as with a lost executor) at its fifth send, once."""

    def __init__(self, path, mark):
        super().__init__(path)
        self.mark = mark

    def send(self, url, body, headers):
        self.n = getattr(self, "n", 0) + 1
        if self.n == 5 and not os.path.exists(self.mark):
            open(self.mark, "w").close()
            self.fh.flush()
            os._exit(1)
        return super().send(url, body, headers)


KILLED_RUN = """
import sys, json
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate())
import test_delivery as t
from lifeline.config import SyncConfig
from lifeline.operators import delivery, payload
from lifeline.plans import state_job
cfg = SyncConfig(send_partitions=2, send_record_every=1, target_batch_size=5)
batches = state_job.state_batches(t.load_testdata(spark, t.SF_SMALL), cfg)
ledger = delivery.deliver(batches, payload.STATE_PAYLOAD_SCHEMA, cfg, t.KilledTransport({log!r}, {mark!r}), {ledger!r})
plain = delivery.deliver(batches, payload.STATE_PAYLOAD_SCHEMA, cfg)
print(json.dumps([ledger.count(), ledger.where("sent").count(), ledger.exceptAll(plain).count(), plain.exceptAll(ledger).count()]))
"""


def test_a_killed_task_commits_nothing_twice(tmp_path):
    """A worker dies part-way; its next attempt sends the rest, and the ledger
    equals that of an undisturbed run."""
    import json
    import subprocess

    tests = os.path.dirname(os.path.abspath(__file__))
    log, ledger = str(tmp_path / "sent.log"), str(tmp_path / "ledger")
    code = KILLED_RUN.format(repo=os.path.dirname(tests), tests=tests, log=log, mark=str(tmp_path / "killed"), ledger=ledger)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    n, n_sent, more, less = json.loads(done.stdout.strip().splitlines()[-1])
    assert os.path.exists(tmp_path / "killed")
    assert n > 5 and more == less == 0
    with open(log) as file:
        assert len(file.read().splitlines()) == n_sent
    (run,) = os.listdir(f"{ledger}/_runs")
    with open(f"{ledger}/_runs/{run}") as file:
        closed = json.load(file)
    assert (closed["state"], closed["payloads"]) == ("committed", n)


def test_an_aborted_run_says_so(spark, tmp_path):
    import json

    import pytest

    batches = state_job.state_batches(load_testdata(spark, SF_SMALL), CFG)
    ledger = str(tmp_path / "ledger")
    with pytest.raises(Exception, match="endpoint gone"):
        delivery.deliver(batches, payload.STATE_PAYLOAD_SCHEMA, CFG, FailingTransport(str(tmp_path / "log")), ledger)
    (run,) = os.listdir(f"{ledger}/_runs")
    with open(f"{ledger}/_runs/{run}") as file:
        assert json.load(file)["state"] == "aborted"
    recorded = spark.read.schema(delivery.LEDGER_SCHEMA).parquet(ledger)
    assert recorded.where("sent").count() == len((tmp_path / "log").read_text().splitlines()) > 0


def test_no_payloads_give_an_empty_ledger(spark, tmp_path):
    batches = state_job.state_batches(load_testdata(spark, SF_SMALL), CFG).limit(0)
    assert delivery.deliver(batches, payload.STATE_PAYLOAD_SCHEMA, CFG, ledger_path=str(tmp_path / "none")).count() == 0
