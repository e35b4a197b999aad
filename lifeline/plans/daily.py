"""The daily runs end to end: batches written once, read back, delivered.

    python -m lifeline.plans.daily state  --snapshot S --subscription-events E \\
        --analytics A --out O --as-of 2024-01-31T07:00:00+01:00
    python -m lifeline.plans.daily events ... [--identity-state P --state-through YYYYMMDD]
        [--new-identity-state Q]

The command line sends nothing (dry-run transport); the functions take any
transport.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lifeline.config import SyncConfig
from lifeline.operators import batching, delivery, payload
from lifeline.operators.identity import (
    day_states,
    first_touch_state,
    fold_shards,
    merge_first_touch,
    read_day_states,
    write_day_states,
    write_state,
)
from lifeline.operators.identity_store import IdentityStore
from lifeline.plans import events_job, state_job
from lifeline.sources.inputs import Inputs
from lifeline.sources.shards import changed_shards


@dataclass(frozen=True)
class SyncResult:
    batches: DataFrame
    ledger: DataFrame
    batches_path: str
    ledger_path: str


def _ship(
    spark: SparkSession,
    batches: DataFrame,
    schema,
    cfg: SyncConfig,
    out_dir: str,
    name: str,
    transport,
    resume: bool,
) -> SyncResult:
    """Write the batches, read them back and deliver.  With ``resume``,
    batches are written again and payloads that the ledger in ``out_dir``
    has as delivered are not sent again."""
    bpath, lpath = f"{out_dir}/{name}_batches", f"{out_dir}/{name}_ledger"
    batches.write.mode("overwrite" if resume else "errorifexists").parquet(bpath)
    stored = spark.read.parquet(bpath)
    done = None
    if resume:
        # an empty commit first: there may be no ledger yet
        spark.createDataFrame([], delivery.LEDGER_SCHEMA).write.mode("append").parquet(lpath)
        done = spark.read.schema(delivery.LEDGER_SCHEMA).parquet(lpath)
    ledger = delivery.deliver(stored, schema, cfg, transport, lpath, done)
    return SyncResult(stored, ledger, bpath, lpath)


def _fingerprints(path: str) -> str:
    """Beside a state's files, in a folder that readers of the state pass over."""
    return f"{path.rstrip('/')}/_fingerprints"


def _has_fingerprints(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(_fingerprints(path) + "/_SUCCESS")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _read_fingerprints(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(_fingerprints(path)) if _has_fingerprints(spark, path) else None


def _write_fingerprints(now: DataFrame, path: str) -> None:
    """After the state: a run that fails between folds the same shards again."""
    now.coalesce(1).write.mode("overwrite").parquet(_fingerprints(path))


def run_state_sync(
    spark: SparkSession,
    inputs: Inputs,
    cfg: SyncConfig,
    out_dir: str,
    transport=None,
    day_states_path: str | None = None,
    states_through: str | None = None,
    resume: bool = False,
    kept: state_job.SnapshotStates | None = None,
    new_kept_path: str | None = None,
) -> SyncResult:
    """Subscription state -> user-property payload batches -> delivery.

    With ``day_states_path``, the complete shards up to yesterday that are new,
    or hold something else than when they were folded (late events), are
    stored in that day-state table first; the identity then reads stored days
    and only today's shard raw.  A table without fingerprints is taken to be right
    through ``states_through``.

    With ``new_kept_path``, what is ``kept`` of the snapshot (of all its days if
    nothing is) is carried on through yesterday and stored there; the run then
    reads today's snapshot only."""
    stored = None
    if day_states_path:
        through = cfg.shard(cfg.yesterday_local)
        now = inputs.analytics.fingerprints(through)
        changed = changed_shards(_read_fingerprints(spark, day_states_path), now)
        if states_through is not None and not _has_fingerprints(spark, day_states_path):
            changed = [s for s in changed if s > states_through]
        if changed:
            write_day_states(day_states(inputs.analytics.only(changed)), day_states_path)
            _write_fingerprints(now, day_states_path)
        stored, states_through = read_day_states(spark, day_states_path), through
    if new_kept_path:
        state_job.SnapshotStates.fold(inputs.snapshot, cfg, cfg.yesterday_local, kept).write(new_kept_path)
        kept = state_job.SnapshotStates.read(spark, new_kept_path, cfg.yesterday_local)
    batches = state_job.state_batches(inputs, cfg, stored, states_through, kept)
    return _ship(spark, batches, payload.STATE_PAYLOAD_SCHEMA, cfg, out_dir, "state", transport, resume)


def run_events_sync(
    spark: SparkSession,
    inputs: Inputs,
    cfg: SyncConfig,
    out_dir: str,
    transport=None,
    identity_state_path: str | None = None,
    state_through: str | None = None,
    new_identity_state_path: str | None = None,
    resume: bool = False,
    identity_store: IdentityStore | None = None,
) -> SyncResult:
    """Yesterday's subscription events -> event payload batches -> delivery.

    With ``identity_state_path`` (a state folded through ``state_through``)
    only later shards are read for identity.  With
    ``new_identity_state_path`` the complete shards through yesterday are
    folded into a new state version first (the run then reads today's
    shard only), and so are earlier shards that changed since the stored
    version was made: a minimum of minima takes late events in.

    An ``identity_store`` takes the place of both: it is updated through
    yesterday, which writes a delta only, and looked up by bucket."""
    if identity_store is not None:
        identity_store.update(inputs.analytics, cfg.shard(cfg.yesterday_local))
        payloads = events_job.event_payloads(inputs, cfg, identity_store)
        batches = batching.batches(batching.assign_buckets(payloads, cfg))
        return _ship(spark, batches, payload.EVENT_PAYLOAD_SCHEMA, cfg, out_dir, "events", transport, resume)
    state = spark.read.parquet(identity_state_path) if identity_state_path else None
    if new_identity_state_path:
        through = cfg.shard(cfg.yesterday_local)
        now = inputs.analytics.fingerprints(through)
        if state is not None and _has_fingerprints(spark, identity_state_path):
            changed = changed_shards(_read_fingerprints(spark, identity_state_path), now)
            folded = merge_first_touch(state, first_touch_state(inputs.analytics.only(changed))) if changed else state
        else:
            folded = fold_shards(state, inputs.analytics, state_through, through)
        write_state(folded, new_identity_state_path)
        _write_fingerprints(now, new_identity_state_path)
        state, state_through = spark.read.parquet(new_identity_state_path), through
    payloads = events_job.event_payloads(inputs, cfg, state, state_through)
    batches = batching.batches(batching.assign_buckets(payloads, cfg))
    return _ship(spark, batches, payload.EVENT_PAYLOAD_SCHEMA, cfg, out_dir, "events", transport, resume)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="lifeline.plans.daily")
    ap.add_argument("job", choices=("state", "events"))
    ap.add_argument("--snapshot", required=True)
    ap.add_argument("--subscription-events", required=True)
    ap.add_argument("--events-by-day", action="store_true", help="subscription events are partitioned by event_day (UTC)")
    ap.add_argument("--analytics", required=True, help="suffix-partitioned dataset")
    ap.add_argument("--out", required=True)
    ap.add_argument(
        "--as-of",
        help="ISO instant with offset (default: now); pass it from the scheduler so reruns "
        "reproduce the same day",
    )
    ap.add_argument("--zone", default=SyncConfig().zone)
    ap.add_argument("--identity-state")
    ap.add_argument("--state-through")
    ap.add_argument("--new-identity-state")
    ap.add_argument("--day-states", help="suffix-partitioned day-state table (state job)")
    ap.add_argument("--day-states-through")
    ap.add_argument("--kept", help="snapshot states of an earlier run (state job)")
    ap.add_argument("--kept-through", type=dt.date.fromisoformat)
    ap.add_argument("--new-kept", help="folder of the snapshot states through yesterday")
    ap.add_argument("--resume", action="store_true", help="go on with the ledger already in --out")
    args = ap.parse_args(argv)
    as_of = (
        dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc)
    )
    cfg = SyncConfig(as_of=as_of, zone=args.zone)
    spark = SparkSession.builder.appName(f"lifeline-{args.job}").getOrCreate()
    inputs = Inputs.read(spark, args.snapshot, args.subscription_events, args.analytics, args.events_by_day)
    if args.job == "state":
        kept = state_job.SnapshotStates.read(spark, args.kept, args.kept_through) if args.kept else None
        res = run_state_sync(
            spark, inputs, cfg, args.out, None, args.day_states, args.day_states_through, args.resume, kept, args.new_kept
        )
    else:
        res = run_events_sync(
            spark, inputs, cfg, args.out, None,
            args.identity_state, args.state_through, args.new_identity_state, args.resume,
        )
    rollup = delivery.status_rollup(res.ledger).collect()  # a handful of rows
    for r in rollup:
        print(r.asDict())


if __name__ == "__main__":
    main()
