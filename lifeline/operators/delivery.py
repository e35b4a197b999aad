"""Delivery of payloads through an injected transport, into a ledger.

Batches are exploded back into payloads (``from_json``) and wire bodies are
built with column expressions; the send itself is a Python data source's
writer.  Each task sends the payloads of its batches in order and records what
it sent in ledger files of its own, every ``send_record_every`` payloads and
when it fails; its commit message tells the counts, and the driver's commit (or
abort) closes the run.  An attempt that follows a failed one reads what that
one recorded and sends only the rest, so a payload is in the ledger once.  Only
payloads sent after the last record of an attempt that was killed outright are
sent again (at most ``send_record_every`` of them).

The number of senders follows from the number of payloads and the stated rate
of one sender.  The ledger is read back from storage, so counting or previewing
it never re-runs the sends; ``skip_delivered`` makes a re-run skip payload ids
that an earlier ledger already records as delivered.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Iterator, Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lifeline.config import SyncConfig
from lifeline.functions.routing import route_columns
from lifeline.operators.payload import wire_columns
from lifeline.session import checkpoint_dir

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("payload_index", T.IntegerType()),
        T.StructField("payload_id", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("deliverable", T.BooleanType()),
        T.StructField("content_length", T.IntegerType()),
        T.StructField("sent", T.BooleanType()),
        # response status; 0 when nothing was sent (undeliverable payload)
        T.StructField("status_code", T.IntegerType()),
    ]
)


class Transport(Protocol):
    """Picklable sender; ``open`` runs once per partition on the executor."""

    def open(self) -> None: ...

    def send(self, url: str, body: bytes, headers: dict[str, str]) -> int: ...

    def close(self) -> None: ...


class DryRunTransport:
    """Sends nothing; answers 204 (no content) for every payload."""

    def open(self) -> None:
        pass

    def send(self, url: str, body: bytes, headers: dict[str, str]) -> int:
        return 204

    def close(self) -> None:
        pass


class EnvSecrets:
    """Values of secret names from the executor's environment: the name in
    capitals, ``-`` as ``_``, behind ``prefix``."""

    def __init__(self, prefix: str = "LIFELINE_") -> None:
        self.prefix = prefix

    def __call__(self, name: str) -> str:
        return os.environ[self.prefix + name.upper().replace("-", "_")]


class UrllibTransport:
    """Plain HTTPS POST with the standard library.  ``resolve`` gives the value
    of a secret *name* found in a URL; it is called on the executor, once a
    name, and the values are never pickled.
    Answers 429 and 5xx, and network errors, are retried ``retries`` times
    with exponential backoff; the last answer is recorded (599 for a
    network error)."""

    def __init__(
        self, resolve: Callable[[str], str] | None = None, timeout: float = 10.0, retries: int = 3, backoff: float = 0.5
    ) -> None:
        self.resolve = resolve or EnvSecrets()
        self.timeout = timeout
        self.retries = retries
        self.backoff = backoff
        self._values: dict[str, str] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_values": {}}

    def _secret(self, name: str) -> str:
        if name not in self._values:
            self._values[name] = self.resolve(name)
        return self._values[name]

    def open(self) -> None:
        pass

    def _post_once(self, url: str, body: bytes, headers: dict[str, str]) -> int:
        import urllib.error
        import urllib.request

        req = urllib.request.Request(url, data=body, headers=headers, method="POST")
        try:
            with urllib.request.urlopen(req, timeout=self.timeout) as resp:
                return resp.status
        except urllib.error.HTTPError as err:
            return err.code
        except OSError:
            return 599

    def send(self, url: str, body: bytes, headers: dict[str, str]) -> int:
        import time

        base, _, name = url.partition("&api_secret=")
        real = f"{base}&api_secret={self._secret(name)}" if name else url
        code = self._post_once(real, body, headers)
        for attempt in range(self.retries):
            if code != 429 and code < 500:
                break
            time.sleep(self.backoff * (2**attempt))
            code = self._post_once(real, body, headers)
        return code

    def close(self) -> None:
        pass


def payload_wire_rows(batch_df: DataFrame, schema: T.StructType, cfg: SyncConfig) -> DataFrame:
    """One row per payload of every batch, with its wire body (each batch's
    JSON array is parsed once, straight into payload structs)."""
    items = batch_df.select(
        "app_id",
        F.concat_ws(":", F.col("app_id"), F.col("bucket").cast("string")).alias("batch_id"),
        F.posexplode(F.from_json(F.col("payload_array"), T.ArrayType(schema))).alias(
            "payload_index", "p"
        ),
    )
    w = wire_columns(F.col("p"), schema)
    return items.select(
        "batch_id",
        F.col("payload_index").cast("int").alias("payload_index"),
        # by day, endpoint and body: batches may be cut otherwise on a re-run
        F.sha2(F.concat_ws("|", F.lit(str(cfg.today_local)), w["url"], w["body"]), 256).alias("payload_id"),
        route_columns(F.col("app_id"), cfg)["route"].alias("route"),
        w["deliverable"].alias("deliverable"),
        w["content_length"].cast("int").alias("content_length"),
        w["url"].alias("url"),
        w["body"].alias("body"),
    )


def store(uri: str):
    """(file system, path) of a qualified path, on the driver or an executor."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"file://{rest.replace('//', '', 1) if rest.startswith('///') else rest}" if scheme == "file" else uri)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark's own writers would use."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


@dataclass
class TaskSent(WriterCommitMessage):
    partition: int
    payloads: int
    sent: int
    recorded_before: int


_LEDGER_ARROW = pa.schema(
    [
        ("batch_id", pa.string()), ("payload_index", pa.int32()), ("payload_id", pa.string()), ("route", pa.string()),
        ("deliverable", pa.bool_()), ("content_length", pa.int32()), ("sent", pa.bool_()), ("status_code", pa.int32()),
    ]
)


class LedgerFiles:
    """The ledger files of one task of a run, from all of its attempts."""

    def __init__(self, uri: str, run: str, partition: int):
        self.fs, self.root = store(uri)
        self.prefix = f"part-{run}-{partition:05d}-"

    def recorded(self) -> set[str]:
        """Payload ids that earlier attempts recorded."""
        from pyarrow import fs

        names = [f.path for f in self.fs.get_file_info(fs.FileSelector(self.root)) if f.base_name.startswith(self.prefix)]
        out: set[str] = set()
        for name in names:
            with self.fs.open_input_file(name) as file:
                out.update(pq.read_table(file, columns=["payload_id"]).column(0).to_pylist())
        return out

    def record(self, rows: list[dict]) -> None:
        """One more file, visible only when complete."""
        if not rows:
            return
        name = f"{self.prefix}{uuid.uuid4().hex}.parquet"
        with self.fs.open_output_stream(f"{self.root}/_{name}") as file:
            pq.write_table(pa.Table.from_pylist(rows, schema=_LEDGER_ARROW), file)
        self.fs.move(f"{self.root}/_{name}", f"{self.root}/{name}")


def _post(transport, row: dict) -> int:
    if not row["deliverable"]:
        return 0
    data = row["body"].encode("utf-8")
    return int(transport.send(row["url"], data, {"Content-Type": "application/json", "Content-Length": str(len(data))}))


class DeliveryWriter(DataSourceArrowWriter):
    """Sends what each task gets; see the module's text."""

    def __init__(self, transport, uri: str, run: str, record_every: int):
        self.transport, self.uri, self.run, self.record_every = transport, uri, run, record_every

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskSent:
        partition = TaskContext.get().partitionId()
        files = LedgerFiles(self.uri, self.run, partition)
        done, rows, n, n_sent = files.recorded(), [], 0, 0
        before = len(done)
        self.transport.open()
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if row["payload_id"] in done:
                        continue
                    code = _post(self.transport, row)
                    rows.append({**{c: row[c] for c in _LEDGER_ARROW.names[:6]}, "sent": row["deliverable"], "status_code": code})
                    n, n_sent = n + 1, n_sent + row["deliverable"]
                    if len(rows) >= self.record_every:
                        files.record(rows)
                        rows = []
        finally:  # what was sent is recorded, also when a send failed for good
            files.record(rows)
            self.transport.close()
        return TaskSent(partition, n, n_sent, before)

    def _close(self, state: str, messages: list[TaskSent | None]) -> None:
        told = [m for m in messages if m is not None]
        fs, root = store(self.uri)
        fs.create_dir(f"{root}/_runs")
        with fs.open_output_stream(f"{root}/_runs/{self.run}.json") as file:
            totals = {"tasks": len(told), "payloads": sum(m.payloads + m.recorded_before for m in told), "sent_last": sum(m.sent for m in told)}
            file.write(json.dumps({"state": state, **totals}).encode())

    def commit(self, messages: list[TaskSent | None]) -> None:
        self._close("committed", messages)

    def abort(self, messages: list[TaskSent | None]) -> None:
        self._close("aborted", messages)


def _sink(transport, uri: str, run: str, record_every: int) -> type[DataSource]:
    """A data source of this run; the transport travels with the class."""
    writer = DeliveryWriter(transport, uri, run, record_every)

    class Delivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lifeline_delivery"

        def writer(self, schema, overwrite):
            return writer

    return Delivery


def senders(n_payloads: int, cfg: SyncConfig) -> int:
    """Tasks that send ``n_payloads`` at the stated rate within the stated time."""
    if cfg.send_partitions is not None:
        return cfg.send_partitions
    return int(min(cfg.max_senders, max(1, -(-n_payloads // (cfg.sends_per_second * cfg.send_seconds)))))


def deliver(
    batch_df: DataFrame,
    schema: T.StructType,
    cfg: SyncConfig,
    transport=None,
    ledger_path: str | None = None,
    skip_delivered: DataFrame | None = None,
) -> DataFrame:
    """Send every deliverable payload once, record it in the ledger at
    ``ledger_path`` (default: a fresh folder under the checkpoint folder)
    and return the ledger as read back from storage.

    Payloads that ``skip_delivered`` (an earlier ledger) has as delivered (or
    undeliverable) are left out; that ledger may be the one at ``ledger_path``,
    which is then added to."""
    spark = batch_df.sparkSession
    transport = transport or DryRunTransport()
    # the sink and transports travel by value, so executors need no copy of
    # this package for the send itself (ship it with --py-files for everything
    # else)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    if ledger_path is None:
        ledger_path = f"{checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    # an empty file first: a run without payloads has a ledger too
    empty = spark.createDataFrame([], LEDGER_SCHEMA).coalesce(1)
    empty.write.mode("errorifexists" if skip_delivered is None else "append").parquet(ledger_path)
    n = batch_df.agg(F.sum("n_payloads")).first()[0] or 0
    rows = payload_wire_rows(batch_df, schema, cfg)
    if skip_delivered is not None:
        done = skip_delivered.where(
            ~F.col("deliverable") | (F.col("sent") & F.col("status_code").between(200, 299))
        ).select("payload_id")
        rows = rows.join(done, "payload_id", "left_anti")
    rows = rows.repartition(senders(n, cfg), "batch_id").sortWithinPartitions("batch_id", "payload_index")
    spark.dataSource.register(_sink(transport, qualified(spark, ledger_path), uuid.uuid4().hex, cfg.send_record_every))
    rows.write.format("lifeline_delivery").mode("append").save()
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def status_rollup(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("route", "sent", "status_code").agg(
        F.count(F.lit(1)).alias("n_payloads"),
        F.sum("content_length").cast("long").alias("bytes"),
    )
