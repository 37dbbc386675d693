"""The speed layer: messages in, history, alerts and cells out."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telltale.operators.alerts import alert_details, run_rule_text
from telltale.operators.cells import to_cells
from telltale.operators.decode import bad, decode, placed
from telltale.schema import READING_FIELDS
from telltale.session import run_dir
from telltale.sinks.commits import OWN_LOG, Attempt, committed
from telltale.sinks.tables import add_to
from telltale.sources.rules import RuleSet
from telltale.streaming.batches import start_batches


class BadMessages(ValueError):
    """A batch holds messages that are no readings."""


@dataclass(frozen=True)
class SpeedLayer:
    """What happens to a batch of messages.

    ``rules`` is checked once; give a function, ``reloaded`` for example, to have
    them loaded again. They are loaded before anything of a batch is written. An
    output without a path is left out. ``rule_text`` is a user's own rule
    query over the views ``inbox_view`` and ``rules_view``; its result goes to
    ``rule_text_path``. With ``guard`` it may be nothing else than one query over these. ``on_bad`` is ``"fail"`` (stop before anything of the
    batch is written) or ``"quarantine"``. ``copy_path`` is a second place for
    the readings, for example an object store.

    All outputs of a batch count at once, by one entry in the log at ``log_path``;
    without one it lies beside the first output, as ``_commits``. Each table says where its
    log is, so readers need its path only.
    """

    rules: RuleSet | Callable[[], RuleSet]
    log_path: str | None = None
    history_path: str | None = None
    copy_path: str | None = None
    alerts_path: str | None = None
    cells_path: str | None = None
    quarantine_path: str | None = None
    rule_text: str | None = None
    rule_text_path: str | None = None
    inbox_view: str = "inbox"
    rules_view: str = "rules"
    cell_stamp: Column | None = None
    cell_metric: str | None = None
    guard: bool = True
    on_bad: str = "fail"
    peek_rows: int = 0

    def __post_init__(self) -> None:
        if self.on_bad not in ("fail", "quarantine"):
            raise ValueError("on_bad is 'fail' or 'quarantine'")
        if self.on_bad == "quarantine" and self.quarantine_path is None:
            raise ValueError("quarantine needs a quarantine_path")
        if (self.rule_text is None) != (self.rule_text_path is None):
            raise ValueError("rule_text and rule_text_path belong together")

    def process(self, messages: DataFrame, batch: str, number: int = 0) -> None:
        """Write all outputs of one batch of a stream.

        The batch is decoded once and held by the executors for all outputs; its
        size is bounded by the source, and lost blocks are decoded again.
        """
        decoded = decode(messages).persist()
        try:
            self.write(decoded, batch)
        finally:
            decoded.unpersist()

    def write(self, decoded: DataFrame, batch: str, of: str | None = None) -> None:
        """Write all outputs of decoded messages.

        None of them counts before all are written, and then all count at once in
        place of those of an earlier attempt at the batch, also where this one has
        fewer days, no alerts or no bad messages. Work runs in as many tasks as the
        messages came in; rows are gathered at each write only.
        """
        attempt = Attempt(decoded.sparkSession, batch, self._log(), of)
        # Writes of one version count in the order of their batches.
        arrival = F.lit(time.time_ns() // 1000)
        total, wrong = decoded.agg(
            F.count("*"), F.count_if(F.col("problem").isNotNull())
        ).first()
        if total == 0:
            attempt.commit_nothing()
            return
        if wrong and self.on_bad == "fail":
            raise BadMessages(f"batch {batch}: {wrong} of {total} messages unreadable")
        rules = None
        if self.alerts_path is not None or self.rule_text is not None:
            rules = self.rules() if callable(self.rules) else self.rules

        readings = placed(decoded)
        if self.peek_rows:
            readings.show(self.peek_rows, truncate=False)
        for path in (self.history_path, self.copy_path):
            if path is not None:
                add_to(attempt, readings.select(*READING_FIELDS), path, "messagedate")
        if self.alerts_path is not None:
            found = alert_details(readings, rules)
            add_to(attempt, found, self.alerts_path, "messagedate")
        if self.rule_text is not None:
            self._write_own_rule(attempt, readings.select(*READING_FIELDS), rules)
        if self.cells_path is not None:
            cells = to_cells(readings, self.cell_stamp, self.cell_metric, arrival=arrival)
            add_to(attempt, cells, self.cells_path, "version")
        if wrong:
            letters = bad(decoded).withColumn("received", F.current_timestamp())
            add_to(attempt, letters, self.quarantine_path)
        attempt.commit()

    def _log(self) -> str | None:
        if self.log_path is not None:
            return self.log_path
        outputs = (
            self.history_path, self.alerts_path, self.cells_path, self.rule_text_path,
            self.quarantine_path, self.copy_path,
        )
        first = next((p for p in outputs if p is not None), None)
        return None if first is None else f"{first.rpartition('/')[0]}/{OWN_LOG}"

    def _write_own_rule(self, attempt: Attempt, readings: DataFrame, rules: RuleSet) -> None:
        # A stream works in a session of its own; a view of the rules reaches it
        # as a global one.
        session = readings.sparkSession
        shared = f"rules_{uuid.uuid4().hex}"
        rules.frame.createOrReplaceGlobalTempView(shared)
        session.table(f"global_temp.{shared}").createOrReplaceTempView(self.rules_view)
        readings.createOrReplaceTempView(self.inbox_view)
        try:
            views = (self.inbox_view, self.rules_view)
            found = run_rule_text(session, self.rule_text, views if self.guard else None)
            add_to(attempt, found, self.rule_text_path)
        finally:
            session.catalog.dropGlobalTempView(shared)

    def start(
        self, messages: DataFrame, checkpoint: str, interval: str | None = "1 second"
    ) -> StreamingQuery:
        """Start the stream. ``interval=None`` handles what is there and ends."""
        return start_batches(messages.writeStream, self.process, checkpoint, interval)


def run_once(layer: SpeedLayer, messages: DataFrame, run: str | None = None) -> None:
    """The same work on a batch frame, without a stream.

    A named run replaces what it wrote before; an unnamed one adds to the tables.
    What is there may be of any size, so the decoded messages are kept in the
    shared folder and not by the executors.
    """
    path = run_dir(messages.sparkSession, "decoded")
    decoded = decode(messages)
    decoded.write.parquet(path)
    stored = messages.sparkSession.read.schema(decoded.schema).parquet(path)
    layer.write(stored, f"{run or uuid.uuid4()}-0")


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """What counts of a written output, without its bookkeeping columns."""
    return committed(spark, path).drop("event_date", "batch")
