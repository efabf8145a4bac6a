"""Stream operators with state of their own, kept by Spark: running totals, city changes, accounts flagged once.

State lies in Spark's state store and its checkpoint, so a restarted query goes on where it stopped and a batch that is
run again starts from the state before it. Work per batch follows the batch and the timers that are due.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.enrich import score_transaction
from ..operators.metrics import running_emissions, type_and_status

# Processors travel with the query, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RunningTotals(StatefulProcessor):
    """Count, sum, largest and smallest value of a key after every ``every``-th of its rows, in sequence order.

    The state is one small row per key. Of a batch, a key's rows are held as two numbers each.
    """

    def __init__(self, every: int):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "n long, known long, total double, hi double, lo double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(p["seq"].to_numpy(np.int64), p["valor"].to_numpy(np.float64)) for p in rows]
        seq, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(seq, kind="stable")
        seq, value = seq[order], value[order]
        n, known, total, hi, lo = self.totals.get() or (0, 0, 0.0, -np.inf, np.inf)
        given = ~np.isnan(value)
        ns = n + np.arange(1, len(seq) + 1)
        knowns = known + np.cumsum(given)
        totals = total + np.cumsum(np.where(given, value, 0))
        his = np.maximum(np.maximum.accumulate(np.where(given, value, -np.inf)), hi)
        los = np.minimum(np.minimum.accumulate(np.where(given, value, np.inf)), lo)
        self.totals.update((int(ns[-1]), int(knowns[-1]), float(totals[-1]), float(his[-1]), float(los[-1])))
        at = np.flatnonzero(ns % self.every == 0)
        empty = knowns[at] == 0
        yield pd.DataFrame({
            "chave": [key[0]] * len(at), "n": ns[at], "seq": seq[at],
            **{name: pd.Series(np.where(empty, np.nan, x[at]), dtype="Float64") for name, x in (("total", totals), ("hi", his), ("lo", los))},
        })

    def close(self) -> None:
        pass


def running_metrics_stream(stream: DataFrame, every: int = 100, sequence: str = "id") -> DataFrame:
    """``metrics.running_metrics`` on a stream: the figures at every ``every``-th transaction of a type and status.

    Rows of a batch are taken in sequence order; later batches must have later sequences for a table to give the same.
    Rows without a sequence are left out.
    """
    rows = stream.where(F.col(sequence).isNotNull()).select(
        type_and_status().alias("chave"), F.col(sequence).cast("long").alias("seq"), F.col("valor").cast("double").alias("valor")
    )
    running = rows.groupBy("chave").transformWithStateInPandas(
        RunningTotals(every), "chave string, n long, seq long, total double, hi double, lo double", "Append", "None"
    )
    return running_emissions(running, every)


class LocationChanges(StatefulProcessor):
    """Transactions whose city differs from the account's transaction before, in event-time order.

    Rows wait until the watermark has passed them, as an earlier one may still come. The state of an account is those
    rows and its last transaction; the last one is forgotten ``horizon_ms`` after its time, if a horizon is given.
    """

    def __init__(self, horizon_ms: int | None):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, id long, cidade string")
        self.last = handle.getValueState("last", "us long, cidade string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = [(r["us"], r["id"], r["cidade"]) for r in rows]
        self.waiting.appendList(found)
        self.handle.registerTimer(min(found)[0] // 1000)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(self.waiting.get(), key=lambda r: (r[0], r[1]))
        due = [r for r in waiting if r[0] <= until * 1000]
        last = self.last.get()
        for us, row_id, city in due:
            if last is not None and self.horizon_ms is not None and us - last[0] > self.horizon_ms * 1000:
                last = None
            if last is not None and city is not None and last[1] is not None and city != last[1]:
                yield Row(conta_id=key[0], id=row_id, us=us, cidade=city, prev_us=last[0], prev_cidade=last[1])
            last = (us, city)
        rest = waiting[len(due) :]
        if due:
            self.last.update(last)
            if rest:
                self.waiting.put([tuple(r) for r in rest])
            else:
                self.waiting.clear()
        if rest:
            self.handle.registerTimer(rest[0][0] // 1000)
        elif last is not None and self.horizon_ms is not None:
            forget = last[0] // 1000 + self.horizon_ms
            if forget < until:
                self.last.clear()
            else:
                self.handle.registerTimer(forget)

    def close(self) -> None:
        pass


def location_change_stream(stream: DataFrame, horizon_ms: int | None = None) -> DataFrame:
    """R4 on a stream with a watermark on ``data_transacao``: see ``alerts.location_change``.

    Without a horizon the alerts are those of the table rule. With one, a transaction raises no alert when the account's
    previous one is further back, and the state of silent accounts expires. Rows behind the watermark are dropped; rows
    without account or time have no previous one and are left out.
    """
    ts = F.col("data_transacao")
    rows = stream.where(F.col("conta_id").isNotNull() & ts.isNotNull()).select(
        "conta_id", F.col("id").cast("long").alias("id"), "cidade", "data_transacao", F.unix_micros(ts).alias("us")
    )
    changed = rows.groupBy("conta_id").transformWithState(
        LocationChanges(horizon_ms), "conta_id long, id long, us long, cidade string, prev_us long, prev_cidade string", "Append", "EventTime"
    )
    return changed.select(
        F.concat(F.lit("ALT-R4-"), F.col("id").cast("string")).alias("alerta_id"),
        "conta_id",
        F.col("id").alias("transacao_id"),
        F.lit("DESVIO_GEOGRAFICO").alias("tipo_fraude"),
        F.col("prev_cidade").alias("cidade_anterior"),
        "cidade",
        F.timestamp_micros("prev_us").alias("timestamp_anterior"),
        F.timestamp_micros("us").alias("timestamp_alerta"),
    )


def flagged_account_stream(stream: DataFrame, horizon: str, threshold: float = 0.7, as_of=None) -> DataFrame:
    """(account_id, data_transacao) of an account's first high-risk transaction, and not again within the horizon.

    The state of an account expires once the watermark, which lags by ``horizon``, has passed its transaction by another
    ``horizon``; an account that goes on after that is flagged again. ``alerts.flagged_accounts`` keeps accounts for ever.
    """
    risky = score_transaction(stream, as_of).where(F.col("calculated_risk_score") > threshold)
    marked = risky.select(F.col("conta_id").alias("account_id"), "data_transacao")
    return marked.withWatermark("data_transacao", horizon).dropDuplicatesWithinWatermark(["account_id"])
