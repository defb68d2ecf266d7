"""Outcomes of sends: what a status means, and bounded retries with back-off.

A sender returns a status text. ``outcome(status)`` says what it means: ``sent``, ``retry``
(the receiver may take it later) or ``refused``. A batch is tried ``attempts`` times at most,
with growing waits between; a sender that raises counts as ``retry``. What is given up is
``refused``: its row keeps the text, and :func:`redelivery_queue` makes payloads of such rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.batching import batch_keys

#: Status codes that a receiver answers when it may accept the same request later.
RETRY_CODES = ("408", "425", "429")


def http_outcome(status: str) -> str:
    """``sent`` for 2xx, ``retry`` for 5xx and the codes that ask to wait, else ``refused``."""
    if status.startswith("2"):
        return "sent"
    return "retry" if status.startswith("5") or status[:3] in RETRY_CODES else "refused"


@dataclass(frozen=True)
class Retry:
    """How often and how long a batch is tried: waits of ``wait * factor ** n`` seconds, ``longest`` at most."""

    attempts: int = 4
    wait: float = 0.5
    factor: float = 2.0
    longest: float = 30.0
    outcome: Callable[[str], str] = http_outcome

    def __post_init__(self) -> None:
        if self.attempts < 1:
            raise ValueError("attempts must be positive")

    def send(self, send: Callable[[str, dict], str], payload: str, destination: dict) -> tuple[str, int, str]:
        """(last status, attempts made, ``sent`` or ``refused``)."""
        for attempt in range(1, self.attempts + 1):
            try:
                status = send(payload, destination)
                outcome = self.outcome(status)
            except Exception as e:  # noqa: BLE001 - whatever the transport raises is an attempt that failed
                status, outcome = f"{type(e).__name__}: {e}", "retry"
            if outcome != "retry":
                break
            if attempt < self.attempts:
                time.sleep(min(self.longest, self.wait * self.factor ** (attempt - 1)))
        return status, attempt, "sent" if outcome == "sent" else "refused"


def redelivery_queue(ledger: DataFrame) -> DataFrame:
    """The refused batches of a ledger, or of the rejected rows that ``ship`` returns, as payloads to be shipped again."""
    part = [c for c in ("part",) if c in ledger.columns]
    return ledger.where(F.col("outcome") == "refused").select(
        *batch_keys(ledger), "batch_id", *part, "n_events", "n_bytes", F.col("dead_letter").alias("payload"))
