"""Lookup services: batches of terms sent concurrently, tried again with backoff, cut smaller when refused; no term is lost.

Every term comes back once, either with what the service says of it or with the reason why it says nothing. So a failed
batch never passes for terms without a mapping: the failures are rows of their own, which a later run takes up again.
"""

from __future__ import annotations

import random
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .llm_calls import Retryable

#: Terms of a batch, batches at a time in a task, attempts, the shortest and longest wait between them, and the seconds an attempt may take.
BATCH_TERMS, WORKERS, ATTEMPTS, WAIT, LONGEST_WAIT, TIMEOUT = 4000, 4, 4, 2.0, 8.0, 30.0
#: Statuses that may go away: too many requests, and faults of the server.
TOO_MANY, SERVER_FAULT = 429, 500

Term = tuple[str, str | None]
Reply = dict[str, list[dict]]
ITEM = "struct<ontology_id:string,ontology_label:string,ontology:string>"
ANSWERED = f"term string, items array<{ITEM}>, failure string, attempts int"


class HttpError(Exception):
    """A reply other than 200; `after` are the seconds that the service asks to wait, if it does."""

    def __init__(self, status: int, text: str = "", after: float | None = None):
        super().__init__(f"HTTP {status}" + (f": {text[:300]}" if text else ""))
        self.status, self.after = status, after


def may_pass(error: BaseException) -> bool:
    """Whether the same call may succeed later."""
    if isinstance(error, HttpError):
        return error.status == TOO_MANY or error.status >= SERVER_FAULT
    return isinstance(error, (Retryable, TimeoutError, ConnectionError))


@dataclass(frozen=True)
class Policy:
    """How a service is called. `timeout` is that of an attempt; None waits for ever. `cut` says whether a batch that fails for good is halved until what is refused stands alone."""

    batch: int = BATCH_TERMS
    workers: int = WORKERS
    attempts: int = ATTEMPTS
    wait: float = WAIT
    longest: float = LONGEST_WAIT
    timeout: float | None = TIMEOUT
    cut: bool = True

    def pause(self, attempt: int, error: BaseException) -> float:
        """Seconds before the attempt after number `attempt` (0, 1, ..): doubling, with a quarter of jitter so that tasks don't return together."""
        asked = getattr(error, "after", None)
        pause = min(self.longest, self.wait * 2**attempt) * (1 + random.random() / 4)
        return max(asked, pause) if asked is not None else pause


def within(call: Callable, argument, seconds: float | None):
    """call(argument), or TimeoutError after so many seconds; a call that hangs is left to itself."""
    if seconds is None:
        return call(argument)
    done: list = []

    def run() -> None:
        try:
            done.append((call(argument), None))
        except BaseException as e:
            done.append((None, e))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(seconds)
    if not done:
        raise TimeoutError(f"no reply in {seconds:g} s")
    value, error = done[0]
    if error is not None:
        raise error
    return value


def patient(call: Callable, policy: Policy) -> Callable:
    """(value, error, attempts) of a call, tried again while its error may pass."""

    def run(argument) -> tuple:
        for n in range(max(1, policy.attempts)):
            try:
                return within(call, argument, policy.timeout), None, n + 1
            except Exception as e:
                if n + 1 >= policy.attempts or not may_pass(e):
                    return None, e, n + 1
                time.sleep(policy.pause(n, e))
        raise AssertionError

    return run


def answers(part: list[Term], call: Callable[[list[Term]], Reply], policy: Policy) -> list[tuple[str, list | None, str | None, int]]:
    """(term, items, failure, attempts) of each term of a batch. What fails for good is cut in halves, so that one bad term costs a few calls and not the batch."""
    value, error, attempts = patient(call, policy)(part)
    if error is None:
        if isinstance(value, dict):
            return [(t, items if isinstance(items := value.get(t), list) else [], None, attempts) for t, _ in part]
        error = TypeError(f"a reply of type {type(value).__name__}")
    if policy.cut and len(part) > 1 and not may_pass(error):
        half = len(part) // 2
        rows = answers(part[:half], call, policy) + answers(part[half:], call, policy)
        return [(t, items, failure, n + attempts) for t, items, failure, n in rows]
    return [(t, None, f"{type(error).__name__}: {error}", attempts) for t, _ in part]


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[Term]]:
    """Full batches of terms, whatever the size of Arrow's."""
    held: list[Term] = []
    for b in batches:
        for term, context in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held.append((term, context))
            if len(held) == size:
                yield held
                held = []
    if held:
        yield held


def ask(terms: DataFrame, call: Callable[[list[Term]], Reply], policy: Policy = Policy()) -> DataFrame:
    """(term, items, failure, attempts) of each row of `terms` (term, context): what a service that maps a batch to candidates says.

    A task has `policy.workers` batches on their way and no more read ahead. failure is null where the service replied, also if it
    had nothing on a term (items is empty then). A null term is not asked for and fails as such.
    """
    item = pa.struct([("ontology_id", pa.string()), ("ontology_label", pa.string()), ("ontology", pa.string())])
    kinds = [pa.string(), pa.list_(item), pa.string(), pa.int32()]

    def picked(items: list | None) -> list[dict] | None:
        return None if items is None else [{k: None if x.get(k) is None else str(x[k]) for k in ("ontology_id", "ontology_label", "ontology")} for x in items if isinstance(x, dict)]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        rows = [(t, picked(items), failure, n) for t, items, failure, n in rows]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["term", "items", "failure", "attempts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max(1, policy.workers)) as pool:
            going: deque[Future] = deque()
            for part in _batches(batches, max(1, policy.batch)):
                asked = [x for x in part if x[0] is not None]
                if len(asked) < len(part):
                    yield made([(None, None, "null term", 0)] * (len(part) - len(asked)))
                if asked:
                    going.append(pool.submit(answers, asked, call, policy))
                while len(going) >= policy.workers:
                    yield made(going.popleft().result())
            while going:
                yield made(going.popleft().result())

    context = F.col("context") if "context" in terms.columns else F.lit(None)
    return terms.select(F.col("term").cast("string").alias("term"), context.cast("string").alias("context")).mapInArrow(run, ANSWERED)


def answered(asked: DataFrame) -> DataFrame:
    """(term, items) of the terms on which the service replied."""
    return asked.where("failure IS NULL").select("term", "items")


def failures(asked: DataFrame) -> DataFrame:
    """(term, failure, attempts) of the terms on which it didn't."""
    return asked.where("failure IS NOT NULL").select("term", "failure", "attempts")
