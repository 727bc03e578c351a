"""What can go wrong in a job, as data first and as exceptions second."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from plumbline.operators.metrics import quarantined_share


@dataclass(frozen=True)
class Failure:
    """One item that a stage could not finish, and why."""

    stage: str
    item: str
    cause: object

    def __str__(self) -> str:
        return f"[{self.stage}] {self.item}: {self.cause}"


class StageFailed(RuntimeError):
    """At least one item of a stage failed; all other items are finished and stored."""

    def __init__(self, failures: Sequence[Failure], outcomes: Mapping[str, Mapping[str, int]] | None = None) -> None:
        super().__init__("\n".join(map(str, failures)))
        self.failures = tuple(failures)
        self.outcomes = {} if outcomes is None else dict(outcomes)


class TooManyRejects(RuntimeError):
    """More rows went to quarantine than the limit allows; ``outcome`` has the keys written and quarantined."""

    def __init__(self, outcome: Mapping[str, int], limit: float) -> None:
        lost, rows = outcome["quarantined"], outcome["written"] + outcome["quarantined"]
        super().__init__(f"quarantine took {lost}/{rows} rows ({quarantined_share(outcome):.2%}); the limit is {limit:.2%}")
        self.outcome, self.limit = dict(outcome), limit
