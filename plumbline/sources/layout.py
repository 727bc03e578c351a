"""Where the datasets of a run lie."""

from __future__ import annotations

import re
from datetime import datetime

#: A run id that is an ISO time, maybe after a manual prefix and with an offset that is not part of the folder name.
_TIMED = re.compile(r"(?:manual__)?(\d{4}-\d\d-\d\dT[\d:.]+)(?:\+.*)?")


def run_folder(run_id: str) -> str:
    """Folder name of a run: its time in compact form, or the run id itself if it holds none."""
    timed = _TIMED.fullmatch(run_id)
    try:
        return datetime.fromisoformat(timed[1]).strftime("%Y%m%dT%H%M%S.%fZ") if timed else run_id
    except ValueError:
        return run_id


def dataset_path(base: str, run_id: str, name: str) -> str:
    return "/".join((base.rstrip("/"), f"run_id={run_folder(run_id)}", f"{name}.parquet"))
