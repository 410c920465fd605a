"""The hourly record load: watermark, newest copies, flattening or routing, partitioned write, log row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from spanledger.functions.dates import TimeLike
from spanledger.operators.flatten import RECORD_ROUTES, Route, flatten_json, route
from spanledger.operators.incremental import dedup_latest, incremental_extract
from spanledger.plans.batch import _utc_now, commit_batch, new_batch_id, read_control, run_batch


def load_records(
    source: DataFrame,
    target_path: str,
    control_path: str,
    run_ts: TimeLike,
    target: str = "records",
    lookback: tuple[int, str] = (1, "hour"),
    batch_id: str | None = None,
    key: str = "record_id",
    updated_col: str = "updated_at",
    clock: Callable[[], TimeLike] = _utc_now,
    exactly_once: bool = False,
    **paths,
) -> int:
    """Append the newest copy of every record changed since the target's mark, flattened; returns the rows written.

    The log decides where to read on from, so a failed or empty run is made up for by the next one. With
    ``exactly_once`` the target holds a folder for each batch and is read by ``read_committed``; otherwise rows are
    appended and a run that is lost before its log row may leave duplicates. ``paths`` are those of ``flatten_json``.
    """
    batch_id = batch_id or new_batch_id()
    control = read_control(source.sparkSession, control_path)
    changed = incremental_extract(source, control, run_ts, lookback, target, updated_col=updated_col)
    rows = flatten_json(dedup_latest(changed, key, updated_col), updated_col=updated_col, batch_id=batch_id,
                        processed_at=run_ts, **paths)
    deliver = commit_batch if exactly_once else run_batch
    return deliver(rows, target_path, control_path, batch_id, updated_col=updated_col, target=target, clock=clock)


def load_routed(
    source: DataFrame,
    root: str,
    control_path: str,
    run_ts: TimeLike,
    rules: Sequence[Route] = RECORD_ROUTES,
    lookback: tuple[int, str] = (1, "hour"),
    batch_id: str | None = None,
    key: str = "record_id",
    updated_col: str = "updated_at",
    clock: Callable[[], TimeLike] = _utc_now,
    exactly_once: bool = False,
) -> dict[str, int]:
    """Load every target below ``root`` from its own mark, with its own log row; returns the rows written to each.

    Every target is tried. If some fail, their rows in the log say so and the first error is raised at the end; the
    next run reads those targets from their old marks. ``exactly_once`` as for ``load_records``.
    """
    deliver = commit_batch if exactly_once else run_batch
    batch_id = batch_id or new_batch_id()
    control = read_control(source.sparkSession, control_path)
    written, errors = {}, []
    for rule in rules:
        changed = incremental_extract(source, control, run_ts, lookback, rule.target, updated_col=updated_col)
        rows = route(dedup_latest(changed, key, updated_col), rule, updated_col=updated_col, batch_id=batch_id)
        try:
            written[rule.target] = deliver(rows, f"{root.rstrip('/')}/{rule.target}", control_path, batch_id,
                                             updated_col=updated_col, target=rule.target, clock=clock)
        except Exception as error:
            errors.append(error)
    if errors:
        raise errors[0]
    return written
