"""Which compacted runs a table has, and which batch folders they stand for.

A run holds the rows of many batches in few files a day, under ``table_runs/<table>/_run=<n>``;
``_batch`` is a column of it. A state file names the runs that count. Each state is a new file that is
renamed into place, and the latest counts, so a swap is seen as a whole or not at all:

* rows of a run count unless the state lists their (batch, run) as replaced by a later attempt,
* batch folders that the state lists as taken do not count; they and merged runs stay until the
  next call, so that queries planned before the swap still find their files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import quote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from clearwell.session import hadoop_path
from clearwell.sinks.manifest import read_json, write_json
from clearwell.sinks.writers import BATCH, batch_path

RUN = "_run"
RUNS = "table_runs"
STATES = "table_states"


@dataclass(frozen=True)
class State:
    version: int = 0
    # Bytes of each run.
    runs: dict[str, int] = field(default_factory=dict)
    # The run that has the rows of a batch.
    batches: dict[str, str] = field(default_factory=dict)
    replaced: frozenset[tuple[str, str]] = frozenset()
    # What the next call deletes: batch folders and runs.
    taken: frozenset[str] = frozenset()
    merged: frozenset[str] = frozenset()

    def in_folders(self) -> Column:
        """Rows of batch folders that count."""
        return ~F.col(BATCH).isin(sorted(self.taken)) if self.taken else F.lit(True)

    def in_runs(self) -> Column:
        """Rows of runs that count."""
        gone = [f"{run}/{batch}" for batch, run in sorted(self.replaced)]
        return ~F.concat_ws("/", RUN, BATCH).isin(gone) if gone else F.lit(True)

    def folders_sql(self) -> str:
        """``in_folders`` for SQL text; batch ids have no quotes."""
        return f"`{BATCH}` NOT IN ({_listed(self.taken)})" if self.taken else "true"

    def runs_sql(self) -> str:
        gone = [f"{run}/{batch}" for batch, run in self.replaced]
        counts = f"`{RUN}` IN ({_listed(self.runs)})"
        return f"{counts} AND concat_ws('/', `{RUN}`, `{BATCH}`) NOT IN ({_listed(gone)})" if gone else counts


def _listed(values: Iterable[str]) -> str:
    return ", ".join(f"'{value}'" for value in sorted(values))


def runs_path(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{RUNS}/{quote(table, safe='')}"


def run_path(lake: str, table: str, run: str) -> str:
    return f"{runs_path(lake, table)}/{RUN}={run}"


def _states(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{STATES}/{quote(table, safe='')}"


def state_of(spark: SparkSession, lake: str, table: str) -> State:
    rows = read_json(spark, _states(lake, table))
    if not rows:
        return State()
    last = max(rows, key=lambda row: row["version"])
    return State(
        last["version"],
        last["runs"],
        last["batches"],
        frozenset(map(tuple, last["replaced"])),
        frozenset(last["taken"]),
        frozenset(last["merged"]),
    )


def save_state(spark: SparkSession, lake: str, table: str, state: State) -> State:
    """Make ``state`` the one that counts; of the older ones the last is kept."""
    state = replace(state, version=state.version + 1)
    folder = _states(lake, table)
    row = {
        "version": state.version,
        "runs": state.runs,
        "batches": state.batches,
        "replaced": sorted(state.replaced),
        "taken": sorted(state.taken),
        "merged": sorted(state.merged),
    }
    write_json(spark, f"{folder}/{state.version:08d}.json", [row])
    files, old = hadoop_path(spark, f"{folder}/{state.version - 2:08d}.json")
    files.delete(old, False)
    return state


def release(spark: SparkSession, lake: str, table: str, batch_id: str) -> None:
    """Before a batch is written again: its folder counts from now on, its rows in a run do not."""
    state = state_of(spark, lake, table)
    run = state.batches.get(batch_id)
    if run is not None:
        others = {batch: at for batch, at in state.batches.items() if batch != batch_id}
        replaced = state.replaced | {(batch_id, run)}
        save_state(spark, lake, table, replace(state, batches=others, replaced=replaced, taken=state.taken - {batch_id}))


def live_batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that have a folder, from a listing of one level."""
    files, folder = hadoop_path(spark, path)
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(name.removeprefix(f"{BATCH}=") for name in names if name.startswith(f"{BATCH}="))


def bytes_below(spark: SparkSession, paths: Sequence[str]) -> int:
    total = 0
    for path in paths:
        files, folder = hadoop_path(spark, path)
        total += files.getContentSummary(folder).getLength()
    return total


def clear(spark: SparkSession, lake: str, table: str, path: str) -> State:
    """Delete what the last swap left behind."""
    state = state_of(spark, lake, table)
    if not (state.taken or state.merged):
        return state
    gone = [batch_path(path, batch) for batch in state.taken] + [run_path(lake, table, run) for run in state.merged]
    for folder in gone:
        files, target = hadoop_path(spark, folder)
        files.delete(target, True)
    return save_state(spark, lake, table, replace(state, taken=frozenset(), merged=frozenset()))
