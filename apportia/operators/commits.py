"""Tables that change together: a load's new partitions become visible in one step, or not at all.

A folder holds data, one sub-folder for each run that wrote some, and numbered commits. A commit is a small
JSON text that names, for each partition of each table, the run whose files it is made of, and the marks
loads have reached. Its number is one above that of the commit it was made from, and a number is taken
once: of two runs that start from the same commit the second finds it taken and gets a ``Conflict``.
Files of runs that no commit names are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "__run"


class Conflict(RuntimeError):
    """Another run has committed since the state that this one was made from."""


@dataclass(frozen=True)
class State:
    """Commit ``number`` (0: none yet); per table its partitions (values as JSON text) and the run of each; marks."""

    number: int = 0
    tables: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    marks: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Change:
    """Rows to store, and the partitions they take the place of: those ``replaced`` besides the ones they are in."""

    rows: DataFrame
    replaced: tuple[str, ...] = ()


class Tables:
    """``partition_by`` names the partition columns, the same for all tables of the folder."""

    def __init__(self, spark: SparkSession, root: str, partition_by: list[str]):
        self.spark, self.root, self.partition_by = spark, root, partition_by
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def state(self) -> State:
        folder = self.path(f"{self.root}/commits")
        if not self.files.exists(folder):
            return State()
        names = [f.getPath().getName() for f in self.files.listStatus(folder)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit() and n.endswith(".json")]
        if not numbers:
            return State()
        text = self.spark.read.text(f"{self.root}/commits/{max(numbers)}.json", wholetext=True).first()[0]
        return State(max(numbers), **json.loads(text))

    def read(self, table: str, state: State | None = None, only=None) -> DataFrame | None:
        """A table as of a state, now by default; None where it has no rows. ``only`` picks partitions by their values."""
        held = (state or self.state()).tables.get(table, {})
        picked = [(json.loads(p), run) for p, run in held.items() if only is None or only(json.loads(p))]
        if not picked:
            return None
        base = f"{self.root}/data/{table}"
        paths = ["/".join([base, f"{RUN}={run}", *[f"{c}={v}" for c, v in zip(self.partition_by, values)]]) for values, run in picked]
        return self.spark.read.option("basePath", base).parquet(*paths).drop(RUN)

    def partitions(self, rows: DataFrame) -> list[str]:
        """Partition values of rows; as many as there are partitions, so few enough for the driver."""
        found = rows.select(*self.partition_by).distinct().collect()
        if any(v is None for r in found for v in r):
            raise ValueError(f"null in {self.partition_by}")
        return sorted(json.dumps(list(r)) for r in found)

    def commit(self, base: State, changes: Mapping[str, Change], marks: Mapping[str, str] | None = None) -> State:
        """Write all changes, then make them visible at once; raises ``Conflict`` if ``base`` is not the last state."""
        run = uuid.uuid4().hex
        tables = {t: dict(p) for t, p in base.tables.items()}
        for name, change in changes.items():
            held = tables.setdefault(name, {})
            change.rows.hint("rebalance", *self.partition_by).write.partitionBy(*self.partition_by).parquet(
                f"{self.root}/data/{name}/{RUN}={run}"
            )
            for p in change.replaced:
                held.pop(p, None)
            held.update(dict.fromkeys(self.partitions(change.rows), run))
        state = State(base.number + 1, tables, {**base.marks, **(marks or {})})
        self.publish(state)
        return state

    def publish(self, state: State) -> None:
        """Write a commit beside its place and rename it there; a rename onto a file that exists fails."""
        jvm = self.spark._jvm
        text = json.dumps({"tables": state.tables, "marks": state.marks}, sort_keys=True)
        aside = self.path(f"{self.root}/commits/_{uuid.uuid4().hex}")
        out = self.files.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        place = self.path(f"{self.root}/commits/{state.number}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        try:
            context.rename(self.files.makeQualified(aside), self.files.makeQualified(place), options)
        except Exception as e:
            self.files.delete(aside, False)
            if self.files.exists(place):
                raise Conflict(f"commit {state.number} is taken") from e
            raise

    def vacuum(self, keep: int = 1) -> int:
        """Delete commits but the last ``keep`` and the runs that those no longer name; returns the folders deleted.

        Not to be run while a load is under way: its files are named by no commit yet.
        """
        last = self.state().number
        texts = [self.spark.read.text(f"{self.root}/commits/{n}.json", wholetext=True).first()[0] for n in range(max(1, last - keep + 1), last + 1)]
        named = {(t, run) for text in texts for t, p in json.loads(text)["tables"].items() for run in p.values()}
        for n in range(1, last - keep + 1):
            self.files.delete(self.path(f"{self.root}/commits/{n}.json"), False)
        gone = 0
        data = self.path(f"{self.root}/data")
        for table in self.files.listStatus(data) if self.files.exists(data) else []:
            for run in self.files.listStatus(table.getPath()):
                if (table.getPath().getName(), run.getPath().getName().removeprefix(f"{RUN}=")) not in named:
                    gone += self.files.delete(run.getPath(), True)
        return gone


def replaced_rows(tables: Tables, state: State, table: str, new: DataFrame, touched, gone, on: list[str] | None = None) -> Change:
    """New rows in the place of stored ones: ``gone`` is a condition, or the keys ``on`` whose rows go.

    Only partitions whose values (a list, in the order of ``partition_by``) satisfy ``touched`` are read and
    written again, together with those that the new rows are in.
    """
    here = {json.dumps(v) for v in map(json.loads, tables.partitions(new))}
    mine = lambda values: bool(touched(values)) or json.dumps(values) in here
    old = tables.read(table, state, mine)
    if old is None:
        return Change(new)
    kept = old.where(~F.coalesce(gone, F.lit(False))) if not isinstance(gone, DataFrame) else old.join(gone, on, "left_anti")
    replaced = tuple(p for p in state.tables.get(table, {}) if mine(json.loads(p)))
    return Change(kept.select(*new.columns).unionByName(new), replaced)
