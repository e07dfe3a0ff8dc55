"""Versions of a keyed table as a log of changes, with branches and tags.

Every commit writes only its changed rows (``_op`` U for upsert, D for delete)
to a folder of its own; a *base* commit holds the full state instead. One
small log lists the commits, each with the columns valid from then on, and the
moves of branches and tags. A state is the newest base of a commit's ancestry, less the
keys changed since, plus the newest change of each such key, so the base is
never shuffled while the changes are few.

A commit's rows are written first and its log row, which also moves the branch,
second: a crash in between leaves unreachable rows and nothing else. One writer
per table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane import scratch
from marketlane.functions.money import money_sum
from marketlane.operators.joins import BROADCAST_ROWS
from marketlane.operators.quality import duplicate_keys
from marketlane.operators.upsert import DuplicateKeys, changed_rows, newest_per_key

UPSERT, DELETE = "U", "D"

# One row per action: "commit" adds a commit and moves a branch to it, "move" sets or
# drops a ref, "rebase" gives a commit a base of its own, "forget" drops a commit.
_LOG = (
    "seq BIGINT, action STRING, name STRING, kind STRING, commit_id BIGINT, parent_id BIGINT, "
    "made_at TIMESTAMP_NTZ, operation STRING, base BOOLEAN, rows BIGINT, path STRING, columns STRING, batch STRING, "
    "merged_id BIGINT"
)


@dataclass(frozen=True)
class Commit:
    commit_id: int
    parent_id: int | None
    made_at: dt.datetime
    operation: str
    base: bool
    rows: int
    path: str | None  # None when the commit changes no rows
    columns: str  # JSON list of {name, type, stored}
    batch: str | None = None
    merged_id: int | None = None  # head of the branch this commit brought in


@dataclass
class _Logs:
    """Commits by id, live refs by name as (kind, commit id), and the last sequence number used."""

    commits: dict[int, Commit]
    refs: dict[str, tuple[str, int]]
    last: int

    def head(self, ref: str) -> int:
        if ref not in self.refs:
            raise UnknownVersion(f"no branch or tag {ref}")
        return self.refs[ref][1]

    def columns(self, ref: str) -> list[dict]:
        return json.loads(self.commits[self.head(ref)].columns)

    def line(self, commit_id: int) -> list[Commit]:
        """The commit and its ancestors, newest first."""
        if commit_id not in self.commits:
            raise UnknownVersion(f"no commit {commit_id}")
        line, at = [], self.commits.get(commit_id)
        while at is not None:
            line.append(at)
            at = self.commits.get(at.parent_id) if at.parent_id is not None else None
        return line


    def seen(self, line: list[Commit]) -> set[int]:
        """Commits whose changes are part of a line, its own or merged in."""
        found = {c.commit_id for c in line}
        for c in line:
            if c.merged_id is not None and c.merged_id in self.commits and c.merged_id not in found:
                found |= self.seen(self.line(c.merged_id))
        return found


class MergeConflict(ValueError):
    """Both branches changed the same key."""


class UnknownVersion(LookupError):
    """No such commit, branch or tag, or nothing committed by that time."""


class VersionedTable:
    """A table under ``root`` whose rows are identified by ``keys``."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys

    # ------------------------------------------------------------------ logs

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).json(f"{self.root}/log")

    def _append(self, *rows: dict) -> None:
        """Add log rows in one write, so that an action is in the log as a whole or not at all."""
        fields = T.StructType.fromDDL(_LOG).fields
        added = None
        for row in rows:
            cells = [F.lit(str(row[f.name]) if f.name == "made_at" else row[f.name]) if row.get(f.name) is not None
                     else F.lit(None) for f in fields]
            one = self.spark.range(1, numPartitions=1).select(
                *[c.cast(f.dataType).alias(f.name) for c, f in zip(cells, fields)]
            )
            added = one if added is None else added.unionByName(one)
        added.coalesce(1).write.mode("append").json(f"{self.root}/log")

    def _logs(self) -> _Logs:
        """The log as it stands: one row per action, whatever the table's size."""
        logs = _Logs({}, {}, 0)
        for r in sorted(self._log().collect(), key=lambda r: r["seq"]):
            logs.last = r["seq"]
            if r["action"] in ("commit", "rebase"):
                logs.commits[r["commit_id"]] = Commit(**{f: r[f] for f in Commit.__dataclass_fields__})
            if r["action"] == "forget":
                logs.commits.pop(r["commit_id"], None)
            if r["name"] is not None:
                logs.refs[r["name"]] = (r["kind"], r["commit_id"])
        logs.refs = {name: ref for name, ref in logs.refs.items() if ref[1] is not None}
        return logs

    def _move(self, logs: _Logs, name: str, kind: str, commit_id: int | None, at: dt.datetime) -> None:
        self._append(
            {"seq": logs.last + 1, "action": "move", "name": name, "kind": kind, "commit_id": commit_id, "made_at": at}
        )

    def refs(self, kind: str | None = None) -> DataFrame:
        """Branches and tags in force: the last row of each name, unless it dropped the name."""
        named = self._log().where("name IS NOT NULL")
        listed = newest_per_key(named, ["name"], "seq").where("commit_id IS NOT NULL")
        listed = listed.select("name", "kind", "commit_id")
        return listed if kind is None else listed.where(F.col("kind") == kind)

    def head(self, ref: str = "main") -> int:
        return self._logs().head(ref)

    # --------------------------------------------------------------- columns

    @staticmethod
    def _entry(field: T.StructField, stored: str | None = None) -> dict:
        return {"name": field.name, "type": field.dataType.simpleString(), "stored": stored or field.name}

    @staticmethod
    def _stored_schema(columns: list[dict]) -> str:
        seen = {}
        for c in columns:
            seen.setdefault(c["stored"], c["type"])
        return ", ".join(f"`{name}` {kind}" for name, kind in seen.items())

    @staticmethod
    def _as_stored(columns: list[dict]) -> list[Column]:
        """Select list from shown to stored columns; one that shows another's values is not stored."""
        first = {}
        for c in columns:
            first.setdefault(c["stored"], c)
        return [F.col(c["name"]).cast(c["type"]).alias(place) for place, c in first.items()]

    # --------------------------------------------------------------- writing

    def create(self, rows: DataFrame, at: dt.datetime, operation: str = "load") -> int:
        """First commit of branch ``main``, with the full state."""
        columns = [self._entry(f) for f in rows.schema.fields]
        return self._commit(_Logs({}, {}, 0), rows, None, "main", at, operation, columns, base=True)

    def _commit(
        self,
        logs: _Logs,
        rows: DataFrame | None,
        parent: int | None,
        ref: str,
        at: dt.datetime,
        operation: str,
        columns: list[dict],
        base: bool = False,
        batch: str | None = None,
        unique: bool = False,
        merged_id: int | None = None,
    ) -> int:
        """Write rows, then the log row. ``unique`` says that no key can occur twice in ``rows``.

        A branch's times rise: a commit dated before its parent is refused, as
        reading as of a time would show it too early.
        """
        if parent is not None and at < logs.commits[parent].made_at:
            raise ValueError(f"a commit at {at} would come before its parent")
        path, written = None, 0
        if rows is not None:
            if "_op" not in rows.columns:
                rows = rows.withColumn("_op", F.lit(UPSERT))
            path = f"changes/{uuid.uuid4().hex}"
            rows.select(*self._as_stored(columns), "_op").write.parquet(f"{self.root}/{path}")
            written = self._check_written(path, columns, unique)
        seq = logs.last + 1
        commit = Commit(seq, parent, at, operation, base, written, path, json.dumps(columns), batch, merged_id)
        self._append({**vars(commit), "seq": seq, "action": "commit", "name": ref, "kind": "branch"})
        return seq

    def _check_written(self, path: str, columns: list[dict], unique: bool) -> int:
        """Rows written to ``path``; a key there more than once is refused, leaving the table as it was."""
        saved = self.spark.read.schema(self._stored_schema(columns)).parquet(f"{self.root}/{path}")
        written = saved.count()  # from the file footers
        stored = {c["name"]: c["stored"] for c in columns}
        if not unique and not duplicate_keys(saved, [stored[k] for k in self.keys]).isEmpty():
            raise DuplicateKeys(f"several rows of one commit share {', '.join(self.keys)}")
        return written

    def commit(
        self,
        changes: DataFrame,
        at: dt.datetime,
        ref: str = "main",
        operation: str = "append",
        batch: str | None = None,
    ) -> int:
        """Add changed rows to a branch. ``_op`` marks deletes; without it every row is an upsert."""
        logs = self._logs()
        head = logs.head(ref)
        if logs.refs[ref][0] != "branch":
            raise ValueError(f"{ref} is a tag")
        return self._commit(logs, changes, head, ref, at, operation, logs.columns(ref), batch=batch)

    def merge_rows(
        self,
        source: DataFrame,
        at: dt.datetime,
        update: list[str],
        insert: list[str] | None = None,
        ref: str = "main",
        batch: str | None = None,
        newer_by: str | None = None,
    ) -> int:
        """Upsert ``source`` into a branch; a ``batch`` already committed there is left alone.

        With ``newer_by`` only newer rows update (see ``changed_rows``), the
        commit is dated no earlier than the branch's last, and nothing is
        committed where nothing changes.
        """
        logs = self._logs()
        line = logs.line(logs.head(ref))
        if batch is not None:
            done = [c.commit_id for c in line if c.batch == batch]
            if done:
                return done[0]
        changes = changed_rows(self._state(line), source, self.keys, update, insert, newer_by=newer_by)
        if newer_by is not None:
            at = max(at, line[0].made_at)
            with scratch.held(changes, "changes") as changes:
                if changes.isEmpty():
                    return line[0].commit_id
                columns = logs.columns(ref)
                return self._commit(logs, changes, line[0].commit_id, ref, at, "merge", columns, batch=batch, unique=True)
        columns = logs.columns(ref)
        return self._commit(logs, changes, line[0].commit_id, ref, at, "merge", columns, batch=batch, unique=True)

    def replace(self, rows: DataFrame, at: dt.datetime, ref: str = "main") -> int:
        """A new full state on a branch; its history stays readable."""
        logs = self._logs()
        return self._commit(logs, rows, logs.head(ref), ref, at, "replace", logs.columns(ref), base=True)

    # --------------------------------------------------------------- reading

    def _rows(self, commit: Commit, columns: list[dict], extra: str = "") -> DataFrame:
        schema = self._stored_schema(columns) + extra
        return self.spark.read.schema(schema).parquet(f"{self.root}/{commit.path}")

    def _shown(self, df: DataFrame, columns: list[dict], *more: str) -> DataFrame:
        return df.select(*[F.col(c["stored"]).cast(c["type"]).alias(c["name"]) for c in columns], *more)

    def _changes(self, commits: list[Commit], columns: list[dict]) -> DataFrame:
        """Newest change of each key over ``commits`` (newest first), with its ``_op``."""
        parts = [
            self._shown(self._rows(c, columns, ", _op STRING"), columns, "_op").withColumn("_age", F.lit(age))
            for age, c in enumerate(commits)
        ]
        if len(parts) == 1:
            return parts[0].drop("_age")
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        newest = Window.partitionBy(*self.keys).orderBy("_age")
        return merged.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "_age")

    def _state(self, line: list[Commit]) -> DataFrame:
        columns = json.loads(line[0].columns)
        depth = next(i for i, c in enumerate(line) if c.base)
        base = self._shown(self._rows(line[depth], columns), columns)
        deltas = [c for c in line[:depth] if c.path is not None]
        if not deltas:
            return base
        changes = self._changes(deltas, columns)
        touched = changes.select(*self.keys)
        if sum(c.rows for c in deltas) <= BROADCAST_ROWS:  # counted when written
            touched = F.broadcast(touched)
        untouched = base.join(touched, self.keys, "left_anti")
        return untouched.unionByName(changes.where(F.col("_op") == UPSERT).drop("_op"))

    def read(
        self, ref: str = "main", commit_id: int | None = None, at: dt.datetime | None = None
    ) -> DataFrame:
        """The state of a branch or tag, now, at a commit, or at a moment."""
        logs = self._logs()
        line = logs.line(logs.head(ref) if commit_id is None else commit_id)
        if at is not None:
            line = line[next((i for i, c in enumerate(line) if c.made_at <= at), len(line)) :]
            if not line:
                raise UnknownVersion(f"nothing committed to {ref} by {at}")
        return self._state(line)

    def snapshots(self, limit: int | None = None) -> DataFrame:
        """Commits, newest first."""
        about = self._log().where("action IN ('commit', 'rebase', 'forget')")
        listed = (
            newest_per_key(about, ["commit_id"], "seq")
            .where("action != 'forget'")
            .select(
                "commit_id",
                "parent_id",
                F.col("made_at").alias("committed_at"),
                "operation",
                F.col("rows").alias("changed_rows"),
            )
            .orderBy(F.col("committed_at").desc(), F.col("commit_id").desc())
        )
        return listed if limit is None else listed.limit(limit)

    def history(self, ref: str = "main") -> DataFrame:
        """Commits a branch has pointed to, newest first, and whether each is part of it now."""
        logs = self._logs()
        line = [c.commit_id for c in logs.line(logs.head(ref))]
        moves = self._log().where((F.col("name") == ref) & F.col("commit_id").isNotNull())
        parents = self.snapshots().select("commit_id", "parent_id", "operation")
        return (
            moves.select("commit_id", F.col("made_at").alias("made_current_at"), "seq")
            .join(parents, "commit_id", "left")
            .orderBy(F.col("seq").desc())
            .select(
                "made_current_at",
                "commit_id",
                "parent_id",
                "operation",
                F.col("commit_id").isin(line).alias("is_current_ancestor"),
            )
        )

    # ------------------------------------------------------- branches, tags

    def branch(self, name: str, at: dt.datetime, start: str = "main", commit_id: int | None = None) -> None:
        """Create a branch unless there is one of that name."""
        self._create_ref(name, "branch", at, start, commit_id)

    def tag(self, name: str, at: dt.datetime, start: str = "main", commit_id: int | None = None) -> None:
        self._create_ref(name, "tag", at, start, commit_id)

    def _create_ref(self, name: str, kind: str, at: dt.datetime, start: str, commit_id: int | None) -> None:
        logs = self._logs()
        if name not in logs.refs:
            self._move(logs, name, kind, logs.head(start) if commit_id is None else commit_id, at)

    def drop(self, name: str, at: dt.datetime) -> None:
        logs = self._logs()
        logs.head(name)  # must exist
        self._move(logs, name, logs.refs[name][0], None, at)

    def rollback(self, commit_id: int, at: dt.datetime, ref: str = "main") -> None:
        """Point a branch back at one of its earlier commits."""
        logs = self._logs()
        if commit_id not in [c.commit_id for c in logs.line(logs.head(ref))]:
            raise UnknownVersion(f"commit {commit_id} is not part of {ref}")
        self._move(logs, ref, "branch", commit_id, at)

    def merge(self, source: str, into: str, at: dt.datetime) -> int:
        """Bring a branch's changes into another.

        When ``into`` has not moved since the split, it is pointed at the
        source's head. Otherwise the source's changes are added to it, provided
        that no key changed on both sides.
        """
        logs = self._logs()
        ours, theirs = logs.line(logs.head(into)), logs.line(logs.head(source))
        if ours[0].commit_id in [c.commit_id for c in theirs]:
            self._move(logs, into, "branch", theirs[0].commit_id, at)
            return theirs[0].commit_id
        seen_here, seen_there = logs.seen(ours), logs.seen(theirs)
        if theirs[0].commit_id in seen_here:
            return ours[0].commit_id
        if not seen_here & seen_there:
            raise MergeConflict(f"{source} and {into} have no commit in common")
        # What one side did that the other has not seen; a merge of the other side is nothing new to it.
        new_ours = [c for c in ours if c.commit_id not in seen_there and c.merged_id not in seen_there]
        new_theirs = [c for c in theirs if c.commit_id not in seen_here and c.merged_id not in seen_here]
        for c in new_ours + new_theirs:
            if c.base and c.operation != "compact":
                raise MergeConflict(f"commit {c.commit_id} replaced the whole table since the split")
        split_columns = next(c.columns for c in theirs if c.commit_id in seen_here)
        if any(c.columns != split_columns for c in new_ours) and any(c.columns != split_columns for c in new_theirs):
            raise MergeConflict("both branches changed the columns since the split")
        # The side that evolved, if any, gives the columns of the result.
        columns = json.loads(ours[0].columns if ours[0].columns != split_columns else theirs[0].columns)
        theirs_rows = [c for c in new_theirs if c.path and not c.base]
        ours_rows = [c for c in new_ours if c.path and not c.base]
        changes = self._changes(theirs_rows, columns) if theirs_rows else None
        if changes is not None and ours_rows:
            other = self._changes(ours_rows, columns).select(*self.keys)
            if not changes.select(*self.keys).join(other, self.keys, "left_semi").isEmpty():
                raise MergeConflict(f"{source} and {into} changed the same keys")
        return self._commit(
            logs, changes, ours[0].commit_id, into, at, "merge branch", columns, unique=True,
            merged_id=theirs[0].commit_id,
        )

    # ------------------------------------------------------ schema evolution

    def _evolve(self, logs: _Logs, columns: list[dict], at: dt.datetime, ref: str, operation: str) -> int:
        return self._commit(logs, None, logs.head(ref), ref, at, operation, columns)

    def add_columns(
        self,
        ddl: str,
        at: dt.datetime,
        ref: str = "main",
        copy_from: dict[str, str] | None = None,
    ) -> int:
        """Add columns without rewriting any row; earlier rows show NULL.

        ``copy_from`` maps a new column to an existing one whose stored values it
        shows as well, cast to the new type. A name used before gets a storage
        name of its own, so dropped values do not come back.
        """
        logs, copied = self._logs(), copy_from or {}
        columns = logs.columns(ref)
        stored = {c["name"]: c["stored"] for c in columns}
        ever = {e["stored"] for c in logs.commits.values() for e in json.loads(c.columns)}
        for field in T.StructType.fromDDL(ddl).fields:
            if field.name in stored:
                raise ValueError(f"there is a column {field.name} already")
            if field.name in copied:
                place = stored[copied[field.name]]
            else:
                place = f"{field.name}__{logs.last + 1}" if field.name in ever else field.name
            columns.append(self._entry(field, place))
        return self._evolve(logs, columns, at, ref, "add columns")

    def drop_column(self, name: str, at: dt.datetime, ref: str = "main") -> int:
        """Hide a column from here on; earlier versions still show it."""
        if name in self.keys:
            raise ValueError(f"{name} identifies rows")
        logs = self._logs()
        columns = logs.columns(ref)
        kept = [c for c in columns if c["name"] != name]
        if len(kept) == len(columns):
            raise ValueError(f"no column {name}")
        return self._evolve(logs, kept, at, ref, "drop column")

    def widen_column(self, name: str, kind: str, at: dt.datetime, ref: str = "main") -> int:
        """Show a column with a wider type, such as INT as BIGINT."""
        logs = self._logs()
        columns = [{**c, "type": kind} if c["name"] == name else c for c in logs.columns(ref)]
        return self._evolve(logs, columns, at, ref, "widen column")

    def rename_column(self, name: str, new: str, at: dt.datetime, ref: str = "main") -> int:
        if name in self.keys:
            raise ValueError(f"{name} identifies rows")
        logs = self._logs()
        columns = [{**c, "name": new} if c["name"] == name else c for c in logs.columns(ref)]
        return self._evolve(logs, columns, at, ref, "rename column")

    # ----------------------------------------------------------- maintenance

    def compact(self, at: dt.datetime, ref: str = "main") -> int:
        """Fold a branch's changes into a new base; the contents stay the same."""
        logs = self._logs()
        head = logs.head(ref)
        state = self._state(logs.line(head)).hint("rebalance")
        return self._commit(logs, state, head, ref, at, "compact", logs.columns(ref), base=True, unique=True)

    def expire(self, older_than: dt.datetime) -> list[int]:
        """Forget commits made before ``older_than`` that no branch or tag points at.

        A kept commit whose ancestors go is first given a base of its own.
        Returns the forgotten commits; ``sweep`` then frees their files.
        """
        logs = self._logs()
        commits, actions = logs.commits, []
        heads = {commit_id for _, commit_id in logs.refs.values()}
        kept = set(heads)
        for head in heads:
            kept |= {c.commit_id for c in logs.line(head) if c.made_at >= older_than}
        gone = sorted(set(commits) - kept)
        for commit_id in sorted(kept):
            commit = commits[commit_id]
            if not commit.base and commit.parent_id in gone:
                path = f"changes/{uuid.uuid4().hex}"
                state = self._state(logs.line(commit_id)).hint("rebalance")
                stored = self._as_stored(json.loads(commit.columns))
                state.select(*stored, F.lit(UPSERT).alias("_op")).write.parquet(f"{self.root}/{path}")
                rebased = replace(commit, base=True, path=path, parent_id=None)
                actions.append({**vars(rebased), "action": "rebase"})
        actions += [{"action": "forget", "commit_id": c} for c in gone]
        if actions:
            self._append(*[{**a, "seq": logs.last + i} for i, a in enumerate(actions, 1)])
        return gone

    def sweep(self) -> int:
        """Delete change folders no commit refers to; returns their number."""
        used = {c.path for c in self._logs().commits.values()}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/changes")
        fs = folder.getFileSystem(conf)
        stale = [s.getPath() for s in fs.listStatus(folder) if f"changes/{s.getPath().getName()}" not in used]
        for path in stale:
            fs.delete(path, True)
        return len(stale)


def compare_versions(
    versions: dict[str, DataFrame], amount: str, count_as: str, total_as: str
) -> DataFrame:
    """Rows and total of each version, side by side."""
    result = None
    for label, df in versions.items():
        part = df.agg(
            F.lit(label).alias("version"),
            F.count(F.lit(1)).alias(count_as),
            money_sum(amount).alias(total_as),
        )
        result = part if result is None else result.unionByName(part)
    return result
