"""Status ledger: claims before payment, and snapshots of the status log (DML-01, WIN-06, ST-02).

The status log itself is one folder of rows per run (``operators.status``).  Beside it lies a folder of numbered
commits, each a small JSON file that exactly one writer can create under its number (put if absent):

* ``claim``: the payments a FINAL run is about to pay, written and committed before any file is.  A run that
  finds commits made since it read the ledger checks its payments against theirs, drops what they claim and
  tries the next number; so two runs at once share no payment.  To other runs a claimed payment counts as sent,
  confirmed by log rows or not: a run that stops between its files and its log has not freed what it may have
  paid.  The same run id, run again, takes exactly its claimed payments with the status they had.
* ``release``: an operator frees the payments of a run that was given up.
* ``snapshot``: the latest entry of every payment, merged from the snapshot before and the log folders of the
  runs it names.  The latest entry is a mergeable state (the greatest of time and run id), so readers take the
  snapshot and the folders it does not name and no others.

Every commit says where the last snapshot is; a reader lists the folder and reads commits from there on.
Creating a commit is atomic on HDFS (a rename fails if the name exists) and on local disks (a hard link does);
an object store needs a committer that offers the same.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ntz
from ..schema import STATUS_PRINTED

LOG_SCHEMA = "check_id long, status string, event_ts timestamp_ntz, attribute_category string, run_id string"
_SNAPSHOT_SCHEMA = LOG_SCHEMA + ", category_ts timestamp_ntz"
_CLAIM_SCHEMA = "check_id long, file_id string, status_before string"
_COLUMNS = ("check_id", "status", "event_ts", "run_id", "attribute_category", "category_ts")


class ClaimConflict(Exception):
    """A claim could not be made within the allowed number of tries."""


@dataclass
class LedgerState:
    """What a reader knows after commit ``version`` (-1: none)."""
    version: int = -1
    snapshot: str | None = None
    covered: frozenset[str] = frozenset()
    claims: dict[str, dict] = field(default_factory=dict)   # run id → its claim, until it is released or covered
    last_snapshot: int = -1


def _entries(rows: DataFrame) -> DataFrame:
    """Log, claim and snapshot rows in the same columns."""
    missing = {"attribute_category": "string", "category_ts": "timestamp_ntz"}
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(missing[c]).alias(c) for c in _COLUMNS])


class Ledger:
    def __init__(self, spark: SparkSession, log_path: str):
        self.spark = spark
        self.log_path = log_path.rstrip("/")
        self.path = f"{self.log_path}_ledger"
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)

    # -- commits ------------------------------------------------------------------------------------------------
    def _path(self, text: str):
        return self._hadoop.Path(text)

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:020d}.json"

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.path}/commits")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[:20]) for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def _read(self, version: int) -> dict:
        stream = self._fs.open(self._path(self._commit_path(version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put(self, version: int, body: dict) -> bool:
        """Create commit ``version``; False if there is one already."""
        target, draft = self._path(self._commit_path(version)), self._path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        self._fs.mkdirs(target.getParent())
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(body).encode()))
        finally:
            out.close()
        try:
            if self._fs.getUri().getScheme() != "file":
                return not self._fs.exists(target) and self._fs.rename(draft, target)
            nio = self.spark.sparkContext._jvm.java.nio.file.Files
            local = self.spark.sparkContext._jvm.java.io.File
            try:  # a local rename would replace the other writer's commit, a link never does
                nio.createLink(local(target.toUri().getPath()).toPath(), local(draft.toUri().getPath()).toPath())
                return True
            except Exception:
                if self._fs.exists(target):
                    return False
                raise
        finally:
            self._fs.delete(draft, False)

    def state(self) -> LedgerState:
        versions = self._versions()
        state = LedgerState()
        if not versions:
            return state
        start = self._read(versions[-1]).get("last_snapshot", -1)
        for version in [v for v in versions if v >= start]:
            self._apply(state, version, self._read(version))
        return state

    @staticmethod
    def _apply(state: LedgerState, version: int, body: dict) -> None:
        state.version = version
        if body["kind"] == "claim":
            state.claims[body["run_id"]] = body
        elif body["kind"] == "release":
            state.claims.pop(body["run_id"], None)
        else:
            state.snapshot, state.covered, state.last_snapshot = body["data"], frozenset(body["covered"]), version
            state.claims = dict(body["claims"])

    # -- reading ------------------------------------------------------------------------------------------------
    def _deltas(self, state: LedgerState) -> DataFrame | None:
        """Log rows of the runs that the snapshot does not name; the folders of the others are not read."""
        if not self._fs.exists(self._path(self.log_path)):
            return None
        rows = self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)
        return rows.where(~F.col("run_id").isin(sorted(state.covered))) if state.covered else rows

    @staticmethod
    def _runs(rows: DataFrame | None) -> list[str]:
        """Run ids among log rows (they are folder names: one row a run)."""
        return [] if rows is None else sorted(r[0] for r in rows.select("run_id").distinct().collect())

    def log(self, without_run: str | None = None, state: LedgerState | None = None) -> DataFrame | None:
        """The snapshot, the log rows of later runs and the payments that others have claimed; None if there is nothing.

        A run's own rows and claim are left out for ``without_run``; of a payment in the snapshot only the latest entry is known.
        """
        state = state or self.state()
        parts = []
        if state.snapshot:
            parts.append(self.spark.read.schema(_SNAPSHOT_SCHEMA).parquet(f"{self.path}/{state.snapshot}"))
        rows = self._deltas(state)
        if rows is not None:
            parts.append(rows if without_run is None else rows.where(F.col("run_id") != without_run))
        logged = {*state.covered, *self._runs(rows)}
        pending = [c for r, c in sorted(state.claims.items()) if r != without_run and r not in logged]
        parts += [self._claimed(c).select("check_id", F.lit(STATUS_PRINTED).alias("status"), ntz(datetime.fromisoformat(c["as_of"])).alias("event_ts"),
                                          F.lit(c["run_id"]).alias("run_id")) for c in pending]
        out = None
        for part in parts:
            out = _entries(part) if out is None else out.unionByName(_entries(part))
        return out

    def _claimed(self, claim: dict) -> DataFrame:
        return self.spark.read.schema(_CLAIM_SCHEMA).parquet(f"{self.path}/{claim['data']}")

    def own_claim(self, run_id: str, state: LedgerState | None = None) -> DataFrame | None:
        """check_id, file_id, status_before of what the run has claimed; None if it has not."""
        claim = (state or self.state()).claims.get(run_id)
        return None if claim is None else self._claimed(claim)

    def open_claims(self) -> DataFrame:
        """run_id, as_of, check_id, file_id: claimed, but without log rows (the run goes on, or has stopped)."""
        state = self.state()
        logged = {*state.covered, *self._runs(self._deltas(state))}
        out = self.spark.createDataFrame([], "run_id string, as_of timestamp_ntz, check_id long, file_id string")
        for r, c in sorted(state.claims.items()):
            if r not in logged:
                out = out.unionByName(self._claimed(c).select(F.lit(r).alias("run_id"), ntz(datetime.fromisoformat(c["as_of"])).alias("as_of"), "check_id", "file_id"))
        return out

    # -- writing ------------------------------------------------------------------------------------------------
    def claim(self, rows: DataFrame, run_id: str, as_of: datetime, state: LedgerState, tries: int = 100) -> DataFrame:
        """Claim ``rows`` (check_id, file_id, status_before), chosen by what ``state`` showed; returns those that are claimed.

        Payments that another run has claimed since go to that run.
        """
        seen = state.version
        data = self._write_claim(rows)
        for _ in range(tries):
            later = [(v, self._read(v)) for v in self._versions() if v > seen]
            taken = [b for _, b in later if b["kind"] == "claim" and b["run_id"] != run_id]
            # A snapshot keeps the claims of runs that are still open; those made since are commits of their own.
            last = max([state.last_snapshot] + [v for v, b in later if b["kind"] == "snapshot"])
            for other in taken:
                mine, theirs = self._claimed({"data": data}), self._claimed(other).select("check_id")
                if mine.join(theirs, "check_id", "left_semi").limit(1).count():
                    data = self._write_claim(mine.join(theirs, "check_id", "left_anti"))
            seen = max([seen] + [v for v, _ in later])
            body = {"kind": "claim", "run_id": run_id, "data": data, "as_of": as_of.isoformat(), "version": seen + 1, "last_snapshot": last}
            if self._put(seen + 1, body):
                return self._claimed(body)
        raise ClaimConflict(f"{run_id}: others committed {tries} times in between")

    def _write_claim(self, rows: DataFrame) -> str:
        data = f"claims/{uuid.uuid4().hex}"
        rows.select("check_id", "file_id", "status_before").write.parquet(f"{self.path}/{data}")
        return data

    def _commit(self, make, tries: int = 100) -> int:
        """Put ``make(state)`` (None: nothing to do) as the next commit."""
        for _ in range(tries):
            state = self.state()
            body = make(state)
            if body is None or self._put(state.version + 1, {**body, "version": state.version + 1}):
                return state.version + 1
        raise ClaimConflict(f"others committed {tries} times in between")

    def release(self, run_id: str) -> bool:
        """Free what ``run_id`` has claimed and not confirmed; False if there is no such claim."""
        state = self.state()
        if run_id not in state.claims or run_id in {*state.covered, *self._runs(self._deltas(state))}:
            return False
        self._commit(lambda s: {"kind": "release", "run_id": run_id, "last_snapshot": s.last_snapshot})
        return True

    def compact(self) -> list[str]:
        """Merge the log rows of all confirmed runs into a new snapshot; returns the runs it has taken in."""
        from ..operators.status import latest_entry

        state = self.state()
        rows = self._deltas(state)
        runs = self._runs(rows)
        if not runs:
            return []
        rows = _entries(rows.where(F.col("run_id").isin(runs)))
        if state.snapshot:
            rows = rows.unionByName(self.spark.read.schema(_SNAPSHOT_SCHEMA).parquet(f"{self.path}/{state.snapshot}"))
        data = f"snapshots/{uuid.uuid4().hex}"
        latest_entry(rows).select(*_COLUMNS).write.parquet(f"{self.path}/{data}")
        covered = sorted({*state.covered, *runs})

        def body(now: LedgerState) -> dict | None:
            if now.last_snapshot != state.last_snapshot:  # another compaction was first: its snapshot stands
                return None
            # Claims of confirmed runs stay too: such a run, run again, takes its payments from there.
            return {"kind": "snapshot", "data": data, "covered": covered, "claims": now.claims, "last_snapshot": now.version + 1}

        self._commit(body)
        return runs
