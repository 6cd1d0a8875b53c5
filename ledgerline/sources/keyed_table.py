"""A table of one row per key that takes changes in proportion to the changes (S9, S10, 2.9).

The key decides a row's bucket. A bucket's rows lie in a base folder and in delta folders, newer rows of the same keys.
Appending a batch writes the batch alone, by bucket, and commits it (``commits``); reading merges, per key, what lies in
several folders, and takes buckets of one folder as they are. Compaction rewrites the buckets whose deltas have grown,
and no others. Writers that name a sequence number (a stream's epochs, a job's run times) can repeat a batch: what was
committed already changes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.timefilters import ts_lit
from ledgerline.sources import files
from ledgerline.sources.commits import GRACE, POINTER, CommitLog
from ledgerline.streaming.incremental import latest_per_key

BUCKET, SEQ = "__bucket", "__seq"
MOST_DELTAS = 8  # a bucket with more is compacted
DELTA_SHARE = 0.25  # and so is one whose deltas have this share of its base's bytes
MOST_FOLDERS = 64  # folders of buckets with deltas; the buckets of older ones are compacted, so that plans stay small
KEPT = 3  # commits whose folders stay for readers


def by_hash(buckets: int) -> Callable[[list[str]], Column]:
    """Buckets by the hash of the key: even, and every batch touches many of them."""
    return lambda keys: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def by_width(column: str, width: int) -> Callable[[list[str]], Column]:
    """Buckets of neighbouring values of a whole-number key column. Where its values rise with time, a batch of new and
    lately changed rows touches the last few. Null has a bucket of its own."""
    return lambda keys: F.coalesce(F.floor(F.col(column) / F.lit(width)).cast("int"), F.lit(-1))


class KeyedTable:
    """The table under ``path``, of rows of ``schema`` with unique ``keys``. Of two rows of a key the one with the greater
    ``order`` columns counts, of equal ones the later committed; without ``order`` the later committed.

    Keys, order and buckets belong to the data: the same ones have to be given whenever something is appended."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str] = (),
                 bucket: Callable[[list[str]], Column] = by_hash(64)) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self._bucket = list(keys), list(order), bucket
        self.log = CommitLog(spark, path)
        self._stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "KeyedTable":
        """A table that exists, for reading, compaction and vacuum."""
        link = files.read_text(spark, f"{path.rstrip('/')}/{POINTER}")
        if link is None:
            raise FileNotFoundError(f"no keyed table at {path}")
        about = json.loads(link)["keyed"]
        return cls(spark, path, T.StructType.fromJson(about["schema"]), about["keys"], about["order"])

    def _describe(self) -> None:
        """The table's definition beside its data; another one than that of the data is refused."""
        about = json.loads(json.dumps({"keyed": {"schema": self.schema.jsonValue(), "keys": self.keys, "order": self.order}}))
        link = f"{self.path}/{POINTER}"
        have = files.read_text(self.spark, link)
        if have is None:
            if not self.log.latest()[0] and files.write_text(self.spark, link, json.dumps(about), replace=False):
                return
            have = files.read_text(self.spark, link)
        if have is None or [(f["name"], f["type"]) for f in json.loads(have)["keyed"]["schema"]["fields"]] != [
                (f["name"], f["type"]) for f in about["keyed"]["schema"]["fields"]] or any(
                json.loads(have)["keyed"][k] != about["keyed"][k] for k in ("keys", "order")):
            raise ValueError(f"{self.path}: lost its definition, or has another one")

    # state: {"parts": {bucket: [[folder, seq, bytes], ...]}, "writers": {name: number}, "high": text,
    #         "gone": [[commit, folder, bucket], ...]}; the first part of a bucket is its base

    def _write(self, rows: DataFrame, folder: str) -> dict[str, int]:
        """Write rows by bucket; the buckets and their bytes. Small buckets share tasks, a large one is split."""
        rows.select(*self.schema.names, BUCKET).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        found = files.names(self.spark, f"{self.path}/{folder}", folders=True)
        return {n.split("=")[1]: files.size(self.spark, f"{self.path}/{folder}/{n}") for n in found if n.startswith(f"{BUCKET}=")}

    def append(self, batch: DataFrame, writer: str | None = None, number: int | None = None, high: Column | None = None) -> bool:
        """Commit a batch of new and changed rows; False if ``writer`` has committed this or a later ``number`` before.

        ``high``: an aggregate over the batch (its latest time) whose text the table keeps if it is greater."""
        if writer is not None and self.log.latest()[1].get("writers", {}).get(writer, -1) >= number:
            return False
        self._describe()
        folder = f"d{uuid.uuid4().hex}"
        with self.log.run(folder):
            rows = batch.select(*self.schema.names)
            rows = latest_per_key(rows, self.keys, self.order) if len(self.keys) < len(self.schema) else rows.distinct()
            written = self._write(rows.withColumn(BUCKET, self._bucket(self.keys)), folder)
            top = None
            if high is not None and written:
                top = self.spark.read.schema(self._stored).parquet(f"{self.path}/{folder}").agg(high.cast("string")).first()[0]
            done = []

            def change(state: dict, commit: int) -> dict | None:
                done.clear()
                if writer is not None:
                    if state.setdefault("writers", {}).get(writer, -1) >= number:
                        return None
                    state["writers"][writer] = number
                parts = state.setdefault("parts", {})
                for b, n in written.items():
                    parts.setdefault(b, []).append([folder, commit, n])
                if top is not None:
                    state["high"] = max(state.get("high") or top, top)
                done.append(True)
                return state

            self.log.commit(change)
        if not done:
            files.delete(self.spark, f"{self.path}/{folder}")
        return bool(done)

    def _folder(self, folder: str, seq: int, buckets: list[str]) -> DataFrame:
        """Some buckets of a folder; the partition filter prunes the others' files."""
        d = self.spark.read.schema(self._stored).parquet(f"{self.path}/{folder}")
        return d.filter(F.col(BUCKET).isin([int(b) for b in buckets])).withColumn(SEQ, F.lit(seq))

    def _rows(self, parts: dict[str, list], buckets: list[str]) -> DataFrame | None:
        """All stored rows of some buckets, with the commit that brought them."""
        of: dict[tuple[str, int], list[str]] = {}
        for b in buckets:
            for folder, seq, _ in parts[b]:
                of.setdefault((folder, seq), []).append(b)
        out = None
        for (folder, seq), have in of.items():
            d = self._folder(folder, seq, have)
            out = d if out is None else out.unionByName(d)
        return out

    def _merged(self, parts: dict[str, list], buckets: list[str]) -> DataFrame | None:
        rows = self._rows(parts, buckets)
        return None if rows is None else latest_per_key(rows, [*self.keys, BUCKET], [*self.order, SEQ])

    def read(self) -> DataFrame:
        """The table as of its newest commit: buckets without deltas are read as they lie, by one scan without a shuffle."""
        parts = self.log.latest()[1].get("parts", {})
        paths = [f"{self.path}/{p[0][0]}/{BUCKET}={b}" for b, p in parts.items() if len(p) == 1]
        whole = self.spark.read.schema(self.schema).parquet(*paths) if paths else None
        merged = self._merged(parts, [b for b, p in parts.items() if len(p) > 1])
        out = None
        for d in (whole, merged):
            if d is not None:
                d = d.select(*self.schema.names)
                out = d if out is None else out.unionByName(d)
        return self.spark.createDataFrame([], self.schema) if out is None else out

    def high(self) -> str | None:
        """The text of the greatest ``high`` of the batches so far."""
        return self.log.latest()[1].get("high")

    def compact(self, most_deltas: int = MOST_DELTAS, share: float = DELTA_SHARE) -> list[int]:
        """Rewrite the buckets with more than ``most_deltas`` deltas, or whose deltas have ``share`` or more of their base's
        bytes, or that lie in more than MOST_FOLDERS folders together; deltas that are committed meanwhile stay beside the
        new base. The buckets."""
        parts = self.log.latest()[1].get("parts", {})
        split = {b: p for b, p in parts.items() if len(p) > 1}
        old = {f for _, f in sorted({(seq, f) for p in split.values() for f, seq, _ in p})[:-MOST_FOLDERS]}
        due = [b for b, p in split.items() if len(p) - 1 > most_deltas or sum(n for _, _, n in p[1:]) >= share * p[0][2]
               or any(f in old for f, _, _ in p)]
        if not due:
            return []
        folder, read = f"b{uuid.uuid4().hex}", {b: [f for f, _, _ in parts[b]] for b in due}
        with self.log.run(folder):
            written = self._write(self._merged(parts, due), folder)
            lost = []

            def change(state: dict, commit: int) -> dict | None:
                lost.clear()
                now = state["parts"]
                for b in due:
                    here = [f for f, _, _ in now[b]]
                    if here[:len(read[b])] != read[b]:  # another compaction was first
                        lost.append(b)
                        continue
                    seq = now[b][len(read[b]) - 1][1]
                    now[b] = [[folder, seq, written[b]], *now[b][len(read[b]):]]
                    state.setdefault("gone", []).extend([commit, f, b] for f in read[b])
                return None if len(lost) == len(due) else state

            self.log.commit(change)
        for b in lost:
            files.delete(self.spark, f"{self.path}/{folder}/{BUCKET}={b}")
        return sorted(int(b) for b in due if b not in lost)

    def vacuum(self, kept: int = KEPT, grace: dt.timedelta = GRACE) -> int:
        """Remove bucket folders that no commit of the last ``kept`` names, and folders of failed runs; how many."""
        found = [n for n in files.names(self.spark, self.path, folders=True) if n[:1] in "db"]
        running = self.log.running(grace)
        gone: list = []

        def change(state: dict, commit: int) -> dict | None:
            gone[:] = [g for g in state.get("gone", []) if g[0] <= commit - 1 - kept]
            state["gone"] = [g for g in state.get("gone", []) if g[0] > commit - 1 - kept]
            return state if gone else None

        _, state = self.log.commit(change)
        for _, folder, b in gone:
            files.delete(self.spark, f"{self.path}/{folder}/{BUCKET}={b}")
        named = {p[0] for parts in state.get("parts", {}).values() for p in parts} | {g[1] for g in state.get("gone", [])}
        failed = [n for n in found if n not in named and n not in running]
        for n in failed:
            files.delete(self.spark, f"{self.path}/{n}")
        return len(gone) + len(failed)


def sync(table: KeyedTable, source: DataFrame, ts_col: str, run_at: dt.datetime, overlap: dt.timedelta) -> bool:
    """One run of the copy job. Reads the source's rows that were modified after the newest one copied, less
    ``overlap`` (for rows that were committed late), up to ``run_at``, and appends them; both bounds are literals that reach
    the source's scan. However late a run is, nothing is left out; a repeated run changes nothing. Without a row copied so
    far it reads everything up to ``run_at``."""
    rows = source.filter(F.col(ts_col) <= ts_lit(run_at))
    since = table.high()
    if since is not None:
        rows = rows.filter(F.col(ts_col) > ts_lit(dt.datetime.fromisoformat(since) - overlap))
    return table.append(rows, "sync", int(run_at.timestamp() * 1e6), F.max(ts_col))


def delta_merger(table: KeyedTable, writer: str, compact_every: int = 10) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function (2.9): each micro-batch is appended under its epoch, so a replayed epoch changes
    nothing and writes in proportion to the batch; every so many epochs the buckets that need it are compacted.
    ``writer`` names the stream; a stream that starts anew from an empty checkpoint needs a name of its own."""

    def merge(batch: DataFrame, epoch_id: int) -> None:
        table.append(batch, writer, epoch_id)
        if (epoch_id + 1) % compact_every == 0:
            table.compact()
            table.vacuum()

    return merge


def reset_links(table: KeyedTable, keep_keys: DataFrame, key_col: str, keep_col: str, column: str, scope: Column) -> bool:
    """``UPDATE table SET column = NULL WHERE scope AND NOT EXISTS (keep_keys.keep_col = table.key_col)`` as a delta of
    the rows that change; rows out of scope, with a match or NULL already are neither written nor shuffled."""
    now = table.read()
    due = now.filter(F.coalesce(scope, F.lit(False)) & F.col(column).isNotNull())
    keys = keep_keys.select(F.col(keep_col).alias("__keep")).distinct()
    changed = due.join(keys, F.col(key_col) == F.col("__keep"), "left_anti")
    return table.append(changed.withColumn(column, F.lit(None).cast(table.schema[column].dataType)))
