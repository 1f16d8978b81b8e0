"""A table with a versioned change log, and tables that follow it.

A folder holds ``changes/version={n}``: the rows that commit n inserted, updated or deleted, with the whole new row. A commit counts once its
line is in ``commits``; what a failed commit left behind is overwritten by the next one. ``base/version={n}`` is the table folded up to n, so that
reading it takes the base and the changes behind it. Nothing but Spark's own readers and writers touches the folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.sources.materialise import stored
from corpusq.sources.snapshots import assert_unique, latest_by_key, row_digest

INSERT, UPDATE, DELETE = "insert", "update", "delete"
#: ``source`` is the version of another table that the commit brought this one up to, for tables that follow one.
COMMITS = "version long, source long, base boolean"
_DIGEST = "_digest"


@dataclass(frozen=True)
class ChangeLog:
    """The log of one table, whose rows have the unique, never NULL column ``key``."""

    spark: SparkSession
    path: str
    key: str

    def _commits(self) -> DataFrame:
        folder = f"{self.path}/commits"
        self.spark.createDataFrame([], COMMITS).write.mode("ignore").parquet(folder)
        return self.spark.read.schema(COMMITS).parquet(folder)

    def version(self) -> int:
        """The last commit's number; 0 before the first."""
        return self._commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def followed(self) -> int:
        """The version of the followed table that this one has taken in."""
        return self._commits().agg(F.coalesce(F.max("source"), F.lit(0))).first()[0]

    def _done(self, version: int, source: int | None, base: bool = False) -> None:
        self.spark.createDataFrame([(version, source, base)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _log(self, after: int, upto: int) -> DataFrame | None:
        """Changes of the versions behind ``after`` up to ``upto``; a version may have columns that another lacks."""
        known = self._commits().filter(~F.col("base")).select("version").distinct()
        numbers = sorted(r.version for r in known.filter((F.col("version") > after) & (F.col("version") <= upto)).collect())
        if not numbers:
            return None
        folders = [f"{self.path}/changes/version={n}" for n in numbers]
        return self.spark.read.option("basePath", f"{self.path}/changes").option("mergeSchema", "true").parquet(*folders)

    def _last(self, log: DataFrame, after: int, upto: int) -> DataFrame:
        """The last change of each key in ``log``, the changes behind ``after`` up to ``upto``.

        One version that ``commit`` wrote has each key once, as it refuses others, so its rows need not move.
        """
        known = self._commits().filter(~F.col("base") & (F.col("version") > after) & (F.col("version") <= upto))
        versions, applied = known.agg(F.count_distinct("version"), F.count("source")).first()
        return log if versions == 1 and not applied else latest_by_key(log, self.key, [F.col("version").desc()])

    def changes(self, after: int = 0, upto: int | None = None, net: bool = False) -> DataFrame:
        """``(key, kind, version, …)`` of the commits behind version ``after`` up to ``upto``, the last if not given.

        With ``net`` only the last change of each key, as a table that has version ``after`` needs them; its kind tells whether the key lives. A deleted
        key's other columns are NULL. A log without commits cannot be read.
        """
        last = self.version()
        upto = last if upto is None else upto
        log = self._log(after, upto)
        if log is None:
            log = self._log(0, last)
            if log is None:
                raise ValueError(f"no commits in {self.path}")
            log = log.limit(0)
        rows = self._last(log, after, upto) if net else log
        rest = [c for c in rows.columns if c not in (self.key, "kind", "version", _DIGEST)]
        return rows.select(self.key, "kind", F.col("version").cast("long").alias("version"), *rest)

    def _state(self, version: int) -> DataFrame | None:
        """Live rows at a version, with their digest."""
        bases = self._commits().filter(F.col("base") & (F.col("version") <= version)).agg(F.max("version")).first()[0]
        base = None if bases is None else self.spark.read.parquet(f"{self.path}/base/version={bases}")
        log = self._log(bases or 0, version)
        if log is None:
            return base
        last = self._last(log, bases or 0, version)
        live = last.filter(F.col("kind") != DELETE).drop("kind", "version")
        if base is None:
            return live
        return base.join(last.select(self.key), self.key, "left_anti").unionByName(live, allowMissingColumns=True)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the last if not given."""
        state = self._state(self.version() if version is None else version)
        if state is None:
            raise ValueError(f"no commits in {self.path}")
        return state.drop(_DIGEST)

    def commit(self, rows: DataFrame) -> int:
        """Make ``rows`` the table's new state and log what differs; returns the version, the old one if nothing does.

        Duplicate and NULL keys are refused. Key and digest of both states meet; of the rows only the changed ones are written.
        """
        assert_unique(rows, self.key)
        names = sorted(c for c in rows.columns if c != self.key)
        new = rows.withColumn(_DIGEST, row_digest(names))
        last = self.version()
        old = self._state(last)
        if old is None:
            found = new.withColumn("kind", F.lit(INSERT))
        else:
            before = old.select(F.col(self.key).alias("_key"), F.col(_DIGEST).alias("_before"))
            after = new.select(self.key, _DIGEST)
            kind = F.when(F.col("_key").isNull(), INSERT).when(F.col(self.key).isNull(), DELETE).when(F.col(_DIGEST) != F.col("_before"), UPDATE)
            differ = stored(
                after.join(before, F.col(self.key) == F.col("_key"), "full_outer")
                .select(F.coalesce(self.key, "_key").alias(self.key), kind.alias("kind"))
                .filter("kind IS NOT NULL"),
                "differ",
            )
            if differ.isEmpty():
                return last
            found = differ.join(new, self.key, "left")
        return self._write(found, last + 1, None)

    def apply(self, changed: DataFrame, source: int) -> int:
        """Log ``changed``, rows with a ``kind``, as one commit that brings this table up to version ``source`` of another.

        The keys are unique. Applying the same changes again, after a commit that failed, writes the same version again.
        """
        names = sorted(c for c in changed.columns if c not in (self.key, "kind"))
        return self._write(changed.withColumn(_DIGEST, row_digest(names)), self.version() + 1, source)

    def _write(self, found: DataFrame, version: int, source: int | None) -> int:
        found.write.mode("overwrite").parquet(f"{self.path}/changes/version={version}")
        self._done(version, source)
        return version

    def compact(self) -> None:
        """Fold the log up to the last version into a new base, clustered by key; the log stays readable."""
        last = self.version()
        state = self._state(last)
        if state is not None:
            folded = state.repartitionByRange(F.col(self.key)).sortWithinPartitions(self.key)
            folded.write.mode("overwrite").parquet(f"{self.path}/base/version={last}")
            self._done(last, None, base=True)


def follow_index(source: ChangeLog, index: ChangeLog, text: str, meta: Sequence[str] = (), encode=None, buckets: int | None = None) -> int:
    """Bring ``index`` up to date with ``source`` from the version it has taken in; returns the source's version.

    Only keys that changed in between are embedded, each once; keys that left the source leave the index. Nothing happens where
    the index is up to date.
    """
    from corpusq.functions.terms import DEFAULT_BUCKETS
    from corpusq.operators.index import build_index

    upto, have = source.version(), index.followed()
    if upto <= have:
        return have
    found = stored(source.changes(have, upto, net=True), "changed")
    live = found.filter(F.col("kind") != DELETE)
    built = build_index(live, source.key, text, meta, buckets or DEFAULT_BUCKETS, False, encode).withColumn("kind", F.lit(UPDATE))
    gone = found.filter(F.col("kind") == DELETE).select(source.key, "kind")
    index.apply(built.unionByName(gone, allowMissingColumns=True), upto)
    return upto
