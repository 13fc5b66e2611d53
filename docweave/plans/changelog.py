"""Publishing of table changes: a base and a log of small changes per table.

Plain parquet tables cannot be changed in place, and writing a whole table anew
for a few changed rows does not scale. So each batch appends its changed rows
and deleted keys, and readers see the base, less the changed keys, plus the
newest change of each key. One commit entry per batch covers all its tables.

Folding rewrites only what changed. A base consists of places: a hash of the partition
columns and one of the key give a row its place, so a table without partition columns and
a partition that holds most rows are divided too. A fold writes a new version of the
places with changes and a list of the version that counts for each place; versions are
never overwritten, so readers and failed folds see whole tables.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators.mutations import one_per_key

_LOG_FIELDS = [T.StructField("_deleted", T.BooleanType()), T.StructField("batch_id", T.LongType())]


def _without(rows, gone, keys):
    """Rows whose key is not in `gone`; null key values match each other."""
    other = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys]
    return rows.join(other, same, "left_anti")


def _among(rows, wanted, keys):
    """Rows whose key columns are found in `wanted`."""
    other = wanted.select(*[F.col(k).alias(f"_wanted_{k}") for k in keys])
    return rows.join(other, [F.col(k).eqNullSafe(F.col(f"_wanted_{k}")) for k in keys], "left_semi")


#: Places of a base: by the partition columns, by the key. Their product is the length of
#: a base's list, whatever the size of the table.
PLACE_GROUPS, PLACES_PER_GROUP = 64, 8


def _place(keys, parts):
    """Number of the place of a row."""
    inner = F.pmod(F.xxhash64(*keys), F.lit(PLACES_PER_GROUP))
    outer = F.pmod(F.xxhash64(*parts), F.lit(PLACE_GROUPS)) if parts else F.lit(0)
    return (outer * PLACES_PER_GROUP + inner).cast("int")


class ChangeLog:
    """Tables under one folder, each given as name -> (schema, key columns[,
    partition columns]).

    One writer at a time, with increasing batch ids, as a streaming query has.
    """

    def __init__(self, spark: SparkSession, root: str, tables):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = {name: (*spec, []) if len(spec) == 2 else tuple(spec) for name, spec in tables.items()}
        for name, (_, keys, parts) in self.tables.items():
            if not set(parts) <= set(keys):
                raise ValueError(f"partition columns of {name} must be key columns")

    def _read(self, kind, name, schema):
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            # Seen to be empty while a query is planned: its joins with nothing are left out.
            return self.spark.createDataFrame([], schema).where(F.lit(False))

    def _write(self, kind, name, batch_id, rows, *more):
        """Files of even size; a partition value with most rows is split over many."""
        places = [*more, *self.tables[name][2]]
        if places:
            rows = rows.hint("rebalance", *[F.col(c) for c in places])
        rows.write.mode("overwrite").partitionBy(*places).parquet(
            f"{self.root}/{kind}/{name}/batch_id={batch_id}")

    def _last(self, kind):
        """Greatest committed batch id, or None: told by the names of the entries, none is read."""
        entries = self._read("commits", kind, "batch_id long, done boolean").inputFiles()
        return max((int(entry.split("/")[-2].partition("=")[2]) for entry in entries), default=None)

    def last_batch(self):
        return self._last("changes")

    def _commit(self, kind, batch_id):
        entry = self.spark.range(1).select(F.lit(True).alias("done"))
        entry.coalesce(1).write.mode("errorifexists").parquet(
            f"{self.root}/commits/{kind}/batch_id={batch_id}")

    def publish(self, batch_id: int, changes, unique=()) -> bool:
        """Write {table: (rows to upsert, keys to delete or None)} as one batch.

        Returns False, and writes nothing, if the batch is already published. A
        failure before the commit entry leaves the tables as they were, and the
        replayed batch overwrites what it had written. A key both deleted and
        upserted ends as the upserted row; of upserted rows with one key, one is written.
        `unique` names tables whose rows repeat no key: rows and deleted keys are written as
        they are, and whoever reads them takes the row of a key that is among both.
        """
        last = self.last_batch()
        if last is not None and batch_id <= last:
            return False
        for name, (rows, gone) in changes.items():
            schema, keys, _ = self.tables[name]
            if name not in unique:
                rows = one_per_key(rows, keys)
            out = rows.select(*schema.names, F.lit(False).alias("_deleted"))
            if gone is not None:
                removed = gone.select(*keys)
                if name not in unique:
                    removed = _without(removed, rows, keys).distinct()
                out = out.unionByName(removed.withColumn("_deleted", F.lit(True)), allowMissingColumns=True)
            self._write("changes", name, batch_id, out)
        self._commit("changes", batch_id)
        return True

    def current(self, name: str, wanted: DataFrame | None = None, derived=None) -> DataFrame:
        """The table as of the last published batch; with `wanted` (columns of the key),
        only the rows that agree with it, picked before anything is sorted. `derived` maps
        columns that are not in the key to what is read in their place, so that a digest
        or a length is sorted and not the text."""
        base_id, last_id = self._last("base"), self.last_batch()
        return self._folded(name, self._log(name, base_id, last_id), base_id, wanted, derived=derived)

    def _log(self, name, base_id, last_id):
        """Published changes since the base."""
        logged = T.StructType([*self.tables[name][0].fields, *_LOG_FIELDS])
        log = self._read("changes", name, logged).where(F.col("batch_id") <= F.lit(-1 if last_id is None else last_id))
        return log if base_id is None else log.where(F.col("batch_id") > base_id)

    def _versions(self, name, base_id):
        """{place: version} of a base."""
        if base_id is None:
            return {}
        listed = self._read("places", name, "place int, version long, batch_id long").where(F.col("batch_id") == base_id)
        return {r["place"]: r["version"] for r in listed.collect()}

    def _base(self, name, base_id, places=None):
        """The rows of a base, or of some of its places."""
        schema = self.tables[name][0]
        by_version = {}
        for place, version in self._versions(name, base_id).items():
            if places is None or place in places:
                by_version.setdefault(version, []).append(place)
        chosen = F.lit(False)
        for version, own in sorted(by_version.items()):
            chosen = chosen | ((F.col("batch_id") == version) & F.col("_place").isin(sorted(own)))
        stored = T.StructType([*schema.fields, T.StructField("_place", T.IntegerType()), _LOG_FIELDS[1]])
        return self._read("base", name, stored).where(chosen).select(*schema.names)

    def _folded(self, name, log, base_id, wanted=None, places=None, derived=None):
        schema, keys, _ = self.tables[name]
        base = None if base_id is None else self._base(name, base_id, places)
        if derived:
            if not set(derived) <= set(schema.names) - set(keys):
                raise ValueError(f"derived columns of {name} must be columns outside the key")
            log = log.withColumns(derived)
            base = None if base is None else base.withColumns(derived)
        if wanted is not None:
            picked = [c for c in keys if c in wanted.columns]
            log = _among(log, wanted, picked)
            base = None if base is None else _among(base, wanted, picked)
        # Of one batch a row counts before a deletion.
        newest = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc(), "_deleted")
        latest = (log.withColumn("_age", F.row_number().over(newest)).where("_age = 1 and not _deleted")
                  .select(*schema.names))
        if base is None:
            return latest
        return _without(base, log.select(*keys), keys).unionByName(latest)

    def compact(self) -> None:
        """Fold the changes into the places they touch. What is no longer read stays on
        disk until `remove_unread`. A fold that fails is repeated by the next one."""
        base_id, last = self._last("base"), self.last_batch()
        if last is None or base_id == last:
            return
        for name, (_, keys, parts) in self.tables.items():
            log, place = self._log(name, base_id, last), _place(keys, parts)
            touched = {r[0] for r in log.select(place.alias("place")).distinct().collect()}
            if touched:
                rows = self._folded(name, log, base_id, places=touched)
                self._write("base", name, last, rows.withColumn("_place", place), "_place")
            versions = {**self._versions(name, base_id), **dict.fromkeys(touched, last)}
            listed = self.spark.createDataFrame(sorted(versions.items()), "place int, version long")
            listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/places/{name}/batch_id={last}")
        self._commit("base", last)

    def remove_unread(self) -> None:
        """Delete changes that are folded and versions of which no place is read any more.
        For a time when nothing reads a state of before the last fold."""
        base_id = self._last("base")
        if base_id is None:
            return
        for name in self.tables:
            read = set(self._versions(name, base_id).values())
            self._remove("changes", name, lambda batch: batch <= base_id)
            self._remove("base", name, lambda batch: batch <= base_id and batch not in read)
            self._remove("places", name, lambda batch: batch < base_id)

    def _remove(self, kind, name, unread):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/{name}")
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for entry in system.listStatus(folder) if system.exists(folder) else []:
            label, _, batch = entry.getPath().getName().partition("=")
            if label == "batch_id" and unread(int(batch)):
                system.delete(entry.getPath(), True)
