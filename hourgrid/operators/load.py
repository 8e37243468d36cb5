"""Star loads that can be repeated: upsert, unseen and corrected facts, profiles, ledger and audit; one version each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schemas, session
from hourgrid.functions import calendar
from hourgrid.operators import checks, profiles
from hourgrid.sources import tables, versions

TABLES: dict[str, T.StructType] = {
    "dim_time": schemas.DIM_TIME,
    "dim_location": schemas.DIM_LOCATION,
    "fact_weather": schemas.FACT_WEATHER_STORED,
    "ledger": schemas.LEDGER,
}


#: Files of a profile from which on a load folds them into one.
PROFILE_FILES = 48
MEASURES = tuple(f.name for f in schemas.FACT_WEATHER.fields if f.name not in checks.FACT_KEYS)


def create_star(spark: SparkSession, root: str) -> None:
    """Make all tables empty, as a version of its own; older versions stay until they are expired."""
    versions.Commit(spark, root, empty=True).finish()


def read_table(
    spark: SparkSession, root: str, name: str, version: int | None = None, low: int | None = None, high: int | None = None
) -> DataFrame:
    """A table or profile of the star as of a version, by default the newest; facts of a range of hour keys are read from the
    files that may hold them only."""
    return versions.read_table(spark, root, name, (TABLES | profiles.TABLES)[name], version, low, high)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` per key, as an aggregate: a key with many versions is
    reduced before the shuffle and never sorted in one task."""
    rest = [c for c in df.columns if c not in keys and c != order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def dim_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Dimension after the load: incoming rows replace existing ones of the same key.

    ``order`` names a column of ``incoming`` that ranks several versions of one key; without it
    the incoming keys are taken to be distinct.
    """
    if order is not None:
        incoming = latest_per_key(incoming, keys, order)
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming)


def unseen(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def append_facts(existing: DataFrame, new: DataFrame, keys: Sequence[str] = checks.FACT_KEYS) -> DataFrame:
    """Fact table after the load; loading the same rows again changes nothing."""
    return existing.unionByName(unseen(new, existing, keys))


def load_audit(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def pending_days(df: DataFrame, ledger: DataFrame, time: str = "time") -> DataFrame:
    """Days with data that the ledger does not list as done."""
    days = df.select(F.to_date(time).alias("day")).distinct()
    return days.join(ledger.select("day"), "day", "left_anti")


def pending(delivered: DataFrame, ledger: DataFrame) -> DataFrame:
    """Deliveries (day, arrived, print) that the ledger does not list: a finished day for which other
    rows arrive is pending again."""
    same = [delivered[c].eqNullSafe(ledger[c]) for c in ("day", "arrived", "print")]
    return delivered.join(ledger, reduce(lambda a, b: a & b, same), "left_anti")


def merge_facts(stored: DataFrame, new: DataFrame, always: bool = False) -> DataFrame:
    """What a load of ``new`` (facts with their ``revision``) changes in ``stored``: one row for each new or corrected fact.

    A key that is not stored is new, and ``file`` is null. A stored one is corrected if the new row's revision is greater and a measure
    differs, or with ``always`` even if none does, so that its revision is known to rows that arrive out of order. Rows
    of an equal or smaller revision change nothing. ``stored`` has ``file``, the hash of its row's file.
    """
    keys = list(checks.FACT_KEYS)
    old = stored.select(*keys, F.struct("revision", *MEASURES).alias("_old"), F.col("file").alias("file"))
    found = new.join(old, keys, "left")
    differs = reduce(lambda a, b: a | b, [~F.col(m).eqNullSafe(F.col("_old")[m]) for m in MEASURES])
    corrected = (F.col("revision") > F.col("_old")["revision"]) & (F.lit(True) if always else differs)
    return found.where(F.col("_old").isNull() | corrected).drop("_old")


def _changes(commit: versions.Commit, new: DataFrame, low: int, high: int, always: bool) -> DataFrame:
    """``merge_facts`` of ``new`` with the stored facts, by joining only the hours that stored files may hold.

    Facts of other hours are new, so they are neither shuffled nor copied: a load into an empty star joins nothing, and the
    next month meets what overlaps it.
    """
    files = commit.overlap("fact_weather", low, high)
    if not files:
        return new.withColumn("file", F.lit(None).cast("long"))
    stored = versions.read_files(commit.spark, commit.root, "fact_weather", schemas.FACT_WEATHER_STORED, [f[1] for f in files])
    stored = stored.withColumn("file", F.xxhash64(F.substring_index(F.col("_metadata.file_path"), "/data/fact_weather/", -1)))
    first = max(low, min(f[2] for f in files)) if all(f[2] is not None for f in files) else low
    last = min(high, max(f[3] for f in files)) if all(f[3] is not None for f in files) else high
    shared = F.col("time_id").between(first, last)
    met = session.stored(merge_facts(stored.where(shared), new.where(shared), always), "delta")
    apart = new.where(~F.coalesce(shared, F.lit(False))).withColumn("file", F.lit(None).cast("long"))
    return met.unionByName(apart)


def _laid_out(facts: DataFrame) -> DataFrame:
    """Facts as they are stored: ranges of hour and place, in order, with their year."""
    order = list(checks.FACT_KEYS)
    rows = tables.spread(facts, order).withColumn("year", calendar.year_of_key(F.col("time_id")))
    return schemas.conform_to(rows, schemas.FACT_WEATHER_STORED).sortWithinPartitions("year", *order)


def _change_facts(commit: versions.Commit, delta: DataFrame, low: int, high: int) -> tuple[int, int]:
    """Put the changes into the version; returns facts added and facts corrected.

    New facts become new files. The files that hold a corrected fact are written anew, with all their other facts as
    they are; no other file is touched.
    """
    name, schema = "fact_weather", schemas.FACT_WEATHER_STORED
    paths = commit.paths(name, low, high)
    added = commit.add(name, _laid_out(delta.where("file is null")), "time_id", "year")
    hashes = [r["file"] for r in delta.where("file is not null").select("file").distinct().collect()]
    if not hashes:
        return added, 0
    # the hash of a row's file was taken from its path below the table
    named = commit.spark.createDataFrame([(p,) for p in paths], "path string").withColumn("file", F.xxhash64("path"))
    touched = sorted(r["path"] for r in named.where(F.col("file").isin(hashes)).collect())
    rows = versions.read_files(commit.spark, commit.root, name, schema, touched)
    keys, values = list(checks.FACT_KEYS), ["revision", *MEASURES]
    better = delta.where("file is not null").select(*keys, F.struct(*values).alias("_new"))
    now = rows.join(better, keys, "left").withColumn("_now", F.coalesce("_new", F.struct(*values)))
    corrected = delta.where("file is not null").count()
    commit.remove(name, touched)
    # a table of its own first: laying out by ranges reads its input twice
    merged = session.stored(now.select(*keys, *[F.col("_now")[v].alias(v) for v in values]), "merged")
    commit.add(name, _laid_out(merged), "time_id", "year")
    return added, corrected


def _keep_profiles(commit: versions.Commit, delta: DataFrame, corrected: bool) -> None:
    """Bring the stored profiles up to date with the changes.

    New facts add rows of their own. A profile is written anew when facts were corrected, and when it has ``PROFILE_FILES`` files.
    """
    fresh = delta.where("file is null").select(*schemas.FACT_WEATHER.fieldNames())
    changed = facts = None
    if corrected:
        changed = delta.where("file is not null")
        low, high = changed.agg(F.min("time_id"), F.max("time_id")).first()
        # whole months, since a place's month is folded as a whole
        first, last = low // 10_000 * 10_000, high // 10_000 * 10_000 + 9_999
        facts = commit.read("fact_weather", schemas.FACT_WEATHER_STORED, first, last)
        facts = facts.where(F.col("time_id").between(first, last)).select(*schemas.FACT_WEATHER.fieldNames())
    for name, schema in profiles.TABLES.items():
        paths = commit.paths(name)
        if corrected:
            rows = profiles.corrected_rows(name, commit.read(name, schema), fresh, changed, facts)
        elif len(paths) >= PROFILE_FILES:
            rows = profiles.merged(name, commit.read(name, schema).unionByName(profiles.FOLD[name](fresh)))
        else:
            rows, paths = profiles.FOLD[name](fresh), []
        commit.add(name, schemas.conform_to(rows, schema))
        commit.remove(name, paths)


def load_star(
    spark: SparkSession,
    root: str,
    facts: DataFrame,
    dim_time: DataFrame,
    dim_location: DataFrame,
    revision: int | None = None,
    done: DataFrame | None = None,
    gate: Callable[[versions.Commit], None] | None = None,
) -> dict:
    """Load facts and dimensions as one version; returns the rows written per table, and the facts corrected.

    The inputs should be stored or cheap: they are read more than once. Ids determine a dimension row, so an unseen id is an
    insert and a known one needs no change. A fact whose key is stored replaces it if its revision is greater and a measure
    differs; the revision is the number of the load unless it is given, as a number that ranks versions of the data whatever
    the order they arrive in. Of the stored facts only files that overlap the new ones' hours are read, and only hours of both are joined. The profiles are
    brought up to date, and the deliveries ``done`` entered into the ledger. ``gate`` may look at the version before it is
    committed and raise; a load that fails at any point leaves readers with the version before it.
    """
    commit, written = versions.Commit(spark, root), {}
    for name, dim, key in (("dim_location", dim_location, "location_id"), ("dim_time", dim_time, "time_id")):
        fresh = unseen(dim, commit.read(name, TABLES[name]), [key])
        written[name] = commit.add(name, schemas.conform_to(fresh, TABLES[name]))

    written |= {"fact_weather": 0, "fact_corrected": 0}
    low, high = facts.agg(F.min("time_id"), F.max("time_id")).first()
    if low is not None:
        new = facts.withColumn("revision", F.lit(commit.version if revision is None else revision).cast("long"))
        delta = _changes(commit, new, low, high, always=revision is not None)
        if not delta.isEmpty():
            added, corrected = _change_facts(commit, delta, low, high)
            written |= {"fact_weather": added, "fact_corrected": corrected}
            _keep_profiles(commit, delta, corrected > 0)
    if done is not None:
        commit.add("ledger", schemas.conform_to(done, schemas.LEDGER))
    if gate:
        gate(commit)
    commit.finish()
    return written
