"""The three-layer Parquet lake (S5..S10, D6, D7).

* raw: Hive partitions ``dt=YYYY-MM-DD/hr=HH/batch=...``; a batch job's write
  replaces the hours it is for (an empty one clears its hour), a stream adds
  a folder per micro-batch, other hours survive.  A replacing write first
  adds its own folder and then drops the hour's other folders, so a job that
  dies in between leaves the old rows and can simply be run again.
* curated / features / vectors: *versioned snapshots* ``<root>/v=<n>``.
  A new version is written next to the old one and becomes visible when its
  ``_SUCCESS`` marker exists; readers take the highest complete version
  (numeric order).  No job ever overwrites the path it reads, and a job that
  dies half way leaves the previous version intact.  A version is either a
  whole table or, as ``merge_snapshot`` writes it, a list of buckets whose
  folders lie beside it: the next one lists the same folders but for the
  buckets that a batch touched.  Layers hold whole texts in several versions,
  so they are written with zstd.

Paths go through the Hadoop FileSystem API, so the same code works on a
local disk, HDFS or an object store.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import partition_date, partition_hour
from postlake.session import shuffle_partitions


@dataclass(frozen=True)
class Layout:
    """Roots of the layers."""
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/items"

    @property
    def curated(self) -> str:
        return f"{self.root}/curated"

    @property
    def tabular(self) -> str:
        return f"{self.root}/features/tabular"

    @property
    def text(self) -> str:
        return f"{self.root}/features/text"

    @property
    def vectors(self) -> str:
        return f"{self.root}/vectors"

    @property
    def index(self) -> str:
        return f"{self.root}/index"

    @property
    def models(self) -> str:
        return f"{self.root}/models"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"


def _writer(df: DataFrame):
    return df.write.option("compression", "zstd")


# ------------------------------------------------------------------ raw layer

BATCH = "batch"


def _replace_hours(df: DataFrame, raw_root: str, hours: list[tuple[str, str]] | None, required: str | None = None) -> None:
    """Write ``df`` (with dt, hr) as one new batch folder per hour and drop the hours' other folders."""
    spark = df.sparkSession
    name = f"run-{uuid.uuid4().hex[:12]}"
    (_writer(df.withColumn(BATCH, F.lit(name))).mode("append").partitionBy("dt", "hr", BATCH).parquet(raw_root))
    fs, root, jvm = _fs(spark, raw_root)
    for dt, hr in hours if hours is not None else _hours(spark, raw_root):
        hour = jvm.org.apache.hadoop.fs.Path(root, f"dt={dt}/hr={hr}")
        folders = [f.getPath() for f in fs.listStatus(hour)] if fs.exists(hour) else []
        if required and not any(f.getName() == f"{BATCH}={name}" for f in folders):
            raise ValueError(f"empty {required}: nothing extracted")
        if hours is None and not any(f.getName() == f"{BATCH}={name}" for f in folders):
            continue
        for f in folders:
            if f.getName() != f"{BATCH}={name}":
                fs.delete(f, True)


def write_hour(df: DataFrame, raw_root: str, dt: str, hr: str, required: str | None = None) -> None:
    """One run's batch into its own ``dt``/``hr`` partition, in place of what the hour held.

    An empty batch clears the hour.  Callers for whom that is an error name it
    as ``required`` (P10): as ``ingest.require_rows``, but seen by the folder
    that was written, so that the batch isn't evaluated for the question.
    """
    _replace_hours(df.withColumns({"dt": F.lit(dt), "hr": F.lit(hr)}), raw_root, [(dt, hr)], required)


def write_by_time(df: DataFrame, raw_root: str, ts_col: str, salt: int = 4) -> None:
    """S5 for many hours at once; partitions derived from a timestamp.

    Rows are dealt by (dt, hr, a salt of ``salt`` values), so a task writes
    few partitions and a hot hour goes to several tasks; no sampling pass.
    """
    out = df.withColumns({"dt": partition_date(ts_col), "hr": partition_hour(ts_col)})
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]), F.lit(salt))
    n = shuffle_partitions(df.sparkSession)
    _replace_hours(out.repartition(n, "dt", "hr", spread), raw_root, None)


def write_stream_batch(df: DataFrame, raw_root: str, stream: str, batch_id: int) -> None:
    """One micro-batch, added to its hours; writing it again replaces its own folders only."""
    (_writer(df.withColumn(BATCH, F.lit(f"{stream}-{batch_id}"))).mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hr", BATCH).parquet(raw_root))


def read_raw(spark: SparkSession, raw_root: str, dt: str | None = None, hr: str | None = None,
             schema: T.StructType | None = None) -> DataFrame:
    """Scan the raw layer; ``dt``/``hr`` filters prune partitions."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [T.StructField("dt", T.StringType()),
                                                             T.StructField("hr", T.StringType()),
                                                             T.StructField(BATCH, T.StringType())]))
    df = reader.parquet(raw_root).drop(BATCH)
    if dt is not None:
        df = df.where(F.col("dt") == dt)
    if hr is not None:
        df = df.where(F.col("hr") == hr)
    return df


def _hours(spark: SparkSession, raw_root: str) -> list[tuple[str, str]]:
    fs, root, _ = _fs(spark, raw_root)
    if not fs.exists(root):
        return []
    days = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("dt=")]
    return sorted((d.getName()[3:], h.getPath().getName()[3:]) for d in days for h in fs.listStatus(d)
                  if h.getPath().getName().startswith("hr=") and len(fs.listStatus(h.getPath())))


def list_partitions(spark: SparkSession, raw_root: str) -> DataFrame:
    """The (dt, hr) partitions present, from folder names alone."""
    return spark.createDataFrame(_hours(spark, raw_root), "dt string, hr string")


# ------------------------------------------------------------- snapshots

_VERSION = re.compile(r"^v=(\d+)$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, root: str, complete_only: bool = True) -> list[int]:
    """Snapshot versions under ``root``, ascending in numeric order."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and st.isDirectory():
            if complete_only and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                continue
            out.append(int(m.group(1)))
    return sorted(out)


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Highest complete version, numeric order (v=10 > v=9)."""
    vs = versions(spark, root)
    return vs[-1] if vs else None


def write_snapshot(df: DataFrame, root: str, version: int | None = None) -> int:
    """Write a new version; returns its number.  Re-writing a given
    version (a replay) replaces only that version."""
    spark = df.sparkSession
    if version is None:
        version = next_version(spark, root)
    _writer(df).mode("overwrite").parquet(f"{root}/v={version}")
    return version


def next_version(spark: SparkSession, root: str) -> int:
    """One above every version begun so far, complete or not."""
    existing = versions(spark, root, complete_only=False)
    return (existing[-1] + 1) if existing else 1


def prune_versions(spark: SparkSession, root: str, keep: int = 3) -> list[int]:
    """Retention: drop all but the newest ``keep`` complete versions (and what older jobs left unfinished);
    readers of a dropped version fail, so keep as many as the longest reader outlives."""
    if keep < 1:
        raise ValueError("at least one version has to stay")
    complete = versions(spark, root)
    if len(complete) <= keep:
        return []
    fs, p, jvm = _fs(spark, root)
    gone = [v for v in versions(spark, root, complete_only=False) if v < complete[-keep]]
    for v in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(p, f"v={v}"), True)
    return gone


def folder_values(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders of ``root``, ascending; one listing, whatever they hold."""
    fs, p, _ = _fs(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def drop_folders(spark: SparkSession, root: str, prefix: str, keep: set[str]) -> None:
    """Drop the folders of ``root`` whose name starts with ``prefix``, but for those in ``keep``."""
    fs, p, _ = _fs(spark, root)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(prefix) and name not in keep:
            fs.delete(st.getPath(), True)


def marked(spark: SparkSession, path: str, name: str) -> bool:
    fs, p, jvm = _fs(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(p, name))


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType | None = None,
                  version: int | None = None) -> DataFrame:
    """Newest complete version; an absent layer reads as an empty
    frame of ``schema``.  Any other failure propagates (never a silent
    empty start that would wipe history)."""
    v = version if version is not None else latest_version(spark, root)
    if v is None:
        if schema is None:
            raise FileNotFoundError(f"no snapshot under {root} and no schema for an empty start")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if listed := _bucket_list(spark, root, v):
        return _read_folders(reader, root, listed["folders"].values())
    return reader.parquet(f"{root}/v={v}")


# ------------------------------------------------- snapshots in buckets

_BUCKETS, _BUCKET = "_buckets.json", "_bucket"
HOT_ROWS = 1_000
SHORT_TEXT = 64


def _bucket_list(spark: SparkSession, root: str, version: int) -> dict | None:
    """{"buckets": n, "folders": {bucket: folder under root}} of a version; None if it is a whole table."""
    fs, p, jvm = _fs(spark, f"{root}/v={version}/{_BUCKETS}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        found = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return found | {"folders": {int(b): f for b, f in found["folders"].items()}}


def _read_folders(reader, root: str, folders) -> DataFrame:
    return reader.option("mergeSchema", "true").parquet(*[f"{root}/{f}" for f in sorted(folders)])


def _bucket_of(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")


def _written_buckets(spark: SparkSession, root: str, run: str) -> dict[int, str]:
    fs, p, _ = _fs(spark, f"{root}/{run}")
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return {int(x.split("=")[1]): f"{run}/{x}" for x in names if x.startswith(f"{_BUCKET}=")}


def _publish(spark: SparkSession, root: str, n: int, folders: dict[int, str], keep_versions: int, mark: str | None) -> int:
    """A new version that lists ``folders``; those that none of the newest versions lists are dropped."""
    version = next_version(spark, root)
    path = f"{root}/v={version}"
    write_marker(spark, path, _BUCKETS, json.dumps({"buckets": n, "folders": folders}))
    if mark:
        write_marker(spark, path, mark)
    write_marker(spark, path)
    prune_versions(spark, root, keep_versions)
    kept = [_bucket_list(spark, root, v) for v in versions(spark, root)]
    drop_folders(spark, root, "run-", {f.split("/")[0] for x in kept if x for f in x["folders"].values()})
    return version


def merge_snapshot(root: str, batch: DataFrame, key: str, merge: Callable[..., DataFrame],
                   buckets: int = 16, files: int = 1, keep_versions: int = 3, mark: str | None = None,
                   keys: DataFrame | None = None) -> int | None:
    """The next version: ``merge(rows of the same keys' buckets, batch)`` in place of the buckets that the batch touches.

    ``merge(None, batch)`` reduces the batch by itself; ``merge`` must work
    key by key.  The table is cut into ``buckets`` by a hash of the key (a
    table's number is fixed by its first such version; with buckets of about
    1 GB an hourly batch of n keys rewrites n GB at most, whatever the
    table's size), each of ``files`` files.  A newest version that is a whole
    table is cut into buckets once.  The list of folders, one entry a bucket,
    goes through the driver.  Rows with a null key fall in one bucket.

    The batch is evaluated once and held for the merge.  A batch that is a
    written table gives its ``keys``, which tell the buckets: then nothing is
    held, and the rows of both sides are shuffled once, to their buckets,
    where ``merge`` (called with ``within=`` the column they are dealt by)
    reduces them and the write follows.  A batch with a key of more than
    ``HOT_ROWS`` rows is reduced before that.

    Returns the version, or None if the batch is empty and there is none yet
    or nothing to mark.  ``mark`` names a file that stands in the version as
    soon as readers see it.  Folders that none of the newest
    ``keep_versions`` versions lists are dropped; one writer per root.
    """
    spark = batch.sparkSession
    newest = latest_version(spark, root)
    listed = None if newest is None else _bucket_list(spark, root, newest)
    known = listed["folders"] if listed else {}
    n = listed["buckets"] if listed else buckets
    bucket, parts = _bucket_of(key, n), shuffle_partitions(spark)
    once = keys is not None and files == 1
    if once:
        most = {r.b: r.most for r in keys.groupBy(bucket.alias("b"), F.col(key)).count().groupBy("b").agg(F.max("count").alias("most")).collect()}
        touched = set(most)

        def dealt(df: DataFrame) -> DataFrame:
            return df.withColumn(_BUCKET, bucket).repartition(parts, _BUCKET)

        hot = max(most.values(), default=0) > HOT_ROWS
        fresh = dealt(merge(None, batch)) if hot else merge(None, dealt(batch), within=[_BUCKET])
    else:
        fresh = merge(None, batch).persist()
    try:
        if not once:
            touched = {r.b for r in fresh.select(bucket.alias("b")).distinct().collect()}
        if not touched and (newest is None or mark is None):
            return newest
        if newest is not None and listed is None:
            old, rewrite = read_snapshot(spark, root, version=newest), True
        else:
            same = [f for b, f in known.items() if b in touched]
            old, rewrite = (_read_folders(spark.read, root, same) if same else None), bool(touched)
        if rewrite:
            run = f"run-{uuid.uuid4().hex[:12]}"
            if once:
                merged = fresh if old is None else merge(dealt(old), fresh, within=[_BUCKET])
            else:
                merged = fresh if old is None else merge(old, fresh)
                # dealt by bucket and a hash of ``files`` values: few files a bucket, each in a task of its own
                merged = merged.withColumn(_BUCKET, bucket).repartition(
                    parts, _BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(1)), F.lit(files)))
            _writer(merged).partitionBy(_BUCKET).parquet(f"{root}/{run}")
            known = {b: f for b, f in known.items() if b not in touched} | _written_buckets(spark, root, run)
            if not known:  # no row is left: an empty bucket holds the columns
                merged.drop(_BUCKET).where("false").write.parquet(f"{root}/{run}/{_BUCKET}=0")
                known = {0: f"{run}/{_BUCKET}=0"}
    finally:
        if not once:
            fresh.unpersist()
    return _publish(spark, root, n, known, keep_versions, mark)


def follow_snapshot(spark: SparkSession, source: str, version: int, root: str, build: Callable[[DataFrame], DataFrame], key: str,
                    changed: set[int] | None = None, keep_versions: int = 3, mark: str | None = None) -> int:
    """The next version of a layer in the buckets of ``source``: ``build`` of that ``version``'s rows, which must work key by key.

    The layer's buckets with a number in ``changed`` (all, unless given) are
    made anew, the others stay.  Rows lie in their bucket's files already, so
    none is shuffled to its bucket.
    """
    after = _bucket_list(spark, source, version)
    if after is None:
        raise ValueError(f"version {version} of {source} isn't in buckets")
    newest, n = latest_version(spark, root), after["buckets"]
    listed = None if newest is None else _bucket_list(spark, root, newest)
    if changed is None or listed is None or listed["buckets"] != n:
        changed, known = set(after["folders"]), {}
    else:
        known = {b: f for b, f in listed["folders"].items() if b not in changed}
    folders = [f for b, f in after["folders"].items() if b in changed]
    if folders or not known:
        run = f"run-{uuid.uuid4().hex[:12]}"
        rows = _read_folders(spark.read, source, folders) if folders else read_snapshot(spark, source, version=version).where("false")
        made = build(rows)
        _writer(made.withColumn(_BUCKET, _bucket_of(key, n))).partitionBy(_BUCKET).parquet(f"{root}/{run}")
        known |= _written_buckets(spark, root, run)
        if not known:  # no row is left: an empty bucket holds the columns
            made.where("false").write.parquet(f"{root}/{run}/{_BUCKET}=0")
            known = {0: f"{run}/{_BUCKET}=0"}
    return _publish(spark, root, n, known, keep_versions, mark)


def buckets_of(spark: SparkSession, root: str, version: int, keys: DataFrame, key: str) -> set[int] | None:
    """The numbers of the buckets in which ``keys`` fall in that version; None if it is a whole table."""
    listed = _bucket_list(spark, root, version)
    return None if listed is None else {r.b for r in keys.select(_bucket_of(key, listed["buckets"]).alias("b")).distinct().collect()}


def changed_rows(spark: SparkSession, root: str, since: int | None, key: str = "id",
                 until: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The change feed between two versions: (rows that are new or differ, keys that are gone).

    Only the buckets whose folder differs are read.  Without ``since``, or if
    that version isn't there any more, or one of the two isn't in the same
    buckets, every row counts as changed and no key as gone.  Texts of over
    ``SHORT_TEXT`` bytes are compared by their SHA-256.
    """
    until = latest_version(spark, root) if until is None else until
    after = _bucket_list(spark, root, until)
    before = _bucket_list(spark, root, since) if since is not None and since in versions(spark, root) else None
    whole = read_snapshot(spark, root, version=until)
    if before is None or after is None or before["buckets"] != after["buckets"]:
        return whole, whole.where("false").select(key)
    differ = [b for b in {*before["folders"], *after["folders"]} if before["folders"].get(b) != after["folders"].get(b)]
    new, old = ([x["folders"][b] for b in differ if b in x["folders"]] for x in (after, before))
    rows = _read_folders(spark.read, root, new) if new else whole.where("false")
    if not old:
        return rows, rows.where("false").select(key)
    past = _read_folders(spark.read, root, old)
    past = past.select(*[F.col(f"`{c}`") for c in past.columns], *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in past.columns])
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType) and isinstance(past.schema[f.name].dataType, T.StringType)]
    marks = {f"_text-{k}": F.when(F.octet_length(f"`{c}`") <= SHORT_TEXT, F.col(f"`{c}`")).otherwise(
        F.concat(F.lit("sha256 of the text: "), F.sha2(f"`{c}`", 256))) for k, c in enumerate(texts)}  # longer than any short text
    now, then = rows.withColumns(marks), past.withColumns(marks).drop(*texts)
    same = F.lit(True)
    for c in [*[c for c in rows.columns if c not in texts], *marks]:
        same &= now[f"`{c}`"].eqNullSafe(then[f"`{c}`"])
    return (now.join(then, same, "left_anti").drop(*marks),
            past.join(rows, past[key].eqNullSafe(rows[key]), "left_anti").select(key))


def mark_value(spark: SparkSession, root: str, prefix: str) -> int | None:
    """The number behind ``prefix`` in the name of a mark of the newest version."""
    version = latest_version(spark, root)
    if version is None:
        return None
    fs, p, _ = _fs(spark, f"{root}/v={version}")
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return next((int(x[len(prefix):]) for x in names if x.startswith(prefix)), None)


def resolve_first(spark: SparkSession, candidates: list[str]) -> str | None:
    """The first candidate root that has a complete version."""
    for root in candidates:
        if latest_version(spark, root) is not None:
            return root
    return None


def write_marker(spark: SparkSession, path: str, name: str = "_SUCCESS", text: str = "") -> None:
    """A small file in a version folder; by default the one that says it is complete."""
    fs, p, jvm = _fs(spark, path)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(p, name), True)
    try:
        if text:
            out.write(bytearray(text.encode()))
    finally:
        out.close()
