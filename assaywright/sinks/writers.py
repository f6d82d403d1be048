"""Writing results and configuration: partitioned appends, staged merges, create-if-absent.

Targets are parquet tables in the catalog, or parquet folders when the name is
a path.  Parquet has no row-level merge, so a merge finds the files that hold
affected keys, writes their new content elsewhere, and swaps just these files in
one committed change (``commit``): a failure before it leaves the old table, one
after it is made good by the next reader or writer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import named
from ..operators.joins import delete_insert, insert_if_absent, upsert
from ..operators.storage import new_path, release
from . import commit

# The partitioning of both result logs.
LOG_PARTITIONS = ("system", "sub_system", "batch_id", "year_id")
#: Groups that the rows of one log partition are dealt over before they are written.
SHARES = 64


def _is_path(target: str) -> bool:
    return "/" in target


def exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read(spark: SparkSession, target: str) -> DataFrame:
    """The table's rows, once what was committed to it is applied."""
    settle(spark, target)
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def location(spark: SparkSession, target: str) -> str:
    """The folder that holds a target's files."""
    if _is_path(target):
        return target.rstrip("/")
    shown = spark.sql(f"describe formatted {target}").where("col_name = 'Location'").first()
    return shown["data_type"].rstrip("/")


def settle(spark: SparkSession, *targets: str) -> None:
    """Finish changes that were committed but not applied, say by a driver that was lost."""
    for target in targets:
        if exists(spark, target):
            commit.finish(spark, location(spark, target))
            _refresh(spark, target)


def _refresh(spark: SparkSession, target: str) -> None:
    if _is_path(target):
        spark.catalog.refreshByPath(target)
        return
    if any(c.isPartition for c in spark.catalog.listColumns(target)):
        spark.catalog.recoverPartitions(target)
    spark.catalog.refreshTable(target)


def _save(df: DataFrame, target: str, mode: str, partitions: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(target) if _is_path(target) else writer.saveAsTable(target)


def create_if_absent(df: DataFrame, target: str, partitions: Sequence[str] = ()) -> bool:
    """An empty table of the frame's schema, unless the target is there already."""
    if exists(df.sparkSession, target):
        return False
    _save(df.limit(0), target, "errorifexists", partitions)
    return True


def sized_files(df: DataFrame) -> DataFrame:
    """Rows regrouped by log partition into files of the session's advisory size.

    A scan of many tasks finds a few failures in each; written as they are, every
    task would leave a tiny file.  Adaptive execution joins small groups.  It can
    split a batch that holds most rows only between the tasks that scanned it, so
    the rows of a log partition are dealt by content over ``SHARES`` groups: one
    scanning task does not make one writing task, which sorts what it writes.
    """
    share = F.pmod(F.xxhash64(*[named(c) for c in df.columns]), F.lit(SHARES))
    dealt = df.withColumn("__share", share).hint("rebalance", *[F.col(c) for c in (*LOG_PARTITIONS, "__share")])
    return dealt.drop("__share")


def streamed(spark: SparkSession, target: str) -> bool:
    """Whether a stream's file sink keeps a file list in the folder; readers then see no other files."""
    return _is_path(target) and exists(spark, f"{target.rstrip('/')}/_spark_metadata")


def holds_files(spark: SparkSession, target: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(path) and len(system.listStatus(path)) > 0


def _refuse_streamed(spark: SparkSession, target: str) -> None:
    if streamed(spark, target):
        raise ValueError(f"{target} belongs to a stream's file sink, which would hide what is added")


def read_log(spark: SparkSession, *targets: str) -> DataFrame:
    """All rows of a log that batch runs and streams write, each to a target of its own."""
    return reduce(DataFrame.unionByName, [read(spark, target) for target in targets])


def append_log(df: DataFrame, target: str, rows_per_file: int = 2_000_000) -> None:
    """Append to a result log, partitioned by organisation, batch and year."""
    spark = df.sparkSession
    _refuse_streamed(spark, target)
    shaped = sized_files(df)
    if not _is_path(target) and exists(spark, target):
        shaped = shaped.select(*spark.table(target).columns)
    writer = shaped.write.mode("append").format("parquet").partitionBy(*LOG_PARTITIONS)
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(target) if _is_path(target) else writer.saveAsTable(target)


def replace_batches(df: DataFrame, target: str, rows_per_file: int = 2_000_000) -> None:
    """Rerun-safe write: only the log partitions present in the frame are replaced."""
    _refuse_streamed(df.sparkSession, target)
    df = sized_files(df)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("maxRecordsPerFile", rows_per_file).format("parquet")
    if not _is_path(target) and exists(df.sparkSession, target):
        _insert_dynamic(df.select(*df.sparkSession.table(target).columns), target)
    elif _is_path(target):
        writer.partitionBy(*LOG_PARTITIONS).save(target)
    else:
        writer.partitionBy(*LOG_PARTITIONS).saveAsTable(target)


def _insert_dynamic(df: DataFrame, target: str) -> None:
    """Catalog inserts take the overwrite mode from the session only; it is put back afterwards."""
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        df.write.insertInto(target, overwrite=True)
    finally:
        conf.set(key, before)


def publish_run(
    run: str, frames: dict[str, DataFrame], rows_per_file: int = 2_000_000, partitions: Sequence[str] = LOG_PARTITIONS
) -> None:
    """Write the results of one run to several logs and publish them together.

    Each frame is written to a folder of its own first; one commit then makes all
    of them visible and takes back what an earlier attempt of the same run left
    in the logs.  Nothing is in the logs before that, whatever fails.
    """
    staged, spark = {}, next(iter(frames.values())).sparkSession
    try:
        for target, df in frames.items():
            _refuse_streamed(spark, target)
            if not _is_path(target):
                create_if_absent(df, target, partitions)
                df = df.select(*spark.table(target).columns)
            folder = new_path(spark, "staged")
            staged[location(spark, target)] = folder
            writer = sized_files(df).write.partitionBy(*partitions) if partitions else df.coalesce(1).write
            writer.option("maxRecordsPerFile", rows_per_file).parquet(folder)
        commit.replace_run(spark, run, staged)
    finally:
        release(spark, [folder for root, folder in staged.items() if not _pending(spark, root)])
    for target in frames:
        _refresh(spark, target)


def _pending(spark: SparkSession, root: str) -> bool:
    """Whether a committed change still needs staged files."""
    names = commit.Files(spark).names(f"{root}/{commit.CHANGES}")
    return any(name.endswith((".json", ".note")) for name in names)


def overwrite(df: DataFrame, target: str) -> None:
    """Replace the whole content in one committed change; a target of other columns is made anew."""
    spark = df.sparkSession
    if create_if_absent(df, target) or _columns(read(spark, target)) != _columns(df):
        _save(df, target, "overwrite")
        return
    root = location(spark, target)
    files = commit.Files(spark)
    _swap(df, target, root, commit.version(files, root), files.data_files(root))


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return sorted(df.dtypes)


def append_absent(source: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Insert rows whose (null-safe) key the target lacks; existing rows are never touched."""
    spark = source.sparkSession
    create_if_absent(source, target)
    paths: list[str] = []
    try:
        _save(insert_if_absent(read(spark, target), source, keys, paths=paths), target, "append")
    finally:
        release(spark, paths)


def merge_upsert(source: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Update matched rows, insert the rest."""
    _rewrite(source, target, keys, lambda old: upsert(old, source, keys))


def merge_delete_insert(source: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Replace all target rows of the source's keys by the source rows."""
    _rewrite(source, target, keys, lambda old: delete_insert(old, source, keys))


def _rewrite(source: DataFrame, target: str, keys: Sequence[str], change: Callable[[DataFrame], DataFrame]) -> None:
    """New content for the files that hold one of the source's keys; all other files stay as they are."""
    spark = source.sparkSession
    create_if_absent(source, target)
    old = read(spark, target)
    root = location(spark, target)
    made_from = commit.version(commit.Files(spark), root)
    affected = files_with_keys(old, source, keys)
    held = old.where(F.col("_metadata.file_path").isin(affected)) if affected else old.limit(0)
    relative = [commit.Files(spark).relative(root, name) for name in affected]
    _swap(change(held.select(*old.columns)), target, root, made_from, relative)


def files_with_keys(old: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """Paths of the files of a table with a row of one of the source's keys (NULL equals NULL): as many as files at most."""
    marks = [f"__key_{i}" for i in range(len(keys))]
    wanted = source.select(*[named(k).alias(m) for k, m in zip(keys, marks)]).distinct()
    placed = old.select(*[named(k) for k in keys], F.col("_metadata.file_path").alias("__file"))
    held = placed.join(wanted, reduce(lambda a, b: a & b, [named(k).eqNullSafe(F.col(m)) for k, m in zip(keys, marks)]), "left_semi")
    return [r["__file"] for r in held.select("__file").distinct().collect()]


def _swap(content: DataFrame, target: str, root: str, made_from: int, replaced: Sequence[str]) -> None:
    """Write content elsewhere, then exchange it for the replaced files in one change."""
    spark, files = content.sparkSession, commit.Files(content.sparkSession)
    partitions = [] if _is_path(target) else [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    if _is_path(target) and replaced:
        partitions = [part.split("=", 1)[0] for part in replaced[0].split("/")[:-1]]
    staged = new_path(spark, "staged")
    writer = content.write.partitionBy(*partitions) if partitions else content.write
    writer.parquet(staged)
    change = commit.Change(removes=[f"{root}/{name}" for name in replaced])
    change.add_written(files, staged, root)
    commit.publish(spark, [root], change, made_from)
    release(spark, [staged])
    _refresh(spark, target)


def anomalies_only(flagged: DataFrame, only: bool, flag: str = "rule_violation_flag") -> DataFrame:
    """Optionally drop the passing rows before detail is written."""
    return flagged.where(F.col(flag) != 0) if only else flagged
