"""Incremental runs as Structured Streaming file-source jobs.

All use ``foreachBatch`` with a checkpoint (so each arrived file is handled
once) and make every batch idempotent on top (anti join against what is
already stored), so a replayed batch after a failure writes nothing twice.
``trigger(availableNow=True)`` processes what has arrived and stops, which is
the reference's "re-run the script" model; drop it to run continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import registry, schemas
from ..operators.joins import pending_units, semi_join_units
from ..plans.benchmark_scores import score_table
from ..plans.translation_metrics import merge_statistics, metric_row, prepare_segments, row_from_statistics
from ..sources import store, versions
from ..session import scratch_path
from ..sources.results import result_path_match

def default_checkpoint(spark: SparkSession, kind: str, *paths: str) -> str:
    """A stable stream checkpoint under the shared ``spark.checkpoint.dir``:
    the same inputs/outputs give the same folder, so a re-run resumes."""
    import hashlib

    from ..session import checkpoint_dir
    key = hashlib.sha1("\x00".join(paths).encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{kind}-{key}"


def incremental_metrics(spark: SparkSession, segments_base: str, metrics_path: str,
                        checkpoint: str | None = None, available_now: bool = True, **metric_kw):
    """Score each newly arrived translation file (one file = one unit)
    once and append its metric row."""
    stream = (store.csv_reader(spark.readStream, True).csv(f"{segments_base.rstrip('/')}/*/*/")
              .withColumn("_path", F.col("_metadata.file_path")))
    seg = store.segments_by_header(stream).filter("_valid").select(*[f.name for f in schemas.SEGMENTS.fields])

    def batch(df: DataFrame, epoch_id: int) -> None:
        keys = schemas.UNIT_KEYS
        done = store.scan_metrics(df.sparkSession, metrics_path)
        todo = semi_join_units(df, done, keys, how="left_anti")
        if todo.isEmpty():
            return
        rows = metric_row(prepare_segments(todo, spread_rows=True), **metric_kw)
        store.append_metrics(rows, metrics_path)

    checkpoint = checkpoint or default_checkpoint(spark, "metrics", segments_base, metrics_path)
    w = seg.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """What tells a stream, over all its restarts, from others: the id in its checkpoint."""
    import json
    return json.loads(versions.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


# ------------------------------------------------------- statistics that add up
STATISTICS = "statistics"


def add_statistics(stats: DataFrame, path: str, stream: str, epoch: int) -> bool:
    """Adds a batch's unit statistics to the table at ``path``, once: the manifest that names the
    batch's files also records its epoch, so a batch that is replayed (whether its commit went
    through or not) counts once. False: it was there already."""
    spark = stats.sparkSession

    def change(now: dict | None) -> dict | None:
        now = now or {"parts": {STATISTICS: []}, "epochs": {}}
        if now["epochs"].get(stream, -1) >= epoch:
            return None
        folder = versions.new_folder()
        stats.write.parquet(versions.data_path(path, folder))
        return {**now, "parts": {STATISTICS: [*now["parts"][STATISTICS], folder]}, "epochs": {**now["epochs"], stream: epoch}}

    return versions.commit(spark, path, change) is not None


def read_statistics(spark: SparkSession, path: str) -> DataFrame | None:
    """Unit statistics of all batches, one row a unit; None before the first."""
    now = versions.current(spark, path)
    if now is None:
        return None
    return merge_statistics(spark.read.option("mergeSchema", True).parquet(*[versions.data_path(path, f) for f in now["parts"][STATISTICS]]))


def compact_statistics(spark: SparkSession, path: str) -> None:
    """Puts one file set in the place of all batches' (the epochs stay known)."""
    def change(now: dict | None) -> dict | None:
        if now is None or len(now["parts"][STATISTICS]) < 2:
            return None
        folder = versions.new_folder()
        read_statistics(spark, path).write.parquet(versions.data_path(path, folder))
        return {**now, "parts": {STATISTICS: [folder]}}
    versions.commit(spark, path, change)


def incremental_statistics(spark: SparkSession, segments: str | DataFrame, path: str, checkpoint: str | None = None,
                           available_now: bool = True, max_files: int | None = None, **metric_kw):
    """I1 where a unit's segments come in parts: each batch adds its segments' statistics; the
    metrics are those of all segments so far (``metrics_so_far``). ``segments``: a folder in the Spark layout
    (K2), or a stream with the columns of SEGMENTS."""
    if isinstance(segments, str):
        checkpoint = checkpoint or default_checkpoint(spark, "statistics", segments, path)
        reader = spark.readStream.schema(schemas.SEGMENTS)
        segments = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(segments)

    def batch(df: DataFrame, epoch: int) -> None:
        from ..plans.translation_metrics import unit_statistics
        add_statistics(unit_statistics(prepare_segments(df, spread_rows=True), **metric_kw), path, stream_identity(df.sparkSession, checkpoint), epoch)

    w = segments.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def metrics_so_far(spark: SparkSession, path: str, with_count: bool = False) -> DataFrame | None:
    """Metric rows of all segments whose statistics are in the table."""
    stats = read_statistics(spark, path)
    return None if stats is None else row_from_statistics(stats, with_count)


# ------------------------------------------------------- scores and their runs
SCORES, RUNS = "part=scores", "part=runs"  # folders of a write: a file or few, however many models
_RUNS_SCHEMA = "path string, mtime timestamp, model string"
MOST_WRITES = 16  # of a ledger, before they are put together


def documents_stream(spark: SparkSession, results_base: str) -> DataFrame:
    """Result files as they arrive: value, path, mtime."""
    return (spark.readStream.option("wholetext", True).format("text")
            .load(f"{results_base.rstrip('/')}/*/*/")
            .select("value", F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_modification_time").alias("mtime"))
            .filter(F.col("path").rlike(r"/results_[^/]*\.json$")))


def _written(spark: SparkSession, root: str, now: dict | None, name: str, schema) -> DataFrame:
    """Rows of every write that the manifest names, with ``v``, the write. (Manifests of older ledgers
    have an entry for each model, and their files lie in folders by model.)"""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    wanted = T.StructType([*fields, T.StructField("v", T.StringType())])
    parts = (now or {"parts": {}})["parts"]
    out = spark.createDataFrame([], wanted)
    for folders in (set(parts.get(name, [])), {f for p, fs in parts.items() if p.startswith(f"{name}/") for f in fs}):
        paths = [p for p in (f"{versions.data_path(root, f)}/{name}" for f in sorted(folders)) if versions.exists(spark, f"{p}/*")]
        if paths:
            found = spark.read.schema(wanted).option("basePath", f"{root.rstrip('/')}/{versions.DATA}").parquet(*paths)
            out = out.unionByName(found.select(*wanted.names))
    return out


def _runs_in_use(spark: SparkSession, root: str, now: dict | None) -> DataFrame:
    """model, path, mtime, v of each model's run in use. A commit only takes newer runs, so it is the newest one written."""
    best = F.max_by(F.struct("path", "mtime", "v"), F.struct("mtime", "path"))
    return _written(spark, root, now, RUNS, _RUNS_SCHEMA).groupBy("model").agg(best.alias("b")).select("model", "b.*")


def _scores_in_use(spark: SparkSession, root: str, now: dict | None, schema) -> DataFrame:
    written = _written(spark, root, now, SCORES, schema)
    return written.join(_runs_in_use(spark, root, now).select("model", "v"), ["model", "v"], "left_semi").select(*[c for c in written.columns if c != "v"])


def commit_scores(spark: SparkSession, docs: DataFrame, models: DataFrame, root: str) -> bool:
    """Takes the documents that are newer than the runs in use: their scores and their run rows are
    written to one folder, and one manifest makes both the current ones of their models. Documents no
    newer than what is held change nothing, so a batch can be replayed at any point."""
    new = result_path_match(docs, models).drop("model").withColumnRenamed("reg_model", "model")

    def change(now: dict | None) -> dict | None:
        now = now or {"parts": {}}
        held = _runs_in_use(spark, root, now)
        cand = new.select("model", "path", "mtime", "value").unionByName(
            held.select("model", "path", "mtime", F.lit(None).cast("string").alias("value")))
        best = cand.groupBy("model").agg(F.max_by(F.struct("path", "mtime", "value"),
                                                  F.struct("mtime", "path", F.col("value").isNull())).alias("b")).select("model", "b.*")
        stage = scratch_path(spark, "runs-stage")  # the documents taken, read twice below
        best.filter(F.col("value").isNotNull()).write.parquet(stage)
        taken = spark.read.schema("model string, path string, mtime timestamp, value string").parquet(stage)
        if taken.isEmpty():
            return None
        folder = versions.new_folder()
        base = versions.data_path(root, folder)
        score_table(taken, registry.aliases_df(spark), run_col="path").write.parquet(f"{base}/{SCORES}")
        taken.select("path", "mtime", "model").write.parquet(f"{base}/{RUNS}")
        parts = now["parts"] | {p: [*now["parts"].get(p, []), folder] for p in (SCORES, RUNS)}
        return {**now, "parts": parts, "last": folder}

    return versions.commit(spark, root, change) is not None


def committed_scores(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """The scores of every model's run in use (``commit_scores``)."""
    return _scores_in_use(spark, root, versions.current(spark, root), schema or SCORES_WIDE)


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    return _runs_in_use(spark, root, versions.current(spark, root)).select("path", "mtime", "model")


def compact_scores(spark: SparkSession, root: str, most: int = 1) -> None:
    """Puts one write, of what is in use, in the place of all, if there are more than ``most``."""
    def change(now: dict | None) -> dict | None:
        if now is None or len(versions.folders(now)) <= most:
            return None
        folder = versions.new_folder()
        base = versions.data_path(root, folder)
        _scores_in_use(spark, root, now, SCORES_WIDE).write.parquet(f"{base}/{SCORES}")
        _runs_in_use(spark, root, now).select("path", "mtime", "model").write.parquet(f"{base}/{RUNS}")
        return {**now, "parts": {SCORES: [folder], RUNS: [folder]}}
    versions.commit(spark, root, change)


SCORES_WIDE = ", ".join(["lang_code string", *(f"{b} double" for b in registry.BENCHMARKS), "model string"])


def publish_scores(spark: SparkSession, root: str, scores_path: str) -> None:
    """Copies the scores of the last commit's models to the plain table at ``scores_path``. It can be
    repeated at will: after a failure between commit and copy the next call brings the table up to date."""
    now = versions.current(spark, root)
    if now and versions.exists(spark, f"{versions.data_path(root, now['last'])}/{SCORES}/*"):
        last = spark.read.schema(SCORES_WIDE).parquet(f"{versions.data_path(root, now['last'])}/{SCORES}")
        store.write_scores(last.select("model", *[c for c in last.columns if c != "model"]), scores_path, fmt="parquet")


def incremental_scores(spark: SparkSession, results_base: str | DataFrame, scores_path: str, runs_path: str,
                       checkpoint: str | None = None, models: DataFrame | None = None,
                       available_now: bool = True):
    """Newly arrived result documents replace a model's scores when they
    are newer than the run the scores came from. ``runs_path`` is a ledger with versions (scores and
    the run that they came from change together, see ``commit_scores``); ``scores_path`` is the plain
    table made from it, brought up to date after each commit and at each start."""
    source = documents_stream(spark, results_base) if isinstance(results_base, str) else results_base
    publish_scores(spark, runs_path, scores_path)

    def batch(df: DataFrame, epoch_id: int) -> None:
        s = df.sparkSession
        reg = models if models is not None else registry.models_df(s).filter("in_benchmark")
        commit_scores(s, df, reg, runs_path)
        publish_scores(s, runs_path, scores_path)
        compact_scores(s, runs_path, MOST_WRITES)

    checkpoint = checkpoint or default_checkpoint(spark, "scores", results_base if isinstance(results_base, str) else "stream", scores_path, runs_path)
    w = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


__all__ = ["incremental_metrics", "incremental_statistics", "metrics_so_far", "incremental_scores", "compact_scores", "pending_units"]
