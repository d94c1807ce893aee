"""S7-S9 scans and K1-K5 sinks on storage.

Layouts:
* segments, reference layout: ``<base>/<dataset>/<model>/<src>-<tgt>.csv``
  with columns source,target,translation (one file = one complete unit);
  Spark layout: Parquet partitioned by dataset/model/tgt_lang.
* metrics: Parquet partitioned by model/dataset (D11), or the reference CSV
  layout ``<root>/<model>/<dataset>.csv`` with a ``translation-pair`` column.
* scores: one folder per model (partition ``model=``), rows by lang_code.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import registry, schemas
from ..functions.text import numeric_or_null, split_pair
from ..session import bounded_batches
from . import versions

_SEG_PATH = r"/([^/]+)/([^/]+)/([^/]+)\.csv$"

# FIXED VALUES: the strings pandas' CSV reader treats as missing by default.
PANDAS_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def pandas_na(c: str):
    """A CSV text cell as pandas reads it: the default NA strings -> NULL."""
    return F.when(~F.col(c).isin(PANDAS_NA), F.col(c)).alias(c)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath)) and len(fs.globStatus(hpath)) > 0


# ----------------------------------------------------------------- scans
_RECORD = T.StructType([T.StructField("_c0", T.StringType()), T.StructField("_record", T.StringType())])


def csv_reader(reader, multi_line: bool):
    """A CSV reader (batch or stream) of whole records, header rows too, of any
    width: Spark finds where a record ends (quoted fields may hold newlines), and gives
    its text as the malformed record of a one-column schema; a record of one field is in
    ``_c0`` alone. See ``by_header``."""
    return (reader.option("header", False).option("multiLine", multi_line).option("escape", '"').option("lineSep", "\n")
            .option("maxColumns", 1 << 18).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").schema(_RECORD))


def _fields(record: str) -> list:
    """A record's fields; an unquoted empty one is None."""
    return next(csv.reader([record] if "\n" not in record and "\r" not in record else io.StringIO(record, newline=""), quoting=csv.QUOTE_NOTNULL), [])


def by_header(raw: DataFrame, names: list[str], path_col: str = "_path") -> DataFrame:
    """Columns ``names`` of CSV records picked by each file's own header row, whatever
    its order and width, as pandas does; columns that a file lacks are NULL, and
    ``_header_ok`` says whether it has all of them. A row with fewer fields lacks the last
    ones. Rows of a file follow each other in a task (its first row is the header), so this
    streams. Only files that one task reads whole may be passed (multi-line CSV isn't split)."""
    schema = ", ".join([f"`{n}` string" for n in names] + [f"{path_col} string", "_header_ok boolean"])
    kinds = [pa.string()] * (len(names) + 1) + [pa.bool_()]

    def run(batches):
        csv.field_size_limit((1 << 31) - 1)
        path, at = None, []
        for b in batches:
            out = []
            for first, record, own in zip(*(b.column(c).to_pylist() for c in ("_c0", "_record", path_col))):
                fields = [first] if record is None else _fields(record)
                if own != path:
                    path = own
                    header = [(x or "").lstrip("\ufeff").rstrip("\r") for x in fields]
                    at = [header.index(n) if n in header else -1 for n in names]
                    continue
                out.append((*[fields[i] if 0 <= i < len(fields) else None for i in at], path, -1 not in at))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [*names, path_col, "_header_ok"])
    bounded_batches(raw.sparkSession)
    return raw.select("_c0", "_record", path_col).mapInArrow(run, schema)


def segments_by_header(raw: DataFrame, na_compat: bool = True) -> DataFrame:
    """Segment rows of translation CSVs, with ``_valid`` and ``_detail`` (what is wrong
    with the row's file). The model folder becomes the registry's name."""
    rows = by_header(raw, [f.name for f in schemas.SEGMENT_FILE.fields])
    src, tgt, valid = split_pair(F.regexp_extract("_path", _SEG_PATH, 3))
    detail = F.when(~valid, F.lit("pair name is not src-tgt")).when(
        ~F.col("_header_ok"), F.lit("header lacks source, target or translation"))
    text = ("source", "target", "translation")
    return rows.select(
        F.regexp_extract("_path", _SEG_PATH, 1).alias("dataset"),
        registry.canonical_model(F.regexp_extract("_path", _SEG_PATH, 2)).alias("model"),
        src.alias("src_lang"), tgt.alias("tgt_lang"), (valid & F.col("_header_ok")).alias("_valid"), detail.alias("_detail"),
        F.xxhash64("_path", *text).alias("seg_id"), *([pandas_na(c) for c in text] if na_compat else text), "_path")


def scan_segments(spark: SparkSession, base: str, with_status: bool = False, na_compat: bool = True):
    """Every translation CSV under ``base`` in one scan. pandas' dialect:
    header row (columns by name), quoted fields may hold newlines, doubled
    quotes escape. dataset/model come from the folders (the model by its registry
    name), the pair from the file stem. Rows of a malformed pair name (not
    exactly one '-') or of a file without the columns are left out and reported.
    ``seg_id`` is a content key (hash of file and row text): the CSV reader
    has no row position, and the key is only used to spread work.
    ``na_compat``: cells pandas would read as missing ('NA', 'None', '' ...)
    become NULL, so P5 turns them into 'nan' as the reference does."""
    glob = f"{base.rstrip('/')}/*/*/*.csv"
    if not _exists(spark, glob):
        empty = spark.createDataFrame([], schemas.SEGMENTS)
        return (empty, spark.createDataFrame([], schemas.RUN_STATUS)) if with_status else empty
    raw = csv_reader(spark.read, True).csv(glob).withColumn("_path", F.col("_metadata.file_path"))
    df = segments_by_header(raw, na_compat)
    good = df.filter("_valid").select(*[f.name for f in schemas.SEGMENTS.fields])
    if not with_status:
        return good
    return good, _file_errors(df, "scan_segments")


def _file_errors(df: DataFrame, stage: str) -> DataFrame:
    return (df.filter(F.col("_detail").isNotNull()).select("_path", "_detail").distinct()
              .select(F.lit(stage).alias("stage"), F.col("_path").alias("unit"),
                      F.lit("error").alias("status"), F.col("_detail").alias("detail")))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments in the Spark layout (K2 output)."""
    return spark.read.schema(schemas.SEGMENTS).parquet(path)


def scan_metrics(spark: SparkSession, path: str, layout: str = "parquet", with_status: bool = False):
    """The metric table; nothing there -> empty table of the D11 schema.
    ``layout='reference'`` reads ``<root>/<model>/<dataset>.csv`` files by their
    headers; a file without the metricx column reads it as NULL. A table that was
    upserted is read at its newest version. Rows whose pair
    name is malformed are left out and, ``with_status``, reported."""
    names = [f.name for f in schemas.METRIC_FILE.fields]
    glob = f"{path.rstrip('/')}/*/*.csv"
    if layout == "parquet" and _exists(spark, path):
        now = versions.current(spark, path)
        found = versions.read_partitioned(spark, path, now, schemas.METRICS) if now else spark.read.schema(schemas.METRICS).parquet(path)
        return (found, spark.createDataFrame([], schemas.RUN_STATUS)) if with_status else found
    if layout == "parquet" or not _exists(spark, glob):
        empty = spark.createDataFrame([], schemas.METRICS)
        return (empty, spark.createDataFrame([], schemas.RUN_STATUS)) if with_status else empty
    raw = csv_reader(spark.read, True).csv(glob).withColumn("_path", F.col("_metadata.file_path"))
    src, tgt, valid = split_pair("translation-pair")
    p = r"/([^/]+)/([^/]+)\.csv$"
    rows = by_header(raw, names).withColumn("_ok", F.coalesce(valid, F.lit(False)))
    good = rows.filter("_ok").select(
        registry.canonical_model(F.regexp_extract("_path", p, 1)).alias("model"),
        F.regexp_extract("_path", p, 2).alias("dataset"),
        src.alias("src_lang"), tgt.alias("tgt_lang"),
        *[numeric_or_null(F.col(a)).alias(b) for a, b in
          [("bleu", "bleu"), ("chrf++", "chrf"), ("rouge-l", "rouge_l"), ("meteor", "meteor"),
           ("xcomet", "xcomet"), ("ssa-comet", "ssa_comet"), ("metricx", "metricx")]])
    if not with_status:
        return good
    bad = rows.withColumn("_detail", F.when(~F.col("_ok"), F.concat(
        F.lit("pair name "), F.coalesce("translation-pair", F.lit("")), F.lit(" is not src-tgt"))))
    return good, _file_errors(bad, "scan_metrics")


def scan_predictions(spark: SparkSession, path: str, by_unit: bool = False) -> DataFrame:
    """Scorer output JSONL; ``prediction`` per line (an empty file gives
    no rows). ``by_unit``: with the unit keys of the folders (K5 ``by_unit``)."""
    fields = schemas.SCORER_OUT.fields + ([schemas.METRICS[k] for k in schemas.UNIT_KEYS] if by_unit else [])
    return spark.read.schema(T.StructType(fields)).json(path)


# ----------------------------------------------------------------- sinks
def write_scores(scores: DataFrame, path: str, fmt: str = "csv") -> None:
    """K1: one folder per model, header, rows ascending by lang_code;
    dynamic partition overwrite, so models without new rows stay as they were.
    The score table has one row per (model, language): few bytes, but a file a model, whose making
    is what takes time. So the number of tasks is given: adaptive execution, which goes by bytes,
    would leave all files to one task or few."""
    spark = scores.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    (scores.repartition(tasks, "model").sortWithinPartitions("model", "lang_code")
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .option("header", True).partitionBy("model").format(fmt).save(path))


def write_segments(seg: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                   max_records_per_file: int = 1_000_000) -> None:
    """K2: partitioned by dataset/model/tgt_lang. Rows are dealt by those columns
    (a rebalance: adaptive execution splits a unit that is too large for a
    task), so a unit is a file or few, not one per task."""
    keys = ["dataset", "model", "tgt_lang"]
    (seg.hint("rebalance", *keys).sortWithinPartitions(*keys, "seg_id")
        .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        .option("header", True).partitionBy(*keys).format(fmt).save(path))


def write_segment_files(seg: DataFrame, base: str, extra: Sequence[str] = (), order: Sequence[str] | None = None) -> None:
    """K2 in the reference layout, ``<base>/<dataset>/<model>/<src>-<tgt>.csv``: one CSV file a
    unit with a header, rows by ``seg_id``, every field quoted. ``extra`` columns follow in the
    files; ``order`` names all columns in another order. Spark writes a file for each unit to a staging folder (a unit is one task's, since it
    is one file; its rows are sorted on disk, not held); then the files are moved to their
    names, one rename a unit."""
    spark = seg.sparkSession
    fs, top = versions._path(spark, base.rstrip("/"))
    stage = f"{base.rstrip('/')}/.stage-{uuid.uuid4().hex}"
    keys = ["dataset", "model", "pair"]
    rows = seg.withColumn("pair", F.concat_ws("-", "src_lang", "tgt_lang"))
    names = list(order or [*(f.name for f in schemas.SEGMENT_FILE.fields), *extra])
    (rows.select(*keys, "seg_id", *names).repartition(*keys).sortWithinPartitions(*keys, "seg_id").drop("seg_id")
         .write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).partitionBy(*keys).csv(stage))
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for part in versions.partitions(spark, stage, 3):
        dataset, model, pair = (unescape(x.split("=", 1)[1]) for x in part.split("/"))
        name = next(n for n in versions.listed(spark, f"{stage}/{part}") if n.startswith("part-"))
        folder = path(f"{base.rstrip('/')}/{dataset}/{model}")
        fs.mkdirs(folder)
        target = path(folder, f"{pair}.csv")
        fs.delete(target, False)
        if not fs.rename(path(f"{stage}/{part}/{name}"), target):
            raise OSError(f"{target} could not be put in place")
    fs.delete(path(stage), True)


def _write_metrics(rows: DataFrame, path: str, mode: str) -> None:
    (rows.select(*[f.name for f in schemas.METRICS.fields]).hint("rebalance", "model", "dataset")
         .sortWithinPartitions("model", "dataset", "src_lang", "tgt_lang")
         .write.mode(mode).partitionBy("model", "dataset").parquet(path))


def append_metrics(rows: DataFrame, path: str) -> None:
    """K3: append metric rows (partitioned by model/dataset, dealt by them), pairs
    in sorted order inside each file. A table that has versions (K4) gets another."""
    spark = rows.sparkSession
    if versions.current(spark, path) is None:
        _write_metrics(rows, path, "append")
        return
    folder = versions.new_folder()
    _write_metrics(rows, versions.data_path(path, folder), "error")
    versions.commit(spark, path, lambda now: versions.replace_partitions(spark, path, now, 2, folder, add=True))


def upsert_metrics(spark: SparkSession, rows: DataFrame, path: str, staging_root: str | None = None) -> None:
    """K4: put ``rows`` into the table: they replace the stored rows of their
    units, and every other stored row stays. The touched (model, dataset) partitions
    are merged on the unit key into a folder of their own, and one atomic switch of the
    table's manifest (``versions``) puts them in the place of the old ones, whose files stay for
    readers under way. Whatever fails before the switch leaves the table as it was; a commit that
    another one overtook merges again with what that one wrote. ``rows`` are written
    first (to ``staging_root`` or the shared checkpoint folder), so each attempt, and each read of
    them, has the same rows, also where they were read from the table itself."""
    from ..session import scratch_path
    names = [f.name for f in schemas.METRICS.fields]
    stage = f"{staging_root.rstrip('/')}/{uuid.uuid4().hex}" if staging_root else scratch_path(spark, "metrics-stage")
    rows.select(*names).write.mode("overwrite").parquet(stage)
    new = spark.read.schema(schemas.METRICS).parquet(stage)

    def change(now: dict | None) -> dict:
        held = scan_metrics(spark, path) if now is None else versions.read_partitioned(spark, path, now, schemas.METRICS)
        kept = (held.join(new.select("model", "dataset").distinct(), ["model", "dataset"], "left_semi")
                    .join(new.select(*schemas.UNIT_KEYS).distinct(), schemas.UNIT_KEYS, "left_anti"))
        folder = versions.new_folder()
        _write_metrics(kept.select(*names).unionByName(new), versions.data_path(path, folder), "error")
        return versions.replace_partitions(spark, path, now, 2, folder)

    versions.commit(spark, path, change)
    _delete(spark, stage)


def _delete(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def export_scorer_jsonl(prepared: DataFrame, path: str, by_unit: bool = False) -> None:
    """K5: {source, reference, hypothesis} lines, UTF-8, non-ASCII as is.
    ``by_unit``: in folders named by the unit keys, which ``scan_predictions`` reads
    back with the scorer's output."""
    rows = prepared.select(*(schemas.UNIT_KEYS if by_unit else []), F.col("src").alias("source"),
                           F.col("ref").alias("reference"), F.col("hyp").alias("hypothesis"))
    if by_unit:
        rows = rows.hint("rebalance", *schemas.UNIT_KEYS)
    w = rows.write.mode("overwrite")
    (w.partitionBy(*schemas.UNIT_KEYS) if by_unit else w).json(path)


__all__ = ["scan_segments", "read_segments", "scan_metrics", "scan_predictions", "write_scores",
           "write_segments", "write_segment_files", "append_metrics", "upsert_metrics", "export_scorer_jsonl"]
