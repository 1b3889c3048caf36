"""Ingest by manifest: only files that are new or changed are parsed.

The state is a folder with two kinds of tables.  ``itens/lote=..`` holds the items that one
run parsed, with the file each came from.  ``manifesto/versao=..`` holds a row per file: its
length, time and content hash, and the batch its items stand in.  A run first writes its
batch, then the next version of the manifest; a version counts from the moment its write
has succeeded, so a run that dies between the two leaves the state as it was, and what it
wrote is in no version.  Items are the join of the latest manifest with the batches.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.plans.versions import finished_versions, read_version, write_version
from caderneta.schemas import ITEM, RAW_GRID
from caderneta.scratch import release
from caderneta.sources.grid import FILE, ingest_grid

PATH = "caminho"
MANIFEST = "caminho string, tamanho long, modificado timestamp, sha256 string, lote string"
FILES = "path string, modificationTime timestamp, length long, content binary"
# Parts a path from the name of a workbook; no file name holds it.
_PART = "\u0001"


@dataclass
class Ingested:
    """Items of all files as they are now, and the files by what became of them."""

    itens: DataFrame
    lidos: int  # parsed in this run: new, or with new content
    mantidos: int  # as known, or only touched
    removidos: int  # known before, gone from the folder
    versao: int


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(caminho, tamanho, modificado) of the Parquet files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup="true").load(folder)
    return _listed(found)


def _listed(files: DataFrame) -> DataFrame:
    return files.select(F.col("path").alias(PATH), F.col("length").alias("tamanho"),
                        F.col("modificationTime").alias("modificado"))


def _hashes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(caminho, sha256) of the files named, by content."""
    found = spark.read.format("binaryFile").load(paths)
    return found.select(F.col("path").alias(PATH), F.sha2("content", 256).alias("sha256"))


def manifest(spark: SparkSession, state: str, version: int | None = None) -> DataFrame:
    """The latest version, or the one asked for; empty before the first run."""
    return read_version(spark, f"{state}/manifesto", MANIFEST, version)


def known_items(spark: SparkSession, state: str, version: int | None = None) -> DataFrame:
    """The items that a version of the manifest stands for: ``ITEM`` columns and ``row_no``."""
    columns = [*ITEM.fieldNames(), "row_no"]
    of = manifest(spark, state, version).select(PATH, "lote")
    batches = [r["lote"] for r in of.select("lote").distinct().collect()]
    if not batches:
        return spark.createDataFrame([], ITEM).withColumn("row_no", F.lit(None).cast("long"))
    stored = spark.read.option("basePath", f"{state}/itens").parquet(*[f"{state}/itens/lote={b}" for b in batches])
    return stored.join(of, [PATH, "lote"]).select(*columns)


def _parsed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Items of the files named, with the file of each.

    Workbooks are told apart by file and name while they are parsed.
    """
    grid = spark.read.schema(RAW_GRID).parquet(*paths)
    owned = grid.withColumn(FILE, F.concat(F.col("_metadata.file_path"), F.lit(_PART), F.col(FILE)))
    return ingest_grid(owned).withColumns({
        PATH: F.substring_index(FILE, _PART, 1), FILE: F.substring_index(FILE, _PART, -1),
    })


def _bring_up(spark: SparkSession, state: str, listed: DataFrame, whole: bool) -> Ingested:
    """Takes the files ``listed`` into the state; if they are the ``whole`` folder, others go."""
    known = manifest(spark, state)
    unseen = listed.join(known, listed.columns, "left_anti")
    paths = sorted(r[PATH] for r in unseen.select(PATH).collect())
    gone = known.join(listed, PATH, "left_anti").count() if whole else 0
    total = listed.count()
    batch = uuid.uuid4().hex
    fresh = spark.createDataFrame([], MANIFEST)
    read = 0
    if paths:
        hashed = _hashes(spark, paths)
        old = known.select(PATH, F.col("sha256").alias("antes"), F.col("lote").alias("lote_antes"))
        kept = F.col("antes") == F.col("sha256")
        told = listed.join(hashed, PATH).join(old, PATH, "left").withColumn(
            "lote", F.when(kept, F.col("lote_antes")).otherwise(F.lit(batch))
        )
        fresh = told.select(*known.columns)
        changed = sorted(r[PATH] for r in fresh.filter(F.col("lote") == batch).select(PATH).collect())
        read = len(changed)
        if changed:
            _parsed(spark, changed).write.parquet(f"{state}/itens/lote={batch}")
            release(spark)
    if paths or gone:
        others = known.join(unseen, PATH, "left_anti")
        if whole:
            others = others.join(listed, PATH, "left_semi")
        write_version(others.unionByName(fresh), f"{state}/manifesto")
    versions = finished_versions(spark, f"{state}/manifesto")
    return Ingested(known_items(spark, state), read, total - read, gone, versions[-1] if versions else 0)


def ingest_new(spark: SparkSession, folder: str, state: str) -> Ingested:
    """Brings the state up to the folder's grid files, parsing only new and changed ones.

    A workbook stands in one file, whole.  A file counts as unchanged if its length and time
    are those known, or, failing that, its content is.  Items of changed files replace the
    old ones, those of files that are gone go too, so ``itens`` equals a full run.  The
    names of the files to be read pass the driver, as in any read of a list of files.
    """
    return _bring_up(spark, state.rstrip("/"), list_files(spark, folder), whole=True)


def ingest_stream(spark: SparkSession, folder: str, state: str, checkpoint: str, files: int = 1000) -> Ingested:
    """Takes the files that came since the last call into the state, ``files`` at a time.

    The file stream remembers in ``checkpoint`` what it has seen, so the folder's known files
    are not compared.  Each batch writes its items and then the manifest; a batch that is
    repeated after a failure finds its files in the manifest and parses nothing.  A stream
    meets a path once: files that change or go are for ``ingest_new``, on the same state.
    """
    state = state.rstrip("/")
    read = kept = 0

    def take(batch: DataFrame, _: int) -> None:
        nonlocal read, kept
        done = _bring_up(batch.sparkSession, state, _listed(batch), whole=False)
        read, kept = read + done.lidos, kept + done.mantidos

    found = (
        spark.readStream.format("binaryFile").schema(FILES)
        .options(pathGlobFilter="*.parquet", recursiveFileLookup="true", maxFilesPerTrigger=str(files))
        .load(folder)
    )
    query = (
        found.select("path", "modificationTime", "length").writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    versions = finished_versions(spark, f"{state}/manifesto")
    return Ingested(known_items(spark, state), read, kept, 0, versions[-1] if versions else 0)
