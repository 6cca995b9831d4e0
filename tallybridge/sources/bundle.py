"""Bundles of files: listed with relative paths, hashed in pieces, sealed and checked again; manifests of runs.

Small files are hashed where they are read.  A file above WHOLE_BYTES is read in pieces by the tasks of its splits, the pieces go to
one task in their order and are hashed as they stream by, so no task holds a file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.functions.text import SHA256_HEX, SUPPLIER_ID, safe_bundle_path
from tallybridge.operators import audit

WHOLE_BYTES = 256 << 20
#: Folders whose names begin with _ or . are no part of a bundle; the seal is one.
SEAL, MANIFEST, VERSION = "_seal", "_manifest", 1
_LISTED = "path string, sha256 string, size long"


def _relative(path, root: str):
    """Path below the root; both as they are written in a URI."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.substring_index(plain, root.rstrip("/") + "/", -1)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of files, in order, to (path, sha256, size); a piece has lost the line end after it, the last one has none."""
    now, digest, done, size = None, hashlib.sha256(), 0, 0

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()]), pa.array([size], pa.int64())], names=["path", "sha256", "size"])

    for batch in batches:
        for path, n_bytes, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if path != now:
                if now is not None:
                    yield told()
                now, digest, done, size = path, hashlib.sha256(), 0, n_bytes
            digest.update(piece)
            done += len(piece)
            if done < size:
                digest.update(b"\n")
                done += 1
    if now is not None:
        yield told()


def hash_pieces(pieces: DataFrame, path: Column, above: int = -1) -> DataFrame:
    """(path, sha256, size) of files above a size, from their lines as Spark's text scan gives them; ``path`` names a file."""
    large = pieces.select(path.alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at")).where(F.col("size") > above)
    ordered = large.repartition("path").sortWithinPartitions("path", "__start", "__at").select("path", "size", "piece")
    return ordered.mapInArrow(_hashed, _LISTED)


def list_files(spark: SparkSession, root: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(path, sha256, size) of the files below a folder, with paths relative to it.  A folder without files gives no rows;
    a file without a byte is listed by ``audit``'s comparison as missing, for no scan gives a row for it."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri().getPath()
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # The length is known from the listing: the content of the larger files is not read.
    small = binary.where(F.col("length") <= whole_bytes).select(F.substring_index("path", full.rstrip("/") + "/", -1).alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
    pieces = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(root)
    return small.union(hash_pieces(pieces, _relative(F.col("_metadata.file_path"), full), whole_bytes))


def seal(spark: SparkSession, root: str) -> None:
    """Write the listing of a bundle beside it; an error if it is sealed already."""
    listed = list_files(spark, root)
    listed.select(F.lit(VERSION).alias("version"), *listed.columns).write.mode("error").option("ignoreNullFields", False).json(f"{root.rstrip('/')}/{SEAL}")


def read_seal(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): what a seal lists, and the rules that rows of it break: another version, an unsafe path, no hash, no
    size, a path that comes twice."""
    rows = spark.read.schema(f"version int, {_LISTED}").json(f"{root.rstrip('/')}/{SEAL}")
    rules = [("seal_version", ~(F.col("version") == VERSION)), ("seal_path", ~safe_bundle_path(F.col("path"))), ("seal_hash", ~F.col("sha256").rlike(SHA256_HEX)), ("seal_size", ~(F.col("size") >= 0))]
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules]))
    twice = rows.groupBy("path").count().where("count > 1").select("path", F.lit("seal_repeats").alias("rule"))
    return rows.drop("version"), rows.select("path", F.explode(broken).alias("rule")).union(twice)


def check_seal(spark: SparkSession, root: str) -> DataFrame:
    """(path, status) of a sealed bundle against its files now: unchanged, missing, extra, changed."""
    rows, _ = read_seal(spark, root)
    return audit.seal_diff(rows, list_files(spark, root))


MANIFEST_SCHEMA = "manifest_version string, run_id string, supplier string, inputs map<string,struct<original_name:string,bundle_path:string,sha256:string,size:bigint>>, policy_sha256 string, production_writes int"


def run_id(supplier, source_sha256, catalog_sha256, policy_sha256):
    """The name that a run has from what went into it."""
    short = lambda c: F.substring(c, 1, 12)
    return F.concat_ws("-", supplier, short(source_sha256), F.lit("catalog"), short(catalog_sha256), F.lit("policy"), short(policy_sha256))


def write_manifest(rows: DataFrame, root: str) -> None:
    """Manifests of runs (MANIFEST_SCHEMA) as JSON lines; an error if they are there."""
    rows.write.mode("error").option("ignoreNullFields", False).json(f"{root.rstrip('/')}/{MANIFEST}")


def read_manifest(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): manifests as written, and (run_id, rule) of those that break one: version, name of the supplier, source and catalogue
    recorded with hash, size and safe path, a run_id that is not the one of its inputs, or writes to production."""
    rows = spark.read.schema(MANIFEST_SCHEMA).json(f"{root.rstrip('/')}/{MANIFEST}")
    part = lambda name, field: F.col("inputs")[name][field]
    whole = lambda name: part(name, "sha256").rlike(SHA256_HEX) & (part(name, "size") >= 0) & safe_bundle_path(part(name, "bundle_path"))
    rules = [
        ("manifest_version", F.col("manifest_version") == str(VERSION)),
        ("supplier", F.col("supplier").rlike(SUPPLIER_ID)),
        ("source_record", whole("source")),
        ("catalog_record", whole("catalog")),
        ("run_id", F.col("run_id") == run_id(F.col("supplier"), part("source", "sha256"), part("catalog", "sha256"), F.col("policy_sha256"))),
        ("production_writes", F.col("production_writes") == 0),
    ]
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules]))
    return rows, rows.select("run_id", F.explode(broken).alias("rule"))


def recorded_inputs(manifest: DataFrame) -> DataFrame:
    """(run_id, path, sha256, size) of the inputs that manifests record, those that were not provided left out."""
    each = manifest.select("run_id", F.explode("inputs").alias("name", "r"))
    return each.where("r.sha256 is not null").select("run_id", F.col("r.bundle_path").alias("path"), "r.sha256", "r.size")
