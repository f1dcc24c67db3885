"""File listings and content hashes, computed on the executors through Spark's readers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Files up to this size are read as one value; larger ones line by line. Both ways go
# through Spark's own readers and give the same result. A value takes a task several times
# its size: what was read, the row, and the growing buffers of both.
IN_MEMORY_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Files:
    """Files below ``path`` whose name fits a pattern; with ``directory`` only those in it."""

    spark: SparkSession
    path: str
    names: str
    recursive: bool = False
    directory: str | None = None

    def _reader(self, kind: str):
        # A file that cannot be read gives no row and does not end the job for all others.
        return (
            self.spark.read.format(kind).option("ignoreCorruptFiles", True)
            .option("pathGlobFilter", self.names).option("recursiveFileLookup", self.recursive)
        )

    def binary(self) -> DataFrame:
        """One row per file; content is read only if used."""
        rows = self._reader("binaryFile").load(self.path)
        if self.directory is None:
            return rows
        name = F.element_at(F.split("path", "/"), -1)
        return rows.where(F.col("path") == F.concat(F.lit(self.directory + "/"), name))

    def lines(self) -> DataFrame:
        """Pieces between line feeds, byte for byte."""
        return self._reader("text").option("lineSep", "\n").load(self.path)

    def listing(self) -> DataFrame:
        """Path, name and size, from file metadata alone.

        ``scan_name`` and ``scan_path`` are as scans report them, with special characters
        encoded.
        """
        return self.binary().select(
            "path", F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("length").alias("size"), F.col("_metadata.file_name").alias("scan_name"),
            F.col("_metadata.file_path").alias("scan_path"),
        )


def _first_line(text: Column) -> Column:
    return F.substring_index(F.substring_index(text, "\n", 1), "\r", 1)


def fingerprints(files: Files, in_memory_bytes: int = IN_MEMORY_BYTES) -> DataFrame:
    """Listing plus the SHA-256 of the content, the first line, and whether it is UTF-8.

    Files are spread over the executors. A file that cannot be read keeps its row, without
    a hash. Bytes of a file too large for one value reach the task that hashes it in order.
    """
    text = F.col("content").cast("string")
    listed = files.listing()
    hashed = files.binary().where(F.col("length") <= in_memory_bytes).select(
        "path", F.sha2("content", 256).alias("sha256"), _first_line(text).alias("header"),
        F.is_valid_utf8(text).alias("is_utf8"),
    )
    large = listed.where(F.col("size") > in_memory_bytes).select("path", "scan_path")
    if not large.isEmpty():
        pieces = (
            files.lines().where(F.col("_metadata.file_size") > in_memory_bytes)
            .select(
                F.col("_metadata.file_path").alias("scan_path"),
                F.col("_metadata.file_size").alias("size"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
                F.col("value").cast("binary").alias("piece"),
            )
            .repartition("scan_path").sortWithinPartitions("scan_path", "block", "row")
            .select("scan_path", "size", "piece")
            .mapInArrow(_hash_pieces, "scan_path string, sha256 string, header string, is_utf8 boolean")
        )
        hashed = hashed.unionByName(large.join(pieces, "scan_path").drop("scan_path"))
    return listed.join(hashed, "path", "left")


_HASHED = pa.schema([
    ("scan_path", pa.string()), ("sha256", pa.string()), ("header", pa.string()), ("is_utf8", pa.bool_())])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes runs of pieces of one file each; a line feed stands between two pieces.

    Pieces that do not add up to the size of their file give no hash.
    """
    current, digest, seen, size, header, valid = None, None, 0, 0, "", True

    def finished() -> pa.RecordBatch:
        if seen == size - 1:  # the file ends with a line feed
            digest.update(b"\n")
        whole = seen in (size, size - 1)  # else the read broke off
        return pa.RecordBatch.from_pylist([
            {"scan_path": current, "sha256": digest.hexdigest() if whole else None, "header": header, "is_utf8": valid}
        ], schema=_HASHED)

    for batch in batches:
        for path, length, piece in zip(*[column.to_pylist() for column in batch.columns]):
            if path != current:
                if current is not None:
                    yield finished()
                current, digest, seen, size, valid = path, hashlib.sha256(), 0, length, True
                header = piece.split(b"\r", 1)[0].decode("utf-8", "replace")
            else:
                digest.update(b"\n")
                seen += 1
            digest.update(piece)
            seen += len(piece)
            try:
                piece.decode()
            except UnicodeDecodeError:
                valid = False
    if current is not None:
        yield finished()
