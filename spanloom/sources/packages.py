"""Article files inside zip packages: the directory at a package's end is read, then only the entries asked for."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def open_file(path: str) -> BinaryIO:
    """A seekable file by its address; a connector of an object store would answer seeks by range requests."""
    return open(unquote(urlparse(path).path), "rb")


def read_packages(spark: SparkSession, folder: str, entry: str = r"\.xml$", opener: Callable[[str], BinaryIO] = open_file) -> DataFrame:
    """(path, entry, content, error) of every entry of every package whose name matches; a broken package is a row with its error.

    Only the packages' names are listed by Spark; each is opened where it is read, and of its bytes only the directory and the
    wanted entries are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = re.compile(entry)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with opener(path) as f, zipfile.ZipFile(f) as z:
                        rows = [(path, n, z.read(n), None) for n in z.namelist() if wanted.search(n)]
                except (zipfile.BadZipFile, zipfile.LargeZipFile, OSError) as e:
                    rows = [(path, None, None, str(e))]
                kinds = (pa.string(), pa.string(), pa.binary(), pa.string())
                made = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], ["path", "entry", "content", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(folder)
    return files.select("path").mapInArrow(run, "path string, entry string, content binary, error string")


def metered(df: DataFrame, name: str = "transfer") -> tuple[DataFrame, Observation]:
    """``df`` and what passes through it, known once it has run: ``requests`` (rows) and ``bytes`` of its content."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("requests"), F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("bytes")), seen
