"""Members of compressed archives as rows."""

from __future__ import annotations

import bz2 as bzip2
import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

MEMBERS = "path string, member string, content binary"
# Unpacked bytes collected before they are handed to Spark.
_BATCH_BYTES = 8 << 20
_ROW_BYTES = 256


def archive_members(
    spark: SparkSession, path: str, pattern: str | None = None, bz2: bool = False
) -> DataFrame:
    """One row per file inside the ZIP archives under ``path``.

    ``pattern`` must match the whole member name. ``bz2`` unwraps a bzip2 layer around each
    archive. Archives are opened in parallel by the tasks that read them.
    """
    spark.catalog.refreshByPath(path)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return expand_archives(files, pattern, bz2)


def expand_archives(files: DataFrame, pattern: str | None = None, bz2: bool = False) -> DataFrame:
    """The same for archives already in a table of ``path`` and ``content``."""

    # A closure travels to the executors by itself: they need not have this package.
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = re.compile(pattern) if pattern is not None else None
        columns = ["path", "member", "content"]
        pending: list[tuple[str, str, bytes]] = []
        held = 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                raw = io.BytesIO(bzip2.decompress(content) if bz2 else content)
                with zipfile.ZipFile(raw) as archive:
                    for entry in archive.infolist():
                        if entry.is_dir() or (wanted and not wanted.fullmatch(entry.filename)):
                            continue
                        pending.append((path, entry.filename, archive.read(entry)))
                        held += entry.file_size + _ROW_BYTES
                        # Many small members share an output batch, a large one goes alone.
                        if held >= _BATCH_BYTES:
                            yield pd.DataFrame(pending, columns=columns)
                            pending, held = [], 0
        if pending:
            yield pd.DataFrame(pending, columns=columns)

    return files.select("path", "content").mapInPandas(unpack, MEMBERS)
