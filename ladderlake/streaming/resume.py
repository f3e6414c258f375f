"""Resume points as state: what each folder has landed, kept up to date by a stream of file names."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ladderlake.functions import canonical_folder, page_number
from ladderlake.session import reachable, tune
from ladderlake.sources import merge_latest, read_table
from ladderlake.streaming.incremental import MAX_FILE_AGE

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LISTED = "path string, modificationTime timestamp, length bigint, content binary"

STATUS = (
    "folder string, first_page int, last_page int, page_count bigint, file_count bigint, "
    "next_page int, absent_pages bigint, repeated bigint, gaps array<struct<first: int, last: int>>"
)

# Pages of one piece of a folder's bitmap.
PIECE = 4096


class PageState(StatefulProcessor):
    """Per folder: first and last page, files, and which pages were seen, as pieces of a bitmap."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summary = handle.getValueState("summary", "first int, last int, pages bigint, files bigint")
        self.seen = handle.getMapState("seen", "piece int", "bits binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, last, pages, files = self.summary.get() if self.summary.exists() else (None, None, 0, 0)
        for batch in rows:
            landed = batch["page"].dropna().astype(int)
            if not len(landed):
                continue
            files += len(landed)
            low, high = int(landed.min()), int(landed.max())
            first = low if first is None else min(first, low)
            last = high if last is None else max(last, high)
            for piece, own in landed.groupby(landed // PIECE):
                bits = self._piece(int(piece))
                before = bits.bit_count()
                for place in set(own % PIECE):
                    bits |= 1 << int(place)
                pages += bits.bit_count() - before
                self.seen.updateValue((int(piece),), (bits.to_bytes(PIECE // 8, "little"),))
        self.summary.update((first, last, pages, files))
        gaps = self._gaps(first, last) if pages else []
        yield pd.DataFrame(
            {
                "folder": [key[0]],
                "first_page": pd.array([first], "Int32"),
                "last_page": pd.array([last], "Int32"),
                "page_count": [pages],
                "file_count": [files],
                "next_page": [1 if last is None else last + 1],
                "absent_pages": pd.array([last - first + 1 - pages if pages else None], "Int64"),
                "repeated": [files - pages],
                "gaps": [gaps],
            }
        )

    def _piece(self, piece: int) -> int:
        if not self.seen.containsKey((piece,)):
            return 0
        return int.from_bytes(self.seen.getValue((piece,))[0], "little")

    def _gaps(self, first: int, last: int) -> list[dict]:
        """Runs of pages between the first and the last that never landed."""
        known = sorted(k[0] for k in self.seen.keys())
        out, after = [], first
        for piece in known:
            bits, page = self._piece(piece), piece * PIECE
            while bits:
                skip = (bits & -bits).bit_length() - 1
                bits, page = bits >> skip, page + skip
                if page > after:
                    out.append({"first": after, "last": page - 1})
                run = (~bits & (bits + 1)).bit_length() - 1
                bits, page = bits >> run, page + run
                after = page
        return out

    def close(self) -> None:
        pass


def track_pages(
    spark: SparkSession,
    source: str,
    status: str,
    checkpoint: str,
    glob: str = "*.json",
    folder_pattern: str = r"/([^/]+)/[^/]+$",
    page_pattern: str = r"(\d+)\.json$",
    files_per_batch: int | None = None,
    buckets: int = 8,
) -> StreamingQuery:
    """Take up the files landed since the last run, and return the finished query.

    Each run looks at the new names only, adds their pages to the state of their folders, and
    merges one row for each changed folder into the table ``status``: see ``resume_points``. The
    state is as large as the bitmaps of the pages, whatever the number of files; a batch
    repeated after a failure starts from the state before it. No file is read. The state needs
    Spark's RocksDB store, which is set for this query alone.
    """
    reachable(spark)
    own = tune(spark)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    reader = own.readStream.format("binaryFile").schema(LISTED).options(
        pathGlobFilter=glob, recursiveFileLookup="true", maxFileAge=MAX_FILE_AGE
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(source).select(
        canonical_folder(F.regexp_extract("path", folder_pattern, 1)).alias("folder"),
        page_number("path", page_pattern).alias("page"),
    )
    changed = files.groupBy("folder").transformWithStateInPandas(
        statefulProcessor=PageState(), outputStructType=STATUS, outputMode="Update", timeMode="None"
    )

    def store(batch: DataFrame, number: int) -> None:
        # Of one folder, the row that has seen more files is the later one.
        merge_latest(batch, status, ["folder"], [F.col("file_count").desc()], buckets=buckets)

    query = (
        changed.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def resume_points(spark: SparkSession, status: str, expected: DataFrame | None = None) -> DataFrame:
    """Landed pages, gaps and the page to fetch next of every folder, out of the tracked state.

    ``expected`` lists folders, in a column ``folder``, that may have landed nothing so far.
    Nothing is listed: the answer is as recent as the last run of ``track_pages``.
    """
    columns = [f.split()[0] for f in STATUS.split(", ")[:8]] + ["gaps"]
    points = read_table(spark, status).select(*columns)
    if expected is not None:
        named = expected.select(canonical_folder("folder").alias("folder")).distinct()
        absent = named.join(points, "folder", "left_anti").select(
            "folder",
            F.lit(1).alias("next_page"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("page_count", "file_count", "repeated")],
        )
        points = points.unionByName(absent, allowMissingColumns=True)
    return points
