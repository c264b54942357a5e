"""Top N items within every group by statistics-guided skipping.

The table is laid out once: clustered by group, best scores first. A file's row groups hold bands of depth: the first few items of
many groups, then the next ones of these, ever more at a time. An index tells which groups a row group contains and the best
item of each. A task then reads a file's row groups in descending order of their maximum score, and skips those that lie
strictly below the current N-th item of every group they contain. One layout serves queries of any N. A group that spans several files has at
most N rows of each merged at the end.
"""

from __future__ import annotations

import uuid
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise, scratch_path

#: Rows that are parted into row groups at a time, and the depths at which bands end.
CHUNK = 1 << 16
BANDS = 4 ** np.arange(1, 20)

_INDEX = "path string, row_group int, n long, top double, groups array<string>, scores array<double>, ties array<long>"
_SCHEMA = pa.schema([("g", pa.string()), ("score", pa.float64()), ("item", pa.string()), ("tie", pa.int64())])


def _files(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One file of the sorted rows of a task, a row group for each band of each chunk; gives its index."""
        path = f"{folder}/{uuid.uuid4().hex}.parquet"
        fs, inner = pyarrow.fs.FileSystem.from_uri(path)
        fs.create_dir(inner.rpartition("/")[0], recursive=True)
        last, deep, number = None, 0, 0

        def flush(rows: pd.DataFrame, writer: pq.ParquetWriter) -> Iterator[pa.RecordBatch]:
            nonlocal last, deep, number
            # of an item that comes again only the best row can count
            rows = rows.drop_duplicates(["g", "item"])
            depth = rows.groupby("g", sort=False).cumcount().to_numpy()
            if rows["g"].iat[0] == last:
                depth = depth + np.where(rows["g"].to_numpy() == last, deep, 0)
            last, deep = rows["g"].iat[-1], int(depth[-1]) + 1
            band = np.searchsorted(BANDS, depth, side="right")
            for b in np.unique(band):
                part = rows[band == b]
                writer.write_table(pa.Table.from_pandas(part, _SCHEMA, preserve_index=False), row_group_size=CHUNK)
                best = part.drop_duplicates("g")
                out = [(path, number, len(part), float(best["score"].max()), best["g"].tolist(), best["score"].tolist(), best["tie"].tolist())]
                number += 1
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=[c.split()[0] for c in _INDEX.split(", ")]).astype({"row_group": "int32"}), preserve_index=False)

        with fs.open_output_stream(inner) as f, pq.ParquetWriter(f, _SCHEMA) as writer:
            held: list[pa.RecordBatch] = []
            for b in batches:
                held.append(b)
                if sum(x.num_rows for x in held) >= CHUNK:
                    yield from flush(pa.Table.from_batches(held).to_pandas(), writer)
                    held = []
            if sum(x.num_rows for x in held):
                yield from flush(pa.Table.from_batches(held).to_pandas(), writer)

    return write


def cluster(df: DataFrame, group: list[str], score: str, item: str, tie: str, path: str | None = None) -> DataFrame:
    """Writes (g, score, item, tie) clustered by group, and gives the index, a table too. Rows with a null among these or a NaN score don't count.

    Ranges are cut by group and score, so a group with a third of all rows fills many files. Several group columns become one
    string key, each with its length before it, so no two groups share a key. Files of tasks that broke off aren't in the index.
    """
    path = path or scratch_path(df.sparkSession, "clustered")
    key = F.concat(*[F.concat(F.length(F.col(g).cast("string")).cast("string"), F.lit(":"), F.col(g).cast("string")) for g in group])
    rows = df.select(key.alias("g"), F.col(score).cast("double").alias("score"), F.col(item).cast("string").alias("item"), F.col(tie).cast("long").alias("tie"))
    rows = rows.where("g is not null and score is not null and not isnan(score) and item is not null and tie is not null")
    # -0.0 + 0.0 is 0.0: the two zeros tie
    rows = rows.withColumn("score", F.col("score") + F.lit(0.0))
    ordered = rows.repartitionByRange("g", F.desc("score"), "tie").sortWithinPartitions("g", F.desc("score"), "tie")
    return materialise(ordered.mapInArrow(_files(path if "://" in path else "file://" + path.removeprefix("file:")), _INDEX), "index")


def scan_file(entries: pd.DataFrame, n: int) -> tuple[list[tuple], int, int]:
    """The best rows of one file, given its part of the index, and how many row groups were read and skipped."""
    best: dict[str, list[tuple[float, int, str]]] = {}
    read = skipped = 0
    fs, inner = pyarrow.fs.FileSystem.from_uri(entries["path"].iat[0])
    with fs.open_input_file(inner) as f:
        file = pq.ParquetFile(f)
        for e in entries.sort_values(["top", "row_group"], ascending=[False, True]).itertuples():
            if all(len(have := best.get(g, ())) >= n and (-s, t) > have[n - 1][:2] for g, s, t in zip(e.groups, e.scores, e.ties)):
                skipped += 1
                continue
            read += 1
            rows = file.read_row_group(e.row_group).to_pydict()
            for g, s, item, t in zip(rows["g"], rows["score"], rows["item"], rows["tie"]):
                have = best.setdefault(g, [])
                new = (-s, t, item)
                if len(have) >= n and new >= have[n - 1]:
                    continue
                same = next((x for x in have if x[2] == item), None)
                if same is not None:
                    if same <= new:
                        continue
                    have.remove(same)
                insort(have, new)
                del have[n:]
    return [(g, -s, item, t) for g, have in best.items() for s, t, item in have], read, skipped


def top_n_clustered(index: DataFrame, n: int) -> DataFrame:
    """(g, score, item, tie, rank) of a clustered table."""

    def scan(entries: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(scan_file(entries, n)[0], columns=["g", "score", "item", "tie"])

    best = index.groupBy("path").applyInPandas(scan, "g string, score double, item string, tie long")
    once = best.groupBy("g", "item").agg(F.max(F.struct("score", (-F.col("tie")).alias("back"))).alias("b")).select("g", "item", "b.score", (-F.col("b.back")).alias("tie"))
    w = Window.partitionBy("g").orderBy(F.desc("score"), "tie")
    return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def skips(index: DataFrame, n: int) -> DataFrame:
    """(path, read, skipped): the row groups of each file that a query of ``n`` reads and skips."""

    def scan(entries: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(entries["path"].iat[0], *scan_file(entries, n)[1:])], columns=["path", "read", "skipped"])

    return index.groupBy("path").applyInPandas(scan, "path string, read long, skipped long")


def top_n(df: DataFrame, group: list[str], score: str, item: str, tie: str, n: int) -> DataFrame:
    """The ``n`` items of highest ``score`` in every group, ties by least ``tie``; an item counts once, by its best row.

    Gives (g, score, item, tie, rank) with the key of ``cluster``. A group of fewer items gives them all; an empty
    table gives no rows. ``tie`` should be unique, else equal rows of one item are interchangeable.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    return top_n_clustered(cluster(df, group, score, item, tie), n)
