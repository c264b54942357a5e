"""Per-entity feature tables: counts, recency and totals for every event type, one row per entity.

Entities are hashed into buckets that hold a bounded number of them. A map task adds its rows up on dense
entity x type blocks (``bincount`` for counts and totals, a maximum scatter for recency) and sends only the cells
that are not empty, so an entity with a third of all rows sends at most one row per type and flush. Each bucket
is then laid out as one dense block, whose columns are emitted as Arrow columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NEVER = np.iinfo(np.int32).min


@dataclass(frozen=True)
class FeatureSpec:
    """``max_types`` bounds the event types (they make up the columns), ``entities_per_bucket`` the height of a
    block, ``rows_per_flush`` and ``entities_per_flush`` the memory of a map task."""

    max_types: int = 4096
    entities_per_bucket: int = 512
    rows_per_flush: int = 1 << 20
    entities_per_flush: int = 1 << 15


def exact_sums(cells: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """int64 sums by cell. ``bincount`` adds in doubles, so the values go in as limbs whose sums stay below 2**53."""
    if not len(values):
        return np.zeros(size, np.int64)
    most = max(abs(int(values.max())), abs(int(values.min())))
    if most * len(values) >= 2**63 and float(np.abs(values.astype(np.float64)).sum()) >= 9.2e18:
        raise OverflowError("a total exceeds 64 bits")
    if most * len(values) < 2**53:
        return np.bincount(cells, values, size).astype(np.int64)
    low = np.bincount(cells, values & 0xFFFF, size).astype(np.int64)
    return low + (exact_sums(cells, values >> 16, size) << 16)


def _cells(entity: np.ndarray, kind: np.ndarray, n: np.ndarray, last: np.ndarray, total: np.ndarray, entities: int, kinds: int):
    """Dense blocks of counts, latest days and totals."""
    cell = entity.astype(np.int64) * kinds + kind
    size = entities * kinds
    latest = np.full(size, _NEVER, np.int32)
    np.maximum.at(latest, cell, last)
    return exact_sums(cell, n, size), latest, exact_sums(cell, total, size)


def _combine(kinds: int, spec: FeatureSpec):
    """Map side: (entity, kind, day, amount) rows to one row per cell that occurs in the flush."""

    def flush(names: list[str], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        ent, kind, day, amount = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(ent, kind="stable")
        ent, kind, day, amount = ent[order], kind[order], day[order], amount[order]
        step = max(1, (1 << 21) // kinds)
        labels = pa.array(names, pa.string())
        for lo in range(0, len(names), step):
            a, b = np.searchsorted(ent, [lo, lo + step])
            if a == b:
                continue
            n, last, total = _cells(ent[a:b] - lo, kind[a:b], np.ones(b - a, np.int64), day[a:b], amount[a:b], min(step, len(names) - lo), kinds)
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [labels.take(pa.array(hit // kinds + lo)), pa.array((hit % kinds).astype(np.int32)), pa.array(n[hit]), pa.array(last[hit]), pa.array(total[hit])],
                names=["entity", "kind", "n", "last", "total"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str, int] = {}
        parts: list[tuple] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = pc.dictionary_encode(batch.column(0))
            local = np.array([ids.setdefault(x, len(ids)) for x in coded.dictionary.to_pylist()], np.int64)
            parts.append((local[coded.indices.to_numpy()], *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))))
            rows += batch.num_rows
            if rows >= spec.rows_per_flush or len(ids) >= spec.entities_per_flush:
                yield from flush(list(ids), parts)
                ids, parts, rows = {}, [], 0
        if parts:
            yield from flush(list(ids), parts)

    return run


def _lay_out(kinds: int, wide: bool):
    """Reduce side: the partial cells of one bucket to a row per entity."""

    def run(table: pa.Table) -> pa.Table:
        coded = pc.dictionary_encode(table.column("entity").combine_chunks())
        ent, names = coded.indices.to_numpy(), coded.dictionary
        kind, n, last, total = (table.column(c).to_numpy() for c in ("kind", "n", "last", "total"))
        out: list[list[pa.Array]] = [[], [], []]
        step = max(1, (1 << 21) // kinds)
        order = np.argsort(ent, kind="stable")
        ent, kind, n, last, total = (x[order] for x in (ent, kind, n, last, total))
        for lo in range(0, len(names), step):
            a, b = np.searchsorted(ent, [lo, lo + step])
            h = min(step, len(names) - lo)
            block = _cells(ent[a:b] - lo, kind[a:b], n[a:b], last[a:b], total[a:b], h, kinds)
            flat = (pa.array(block[0]), pa.array(block[1], mask=block[1] == _NEVER).cast(pa.date32()), pa.array(block[2]))
            for k, x in enumerate(flat):
                out[k].append(x)
        flat = [pa.concat_arrays(x) for x in out]
        if wide:
            at = np.arange(len(names)) * kinds
            cols = [x.take(pa.array(at + k)) for k in range(kinds) for x in flat]
            return pa.Table.from_arrays([names, *cols], names=["entity", *(f"{m}_{k}" for k in range(kinds) for m in ("n", "last", "total"))])
        ends = pa.array(np.arange(len(names) + 1, dtype=np.int32) * kinds)
        return pa.Table.from_arrays([names, *(pa.ListArray.from_arrays(ends, x) for x in flat)], names=["entity", "n", "last", "total"])

    return run


def event_types(events: DataFrame, kinds: list[str], max_types: int) -> list[tuple]:
    """The event types: every combination of the labels found in ``kinds``, in label order; bounded by ``max_types``."""
    found = events.select(*kinds).dropna().distinct().limit(max_types + 1).collect()
    types: list[tuple] = [()]
    for i in range(len(kinds)):
        types = [t + (v,) for t in types for v in sorted({r[i] for r in found})]
        if len(types) > max_types:
            raise ValueError(f"more than {max_types} event types")
    return types if found else []


def feature_table(events: DataFrame, entity: str, kinds: list[str], day: str, amount: Column, types: list[tuple], spec: FeatureSpec = FeatureSpec(), wide: bool = False, population: DataFrame | None = None, every: bool = False, undated: bool = False) -> DataFrame:
    """One row per ``entity`` with, for each event type k of ``types``, the rows ``n``, the latest ``day`` and the total of ``amount``.

    ``amount`` is a bigint column, such as an unscaled decimal; null counts as 0. Rows without entity, kind or day
    are left out; with ``undated`` those without day count in ``n`` and the total. ``population`` is a cheaper table with the column
    ``entity`` to estimate the number of entities from, which sets the number of buckets; with ``every`` each non-null entity of it
    has a row, though it may have no event. ``wide`` gives the columns ``n_k, last_k, total_k``; else there are
    three arrays with an element for each type. A type an entity has no row of gets 0, null and 0. An empty table gives no rows but those of ``every``. A total beyond
    64 bits raises OverflowError.
    """
    schema = T.StructType([T.StructField("entity", T.StringType())])
    if wide:
        for k in range(len(types)):
            schema = schema.add(f"n_{k}", T.LongType()).add(f"last_{k}", T.DateType()).add(f"total_{k}", T.LongType())
    else:
        schema = schema.add("n", T.ArrayType(T.LongType())).add("last", T.ArrayType(T.DateType())).add("total", T.ArrayType(T.LongType()))
    spark = events.sparkSession
    if every and population is None:
        raise ValueError("every needs a population")
    names = population.select(F.col(entity).cast("string").alias("entity")).where("entity is not null").distinct() if every else None
    if not types:
        return spark.createDataFrame([], schema) if names is None else names.select("entity", *(F.array().cast(f.dataType).alias(f.name) for f in schema.fields[1:]))
    entities = (events if population is None else population).agg(F.approx_count_distinct(entity, 0.05)).first()[0]
    buckets = max(1, -(-entities // spec.entities_per_bucket))
    # the sorted labels of each kind give the code of a type in mixed radix, as event_types orders them
    code = F.lit(0)
    for i, c in enumerate(kinds):
        labels = sorted({t[i] for t in types})
        code = code * len(labels) + F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(c)).cast("int") - 1
    rows = events.select(F.col(entity).alias("entity"), code.alias("kind"), F.unix_date(F.col(day)).alias("last"), F.coalesce(amount, F.lit(0)).cast("long").alias("total"))
    if undated:
        rows = rows.withColumn("last", F.coalesce("last", F.lit(int(_NEVER))))
    rows = rows.where(" and ".join(f"{c} is not null" for c in ("entity", "kind", "last")))
    partial = rows.mapInArrow(_combine(len(types), spec), "entity string, kind int, n long, last int, total long")
    if names is not None:
        # a cell of nothing brings the entity into its bucket
        partial = partial.unionByName(names.select("entity", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(int(_NEVER)).alias("last"), F.lit(0).cast("long").alias("total")))
    partial = partial.withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(buckets)))
    return partial.groupBy("bucket").applyInArrow(_drop_bucket(_lay_out(len(types), wide)), schema)


def _drop_bucket(run):
    return lambda key, table: run(table)
