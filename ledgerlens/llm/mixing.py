"""Mixing sources to target shares of the total size, by iterative proportional fitting.

Sizes are added up in cells of source, language and topic; the cells' weights are raked to the source targets and to
the shares of languages and topics in the whole table, under each source's cap of repeats. A document is then
taken as often as its cell's factor says, the fraction by a draw that depends on its id only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words by which a text of the forwarding trade is put to a topic, in the five languages.
TOPICS = {
    "billing": "facture|règlement|avoir|tarif|cotation|invoice|payment|credit note|rate|quotation|rechnung|zahlung|gutschrift|lagermiete|angebot|factura|pago|abono|almacenaje|cotización|fatura|pagamento|crédito|armazenagem|cotação",
    "customs": "douane|certificat|manifeste|connaissement|customs|certificate|manifest|bill of lading|zoll|ursprungszeugnis|konnossement|aduana|certificado|manifiesto|conocimiento|alfândega|conhecimento",
    "transport": "conteneur|navire|chauffeur|palettes|plombs|reefer|container|vessel|driver|pallets|seals|schiff|fahrer|paletten|plomben|contenedor|buque|conductor|contentor|navio|motorista",
    "account": "client|chiffre d'affaires|segmentation|compte|customer|turnover|account|kunde|umsatz|konto|cliente|ventas|cuenta|vendas|conta",
}
#: Cells that are brought to the driver at most, unless the caller allows more.
MAX_CELLS = 100_000


def topic_of(text: Column) -> Column:
    """The topic whose words occur most often in the whole lower-case text, overlapping ones too; ties in the order
    above, ``other`` without any, null for null. One pass of a string automaton over all words."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        names = list(TOPICS)
        words: dict[str, list[int]] = {}
        for i, n in enumerate(names):
            for w in TOPICS[n].split("|"):
                words.setdefault(w, []).append(i)
        automaton = ahocorasick.Automaton()
        for w, topics in words.items():
            automaton.add_word(w, topics)
        automaton.make_automaton()

        def one(t: str | None) -> str | None:
            if t is None:
                return None
            n = [0] * len(names)
            for _, topics in automaton.iter(t.lower()):
                for i in topics:
                    n[i] += 1
            return names[n.index(max(n))] if any(n) else "other"

        for s in batches:
            yield pd.Series([one(t) for t in s], dtype=object)

    return of(text)


@dataclass
class Raked:
    cells: list[tuple]
    factor: np.ndarray
    rounds: int


def rake(cells: list[tuple], size: np.ndarray, targets: dict[str, float], caps: dict[str, int], rounds: int = 500, tolerance: float = 1e-9) -> Raked:
    """Factors of the cells (source, language, topic): their weighted sizes meet the source targets as far as the caps
    allow, then the languages' and topics' own shares as nearly as can be. Sources without target get factor 0."""
    if not cells:
        return Raked([], np.zeros(0), 0)
    total = size.sum()
    axes = [{v: i for i, v in enumerate(sorted({c[k] for c in cells}, key=lambda x: (x is None, x)))} for k in range(3)]
    at = [np.array([axes[k][c[k]] for c in cells], int) for k in range(3)]
    wanted = np.array([targets.get(s, 0.0) for s in axes[0]]) * total
    cap = np.array([caps.get(s, 0) for s in axes[0]], float)[at[0]]
    factor = np.where(wanted[at[0]] > 0, np.minimum(1.0, cap), 0.0)
    natural = [np.bincount(at[k], size, len(axes[k])) / max(total, 1) for k in (1, 2)]
    done = 0
    for done in range(1, rounds + 1):
        before = factor.copy()
        for k, share in ((1, natural[0]), (2, natural[1])):
            got = np.bincount(at[k], factor * size, len(axes[k]))
            factor = factor * np.divide(share * got.sum(), got, out=np.ones_like(got), where=got > 0)[at[k]]
        # the source targets last, spread over the cells that the cap leaves room in
        # a round fills up at least one more cell, or is the last
        for _ in range(len(cells) + 1):
            factor = np.minimum(factor, cap)
            held = factor >= cap
            fixed = np.bincount(at[0], factor * size * held, len(wanted))
            free = np.bincount(at[0], factor * size * ~held, len(wanted))
            scale = np.divide(np.maximum(0, wanted - fixed), free, out=np.ones_like(free), where=free > 0)
            factor = np.where(held, factor, factor * scale[at[0]])
            if (factor <= cap * (1 + 1e-12)).all():
                break
        factor = np.minimum(factor, cap)
        if np.abs(factor - before).max() < tolerance:
            break
    return Raked(cells, factor, done)


def _source(c: Column) -> Column:
    return F.lower(F.trim(c))


def mix(docs: DataFrame, doc: str, source: str, lang: str, topic: str, size: str, targets: DataFrame, seed: int = 1, max_cells: int = MAX_CELLS) -> tuple[DataFrame, DataFrame]:
    """(sample, report) for materialised ``docs``; ``targets`` has source, target_share and max_repeats.

    sample: (doc, source, size, copies) of the documents taken. report, a row per source of ``targets`` or ``docs``:
    size, target_share, max_repeats, target_size, capacity (size x max_repeats), planned and reached size, reached_share,
    and ``short`` where the raked plan, all cells of the source at their cap, stays below the target size. Sources compare in lower case without outer blanks.
    The total size is that of all documents; where a source is short the mixture falls short of it, no other source makes
    up for it. A source without documents has size 0; documents without source, or with a source without target, are not
    taken. Null sizes count as 0. Empty tables give empty results.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).alias("doc"), _source(F.col(source)).alias("source"), F.col(lang).alias("lang"), F.col(topic).alias("topic"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"))
    cells = rows.groupBy("source", "lang", "topic").agg(F.sum("size").alias("size")).limit(max_cells + 1).collect()
    wanted = targets.select(_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null").limit(max_cells + 1).collect()
    if max(len(cells), len(wanted)) > max_cells:
        raise ValueError(f"more than {max_cells} cells of source, language and topic, or targets")
    share, cap = {r[0]: r[1] or 0.0 for r in wanted}, {r[0]: r[2] or 0 for r in wanted}
    sizes = np.array([r[3] for r in cells], float)
    raked = rake([(r[0], r[1], r[2]) for r in cells], sizes, share, cap)
    total = float(sizes.sum())

    factors = spark.createDataFrame([(r[0], r[1], r[2], float(f)) for r, f in zip(cells, raked.factor) if r[0] is not None], "source string, lang string, topic string, factor double")
    # the cells are bounded by max_cells
    on = (rows.source == F.col("f.source")) & rows.lang.eqNullSafe(F.col("f.lang")) & rows.topic.eqNullSafe(F.col("f.topic"))
    drawn = rows.join(F.broadcast(factors.alias("f")), on).select(rows.doc, rows.source, rows["size"], "factor")
    u = F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    sample = drawn.withColumn("copies", (F.floor("factor") + (u < F.col("factor") - F.floor("factor")).cast("int")).cast("int")).where("copies > 0").select(F.col("doc").alias(doc), "source", "size", "copies")

    planned: dict = {}
    own: dict = {}
    for r, f in zip(cells, raked.factor):
        planned[r[0]] = planned.get(r[0], 0.0) + float(f) * r[3]
        own[r[0]] = own.get(r[0], 0) + r[3]
    names = [s for s in sorted({*own, *share} - {None})]
    table = [(s, int(own.get(s, 0)), float(share.get(s, 0.0)), int(cap.get(s, 0)), share.get(s, 0.0) * total, int(own.get(s, 0) * cap.get(s, 0)), float(planned.get(s, 0.0)), planned.get(s, 0.0) < share.get(s, 0.0) * total * (1 - 1e-9)) for s in names]
    base = spark.createDataFrame(table, "source string, size long, target_share double, max_repeats int, target_size double, capacity long, planned_size double, short boolean")
    reached = sample.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("reached_size"), F.max("copies").alias("most_copies"))
    report = base.join(reached, "source", "left").withColumn("reached_size", F.coalesce("reached_size", F.lit(0)))
    # one window over the sources, which max_cells bounds
    all_reached = F.sum("reached_size").over(Window.partitionBy(F.lit(0))).cast("double")
    report = report.withColumn("reached_share", F.try_divide(F.col("reached_size").cast("double"), all_reached))
    return sample, report
