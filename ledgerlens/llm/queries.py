"""Queries of this subpackage: percentiles (p2), top N (p3), batch de-duplication (p5), packing (p8), mixing (p9), content (p10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import col, name_form
from ledgerlens.llm import abuse, mixing, packing, segments, sketch, tokens, topn
from ledgerlens.queries import table
from ledgerlens.session import materialise, scratch_path

#: Tokens of a container.
CAPACITY = 2048


def sql_name(c: str) -> str:
    return f"upper(trim(regexp_replace(\"{c}\", '\\s+', ' ', 'g')))"


def _aggregates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "client_aggregates").select("agg_id", "run_no", name_form(col("Market Segment Name")).alias("market"), col("CA_EUR").alias("ca")).where("market is not null")


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles within 1 percent from sketches of each run, added up."""
    runs = sketch.build(_aggregates(spark, d), ["market", "run_no"], "ca")
    return sketch.percentiles(sketch.merge(runs, ["market"]), ["market"], [0.05, 0.25, 0.5, 0.75, 0.95])


def _exact(spark: SparkSession, d: str, probs: list[float]) -> DataFrame:
    rows = _aggregates(spark, d)
    runs = sketch.build(rows, ["market", "run_no"], "ca")
    return sketch.exact_percentiles(rows, sketch.merge(runs, ["market"]), ["market"], "ca", probs)


def p2_exact_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return _exact(spark, d, [0.05, 0.25, 0.5, 0.75, 0.95]).select("market", "p", "value", F.col("group_n").alias("n"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows far outside the quartiles; the exact quartiles come from the buckets that the merged sketches point at."""
    at = _exact(spark, d, [0.25, 0.75]).groupBy("market").agg(F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("p25"), F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("p75"))
    rows = _aggregates(spark, d).where("ca is not null and not isnan(ca)")
    # the planner broadcasts the quartiles only below the session's size threshold
    return rows.join(at, "market").where("ca > p75 + 6 * (p75 - p25) or ca < p25 - 6 * (p75 - p25)").select("agg_id")


P2_RANKED = f"""with r as (select agg_id, {sql_name('Market Segment Name')} as market, "CA_EUR" as ca from client_aggregates),
 o as (select *, row_number() over (partition by market order by ca) as rn, count(*) over (partition by market) as n from r where market is not null and ca is not null and not isnan(ca))
"""


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "client_aggregates").select("run_no", name_form(col("Reporting Entity Label")).alias("entity"), col("CA_EUR").alias("ca"), name_form(F.col("Customer")).alias("customer"), "agg_id")
    best = topn.top_n(rows, ["run_no", "entity"], "ca", "customer", "agg_id", 3)
    # the key is <length>:<run><length>:<entity>
    size = F.regexp_extract("g", r"^(\d+):", 1).cast("int")
    at = F.instr("g", ":")
    run = F.substring(F.col("g"), at + 1, size)
    rest = F.substring(F.col("g"), at + 1 + size, F.lit(2**30))
    return best.select(run.cast("int").alias("run_no"), F.regexp_replace(rest, r"^\d+:", "").alias("entity"), F.col("tie").alias("agg_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Every file is checked against the index of all files before it, in the order of load_seq, and appended."""
    ops = table(spark, d, "operations")
    attributes = [name_form(F.col("Customer")), F.col("Period"), col("Activity Name (EN)"), col("Product Name"), col("Turnover in EUR")]
    jobs = segments.keyed(ops, "load_seq", F.col("JobfileNumber"), attributes, keep=[col("__source_file__").alias("file")])
    # the number of files doesn't grow with the rows
    files = [r[0] for r in ops.groupBy(col("__source_file__").alias("file")).agg(F.min("load_seq").alias("at")).orderBy("at").collect()]
    index = segments.BatchIndex(spark, scratch_path(spark, "history"))
    index.accept_all(list(range(len(files))), jobs.withColumn("batch", F.array_position(F.lit(files), F.col("file")).cast("int") - 1))
    return index.repeats()


def _spread(docs: DataFrame) -> DataFrame:
    """At least two tasks a core, as reading texts costs far more than moving them; a table of that many splits isn't moved."""
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= tasks else docs.repartition(tasks)


def _packed(spark: SparkSession, d: str):
    sizes = materialise(_spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", tokens.count_tokens(F.col("text")).alias("size")), "sizes")
    return packing.pack(sizes, "doc_id", "size", CAPACITY)


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every text, or piece of one that is too long, with its container."""
    return _packed(spark, d)[0]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0].where("piece = 0 and pieces > 1").select("doc_id")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and the share of space used."""
    fill = _packed(spark, d)[0].groupBy("container").agg(F.sum("size").alias("used"))
    return fill.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), (F.sum("used") / (F.count("*") * CAPACITY)).alias("share_used"))


def _mixed(spark: SparkSession, d: str):
    docs = _spread(table(spark, d, "documents").select("doc_id", "source", "lang", "text"))
    sized = docs.select("doc_id", "source", "lang", mixing.topic_of(F.col("text")).alias("topic"), tokens.count_tokens(F.col("text")).alias("size"))
    return mixing.mix(materialise(sized, "sized"), "doc_id", "source", "lang", "topic", "size", table(spark, d, "mix_targets"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents taken and how often."""
    return _mixed(spark, d)[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of every source."""
    return _mixed(spark, d)[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_report(spark, d).where("short and target_share > 0").select("source")


def _scored(spark: SparkSession, d: str) -> tuple[DataFrame, float]:
    docs = _spread(table(spark, d, "documents").select("doc_id", "source", "text"))
    reviewed = abuse.examples_of(table(spark, d, "review_examples"), "example_id", "example_text", "verdict")
    return abuse.score_corpus(docs, "text", *reviewed)


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)[0].select("doc_id", "score")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Flagged texts per source."""
    scored, threshold = _scored(spark, d)
    return abuse.rates(scored, F.lower(F.trim("source")), threshold)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    scored, threshold = _scored(spark, d)
    return scored.where(F.col("score") > threshold).select("doc_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_percentiles, p2_exact_percentiles, p3_found, p5_found, p8_found, p8_containers, p8_fill, p9_found, p9_mixture, p9_report, p10_found, p10_scores, p10_rates)}

ORACLE = {
    "p2_found": P2_RANKED + ", q as (select market, max(case when rn = (n + 3) // 4 then ca end) as p25, max(case when rn = (3 * n + 3) // 4 then ca end) as p75 from o group by 1) select agg_id from o join q using (market) where ca > p75 + 6 * (p75 - p25) or ca < p25 - 6 * (p75 - p25)",
    "p2_exact_percentiles": P2_RANKED + "select market, p, ca as value, n from o, (values (0.05::double, 1), (0.25::double, 5), (0.5::double, 10), (0.75::double, 15), (0.95::double, 19)) as t(p, k) where rn = (k * n + 19) // 20",
    "p5_found": rf"""with recursive j as (select load_seq, nullif(upper(regexp_replace("JobfileNumber", '[^\p{{L}}\p{{Nd}}]+', '', 'g')), '') as s,
  {sql_name('Customer')} as c, "Period" as p, "Activity Name (EN)" as a, "Product Name" as r, "Turnover in EUR" as t from operations),
 k as (select *, regexp_replace(s, '^(\p{{L}}+\d\d)0*(\d*)$', '\1\2') as canon from j where s is not null),
 u as (select distinct s, canon, c, p, a, r, t from k where c is not null and p is not null and a is not null and r is not null and t is not null),
 e as (select distinct x.canon as f, y.canon as g from u x join u y using (c, p, a, r, t) where x.canon <> y.canon and levenshtein(x.s, y.s) <= 2),
 w(f, g) as (select canon, canon from k union select w.f, e.g from w join e on w.g = e.f),
 m as (select canon, min(load_seq) as first from k group by 1),
 o as (select w.f as canon, min(m.first) as first_seq from w join m on w.g = m.canon group by 1)
select first_seq, load_seq as repeat_seq from k join o using (canon) where load_seq <> first_seq""",
    "p3_found": f"""with r as (select agg_id, run_no, {sql_name('Reporting Entity Label')} as entity, {sql_name('Customer')} as c, "CA_EUR" as ca from client_aggregates),
 o as (select *, row_number() over (partition by run_no, entity, c order by ca desc, agg_id) as k from r where entity is not null and c is not null and ca is not null and not isnan(ca)),
 t as (select *, row_number() over (partition by run_no, entity order by ca desc, agg_id) as rk from o where k = 1)
select run_no, entity, agg_id from t where rk <= 3""",
}
