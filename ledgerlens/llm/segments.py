"""De-duplicating new batches against all history by a segment index for edit distance.

A string within ``tau`` edits of an indexed one contains at least one of its tau + 1 segments at a position shifted by
at most tau, so each string is stored with its segments, found by (scope, length, segment number, segment), and a new string probes with the
few of its substrings that could be such a segment. Candidates are verified by bounded edit distance. A batch probes
the stored index and itself, and is appended.

Where very many strings share a scope, a segment that all of them have would make pairs of all of them. There strings meet by
what is left of them after up to tau deletions instead, which strings within tau edits have in common, and few others.

The scope is a hash of attributes that must be equal as well. It is part of the index key, so that a segment that
a third of all numbers share leads to strings of the same scope only; and a scope with one distinct string is never probed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.components import components
from ledgerlens.session import BROADCAST_ROWS, materialise

TAU = 2
#: Strings of one scope from which on they meet by deletions.
CROWD = 500


def number_form(c: Column) -> Column:
    """Letters and digits only, upper case; null where there are none."""
    s = F.upper(F.regexp_replace(c, r"[^\p{L}\p{Nd}]+", ""))
    return F.when(s != "", s)


def canonical_form(form: Column) -> Column:
    """The number form without the leading zeros of the serial: the digits after letters and a two-digit year."""
    return F.regexp_replace(form, r"^(\p{L}+\d\d)0*(\d*)$", "$1$2")


def _segment(length: str, no: str, tau: int) -> tuple[str, str]:
    """SQL of the start (from 0) and the size of segment ``no`` of the tau + 1 even segments of a string of that length; the last ones are longer by one."""
    parts = tau + 1
    longer = f"({no} - ({parts} - ({length}) % {parts}))"
    return f"cast(({length}) div {parts} * {no} + greatest(0, {longer}) as int)", f"cast(({length}) div {parts} + if({longer} >= 0, 1, 0) as int)"


def segments_of(tau: int = TAU) -> Column:
    """The tau + 1 segments of the string s, in order."""
    at, size = _segment("length(s)", "i", tau)
    return F.expr(f"transform(sequence(0, {tau}), i -> substring(s, {at} + 1, {size}))")


def _probes(tau: int) -> str:
    """SQL of the hashed (length, segment number, segment) that a string s looks for: for every indexed length within tau, the
    substrings that can match a segment of it.

    Position windows come from both ends: the i-th segment can shift left by at most i edits counted from the left, and
    what is left of tau counts from the right end.
    """
    n, other = "length(s)", "length(s) + d"
    at, size = _segment(other, "i", tau)
    lo = f"greatest(0, {at} - i, {at} - d - ({tau} - i))"
    hi = f"least({n} - {size}, {at} + i, {at} - d + ({tau} - i))"
    window = f"if({other} > 0 and {lo} <= {hi}, sequence({lo}, {hi}), cast(array() as array<int>))"
    entry = f"xxhash64({other}, i, substring(s, at + 1, {size}))"
    return f"flatten(transform(sequence(-{tau}, {tau}), d -> flatten(transform(sequence(0, {tau}), i -> transform({window}, at -> {entry})))))"


def _remnants(tau: int) -> str:
    """SQL of what is left of a string s after up to ``tau`` deletions, hashed."""
    levels = ["array(s)"]
    for _ in range(tau):
        levels.append(f"array_distinct(flatten(transform({levels[-1]}, x -> transform(sequence(1, greatest(1, length(x))), k -> concat(substring(x, 1, k - 1), substring(x, k + 1))))))")
    return f"transform(concat({', '.join(levels)}), x -> xxhash64(x))"


def near(new: DataFrame, known: DataFrame, tau: int = TAU, crowd: int = CROWD) -> DataFrame:
    """(s, t): strings of ``new`` (scope, s) and of ``known`` (scope, s, segments) that share a scope, within ``tau`` edits, t not s; each pair once.

    The distinct strings of ``known`` include those of ``new``, so a scope with one string is never probed.
    """
    h = F.xxhash64("s")
    sizes = known.groupBy("scope").agg(F.min(h).alias("lo"), F.max(h).alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("scope", (F.col("n") > crowd).alias("many"))
    indexed = "transform(segments, (x, i) -> xxhash64(length(s), i, x))"
    keys = lambda of: F.expr(f"explode(array_distinct(if(many, {_remnants(tau)}, {of})))").alias("key")
    mine, theirs = new.join(sizes, "scope").select("scope", "s", keys(_probes(tau))), known.join(sizes, "scope").select("scope", F.col("s").alias("t"), keys(indexed))
    return mine.join(theirs, ["scope", "key"]).where("s <> t").select("s", "t").distinct().where(F.levenshtein("s", "t", tau) >= 0)


def keyed(df: DataFrame, seq: str, number: Column, attributes: list[Column], keep: list[Column] = []) -> DataFrame:
    """(seq, s, canon, scope) of the rows with a number, and the columns ``keep``; scope is null where an attribute is missing."""
    all_there = F.lit(True)
    for a in attributes:
        all_there = all_there & a.isNotNull()
    scope = F.when(all_there, F.xxhash64(*attributes))
    rows = df.select(F.col(seq).cast("long").alias("seq"), number_form(number).alias("s"), scope.alias("scope"), *keep)
    return rows.where("s is not null and seq is not null").withColumn("canon", canonical_form(F.col("s")))


def repeats(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(first_seq, repeat_seq) of ``keyed`` rows: every row but the first of the rows that are the same operation.

    Rows agree if their canonical numbers are equal, or if ``links`` (canon, other) joins these; this carries over from row to row.
    """
    classes = materialise(rows.groupBy("canon").agg(F.min("seq").alias("first"), F.count("*").alias("n")), "classes")
    ends = links.select(F.least("canon", "other").alias("canon"), F.greatest("canon", "other").alias("other")).distinct()
    firsts = classes.select("canon", "first")
    edges = ends.join(firsts.withColumnRenamed("first", "a"), "canon").join(firsts.select(F.col("canon").alias("other"), F.col("first").alias("b")), "other").select("a", "b")
    roots = materialise(components(edges, "a", "b"), "roots")
    linked = classes.join(roots, F.col("first") == F.col("node"), "left")
    # classes of one row that is linked to no earlier one give no case, so they aren't joined back
    wanted = linked.where("n > 1 or root is not null").select("canon", F.coalesce("root", "first").alias("first_seq"))
    found = rows.select("seq", "canon").join(wanted, "canon").where("seq <> first_seq")
    return found.select("first_seq", F.col("seq").alias("repeat_seq"))


ROWS, STRINGS, LINKS = "seq long, s string, canon string, scope long", "scope long, s string, segments array<string>, bucket int", "canon string, other string"


class BatchIndex:
    """The history of accepted batches in a folder; each new batch is checked against all of it, and appended.

    Each batch has its own part of three tables: rows (seq, s, canon, scope), strings (the distinct s of a scope, with its segments in
    order) and links (pairs of canonical numbers that are the same operation). A batch counts once its mark is written, which comes
    last: one that broke off leaves nothing behind and may be given again. Strings lie in ``buckets`` folders by their scope, and only
    those are read that the batch has scopes for; of these, only strings whose scope the batch has are probed. Links and rows of
    earlier batches aren't read. So a batch costs its own size, and a scan of the probed buckets, which holds one hash a string.
    """

    def __init__(self, spark: SparkSession, path: str, tau: int = TAU, crowd: int = CROWD, buckets: int = 4, together: int = 8) -> None:
        self.spark, self.path, self.tau, self.crowd, self.buckets, self.together = spark, path, tau, crowd, buckets, together

    def batches(self) -> list[int]:
        """Numbers of the batches accepted."""
        try:
            return sorted({r[0] for r in self.spark.read.schema("batch int").json(f"{self.path}/marks").collect()})
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def _read(self, name: str, schema: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, batch int").parquet(f"{self.path}/{name}").where(F.col("batch").isin(batches)).drop("batch")

    def _write(self, df: DataFrame, name: str, *by: str) -> None:
        """Replaces the batches in ``df``, so what is left of one that broke off goes."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", *by).parquet(f"{self.path}/{name}")

    def accept(self, batch: int, rows: DataFrame) -> None:
        """Accepts a single batch of ``keyed`` rows."""
        self.accept_all([batch], rows.withColumn("batch", F.lit(batch)))

    def accept_all(self, batches: list[int], rows: DataFrame) -> None:
        """Appends the ``keyed`` rows of new batches, told apart by their column batch, and in the order of ``batches`` the links that
        the numbers of each have to those of all batches before and to each other. ``together`` batches are probed at a time: first all
        against the stored index, and among themselves.

        A batch accepted before isn't taken again. Two scopes of equal 64-bit hash would be taken for one. An empty batch is a batch.
        """
        done = self.batches()
        new = [k for k in batches if k not in done]
        if not new:
            return
        self._write(rows.where(F.col("batch").isin(new)).select("seq", "s", "canon", "scope", "batch"), "rows")
        own = self.spark.read.schema(f"{ROWS}, batch int").parquet(f"{self.path}/rows").where(F.col("batch").isin(new) & F.col("scope").isNotNull())
        bucket = F.pmod("scope", F.lit(self.buckets)).cast("int").alias("bucket")
        strings = own.select("scope", "s", bucket, "batch").repartition("batch", "bucket").distinct()
        self._write(strings.select("scope", "s", segments_of(self.tau).alias("segments"), "bucket", "batch"), "strings", "bucket")
        for at in range(0, len(new), self.together):
            some = new[at : at + self.together]
            self._probe(some, done)
            done += some
        self.spark.createDataFrame([(k,) for k in new], "batch int").coalesce(1).write.mode("append").json(f"{self.path}/marks")

    def _probe(self, batches: list[int], before: list[int]) -> None:
        """Writes the links of some batches to those before them and to each other."""
        new, known = self._read("strings", STRINGS, batches), self._read("strings", STRINGS, [*before, *batches])
        scopes = new.select("scope", "bucket").distinct()
        size, buckets = scopes.agg(F.count("*"), F.collect_set("bucket")).first()
        known = known.where(F.col("bucket").isin(buckets))
        # the scopes are broadcast where they are few, else both sides are shuffled by them
        scopes = scopes.select("scope")
        met = known.join(F.broadcast(scopes) if size <= BROADCAST_ROWS else scopes, "scope", "left_semi").select("scope", "s", "segments")
        pairs = near(new.select("scope", "s").distinct(), met, self.tau, self.crowd)
        links = pairs.select(canonical_form(F.col("s")).alias("canon"), canonical_form(F.col("t")).alias("other")).where("canon <> other").distinct()
        links.write.mode("overwrite").parquet(f"{self.path}/links/batch={batches[-1]}")

    def repeats(self) -> DataFrame:
        """(first_seq, repeat_seq) over all batches accepted. Later batches can join classes, so a row's first_seq may be lower than it was."""
        done = self.batches()
        return repeats(self._read("rows", ROWS, done), self._read("links", LINKS, done))

    def check(self, batch: int, rows: DataFrame) -> DataFrame:
        """Accepts a batch and gives what is new by it: the (first_seq, repeat_seq) of its own rows, and of earlier rows whose first_seq it changed.

        Unlike ``accept`` this reads the rows and links of all batches.
        """
        before = materialise(self.repeats(), "before")
        self.accept(batch, rows)
        return self.repeats().exceptAll(before)
