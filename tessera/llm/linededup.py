"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (hash, documents that hold the line, largest such doc_id, fresh), hash-partitioned and sorted within its
partitions. A new batch is merge-anti-joined with the runs so far: hashes that no run has start here, and the others
only raise what an earlier run has started. The batch is then added as a run of level 0; as soon as a level has `fanout` runs
they are merged into one run of the next level. A line's total is its one start and all that raised it. A table of any size is thus taken in batch after batch, each line hash being rewritten once a level.

All of it is DataFrame operations. Lines are hashed once, into a table of document ids and hashes. Hashes are distinct
within a document before they are exploded, and counting has a map-side combine, so that a line which a third of all
documents holds is one row from each task. The join that applies the result is a sort-merge join whose hot keys
adaptive execution splits. Texts are shuffled once, at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, table, whole

MIN_CHARS, MIN_DOCS = 40, 5
#: Lines of a batch, about.
BATCH = 200_000_000
BLANK = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(text: Column, min_chars: int) -> Column:
    """Of each line: 128 bits of its key (two hashes with different seeds), or null where the key is too short."""
    keys = F.transform(lines_of(ascii_lower(text)), lambda line: F.btrim(line, F.lit(BLANK)))
    return F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))))


class LineRuns:
    """Levelled runs of all batches added so far. A row starts a hash (`fresh`) or raises one that another run has started; the
    merge-anti-join of a batch with the runs decides which, so that each hash is started once."""

    def __init__(self, spark: SparkSession, fanout: int = 2, scratch: Scratch | None = None):
        self.scratch, self.fanout = scratch or Scratch(spark, "line-runs"), fanout
        self.levels: list[list[DataFrame]] = []

    def _all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def _told_apart(self, own: DataFrame) -> DataFrame:
        """own with fresh: true for the hashes that no run has."""
        seen = self._all()
        if seen is None:
            return own.withColumn("fresh", F.lit(True))
        old = seen.filter("fresh").select("a", "b")
        new = own.join(old.hint("merge"), ["a", "b"], "left_anti").withColumn("fresh", F.lit(True))
        return new.unionByName(own.join(old.hint("merge"), ["a", "b"], "left_semi").withColumn("fresh", F.lit(False)))

    def add(self, batch: DataFrame, doc_id: str, hashes: str) -> None:
        """Take in one batch of whole documents, given the hashed lines of each."""
        each = F.explode(F.array_distinct(F.filter(hashes, lambda h: h.isNotNull())))
        rows = batch.select(F.col(doc_id).alias("doc_id"), each.alias("h")).select("h.a", "h.b", "doc_id")
        own = rows.groupBy("a", "b").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("holder"))
        self._push(self.scratch.write(self._told_apart(own).sortWithinPartitions("a", "b")), 0)

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            both = reduce(DataFrame.unionByName, old)
            merged = both.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"), F.bool_or("fresh").alias("fresh"))
            merged = self.scratch.write(merged.sortWithinPartitions("a", "b"))
            self.scratch.drop(*old)
            self._push(merged, level + 1)

    def totals(self) -> DataFrame | None:
        """(a, b, n_docs, holder) of every line taken in: what started it, with all that raised it since."""
        every = self._all()
        if every is None:
            return None
        raised = every.filter("not fresh").groupBy("a", "b").agg(F.sum("n_docs").alias("more"), F.max("holder").alias("later"))
        both = every.filter("fresh").join(raised, ["a", "b"], "left")
        return both.select("a", "b", (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("holder", "later").alias("holder"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fanout: int = 2, out: str = "text") -> DataFrame:
    """docs with repeated lines removed from `text` (written to column `out`), plus n_lines and n_dropped.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at least min_chars
    code points which at least min_docs documents hold lose all their lines, except in the document with the largest
    doc_id that holds them. Null or empty text is one empty line. Each row is a document of its own; rows that repeat a
    doc_id count each, and are treated alike. A null doc_id sorts below all others. Other columns stay as they are, whatever
    their names, but for n_lines, n_dropped and `out`, which are replaced. batches: as many as keep each at BATCH lines, if not given.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    scratch = Scratch(spark, "lines")
    hashed = scratch.write(docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("of"), hashed_lines(F.col(text), min_chars).alias("h")))
    runs = LineRuns(spark, fanout, scratch)
    if batches is None:
        batches = max(3, -(-(hashed.agg(F.sum(F.size("h"))).first()[0] or 0) // BATCH))
    dealt = F.pmod(F.xxhash64(F.lit(7), "id", "of"), F.lit(batches))
    for k in range(batches):
        runs.add(hashed.filter(dealt == k), "id", "h")
    often = scratch.write(runs.totals().filter(F.col("n_docs") >= min_docs).select("a", "b", "holder"))
    rows = hashed.select("id", "of", F.posexplode("h").alias("at", "l")).filter("l is not null").select("id", "of", "at", "l.a", "l.b")
    hit = rows.join(often, ["a", "b"]).filter(F.col("holder").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("holder"))))
    gone = hit.groupBy("id", "of").agg(F.collect_set("at").alias("gone"))
    mine = docs.select(whole(docs).alias("row"), F.col(doc_id).alias("my_id"), F.col(text).alias("text"), F.xxhash64(text).alias("my_of"))
    both = mine.join(gone, F.col("my_id").eqNullSafe(F.col("id")) & (F.col("my_of") == F.col("of")), "left")
    lines, gone_at = lines_of(F.col("text")), F.coalesce("gone", F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone_at)
    kept = F.when(F.size(gone_at) == 0, F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    columns = [kept.alias(c) if c == out else F.col("row").getField(c).alias(c) for c in docs.columns]
    return both.select(*columns, *([] if out in docs.columns else [kept.alias(out)]), F.size(lines).cast("long").alias("n_lines"), F.size(gone_at).cast("long").alias("n_dropped"))


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, null texts as one empty line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
often AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE often.k IS NOT NULL AND doc_id <> holder) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often.k IS NULL OR doc_id = holder), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (k) GROUP BY doc_id
"""
