"""Filter interaction audit: what each of five filters removes, in every order of them.

Filters (a document *fails* one if the condition holds), on whole texts, null being empty:
A fewer than 50 words; B fewer than 65 distinct words in 100; C more than 5 capitals in 100 code
points; D any of ``#$%&*|``; E the text is that of a row with a smaller id.

1. One pass of the byte transducer (``transducer.py``) over every text gives the bits of A to D and a
   digest of the text. Nothing but those, the id and the part goes on.
2. E: the least id of each digest is an aggregate with a partial step, so a group of copies sends one
   row a task. Joined back by digest *and* id, it meets the rows that are first of their text: no
   group of copies meets in a task.
3. A document is then one of 32 sets of failed filters. Counts per (part, set, labels) are all that is
   left, at most 128 rows a part. What a filter removes depends on the set of filters before it, not
   on their order: 80 states (set before, filter) are evaluated a part and laid out over the 120 orders
   by a join with a table of 600 fixed rows.

Odd rows: a null part is the empty string; a null id has no smaller id and is smaller than none, so
it never fails E and has no labels; several rows of one id and text are all first of it; of several
label rows of one id any mark counts. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardflow.llm.common import give_back, ship_code, short_batches, written
from cardflow.llm.textstats import utf8
from cardflow.llm.transducer import digests, text_counts

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
_SETS = 1 << len(FILTERS)
#: Rows whose texts are looked at together.
BATCH_ROWS = 500


def failed_filters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, failed, digest) of every row: a bit for each of the filters A to D that the text fails."""

    def run(batches):
        for batch in short_batches(batches, BATCH_ROWS):
            texts = utf8(batch.column(2).to_pylist())
            words, distinct, points, capitals, symbols = text_counts(texts).T
            failed = ((words < MIN_WORDS) * 1 + (100 * distinct < DISTINCT_PERCENT * words) * 2
                      + (100 * capitals > CAPITAL_PERCENT * points) * 4 + (symbols > 0) * 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(failed, pa.int32()), pa.array(digests(texts), pa.binary())],
                names=["doc_id", "part", "failed", "digest"])
        give_back()

    ship_code(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "doc_id long, part string, failed int, digest binary")


def failure_sets(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 part: str = "source") -> DataFrame:
    """(part, failed, docs, good, toxic): documents of each part by the set of filters that they fail."""
    facts = written(failed_filters(docs, doc_id, text, part), "audit-facts")
    first = facts.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("bad"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    known = facts.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("failed") + F.when(copy, 16).otherwise(0)).alias("failed"))
    marked = known.join(marks, "doc_id", "left")
    return marked.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("docs"), F.sum("good").alias("good"),
                                                F.sum("bad").alias("toxic"))


def _orders(spark) -> DataFrame:
    """The 600 fixed rows (before, filter, filter_order, step) of all orders."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            rows.append((before, FILTERS.index(letter), order, step))
            before |= 1 << FILTERS.index(letter)
    return F.broadcast(spark.createDataFrame(rows, "before int, filter int, filter_order string, step int"))


def _total(column: str, where: str) -> Column:
    """The sum of an array by set of failed filters, over the sets that satisfy ``where``."""
    return F.expr(f"aggregate(sequence(0, {_SETS - 1}), 0L, (a, s) -> a + if({where}, {column}[s], 0L))")


def interactions(sets: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    cell = [F.coalesce(F.sum(F.when(F.col("failed") == s, F.col(c))), F.lit(0).cast("long"))
            for c in ("docs", "good", "toxic") for s in range(_SETS)]
    arrays = [F.array(*cell[k * _SETS:(k + 1) * _SETS]).alias(c) for k, c in enumerate(("docs", "good", "toxic"))]
    parts = sets.groupBy("part").agg(*arrays)
    states = (parts.withColumn("before", F.explode(F.sequence(F.lit(0), F.lit(_SETS - 1))))
              .withColumn("filter", F.explode(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1))))
              .withColumn("bit", F.expr("shiftleft(1, filter)")).filter("before & bit = 0"))
    now, gone = "s & before = 0 and s & bit <> 0", "s & before <> 0 and s & bit <> 0"
    # a state comes up in as many orders as the filters before it and those after it can be arranged
    times = F.element_at(F.array(*[F.lit(factorial(k) * factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS))]),
                         F.bit_count("before") + 1)
    judged = states.select(
        "part", "before", "filter",
        _total("docs", "s & (before | bit) = 0").alias("kept"), _total("docs", now).alias("removed"),
        _total("docs", gone).alias("redundant"), _total("docs", "s = bit").alias("unique_fails"),
        _total("good", now).alias("good_lost"), _total("toxic", now).alias("toxic_lost"), times.alias("times"))
    share = F.sum(F.col("removed") * F.col("times")).over(Window.partitionBy("part", "filter"))
    orders = _orders(sets.sparkSession)
    return judged.withColumn("shapley", share).join(orders, ["before", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see the module's text."""
    return interactions(written(failure_sets(docs, labels, doc_id, text, part), "audit-sets"))
