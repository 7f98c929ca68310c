"""Mixing sources to target weights by weighted fair queueing.

Each source has a weight, and its target is its share of the budget by weight; a target
above ``repeats`` times the size of its source stops there, and the excess is shared out
anew by weight. The documents of a source queue in shuffled order, round after round. A
document's virtual finish time is the number of words its source has given with it, divided
by the source's target. All documents of all rounds are then sorted by finish time, and
the mix is cut off where the next one would exceed the budget.

A running total over shuffled or sorted rows never gathers a source, or the mix, in one
task. Rows fall into ranges of about ``RANGE_WORDS`` words along the order; the sums of
ranges are added up block by block, and only the rows of one range are sorted together. All
of this handles ids, sizes and times alone: texts are read once, to be counted.

Shuffled order is by a digest of the id and the size, so reruns agree. Rows alike in
id, source and size take their turns one after another and may stand for each other. A null
text has no words; it takes no turn and nothing is taken of it. Null ids queue like others.
Null is a source of its own, after all others. A source without words has the target 0. An
empty table gives an empty table. Only the columns ``doc_id``, ``text`` and ``source`` are
looked at, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm.common import documents, word_count, written

#: Words of a range of rows that are sorted together.
RANGE_WORDS = 8192
#: Ranges, or blocks of them, whose sums are added up together, and the levels of blocks.
FAN = 256
LEVELS = 2
#: Copies of a row that one element of an array stands for.
COPIES = 4096
#: A digest is cut to so many hexadecimal digits.
DIGITS = 15


@dataclass(frozen=True)
class MixRule:
    """``weights`` repeat over the sources in order; ``share`` of all words is the budget."""

    weights: Sequence[float] = (1, 2, 3)
    repeats: int = 3
    share: float = 1.0


@dataclass(frozen=True)
class Mix:
    """``sources`` with their targets, the ``plan`` by document and the mixed ``sequence``.

    ``sequence`` has a row for each turn that is taken, with its virtual finish time and
    ``words_before`` it in the mix. ``budget`` counts words.
    """

    sources: DataFrame
    plan: DataFrame
    sequence: DataFrame
    budget: int

    def in_order(self) -> DataFrame:
        """The sequence, range-sorted over all tasks."""
        return self.sequence.orderBy("words_before")


def range_bases(rows: DataFrame, within: Sequence[str], value: str) -> DataFrame:
    """``base`` of each ``range`` in each group: the sum of ``value`` over the ranges before it."""
    return _bases(rows.groupBy(*within, "range").agg(F.sum(value).alias("sum")), within, LEVELS)


def _bases(sums: DataFrame, within: Sequence[str], above: int) -> DataFrame:
    """Sums before each range: those of the blocks before its block, and before it in the block."""
    keys = [*within, "block"] if above else [*within]
    window = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("sum").over(window), F.lit(0))
    if above:
        sums = sums.withColumn("block", F.expr(f"range div {FAN}"))
        blocks = sums.groupBy(*keys).agg(F.sum("sum").alias("sum")).withColumnRenamed("block", "range")
        blocks = _bases(blocks, within, above - 1)
        sums = sums.join(blocks.select(*within, F.col("range").alias("block"), F.col("base").alias("first")), keys)
        base = base + F.col("first")
    return sums.select(*within, "range", base.cast("long").alias("base"))


def running_total(
    rows: DataFrame, bases: DataFrame, within: Sequence[str], order: Sequence[Column], value: str
) -> DataFrame:
    """``rows`` of the ranges in ``bases`` with ``before``: the sum of ``value`` over earlier rows."""
    keys = [*within, "range"]
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(bases, keys)
    here = F.coalesce(F.sum(value).over(window), F.lit(0))
    return placed.withColumn("before", (F.col("base") + here).cast("long")).drop("base", "range")


def ranked_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``source, source_size, place, weight``; places count sources by code point, null last.

    Sources are sorted by ranges, each task numbers its own, and the counts of the tasks
    before are added.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = F.col("source").asc_nulls_last()
    dealt = totals.repartitionByRange(by_name).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "sources")
    counts = dealt.groupBy("part").count()
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    counts = counts.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("part").orderBy(by_name)) - 1
    ranked = dealt.withColumn("number", number).join(counts, "part")
    ranked = ranked.withColumn("place", F.col("base") + F.col("number"))
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weight = F.get(cycle, (F.col("place") % len(weights)).cast("int"))
    return ranked.select("source", "source_size", "place", weight.alias("weight"))


def with_targets(sources: DataFrame, budget: int, repeats: int) -> DataFrame:
    """``sources`` with ``target``: shares of ``budget`` by weight, up to ``repeats`` sizes.

    Each step sums up two numbers over all sources. Sources that are full stay full, as
    the level only rises, so the steps end; there are as many as the level has rises.
    """
    most = (F.lit(repeats) * F.col("source_size")).cast("double")
    level, full_before = 0.0, -1
    while True:
        full = (most < F.lit(level) * F.col("weight")) if full_before >= 0 else F.lit(False)
        n_full, in_full, weight = sources.agg(
            F.count(F.when(full, 1)),
            F.coalesce(F.sum(F.when(full, F.lit(repeats) * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n_full == full_before or not weight:
            break
        full_before, level = n_full, (budget - in_full) / weight
    return sources.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))


def _shuffled(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with words once: ``doc_id, size, place, source_size, target, before``."""
    alike = sizes.where("size > 0").groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    rows = alike.join(sources, alike.source.eqNullSafe(sources.source)).drop("source")
    label = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size"))
    digest = F.conv(F.substring(F.md5(label.cast("binary")), 1, DIGITS), 16, 10).cast("long")
    ranges = F.ceil(F.col("source_size") / RANGE_WORDS)
    part = F.floor(F.col("digest") / F.lit(float(16**DIGITS)) * ranges)
    rows = rows.withColumn("digest", digest).withColumn("words", F.expr("size * copies"))
    rows = written(rows.withColumn("range", part.cast("long")), "shuffled")
    order = [F.col("digest"), F.col("doc_id").asc_nulls_last(), F.col("size")]
    queue = running_total(rows, range_bases(rows, ["place"], "words"), ["place"], order, "words")
    # Copies in two steps: no array grows with a group of copies.
    queue = queue.withColumn("many", F.explode(F.expr(f"sequence(0, (copies - 1) div {COPIES})")))
    queue = queue.withColumn(
        "one", F.explode(F.expr(f"sequence(0, least({COPIES}, copies - many * {COPIES}) - 1)"))
    )
    before = F.expr(f"before + (many * {COPIES} + one) * size")
    return queue.select("doc_id", "size", "place", "source_size", "target", before.alias("before"))


def mix_sources(docs: DataFrame, rule: MixRule = MixRule()) -> Mix:  # noqa: B008
    """How often each document is taken, and the mix itself."""
    sizes = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size")
    )
    sizes = written(sizes, "sizes")
    sources = written(ranked_sources(sizes, rule.weights), "ranked")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = total if rule.share == 1 else int(total * rule.share)
    sources = written(with_targets(sources, budget, rule.repeats), "targets")
    queue = written(_shuffled(sizes, sources), "queue")

    turns = queue.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(rule.repeats - 1))))
    given = F.col("turn") * F.col("source_size") + F.col("before") + F.col("size")
    turns = turns.withColumn("finish", given / F.col("target"))
    ranges = max(1, -(-budget // RANGE_WORDS))
    turns = turns.withColumn("range", F.floor(F.col("finish") * ranges).cast("long"))
    bases = written(range_bases(turns, [], "size"), "bases")
    # Ranges that start beyond the budget are not taken, and need not be sorted.
    bases = bases.where(F.col("base") < budget)
    last = bases.agg(F.max("range")).first()[0]
    order = [F.col(name) for name in ("finish", "place", "turn", "before_in_source")]
    turns = turns.where(F.col("range") <= F.lit(last).cast("long"))
    turns = turns.withColumnRenamed("before", "before_in_source")
    sequence = running_total(turns, bases, [], order, "size")
    sequence = sequence.where(F.col("before") + F.col("size") <= budget)
    sequence = written(sequence.withColumnRenamed("before", "words_before"), "mix")

    # A row with words is known by its source and the words before it there.
    times = sequence.groupBy("place", F.col("before_in_source").alias("before")).agg(F.count("*").alias("turns"))
    taken = queue.join(times, ["place", "before"], "left")
    taken = taken.withColumn("turns", F.coalesce("turns", F.lit(0)).cast("int"))
    wordless = sizes.where("size = 0").join(sources, sizes.source.eqNullSafe(sources.source))
    columns = ["doc_id", "size", "place", "source_size", "target", "turns"]
    rows = taken.select(*columns).union(wordless.withColumn("turns", F.lit(0)).select(*columns))
    plan = rows.withColumn("taken", F.expr("turns * size"))
    return Mix(sources, plan, sequence, budget)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_sources(documents(spark, sf_dir)).plan
    return plan.select("doc_id", "size", "source_size", "target", "taken", "turns")


#: The same by windows over whole tables.
ORACLE = f"""
WITH sizes AS (
  SELECT doc_id, source, CASE WHEN body = '' THEN 0
    ELSE len(string_split_regex(body, '[ \\t\\n\\x0B\\f\\r]+')) END AS size
  FROM (SELECT doc_id, source, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
        FROM documents)
), sources AS (
  SELECT source, source_size, place, [1.0, 2.0, 3.0][1 + place % 3]::DOUBLE AS weight,
    (3 * source_size)::DOUBLE AS most
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
          row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place
        FROM sizes GROUP BY source)
), filled AS (
  SELECT *, coalesce(sum(most) OVER before, 0) AS full_before,
    sum(weight) OVER (ORDER BY most / weight DESC, place DESC) AS weight_left
  FROM sources
  WINDOW before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, ((SELECT sum(size) FROM sizes) - full_before) / weight_left AS level FROM filled
), level AS (
  SELECT min_by(level, most / weight) AS level FROM levels WHERE most >= level * weight
), targets AS (
  SELECT s.*, least(most, level * weight) AS target FROM sources s, level
), queue AS (
  SELECT row_number() OVER () AS id, d.doc_id, size, place, source_size, target,
    sum(size) OVER (PARTITION BY place ORDER BY
      ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ' ' || size), 1, {DIGITS}))::BIGINT,
      d.doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS given
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), turns AS (
  SELECT id, size, place, turn, given, (turn * source_size + given)::DOUBLE / target AS finish
  FROM queue, range(3) AS r(turn) WHERE size > 0
), mix AS (
  SELECT id, sum(size) OVER (ORDER BY finish, place, turn, given ROWS UNBOUNDED PRECEDING) AS words FROM turns
), taken AS (
  SELECT id, count(*) AS turns FROM mix WHERE words <= (SELECT sum(size) FROM sizes) GROUP BY id
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * coalesce(turns, 0))::BIGINT AS taken,
  coalesce(turns, 0)::INTEGER AS turns
FROM queue LEFT JOIN taken USING (id)
"""
