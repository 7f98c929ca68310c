"""Quality rules as weak supervision: rules vote or abstain, and a model weighs them.

Each rule looks at the counts of a document and votes good (1), bad (-1) or abstains (0).
How often each rule votes which way on good and on bad documents is estimated by
expectation-maximisation over the counts of vote patterns, of which there are at most
three to the number of rules however large the corpus is. A document is kept if its
posterior probability of being good reaches ``MIN_POSTERIOR``, not if all rules pass.

All rows are counted by SQL functions within the row; nothing is shuffled but the partial
counts of patterns. Null texts have no words. A text without words fails the base rule and
gets a posterior like any other. Rows with the same id are judged each by their own text.
An empty table gives an empty table. Extra columns are kept; those named like a result
column are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.llm.common import BLANKS, documents, whole_text, written

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_POSTERIOR = 0.5
ROUNDS = 40

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that the rules look at.
MORE = ("n_lines", "n_distinct_words")

#: Rules as (name, bad if, good if) over the counts; otherwise the rule abstains.
RULES = (
    ("length", "n_words < 20", "n_words >= 40"),
    ("symbol_share", "10 * n_symbols > word_chars", "50 * n_symbols <= word_chars"),
    ("symbols_per_word", "2 * n_symbols > n_words", "20 * n_symbols <= n_words"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 15 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines", "10 * n_dup_lines <= n_lines"),
    ("variety", "5 * n_distinct_words < least(n_words, 1000)", "5 * n_distinct_words >= 2 * least(n_words, 1000)"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
)


def _document_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The counts of every text, next to the columns ``keep``."""
    text = whole_text(F.col("text"))
    body = docs.select(*keep, text.alias("__text"))
    marks = F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))
    chars = F.length(F.translate("__text", BLANKS, ""))
    lines = F.split("__text", "\n", -1)
    trimmed = F.btrim("__text", F.lit(BLANKS))
    no_words = F.array().cast("array<string>")
    split = body.select(
        *keep,
        chars.cast("long").alias("word_chars"),
        marks.cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        F.filter(lines, lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0).alias("__lines"),
        F.when(F.length(trimmed) == 0, no_words)
        .otherwise(F.split(trimmed, WORD_GAP, -1))
        .alias("__words"),
    )
    # A hash for each window of words; words count by their hashes as well.
    hashed = split.select(
        *keep,
        "word_chars",
        "n_symbols",
        "n_lines",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__words").cast("long").alias("n_words"),
        F.transform("__words", lambda word: F.xxhash64(word)).alias("__words"),
    )
    window = ", ".join(f"__words[i + {k}]" for k in range(WINDOW))
    starts = f"if(n_words >= {WINDOW}, sequence(0, cast(n_words as int) - {WINDOW}), array())"
    windows = hashed.select(
        "*",
        F.size(F.array_distinct("__words")).cast("long").alias("n_distinct_words"),
        F.expr(f"transform({starts}, i -> xxhash64({window}))").alias("__windows"),
    ).drop("__words")
    # Only texts with an equal pair sort their windows; equal ones are then neighbours.
    equal = F.size(F.array_distinct("__windows")) < F.size("__windows")
    in_order = F.expr("sort_array(transform(__windows, (h, i) -> struct(h as h, i as i)))")
    ordered = windows.select("*", F.when(equal, in_order).alias("__sorted")).drop("__windows")
    twice = F.expr(
        "sort_array(transform(filter(transform(__sorted, (w, k) -> struct(w.i as i, "
        "(k > 0 and w.h = __sorted[if(k > 0, k - 1, 0)].h) or (k + 1 < size(__sorted) "
        "and w.h = __sorted[if(k + 1 < size(__sorted), k + 1, k)].h) as again)), "
        "w -> w.again), w -> w.i))"
    )
    found = ordered.select("*", twice.alias("__starts")).drop("__sorted")
    # A window covers its words up to the start of the next one at most.
    covered = F.expr(
        f"aggregate(__starts, struct(0L as n, {-WINDOW} as last), (a, s) -> struct("
        f"a.n + least({WINDOW}, s - a.last) as n, s as last), a -> a.n)"
    )
    return found.select(
        *keep, *COUNTS[:4], F.coalesce(covered, F.lit(0)).cast("long").alias(COUNTS[4]), *MORE
    )


def _vote(rule: tuple[str, str, str]) -> Column:
    name, bad, good = rule
    vote = F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
    return F.coalesce(vote, F.lit(0)).cast("tinyint").alias(f"vote_{name}")


@dataclass
class RuleModel:
    """Share of good documents, and of each vote by rule, class and vote."""

    prior: float = 0.85
    rates: dict[tuple[str, int, int], float] = field(default_factory=dict)

    def posterior(self) -> Column:
        """Probability of good, given the votes of a row."""
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, _, _ in RULES:
            vote = F.col(f"vote_{name}")
            weight = {v: math.log(self.rates[name, 1, v] / self.rates[name, 0, v]) for v in (-1, 0, 1)}
            logit = logit + F.when(vote == -1, weight[-1]).when(vote == 1, weight[1]).otherwise(weight[0])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def starting_model() -> RuleModel:
    """Before any data: a good document rarely gets a bad vote, a bad one often does."""
    model = RuleModel()
    for name, _, _ in RULES:
        model.rates |= {(name, 1, -1): 0.02, (name, 1, 0): 0.08, (name, 1, 1): 0.90}
        model.rates |= {(name, 0, -1): 0.40, (name, 0, 0): 0.15, (name, 0, 1): 0.45}
    return model


#: Weight of the starting rates, in documents for each document of the corpus.
ANCHOR = 0.05


def fit_rules(votes: DataFrame, rounds: int = ROUNDS) -> RuleModel:
    """Expectation-maximisation over the patterns of votes and their numbers.

    The starting rates stay in as pseudo-counts, so the two classes keep their meaning
    also where rules never err together. All rounds are one expression over the array of
    patterns, which has three to the number of rules entries at most; a pattern lists its
    cells, of which each rule has three, one for each vote.
    """
    cells = [(name, vote) for name, _, _ in RULES for vote in (-1, 0, 1)]
    start = starting_model()
    first = {kind: [start.rates[name, kind, vote] for name, vote in cells] for kind in (0, 1)}
    own = [F.col(f"vote_{name}").cast("int") + 1 + 3 * k for k, (name, _, _) in enumerate(RULES)]
    patterns = votes.groupBy(F.array(*own).alias("cells")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    numbers = lambda rates: "array(" + ", ".join(f"{rate!r}D" for rate in rates) + ")"
    rate = (
        "transform(start, (r, j) -> (aggregate(filter(x, y -> array_contains(y.cells, j)), 0D, "
        "(s, y) -> s + y.part) + {anchor} * total * r) / (aggregate(x, 0D, (s, y) -> s + y.part) "
        "+ {anchor} * total))"
    ).replace("{anchor}", f"{ANCHOR!r}D")
    weighed = (
        "transform(patterns, y -> struct(y.cells as cells, y.n as n, y.n / (1D + exp(-(ln(m.prior / "
        "(1D - m.prior)) + aggregate(y.cells, 0D, (s, j) -> s + ln(m.good[j] / m.bad[j]))))) as good))"
    )
    good = rate.replace("start", numbers(first[1])).replace("y.part", "y.good")
    bad = rate.replace("start", numbers(first[0])).replace("y.part", "(y.n - y.good)")
    prior = f"(aggregate(x, 0D, (s, y) -> s + y.good) + {ANCHOR * start.prior!r}D * total) / ({1 + ANCHOR!r}D * total)"
    update = f"transform(array({weighed}), x -> struct({prior} as prior, {good} as good, {bad} as bad))[0]"
    begin = f"struct({start.prior!r}D as prior, {numbers(first[1])} as good, {numbers(first[0])} as bad)"
    table = patterns.agg(
        F.sort_array(F.collect_list(F.struct("cells", "n"))).alias("patterns"),
        F.sum("n").alias("total"),
    )
    fitted = table.select(F.expr(f"aggregate(sequence(1, {rounds}), {begin}, (m, t) -> {update})").alias("m"))
    row = fitted.where("total > 0").select("m.*").first()
    if row is None:
        return start
    model = RuleModel(row["prior"])
    for k, (name, vote) in enumerate(cells):
        model.rates |= {(name, 1, vote): row["good"][k], (name, 0, vote): row["bad"][k]}
    return model


def judge_documents(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with counts, votes, ``base_failed``, ``posterior`` and ``kept``."""
    results = {*COUNTS, *MORE, "base_failed", "posterior", "kept"}
    keep = [name for name in keep if name.lower() not in results]
    counted = _document_counts(docs, keep)
    votes = written(counted.select("*", *map(_vote, RULES)), "rules")
    model = fit_rules(votes)
    base = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    judged = votes.select("*", base.alias("base_failed"), model.posterior().alias("posterior"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= MIN_POSTERIOR))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(documents(spark, sf_dir), ["doc_id"])
    votes = [f"vote_{name}" for name, _, _ in RULES]
    order = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # Rounded, as sums in another order differ in their last digits.
    posterior = F.round("posterior", 6).alias("posterior")
    shown = [F.col(vote).cast("int").alias(vote) for vote in votes]
    return judged.select("doc_id", *order, "base_failed", "kept", posterior, *MORE, *shown)


def _oracle() -> str:
    """The same in SQL for DuckDB: windows as rows, the model by recursion over its rounds."""
    cells = [(name, vote) for name, _, _ in RULES for vote in (-1, 0, 1)]
    start = starting_model()
    good, bad = ([start.rates[name, kind, vote] for name, vote in cells] for kind in (1, 0))
    votes = ", ".join(
        f"CASE WHEN {b} THEN -1 WHEN {g} THEN 1 ELSE 0 END AS vote_{name}" for name, b, g in RULES
    )
    own = ", ".join(f"vote_{name} + 2 + 3 * {k}" for k, (name, _, _) in enumerate(RULES))
    weight = "list_sum(list_transform({cells}, lambda j: ln(good[j] / bad[j])))"
    logit = "ln(prior / (1 - prior)) + " + weight
    part = f"p.n / (1 + exp(-({logit.format(cells='p.cells')})))"
    total = "list_sum(list_transform(patterns, lambda p: p.n))"

    def rates(first: list[float], size: str, share: str) -> str:
        sums = (
            "list_sum(list_transform(range(1, len(patterns) + 1), lambda k: "
            f"CASE WHEN list_contains(patterns[k].cells, j) THEN {share} ELSE 0 END))"
        )
        return (
            f"list_transform(range(1, {len(cells) + 1}), lambda j: ({sums} + {ANCHOR} * {total} * {first}[j]) "
            f"/ ({size} + {ANCHOR} * {total}))"
        )

    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), counts AS (
  SELECT doc_id, words, len(words) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS full_lines,
    len(lines) AS n_lines, len(list_distinct(words)) AS n_distinct_words FROM texts
), windows AS (
  SELECT doc_id, unnest(range(1, n_words - {WINDOW - 2})) AS begins,
    unnest(list_transform(range(1, n_words - {WINDOW - 2}),
      lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' '))) AS part
  FROM counts WHERE n_words >= {WINDOW}
), twice AS (
  SELECT doc_id, begins FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, part) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(begins, begins + {WINDOW})) AS place FROM twice) GROUP BY doc_id
), features AS (
  SELECT doc_id, n_words, word_chars, n_symbols,
    len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_distinct_words
  FROM counts LEFT JOIN covered USING (doc_id)
), voted AS (
  SELECT *, {votes} FROM features
), celled AS (
  SELECT *, [{own}] AS cells FROM voted
), grouped AS (
  SELECT list({{'cells': cells, 'n': n}} ORDER BY cells) AS patterns
  FROM (SELECT cells, CAST(count(*) AS DOUBLE) AS n FROM celled GROUP BY cells)
), model AS (
  SELECT 0 AS round, patterns, CAST({start.prior} AS DOUBLE) AS prior,
    CAST({good} AS DOUBLE[]) AS good, CAST({bad} AS DOUBLE[]) AS bad FROM grouped
  UNION ALL
  SELECT round + 1, patterns,
    (list_sum(parts) + {ANCHOR * start.prior} * {total}) / ({1 + ANCHOR} * {total}),
    {rates(good, "list_sum(parts)", "parts[k]")},
    {rates(bad, f"({total} - list_sum(parts))", "(patterns[k].n - parts[k])")}
  FROM (SELECT *, list_transform(patterns, lambda p: {part}) AS parts FROM model WHERE round < {ROUNDS})
), judged AS (
  SELECT celled.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    1 / (1 + exp(-({logit.format(cells="cells")}))) AS posterior
  FROM celled, (SELECT prior, good, bad FROM model WHERE round = {ROUNDS})
)
SELECT doc_id, {", ".join([*COUNTS, *MORE])}, base_failed,
  NOT base_failed AND posterior >= {MIN_POSTERIOR} AS kept, round(posterior, 6) AS posterior,
  {", ".join(f"vote_{name}" for name, _, _ in RULES)}
FROM judged
"""


ORACLE = _oracle()
