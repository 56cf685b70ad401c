"""Quality rules whose cutoffs come from labelled documents with a bounded risk.

Each rule has an integer score; a document goes if a score reaches the rule's cutoff in its
stratum (the language). Cutoffs are tested on labelled documents that pass the fixed base
rules: the hypothesis "this cutoff rejects more than `RISK` of the good documents" is
rejected by the exact binomial tail of the good documents it hits. Cutoffs are tested from
the most lenient on until one fails (a fixed sequence, which needs no correction inside a
rule) and the level is divided by the number of rules times strata, so that with probability
1 - `LEVEL` no rule exceeds its risk in any stratum. Of the cutoffs that passed, the one that
catches most bad documents for the good ones it costs is taken; if none passed, the rule
rejects nothing there. No stratum lends its cutoffs to another: a language with few labels or
none keeps all that pass the base rules, and documents without a language are a stratum of
their own.
"""

from __future__ import annotations

import math
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, small, table, written

#: Most good documents that a rule may reject in a stratum, and the chance that one exceeds it.
RISK = 0.02
LEVEL = 0.05
#: A cutoff's gain: share of bad documents caught less this times the share of good ones hit.
GOOD_COST = 10.0
TOP_SCORE = 1000
MIN_WORDS = 50

SYMBOLS = "#*$%&|<>"
_WORD = re.compile(WORD)
_BLANK = "\t\n\x0b\x0c\r "

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Score of each rule, per mille but for the mean word length, which is in tenths.
RULES = {
    "symbols": "1000 * {0}.n_symbols div {0}.n_words",
    "dup_lines": "1000 * {0}.n_dup_lines div {0}.n_lines",
    "repeat_words": "1000 * {0}.n_repeat_words div {0}.n_words",
    "long_words": "10 * {0}.word_chars div {0}.n_words",
}


def _repeated(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, again = set(), set()
    for window in windows:
        (again if window in seen else seen).add(window)
    covered, reach = 0, 0
    for at, window in enumerate(windows):
        if window in again:
            covered += at + 3 - max(at, reach)
            reach = at + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of `COUNTS`; null and empty have none."""
    if not text:
        return (0,) * len(COUNTS)
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
    )


def text_counts(text: Column) -> Column:
    """A struct of `COUNTS` for each text, measured once however often it is used.

    The optimizer would otherwise move filters before the function, each with a call of
    its own; told that it is not deterministic, it leaves it where it is.
    """

    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def counted(texts: pa.Array) -> pa.Array:
        columns = zip(*map(measure, texts.to_pylist()), strict=True)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)

    return counted.asNondeterministic()(text)


def base_failed(counts: str) -> Column:
    return F.expr(
        f"{counts}.n_words < {MIN_WORDS} OR 100 * {counts}.n_repeat_words > 50 * {counts}.n_words"
    )


def binomial_tail(hits: int, trials: int, share: float) -> float:
    """P(X <= hits) of a binomial variable, summed exactly in its terms."""
    if hits >= trials:
        return 1.0
    log = [
        math.lgamma(trials + 1)
        - math.lgamma(k + 1)
        - math.lgamma(trials - k + 1)
        + k * math.log(share)
        + (trials - k) * math.log1p(-share)
        for k in range(hits + 1)
    ]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def choose_cutoff(
    good: list[int], bad: list[int], level: float, risk: float = RISK, good_cost: float = GOOD_COST
) -> int | None:
    """The cutoff of one rule in one stratum; good[s] and bad[s] count documents of score s."""
    n_good, n_bad = sum(good), sum(bad)
    hit_good = hit_bad = 0
    best, best_gain = None, -math.inf
    if not n_good:
        return None
    for cutoff in range(len(good) - 1, 0, -1):
        hit_good, hit_bad = hit_good + good[cutoff], hit_bad + bad[cutoff]
        if binomial_tail(hit_good, n_good, risk) > level:
            break
        gain = hit_bad / max(1, n_bad) - good_cost * hit_good / n_good
        if gain > best_gain:
            best, best_gain = cutoff, gain
    return best


def calibrate(
    measured: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    level: float = LEVEL,
) -> DataFrame:
    """stratum, one cutoff per rule (null: never), from measured (doc_id, lang, counts).

    The null stratum is that of the labelled documents whose language is null.

    A document labelled twice counts as good only if every label says so; labels without
    quality or without a document, and documents without an id, take no part. Scores are
    counted in Spark; one stratum's counts (rules times scores) go to one task.
    """
    verdicts = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
    )
    scores = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.expr(f"int(least({TOP_SCORE}, {score.format('counts')}))").alias("score"),
            )
            for rule, score in RULES.items()
        ]
    )
    counted = written(
        measured.filter(~base_failed("counts"))
        .join(verdicts, "doc_id")
        .select("lang", "quality", F.explode(scores).alias("s"))
        .groupBy("lang", "s.rule", "s.score")
        .agg(
            F.sum(F.expr("int(quality = 1)")).alias("good"),
            F.sum(F.expr("int(quality <> 1)")).alias("bad"),
        ),
        "quality-scores",
    )
    strata = counted.withColumnRenamed("lang", "stratum")
    # The level is divided among the strata that have labels enough to pass at all; whether
    # they have does not depend on the scores. In the others no cutoff can pass.
    testable = (
        counted.filter(F.col("rule") == next(iter(RULES)))
        .groupBy("lang")
        .agg(F.sum("good").alias("n_good"))
        .filter(F.pow(F.lit(1 - risk), F.col("n_good")) <= level / len(RULES))
        .count()
    )
    tests = len(RULES) * max(1, testable)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        found = {"stratum": rows["stratum"].iloc[0]}
        for rule in RULES:
            good, bad = [0] * (TOP_SCORE + 1), [0] * (TOP_SCORE + 1)
            for row in rows[rows["rule"] == rule].itertuples():
                good[row.score], bad[row.score] = int(row.good), int(row.bad)
            found[rule] = choose_cutoff(good, bad, level / tests, risk)
        return pd.DataFrame([found]).astype({rule: "Int64" for rule in RULES})

    kinds = ", ".join(f"{rule} long" for rule in RULES)
    return written(
        strata.groupBy("stratum").applyInPandas(choose, f"stratum string, {kinds}"),
        "quality-cutoffs",
    )


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The measured rows with base_failed and kept. A null score or cutoff rejects nothing."""
    own = cutoffs.select(F.col("stratum").alias("cutoff_lang"), F.struct(*RULES).alias("cutoffs"))
    joined = measured.join(small(own), F.col("lang").eqNullSafe(F.col("cutoff_lang")), "left")
    failed = base_failed("counts")
    rejected = F.lit(False)
    for rule, score in RULES.items():
        safe = score.replace("div ", "div nullif(", 1) + ", 0)"
        hit = F.expr(f"least({TOP_SCORE}, {safe.format('counts')}) >= cutoffs.{rule}")
        rejected = rejected | F.coalesce(hit, F.lit(False))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~rejected}).drop(
        "cutoff_lang", "cutoffs"
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept.

    Null texts have no words and fail. Texts are measured once, into a written table that
    both the calibration and the verdicts read.
    """
    measured = written(
        docs.select("doc_id", "lang", text_counts(F.col("text")).alias("counts")), "quality"
    )
    judged = judge(measured, calibrate(measured, labels, **options))
    return judged.select("doc_id", "counts.*", "base_failed", "kept").drop("n_lines")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose verdict is kept, with all their columns under any names.

    Verdicts are found in place, so that no text is shuffled and repeated rows stay apart.
    """
    row = docs.select(
        "doc_id", "lang", F.struct("*").alias("row"), text_counts(F.col("text")).alias("counts")
    )
    cutoffs = calibrate(row.select("doc_id", "lang", "counts"), labels, **options)
    return judge(row, cutoffs).filter("kept").select("row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
