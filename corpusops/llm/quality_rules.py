"""Quality rules whose cutoffs are chosen under a bound on falsely rejected good documents.

Everything here is DataFrame expressions. Each rule compares a ratio of two counts of a text with a
cutoff in thousandths. The rules are one decision: step ``i`` uses cutoff ``i`` of every rule and rejects
what breaks any of them. The good documents of a labelled holdout that a step would reject are counted,
and the hypothesis "it rejects more than ``risk`` of the good documents" is tested with the exact
binomial tail. Steps are tested in a fixed order, from loose to strict, up to the first that is not
certified, so each needs no correction for the others and has the level ``error / strata``. So with probability ``1 - error`` no
stratum loses more than ``risk`` of its good documents. A stratum without a certified step rejects nothing: without a false rejection it takes
``ln(error / strata) / ln(1 - risk)`` good labelled documents to certify one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import SPACES, UPPER, let, text_or_empty, words

#: fixed values: characters that count as symbols, and the base limits
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: rule -> (numerator, denominator, cutoffs in thousandths)
RULES = {
    "symbols": ("n_symbols", "n_words", [5, 10, 20, 50, 100, 150, 200, 300, 500, 800]),
    "repeats": ("n_repeat_words", "n_words", [20, 50, 100, 150, 200, 250, 300, 350, 400, 450]),
    "duplicate_lines": ("n_dup_lines", "n_lines", [20, 50, 100, 150, 200, 300, 400, 500, 700, 900]),
    "capitals": ("n_capitals", "word_chars", [20, 50, 100, 150, 200, 300, 400, 500, 600, 800]),
    "long_words": ("word_chars", "n_words", [6000, 7000, 8000, 9000, 10000, 12000, 15000, 20000, 30000, 50000]),
}
STEPS = min(len(cutoffs) for _, _, cutoffs in RULES.values())
#: strata above this number are joined instead of broadcast (about 100 bytes each)
BROADCAST_STRATA = 10_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def repeated_words(tokens: Column) -> Column:
    """How many words stand in 3-word windows that occur at least twice.

    Windows are sorted by hash with their position; equal neighbours are repeats, and the union of
    their spans is summed from left to right. Linear memory and n log n time for a text of n words.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(tokens) - 3), lambda i: F.struct(
        F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("h"), i.alias("p")))

    def spans(found: Column) -> Column:
        def same(i: Column, x: Column) -> Column:
            return F.coalesce(F.get(found, i)["h"] == x["h"], F.lit(False))

        at = F.sort_array(F.transform(F.filter(found, lambda x, i: same(i - 1, x) | same(i + 1, x)), lambda x: x["p"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")))["n"]

    return F.when(F.size(tokens) < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows), spans))


def counts_of(text: Column) -> Column:
    """Struct of COUNTS for one whole text; all zero for null and for texts without a word."""
    text = text_or_empty(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    chars = F.translate(text, SPACES, "")
    return let(F.struct(words(text).alias("w"), lines.alias("lines"), chars.alias("chars")), lambda x: F.struct(
        F.size(x["w"]).cast("long").alias("n_words"),
        F.length(x["chars"]).cast("long").alias("word_chars"),
        (F.length(x["chars"]) - F.length(F.translate(x["chars"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
        repeated_words(x["w"]).alias("n_repeat_words"),
        F.size(x["lines"]).cast("long").alias("n_lines"),
        (F.length(x["chars"]) - F.length(F.translate(x["chars"], UPPER, ""))).cast("long").alias("n_capitals")))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed in logarithms; 1 where k >= n * p.

    The ratio of neighbouring terms gives each from the one before, so no factorial is needed.
    """
    odds = F.log(F.lit(p / (1 - p)))
    first = n * F.log(F.lit(1 - p))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        return let(term, lambda t: F.struct(t.alias("term"), (F.greatest(acc["total"], t) + F.log1p(
            F.exp(F.least(acc["total"], t) - F.greatest(acc["total"], t)))).alias("total")))

    start = F.struct(first.alias("term"), first.alias("total"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.expr("array()").cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(F.aggregate(steps, start, add)["total"]))


def _exceeded(numerator: str, denominator: str, cutoffs: list[int]) -> Column:
    a, b = F.col("counts")[numerator], F.col("counts")[denominator]
    return F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cutoffs]), lambda c: 1000 * a > c * b))


def _cutoffs_at(step: Column) -> Column:
    """Map of rule to its cutoff at a step."""
    return F.create_map(*[x for rule, (_, _, cutoffs) in RULES.items() for x in (
        F.lit(rule), F.get(F.array(*[F.lit(c).cast("long") for c in cutoffs]), step))])


def certified_steps(good: DataFrame, strata: int, risk: float, error: float) -> DataFrame:
    """stratum, n (good documents), step: the strictest certified one, null if there is none.

    A stricter step rejects all that a looser one does, so the tail only grows along the sequence, and the strictest step
    at the level is where the tests from loose to strict end.
    """
    over = F.greatest(*[_exceeded(a, b, cutoffs[:STEPS]) for a, b, cutoffs in RULES.values()])
    seen = good.select("stratum", over.alias("over")).groupBy("stratum", "over").agg(F.count(F.lit(1)).alias("docs"))
    tests = (seen.select("*", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("step")).groupBy("stratum", "step")
             .agg(F.sum(F.when(F.col("over") > F.col("step"), F.col("docs")).otherwise(0)).alias("k"), F.sum("docs").alias("n")))
    certified = binomial_tail(F.col("k"), F.col("n"), risk) <= error / max(strata, 1)
    passed = tests.select("stratum", "n", F.when(certified, F.col("step")).alias("step"))
    return passed.groupBy("stratum").agg(F.max("n").alias("n"), F.min("step").alias("step"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text", doc_id: str = "doc_id",
          risk: float = 0.01, error: float = 0.05, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed``, ``kept``, ``broken_rules``.

    Columns named in ``carry`` come along in a struct ``carried``.

    A document is good if all its rows in ``labels`` (doc_id, quality) say 1; those without a label
    or with a null one take no part in the tests. Null texts have no words and fail the base limits;
    a null stratum is a stratum of its own; repeated rows are judged alike; without labels only the
    base limits reject. The counts are written once and read for the tests and for the verdict.
    """
    carry = carry or []
    carried = [F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []
    rows = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"),
                             counts_of(F.col(text)).alias("counts"), *carried), "quality-counts")
    good = (labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
            .agg(F.min("quality").alias("q")).where("q = 1").select("label_id"))
    held = rows.where(~base_failed(F.col("counts"))).select("doc_id", "stratum", "counts").join(
        good, F.col("doc_id") == F.col("label_id"), "left_semi").select("stratum", "counts")
    strata = held.select(F.coalesce("stratum", F.lit("")), F.col("stratum").isNull()).distinct().count()
    steps = stage(certified_steps(held, strata, risk, error), "quality-steps")
    cutoffs = steps.where("step IS NOT NULL").select(F.col("stratum").alias("of"), _cutoffs_at(F.col("step")).alias("cutoffs"))
    if strata <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    c = F.col("counts")
    broken = F.filter(F.array(*[F.when(1000 * c[a] > F.element_at("cutoffs", rule) * c[b], F.lit(rule))
                                for rule, (a, b, _) in RULES.items()]), lambda x: x.isNotNull())
    judged = rows.join(cutoffs, F.col("stratum").eqNullSafe(F.col("of")), "left")
    return (judged
            .withColumn("broken_rules", F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(broken))
            .withColumn("failed", base_failed(c))
            .select("doc_id", *(["carried"] if carry else []), "stratum", *[c[x].alias(x) for x in COUNTS],
                    F.col("failed").alias("base_failed"),
                    (~F.col("failed") & (F.size("broken_rules") == 0)).alias("kept"), "broken_rules"))
