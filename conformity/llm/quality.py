"""Quality rules with risk-controlled cutoffs.

Beside the base rules, a document has a risk: the worst rule's log odds of being bad, in levels. Every rule is
a ratio that grows with junk; its odds come from a fifth of the labelled documents (``FIT_PART``). The other
labelled documents are the holdout on which cutoffs are certified, for each stratum (``lang``; null is a
stratum of its own): levels are added to what is rejected from the highest down, and each choice counts as
safe if the exact binomial probability of seeing so few rejected good documents, were the true share
``alpha``, is at most ``delta / strata``. Documents that the base rules reject count as rejected. The tests of
one sequence stop at the first choice that is not safe (fixed-sequence testing) and the Bonferroni division
covers the strata with enough labels to certify anything; so, with probability 1 - delta, no cutoff is in use
in a stratum where it and the base rules together reject more than ``alpha`` of the good documents. Of the
certified choices the one is taken that rejects most bad holdout documents less good ones. A stratum without a
certified choice rejects only what the base rules reject, whatever share of its good documents that is.

Null and empty texts have no words: they fail the base rules. Labels that repeat for a document count once,
as bad if any of them is; labels without a document and null labels are ignored. Rows that repeat a labelled
doc_id count once in learning (the least by metrics) and are judged each. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import BROADCAST_ROWS, claim, drop_saved, prepare, saved, small

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LINE_SPACES = " \t\x0b\x0c\r"
UPPER = re.compile("[A-ZÀ-ÖØ-Þ]+")
#: Share of a stratum's good documents that may be rejected, and the chance that a cutoff in use exceeds it.
ALPHA, DELTA = 0.05, 0.05
#: One in so many labelled documents, by checksum of the doc_id, gives the odds; the others certify.
FIT_PART = 5
#: Cells of a rule's ratio, and levels of risk above none.
CELLS, LEVELS = 101, 48
METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_exclaim long"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside word windows that occur twice or more in the text."""
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    key, base = ids, len(known)
    for k in range(1, window):
        if base > (1 << 62) // max(len(known), 1):
            _, key = np.unique(key, return_inverse=True)
            base = len(key) + 1
        key = key[: len(words) - k] * len(known) + ids[k:]
        base *= len(known)
    _, at, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[at] >= 2
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def text_metrics(text: str | None) -> tuple[int, ...]:
    """The counts the rules use, of one whole text."""
    if not text:
        return (0,) * 8
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(LINE_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(len, UPPER.findall(text))),
        text.count("!"),
    )


def _measure(texts: pd.Series) -> pd.DataFrame:
    claim("quality")
    return pd.DataFrame([text_metrics(t) for t in texts], columns=[c.split()[0] for c in METRICS.split(", ")], dtype="int64")


def metrics_of(text: Column) -> Column:
    """The metrics as a struct. Marked nondeterministic so that no plan evaluates them twice: each further
    Python step of a stage is a further worker for each of an executor's cores."""
    return pandas_udf(_measure, METRICS).asNondeterministic()(text)


def rules() -> dict[str, Column]:
    """Name and ratio of each rule; larger is worse."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "duplicate_line_share": F.col("n_dup_lines") / lines,
        "upper_share": F.col("n_upper") / chars,
        "exclaims_per_word": F.col("n_exclaim") / words,
        "repeat_share": F.col("n_repeat_words") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(X <= x) of a binomial with n trials, summed exactly from its terms."""
    if x >= n:
        return 1.0
    term = lambda k: math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    return min(1.0, math.fsum(term(k) for k in range(x + 1)))


def least_labels(alpha: float, delta: float) -> int:
    """Labelled good documents with which a cutoff that rejects none of them is certified."""
    return math.ceil(math.log(delta) / math.log1p(-alpha))


def tested_strata(sizes: dict[str, int], alpha: float, delta: float) -> list[str]:
    """The strata with enough labels to certify anything when ``delta`` is divided among them all."""
    order = sorted(sizes, key=lambda s: (-sizes[s], s))
    for k in range(len(order), 0, -1):
        if sizes[order[k - 1]] >= least_labels(alpha, delta / k):
            return order[:k]
    return []


def certified_levels(base: int, good: list[int], alpha: float, delta: float) -> int:
    """How many risk levels, from the highest down, may be rejected beside ``base`` of the good documents.

    ``good[i]``: good documents at the i-th highest level. The tests of the sequence stop at the first that
    fails, so none needs a correction for the others.
    """
    n, x = base + sum(good), base
    if not n or binomial_cdf(x, n, alpha) > delta:
        return 0
    for k, more in enumerate(good[:LEVELS]):  # the last level, no risk at all, is never rejected
        x += more
        if binomial_cdf(x, n, alpha) > delta:
            return k
    return LEVELS


def choose_levels(base: int, good: list[int], bad: list[int], alpha: float, delta: float) -> int:
    """Of the certified choices the one that rejects most bad documents less good ones; the most lenient of equals."""
    gain, best, levels = 0, 0, 0
    for k in range(certified_levels(base, good, alpha, delta)):
        gain += bad[k] - good[k]
        if gain > best:
            best, levels = gain, k + 1
    return levels


def risk_weights(counts: dict[tuple[str, int, int], int]) -> dict[str, list[float]]:
    """For each rule and cell the log odds that a document with so large a value is bad, never falling as the
    value grows, 0 at least. ``counts``: fitting documents by (rule, cell, quality)."""
    out = {}
    for rule in sorted({r for r, _, _ in counts}):
        tail = {y: np.cumsum([counts.get((rule, c, y), 0) for c in range(CELLS, -1, -1)])[::-1] for y in (0, 1)}
        ratio = np.log((tail[0] + 0.5) / (tail[0][0] + 1)) - np.log((tail[1] + 0.5) / (tail[1][0] + 1))
        ratio[0] = 0
        out[rule] = np.maximum.accumulate(np.maximum(ratio, 0)).round(6).tolist()
    return out


@dataclass(frozen=True)
class Cutoffs:
    """Risk weights by rule and cell, and per certified stratum how many of the highest levels are rejected."""

    weights: dict[str, list[float]]
    levels: dict[str, int]

    def level(self) -> Column:
        """0 for the highest risk, ``LEVELS`` for none: the worst rule's log odds in steps of 0.25."""
        if not self.weights:
            return F.lit(LEVELS)
        risks = [F.element_at(F.array(*map(F.lit, w)), cell(rules()[k]) + 1) for k, w in self.weights.items()]
        risk = F.greatest(*risks, F.lit(0.0))
        return (LEVELS - F.least(F.lit(LEVELS), F.floor(risk * 4 + 1e-6))).cast("int")

    def rejects(self) -> Column:
        """Whether a measured row is rejected beside the base rules."""
        verdict = F.lit(False)
        for stratum, k in sorted(self.levels.items()):
            verdict = verdict | ((F.col("stratum") == stratum) & (self.level() < k))
        return verdict


def cell(value: Column) -> Column:
    """Cell 0 for a ratio of 0, then steps of 0.02, the last for all that is larger."""
    return F.least(F.lit(CELLS), F.ceil(value / 0.02 - 1e-9)).cast("int")


def stratum_of(docs: DataFrame, lang: str) -> Column:
    return F.coalesce(F.col(lang).cast("string"), F.lit("\0null")) if "lang" in docs.columns else F.lit("\0null")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the stratum, and the metrics of every document; texts are left behind."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    held = docs.select(doc_id, stratum_of(docs, "lang").alias("stratum"), metrics_of(F.col("text").cast("string")).alias("__m"))
    return held.select("doc_id", "stratum", "__m.*")


def quality_of(labels: DataFrame) -> DataFrame:
    """doc_id and quality (0 if any label of the document is bad)."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") > 0).cast("int").alias("quality"))


def learn_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> Cutoffs:
    """Cutoffs from labelled documents (doc_id, stratum, metrics, quality; repeated doc_ids count once).

    Spark counts documents by rule and cell, then by stratum and level; the driver gets those counts, as
    many for any number of documents.
    """
    columns = [c for c in labelled.columns if c != "doc_id"]
    once = saved(labelled.groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("m")).select("doc_id", "m.*"), "quality-labelled")
    fits = F.crc32(F.col("doc_id").cast("string")) % FIT_PART == 0
    pairs = F.array(*[F.struct(F.lit(k).alias("rule"), cell(v).alias("cell")) for k, v in rules().items()])
    fitted = once.where(fits & ~base_failed()).select("quality", F.explode(pairs).alias("r")).groupBy("r.rule", "r.cell", "quality").count().collect()
    weights = risk_weights({(r["rule"], r["cell"], r["quality"]): r["count"] for r in fitted})
    level = F.when(base_failed(), -1).otherwise(Cutoffs(weights, {}).level()).alias("level")
    holdout = once.where(~fits)
    enough = holdout.where("quality = 1").groupBy("stratum").count().where(F.col("count") >= least_labels(alpha, delta)).select("stratum")
    counted = holdout.join(small(enough), "stratum").groupBy("stratum", level, "quality").count().collect()
    drop_saved(once)
    table: dict[str, dict[int, list[int]]] = defaultdict(lambda: {y: [0] * (LEVELS + 2) for y in (0, 1)})
    for r in counted:
        table[r["stratum"]][r["quality"]][r["level"] + 1] += r["count"]
    strata = tested_strata({s: sum(by[1]) for s, by in table.items()}, alpha, delta)
    levels = {s: choose_levels(table[s][1][0], table[s][1][1:], table[s][0][1:], alpha, delta / len(strata)) for s in strata}
    return Cutoffs(weights, {s: k for s, k in levels.items() if k})


def quality_verdicts(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, the metrics, base_failed and kept of every document."""
    prepare(docs.sparkSession)
    metrics = saved(measured(docs), "quality-metrics")
    cutoffs = learn_cutoffs(metrics.join(small(quality_of(labels)), "doc_id"), alpha, delta)
    return metrics.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~cutoffs.rejects())


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns. If the labels are few enough to be
    with every task, only labelled documents are measured to learn the cutoffs."""
    prepare(docs.sparkSession)
    known = quality_of(labels)
    n = known.count()
    if n <= BROADCAST_ROWS:
        ids = F.broadcast(known.select(F.col("doc_id").alias("__id")))
        labelled = measured(docs.join(ids, docs["doc_id"].cast("long") == ids["__id"], "left_semi"))
    else:  # labels that are too many for every task meet the metrics: texts are never shuffled
        labelled = measured(docs)
    cutoffs = learn_cutoffs(labelled.join(small(known, n), "doc_id"), alpha, delta)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), metrics_of(F.col("text").cast("string")).alias("__m"))
    whole = whole.select("__row", stratum_of(docs, "__row.lang").alias("stratum"), "__m.*")
    return whole.where(~base_failed() & ~cutoffs.rejects()).select("__row.*")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
