"""Toxicity by a linear-chain conditional random field over tokens.

A document label says only that some of its tokens offend. Token labels come from it: a token of a toxic
training document is labelled toxic if its word, or one of its leading parts, occurs in at least
``MIN_DOCS`` toxic training documents and in hardly any other. The field has two states and, per token,
features of the word, its leading parts and its ending (hashed to a fixed number of weights), plus state
transitions; it is trained by gradient ascent on the exact conditional likelihood. Forward-backward
marginals of a document's tokens are summed to two document features, and a logistic regression on these
gives the score.

A chain is a whole document, however long.

Training rows are labelled rows outside the held-out third, at most ``TRAIN_DOCS`` of each class (the
first by hash of the doc_id) and, of these, as many as fit into ``TRAIN_BYTES``: a stated bound on what the
driver fits, in rows and in bytes. Each is taken with its whole text; one whose text alone is longer is passed over.
Cues and the regression come from all of them, the field's weights from ``FIELD_DOCS`` of each class. If one class is missing, every score
is the share of the other's rows (0 without labels). Null and empty texts are scored by the intercept.
Repeated labels of a document count once (toxic if any is), null labels are ignored, repeated rows are
scored each, a null doc_id is not held out, and of several texts with one labelled doc_id the least trains. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import claim, drop_saved, prepare, saved

TRAIN_DOCS = 2000
#: UTF-8 bytes of their texts, for each class.
TRAIN_BYTES = 128 << 20
#: Of these so many of each class fit the field itself, with all their tokens.
FIELD_DOCS = 1000
#: Tokens to a row of the tables that chains are laid out in; a chain takes as many rows as it needs.
ROW = 64
BITS = 20
#: A row of the sample stands for as many labelled rows as its class has for each of its rows, up to this many: a
#: class that is far larger than the sample would otherwise drown the other in the regression.
MOST_WEIGHT = 20.0
MIN_DOCS = 4
#: A cue may occur in this share of the documents of the other class, relative to its share of toxic ones.
MAX_LEAK = 0.05
SPAN = 0.5
THRESHOLD = 0.7
KEPT_TOKENS = 400_000
TOKEN = re.compile(r"\S+")
EDGES = re.compile(r"^\W+|\W+$")


def parts(token: str) -> list[str]:
    """Feature names of a token: the word, its leading parts, its ending."""
    word = EDGES.sub("", token.lower())
    if not word:
        return ["w:"]
    return [f"w:{word}", *(f"p{k}:{word[:k]}" for k in (4, 5, 6) if len(word) >= k), f"s:{word[-3:]}"]


def slots(token: str) -> list[int]:
    mask = (1 << BITS) - 1
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & mask for p in parts(token)]


def _ratio(r: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log odds carried over one transition; t[i, j]: log weight from state i to state j."""
    e, x = np.exp(t - t.max()), np.exp(np.clip(r, -30, 30))
    return np.log((e[0, 1] + e[1, 1] * x) / (e[0, 0] + e[1, 0] * x))


def _carried(emission: np.ndarray, t: np.ndarray, real: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log odds of state 1 at each token, from its chain up to it.

    Rows are stretches of chains, one after another; ``first`` marks those that begin a chain. What a row
    does to the odds that enter it is a fractional linear map: maps of all rows are made at once, then
    applied row after row, so that a chain of any length takes few vector steps and is not cut.
    """
    n, length = emission.shape
    ahead = np.append(first[1:], True)  # whether the next row begins another chain

    def run(rows: np.ndarray, entering: np.ndarray, out: np.ndarray | None) -> np.ndarray:
        r = emission[rows, 0] + np.where(first[rows], 0.0, _ratio(entering, t))
        for k in range(length):
            if k:
                r = emission[rows, k] + np.where(real[rows, k - 1], _ratio(r, t), 0.0)
            if out is not None:
                out[:, k] = r
        return r

    entering, last = np.zeros(n), np.zeros(n)
    heads = np.flatnonzero(first & ~ahead)
    if len(heads):
        last[heads] = run(heads, entering[heads], None)
        inner = np.flatnonzero(~first & ~ahead)  # whole rows between others of their chain
        e = np.exp(t - t.max())
        a, b, c, d = np.zeros(len(inner)), np.ones(len(inner)), np.ones(len(inner)), np.zeros(len(inner))
        for k in range(length):  # the map is x -> (a + b x) / (c + d x)
            w = np.exp(np.clip(emission[inner, k], -30, 30))
            a, b, c, d = w * (e[0, 1] * c + e[1, 1] * a), w * (e[0, 1] * d + e[1, 1] * b), e[0, 0] * c + e[1, 0] * a, e[0, 0] * d + e[1, 0] * b
            top = np.maximum(np.maximum(a, b), np.maximum(c, d))
            a, b, c, d = a / top, b / top, c / top, d / top
        place = np.full(n, -1)
        place[inner] = np.arange(len(inner))
        depth = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
        later = np.flatnonzero(~first)
        later = later[np.argsort(depth[later], kind="stable")]
        for rows in np.split(later, np.flatnonzero(np.diff(depth[later])) + 1):
            entering[rows] = last[rows - 1]
            on = rows[place[rows] >= 0]
            k, x = place[on], np.exp(np.clip(entering[on], -30, 30))
            last[on] = np.log((a[k] + b[k] * x) / (c[k] + d[k] * x))
    out = np.empty((n, length))
    run(np.arange(n), entering, out)
    return out


def marginals(emission: np.ndarray, transition: np.ndarray, real: np.ndarray | None = None, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of state 1 before and after each token, and its marginal.

    Without ``first`` every row is a chain; ``real`` is false at the padding that ends a chain's last row.
    """
    real = np.ones(emission.shape, bool) if real is None else real
    first = np.ones(len(emission), bool) if first is None else first
    forward = _carried(emission, transition, real, first)
    # from behind, the same with the transitions turned round
    last = np.append(first[1:], True)
    behind = _carried(emission[::-1, ::-1], transition.T, real[::-1, ::-1], last[::-1])[::-1, ::-1]
    return forward, behind - emission, 1 / (1 + np.exp(-np.clip(forward + behind - emission, -60, 60)))


def rows_of(lengths: np.ndarray, width: int = ROW) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of consecutive chains go in rows of ``width`` (flat), and which rows begin a chain."""
    rows = -(-lengths // width)
    begin = np.concatenate([[0], np.cumsum(rows)])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) + np.repeat(begin[:-1] * width - starts, lengths)
    first = np.zeros(int(begin[-1]), bool)
    first[begin[:-1][rows > 0]] = True
    return place, first


@dataclass
class Tagger:
    """A trained field: hashed token weights, transitions, and the document regression."""

    weights: np.ndarray
    bias: float
    transition: np.ndarray
    document: np.ndarray
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return (self.weights, self.bias, self.transition, self.document)

    def __setstate__(self, state):
        self.weights, self.bias, self.transition, self.document = state
        self.known = {}

    def emissions(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > KEPT_TOKENS:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, tokens), float, len(tokens))
        except KeyError:
            for token in set(tokens):
                if token not in known:
                    known[token] = self.bias + float(self.weights[slots(token)].sum())
            return np.fromiter(map(known.__getitem__, tokens), float, len(tokens))

    def token_marginals(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        split = [t.split() for t in texts]
        lengths = np.array([len(s) for s in split], np.int64)
        if not lengths.sum():
            return [np.zeros(0)] * len(texts), lengths
        flat = np.concatenate([self.emissions(s) for s in split if s])
        place, first = rows_of(lengths)
        table, real = np.zeros(len(first) * ROW), np.zeros(len(first) * ROW, bool)
        table[place], real[place] = flat, True
        held = marginals(table.reshape(-1, ROW), self.transition, real.reshape(-1, ROW), first)[2].reshape(-1)[place]
        return np.split(held, np.cumsum(lengths)[:-1]), lengths

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.scored(texts)[0]

    def scored(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Score and offending spans of each text."""
        found, _ = self.token_marginals(texts)
        score = 1 / (1 + np.exp(-np.clip(document_features(found) @ self.document, -40, 40)))
        return score, [spans_of(t, m) for t, m in zip(texts, found, strict=True)]


def spans_of(text: str, p: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, probability) in code points of the tokens tagged toxic, neighbours joined."""
    out: list[tuple[int, int, float]] = []
    if not len(p) or p.max() < SPAN:
        return out
    last = -2
    at = 0
    for i, token in enumerate(text.split()):
        at = text.index(token, at)
        if p[i] >= SPAN:
            if last == i - 1:
                out[-1] = (out[-1][0], at + len(token), max(out[-1][2], float(p[i])))
            else:
                out.append((at, at + len(token), float(p[i])))
            last = i
        at += len(token)
    return out


def document_features(found: list[np.ndarray]) -> np.ndarray:
    """Intercept, log of the sum of squared marginals (tokens count as far as they are sure), and the greatest."""
    rows = [(1.0, float(np.log1p(np.square(m).sum())), float(m.max())) if len(m) else (1.0, 0.0, 0.0) for m in found]
    return np.array(rows).reshape(-1, 3)


def cue_slots(documents: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Whether each feature slot marks toxic tokens: it occurs in enough toxic documents, in hardly any
    other, and more one-sidedly than chance explains for any slot of such counts (invented rare words fall
    into toxic documents by luck)."""
    yes, no = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for found, y in zip(documents, toxic, strict=True):
        (yes if y else no)[found] += 1
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    least = min(MIN_DOCS, max(2, n1 // 20))
    clear = (yes >= least) & (no / n0 <= MAX_LEAK * yes / n1)
    # P(all occurrences in toxic documents) of a neutral slot, over all slots that are clear by count
    chance = (yes + no) * np.log(max(float(toxic.mean()), 1e-9))
    return clear & (chance < np.log(1e-3 / max(1, int(clear.sum()))) * np.where(no > 0, 1.5, 1.0))


def train(texts: list[str], toxic: np.ndarray, weight: np.ndarray | None = None, rounds: int = 80, rate: float = 0.5, l2: float = 1e-4) -> Tagger:
    """Fit the field on token labels from document labels, then the document regression."""
    toxic = np.asarray(toxic, bool)
    weight = np.ones(len(texts)) if weight is None else np.asarray(weight, float)
    vocabulary: dict[str, int] = {}
    split = [np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in text.split()), np.int32) for text in texts]
    lengths = np.array([len(x) for x in split], np.int64)
    ids = np.concatenate([*split, np.zeros(0, np.int32)]).astype(np.int64)
    # slots of each word, in a row: those of word w are flat[bounds[w] : bounds[w + 1]]; endings are no cues
    flat_list, counts, leading = [], [], []
    for w in vocabulary:
        x = slots(w)
        flat_list += x
        leading += [True] * (len(x) - 1) + [False]
        counts.append(len(x))
    flat, leading = np.array(flat_list, np.int64), np.array(leading, bool)
    del flat_list
    owner = np.repeat(np.arange(len(counts)), counts)
    bounds = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])

    def found(word_ids: np.ndarray) -> np.ndarray:
        at = np.unique(word_ids)
        rows = np.concatenate([np.arange(bounds[w], bounds[w + 1]) for w in at]) if len(at) else np.zeros(0, np.int64)
        return np.unique(flat[rows][leading[rows]])

    # copies of a toxic document repeat all its rare words: a toxic occurrence counts once per context
    size = len(counts) + 1
    context = (np.concatenate([[0], ids[:-1] + 1]) * size + ids + 1) * size + np.concatenate([ids[1:] + 1, [0]]) if len(ids) else ids
    fresh = np.zeros(len(ids), bool)
    fresh[np.unique(context, return_index=True)[1]] = True
    ends = np.cumsum(lengths)
    cues = cue_slots([found(x[fresh[b - len(x) : b]] if y else x) for x, b, y in zip(split, ends.tolist(), toxic, strict=True)], toxic)
    del context, fresh
    cues[slots("")[0]] = False
    cue = np.bincount(owner, (cues[flat] & leading).astype(float), len(counts)) > 0
    marks = np.repeat(toxic, lengths)
    del split
    label = marks & cue[ids] if len(ids) else np.zeros(0, bool)
    fits = np.zeros(len(toxic), bool)
    for y in (True, False):
        fits[np.flatnonzero(toxic == y)[:FIELD_DOCS]] = True
    inside = np.repeat(fits, lengths)
    ids, label, lengths = ids[inside], label[inside], lengths[fits]
    place, first = rows_of(lengths)
    table, truth = np.full(len(first) * ROW, -1), np.zeros(len(first) * ROW, bool)
    table[place], truth[place] = ids, label
    table, truth = table.reshape(-1, ROW), truth.reshape(-1, ROW)
    real = table >= 0
    at = np.where(real, table, 0)
    # neighbours within a row, and from a row's end to the next row of its chain
    on = np.flatnonzero(~first)
    left, right = (lambda x: np.concatenate([x[:, :-1].ravel(), x[on - 1, -1]])), (lambda x: np.concatenate([x[:, 1:].ravel(), x[on, 0]]))
    both = left(real) & right(real)
    seen = np.array([(both & (left(truth) == i) & (right(truth) == j)).sum() for i in (0, 1) for j in (0, 1)])
    weights, transition, bias = np.zeros(1 << BITS), np.zeros((2, 2)), -3.0
    g2, t2, b2 = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6), 1e-6
    scale = 1.0 / max(1, int(truth.sum()))
    for _ in range(rounds):
        emit = bias + np.bincount(owner, weights[flat], len(counts))
        emission = np.where(real, emit[at], 0.0)
        forward, backward, p = marginals(emission, transition, real, first)
        miss = np.where(real, truth - p, 0.0)
        by_word = np.bincount(at.ravel(), miss.ravel(), len(counts))
        g = np.bincount(flat, by_word[owner], 1 << BITS) * scale - l2 * weights
        # expected transitions from pair marginals
        before, ahead = left(forward)[both], right(backward + emission)[both]
        pair = np.stack([transition[i, j] + i * before + j * ahead for i in (0, 1) for j in (0, 1)])
        pair = np.exp(pair - pair.max(0))
        pair /= pair.sum(0)
        gt = (seen - pair.sum(1)).reshape(2, 2) * scale - l2 * transition
        gb = float(miss.sum()) * scale
        g2 += g * g
        t2 += gt * gt
        b2 += gb * gb
        weights += rate * g / np.sqrt(g2)
        transition += 0.2 * rate * gt / np.sqrt(t2)
        transition -= transition[0, 0]
        bias += rate * gb / np.sqrt(b2)
    tagger = Tagger(weights.astype(np.float32), float(bias), transition, np.zeros(3))
    x = np.concatenate([document_features(tagger.token_marginals(texts[a : a + 500])[0]) for a in range(0, len(texts), 500)])
    beta = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + 0.1 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (weight * (toxic - p)) - 0.1 * beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    tagger.document = beta
    return tagger


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, most_bytes: int = TRAIN_BYTES) -> Tagger:
    """Train on at most ``most`` labelled documents of each class outside the held-out third, of ``most_bytes`` at most."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    ways = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    chosen = ways[0].unionByName(ways[1])  # 2 * most rows at most
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # of several texts with one doc_id the least
    sample = saved(texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic")), "toxic-sample")
    size = F.octet_length("text")
    so_far = F.sum(size).over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))  # a window of ``most`` rows
    fits = sample.where(size <= most_bytes).select("doc_id", so_far.alias("__bytes")).where(F.col("__bytes") <= most_bytes).select("doc_id")
    rows = sample.join(F.broadcast(fits), "doc_id").orderBy("doc_id").collect()
    drop_saved(sample)
    toxic, known_texts = np.array([r["toxic"] == 1 for r in rows], bool), [r["text"] or "" for r in rows]
    if not len(rows) or toxic.all() or not toxic.any():
        odds = -40.0 if not len(rows) or not toxic.any() else 40.0
        return Tagger(np.zeros(1 << BITS), -20.0, np.zeros((2, 2)), np.array([odds, 0.0, 0.0]))
    share = np.array([totals.get(0, 0) / max(1, int((~toxic).sum())), totals.get(1, 0) / max(1, int(toxic.sum()))])
    weight = np.minimum(share[toxic.astype(int)], MOST_WEIGHT)
    del rows
    return train(known_texts, toxic, weight)


def tagged(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, score and spans (start and end in code points, probability) of every document."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(tagger)

    def tag(texts: pd.Series) -> pd.DataFrame:
        held = shared.value
        claim("toxicity", held.known.clear)
        score, spans = held.scored(["" if t is None else t for t in texts])
        return pd.DataFrame({"score": score, "spans": [[dict(zip(("start", "end", "probability"), x, strict=True)) for x in s] for s in spans]})

    kind = "score double, spans array<struct<start:int,end:int,probability:double>>"
    # nondeterministic: no plan may evaluate it twice
    found = docs.select("doc_id", pandas_udf(tag, kind).asNondeterministic()(F.col("text").cast("string")).alias("__t"))
    return found.select("doc_id", "__t.score", "__t.spans")


def score_documents(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, held_out, score, predicted and offsets (of the offending spans, "start-end ...") of every document."""
    offsets = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), " ")
    out = tagged(docs, tagger).withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= THRESHOLD).cast("int"), "offsets": offsets})
    return out.select("doc_id", "held_out", "score", "predicted", "offsets")


def toxic_spans(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id and spans (start, end in code points, probability) of every document with a toxic span."""
    return tagged(docs, tagger).where(F.size("spans") > 0).select("doc_id", "spans")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
