"""Operator 1: a weak-label quality classifier.

Overlapping heuristic labellers vote on each document, for two questions: is it
junk, is it toxic. For each question expectation-maximisation over the counts of
vote patterns estimates how often each labeller is right on either class, without
any given label, and turns every pattern into a posterior. The posteriors of a
bounded sample of documents then train a linear scorer over hashed features,
which decides for all documents. The toxicity labellers look words up in a
lexicon: a few fixed ones, and those that a bounded sample of labelled documents
shows to mark toxic texts, in whatever language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_steps
from .words import GAP, LOWER, hash_runs, join, segments, words

#: Insults that are in every lexicon.
INSULTS = "idiot pathetic scum worthless dumb imbecile bastard moron disgusting trash loathsome jerk freak vermin stupid loser clown fool crap creep".split()
#: Features: hashed words below this, then one for each level of each measure.
BUCKETS = 1 << 18
LEVELS = 12
MEASURES = ("symbols", "capitals", "bars", "marks", "echoes", "variety", "long_words", "digits", "length", "insults", "slurs")
JUNK_LABELLERS = ("symbols", "capitals", "bars", "marks", "echoes", "long_words", "variety")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"%$#&*|!<>{}[]=+\\^~@_")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!%$#&*?")] = True


def hash_word(text: str) -> int:
    buf = np.frombuffer(text.encode(), np.uint8)
    return int(hash_runs(buf, np.array([0]), np.array([len(buf)]))[0])


@dataclass(frozen=True)
class Lexicon:
    """Sorted hashes of words that mark toxic texts: the fixed ones, those learnt
    that surely do, and those that likely do. No word is in two of them."""

    fixed: np.ndarray
    sure: np.ndarray
    likely: np.ndarray


def fixed_lexicon() -> Lexicon:
    none = np.zeros(0, np.uint64)
    return Lexicon(np.sort(np.array([hash_word(w) for w in INSULTS], np.uint64)), none, none)


def _is_in(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


@dataclass
class Measured:
    """Measures of some texts, and their distinct words' hashes."""

    values: dict[str, np.ndarray]
    groups: np.ndarray
    word_hash: np.ndarray
    of: np.ndarray


TOXIC_LABELLERS = 5


def measure(texts: list[bytes], lexicon: Lexicon) -> Measured:
    """All measures of whole texts. An empty text has zeros."""
    buf, at = join(texts)
    low = LOWER[buf]
    # a word's letters without the signs around it, for lookups
    letter = _LETTER[low]
    starts, ends = words(low, GAP[low])
    n_docs = len(texts)
    doc = np.searchsorted(at, starts, "right") - 1
    count = np.bincount(doc, minlength=n_docs).astype(float)
    size = np.maximum(np.diff(at) - 1, 0).astype(float)
    some = np.maximum(count, 1)

    def share(flag: np.ndarray, base: np.ndarray) -> np.ndarray:
        upto = segments(flag)
        return (upto[at[1:]] - upto[at[:-1]]) / np.maximum(base, 1)

    def of_words(flag: np.ndarray) -> np.ndarray:
        return np.bincount(doc[flag], minlength=n_docs) / some

    letters = np.diff(segments(letter)[at])
    inner, outer = words(low, ~letter)
    h = hash_runs(low, inner, outer)
    of = np.searchsorted(at, inner, "right") - 1
    insult, sure, likely = (_is_in(h, x) for x in (lexicon.fixed, lexicon.sure, lexicon.likely))
    # different words only: one that is said again is one hit
    single = np.unique(of[likely].astype(np.uint64) << np.uint64(40) | h[likely] >> np.uint64(24)) >> np.uint64(40)
    several = np.bincount(single.astype(np.int64), minlength=n_docs)
    hits = np.stack([np.bincount(of[x], minlength=n_docs) for x in (insult, sure)])
    place = np.flatnonzero(insult | sure | likely)
    near = (np.diff(place) <= 12) & (np.diff(of[place]) == 0) & (h[place[1:]] != h[place[:-1]])
    close = np.bincount(of[place[1:]][near], minlength=n_docs)
    thick = np.bincount(of[place], minlength=n_docs) >= 0.02 * some
    groups = np.stack((hits[0] > 0, hits[1] > 0, several > 1, close > 0, thick & (count > 0)))
    # how many words came before among the thirty words before them
    whole = hash_runs(low, starts, ends)
    order = np.lexsort((whole, doc))
    again = np.zeros(len(whole), bool)
    if len(whole) > 1:
        a, b = order[:-1], order[1:]
        again[b] = (whole[a] == whole[b]) & (doc[a] == doc[b]) & (b - a <= 30)
    new = np.ones(len(whole), bool)
    if len(whole) > 1:
        new[order[1:]] = (whole[order[1:]] != whole[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    length = ends - starts
    values = {
        "symbols": share(_SYMBOL[low], size),
        "capitals": share((buf >= 65) & (buf <= 90), letters),
        "bars": of_words((length == 1) & (low[starts] == 124)),
        "marks": of_words((length > 1) & _MARK[low[ends - 1]] & _MARK[low[np.maximum(ends - 2, 0)]]),
        "echoes": of_words(again),
        "variety": 1 - np.where(count >= 40, of_words(new) / np.minimum(1, 40 / np.sqrt(some)), 1.0).clip(0, 1),
        "long_words": of_words(length >= 5),
        "digits": share((low >= 48) & (low <= 57), size),
        "length": np.log2(count + 1) / 16,
        "insults": np.minimum(hits.sum(0) / 8, 1),
        "slurs": np.minimum(several / 8, 1),
    }
    first = np.unique(of.astype(np.uint64) << np.uint64(40) | h % np.uint64(BUCKETS)) if len(h) else np.zeros(0, np.uint64)
    owner = (first >> np.uint64(40)).astype(np.int64)
    return Measured(values, groups, (first & np.uint64(BUCKETS - 1)).astype(np.int64), np.searchsorted(owner, np.arange(n_docs + 1)))


#: Measure above which a labeller says junk.
LIMITS = {"symbols": 0.05, "capitals": 0.35, "bars": 0.08, "marks": 0.15, "echoes": 0.5, "long_words": 0.85, "variety": 0.8}


def patterns(m: Measured) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns as bits: of the junk labellers and of the toxicity labellers (a
    fixed insult; a word learnt as sure; several different likely words; two
    different words of any of these close together; one word in fifty is one)."""
    junk = sum((m.values[k] > LIMITS[k]).astype(np.int64) << i for i, k in enumerate(JUNK_LABELLERS))
    toxic = sum(g.astype(np.int64) << i for i, g in enumerate(m.groups))
    return junk, toxic


def features(m: Measured) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features: index, value, and where each text's begin."""
    n = len(m.of) - 1
    size = np.diff(m.of)
    words_value = np.repeat(1 / np.sqrt(np.maximum(size, 1)), size)
    level = np.stack([BUCKETS + i * LEVELS + np.minimum((m.values[k] * LEVELS).astype(np.int64), LEVELS - 1) for i, k in enumerate(MEASURES)], 1)
    some = np.stack([np.where(m.values[k] > 0, BUCKETS + len(MEASURES) * LEVELS + i, -1) for i, k in enumerate(MEASURES)], 1)
    fixed = np.concatenate((level, np.where(some < 0, BUCKETS + len(MEASURES) * (LEVELS + 1), some)), 1)
    rows = np.concatenate((np.repeat(np.arange(n), size), np.repeat(np.arange(n), fixed.shape[1])))
    order = np.argsort(rows, kind="stable")
    index = np.concatenate((m.word_hash, fixed.ravel()))[order]
    value = np.concatenate((words_value, np.ones(fixed.size)))[order]
    return index, value, segments(size + fixed.shape[1])


N_FEATURES = BUCKETS + len(MEASURES) * (LEVELS + 1) + 1


def expectation_maximisation(counts: dict[int, int], labellers: int, rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """Posterior of the positive class for each vote pattern, the labellers' hit
    rates on either class (2 x labellers), and the positive share.

    Labellers are taken to be independent given the class. The start says that a
    vote is right nine times in ten.
    """
    keys = sorted(counts)
    votes = np.array([[k >> j & 1 for j in range(labellers)] for k in keys], float)
    weight = np.array([counts[k] for k in keys], float)
    post = 1 - 0.1 ** votes.sum(1)
    rate, prior = np.zeros((2, labellers)), 0.0
    for _ in range(rounds):
        mass = np.stack(((1 - post) * weight, post * weight))
        prior = mass[1].sum() / weight.sum()
        rate = (mass @ votes + 0.01) / (mass.sum(1, keepdims=True) + 1)
        rate[0] = np.minimum(rate[0], 0.5)
        told = votes @ np.log(rate).T + (1 - votes) @ np.log1p(-rate.clip(max=1 - 1e-9)).T + np.log([max(1 - prior, 1e-9), max(prior, 1e-9)])
        post = 1 / (1 + np.exp((told[:, 0] - told[:, 1]).clip(-50, 50)))
    return dict(zip(keys, post.tolist(), strict=True)), rate, float(prior)


def train(index: np.ndarray, value: np.ndarray, of: np.ndarray, target: np.ndarray, epochs: int = 120, rate: float = 0.3, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels by full-batch adaptive gradients;
    the last weight is the bias."""
    w, seen = np.zeros(N_FEATURES + 1), np.full(N_FEATURES + 1, 1e-8)
    row = np.repeat(np.arange(len(target)), np.diff(of))
    # both classes count alike, whatever their shares
    up = target.mean() if len(target) else 0.5
    weight = np.where(target > 0.5, 0.5 / max(up, 0.02), 0.5 / max(1 - up, 0.02)) / max(len(target), 1)
    for _ in range(epochs if len(target) else 0):
        p = 1 / (1 + np.exp(-(np.bincount(row, value * w[index], len(target)) + w[-1]).clip(-30, 30)))
        gap = (p - target) * weight
        g = np.append(np.bincount(index, value * gap[row], N_FEATURES), gap.sum()) + decay * w
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


@dataclass
class Classifier:
    """Weights per question, and what the labellers were found to be worth."""

    weights: dict[str, np.ndarray]
    lexicon: Lexicon
    rates: dict[str, np.ndarray] = field(default_factory=dict)
    priors: dict[str, float] = field(default_factory=dict)

    def scores(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        index, value, of = features(measure(texts, self.lexicon))
        row = np.repeat(np.arange(len(texts)), np.diff(of))
        return {k: 1 / (1 + np.exp(-(np.bincount(row, value * w[index], len(texts)) + w[-1]).clip(-30, 30))) for k, w in self.weights.items()}


def learn_lexicon(docs: DataFrame, labels: DataFrame, sample: int = 20_000, most: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """The fixed lexicon and up to ``most`` words that are in at least one in two
    hundred of the toxic labelled texts (five at least), and 150 times (sure) or 15
    times (likely) more often in those than in the others.

    Only about ``sample`` labelled rows are read, chosen by a hash of their id;
    copies of one text count once. Null labels are left out.
    """
    labels = labels.where("toxic IS NOT NULL").select(F.col(id_col).cast("long").alias("_i"), F.col("toxic").cast("long").alias("_toxic"))
    share = min(1.0, sample / max(labels.count(), 1))
    if share < 1:
        labels = labels.where(F.pmod(F.xxhash64("_i"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    # its size is bounded by the sample
    rows = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("t")).join(F.broadcast(labels.dropDuplicates(["_i"])), "_i")
    rows = rows.select("t", "_toxic").where("t IS NOT NULL").dropDuplicates(["t"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_steps(batch, "t"):
                buf, at = join(texts)
                low = LOWER[buf]
                starts, ends = words(low, ~_LETTER[low])
                h = hash_runs(low, starts, ends)
                of = np.searchsorted(at, starts, "right") - 1
                toxic = np.array(batch.column("_toxic").slice(a, b - a).to_pylist())
                order = np.lexsort((h, of))
                keep = np.ones(len(h), bool)
                keep[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
                mine = order[keep]
                yield pa.RecordBatch.from_arrays([pa.array(h[mine].view(np.int64)), pa.array(toxic[of[mine]].astype(np.int64))], ["h", "toxic"])

    texts = materialise(rows, "labelled-texts")
    n = {r["_toxic"]: r["count"] for r in texts.groupBy("_toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return fixed_lexicon()
    counted = texts.mapInArrow(distinct, "h long, toxic long").groupBy("h").agg(F.sum("toxic").alias("a"), (F.count("*") - F.sum("toxic")).alias("b"))
    ratio = (F.col("a") / n1) / ((F.col("b") + 0.5) / n0)
    found = counted.withColumn("r", ratio).where((F.col("a") >= max(5, n1 // 200)) & (F.col("r") >= 15)).orderBy(F.desc("r"), "h").limit(most).collect()
    pick = lambda low, high: np.array([x["h"] for x in found if low <= x["r"] < high], np.int64).view(np.uint64)
    fixed = fixed_lexicon().fixed
    return Lexicon(fixed, np.setdiff1d(pick(150, np.inf), fixed), np.setdiff1d(pick(15, 150), fixed))


def vote_counts(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """(junk, toxic, n): how many documents have each pair of vote patterns."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_steps(batch, "t"):
                junk, toxic = patterns(measure(texts, lexicon))
                yield pa.RecordBatch.from_arrays([pa.array(junk), pa.array(toxic)], ["junk", "toxic"])

    votes = docs.select(F.col(text_col).alias("t")).mapInArrow(vote, "junk long, toxic long")
    return votes.groupBy("junk", "toxic").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, labels: DataFrame | None = None, sample: int = 6000, longest: int = 1 << 17, text_col: str = "text") -> Classifier:
    """Fit on ``docs``: votes of all documents, and for the scorer about ``sample``
    different texts of at most ``longest`` bytes, those whose hash is least, which
    bounds what is collected. An empty table gives a classifier that rejects nothing
    but empty texts."""
    lexicon = learn_lexicon(docs, labels, text_col=text_col) if labels is not None else fixed_lexicon()
    counted = vote_counts(docs, lexicon, text_col).collect()  # at most 2 ** 12 rows
    total = sum(r["n"] for r in counted)
    posterior, out = {}, Classifier({}, lexicon)
    for k, labellers in (("junk", len(JUNK_LABELLERS)), ("toxic", TOXIC_LABELLERS)):
        counts: dict[int, int] = {}
        for r in counted:
            counts[r[k]] = counts.get(r[k], 0) + r["n"]
        posterior[k], out.rates[k], out.priors[k] = expectation_maximisation(counts or {0: 1}, labellers)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, texts in text_steps(batch, "t"):
                m = measure(texts, lexicon)
                index, value, of = features(m)
                junk, toxic = patterns(m)
                cut = lambda x, t: pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(x, t))
                yield pa.RecordBatch.from_arrays([cut(index, pa.int32()), cut(value, pa.float32()), pa.array(junk), pa.array(toxic), batch.column("h").slice(a, len(texts))], ["i", "v", "junk", "toxic", "h"])

    share = min(1.0, sample / max(total, 1))
    hashed = docs.select(F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h")).where(F.octet_length("t") <= longest)
    chosen = hashed.where(F.pmod("h", F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))) if share < 1 else hashed
    # copies of one text are one example; the order is fixed, so a second run fits the same
    made = chosen.distinct().mapInArrow(take, "i array<int>, v array<float>, junk long, toxic long, h long")
    rows = made.orderBy("h").limit(2 * sample).toArrow()
    if not rows.num_rows:
        out.weights = {k: np.zeros(N_FEATURES + 1) - 1e-6 for k in posterior}
        return out
    lists = rows.column("i").combine_chunks(), rows.column("v").combine_chunks()
    of = np.concatenate(([0], np.cumsum([len(x) for x in lists[0]]))).astype(np.int64)
    index, value = (x.flatten().to_numpy() for x in lists)
    for k in posterior:
        target = np.array([posterior[k][p] for p in rows.column(k).to_pylist()])
        out.weights[k] = train(index, value, of, target)
    return out


def score(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_junk`` and ``_toxic``, the scorer's probabilities. A text
    that is null or has no word is junk."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_steps(batch, text_col):
                got = sent.value.scores(texts)
                empty = np.array([not t.strip() for t in texts])
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.where(empty, 1.0, got["junk"])), pa.array(got["toxic"])], [*rows.schema.names, "_junk", "_toxic"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(add, f"{fields}, _junk double, _toxic double")


def classify(docs: DataFrame, labels: DataFrame | None = None, threshold: float = 0.5, sample: int = 6000, text_col: str = "text") -> DataFrame:
    """Fit and score: every row of ``docs`` with ``_junk``, ``_toxic`` and
    ``_kept``. Repeated rows get equal scores; null ids don't matter; the columns
    of ``docs`` pass through (names of these three are taken over)."""
    docs = docs.drop("_junk", "_toxic", "_kept")
    scored = score(docs, fit(docs, labels, sample, text_col=text_col), text_col)
    return scored.withColumn("_kept", (F.col("_junk") < threshold) & (F.col("_toxic") < threshold))
