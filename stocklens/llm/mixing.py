"""Mixing to target weights by soft membership.

A naive Bayes classifier, fitted to a labelled table, gives each document a posterior over domains;
a document belongs to all domains to that degree. The mix is a rate for each document, the number
of times it is to be read. Rates are the nonnegative least-squares fit of the expected token totals
of the domains to their targets:

    minimise (S - T)' Q (S - T) / 2   over r >= 0,   S_d = sum_i r_i tokens_i p_id

Q is the inverse of the documents' Gram matrix, G = sum_i tokens_i p_i p_i'. Projected gradient
steps start at rate 1 and are scaled by tokens, so a step is

    r_i <- max(0, r_i - a p_i' Q (S - T))

with a = 1, which meets the targets at once if no rate is clipped; where some are, a follows
Barzilai and Borwein. A step needs the few totals S only: they are summed on the executors, and the
rates are never stored, since they are a function of a document's posterior and the past steps. The
usual targets take a few steps; targets out of reach take up to ``STEPS``, of which the best is kept.

The classifier: presence of up to ``VOCABULARY`` words for each domain, and
four shapes (length, share of symbols, of capitals, of different words) in fixed bins. A domain's words
are common in its own labelled documents, however few of all they are, and tell most about the
domains; a word must tell more bits than it takes to name one of the candidates. It is
fitted to at most ``SAMPLE`` labelled documents (the first by hash of their key); all else covers
all documents. Everything is DataFrame functions.

Defined results: null and empty texts have no tokens, count for nothing in the totals and get the
rate of their posterior; repeated rows get equal rates; labels without a document or without a
domain are not used; without any usable label the posterior is the target and all rates are 1; an
empty table gives no rows; a domain without labelled documents has posterior 0 and is left out of
the fit; further columns are kept and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce
from math import exp, log, log2

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table, text_column

SAMPLE = 20_000
VOCABULARY = 64  # words for each domain
COMMON = 0.02  # share of a domain's own labelled documents that a word chosen for it is in, at least
LEAST = 3  # so many of them at least
LIFT = 2.0  # such a word is in that domain so many times as often as in all
PRIOR = 2.0  # weight of the pooled rates in a domain's rates
STEPS = 60
PATIENCE = 15  # steps without a better point, after which the best one is taken
TOLERANCE = 1e-5  # of the target total
NEVER = -1e9  # log prior of a domain without labelled documents: its posterior is 0
SYMBOLS = "[#*$%&|<>!]"
CAPITALS = "[A-Z]"
#: Upper bounds of the shapes' bins; values beyond the last have a bin of their own.
BINS = {
    "length": (20.0, 50.0, 200.0, 1000.0),
    "symbols": (0.001, 0.02, 0.1, 0.5),
    "capitals": (0.01, 0.05, 0.2, 0.5),
    "variety": (0.1, 0.3, 0.5, 0.7, 0.9),
}


@dataclass(frozen=True)
class Targets:
    """Weights of the domains. The totals are such that ``anchor`` keeps its expected tokens."""

    weights: tuple[tuple[str, float], ...] = (("high", 0.93), ("low", 0.02), ("toxic", 0.05))
    anchor: str = "high"

    @property
    def domains(self) -> list[str]:
        return [d for d, _ in self.weights]

    @property
    def shares(self) -> np.ndarray:
        given = np.array([w for _, w in self.weights], float)
        return given / given.sum()


def domain_of_labels() -> Column:
    """Domain of a row of ``labels``; null if its labels are."""
    return (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "high")
        .when(F.col("quality") == 0, "low")
    )


def features(docs: DataFrame, keep: Sequence[Column], text: str) -> DataFrame:
    """``keep``, tokens, ``words`` (the different ones) and the bin of each shape. Words end at blanks
    and line ends only: punctuation and case are part of a word, and of what it tells."""
    share = lambda chars: F.regexp_count("t", F.lit(chars)) / F.greatest(F.length("t"), F.lit(1))
    split = docs.select(*keep, text_column(docs, text).alias("t")).withColumn(
        "all", F.array_remove(F.split(F.replace("t", F.lit("\n"), F.lit(" ")), " "), "")
    )
    kept = split.columns[: len(keep)]
    sized = split.select(
        *(F.col(f"`{c}`") for c in kept),
        F.size("all").cast("long").alias("tokens"),
        F.array_distinct("all").alias("words"),
        share(SYMBOLS).alias("symbols"),
        share(CAPITALS).alias("capitals"),
    )
    value = {
        "length": F.col("tokens").cast("double"),
        "symbols": F.col("symbols"),
        "capitals": F.col("capitals"),
        "variety": F.size("words") / F.greatest(F.col("tokens"), F.lit(1)),
    }
    bins = [sum(((value[s] > b).cast("int") for b in BINS[s]), F.lit(0)).alias(f"bin_{s}") for s in BINS]
    return sized.select(*(F.col(f"`{c}`") for c in kept), "tokens", "words", *bins)


def _add(weights: Column, total: Column, i: Column) -> Column:
    return total + F.get(weights, i)


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes: log weights by domain."""

    prior: list[float]
    vocabulary: list[str]
    word_weights: list[list[float]]  # by domain, by word
    bin_weights: dict[str, list[list[float]]]  # by shape, by domain, by bin

    def posteriors(self, found: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the posteriors p_0, p_1, ... of a frame of ``features``.

        Each step is a select of its own, so that no score is computed more than once."""
        kept = [f"`{c}`" for c in keep]
        known = F.array(*[F.lit(w) for w in self.vocabulary]).cast("array<string>")
        held = F.transform(F.array_intersect("words", known), lambda w: F.array_position(known, w).cast("int") - 1)
        scores = []
        for d, prior in enumerate(self.prior):
            weights = F.array(*[F.lit(x) for x in self.word_weights[d]]).cast("array<double>")
            by_word = F.aggregate("held__", F.lit(prior), partial(_add, weights))
            by_bin = [
                F.get(F.array(*[F.lit(x) for x in self.bin_weights[s][d]]), F.col(f"bin_{s}")) for s in BINS
            ]
            scores.append(reduce(lambda a, b: a + b, by_bin, by_word).alias(f"s_{d}"))
        names = [f"s_{d}" for d in range(len(self.prior))]
        top = F.array_max(F.array(*names))
        scored = found.select(*kept, *[f"bin_{s}" for s in BINS], held.alias("held__")).select(*kept, *scores)
        raised = scored.select(*kept, *names, top.alias("top__")).select(
            *kept, *[F.exp(F.col(s) - F.col("top__")).alias(s) for s in names]
        )
        total = reduce(lambda a, b: a + b, [F.col(s) for s in names])
        return raised.select(*kept, *names, total.alias("total__")).select(
            *kept, *[(F.col(s) / F.col("total__")).alias(f"p_{d}") for d, s in enumerate(names)]
        )


def fit(
    docs: DataFrame, labels: DataFrame, domain: Column, targets: Targets, key: str, text: str
) -> Classifier:
    """Fit to the first SAMPLE labelled keys, of those that have a document, by hash. Of all labels only these go to the driver's
    side of the join, so what is broadcast has a fixed bound, as have vocabulary and counts."""
    domains = targets.domains
    texts = docs.select(F.col(key).alias("k"), text_column(docs, text).alias("text"))
    chosen = (
        labels.select(F.col(key).alias("k"), domain.alias("domain"))
        .where(F.col("domain").isin(domains) & F.col("k").isNotNull())
        .distinct().join(texts.select("k"), "k", "left_semi")
        .orderBy(F.xxhash64("k"), "k", "domain").limit(SAMPLE)
    )
    labelled = texts.join(F.broadcast(chosen), "k").dropDuplicates(["text", "domain"])
    sample = settle(features(labelled, [F.col("domain")], "text"), "labelled")
    per_domain = lambda: [
        F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(domains)
    ]
    totals = [n or 0 for n in sample.agg(*per_domain()).first()]
    if not sum(totals):
        return Classifier([log(max(s, 1e-12)) for s in targets.shares], [], [[] for _ in domains],
                          {s: [[0.0] * (len(b) + 1) for _ in domains] for s, b in BINS.items()})
    size = sum(totals)
    counted = sample.select("domain", F.explode("words").alias("word")).groupBy("word").agg(*per_domain())
    found = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(len(domains))])

    def term(count: Column, side: Column, total: int) -> Column:  # of the mutual information
        return F.when(count > 0, count * F.log2(count * F.lit(float(size)) / (side * F.lit(float(max(total, 1)))))).otherwise(0.0)

    told = reduce(
        lambda a, b: a + b,
        [
            term(F.col(f"n{i}"), found, n) + term(F.lit(n) - F.col(f"n{i}"), F.lit(size) - found, n)
            for i, n in enumerate(totals)
        ],
    )
    # Words that set a domain off; words that only go with a language or with long texts do not.
    for_domain = [
        (F.col(f"n{i}") * (size / max(n, 1)) / found >= LIFT) & (F.col(f"n{i}") >= max(LEAST, n * COMMON))
        for i, n in enumerate(totals)
    ]
    words = settle(
        counted.where(reduce(lambda a, b: a | b, for_domain)).withColumn("told", told).withColumn("found", found),
        "candidates",
    )
    telling = words.where(F.col("told") >= log2(max(words.count(), 2)))
    chosen_words = {
        r["word"]: r
        for own in for_domain
        for r in telling.where(own).orderBy(F.desc("told"), "word").limit(VOCABULARY).collect()
    }
    best = [chosen_words[word] for word in sorted(chosen_words)]
    # Rates lean to those of all domains together: what a domain has not shown tells nothing.
    smooth = lambda n, total, pooled: log((n + PRIOR * pooled) / (total + PRIOR))
    shapes = {}
    for s, bounds in BINS.items():
        seen = {r[f"bin_{s}"]: r for r in sample.groupBy(f"bin_{s}").agg(*per_domain()).collect()}
        counts = [[seen[b][f"n{i}"] if b in seen else 0 for i in range(len(domains))] for b in range(len(bounds) + 1)]
        pooled = [(sum(c) + 0.5) / (size + 0.5 * len(counts)) for c in counts]
        shapes[s] = [
            [smooth(c[i], n, x) for c, x in zip(counts, pooled, strict=True)] for i, n in enumerate(totals)
        ]
    held = [
        [smooth(r[f"n{i}"], n, (r["found"] + 0.5) / (size + 1)) for r in best] for i, n in enumerate(totals)
    ]
    # A word that is not there tells as well: that is part of the prior, a word that is there adds
    # the difference.
    absent = [[log(max(1 - exp(x), 1e-9)) for x in own] for own in held]
    return Classifier(
        [log(n / size) + sum(a) if n else NEVER for n, a in zip(totals, absent, strict=True)],
        [r["word"] for r in best],
        [[x - a for x, a in zip(*pair, strict=True)] for pair in zip(held, absent, strict=True)],
        shapes,
    )


def rate(posteriors: Sequence[Column], steps: Sequence[np.ndarray]) -> Column:
    """The rate after the given steps, a Q (S - T) each."""
    out = F.lit(1.0)
    for step in steps:
        move = reduce(lambda a, b: a + b, [p * F.lit(float(v)) for p, v in zip(posteriors, step, strict=True)])
        out = F.greatest(F.lit(0.0), out - move)
    return out


def fit_steps(members: DataFrame, targets: Targets) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Steps, target totals and reached totals. ``members``: tokens and p_0, p_1, ... (written)."""
    n = len(targets.domains)
    p = [F.col(f"p_{i}") for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    sums = members.agg(
        *[F.sum(F.col("tokens") * x) for x in p], *[F.sum(F.col("tokens") * p[i] * p[j]) for i, j in pairs]
    ).first()
    reached = np.array([x or 0.0 for x in sums[:n]], float)
    gram = np.zeros((n, n))
    for (i, j), value in zip(pairs, sums[n:], strict=True):
        gram[i, j] = gram[j, i] = value or 0.0
    anchor = targets.domains.index(targets.anchor)
    goal = targets.shares * (reached[anchor] / max(targets.shares[anchor], 1e-12))
    goal[reached == 0] = 0.0  # nothing belongs there
    q = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    far = lambda totals: float((totals - goal) @ q @ (totals - goal))
    steps: list[np.ndarray] = []
    best, longer = (far(reached), 0, reached), 1.0
    while len(steps) < STEPS and np.abs(reached - goal).sum() > TOLERANCE * goal.sum():
        before = rate(p, steps)
        steps.append(longer * (q @ (reached - goal)))
        both = members.select("tokens", *p, before.alias("old"), rate(p, steps).alias("new"))
        moved = F.sum(F.col("tokens") * F.pow(F.col("new") - F.col("old"), 2))
        *after, length = both.agg(*[F.sum(F.col("tokens") * F.col("new") * x) for x in p], moved).first()
        after = np.array([x or 0.0 for x in after], float)
        bend = float((after - reached) @ q @ (after - reached))
        longer = min(max((length or 0.0) / bend, 1.0), 1e3) if bend > 0 else 1.0
        reached = after
        best = min(best, (far(reached), len(steps), reached), key=lambda b: b[:2])
        if len(steps) - best[1] > PATIENCE or (length or 0.0) < 1e-9 * goal.sum():
            break  # nothing moves any more: the targets cannot be met, the best point is the nearest
    return steps[: best[1]], goal, best[2]


def fitted(
    docs: DataFrame, labels: DataFrame, targets: Targets, keep: Sequence[Column], domain: Column | None,
    key: str, text: str,
) -> tuple[DataFrame, Classifier, Column]:
    """``keep``, tokens and posteriors of every row as a written table; the classifier, and the rate
    as a column over posteriors."""
    domain = domain_of_labels() if domain is None else domain
    model = fit(docs, labels, domain, targets, key, text)
    found = features(docs, keep, text)
    members = settle(model.posteriors(found, [*found.columns[: len(keep)], "tokens"]), "members")
    steps, _, _ = fit_steps(members, targets)
    return members, model, rate([F.col(f"p_{i}") for i in range(len(model.prior))], steps)


def draw_of(key: str, text: str) -> Column:
    """A fixed number from 0 to 1 by key and text. A rate plus this, rounded down, is on average the
    rate: the number of copies."""
    return F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(1 << 30)) / float(1 << 30)


def copies(rate_: Column, draw: Column) -> Column:
    return F.floor(rate_ + draw).cast("int")


def mixed(
    docs: DataFrame, labels: DataFrame, targets: Targets = Targets(), keep: tuple[str, ...] = ("doc_id",),
    domain: Column | None = None, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``keep``, tokens, p_0, ..., rate and copies of every row, without the texts."""
    columns = [F.col(f"`{c}`").alias(c) for c in keep]
    columns.append(draw_of(key, text).alias("draw__"))
    members, _, rate_ = fitted(docs, labels, targets, columns, domain, key, text)
    return members.withColumn("rate", rate_).select(
        *(f"`{c}`" for c in members.columns if c != "draw__"),
        "rate",
        copies(F.col("rate"), F.col("draw__")).alias("copies"),
    )


def resample(
    docs: DataFrame, labels: DataFrame, targets: Targets = Targets(), domain: Column | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` with each row as often as its copies say, none for copies 0; same columns. The
    posteriors are computed again in the pass that returns the rows: no text is shuffled."""
    _, model, rate_ = fitted(docs, labels, targets, [], domain, key, text)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d")
    found = features(docs, [row, draw_of(key, text).alias("draw__")], text)
    found = model.posteriors(found, ["d", "draw__"])
    often = found.select("d", copies(rate_, F.col("draw__")).alias("copies")).where("copies > 0")
    return often.select("d", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *(F.col(f"d.`{c}`").alias(c) for c in docs.columns)
    )


def op1_soft_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = Targets()
    rows = mixed(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), targets, ("doc_id", "source")
    )
    return rows.select(
        "doc_id", "source", "tokens",
        *(F.col(f"p_{i}").alias(f"p_{d}") for i, d in enumerate(targets.domains)),
        "rate", "copies",
    )
