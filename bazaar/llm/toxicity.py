"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

Voters are a lexicon of insults and patterns mined from a bounded sample of labelled documents: words and word
beginnings that toxic documents hold and others do not. A voter says toxic where its word occurs and abstains
elsewhere. The label model (expectation maximisation) estimates how often each voter speaks on either class, with the
given label as one more voter that can be wrong; voters that agree beyond what the class explains, such as a word
and its beginning, share one weight. A logistic regression over the votes is then fitted to the posteriors, and scores
whole texts of all documents.

Counting, voting and scoring are Spark work. What reaches the driver is the votes of the sample as bits: at most
POSITIVES + NEGATIVES rows (about; rows are drawn by a hash of the id) of VOTERS bits.

Defined cases: null and empty texts get the score of a text without votes; null ids or labels never teach; of several
labels of an id, toxic wins; without learning documents of both classes every score is 0; repeated rows score alike;
an empty table gives none; columns other than doc_id and text do not enter.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common

FOLDS, HELD = 5, 0
POSITIVES, NEGATIVES = 6_000, 18_000  # learning documents of each class, about
VOTERS = 512
BEGINNINGS = (4, 5, 6, 7, 8)  # lengths of word beginnings, in bytes
LEXICON = (
    "asshole", "bastard", "bitch", "clown", "cretin", "disgusting", "dumb", "filth", "fool", "idiot", "imbecile",
    "jerk", "loser", "moron", "pathetic", "pig", "scum", "shit", "stupid", "trash", "vermin", "worthless",
)
_WHOLE = np.uint64(0x5851F42D4C957F2D)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(text: str | None) -> np.ndarray:
    """Hashes of the words (runs of letters, lower case) of a text and of their beginnings."""
    a = common.as_bytes((text or "").lower())
    if not len(a):
        return np.empty(0, dtype=np.uint64)
    starts, ends = common.spans(_LETTER[a])
    out = [common.hash_spans(a, starts, ends) ^ _WHOLE]
    for n in BEGINNINGS:
        s = starts[ends - starts >= n]
        out.append(common.hash_spans(a, s, s + n))
    return np.concatenate(out)


def votes(text: str | None, voters: np.ndarray) -> np.ndarray:
    """Which of the ordered voters occur."""
    found = features(text)
    if not len(voters) or not len(found):
        return np.zeros(len(voters), dtype=bool)
    at = np.minimum(np.searchsorted(voters, found), len(voters) - 1)
    out = np.zeros(len(voters), dtype=bool)
    out[at[voters[at] == found]] = True
    return out


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of a bounded share of the labelled documents outside the held-out fold, written once."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (common.split_of(F.col("doc_id"), FOLDS) != HELD)
    )
    known = common.saved(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for value, bound in ((1, POSITIVES), (0, NEGATIVES)):
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, bound / max(1, n.get(value, 0))))).otherwise(share)
    drawn = known.filter(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    # The drawn labels are bounded by POSITIVES + NEGATIVES rows of two numbers.
    return common.saved(texts.join(F.broadcast(drawn), "doc_id").select("text", "toxic"), "sample")


def _document_counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: features and the documents that hold them."""
    held: list[np.ndarray] = []
    for batch in batches:
        held += [np.unique(features(t)) for t in batch["text"]]
    if held:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        yield pd.DataFrame({"feature": common.signed(keys), "n": n})


def mined(rows: DataFrame) -> np.ndarray:
    """Voters: the lexicon and the features that tell toxic learning documents best, ascending."""
    count = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = count.get(1, 0), count.get(0, 0)
    own = np.unique([features(w)[0] for w in LEXICON])
    if not toxic or not other:
        return own
    least = max(3, toxic // 500)
    often = rows.filter("toxic = 1").select("text").mapInPandas(_document_counts, "feature long, n long")
    often = often.groupBy("feature").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()  # from the sample
    keys = np.array([r["feature"] for r in often], dtype=np.int64).view(np.uint64)
    n1 = np.array([r["n"] for r in often], dtype=np.float64)[np.argsort(keys)]
    keys = np.sort(keys)
    shared = rows.sparkSession.sparkContext.broadcast(keys)  # features of the bounded sample

    def against(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for t in batch["text"]:
                total += votes(t, shared.value)
        yield pd.DataFrame({"counts": [total.tobytes()]})

    n0 = np.zeros(len(keys))
    for r in rows.filter("toxic = 0").select("text").coalesce(8).mapInPandas(against, "counts binary").toLocalIterator():
        n0 += np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    # How much more often on toxic documents, one standard deviation of the count taken off.
    gain = np.log((n1 - np.sqrt(n1)) / toxic) - np.log((n0 + 1) / other)
    good = np.flatnonzero(gain > np.log(8.0))
    best = good[np.lexsort((keys[good], -(n1 * gain)[good]))][: VOTERS - len(own)]
    return np.unique(np.concatenate((own, keys[best])))


@dataclass
class LabelModel:
    """Voters' rates on toxic and other documents, and the weights that account for their correlations."""

    prior: float
    on_toxic: np.ndarray
    on_other: np.ndarray
    weight: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        yes, no = np.log(self.on_toxic / self.on_other), np.log((1 - self.on_toxic) / (1 - self.on_other))
        odds = np.log(self.prior / (1 - self.prior)) + v @ ((yes - no) * self.weight) + (no * self.weight).sum()
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _correlated(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Per voter the sum of its squared correlations with others that the class does not explain."""
    covariance, spread = np.zeros((v.shape[1],) * 2), np.zeros(v.shape[1])
    for share in (q, 1 - q):
        mean = (share @ v) / max(share.sum(), 1e-9)
        covariance += (v * share[:, None]).T @ v - share.sum() * np.outer(mean, mean)
        spread += share.sum() * mean * (1 - mean)
    rho = covariance / np.sqrt(np.outer(spread, spread) + 1e-9)
    np.fill_diagonal(rho, 0)
    return (np.clip(rho, 0, 1) ** 2).sum(axis=1)


def label_model(v: np.ndarray, start: np.ndarray, rounds: int = 12) -> LabelModel:
    """Expectation maximisation over votes (documents x voters), from the given first guess of the labels."""
    q, weight = start.astype(float), np.ones(v.shape[1])
    v = v.astype(float)
    for r in range(rounds):
        toxic, other = q.sum(), (1 - q).sum()
        model = LabelModel(
            float(np.clip(q.mean(), 1e-4, 1 - 1e-4)), (q @ v + 0.1) / (toxic + 1), ((1 - q) @ v + 0.1) / (other + 1), weight
        )
        if r in (0, rounds // 2):
            model.weight = weight = 1 / (1 + _correlated(v, q))
        q = model.posterior(v)
    return model


def _inputs(v: np.ndarray) -> np.ndarray:
    """Votes, whether there is any, and how many there are."""
    n = v.sum(axis=1, keepdims=True)
    return np.hstack((np.ones((len(v), 1)), v, n > 0, np.log1p(n))).astype(float)


def fitted(v: np.ndarray, q: np.ndarray, ridge: float = 0.1, rounds: int = 12) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps."""
    x = _inputs(v)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (q - p) - penalty * w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return w


@dataclass
class Scorer:
    """Voters and the linear classifier over their votes."""

    voters: np.ndarray
    coefficients: np.ndarray

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        v = np.array([votes(t, self.voters) for t in texts], dtype=bool).reshape(-1, len(self.voters))
        return 1 / (1 + np.exp(-np.clip(_inputs(v) @ self.coefficients, -30, 30)))


def learnt(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """A scorer from labelled documents; None where they don't have both classes."""
    rows = sample(docs, labels)
    voters = mined(rows)

    def vote(batch: pd.DataFrame) -> pd.DataFrame:
        bits = [np.packbits(votes(t, voters)).tobytes() for t in batch["text"]]
        return pd.DataFrame({"toxic": batch["toxic"].to_numpy(), "bits": bits})

    found = common.over_batches(rows, vote, "toxic int, bits binary").collect()  # the bounded sample
    y = np.array([r["toxic"] for r in found], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    v = np.array([np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), count=len(voters)) for r in found], dtype=bool)
    order = np.lexsort((*np.packbits(v, axis=1).T, y))  # so that sums, and so reruns, agree
    v, y = v[order], y[order]
    with_label = np.hstack((y[:, None].astype(bool), v))
    q = label_model(with_label, 0.02 + 0.96 * y).posterior(with_label.astype(float))
    return Scorer(voters, fitted(v, q))


def scored(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """doc_id and score of every row."""

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        score = scorer.scores(batch["text"]) if scorer else np.zeros(len(batch))
        return pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "score": score})

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return common.over_batches(rows, work, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    rows = scored(docs, learnt(docs, labels))
    held = common.split_of(F.col("doc_id"), FOLDS) == HELD
    return rows.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score below the threshold."""
    scorer = learnt(docs, labels)
    if scorer is None:
        return docs

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [scorer.scores(texts.iloc[i : i + 512]) for i in range(0, len(texts), 512)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.filter(score("text") < threshold)
