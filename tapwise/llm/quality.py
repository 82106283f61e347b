"""Quality classifier without hand labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapwise.llm.shingles import word_hashes

BUCKETS = 1 << 15  # hashed word features
SAMPLE_DOCUMENTS = 8_000  # bound of the documents that the linear scorer is fitted on
EM_ROUNDS = 60
PRIOR_SHARE = 0.002  # weight of the prior belief in the labellers, as a share of the documents
PRIOR_ACCURACY = np.array([[0.3], [0.95]])  # a filter rule finds few of the bad documents and spares the good ones
FIT_ROUNDS, STEP, SHRINK = 120, 4.0, 1e-5
ABSTAIN, BAD, GOOD = 0, 1, 2

_SPACE, _LETTER, _UPPER, _DIGIT, _STOP, _MARK, _SYMBOL = range(7)
_kind = np.full(256, _SYMBOL)
_kind[[9, 10, 11, 12, 13, 32]] = _SPACE
_kind[97:123] = _kind[128:] = _LETTER  # bytes of other letters than a-z count as letters
_kind[65:91] = _UPPER
_kind[48:58] = _DIGIT
_kind[[33, 46, 63]] = _STOP
_kind[[34, 39, 40, 41, 44, 45, 58, 59]] = _MARK


def _between(value: float, low: float, high: float) -> int:
    """BAD from `high` on, GOOD up to `low`, else no vote."""
    return BAD if value >= high else GOOD if value <= low else ABSTAIN


def labels_of(text: str | None) -> list[int]:
    """Votes of the labellers on a whole text; none votes on null, empty and blank texts but the first."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_kind[data], minlength=7)
    seen = int(kinds.sum() - kinds[_SPACE])
    if not seen:
        return [BAD] + [ABSTAIN] * (len(LABELLERS) - 1)
    inside = _kind[data] != _SPACE
    words = int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[0])
    lines = [line for line in text.split("\n") if line.strip()]
    letters = kinds[_LETTER] + kinds[_UPPER]
    mean = seen / words
    ends = kinds[_STOP] / words
    hashes, _ = word_hashes(text)
    return [
        _between(1 - letters / seen, 0.12, 0.3),
        _between(kinds[_SYMBOL] / words, 0.02, 0.3),
        _between(kinds[_UPPER] / max(letters, 1), 0.15, 0.5),
        BAD if mean > 12 or mean < 2 else GOOD if 3 <= mean <= 9 else ABSTAIN,
        _between(ends, 0.25, 0.5) if words >= 20 else ABSTAIN,
        _between(1 - len(set(lines)) / len(lines), 0.1, 0.4) if len(lines) >= 5 else ABSTAIN,
        _between(text.count("|") / words, 0.0, 0.1),
        _between(float(np.mean(hashes[1:] == hashes[:-1])), 0.05, 0.25) if words >= 10 else ABSTAIN,
    ]


LABELLERS = ("letters", "symbols", "capitals", "word_length", "sentence_ends", "repeated_lines", "tables",
             "repeated_words")


def estimate_accuracies(patterns: dict[int, int]) -> tuple[float, np.ndarray, dict[int, float]]:
    """EM over vote patterns (base-3 numbers) with their documents: share of good ones, accuracies, posteriors.

    A labeller that votes is right with an accuracy of its own for each class, and abstains regardless of class.
    The first round starts from the prior accuracies, which also keep the classes in their places where one of
    them is rare or absent.
    """
    codes = sorted(patterns)
    votes = np.array([[c // 3 ** j % 3 for j in range(len(LABELLERS))] for c in codes]).reshape(-1, len(LABELLERS))
    weight = np.array([patterns[c] for c in codes], float)
    pseudo = max(1.0, PRIOR_SHARE * weight.sum())
    share, accuracy = 0.5, np.repeat(PRIOR_ACCURACY, len(LABELLERS), axis=1)
    posterior = np.full(len(codes), 0.5)
    for _ in range(EM_ROUNDS):
        odds = np.log(share / (1 - share)) + np.where(votes == GOOD, np.log(accuracy[1] / (1 - accuracy[0])), 0).sum(
            1) + np.where(votes == BAD, np.log((1 - accuracy[1]) / accuracy[0]), 0).sum(1)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        good, bad = weight * posterior, weight * (1 - posterior)
        right = np.array([(bad[:, None] * (votes == BAD)).sum(0), (good[:, None] * (votes == GOOD)).sum(0)])
        voted = np.array([(bad[:, None] * (votes != ABSTAIN)).sum(0), (good[:, None] * (votes != ABSTAIN)).sum(0)])
        accuracy = (right + pseudo * PRIOR_ACCURACY) / (voted + pseudo)
        share = (good.sum() + pseudo * 0.5) / (weight.sum() + pseudo)
    return share, accuracy, dict(zip(codes, posterior.tolist()))


def _features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words with damped, normalised counts."""
    hashes, _ = word_hashes(text)
    buckets, counts = np.unique((hashes >> np.uint64(40)).astype(np.int64) % BUCKETS, return_counts=True)
    values = np.log1p(counts)
    norm = np.sqrt(values @ values)
    return buckets, values / norm if norm else values


def _votes(documents: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sum(v * 3 ** j for j, v in enumerate(labels_of(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], ["votes"])

    return documents.select("text").mapInArrow(rows, "votes int")


def _fit(sample: list, posteriors: dict[int, float]) -> np.ndarray:
    """Weights of a logistic scorer, the last one its bias, by full gradient steps on posterior labels."""
    weights = np.zeros(BUCKETS + 1)
    if not sample:
        return weights
    parts = [_features(r["text"]) for r in sample]
    goal = np.array([posteriors[sum(v * 3 ** j for j, v in enumerate(labels_of(r["text"])))] for r in sample])
    row = np.repeat(np.arange(len(parts)), [len(b) for b, _ in parts])
    column, value = np.concatenate([b for b, _ in parts]), np.concatenate([v for _, v in parts])
    # both classes weigh the same, as far as there are both
    balance = goal / max(goal.sum(), 1.0) + (1 - goal) / max((1 - goal).sum(), 1.0)
    balance /= balance.sum()
    for _ in range(FIT_ROUNDS):
        guess = 1 / (1 + np.exp(-(np.bincount(row, value * weights[column], len(parts)) + weights[-1])))
        miss = balance * (goal - guess)
        weights[:-1] += STEP * 10 * (np.bincount(column, value * miss[row], BUCKETS) - SHRINK * weights[:-1])
        weights[-1] += STEP * miss.sum()
    return weights


def score_quality(documents: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """Every document as (doc_id, votes, posterior, score, keep).

    `votes` has a letter for each of LABELLERS: g, b or - for no vote. `posterior` is the label model's probability
    of good quality, `score` the linear scorer's, and `keep` says that their mean reaches `keep_from`. Null, empty
    and blank texts get the vote of the first labeller alone and the scorer's bias.

    Votes of all documents are counted by pattern, of which there are 3 ** 8, before anything reaches the driver.
    The scorer is fitted on at most SAMPLE_DOCUMENTS documents chosen by a hash of the text, with their posterior
    labels; everything else covers all rows. Scoring is one pass without shuffle.
    """
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    patterns = {r["votes"]: r["count"] for r in _votes(columns).groupBy("votes").count().collect()}
    _, _, posteriors = estimate_accuracies(patterns)
    draw = columns.filter(F.length("text") > 0).select("text", F.xxhash64("doc_id", "text").alias("_draw"))
    limit = min(1.0, 3.0 * SAMPLE_DOCUMENTS / max(1, sum(patterns.values())))
    drawn = draw.filter(F.pmod("_draw", F.lit(1 << 20)) < int(limit * (1 << 20)) + 1)
    weights = _fit(drawn.orderBy("_draw").limit(SAMPLE_DOCUMENTS).collect(), posteriors)
    shared = documents.sparkSession.sparkContext.broadcast((weights, posteriors))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, posteriors = shared.value
        for batch in batches:
            votes, posterior, score = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                found = labels_of(text)
                votes.append("".join("-bg"[v] for v in found))
                posterior.append(posteriors.get(sum(v * 3 ** j for j, v in enumerate(found)), 0.5))
                buckets, values = _features(text)
                score.append(1 / (1 + np.exp(-(values @ weights[buckets] + weights[-1]))))
            keep = [(p + s) / 2 >= keep_from for p, s in zip(posterior, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(votes, pa.string()), pa.array(posterior, pa.float64()),
                 pa.array(score, pa.float64()), pa.array(keep, pa.bool_())],
                ["doc_id", "votes", "posterior", "score", "keep"])

    return columns.mapInArrow(rows, "doc_id long, votes string, posterior double, score double, keep boolean")
