"""Toxicity scores by weak supervision.

Voters are terms: words of a small fixed lexicon, fixed patterns, and words and word beginnings
that labelled rows show far more often in toxic texts. A voter fires or stays silent on a text. A
generative label model estimates, by expectation maximisation over a bounded sample, how often each
voter fires on toxic and on other texts, and which voters fire together more often than their class
explains; such a group shares its evidence, so that ten spellings of one insult do not count as ten
witnesses. Its posterior labels train a linear classifier on the voters' terms, which scores every
whole text. A last scaling on the labelled rows makes 0.7 mean 0.7.

Only the text feeds a score. A term counts once per text, however long the text is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from . import memos
from .linear import Rows, bounded_sample, fit_logistic, fit_scale, sigmoid

SAMPLE = 20_000        # labelled rows that voters, label model and classifier are fitted on
VOTERS = 1_000
SURE = 24.0            # least likelihood ratio of a term and the label, twice the logarithm
PRECISE = 30.0         # least ratio of a voter's rates on toxic and on other texts
WITNESS = 0.995        # accuracy of a label as one more witness
ALIKE = 0.9            # correlation within a class from which voters share their evidence
_CACHED = 400_000

#: Fixed lexicon of insults in four languages, with patterns below.
LEXICON = ("arschloch asshole bastard bitch clown connard cretin cretino depp disgusting dumb "
           "dummkopf estupido filth freak garbage hate idiot idiota idiote imbecil imbecile "
           "imbécile jerk kill loser moron mierda merde pathetic pendejo puta schlampe scum "
           "shit stupid stupide tonto trash trottel ugly verlierer vermin wichser worthless")
PATTERNS = (r"\byou(?:'re| are) (?:an? )?\w+ (?:idiot|moron|loser|clown)", r"\bshut up\b",
            r"\bgo to hell\b", r"\bhate (?:you|them|him|her)\b", r"\bkill (?:you|yourself)\b")
_WORD = re.compile(r"\w+")


# A term's number ends in its kind: 7 word, 6 to 3 beginning of so many letters, 2 and 1 beginning
# that two or three different words of the text share, 0 pattern.
def _number(text: str, kind: int) -> int:
    return xxhash.xxh64_intdigest(text.encode()) >> 1 & ~7 | kind


def _shared(beginning: int, kind: int) -> int:
    return (beginning * 0x9E3779B97F4A7C15 & (1 << 63) - 1) & ~7 | kind


class _Terms(dict):
    """Numbers of the terms of a raw word: its words, and their beginnings of 3 to 6 letters."""

    def __init__(self, chosen: dict[int, int] | None = None):
        super().__init__()
        memos.claim("toxicity")
        self.chosen = chosen

    def __missing__(self, raw: str) -> tuple[int, ...]:
        found = []
        for word in _WORD.findall(raw):
            found.append(_number(word, 7))
            found += [_number(word[:k], k) for k in range(3, 7) if len(word) > k]
        if self.chosen is not None:
            found = [x for x in found if x in self.chosen or (
                3 <= x & 7 < 7 and (_shared(x, 2) in self.chosen or _shared(x, 1) in self.chosen))]
        if len(self) >= _CACHED:
            self.clear()
        terms = self[raw] = tuple(found)
        return terms


_patterns = [(_number(p, 0), re.compile(p)) for p in PATTERNS]


def terms_of(text: str | None, terms: _Terms) -> set[int]:
    """Numbers of the terms of a whole text."""
    text = (text or "").lower()
    found: set[int] = set()
    twice: set[int] = set()
    for own in map(terms.__getitem__, set(text.split())):
        if own:
            more = found.intersection(own)
            if more:
                thrice = twice & more
                twice |= more
                found.update(_shared(x, 1) for x in thrice if 3 <= x & 7 < 7)
            found.update(own)
    found.update(_shared(x, 2) for x in twice if 3 <= x & 7 < 7)
    found.update(number for number, pattern in _patterns
                 if (terms.chosen is None or number in terms.chosen) and pattern.search(text))
    if terms.chosen is not None:
        return {terms.chosen[x] for x in found if x in terms.chosen}
    return found


def in_training_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def _term_counts(sample: DataFrame) -> DataFrame:
    """term, toxic rows, other rows; counted per batch before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms()
        for batch in batches:
            for label in (0, 1):
                found = [np.fromiter(s, np.int64, len(s)) for t, y in zip(
                    batch.column(0), batch.column(1), strict=True) if y.as_py() == label
                    for s in [terms_of(t.as_py(), terms)]]
                if found:
                    term, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(term), pa.array(n * label), pa.array(n * (1 - label))],
                        ["term", "toxic", "other"])
    return (sample.mapInArrow(count, "term long, toxic long, other long").groupBy("term")
            .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def _listed(sample: DataFrame, chosen: dict[int, int]) -> tuple[list[list[int]], np.ndarray]:
    """Feature numbers and label of every sampled row."""
    def fired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms(chosen)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(terms_of(t.as_py(), terms)) for t in batch.column(0)],
                          pa.list_(pa.int32())), batch.column(1).cast(pa.int32())],
                ["at", "label"])
    rows = sample.mapInArrow(fired, "at array<int>, label int").toArrow()
    return rows["at"].to_pylist(), rows["label"].to_numpy().astype(float)


def label_model(votes: Rows, prior: np.ndarray, rounds: int = 12):
    """Posterior that each row is toxic, and the evidence of each voter's firing.

    Start: ``prior``, the labels with room for error. Each round estimates the voters' firing rates
    per class from the posterior, groups voters whose joint firing within a class is far above what
    independent voters would show, and shares a group's evidence among its members.
    """
    n, width = len(prior), votes.width
    posterior = prior.copy()
    fired = np.zeros((n, width), np.float32)
    fired[votes.row, votes.at] = 1
    for _ in range(rounds):
        rates = []
        for share in (posterior, 1 - posterior):
            rates.append((votes.back(share) + 0.1) / (share.sum() + 1.0))
        toxic, other = np.clip(rates[0], 1e-6, 1 - 1e-6), np.clip(rates[1], 1e-6, 1 - 1e-6)
        # Correlation of voters within the toxic class: joint firing against the product of rates.
        joint = (fired * posterior[:, None].astype(np.float32)).T @ fired / max(1.0, posterior.sum())
        apart = np.sqrt(np.outer(toxic * (1 - toxic), toxic * (1 - toxic)))
        correlation = (joint - np.outer(toxic, toxic)) / apart
        shared = 1 / np.maximum(1.0, (correlation > ALIKE).sum(axis=1))
        fire = shared * np.log(toxic / other)  # a silent voter abstains
        base = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
        evidence = votes.dot(fire) + np.log(base / (1 - base))
        # The label stays one more witness, of fixed accuracy.
        posterior = sigmoid(evidence + np.log(prior / (1 - prior)))
    return posterior, fire


class Model:
    """Feature numbers, weights and scaling of a fitted classifier."""

    def __init__(self, chosen, weights, bias, slope, shift):
        self.chosen, self.weights, self.bias = chosen, weights, bias
        self.slope, self.shift = slope, shift

    def score(self, texts) -> list[float]:
        terms = _Terms(self.chosen)
        weights = self.weights.tolist()
        logits = [self.bias + sum(weights[i] for i in terms_of(t, terms)) for t in texts]
        return sigmoid(self.slope * np.array(logits, dtype=float) + self.shift).tolist()


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """A model from labelled rows outside the held-out fold.

    ``labels`` has doc_id and toxic (0 or 1; other values and nulls are ignored). At most ``most``
    rows are used. Without rows of both classes the model knows the fixed lexicon only.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).where(in_training_fold(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen_rows = bounded_sample(known, most, F.col("doc_id"))
    sample = docs.select("doc_id", "text").join(
        F.broadcast(chosen_rows), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic")
    seen = sample.groupBy("toxic").count().collect()  # two rows
    toxic_rows = sum(r["count"] for r in seen if r["toxic"] == 1)
    other_rows = sum(r["count"] for r in seen if r["toxic"] == 0)
    fixed = [_number(w, 7) for w in LEXICON.split()] + [number for number, _ in _patterns]
    if not toxic_rows or not other_rows:
        chosen = {number: k for k, number in enumerate(dict.fromkeys(fixed))}
        return Model(chosen, np.full(len(chosen), 6.0), -4.0, 1.0, 0.0)
    counts = _term_counts(sample)
    rows = toxic_rows + other_rows
    total = F.col("toxic") + F.col("other")

    def gain(seen, expected):  # a cell of the likelihood-ratio test of independence
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)
    lean = sum(gain(seen, whole * total / rows) + gain(whole - seen, whole * (rows - total) / rows)
               for seen, whole in ((F.col("toxic"), F.lit(float(toxic_rows))),
                                   (F.col("other"), F.lit(float(other_rows)))))
    ranked = (counts.where((total >= 4) & (total < rows)).withColumn("lean", lean)
              .where(F.col("lean") > SURE)
              .where((F.col("toxic") + 0.5) / (toxic_rows + 1)
                     >= PRECISE * (F.col("other") + 0.5) / (other_rows + 1))
              .orderBy(F.col("lean").desc(), "term").limit(VOTERS).collect())
    voters = list(dict.fromkeys(fixed + [r["term"] for r in ranked]))
    chosen = {number: k for k, number in enumerate(voters)}
    lists, label = _listed(sample, chosen)
    # Of voters that fire on the very same rows one is enough: the most special one.
    firing: list[list[int]] = [[] for _ in voters]
    for row, at in enumerate(lists):
        for k in at:
            firing[k].append(row)
    first: dict[tuple[int, ...], int] = {}
    for k in sorted(range(len(voters)), key=lambda k: (-(voters[k] & 7), k)):
        first.setdefault(tuple(firing[k]) or (-1 - k,), k)
    kept = sorted(first.values())
    place = {k: at for at, k in enumerate(kept)}
    chosen = {voters[k]: at for k, at in place.items()}
    votes = Rows([[place[k] for k in x if k in place] for x in lists], len(kept))
    posterior, evidence = label_model(votes, np.where(label > 0, WITNESS, 1 - WITNESS))
    # Texts with one voter are rare in the sample; the evidence says where such weights belong.
    weights, bias = fit_logistic(votes, posterior, penalty=0.2, steps=600,
                                 centre=np.clip(evidence, -3, 9))
    slope, shift = fit_scale(votes.dot(weights) + bias, label)
    return Model(chosen, weights, bias, slope, shift)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add (or replace) ``to``: probability that the whole text is toxic. Null counts as empty."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shipped.value.score(batch.to_pylist()), pa.float64())
    return docs.withColumn(to, scored(F.col(f"`{text}`")))
