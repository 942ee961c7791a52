"""Toxicity from two Kneser-Ney bigram models, one per class, that share counts for backoff.

    P_c(w | v) = d(n_c(v w)) / n_c(v) + b_c(v) (d(n(v w)) / n(v) + b(v) P_c(w))
    P_c(w)     = d(n_c(w)) / N_c + b_c S(w)
    S(w)       = (distinct words before w, in either class, + 1) / (distinct pairs + distinct words + 1)

``n`` without a class counts both. ``d`` takes off a discount for 1, 2 and more that the counts of counts give, ``b`` is
what the discounts leave. Every word and pair of the labelled sample has its own counts; only words never seen are one
word. Rare ones are smoothed by the discount and the shared counts: what was seen once in one class is expected of the
other as well, so it says something, but less than what one class favours often. The log-likelihood ratio is normalised
by length, over the whole text and over its ``TOP`` most toxic words, once after the word before them and once alone,
and a logistic curve turns the three into a probability. The curve is fitted on ratios of labelled texts by the models
of the other half of the labels.

The labelled texts are a documented sample: about ``LABELLED`` rows of each class, chosen by a hash of the id; all rows
of a smaller class. Everything that is broadcast is bounded by that sample.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from readframe.llm.common import Growing, Numbered, each_piece, plain_words, sampled, stored, texts_of

LABELLED = 3_000
DISCOUNT = 0.75
TOP = 4
CACHE_WORDS = 300_000


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 1  # fits a signed column; 0 stands for the beginning


def _pair_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(half, toxic, before, word, n) of each piece."""
    for batch in each_piece(batches, "text"):
        words, keys = Numbered(), []
        words[b""] = 0
        groups = np.array(batch.column("half").to_pylist()) * 2 + np.array(batch.column("toxic").to_pylist())
        for text in texts_of(batch, "text"):
            keys.append(np.array([0, *map(words.__getitem__, plain_words(text))], dtype=np.int64))
        hashes = np.array([0, *map(word_hash, words.new)], dtype=np.int64)
        for group in range(4):
            own = [k for k, g in zip(keys, groups) if g == group and len(k) > 1]
            if own:
                pairs = np.concatenate([k[:-1] * len(words) + k[1:] for k in own])
                pairs, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), group // 2, dtype=np.int32)),
                        pa.array(np.full(len(n), group % 2, dtype=np.int32)),
                        pa.array(hashes[pairs // len(words)]),
                        pa.array(hashes[pairs % len(words)]),
                        pa.array(n),
                    ],
                    names=["half", "toxic", "before", "word", "n"],
                )


@dataclass
class Models:
    """Both classes' models: sorted word hashes, word and backoff probabilities, and pairs. The last word is any other.

    The first hash is 0, the beginning of a text, which comes before words only.
    """

    words: np.ndarray
    word_p: np.ndarray  # class, word
    backoff: np.ndarray  # class, word before
    pairs: np.ndarray  # word before * size + word, sorted
    pair_p: np.ndarray  # class, pair

    def index(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashes)
        known = at < len(self.words)
        known[known] = self.words[at[known]] == hashes[known]
        return np.where(known, at, len(self.words))

    def word_ratios(self) -> np.ndarray:
        p = np.maximum(self.word_p, 1e-300)  # the beginning has none
        return np.log(p[1]) - np.log(p[0])

    def ratios(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        p = self.backoff[:, before] * self.word_p[:, word]
        if len(self.pairs):
            key = before * (len(self.words) + 1) + word
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            p += np.where(self.pairs[at] == key, self.pair_p[:, at], 0.0)
        return np.log(p[1]) - np.log(p[0])


def _discounted(n: np.ndarray) -> np.ndarray:
    """Counts less the discounts for 1, 2 and more that the counts of counts give (Chen and Goodman)."""
    r = np.array([np.count_nonzero(n == k) for k in (1, 2, 3, 4)], dtype=float)
    d = np.full(3, DISCOUNT)
    if r.all():
        k = np.arange(1, 4)
        d = np.clip(k - (k + 1) * r[0] / (r[0] + 2 * r[1]) * r[1:] / r[:-1], 0.1, k - 0.1)
    return np.maximum(n - d[np.clip(n, 1, 3) - 1], 0.0)


def _models(words: pa.Table, pairs: pa.Table) -> Models:
    """From counts per word (n_<class>, h_<class> as the word before, cont) and per pair (n_<class>)."""
    hashes = words["word"].to_numpy()
    order = np.argsort(hashes)
    hashes = hashes[order]
    size = len(hashes) + 1
    n, held = (np.array([np.append(words[f"{k}_{c}"].to_numpy()[order], 0) for c in (0, 1)]) for k in "nh")
    cont = np.append(words["cont"].to_numpy()[order], 0)
    shared = np.where(np.append(hashes, -1) == 0, 0.0, cont + 1)
    shared /= shared.sum()
    total = np.maximum(n.sum(axis=1, keepdims=True), 1.0)
    kept = np.array([_discounted(k) for k in n]) / total
    word_p = kept + (1 - kept.sum(axis=1, keepdims=True)) * shared
    model = Models(hashes, word_p, np.ones(n.shape), np.zeros(0, dtype=np.int64), np.zeros((2, 0)))
    count = np.array([pairs[f"n_{c}"].to_numpy() for c in (0, 1)])
    before, word = (model.index(pairs[k].to_numpy()) for k in ("before", "word"))
    both = _discounted(count.sum(axis=0)) / np.maximum(held.sum(axis=0)[before], 1.0)
    left = 1 - np.bincount(before, weights=both, minlength=size)
    p = np.array([_discounted(k) for k in count]) / np.maximum(held[:, before], 1.0)
    for c in (0, 1):
        model.backoff[c] -= np.bincount(before, weights=p[c], minlength=size)
    p += model.backoff[:, before] * both
    model.backoff *= left
    key = before * size + word
    order = np.argsort(key)
    model.pairs, model.pair_p = key[order], p[:, order].astype(np.float32)
    return model


class Scorer:
    def __init__(self, models: Models) -> None:
        self.models, self.alone = models, models.word_ratios()
        self.clear()

    def clear(self) -> None:
        self.words, self.at = Numbered(), Growing(np.int64)

    def features(self, texts: list[str]) -> np.ndarray:
        """(mean ratio, mean ratio of the most toxic words after the ones before, and alone) of each text; zeros without words."""
        if len(self.words) > CACHE_WORDS:
            self.clear()
        found = []
        for text in texts:
            words = plain_words(text)
            found.append(np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words)))
        new, self.words.new = self.words.new, []
        self.at.extend(self.models.index(np.fromiter(map(word_hash, new), dtype=np.int64, count=len(new))))
        lens = np.array([len(f) for f in found])
        out = np.zeros((len(texts), 3))
        if not lens.sum():
            return out
        word = self.at.view()[np.concatenate(found)]
        doc = np.repeat(np.arange(len(texts)), lens)
        first = np.cumsum(lens) - lens
        before = np.concatenate([[0], word[:-1]])
        before[first[lens > 0]] = 0
        ratio, alone = self.models.ratios(before, word), self.alone[word]
        out[:, 0] = np.bincount(doc, weights=ratio, minlength=len(texts)) / np.maximum(lens, 1)
        for i, (begin, n) in enumerate(zip(first.tolist(), lens.tolist())):
            for k, every in ((1, ratio), (2, alone)):
                own = every[begin : begin + n]
                if n > TOP:
                    own = np.partition(own, n - TOP)[n - TOP :]
                out[i, k] = own.sum() / TOP
        return out


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with an intercept and a light penalty, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 1e-3 * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), gradient)
    return w


def fit(labelled: DataFrame) -> tuple[Models, np.ndarray] | None:
    """Models and curve from ``doc_id, text, toxic`` (0 or 1); None unless both classes have rows."""
    rows = labelled.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    rows = stored(rows.select("doc_id", "half", F.col("toxic").cast("int").alias("toxic"), "text"), "labelled")
    counts = rows.mapInArrow(_pair_counts, "half int, toxic int, before bigint, word bigint, n bigint")
    cells = [(h, c) for h in (0, 1) for c in (0, 1)]
    sums = [F.sum(F.when((F.col("half") == h) & (F.col("toxic") == c), F.col("n")).otherwise(0)).alias(f"n_{h}{c}") for h, c in cells]
    pairs = stored(counts.groupBy("before", "word").agg(*sums), "pairs")
    n = {f"{h}{c}": F.col(f"n_{h}{c}") for h, c in cells}
    if {c for h, c in cells if pairs.filter(n[f"{h}{c}"] > 0).limit(1).count()} != {0, 1}:
        return None

    def models(*halves: int) -> Models:
        # Only what these halves have comes to the driver; the beginning (0) comes before words only.
        own = [sum(n[f"{h}{c}"] for h in halves) for c in (0, 1)]
        found = pairs.select("before", "word", *(k.cast("int").alias(f"n_{c}") for c, k in enumerate(own))).filter("n_0 + n_1 > 0")
        as_word = found.selectExpr("word", "n_0", "n_1", "0 AS h_0", "0 AS h_1", "1 AS cont")
        as_before = found.selectExpr("before", "0", "0", "n_0", "n_1", "0")
        sums = [F.sum(k).cast("int").alias(k) for k in ("n_0", "n_1", "h_0", "h_1", "cont")]
        words = as_word.union(as_before).groupBy("word").agg(*sums)
        return _models(words.toArrow(), found.toArrow())

    given = rows.sparkSession.sparkContext.broadcast({h: models(1 - h) for h in (0, 1)})

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = {h: Scorer(m) for h, m in given.value.items()}
        for batch in each_piece(batches, "text"):
            texts, halves = texts_of(batch, "text"), batch.column("half").to_pylist()
            x = np.zeros((len(texts), 3))
            for h, scorer in scorers.items():
                own = [i for i, half in enumerate(halves) if half == h]
                x[own] = scorer.features([texts[i] for i in own])
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), batch.column("toxic")], names=["x0", "x1", "x2", "y"])

    scored = rows.mapInArrow(score, "x0 double, x1 double, x2 double, y int").toArrow()
    given.destroy()
    x = np.column_stack([scored[k].to_numpy() for k in ("x0", "x1", "x2")])
    return models(0, 1), _curve(x, scored["y"].to_numpy())


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bound: int = LABELLED
) -> DataFrame:
    """``doc_id, score`` of every whole text; ``labels`` has the id and the label of the rows to learn from.

    A null text is an empty one; a text without words gets the score of zero ratios. Several labels of an id count as
    the highest; null labels and ids are left out. Without rows of both classes every score is 0.5. Other columns are
    not read. Repeated rows are scored each.
    """
    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"coalesce(CAST(`{text_col}` AS STRING), '') AS text")
    marked = labels.selectExpr(f"`{id_col}` AS doc_id", f"`{label_col}` AS toxic").dropna()
    marked = stored(sampled(marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic", "doc_id", bound), "labels")
    # The sample bounds the labels that are broadcast.
    fitted = fit(source.join(F.broadcast(marked), "doc_id"))
    given = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, curve = given.value or (None, None)
        scorer = models and Scorer(models)
        for batch in each_piece(batches, "text"):
            p = np.full(batch.num_rows, 0.5)
            if scorer:
                x = scorer.features(texts_of(batch, "text"))
                p = 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")
