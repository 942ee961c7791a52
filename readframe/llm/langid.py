"""Language identification by the nearest of several centroids per language.

A text is its character n-grams (one to three letters, lower-cased, all else a gap), hashed to ``DIMS`` places, with
logarithmic counts, weighted by inverse document frequency and scaled to length one. The training texts of a language
are clustered by cosine into ``CENTROIDS`` centroids. A text takes the language of the centroid nearest by cosine, and
is rejected if it has no letter or is farther from that centroid than the reach. The reach is pooled over all languages,
so a language of few texts has it too: it parts best what training texts have with centroids of the other half of their
language from what they have with the centroids of all other languages, as if their own had not been learned. Very short
texts of a learned language may be beyond it. With a single language it is half of what all but ``FAR`` of its texts have.

The training texts are a documented sample of about ``SAMPLE`` labelled rows per language, chosen by a hash of the id
(all rows of a rarer language), read whole. The model is bounded by languages x CENTROIDS x DIMS.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from readframe.llm.common import each_piece, sampled, stored, texts_of

DIMS = 2_048
CENTROIDS = 3
SAMPLE = 1_000
ROUNDS = 8
FAR = 0.002
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)  # odd numbers that spread code points over 32 bits

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def grams(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    # Gaps of any width are one gap; the text begins and ends with one.
    keep = letter | np.concatenate([[False], letter[:-1]])
    points = np.concatenate([[0], np.where(letter, points, 0)[keep], [0]]).astype(np.uint32)
    a, b, c = (points * np.uint32(m) for m in MULTIPLIERS)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    hashes = [a[points != 0], a[:-1] ^ b[1:], (a[:-2] ^ b[1:-1] ^ c[2:])[points[1:-1] != 0]]
    out = np.zeros(DIMS)
    for salt, h in enumerate(hashes):
        h = (h ^ np.uint32(salt)) * np.uint32(0x27D4EB2F)
        out += np.bincount(h >> shift, minlength=DIMS)
    return out


def unit(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * weights
    return v / max(np.linalg.norm(v), 1e-12)


@dataclass
class Model:
    weights: np.ndarray
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    reach: float  # least similarity that is not rejected

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        counts = grams(text)
        if counts is None or not self.langs:
            return "und", 0.0, True
        cosines = self.centroids @ unit(counts, self.weights)
        best = int(np.argmax(cosines))
        return self.langs[best], float(min(max(cosines[best], 0.0), 1.0)), bool(cosines[best] < self.reach)


def _clusters(rows: np.ndarray, number: int) -> np.ndarray:
    """Centroids by spherical k-means from rows near and far from the mean."""
    order = np.argsort(-(rows @ rows.mean(axis=0)), kind="stable")
    number = min(number, len(rows))
    centroids = rows[order[np.arange(number) * len(rows) // number]]
    for _ in range(ROUNDS):
        own = (rows @ centroids.T).argmax(axis=1)
        sums = np.array([rows[own == k].sum(axis=0) if (own == k).any() else c for k, c in enumerate(centroids)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def _reach(own: np.ndarray, foreign: np.ndarray) -> float:
    """The similarity with the least sum of the shares of ``own`` below it and of ``foreign`` above it."""
    own, foreign = np.sort(own), np.sort(foreign)
    if not len(own) or not len(foreign):
        return float(np.quantile(own, FAR) / 2) if len(own) else 0.0
    values = np.unique(np.concatenate([own, foreign]))
    cuts = (values[1:] + values[:-1]) / 2 if len(values) > 1 else values
    wrong = np.searchsorted(own, cuts) / len(own) - np.searchsorted(foreign, cuts) / len(foreign)
    return float(cuts[wrong.argmin()])


def fit(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """A model from ``doc_id, text, lang``; rows without a language or a letter teach nothing."""
    rows = sampled(labelled.dropna(subset=["lang", "text"]).select("doc_id", "text", "lang"), "lang", "doc_id", sample)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, "text"):
            found = [grams(t) for t in texts_of(batch, "text")]
            kept = pa.array([i for i, g in enumerate(found) if g is not None], pa.int64())
            packed = [g.astype(np.float32).tobytes() for g in found if g is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(kept), pa.array(packed, pa.binary())], names=["lang", "grams"]
            )

    counts = stored(rows.mapInArrow(counted, "lang string, grams binary"), "grams")

    def present(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for packed in batch.column("grams").to_pylist():
                total += np.frombuffer(packed, dtype=np.float32) > 0
                n += 1
        place = np.append(np.arange(DIMS), -1)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.append(total, n))], names=["place", "n"])

    in_texts = counts.select("grams").mapInArrow(present, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    df = {r["place"]: r["n"] for r in in_texts.collect()}  # DIMS + 1 rows at most
    seen = np.array([df.get(i, 0) for i in range(DIMS)], dtype=float)
    weights = np.log((1 + df.get(-1, 0)) / (1 + seen)) + 1

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        texts = np.array([unit(np.frombuffer(g, dtype=np.float32).astype(float), weights) for g in sorted(frame["grams"])])
        halves = [texts[::2], texts[1::2]]
        own = [(a @ _clusters(b, centroids).T).max(axis=1) for a, b in (halves, halves[::-1]) if len(texts) > 1]
        row = {"lang": frame["lang"].iloc[0], "centroids": _clusters(texts, centroids).tobytes(), "own": np.concatenate([*own, []])}
        return pd.DataFrame([row])

    # A group is a language's sample, so it is bounded.
    found = sorted(counts.groupBy("lang").applyInPandas(cluster, "lang string, centroids binary, own array<double>").collect())
    stacks = [np.frombuffer(r["centroids"]).reshape(-1, DIMS) for r in found]
    langs = [r["lang"] for r, own in zip(found, stacks) for _ in own]
    stack = np.concatenate([np.zeros((0, DIMS)), *stacks])
    given = counts.sparkSession.sparkContext.broadcast((np.array(langs), stack))

    def left_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, centres = given.value
        for batch in batches:
            cosines = []
            for lang, packed in zip(batch.column("lang").to_pylist(), batch.column("grams").to_pylist()):
                others = names != lang
                if others.any():
                    text = unit(np.frombuffer(packed, dtype=np.float32).astype(float), weights)
                    cosines.append(float((centres @ text)[others].max()))
            yield pa.RecordBatch.from_arrays([pa.array(cosines, pa.float64())], names=["cosine"])

    # One number for each sampled text.
    foreign = counts.mapInArrow(left_out, "cosine double").toArrow()["cosine"].to_numpy()
    return Model(weights, langs, stack, _reach(np.array([c for r in found for c in r["own"]]), foreign))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every whole text.

    ``lang_pred`` is the nearest centroid's language (on ties the first by name); ``und`` with score 0 for a null text
    or one without letters, or where nothing was learned. Repeated rows stay; other columns are not read.
    """
    given = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, "text"):
            found = [given.value.nearest(t) for t in texts_of(batch, "text")]
            lang, score, rejected = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, text_col):
            yield batch.filter(pa.array([not given.value.nearest(t)[2] for t in texts_of(batch, text_col)]))

    return docs.mapInArrow(run, docs.schema)
