"""Language-model scores from a hidden Markov model over the whole training corpus.

A text is a chain of latent states; a state emits a word class, and the class emits the word:

    P(text) = sum over state chains of prod A(s, s') B(s', class) C(word | class),   C = (c + 1) / (N_class + V_class + 1)

Classes are hashes of a word's first and last letters, so unknown words have one too; the end of a text is a class of
its own. Word counts ``c`` cover all training texts. ``A`` and ``B`` come from Baum-Welch: each partition adds up
expected counts over stretches of ``STRETCH`` words of all training texts, the sums over partitions give the next
parameters. A score is the exact likelihood of the whole text by the scaled forward recursion: products of transition
matrices over stretches, in parallel, then along each text.

Texts are kept as blocks of about ``BLOCK_TOKENS`` words: the distinct words once, the text as numbers. Counting and
looking up move a block's distinct words, never its tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from readframe.llm.common import Numbered, each_piece, stored, texts_of, words_of

STATES, CLASSES, STRETCH, ROUNDS = 6, 4_096, 64, 6
BLOCK_TOKENS = 2_000_000
BATCH = 4_096  # stretches worked on at a time


def word_class(word: bytes) -> int:
    return zlib.crc32(word[:2] + word[-2:]) % CLASSES


class _Block:
    def __init__(self) -> None:
        self.words, self.ids, self.docs, self.train, self.size = Numbered(), [], [], [], 0

    def add(self, doc, train: bool, text: str) -> None:
        words = words_of(text.encode())
        self.ids.append(np.fromiter(map(self.words.__getitem__, words), dtype=np.int32, count=len(words)))
        self.docs.append(doc)
        self.train.append(train)
        self.size += len(words)

    def row(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        lens = np.array([len(i) for i in self.ids])
        flat = np.concatenate(self.ids)
        learned = np.bincount(flat[np.repeat(np.array(self.train, dtype=bool), lens)], minlength=len(self.words))
        columns = {
            "block": pa.array([block], pa.int64()),
            "docs": pa.array([self.docs], pa.list_(kind)),
            "train": pa.array([self.train], pa.list_(pa.bool_())),
            "lens": pa.array([lens], pa.list_(pa.int32())),
            "ids": pa.array([flat.tobytes()], pa.binary()),
            "words": pa.array([list(self.words)], pa.list_(pa.binary())),
            "classes": pa.array([np.array([word_class(w) for w in self.words], dtype=np.int32)], pa.list_(pa.int32())),
            "counts": pa.array([learned], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def blocks(docs: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, block, arrow = TaskContext.get().partitionId(), 0, _Block(), None
        for batch in each_piece(batches, "text"):
            arrow = batch.column("doc_id").type
            for doc, learn, text in zip(batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), texts_of(batch, "text")):
                block.add(doc, learn, text)
                if block.size >= BLOCK_TOKENS:
                    yield block.row(part << 32 | number, arrow)
                    number, block = number + 1, _Block()
        if block.docs:
            yield block.row(part << 32 | number, arrow)

    schema = (
        f"block bigint, docs array<{kind}>, train array<boolean>, lens array<int>, ids binary, words array<binary>, "
        "classes array<int>, counts array<bigint>"
    )
    return stored(source.mapInArrow(run, schema), "blocks", "zstd")


def _sequences(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all texts of a block, each with its end, and the number of them in each text."""
    lens = np.array(row["lens"], dtype=np.int64)
    classes = np.asarray(row["classes"], dtype=np.int64)[np.frombuffer(row["ids"], dtype=np.int32)]
    out = np.full(len(classes) + len(lens), CLASSES, dtype=np.int64)
    out[np.arange(len(classes)) + np.repeat(np.arange(len(lens)), lens)] = classes
    return out, lens + 1


def _stretches(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first position, length) of each stretch of texts that lie one after another."""
    per = -(-lens // STRETCH)
    text = np.repeat(np.arange(len(lens)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(lens) - lens)[text] + nth * STRETCH
    return text, first, np.minimum(lens[text] - nth * STRETCH, STRETCH)


class Parameters:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit  # (S), (S, S), (S, CLASSES + 1)

    @classmethod
    def first(cls) -> Parameters:
        """Sticky states with random emissions, the same in every run."""
        random = np.random.default_rng(0)
        emit = random.uniform(0.5, 1.5, (STATES, CLASSES + 1))
        move = np.full((STATES, STATES), 0.1 / (STATES - 1)) + np.eye(STATES) * (0.9 - 0.1 / (STATES - 1))
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=1, keepdims=True))

    def expected(self, classes: np.ndarray, first: np.ndarray, lens: np.ndarray, total: np.ndarray) -> None:
        """Add expected counts of stretches to ``total`` (S, S + CLASSES + 2): moves, emissions, starts."""
        order = np.argsort(-lens, kind="stable")  # longest first, so that the active ones are a prefix
        first, lens = first[order], lens[order]
        steps = int(lens[0])
        active = [int(np.searchsorted(-lens, -t, side="left")) for t in range(steps)]  # with more than t words
        seen = [classes[first[: active[t]] + t] for t in range(steps)]
        by_class = self.emit.T.copy()
        emitted = [by_class[s] for s in seen]
        alpha, scales = [], []
        for t in range(steps):
            a = (self.start if t == 0 else alpha[-1][: active[t]] @ self.move) * emitted[t]
            scale = a.sum(axis=1)
            alpha.append(a / scale[:, None])
            scales.append(scale)
        beta = np.ones((active[steps - 1], STATES))
        for t in range(steps - 1, -1, -1):
            gamma = alpha[t] * beta
            gamma /= gamma.sum(axis=1, keepdims=True)
            for s in range(STATES):
                total[s, STATES : STATES + CLASSES + 1] += np.bincount(seen[t], weights=gamma[:, s], minlength=CLASSES + 1)
            if t == 0:
                total[:, -1] += gamma.sum(axis=0)
                break
            onward = emitted[t] * beta / scales[t][:, None]
            total[:, :STATES] += self.move * (alpha[t - 1][: active[t]].T @ onward)
            beta = np.ones((active[t - 1], STATES))
            beta[: active[t]] = onward @ self.move.T

    @classmethod
    def from_counts(cls, total: np.ndarray) -> Parameters:
        move = total[:, :STATES] + 1e-3
        emit = total[:, STATES : STATES + CLASSES + 1] + 1e-2
        start = total[:, -1] + 1e-3
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))

    def log10(self, classes: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """log10 probability of each text's classes."""
        text, first, size = _stretches(lens)
        by_class = self.emit.T.copy()
        product, scale = np.empty((len(first), STATES, STATES)), np.zeros(len(first))
        # A text's first word comes from the start, so its move is undone there.
        begins = np.concatenate([[True], text[1:] != text[:-1]])
        for low in range(0, len(first), BATCH):
            own = np.arange(low, min(low + BATCH, len(first)))
            own = own[np.argsort(-size[own], kind="stable")]
            p = np.where(begins[own][:, None, None], np.eye(STATES), self.move) * by_class[classes[first[own]]][:, None, :]
            logs = np.zeros(len(own))
            for t in range(int(size[own[0]])):
                n = int(np.searchsorted(-size[own], -t, side="left"))
                if t:
                    p[:n] = (p[:n].reshape(-1, STATES) @ self.move).reshape(n, STATES, STATES)
                    p[:n] *= by_class[classes[first[own[:n]] + t]][:, None, :]
                total = p[:n].sum(axis=(1, 2))
                p[:n] /= total[:, None, None]
                logs[:n] += np.log10(total)
            product[own], scale[own] = p, logs
        out = np.zeros(len(lens))
        per = -(-lens // STRETCH)
        place = np.cumsum(per) - per
        order = np.argsort(-per, kind="stable")
        state = np.tile(self.start, (len(lens), 1))
        for k in range(int(per.max()) if len(per) else 0):
            live = order[: int(np.searchsorted(-per[order], -k, side="left"))]
            at = place[live] + k
            moved = np.einsum("ns,nst->nt", state[live], product[at])
            total = moved.sum(axis=1)
            state[live] = moved / total[:, None]
            out[live] += np.log10(total) + scale[at]
        return out


def train(own: DataFrame, rounds: int = ROUNDS) -> Parameters:
    """Baum-Welch over the training texts of ``own`` blocks."""
    found = Parameters.first()
    width = STATES + CLASSES + 2
    for _ in range(rounds):
        given = own.sparkSession.sparkContext.broadcast(found)

        def count(batches: Iterable[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            total = np.zeros((STATES, width))
            for batch in batches:
                for row in range(batch.num_rows):
                    block = {c: batch.column(c)[row].as_py() for c in ("lens", "ids", "classes", "train")}
                    classes, lens = _sequences(block)
                    text, first, size = _stretches(lens)
                    learn = np.flatnonzero(np.array(block["train"], dtype=bool)[text])
                    for low in range(0, len(learn), BATCH):
                        part = learn[low : low + BATCH]
                        given.value.expected(classes, first[part], size[part], total)
            place = np.flatnonzero(total.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], names=["place", "n"])

        counts = own.select("lens", "ids", "classes", "train").mapInArrow(count, "place bigint, n double")
        sums = counts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # at most STATES x width rows
        if not sums.num_rows:
            return found
        total = np.zeros(STATES * width)
        total[sums["place"].to_numpy()] = sums["n"].to_numpy()
        found = Parameters.from_counts(total.reshape(STATES, width))
    return found


def score(
    docs: DataFrame, held_out: Column, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    Learns from the rows where ``held_out`` is false (a null is held out). A null text is an empty one: one token, its
    end. Without training rows all counts are zero and the classes' model is the untrained one. Repeated rows are
    learned and scored each; other columns are not read.
    """
    own = blocks(docs, id_col, text_col, ~held_out)
    zipped = F.explode(F.arrays_zip("words", "classes", "counts")).alias("w")
    counts = own.select(zipped).select("w.*").filter("counts > 0")
    counts = stored(counts.groupBy("words").agg(F.first("classes").alias("class"), F.sum("counts").alias("c")), "counts")
    by_class = counts.groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()  # CLASSES rows at most
    ends = own.agg(F.sum(F.size(F.filter("train", lambda t: t)))).first()[0] or 0
    mass = np.ones(CLASSES + 1)
    mass[by_class["class"].to_numpy()] += by_class["n"].to_numpy() + by_class["v"].to_numpy()
    n_all = int(by_class["n"].to_numpy().sum()) + ends
    distinct = int(by_class["v"].to_numpy().sum()) + (ends > 0)
    given = docs.sparkSession.sparkContext.broadcast((train(own, rounds), np.log10(mass)))
    base_mass, end_mass = float(np.log10(n_all + distinct + 1)), float(np.log10(ends + 1))

    asked = own.select("block", F.posexplode("words").alias("at", "words"))
    told = asked.join(counts.select("words", "c"), "words").groupBy("block").agg(F.collect_list(F.struct("at", "c")).alias("told"))
    looked_up = own.select("block", "docs", "train", "lens", "ids", "classes").join(told, "block", "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parameters, log_mass = given.value
        for batch in batches:
            for row in range(batch.num_rows):
                block = {c: batch.column(c)[row].as_py() for c in ("lens", "ids", "classes", "train")}
                c = np.zeros(len(block["classes"]))
                told = batch.column("told")[row].values
                if told is not None:
                    c[told.field("at").to_numpy()] = told.field("c").to_numpy()
                classes, lens = _sequences(block)
                text = np.repeat(np.arange(len(lens)), lens - 1)
                ids = np.frombuffer(block["ids"], dtype=np.int32)
                add = lambda x: np.bincount(text, weights=x[ids], minlength=len(lens))  # noqa: B023, E731
                logs, known = add(np.log10(c + 1)), add((c > 0).astype(float)).astype(np.int64)
                in_class = add(log_mass[np.asarray(block["classes"], dtype=np.int64)])
                n = len(lens)
                columns = {
                    "doc_id": batch.column("docs")[row].values,
                    "held_out": pa.array(~np.array(block["train"], dtype=bool)),
                    "n_tokens": pa.array(lens),
                    "n_known": pa.array(known + (ends > 0)),
                    "train_tokens": pa.array(np.full(n, n_all, dtype=np.int64)),
                    "base_score": pa.array(logs + end_mass - base_mass * lens),
                    "score": pa.array(parameters.log10(classes, lens) + logs - in_class),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return looked_up.mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
