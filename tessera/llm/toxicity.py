"""A convolutional text classifier for toxicity, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stages
from .language_id import held_out
from .textkit import U, chunks, texts_of, words_of

BUCKETS = 1 << 15  # rows of the embedding; row BUCKETS stays zero and pads
DIM = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5)  # bytes of a word's beginnings that are hashed besides the whole word
LEARNER_ROWS = 2_000  # rows that one learner gets at least, so that few rows are not learnt in vain by many
LEARNERS = 256  # at once; they read all rows however many there are
_BLOCK = 1 << 16  # places whose responses are held at a time
_ROWS = 1 << 10  # embedding rows that are averaged together
_PAD = max(WIDTHS)  # rows of padding after each text: an empty text still spans one window


def _features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of each word (whole word and beginnings), with padding after each text; starts and sizes of the texts."""
    words = words_of(texts, full_lower=True, strip_punctuation=True)
    codes = [words.hash, *(words.beginnings(p) + U(p) for p in PREFIXES)]
    sizes = np.diff(words.first)
    starts = words.first[:-1] + _PAD * np.arange(len(sizes))
    rows = np.full((int(words.first[-1]) + _PAD * len(sizes), len(codes)), BUCKETS, np.int32)
    at = np.arange(int(words.first[-1])) + _PAD * words.owner()
    for k, c in enumerate(codes):
        rows[at, k] = ((c >> U(29)) % U(BUCKETS)).astype(np.int32)
    return rows, starts, sizes


@dataclass
class TextCnn:
    """Hashed word embeddings, filters of several widths, max pooling over the whole text, logistic output."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    @classmethod
    def start(cls, seed: int = 7) -> TextCnn:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.05, (BUCKETS + 1, DIM)).astype(np.float32)
        embedding[BUCKETS] = 0
        filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(embedding, filters, np.zeros(len(WIDTHS) * FILTERS, np.float32), rng.normal(0.5, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), -2.0)

    def _responses(self, x: np.ndarray) -> np.ndarray:
        """Filter responses at each place the widest filter fits, from the summed embeddings of the words."""
        out = np.empty((len(x) - _PAD + 1, len(WIDTHS) * FILTERS), np.float32)
        for k, f in enumerate(self.filters):
            r = x[: len(out)] @ f[0]
            for j in range(1, len(f)):
                r += x[j : j + len(out)] @ f[j]
            out[:, k * FILTERS : (k + 1) * FILTERS] = r
        return out

    def _peaks(self, rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each filter responds most in each text, and how much; a long text in blocks."""
        if len(rows) <= _BLOCK:
            r = self._responses(self.embedding[rows].sum(axis=1))
            place = np.stack([s + r[s : s + max(1, n)].argmax(axis=0) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)])
            return place, r[place, np.arange(r.shape[1])[None, :]]
        place = np.zeros((len(starts), len(WIDTHS) * FILTERS), np.int64)
        most = np.full(place.shape, -np.inf, np.float32)
        for i, (s, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
            end = s + max(1, n)
            for at in range(s, end, _BLOCK):
                r = self._responses(self.embedding[rows[at : min(end, at + _BLOCK) + _PAD - 1]].sum(axis=1))
                best = r.max(axis=0)
                place[i] = np.where(best > most[i], at + r.argmax(axis=0), place[i])
                most[i] = np.maximum(most[i], best)
        return place, most

    def fit(self, texts: list, labels: np.ndarray, epochs: int = 5, seed: int = 11) -> TextCnn:
        """Learn from texts in memory."""
        state, rng = Learning.start(self), np.random.default_rng(seed)
        for _ in range(epochs):
            state.learn(texts, labels, rng)
        return self

    def tables(self) -> np.ndarray:
        """Every embedding row through every filter place, so that scoring only adds looked-up rows."""
        return np.concatenate([self.embedding @ f[j] for f in self.filters for j in range(len(f))], axis=1)

    def score(self, texts: list, tables: np.ndarray) -> np.ndarray:
        rows, starts, sizes = _features(texts)
        parts = tables[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            parts += tables[rows[:, k]]
        n = len(rows) - _PAD + 1
        out, col = np.empty((n, len(WIDTHS) * FILTERS), np.float32), 0
        for k, w in enumerate(WIDTHS):
            r = parts[:n, col * FILTERS : (col + 1) * FILTERS].copy()
            for j in range(1, w):
                r += parts[j : j + n, (col + j) * FILTERS : (col + j + 1) * FILTERS]
            out[:, k * FILTERS : (k + 1) * FILTERS] = r
            col += w
        inside = np.zeros(n, bool)
        inside[np.concatenate([np.arange(s, s + max(1, c)) for s, c in zip(starts.tolist(), sizes.tolist(), strict=True)])] = True
        out[~inside] = -np.inf
        pooled = np.maximum(np.maximum.reduceat(out, starts, axis=0) + self.bias, 0)
        return 1 / (1 + np.exp(-np.clip(pooled @ self.weights + self.offset, -30, 30)))


@dataclass
class Learning:
    """A network with the squares of Adagrad."""

    network: TextCnn
    squares: dict[str, np.ndarray]

    @classmethod
    def start(cls, network: TextCnn) -> Learning:
        return cls(network, {k: np.full(v.shape, 1e-3, np.float32) for k, v in (("e", network.embedding), *_dense(network).items(), ("o", np.zeros(1)))})

    def learn(self, texts: list, labels: np.ndarray, rng: np.random.Generator, batch: int = 32, rate: float = 0.05, decay: float = 1e-4) -> int:
        """Adagrad on the log loss, once over the texts; the gradient passes only through the places that pooling chose.  The number of batches."""
        net, squares, labels = self.network, self.squares, np.asarray(labels, np.float32)
        dense = _dense(net)

        def step(name: str, grad: np.ndarray) -> None:
            squares[name] += grad * grad
            dense[name][...] -= rate * grad / np.sqrt(squares[name])

        whole, begin, count = _features(texts)
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            ids = order[a : a + batch]
            rows = np.concatenate([whole[begin[i] : begin[i] + count[i] + _PAD] for i in ids])
            sizes = count[ids]
            starts = np.cumsum(sizes + _PAD) - sizes - _PAD
            place, peak = net._peaks(rows, starts, sizes)
            pre = peak + net.bias
            pooled = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.offset, -30, 30)))
            err = (p - labels[ids]) / len(ids)
            to_pre = (err[:, None] * net.weights[None, :]) * (pre > 0)
            grad_w = pooled.T @ err + decay * net.weights
            touched_rows, touched = [], []
            for k, f in enumerate(net.filters):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                g, at = to_pre[:, own], place[:, own]
                grad_f = np.zeros_like(f)
                for j in range(len(f)):
                    grad_f[j] = np.einsum("nfd,nf->df", net.embedding[rows[at + j]].sum(axis=2), g)
                    touched_rows.append(rows[at + j].reshape(-1, rows.shape[1]))
                    touched.append((g[:, :, None] * f[j].T[None, :, :]).reshape(-1, DIM))
                step(f"f{k}", grad_f + decay * f)
            step("b", to_pre.sum(axis=0))
            step("w", grad_w)
            squares["o"] += float(err.sum()) ** 2
            net.offset -= rate * float(err.sum()) / float(squares["o"][0]) ** 0.5
            at_rows, inverse = np.unique(np.concatenate(touched_rows), return_inverse=True)
            inverse = inverse.reshape(-1, rows.shape[1])
            grad_e, every = np.zeros((len(at_rows), DIM), np.float32), np.concatenate(touched)
            for k in range(rows.shape[1]):
                np.add.at(grad_e, inverse[:, k], every)
            grad_e[at_rows == BUCKETS] = 0
            squares["e"][at_rows] += grad_e * grad_e
            net.embedding[at_rows] -= rate * grad_e / np.sqrt(squares["e"][at_rows])
        return -(-len(order) // batch)

    def copy(self) -> Learning:
        n = self.network
        return Learning(TextCnn(n.embedding.copy(), [f.copy() for f in n.filters], n.bias.copy(), n.weights.copy(), n.offset), {k: v.copy() for k, v in self.squares.items()})

    def words(self) -> np.ndarray:
        """A row for each row of the embedding, with its squares."""
        return np.concatenate([self.network.embedding, self.squares["e"]], axis=1)

    def rest(self) -> np.ndarray:
        """Everything else in one row."""
        dense = _dense(self.network)
        return np.concatenate([*(v.ravel() for v in dense.values()), *(self.squares[k].ravel() for k in dense), [self.network.offset], self.squares["o"]]).astype(np.float32)[None, :]

    def moved(self, words: dict[int, tuple[np.ndarray, np.ndarray]], rest: np.ndarray) -> Learning:
        """The state after these changes of some rows of words() and of rest()."""
        out, at = self.copy(), 0
        for ids, change in words.values():
            out.network.embedding[ids] += change[:, :DIM]
            out.squares["e"][ids] += change[:, DIM:]
        dense = _dense(out.network)
        for v in (*dense.values(), *(out.squares[k] for k in dense)):
            v += rest[0, at : at + v.size].reshape(v.shape)
            at += v.size
        out.network.offset += float(rest[0, at])
        out.squares["o"] += rest[0, at + 1]
        return out


def _dense(network: TextCnn) -> dict[str, np.ndarray]:
    """The arrays that every batch changes."""
    return {**{f"f{k}": f for k, f in enumerate(network.filters)}, "b": network.bias, "w": network.weights}


@dataclass
class ToxicityModel:
    network: TextCnn
    thresholds: dict[str, float]  # by language
    default: float


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score above which marking gives the best F1; 0.5 without a positive."""
    if not labels.any():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    hit = np.cumsum(labels[order])
    f1 = 2 * hit / (np.arange(1, len(order) + 1) + labels.sum())
    k = int(f1.argmax())
    after = scores[order[k + 1]] if k + 1 < len(order) else 0.0
    return float((scores[order[k]] + after) / 2)


def learning_round(rows: DataFrame, state: Learning, number: int) -> Learning:
    """One pass over all rows(text, toxic): each partition learns its own from the same state, and the changes are averaged.

    A row of the embedding takes the mean over the learners that met it, by their
    batches.  The mean is made in the cluster, so the driver gets one network.
    """
    shared = rows.sparkSession.sparkContext.broadcast(state)

    def learn(frames):
        own, learner, batches = shared.value.copy(), TaskContext.get().partitionId(), 0
        rng = np.random.default_rng((11, number, learner))
        for part in chunks(frames):
            batches += own.learn(texts_of(part["text"]), part["toxic"].to_numpy(int), rng)
        if batches:
            before = shared.value
            change = own.words() - before.words()
            ids = np.flatnonzero((own.squares["e"] != before.squares["e"]).any(axis=1)).astype(np.int32)
            for block in np.unique(ids // _ROWS).tolist():
                some = ids[ids // _ROWS == block]
                yield pd.DataFrame({"block": [block], "learner": [learner], "batches": [batches], "ids": [some.tobytes()], "change": [change[some].tobytes()]})
            yield pd.DataFrame({"block": [-1], "learner": [learner], "batches": [batches], "ids": [np.zeros(1, np.int32).tobytes()], "change": [(own.rest() - before.rest()).tobytes()]})

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("learner")
        ids = [np.frombuffer(x, np.int32) for x in frame["ids"]]
        every = np.unique(np.concatenate(ids))
        total, weight = None, np.zeros(len(every))
        for own, change, n in zip(ids, frame["change"], frame["batches"], strict=True):
            change = np.frombuffer(change, np.float32).reshape(len(own), -1)
            total = np.zeros((len(every), change.shape[1])) if total is None else total
            at = np.searchsorted(every, own)
            total[at] += change * float(n)
            weight[at] += n
        out = (total / weight[:, None]).astype(np.float32)
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "ids": [every.tobytes()], "change": [out.tobytes()]})

    changes = rows.select("text", "toxic").mapInPandas(learn, "block int, learner int, batches long, ids binary, change binary")
    found = changes.groupBy("block").applyInPandas(mean, "block int, ids binary, change binary").collect()
    shared.destroy()
    got = {r["block"]: (ids := np.frombuffer(r["ids"], np.int32), np.frombuffer(r["change"], np.float32).reshape(len(ids), -1)) for r in found}
    if not got:
        return state
    rest = got.pop(-1)[1]
    return state.moved(got, rest)


def thresholds(scored: DataFrame) -> tuple[dict[str, float], float]:
    """For scored(lang, score, toxic): best_threshold of every language with a positive, and over all rows, from counts by score.

    Scores are counted down within steps of their logit and, over the steps of a
    language, from the sums of the steps, so that no task gets a whole language.
    """
    stages = Stages(scored.sparkSession, "thresholds")
    groups = F.array(F.struct(F.lit(True).alias("every"), F.lit("").alias("lang")), F.struct(F.lit(False).alias("every"), F.col("lang")))
    inner = F.least(F.greatest(F.col("score"), F.lit(1e-13)), F.lit(1 - 1e-13))
    rows = scored.select(F.explode(groups).alias("g"), "score", "toxic", F.floor(F.ln(inner / (1 - inner)) * 256).cast("int").alias("step")).filter("g.lang is not null")
    by = stages.keep(rows.groupBy("g.every", "g.lang", "step", "score").agg(F.count("*").alias("n"), F.sum("toxic").alias("hit")), "scores")
    group, step = Window.partitionBy("every", "lang"), Window.partitionBy("every", "lang", "step").orderBy(F.desc("score"))
    steps = by.groupBy("every", "lang", "step").agg(F.sum("n").alias("sn"), F.sum("hit").alias("sh"), F.max("score").alias("top"))
    down = group.orderBy(F.desc("step"))
    steps = steps.select("every", "lang", "step", (F.sum("sn").over(down) - F.col("sn")).alias("n0"), (F.sum("sh").over(down) - F.col("sh")).alias("hit0"), F.sum("sh").over(group).alias("total"), F.coalesce(F.lead("top").over(down), F.lit(0.0)).alias("below"))
    sums = by.join(steps.filter("total > 0"), ["every", "lang", "step"]).select("every", "lang", "score", "total", (F.col("n0") + F.sum("n").over(step)).alias("marked"), (F.col("hit0") + F.sum("hit").over(step)).alias("hits"), F.coalesce(F.lead("score").over(step), "below").alias("after"))
    f1 = 2 * F.col("hits") / (F.col("marked") + F.col("total"))
    best = sums.groupBy("every", "lang").agg(F.max_by((F.col("score") + F.col("after")) / 2, F.struct(f1, "score")).alias("t")).collect()
    stages.drop()
    return {r["lang"]: r["t"] for r in best if not r["every"]}, next((r["t"] for r in best if r["every"]), 0.5)


def train(docs: DataFrame, labels: DataFrame, epochs: int = 5) -> ToxicityModel | None:
    """Fit on all labelled rows that are not held out, each with its whole text; None if both labels do not occur.

    The rows stay in the cluster: in every epoch each partition learns its rows
    from the same network and the networks are averaged, see learning_round.  A
    quarter of the ids, by hash, calibrates one threshold per language instead; a
    language without positives there takes the threshold over all.  Of labels
    repeating an id the greatest counts; every row of documents with that id is learnt.
    Labels are never broadcast, as they grow with the documents.
    """
    known = labels.filter(F.col("toxic").cast("int").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang").join(known.hint("merge"), "doc_id")
    own = own.withColumns({"mixed": F.xxhash64("doc_id"), "checks": F.xxhash64("doc_id").bitwiseAND(F.lit(3)) == 0})
    stages = Stages(docs.sparkSession, "toxicity")
    rows = stages.keep(own.sortWithinPartitions("mixed", "doc_id", "text", "lang").select("text", "lang", "toxic", "checks"), "rows")
    sizes = {(r["toxic"], r["checks"]): r["n"] for r in rows.groupBy("toxic", "checks").agg(F.count("*").alias("n")).collect()}
    if len({toxic for toxic, _ in sizes}) < 2:
        return None
    learnt = rows.filter("not checks").coalesce(max(1, min(LEARNERS, sum(n for (_, checks), n in sizes.items() if not checks) // LEARNER_ROWS)))
    state = Learning.start(TextCnn.start())
    for number in range(epochs):
        state = learning_round(learnt, state, number)
    model = ToxicityModel(state.network, {}, 0.5)
    scored = _scored(rows.filter("checks").select("text", "lang", "toxic"), model, "lang string, toxic int, score double")
    by, default = thresholds(scored)
    stages.drop()
    return ToxicityModel(state.network, by, default)


def _scored(rows: DataFrame, model: ToxicityModel, schema: str) -> DataFrame:
    """The other columns of rows(text, ...) with the score of the text."""
    shared = rows.sparkSession.sparkContext.broadcast((model.network, model.network.tables()))

    def run(frames):
        network, tables = shared.value
        for part in chunks(frames):
            yield part.drop(columns="text").assign(score=network.score(texts_of(part["text"]), tables).astype(float))

    return rows.mapInPandas(run, schema)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, score in 0..1 from the text alone, and flagged: the score against its language's threshold.

    Null or empty texts get the score of a text without words; without a model
    every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, model.network.tables() if model else None))

    def run(frames):
        own, tables = shared.value
        for part in chunks(frames):
            texts = texts_of(part["text"])
            score = own.network.score(texts, tables).astype(float) if own else np.zeros(len(texts))
            limit = np.array([own.thresholds.get(x, own.default) if own else 1.1 for x in part["lang"]])
            yield pd.DataFrame({"doc_id": part["doc_id"], "score": score, "flagged": score >= limit})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").mapInPandas(run, "doc_id long, score double, flagged boolean")
