"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Every word of a window is an input vector: how much oftener toxic training
documents hold the word itself (word input), its first characters and its
character 4-grams (character inputs), and its length. Two gated recurrent
layers read the window forward and backward, attention weighs the words, and
the pooled state gives the window's logit. All windows of a text are scored,
each overlapping the next; the text's score is that of its worst window.

Trained in numpy on the driver, on a bounded sample of labelled rows: at most
``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` rows (in order of a hash of their ids) whose
texts have at most ``TRAIN_CHARS`` characters; longer ones are never cut for
it. The documents' worst windows are chosen anew before each epoch. Training
inputs are cross-fitted: the frequencies that a document sees come from the
other folds, as those of a new document do. Labels, language, source and id
are no inputs.

Defined cases: null and empty texts, and those without letters or digits, get
the score of a window without words; repeated rows are scored each; without
labelled rows of both kinds every score is the share of toxic rows (0 without
any); no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.strategy import write_table
from .ngram_join import BASE, POWERS, mixed, normalised

TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 2000, 4000, 8000
BUCKETS = 1 << 18
FOLDS = 5
WINDOW, STRIDE = 64, 48
HIDDEN, ATTENTION = 8, 8
EPOCHS, BATCH, RATE = 8, 64, 0.01
INPUTS = 5
PRIOR = 1.0  # a bucket's frequencies start as if it had been seen so often
SEGMENT = 1 << 20
STEP_WINDOWS = 2048
SEED = 11
TABLES = ("word", "head", "gram")


def buckets_of(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of a text's words, in segments: (bucket of the word, of its head, of each 4-gram, word of each 4-gram, length)."""
    at = 0
    while at < len(text):
        to = text.find(b" ", at + SEGMENT)
        to = len(text) if to < 0 else to
        data = np.frombuffer(b" " + text[at:to] + b" ", np.uint8)
        at = to + 1
        gaps = np.flatnonzero(data == 32)
        starts, ends = gaps[:-1] + 1, gaps[1:]
        up, down = POWERS.upto(len(data))
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=run[1:])
        word = (run[ends] - run[starts]) * down[starts]
        stop = np.minimum(starts + 4, ends)
        head = (run[stop] - run[starts]) * down[starts] + BASE
        four = data[: len(data) - 3].astype(np.uint64)
        for k in range(1, 4):
            four = four << np.uint64(8) | data[k : len(data) - 3 + k]
        owner = np.cumsum(data == 32)[: len(four)] - 1
        whole = np.arange(len(four)) + 4 <= ends[np.minimum(owner, len(ends) - 1)]
        whole &= data[: len(four)] != 32
        mask = np.uint64(BUCKETS - 1)
        yield ((mixed(word) & mask).astype(np.int64), (mixed(head) & mask).astype(np.int64), (mixed(four[whole] * BASE) & mask).astype(np.int64),
               owner[whole], ends - starts)


def inputs_of(text: bytes, tables: dict[str, np.ndarray]) -> np.ndarray:
    """A row of inputs for each word."""
    parts = []
    for word, head, gram, owner, length in buckets_of(text):
        x = np.zeros((len(word), INPUTS), np.float32)
        x[:, 0], x[:, 1] = tables["word"][word], tables["head"][head]
        if len(gram):
            score = tables["gram"][gram]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            x[owner[first], 2] = np.maximum.reduceat(score, first)
            x[owner[first], 3] = np.add.reduceat(score, first) / np.diff(np.concatenate([first, [len(owner)]]))
        x[:, 4] = np.minimum(length, 20) / 10
        parts.append(x)
    return np.concatenate(parts) if parts else np.zeros((0, INPUTS), np.float32)


def windows_of(words: int) -> np.ndarray:
    """Starts of the windows; the last one ends with the text or beyond it."""
    return np.arange(0, max(words - (WINDOW - STRIDE), 1), STRIDE)


def laid_out(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, window, input) and the words of each window."""
    size = np.minimum(len(x) - starts, WINDOW)
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    inside = at < len(x)
    out = np.zeros((WINDOW, len(starts), INPUTS), np.float32)
    out[inside] = x[at[inside]]
    return out, size


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    """Parameters by name; each direction has w (inputs), u (state) and b for update, reset and candidate."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, rng: np.random.Generator) -> Network:
        p = {}
        for d in ("f", "b"):
            p[f"w{d}"] = rng.normal(0, 0.3, (INPUTS, 3 * HIDDEN))
            p[f"u{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            p[f"b{d}"] = np.zeros(3 * HIDDEN)
        p |= {"a": rng.normal(0, 0.3, (2 * HIDDEN, ATTENTION)), "ab": np.zeros(ATTENTION), "av": rng.normal(0, 0.3, ATTENTION),
              "o": rng.normal(0, 0.3, 2 * HIDDEN), "ob": np.full(1, -1.0)}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def recur(self, x: np.ndarray, d: str, steps: list | None = None) -> np.ndarray:
        """States (time, window, hidden) of one direction; ``steps`` gets what the way back needs."""
        w, u, b, h3 = self.p[f"w{d}"], self.p[f"u{d}"], self.p[f"b{d}"], HIDDEN
        own = x @ w + b
        out = np.empty((*x.shape[:2], h3), np.float32)
        h = np.zeros((x.shape[1], h3), np.float32)
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            state = h @ u
            gates = sigmoid(own[t, :, : 2 * h3] + state[:, : 2 * h3])
            update, reset = gates[:, :h3], gates[:, h3:]
            new = np.tanh(own[t, :, 2 * h3 :] + reset * state[:, 2 * h3 :])
            if steps is not None:
                steps.append((t, h, update, reset, new, state[:, 2 * h3 :]))
            h = new + update * (h - new)
            out[t] = h
        return out

    def attend(self, h: np.ndarray, size: np.ndarray):
        """(logit, weights, tanh of the keys, pooled state)."""
        keys = np.tanh(h @ self.p["a"] + self.p["ab"])
        score = keys @ self.p["av"]
        score[np.arange(len(h))[:, None] >= size] = -1e9
        score = np.exp(score - score.max(axis=0))
        score[np.arange(len(h))[:, None] >= size] = 0
        weight = score / np.maximum(score.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weight, h)
        return pooled @ self.p["o"] + self.p["ob"][0], weight, keys, pooled

    def logits(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.attend(np.concatenate([self.recur(x, "f"), self.recur(x, "b")], axis=2), size)[0]

    def gradients(self, x: np.ndarray, size: np.ndarray, y: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        steps = {"f": [], "b": []}
        h = np.concatenate([self.recur(x, d, steps[d]) for d in "fb"], axis=2)
        logit, weight, keys, pooled = self.attend(h, size)
        d_logit = ((sigmoid(logit) - y) * importance / len(y)).astype(np.float32)
        g = {"o": pooled.T @ d_logit, "ob": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["o"]
        d_h = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tbh,bh->tb", h, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["av"] = np.einsum("tb,tba->a", d_score, keys)
        d_keys = d_score[:, :, None] * self.p["av"] * (1 - keys**2)
        g["a"], g["ab"] = np.einsum("tbh,tba->ha", h, d_keys), d_keys.sum(axis=(0, 1))
        d_h = d_h + d_keys @ self.p["a"].T
        for k, d in enumerate("fb"):
            w, u = self.p[f"w{d}"], self.p[f"u{d}"]
            g[f"w{d}"], g[f"u{d}"], g[f"b{d}"] = np.zeros_like(w), np.zeros_like(u), np.zeros(3 * HIDDEN, np.float32)
            back = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, before, update, reset, new, state in reversed(steps[d]):
                back = back + d_h[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                d_new = back * (1 - update) * (1 - new**2)
                d_update = back * (before - new) * update * (1 - update)
                d_reset = d_new * state * reset * (1 - reset)
                d_own = np.concatenate([d_update, d_reset, d_new], axis=1)
                d_state = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                g[f"w{d}"] += x[t].T @ d_own
                g[f"b{d}"] += d_own.sum(axis=0)
                g[f"u{d}"] += before.T @ d_state
                back = back * update + d_state @ u.T
        return g


@dataclass
class Model:
    """``scale`` and ``shift`` turn the worst window's logit into the score; a network of None scores ``share``."""

    tables: dict[str, np.ndarray]
    network: Network | None
    scale: float = 1.0
    shift: float = 0.0
    share: float = 0.0

    def worst(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(largest logit of each text's windows, first word of that window)."""
        best, where = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        held, width = [], 0

        def flush():
            nonlocal held, width
            if held:
                x = np.concatenate([h[1] for h in held], axis=1)
                logit = self.network.logits(x, np.concatenate([h[2] for h in held]))
                at = 0
                for i, part, _, starts in held:
                    own = logit[at : at + part.shape[1]]
                    at += part.shape[1]
                    k = int(own.argmax())
                    if own[k] > best[i]:
                        best[i], where[i] = own[k], starts[k]
            held, width = [], 0

        for i, text in enumerate(texts):
            x = inputs_of(text, self.tables)
            starts = windows_of(len(x))
            for a in range(0, len(starts), STEP_WINDOWS):
                part, size = laid_out(x, starts[a : a + STEP_WINDOWS])
                held.append((i, part, size, starts[a : a + STEP_WINDOWS]))
                width += part.shape[1]
                if width >= STEP_WINDOWS:
                    flush()
        flush()
        return best, where

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.network is None:
            return np.full(len(texts), self.share), np.zeros(len(texts), np.int64)
        logit, where = self.worst(texts)
        return sigmoid(self.scale * logit + self.shift), where


def counted(docs: list[dict[str, np.ndarray]], labels: np.ndarray, folds: np.ndarray) -> dict[str, np.ndarray]:
    """(fold, label, bucket) document frequencies for each table."""
    out = {t: np.zeros((FOLDS, 2, BUCKETS), np.float32) for t in TABLES}
    for doc, y, f in zip(docs, labels, folds, strict=True):
        for t in TABLES:
            out[t][f, y, doc[t]] += 1
    return out


def log_odds(counts: np.ndarray, toxic: float) -> np.ndarray:
    """How much oftener toxic documents hold each bucket; 0 for one that was never seen."""
    share = (counts[1] + PRIOR * toxic) / (counts[0] + PRIOR * (1 - toxic))
    return np.log(share * (1 - toxic) / toxic).astype(np.float32)


def calibrate(logit: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit (Newton steps with a small ridge)."""
    x, beta = np.stack([logit, np.ones(len(y))], axis=1), np.array([1.0, 0.0])
    for _ in range(25):
        p = sigmoid(x @ beta)
        grad = x.T @ (importance * (p - y)) + 0.1 * (beta - [1.0, 0.0])
        hess = (x * (importance * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        beta -= np.linalg.solve(hess, grad)
    return float(max(beta[0], 0.05)), float(beta[1])


def fit(texts: list[bytes], labels: np.ndarray, toxic_share: float | None = None, seed: int = SEED) -> Model:
    """Train on whole texts with labels 0 and 1; ``toxic_share``: of all labelled rows, where the sample's differs."""
    labels = np.asarray(labels, np.int64)
    toxic = float(labels.mean()) if len(labels) else 0.0
    share = toxic if toxic_share is None else toxic_share
    if not 0 < toxic < 1:
        return Model({}, None, share=share)
    rng = np.random.default_rng(seed)
    folds = np.arange(len(texts)) % FOLDS
    seen = []
    for text in texts:
        parts = list(buckets_of(text))
        seen.append({t: np.unique(np.concatenate([p[k] for p in parts])).astype(np.int32) if parts else np.zeros(0, np.int32) for k, t in enumerate(TABLES)})
    counts = counted(seen, labels, folds)
    del seen
    rates = [float(labels[folds != f].mean()) if (folds != f).any() else toxic for f in range(FOLDS)]
    tables = [{t: log_odds(counts[t].sum(axis=0) - counts[t][f], min(max(rates[f], 1e-3), 1 - 1e-3)) for t in TABLES} for f in range(FOLDS)]
    x = [inputs_of(text, tables[f]) for text, f in zip(texts, folds, strict=True)]
    # Sampled rows count as often as they stand for in all labelled rows.
    importance = np.where(labels == 1, share / toxic, (1 - share) / (1 - toxic)) if 0 < share < 1 else np.ones(len(labels))
    gentle = np.sqrt(importance / importance.min())

    laid = [laid_out(v, windows_of(len(v))) for v in x]
    doc = np.repeat(np.arange(len(x)), [p.shape[1] for p, _ in laid])
    every, size = np.concatenate([p for p, _ in laid], axis=1), np.concatenate([s for _, s in laid])
    docs = len(x)
    del x, laid, tables
    network = Network.new(rng)
    model = Model({}, network, share=share)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    hope = every[:, :, :3].sum(axis=2).max(axis=0)  # before the first epoch: the window with the most telling word
    n = 0
    for epoch in range(EPOCHS + 1):
        if epoch:
            hope = np.concatenate([network.logits(every[:, a : a + STEP_WINDOWS], size[a : a + STEP_WINDOWS]) for a in range(0, len(doc), STEP_WINDOWS)])
        order = np.lexsort((-hope, doc))
        chosen = order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])]
        if epoch == EPOCHS:
            break
        extra = rng.choice(len(doc), len(chosen) // 2)
        chosen = np.concatenate([chosen, extra[labels[doc[extra]] == 0]])
        chosen = rng.permutation(chosen)
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for a in range(0, len(chosen), BATCH):
            k = chosen[a : a + BATCH]
            n += 1
            for name, grad in network.gradients(every[:, k], size[k], labels[doc[k]].astype(np.float32), gentle[doc[k]]).items():
                grad = np.clip(grad, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad**2
                step = rate * (first[name] / (1 - 0.9**n)) / (np.sqrt(second[name] / (1 - 0.99**n)) + 1e-6)
                network.p[name] = (network.p[name] - step).astype(np.float32)
    worst = np.full(docs, -np.inf)
    np.maximum.at(worst, doc, hope)
    model.scale, model.shift = calibrate(worst, labels, importance)
    model.tables = {t: log_odds(counts[t].sum(axis=0), toxic) for t in TABLES}
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_toxic: int = TRAIN_TOXIC, most_clean: int = TRAIN_CLEAN, most_chars: int = TRAIN_CHARS) -> Model:
    """Fit on the bounded sample; rows that are held out and rows without a label or text take no part."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    if not totals:
        return Model({}, None)
    # Of rows that qualify alone, so that long texts don't take places in the sample.
    short = docs.where(F.length(text_col) <= most_chars).select(F.col(id_col).alias("doc"))
    fitting = write_table(marked.join(short, F.col("id") == F.col("doc"), "left_semi"), "labelled")
    picked = None
    for y, most in ((1, most_toxic), (0, most_clean)):
        part = fitting.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    # At most most_toxic + most_clean ids, so they can be sent to every task.
    found = docs.where(F.length(text_col) <= most_chars).select(F.col(id_col).alias("doc"), normalised(F.col(text_col)).alias("text"))
    rows = found.join(F.broadcast(picked), F.col("doc") == F.col("id")).groupBy("id", "y").agg(F.min("text").alias("text"))
    sample = rows.orderBy(F.xxhash64("id"), "id").toPandas()
    if sample["y"].nunique() < 2:
        # Without a text a label tells nothing; with texts of both kinds there must be a network.
        given = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"))
        kinds = {r["y"] for r in marked.join(given, F.col("id") == F.col("doc"), "left_semi").select("y").distinct().collect()}
        if len(kinds) == 2:
            raise ValueError(f"documents of both labels exist, but not with texts of at most {most_chars} characters")
    return fit([t.encode() for t in sample["text"]], sample["y"].to_numpy(np.int64), totals.get(1, 0) / sum(totals.values()))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with columns toxic_score and toxic_word (where the worst window starts, in words), instead of own ones of these names."""
    names = [c for c in docs.columns if c.lower() not in ("toxic_score", "toxic_word")]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_word", T.LongType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            value, where = model.scores(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(value), pa.array(where)], names=[*names, "toxic_score", "toxic_word"])

    # Numbered columns, so that none of the table's can clash with the normalised text.
    given = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], normalised(F.col(text_col)).cast("binary").alias("words"))
    return given.mapInArrow(scored, schema)


def clean_documents(docs: DataFrame, model: Model, threshold: float = 0.5, **options) -> DataFrame:
    """The documents whose score is under the threshold, with their own columns."""
    kept = score(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(options.pop("text_col", "text")).alias("text")), model)
    return kept.where(F.col("toxic_score") < threshold).select("doc.*")
