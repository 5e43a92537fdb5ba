"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A word's input is the embedding of the word, if frequent, and the mean embedding of its character 3-grams and 5-grams, so it is
worked out once for each distinct word. A text is read in overlapping windows, each from fresh states in both directions, in
training and in scoring alike. A text's score is that of its worst window, and training, too, follows the worst of the
windows of each labelled text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.storage import frugal, give_back_driver

#: Words in a window, and from one window's start to the next in training and in scoring.
WINDOW, TRAIN_STRIDE, STRIDE = 32, 24, 4
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 8, 8, 8
VOCABULARY, LEAST_DOCS, NGRAM_BITS = 4096, 8, 14
#: Labelled texts of each class that a model is fitted on at most.
TOXIC_ROWS, CLEAN_ROWS = 1000, 2000
#: Labelled texts of more bytes are not fitted on, so that the driver holds a bounded amount; all texts are scored.
FIT_BYTES = 1 << 16
#: Epochs, but so many more for few texts that the least number of steps is done; rows of a step; learning rate; and the
#: share of words that a step sees by their characters only.
EPOCHS, STEPS, BATCH, RATE, DROP = 10, 500, 128, 0.01, 0.3
THRESHOLD = 0.7
_SCORE = "__toxicity_score"
_BLOCK_WORDS, _KNOWN_WORDS, _WINDOWS, _SCORED = 400_000, 150_000, 4096, 1024
_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of letters."""
    return (text or "").lower().encode().translate(_TABLE).split()


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character 3-grams and 5-grams of ^word$ for all words, by word, and how many each word has."""
    raw = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint32)
    length = np.array([len(w) for w in words], np.int64)
    if not len(raw):
        return np.empty(0, np.int64), length
    starts = np.cumsum(length + 2) - (length + 2)
    codes, owner = [], []
    for n in (3, 5):
        sizes = np.maximum(length + 3 - n, 0)
        at = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        code = np.full(len(at), n, np.uint32)
        for j in range(n):
            code = (code ^ raw[at + j]) * np.uint32(16777619)
        code ^= code >> np.uint32(15)
        codes.append((code * np.uint32(2654435761)) >> np.uint32(32 - NGRAM_BITS))
        owner.append(np.repeat(np.arange(len(words)), sizes))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(codes)[order].astype(np.int64), np.bincount(owner, minlength=len(words))


def windows(codes: np.ndarray, pad: int, stride: int = TRAIN_STRIDE) -> np.ndarray:
    """Windows of a text's words, one from every stride-th word on, up to its end; a text of no words has none."""
    if not len(codes):
        return np.empty((0, WINDOW), np.int32)
    count = 1 + max(0, -(-(len(codes) - WINDOW) // stride))
    out = np.full((count - 1) * stride + WINDOW, pad, np.int32)
    out[: len(codes)] = codes
    return np.lib.stride_tricks.sliding_window_view(out, WINDOW)[::stride]


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices values[start : start + size], joined."""
    ends = np.cumsum(size)
    return values[np.arange(int(size.sum())) + np.repeat(start - (ends - size), size)]


def _sigmoid(x):
    return np.float32(0.5) + np.float32(0.5) * np.tanh(np.float32(0.5) * x)


@dataclass
class Model:
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(vocabulary: dict[bytes, int], seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        inputs = WORD_DIM + CHAR_DIM
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return Model(vocabulary, {
            "word": draw(len(vocabulary) + 1, WORD_DIM, scale=0.05), "char": draw(1 << NGRAM_BITS, CHAR_DIM, scale=0.05),
            "wx": draw(2, inputs, 3 * HIDDEN, scale=inputs**-0.5), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32), "u": draw(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "wa": draw(2 * HIDDEN, ATTENTION, scale=0.25), "ba": np.zeros(ATTENTION, np.float32), "va": draw(ATTENTION, scale=0.35), "wo": draw(2 * HIDDEN, scale=0.25), "bo": np.full(1, -2, np.float32),
        })

    def features(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the vocabulary (its size: none) of each word, its character n-grams, and how many."""
        index = np.array([self.vocabulary.get(w, len(self.vocabulary)) for w in words], np.int32)
        found = [ngrams(words[low : low + 20_000]) for low in range(0, len(words), 20_000)]
        codes, sizes = zip(*found, strict=True) if found else ((np.empty(0, np.int64),), (np.empty(0, np.int64),))
        return index, np.concatenate([c.astype(np.int32) for c in codes]), np.concatenate(sizes)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        return self.embedded(self.features(words))

    def embedded(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """A row for each distinct word, and one of zeros for padding."""
        index, codes, sizes = features
        chars = np.zeros((len(index), CHAR_DIM), np.float32)
        ends = np.cumsum(sizes)
        for low in range(0, len(index), 20_000):
            some = sizes[low : low + 20_000]
            begin = ends[low] - sizes[low]
            part = self.p["char"][codes[begin : begin + int(some.sum())]]
            chars[low : low + len(some)] = np.add.reduceat(part, np.cumsum(some) - some, axis=0) / some[:, None].astype(np.float32)
        out = np.zeros((len(index) + 1, WORD_DIM + CHAR_DIM), np.float32)
        out[:-1, :WORD_DIM] = np.where((index < len(self.vocabulary))[:, None], self.p["word"][index], np.float32(0))
        out[:-1, WORD_DIM:] = chars
        return out

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        return np.stack([inputs @ self.p["wx"][d] + self.p["b"][d] for d in range(2)])

    def forward(self, projected: np.ndarray, windows_: np.ndarray, keep: bool = False):
        """Logits of windows, given by indices of distinct words; the last index is padding."""
        p, n, pad = self.p, len(windows_), projected.shape[1] - 1
        both = np.stack([windows_, windows_[:, ::-1]])
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((WINDOW, 2, n, HIDDEN), np.float32)
        saved = []
        for t in range(WINDOW):
            at = both[:, :, t]
            x = np.stack([projected[0][at[0]], projected[1][at[1]]])
            g = h @ p["u"]
            zr = _sigmoid(x[..., : 2 * HIDDEN] + g[..., : 2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            new = np.tanh(x[..., 2 * HIDDEN :] + r * g[..., 2 * HIDDEN :])
            real = (at != pad)[..., None]
            after = np.where(real, new + z * (h - new), h)
            if keep:
                saved.append((h, z, r, new, g[..., 2 * HIDDEN :], real))
            h = states[t] = after
        hidden = np.concatenate((states[:, 0], states[::-1, 1]), axis=-1)  # [time, window, 2 * HIDDEN]
        act = np.tanh(hidden @ p["wa"] + p["ba"])
        weight = act @ p["va"]
        weight = np.where((windows_ != pad).T, weight, np.float32(-30))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, hidden)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (both, saved, hidden, act, weight, pooled)) if keep else logit

    def logits(self, projected: np.ndarray, windows_: np.ndarray) -> np.ndarray:
        """forward() for many windows: those of like length together, without steps over padding."""
        size = (windows_ != projected.shape[1] - 1).sum(axis=1)
        order, out = np.argsort(size, kind="stable")[::-1], np.empty(len(windows_), np.float32)
        at = 0
        while at < len(order):
            own = order[at : at + _SCORED]
            own = own[size[own] == size[own[0]]]
            out[own] = self._of_length(projected, windows_[own, : size[own[0]]])
            at += len(own)
        return out

    def _of_length(self, projected: np.ndarray, windows_: np.ndarray) -> np.ndarray:
        p, (n, length) = self.p, windows_.shape
        codes = np.ascontiguousarray(windows_.T)
        hidden = np.empty((length, n, 2 * HIDDEN), np.float32)
        h, x = np.zeros((2, n, HIDDEN), np.float32), np.empty((2, n, 3 * HIDDEN), np.float32)
        for t in range(length):
            np.take(projected[0], codes[t], axis=0, out=x[0], mode="clip")
            np.take(projected[1], codes[length - 1 - t], axis=0, out=x[1], mode="clip")
            g = h @ p["u"]
            g[..., : 2 * HIDDEN] += x[..., : 2 * HIDDEN]
            zr = _sigmoid(g[..., : 2 * HIDDEN])
            new = zr[..., HIDDEN:] * g[..., 2 * HIDDEN :]
            new += x[..., 2 * HIDDEN :]
            np.tanh(new, out=new)
            h -= new
            h *= zr[..., :HIDDEN]
            h += new
            hidden[t, :, :HIDDEN], hidden[length - 1 - t, :, HIDDEN:] = h[0], h[1]
        act = hidden @ p["wa"]
        act += p["ba"]
        weight = np.tanh(act, out=act) @ p["va"]
        weight = np.exp(weight - weight.max(axis=0))
        return ((hidden @ p["wo"]) * weight).sum(axis=0) / weight.sum(axis=0) + p["bo"][0]

    def gradient(self, projected: np.ndarray, inputs: np.ndarray, windows_: np.ndarray, error: np.ndarray, kept: tuple):
        """Gradients of the parameters but the embeddings, and of the input rows, for errors of the logits."""
        p, (both, saved, hidden, act, weight, pooled) = self.p, kept
        out = {"wo": pooled.T @ error, "bo": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * p["wo"]
        d_hidden = weight[..., None] * d_pooled
        d_weight = np.einsum("nh,tnh->tn", d_pooled, hidden)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_act = d_score[..., None] * p["va"] * (1 - act**2)
        out |= {"va": np.einsum("tn,tna->a", d_score, act), "wa": np.einsum("tnh,tna->ha", hidden, d_act), "ba": d_act.sum(axis=(0, 1))}
        d_hidden = d_hidden + d_act @ p["wa"].T
        d_states = np.stack((d_hidden[..., :HIDDEN], d_hidden[::-1, :, HIDDEN:]), axis=1)
        d_u = np.zeros_like(p["u"])
        d_projected = np.zeros_like(projected)
        d_h = np.zeros_like(saved[0][0])
        for t in reversed(range(WINDOW)):
            h, z, r, new, inner, real = saved[t]
            d = d_h + d_states[t]
            d_new = d * (1 - z) * (1 - new**2)
            d_z = d * (h - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_x = np.concatenate((d_z, d_r, d_new), axis=-1) * real
            d_g = np.concatenate((d_z, d_r, d_new * r), axis=-1) * real
            d_h = np.where(real, d * z, d) + d_g @ p["u"].transpose(0, 2, 1)
            d_u += h.transpose(0, 2, 1) @ d_g
            for way in range(2):
                np.add.at(d_projected[way], both[way, :, t], d_x[way])
        d_projected[:, -1] = 0
        out |= {"u": d_u, "b": d_projected.sum(axis=1, keepdims=True), "wx": np.stack([inputs.T @ d_projected[w] for w in range(2)])}
        return out, sum(d_projected[w] @ p["wx"][w].T for w in range(2))


def _log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Evidence of a feature that so many toxic and clean texts have."""
    a, b = toxic + np.float32(0.5), clean + np.float32(0.5)
    return ((np.log(a / (n_toxic + 1)) - np.log(b / (n_clean + 1))) * (a + b) / (a + b + 20)).astype(np.float32)  # rare ones prove little


def train(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Fit a model to labelled texts (1: toxic). The same input gives the same model."""
    y = np.array(labels, np.float32)
    sides = (Counter(), Counter())
    distinct: dict[bytes, int] = {}
    codes = []
    for text, label in zip(texts, labels, strict=True):
        codes.append(np.array([distinct.setdefault(w, len(distinct)) for w in words_of(text)], np.int32))
        sides[int(label)].update(np.unique(codes[-1]).tolist())
    words, pad = list(distinct), len(distinct)
    del distinct
    count = sides[0] + sides[1]
    frequent = sorted((w for w in count if count[w] >= LEAST_DOCS), key=lambda w: (-count[w], words[w]))[:VOCABULARY]
    model = Model.fresh({words[w]: i for i, w in enumerate(frequent)}, seed)
    n = (int(y.sum()), int(len(y) - y.sum()))
    whole = index, grams, sizes = model.features(words)
    starts = np.cumsum(sizes) - sizes
    char_sides = np.zeros((2, 1 << NGRAM_BITS), np.float32)
    for c, label in zip(codes, labels, strict=True):
        own = np.unique(c)
        char_sides[int(label)][np.unique(gather(grams, starts[own], sizes[own]))] += 1
    del words, index, grams, sizes
    # first coordinates start as evidence, so that the first worst windows are sensible ones
    if len(frequent):
        model.p["word"][: len(frequent), 0] = _log_odds(*(np.array([sides[k][w] for w in frequent], np.float32) for k in (1, 0)), *n) / 2
    model.p["char"][:, 0] = _log_odds(char_sides[1], char_sides[0], *n) / 2
    parts = [windows(c, pad, TRAIN_STRIDE) for c in codes]
    usable = [i for i, w in enumerate(parts) if len(w)]
    if not usable or not n[0] or not n[1]:
        return model
    every = np.concatenate([parts[i] for i in usable])
    owner = np.repeat(np.arange(len(usable)), [len(parts[i]) for i in usable])
    begins = np.searchsorted(owner, np.arange(len(usable)))
    goal = y[usable]
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    epochs = max(EPOCHS, -(-STEPS * BATCH // (len(goal) + int((goal == 0).sum()))))
    inputs = model.embedded(whole)
    evidence = np.sort((inputs[:, 0] + inputs[:, WORD_DIM])[every], axis=1)[:, -6:].sum(axis=1)
    score = evidence
    for epoch in range(epochs):
        if epoch:
            projected = model.projected(model.embedded(whole))
            score = np.concatenate([model.forward(projected, every[i : i + _WINDOWS]) for i in range(0, len(every), _WINDOWS)])
        order = np.lexsort((-score, owner))
        worst = order[begins]
        picked, aims = [worst], [goal]
        clean = np.flatnonzero(goal == 0)
        other = begins[clean] + (rng.random(len(clean)) * np.diff(np.append(begins, len(every)))[clean]).astype(np.int64)
        picked.append(other)
        aims.append(np.zeros(len(other), np.float32))
        picked, aims = np.concatenate(picked), np.concatenate(aims)
        shuffle = rng.permutation(len(picked))
        for at in range(0, len(shuffle), BATCH):
            some = shuffle[at : at + BATCH]
            local, where = np.unique(every[picked[some]], return_inverse=True)
            if local[-1] != pad:
                local = np.append(local, pad)
            own = local[:-1]
            view = where.reshape(len(some), WINDOW).astype(np.int32)
            index, gram_sizes = whole[0][own], whole[2][own]
            gram_codes = gather(whole[1], starts[own], gram_sizes)
            inputs = model.embedded((index, gram_codes, gram_sizes))
            left = (rng.random((len(own), 1)) >= DROP).astype(np.float32)  # without some words, characters are learned too
            inputs[:-1, :WORD_DIM] *= left
            projected = model.projected(inputs)
            logit, kept = model.forward(projected, view, keep=True)
            error = ((_sigmoid(logit) - aims[some]) / len(some)).astype(np.float32)
            grads, d_inputs = model.gradient(projected, inputs, view, error, kept)
            d_inputs[:-1, :WORD_DIM] *= left
            d_word = np.zeros_like(model.p["word"])
            known = index < len(model.vocabulary)
            np.add.at(d_word, index[known], d_inputs[:-1][known, :WORD_DIM])
            d_char = np.zeros_like(model.p["char"])
            spread = d_inputs[:-1, WORD_DIM:] / np.maximum(gram_sizes, 1)[:, None].astype(np.float32)
            np.add.at(d_char, gram_codes, np.repeat(spread, gram_sizes, axis=0))
            grads |= {"word": d_word, "char": d_char}
            step += 1
            rate = RATE * (1 - epoch / epochs) * min(1, step / 20)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                model.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def scores(model: Model, texts) -> np.ndarray:
    """The score of each text; words are worked out once for each block of texts."""

    def block() -> np.ndarray:
        projected = model.projected(model.inputs(list(words)))
        out = np.full(len(codes), model.p["bo"][0], np.float64)
        parts = [windows(c, len(words), STRIDE) for c in codes]
        counts = np.array([len(w) for w in parts])
        has = np.flatnonzero(counts)
        if len(has):
            found = model.logits(projected, np.concatenate(parts))
            out[has] = np.maximum.reduceat(found, (np.cumsum(counts) - counts)[has])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    found: list[np.ndarray] = []
    words: defaultdict[bytes, int] = defaultdict(int)
    words.default_factory = words.__len__
    codes: list[np.ndarray] = []
    size = 0
    for text in texts:
        own = words_of(text)
        codes.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
        size += len(own)
        if size >= _BLOCK_WORDS or len(words) >= _KNOWN_WORDS:
            found.append(block())
            words.clear()
            codes, size = [], 0
    if codes:
        found.append(block())
    return np.concatenate(found) if found else np.empty(0)


def _scorer(model: Model):
    def run(batches):
        for batch in batches:
            found = scores(model, (t.as_py() for t in batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, _SCORE])

    return run


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs and the column _SCORE."""
    kinds = T.StructType([*docs.schema.fields, T.StructField(_SCORE, T.DoubleType())])
    return docs.mapInArrow(frugal(_scorer(model)), kinds)


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """A model from labelled documents: labels (doc_id, toxic), at most so many of each class, chosen by hashed doc_id.

    Labels of one doc_id count once, as the highest; of several texts of a doc_id the one of least hash is used. The
    chosen ids, a bounded number, are broadcast, so the documents are not shuffled, and texts over FIT_BYTES are left
    out, so the driver holds at most (toxic_rows + clean_rows) * FIT_BYTES. Null ids, labels and unlabelled documents
    are left out. Without both classes the model is that of its first random weights.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    key = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = marked.where("toxic = 1").orderBy(*key).limit(toxic_rows).union(marked.where("toxic = 0").orderBy(*key).limit(clean_rows))
    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES)
    rows = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    model = train([r["text"] for r in rows], [r["toxic"] for r in rows])
    del rows
    give_back_driver(docs.sparkSession)  # else it holds what training freed through all that follows
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, score (0 to 1, of the worst window), predicted (1 from THRESHOLD).

    One map over the texts, each read whole. Null texts and texts without words get the score of no evidence. Null and
    repeated doc_ids: a result for each row; equal texts get equal scores. Other columns are not read. An empty table
    gives an empty result.
    """
    out = _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", F.col(_SCORE).alias("score"), (F.col(_SCORE) >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that score() predicts 0 for, with all their columns; edge cases as there."""
    return _scored(docs, model).where(F.col(_SCORE) < THRESHOLD).drop(_SCORE)
