"""Language identification with averaged hashed subword embeddings.

Each run of 2 to 4 UTF-8 bytes of the lower-cased text (white space is one
space, a space stands before and after the text) is hashed into a bucket; the
mean of the buckets' embeddings goes through a linear softmax.  Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows; for prediction their product is one small table of
class scores per bucket, sent to the tasks (with more
languages than dimensions: the two factors, so that what is sent hardly grows with them).

Scores are calibrated on sampled rows held back from training, whole texts and short spans of them: one temperature
that minimises their log loss, and a rejection threshold at the lower
``reject_share`` quantile of the scores of those predicted right, so at most
about that share of recognisable text is rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import WHITE, ascii_lower, saved, shipped

_SIZES = (2, 3, 4)
_PART = 1 << 20
_TO_SPACE = bytes.maketrans(WHITE.encode(), b" " * len(WHITE))
PREDICTION = "lang_pred string, score double, accepted boolean"


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray      # bucket x language, or bucket x dimension if there are more languages than dimensions
    head: np.ndarray | None  # dimension x language in that case
    bias: np.ndarray
    temperature: float
    threshold: float
    bits: int

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Class index and calibrated probability of each text."""
        means = np.zeros((len(texts), self.scores.shape[1]))
        for i, text in enumerate(texts):
            means[i] = self._mean_scores(text)
        return _best(means if self.head is None else means @ self.head, self.bias, self.temperature)

    def _mean_scores(self, text: bytes) -> np.ndarray:
        total, n = np.zeros(self.scores.shape[1]), 0
        for ids in subwords(text, self.bits):
            for at in range(0, len(ids), 1 << 15):
                total += self.scores[ids[at: at + (1 << 15)]].sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total / max(n, 1)


def _best(logits: np.ndarray, bias: np.ndarray, temperature: float) -> tuple[np.ndarray, np.ndarray]:
    z = (logits + bias) / temperature
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p.argmax(axis=1), p.max(axis=1)


def subwords(text: bytes, bits: int):
    """Bucket ids of all subwords, in parts of bounded size that together cover the whole text."""
    framed = b" " + ascii_lower(text).translate(_TO_SPACE) + b" "
    most = _SIZES[-1]
    for at in range(0, max(1, len(framed) - 1), _PART):
        raw = np.frombuffer(framed[at: at + _PART + most - 1], dtype=np.uint8).astype(np.uint32)
        code = raw.copy()
        ids = []
        for n in range(2, most + 1):
            code = code[:-1] | (raw[n - 1:] << np.uint32(8 * (n - 1)))
            own = code[:_PART] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            ids.append((own * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits))
            if len(code) < 2:
                break
        yield np.concatenate(ids)


def _spans(text: bytes, key: int) -> list[bytes]:
    """The whole text, and a few short spans of it at places set by ``key`` (so that short texts are learned too)."""
    words = text.split()
    out, rng = [text], np.random.default_rng(key)
    for n in (12, 5, 2):
        if len(words) > n:
            at = int(rng.integers(0, len(words) - n + 1))
            out.append(b" ".join(words[at: at + n]))
    return out


def labelled_features(rows: DataFrame, bits: int) -> DataFrame:
    """(key, lang, part, ids, counts) of the rows (key, lang, text): the distinct buckets of each text and span.

    ``ids`` (4-byte integers) and ``counts`` (4-byte floats) are packed arrays.
    """
    def extract(batches):
        for batch in batches:
            for key, lang, text in zip(*(batch.column(c) for c in ("key", "lang", "text")), strict=True):
                key, out = key.as_py(), []
                for span in _spans(text.as_py().encode(), key):
                    counts = np.zeros(1 << bits, dtype=np.int64)
                    for ids in subwords(span, bits):
                        counts += np.bincount(ids, minlength=1 << bits)
                    own = np.flatnonzero(counts)
                    out.append((own.astype(np.uint32).tobytes(), counts[own].astype(np.float32).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(out), pa.int64()), pa.array([lang.as_py()] * len(out), pa.string()),
                     pa.array(range(len(out)), pa.int32()), *(pa.array(v, pa.binary()) for v in zip(*out, strict=True))],
                    names=["key", "lang", "part", "ids", "counts"])
    return rows.mapInArrow(extract, "key long, lang string, part int, ids binary, counts binary")


def fit(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_langs: int, bits: int, *, dim: int = 16,
        epochs: int = 5, rate: float = 0.5, seed: int = 5) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Bucket scores (embeddings times softmax weights; with many languages the two apart) and bias, by plain SGD over the examples."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1.0, 1.0, (1 << bits, dim)).astype(np.float32) / dim
    out, bias = np.zeros((dim, n_langs), dtype=np.float32), np.zeros(n_langs, dtype=np.float32)
    steps, done = epochs * len(x), 0
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            ids, f = x[i]
            f = f / f.sum()
            lr = rate * (1 - done / steps)
            mean = f @ emb[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= lr * np.outer(mean, p)
            bias -= lr * p
            # the step of an embedding follows its share of the text; scaled so that long texts move rare buckets too
            emb[ids] -= (lr * len(ids) ** 0.5) * np.outer(f, back)
            done += 1
    return (emb @ out, None, bias) if n_langs <= dim else (emb, out, bias)


def calibrate(logits: np.ndarray, y: np.ndarray, bias: np.ndarray, reject_share: float) -> tuple[float, float]:
    """Temperature of least log loss, and the score under which a prediction is rejected."""
    if not len(y):
        return 1.0, 0.0
    def loss(t: float) -> float:
        z = (logits + bias) / t
        z -= z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())
    temperature = min(np.geomspace(0.1, 10, 41), key=loss)
    best, score = _best(logits, bias, temperature)
    right = np.sort(score[best == y])
    return float(temperature), float(right[int(reject_share * len(right))]) if len(right) else 0.0


def sampled(usable: DataFrame, rows_per_lang: int) -> DataFrame:
    """(key, lang, text): the ``rows_per_lang`` distinct texts of least hash of each language, each once however often it is there."""
    keys = saved(usable.select("lang", "key").distinct(), "langid-keys")
    sizes = keys.groupBy("lang").count()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    # only hashes that can be among the least are ranked: a few times rows_per_lang, whatever the language holds
    enough = F.least(F.lit(1.0), F.lit(3.0 * rows_per_lang + 100) / F.col("count")) * float(1 << 63)
    # one row a class of the model, which is on the driver with all its classes
    near = keys.join(F.broadcast(sizes), "lang").where(F.col("key") <= enough)
    chosen = near.withColumn("__nth", nth).where(F.col("__nth") <= rows_per_lang)
    # rows_per_lang keys a language at most; the planner chooses how to join them
    return usable.join(saved(chosen.select("lang", "key"), "langid-chosen"), ["lang", "key"]).groupBy("key", "lang").agg(F.min("text").alias("text"))


def train(labelled: DataFrame, *, rows_per_lang: int = 600, bits: int = 16, calibration_share: float = 0.25,
          reject_share: float = 0.001) -> Model | None:
    """A model from the rows (text, lang); null labels, null and letterless texts teach nothing.

    The sample is ``rows_per_lang`` distinct texts of each language, or all if
    it has fewer (chosen by a hash of the text, whole texts each); copies count
    once, and every language is learned, however rare.  The driver gets the
    distinct buckets of the sample only, at most ``2^bits`` for a text of any
    length; it grows with the number of languages, not of rows.
    Without any usable row there is no model (None).
    """
    usable = (labelled.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
              .select("text", "lang", F.shiftrightunsigned(F.xxhash64("text", F.lit("langid")), 1).alias("key")))
    x, y, held, langs = _examples(labelled_features(sampled(usable, rows_per_lang), bits), calibration_share)
    if not x:
        return None
    learn = [i for i, h in enumerate(held) if not h]
    scores, head, bias = fit([x[i] for i in learn], y[learn], len(langs), bits)
    check = [i for i, h in enumerate(held) if h]  # whole texts and short spans: short texts are not rejected for being short
    logits = np.array([c @ scores[ids] / c.sum() for ids, c in (x[i] for i in check)]).reshape(-1, scores.shape[1])
    logits = logits if head is None else logits @ head
    return Model(langs, scores, head, bias, *calibrate(logits, y[check], bias, reject_share), bits)


def _examples(features: DataFrame, calibration_share: float) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, list[bool], list[str]]:
    """(buckets and counts, class, held back?) of each example, in an order that does not depend on the partitions, and the classes."""
    found = sorted(((r.key, r.lang, r.part, r.ids, r.counts) for r in features.toLocalIterator()), key=lambda r: r[:3])
    langs = sorted({r[1] for r in found})
    aside = lambda key: (key >> 8) % 1000 < 1000 * calibration_share
    # a language whose few texts would all be held back learns from one of them
    taught = {r[1] for r in found if not aside(r[0])}
    needed = {}
    for r in found:
        if r[1] not in taught:
            needed.setdefault(r[1], r[0])
    once = set(needed.values())
    held = [aside(r[0]) and r[0] not in once for r in found]
    number = {lang: i for i, lang in enumerate(langs)}
    x = [(np.frombuffer(r[3], dtype=np.uint32), np.frombuffer(r[4], dtype=np.float32)) for r in found]
    return x, np.array([number[r[1]] for r in found], dtype=np.int64), held, langs


def predictor(docs: DataFrame, model: Model | None) -> Callable:
    """A function of a text column giving (lang_pred, score, accepted)."""
    model_of = shipped(docs.sparkSession, model)

    @F.arrow_udf(PREDICTION)
    def predict(texts: pa.Array, letters: pa.Array) -> pa.Array:
        known = model_of()
        lang, score, accepted = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        at = np.flatnonzero(letters.fill_null(False).to_numpy(zero_copy_only=False))
        if known is not None and len(at):
            own = texts.cast(pa.large_binary()).take(pa.array(at)).to_pylist()
            best, p = known.predict(own)
            for i, b in zip(at.tolist(), best.tolist(), strict=True):
                lang[i] = known.langs[b]
            score[at], accepted[at] = p, p >= known.threshold
        return pa.StructArray.from_arrays([pa.array(lang), pa.array(score), pa.array(accepted)],
                                          names=["lang_pred", "score", "accepted"])
    return lambda text: predict(text, text.rlike("\\p{L}"))


def identify(docs: DataFrame, model: Model | None, out: str = "__lang") -> DataFrame:
    """``docs`` with the struct column ``out`` (lang_pred, score, accepted) for each whole text.

    Null texts and texts without a letter are ``und`` with score 0, not
    accepted; so is every text if there is no model.  Other columns are not
    looked at.
    """
    return docs.withColumn(out, predictor(docs, model)(F.col("text")))


def keep_recognised(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose language is recognised; all columns are kept as they are."""
    return identify(docs, model, "__lang").where("__lang.accepted").select(*docs.columns)
