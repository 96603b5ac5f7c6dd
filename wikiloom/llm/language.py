"""Language mixtures: proportions by expectation-maximisation, languages by penalised likelihood.

The model is a table of byte-trigram probabilities per language, counted over
all learning documents. A document is a sequence of stretches of text, each in
one of its languages; the likelihood of a stretch is that of its trigrams.
Expectation-maximisation finds the proportions. Sets of languages are tried by
size, most likely ones first, and the one with the best penalised likelihood
stays: a language must explain enough text to pay for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16
#: Most languages of a model, which bounds it (half a megabyte each).
MAX_LANGUAGES = 400
STRETCH = 48  # bytes
SMOOTHING = 0.5
ROUNDS = 12
#: A language's price in log likelihood is this times the logarithm of the number of stretches (and 2).
PENALTY = 2.0
#: Bytes that a task looks at together.
POOL = 1 << 19
NOT_LETTERS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalpha()), b" " * (128 - 52))
UNKNOWN = "und"


def letters(text: str) -> np.ndarray:
    """Bytes of the lower-case text; ASCII that is no letter counts as a space."""
    return np.frombuffer(b" " + text.lower().encode(errors="replace").translate(NOT_LETTERS) + b" ", np.uint8)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of each three consecutive bytes."""
    wide = data.astype(np.uint32)
    return ((((wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def count_trigrams(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows of ``docs`` with a text and a ``lang``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lang not in counts:
                    counts[lang] = np.zeros(BUCKETS, np.int64)
                np.add.at(counts[lang], trigrams(letters(text.as_py())), 1)
        for lang, table in counts.items():
            full = np.nonzero(table)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(full), pa.string()), pa.array(full), pa.array(table[full])],
                                             ["lang", "bucket", "n"])

    known = docs.where("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return known.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each bucket in each."""
    found = count_trigrams(docs).toPandas()  # at most BUCKETS rows a language
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; a model holds {MAX_LANGUAGES}")
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    counts[found["bucket"], np.searchsorted(languages, found["lang"])] += found["n"]
    return languages, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def proportions(likelihood: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages of each document, and its log likelihood.

    ``likelihood``: log likelihood of each stretch in each language; ``starts``:
    where the documents begin.
    """
    lengths = np.diff(np.r_[starts, len(likelihood)])
    owner = np.repeat(np.arange(len(starts)), lengths)
    top = likelihood.max(axis=1, keepdims=True)
    ratio = np.exp(likelihood - top, dtype=np.float64) + 1e-300
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = ratio * share[owner]
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, starts) / lengths[:, None]
    fit = np.add.reduceat(np.log((ratio * share[owner]).sum(axis=1)) + top[:, 0], starts)
    return share, fit


def select_languages(likelihood: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions of each document's languages, those of the set with the best penalised likelihood."""
    n_docs, n_langs = len(starts), likelihood.shape[1]
    lengths = np.diff(np.r_[starts, len(likelihood)])
    single = np.add.reduceat(likelihood.astype(np.float64), starts)
    share = np.zeros((n_docs, n_langs))
    share[np.arange(n_docs), single.argmax(axis=1)] = 1.0
    best = single.max(axis=1)
    full, _ = proportions(likelihood, starts, np.ones((n_docs, n_langs)))
    order = np.argsort(-full, axis=1, kind="stable")
    price = PENALTY * np.log(lengths + 1.0)
    open_ = np.nonzero(lengths > 1)[0]
    for size in range(2, n_langs + 1):
        # Another language can pay only if it has some text at all.
        open_ = open_[full[open_, order[open_, size - 1]] * lengths[open_] > 0.5]
        if not len(open_):
            break
        allowed = np.zeros((len(open_), n_langs))
        np.put_along_axis(allowed, order[open_, :size], 1.0, axis=1)
        rows = np.concatenate([np.arange(starts[d], starts[d] + lengths[d]) for d in open_])
        tried, fit = proportions(likelihood[rows], np.r_[0, np.cumsum(lengths[open_])[:-1]], allowed)
        fit -= (size - 1) * price[open_]
        better = fit > best[open_]
        share[open_[better]], best[open_[better]] = tried[better], fit[better]
    return share


def predict(docs: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score, mixture``, one row per row of ``docs``.

    ``lang_pred`` has the largest share, ``score`` is that share, ``mixture`` a
    map of the selected languages' shares. A text that is null or has no letter
    is ``und`` with score 0 and an empty mixture; so is every text if no
    language was learned.
    """
    model = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, mixtures = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, [[] for _ in range(batch.num_rows)]
            pool: list[tuple[int, np.ndarray]] = []
            held = 0
            for at, text in enumerate(batch.column("text")):
                text = text.as_py()
                if languages and has_letter(text):
                    data = letters(text)
                    marks = np.arange(0, len(data) - 2, STRETCH)
                    pool.append((at, np.add.reduceat(model.value[trigrams(data)], marks)))
                    held += len(data)
                if pool and (held >= POOL or at == batch.num_rows - 1):
                    starts = np.r_[0, np.cumsum([len(x) for _, x in pool])[:-1]]
                    for (row, _), share in zip(pool, select_languages(np.concatenate([x for _, x in pool]), starts)):
                        names[row], scores[row] = languages[share.argmax()], min(float(share.max()), 1.0)
                        mixtures[row] = [(languages[i], float(share[i])) for i in np.nonzero(share > 1e-6)[0]]
                    pool, held = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(mixtures, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "mixture"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType()))])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, by ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, mixture``: learn from all folds but 0, predict every row.

    A row with a null ``doc_id`` is in no fold, so it is not learned from and
    counts as held out. Repeated rows are learned from and predicted each.
    """
    number = fold(F.col("doc_id"), folds)
    languages, table = learn(docs.where(number != 0))
    predicted = predict(docs, languages, table)
    held_out = F.coalesce(number == 0, F.lit(True))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "mixture")
