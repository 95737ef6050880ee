"""Toxicity by compression distance.

One zstandard dictionary is trained on toxic text and one on ordinary text. A window of words that
the toxic dictionary, put before the ordinary one, makes shorter than the ordinary one alone looks
toxic. How much the windows of a document gain gives its score, by a calibrated logistic curve.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.shared import row_schema, text_slices, whole_row

WINDOW_WORDS = 24
THRESHOLD = 0.7
LEVEL = 6
#: Size of the dictionary of ordinary text, and of that of what only toxic text has.
ORDINARY_BYTES, TOXIC_BYTES = 112 << 10, 2 << 10
#: Most labelled documents that the dictionaries and the curve are fitted to, and longest of them.
TOXIC_SAMPLE, ORDINARY_SAMPLE, CURVE_SAMPLE = 800, 2_500, 4_000
SAMPLE_BYTES = 256 << 10
#: Letters of the parts by which words of the toxic sample are told apart, and the least contrast.
PART, CONTRAST = 5, 8.0


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def windows(text: bytes, size: int = WINDOW_WORDS) -> list[bytes]:
    """Consecutive words of the text, in lower case; one empty window for a text without words."""
    words = text.lower().split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)] or [b""]


def _parts(word: bytes) -> set[bytes]:
    framed = b" " + word + b" "
    return {framed[i : i + PART] for i in range(max(1, len(framed) - PART + 1))}


def _telling_words(own: list[bytes], other: list[bytes]) -> list[bytes]:
    """Words of the first texts with a part that is much rarer in the second ones.

    They are the samples that a dictionary for the first texts alone is trained on.
    """
    counts = [Counter(w for t in texts for w in set(t.lower().split())) for texts in (own, other)]
    parts = [Counter(), Counter()]
    for into, words in zip(parts, counts, strict=True):
        for word, n in words.items():
            for part in _parts(word):
                into[part] += n
    least = CONTRAST * (len(own) + 1) / (len(other) + 1)
    telling = {p for p, n in parts[0].items() if n >= 5 and (n + 0.5) / (parts[1][p] + 0.5) > least}
    return [b" " + w + b" " for w, n in sorted(counts[0].items()) if not telling.isdisjoint(_parts(w)) for _ in range(n)]


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


@dataclass
class Model:
    """Two dictionaries and a logistic curve. Plain values, so it goes to the tasks as it is."""

    toxic: bytes = b""
    ordinary: bytes = b""
    centre: np.ndarray = field(default_factory=lambda: np.zeros(7))
    scale: np.ndarray = field(default_factory=lambda: np.ones(7))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(8))

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False
        )
        made = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            if len(content) < 8:
                made.append(zstandard.ZstdCompressor(compression_params=settings))
                continue
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            made.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))
        return made[0], made[1]

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack(((features - self.centre) / self.scale, np.ones(len(features))))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


def features(text: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> list[float]:
    """What the toxic dictionary gains over the windows of a whole text."""
    parts = windows(text)
    gains = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in parts])
    top = np.sort(gains)[::-1]
    return [
        float(top[0]), float(top[:3].mean()), float(gains.mean()), float((gains >= 2).mean()),
        float((gains >= 4).mean()), float((gains <= -2).mean()), math.log(len(parts)),
    ]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps on the penalised likelihood."""
    weights = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, x.T @ (p - y) + ridge * weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(toxic: list[bytes], ordinary: list[bytes], curve: list[tuple[int, bytes]]) -> Model:
    """Dictionaries from the first two samples, the curve from the third. Without both kinds of
    text the model scores every text with the share of toxic ones in the third, or zero."""
    model = Model()
    if toxic and ordinary:
        model.toxic = _trained(TOXIC_BYTES, _telling_words(toxic, ordinary))
        model.ordinary = _trained(ORDINARY_BYTES, [w for t in ordinary for w in windows(t, 8)])
    y = np.array([float(label) for label, _ in curve])
    if not curve:
        model.weights[-1] = -40.0
        return model
    pair = model.compressors()
    x = np.array([features(t, *pair) for _, t in curve])
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic(np.column_stack(((x - model.centre) / model.scale, np.ones(len(x)))), y)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from labelled rows that are not held out.

    The ids with the smallest hashes are taken, up to a fixed number of each kind, and their texts
    up to a fixed length collected: a bounded sample. Of several labels of an id the toxic one
    counts; null labels and ids don't. Equal texts count once.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    known = known.filter(~held_out(F.col(id_col))).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(8), id_col)
    # Three times the wanted number, as an id may have no document or an equal one.
    some = [
        known.filter("toxic = 1").orderBy(order).limit(3 * (TOXIC_SAMPLE + CURVE_SAMPLE // 2)),
        known.filter("toxic = 0").orderBy(order).limit(3 * (ORDINARY_SAMPLE + CURVE_SAMPLE)),
    ]
    ids = F.broadcast(some[0].unionByName(some[1]).select(F.col(id_col).alias("_id"), "toxic"))
    named = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text"))
    named = named.filter(F.octet_length("text") <= SAMPLE_BYTES)
    found = named.join(ids, F.col("_doc") == F.col("_id")).select("toxic", "text", F.xxhash64(F.lit(8), "_doc").alias("at"))
    wanted = {1: TOXIC_SAMPLE + CURVE_SAMPLE // 2, 0: ORDINARY_SAMPLE + CURVE_SAMPLE}
    parts = [found.filter(F.col("toxic") == k).orderBy("at", "text").limit(n) for k, n in wanted.items()]
    seen: dict[str, int] = {}
    for row in parts[0].unionByName(parts[1]).orderBy("at", "text").collect():
        seen.setdefault(row.text, row.toxic)
    kinds: dict[int, list[bytes]] = {0: [], 1: []}
    for text, kind in seen.items():
        kinds[kind].append(text.encode())
    # Dictionaries take at most half of each kind; the curve needs texts that they have not seen.
    first = {k: min(n, len(kinds[k]) // 2) for k, n in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))}
    rest = [(k, t) for k in (0, 1) for t in kinds[k][first[k] :]]
    return train(kinds[1][: first[1]], kinds[0][: first[0]], rest)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the input's columns) and ``score`` from 0 to 1 for every row, by its whole text.

    Null and empty texts have one empty window. Equal texts have equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        pair = own.compressors()
        for batch in batches:
            for part, texts in text_slices(batch, text_col):
                x = np.array([features(t, *pair) for t in texts])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(own.score(x))], ["row", "score"])

    return docs.select(whole_row(docs)).mapInArrow(run, row_schema(docs, "score double"))


def rejected(threshold: float = THRESHOLD) -> Column:
    return F.col("score") >= threshold


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, whose score is under the threshold."""
    model = fit(docs, labels, id_col, text_col)
    return score(docs, model, text_col).filter(~rejected()).select("row.*")
