"""Language identification by string kernels.

Texts are case-folded runs of letters joined by spaces. The blended-spectrum presence kernel of two texts is the number
of character n-grams (n = 1..4, hashed to 2^18 places) that both have, divided by the geometric mean of what each has.
A bounded sample of labelled documents (PER_LANGUAGE of each language) trains a one-versus-rest kernel ridge regression
on Nyström features of LANDMARKS landmarks. As the kernel is linear in a text's presence vector, landmarks, whitening and
ridge weights fold into one matrix of places by languages, and documents are scored by batched matrix products with it.
The matrix is bounded by the parameters (2^18 x languages) and is the only thing that tasks get from the driver.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, discard
from .tokens import let_go

#: Documents of each language to learn from, and documents in all (but one of each language at least), as bounds of the model.
PER_LANGUAGE, SAMPLE, LANDMARKS, RIDGE, ORDERS, PLACES = 300, 4096, 256, 1e-2, (1, 2, 3, 4), 1 << 18
_OTHER = re.compile(r"[\W\d_]+")
UNDECIDED, LEAST = "und", 0.05


def normalised(text: str | None) -> str:
    """Case-folded runs of letters, each between spaces; empty if there is no letter."""
    runs = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {runs} " if any(c.isalpha() for c in runs) else ""


def presence(text: str, out: np.ndarray) -> int:
    """Mark the n-grams of a normalised text in the zeroed array `out`; how many there are."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.zeros(len(c), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(c) < n:
            break
        h = h[: len(c) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            out[((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(46)] = 1
    return int(np.count_nonzero(out))


class Model:
    """labels: the languages in order. places: those with a weight. weights: places x languages; bias: by language."""

    def __init__(self, labels: list[str], places: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.labels, self.places, self.weights, self.bias = labels, places, weights, bias

    @classmethod
    def fit(cls, marks: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
        """Train on presence vectors (a row of packed bits each); landmarks are spread evenly over the languages in the
        order given. Vectors are unpacked a block of places at a time."""
        labels, n = sorted(set(langs)), len(langs)
        if not labels:
            return cls([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0))
        scale = 1 / np.sqrt(np.maximum(np.bitwise_count(marks).sum(1, dtype=np.int64), 1))
        places = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(marks, 0)))
        by = [[k for k, g in enumerate(langs) if g == lang] for lang in labels]
        each = max(1, landmarks // len(labels))
        pick = np.array([k for ks in by for k in ks[:each]])
        parts = [slice(k, k + 1024) for k in range(0, marks.shape[1], 1024)]
        kernel = np.zeros((n, len(pick)), np.float32)  # counts, exact
        for part in parts:
            x = np.unpackbits(marks[:, part], axis=1).astype(np.float32)
            kernel += x @ x[pick].T
        kernel = kernel * scale[:, None] * scale[pick]
        values, vectors = np.linalg.eigh(kernel[pick])
        keep = values > 1e-6 * max(values[-1], 1e-12)
        white = vectors[:, keep] / np.sqrt(values[keep])
        phi = kernel @ white
        y = np.array([[1.0 if g == lang else -1.0 for lang in labels] for g in langs])
        # every language weighs the same, however many documents it has
        w = np.array([n / (len(labels) * len(by[labels.index(g)])) for g in langs])[:, None]
        mean_phi, mean_y = (w * phi).sum(0) / w.sum(), (w * y).sum(0) / w.sum()
        a = (w * (phi - mean_phi)).T @ (phi - mean_phi) + ridge * n * np.eye(phi.shape[1])
        beta = np.linalg.solve(a, (w * (phi - mean_phi)).T @ (y - mean_y))
        of_mark = scale[pick][:, None] * (white @ beta)
        weights = np.concatenate([np.unpackbits(marks[pick, part], axis=1).T.astype(np.float64) @ of_mark for part in parts])
        return cls(labels, places, weights[places].astype(np.float32), mean_y - mean_phi @ beta)

    def predict(self, texts: list[str | None], batch: int = 16) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. The score is the softmax of the regressions (times 4), 0 if undecided."""
        out, scores = [], np.zeros(len(texts))
        marks = np.zeros(PLACES, np.uint8)
        for lo in range(0, len(texts), batch):
            part = [normalised(t) for t in texts[lo : lo + batch]]
            x, norm = np.zeros((len(part), len(self.places)), np.float32), np.ones(len(part), np.float32)
            for k, t in enumerate(part):
                if t:
                    marks[:] = 0
                    norm[k] = max(presence(t, marks), 1)
                    x[k] = marks[self.places]
            f = (x @ self.weights) / np.sqrt(norm)[:, None] + self.bias if self.labels else np.zeros((len(part), 0))
            for k, t in enumerate(part):
                if not t or not self.labels:
                    out.append(UNDECIDED)
                    continue
                e = np.exp(4 * (f[k] - f[k].max()))
                best = int(np.argmax(f[k]))
                out.append(self.labels[best])
                scores[lo + k] = float(e[best] / e.sum())
        return out, scores


def held_out() -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed presence vectors of whole texts; null for a text without a letter."""
    for batch in batches:
        out = []
        for text in batch.column(2):
            t, marks = normalised(text.as_py()), np.zeros(PLACES, np.uint8)
            out.append(zlib.compress(np.packbits(marks).tobytes(), 1) if t and presence(t, marks) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["lang", "k", "marks"])


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = SAMPLE) -> Model:
    """A model of a bounded sample: of each language the `per_language` documents with the least hash of doc_id, of those that
    are not held out, have a language and a letter, and at most `most` in all, but one of each language at least.

    The sample is chosen by ids and hashes alone; tasks then read the whole texts of the chosen ones, and the driver gets
    their presence vectors, of 32 KB each at most. Of equal hashes the least doc_id, then the least hash of the text comes
    first; rows that are equal in all three count once."""
    x = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out()).select("lang", "doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")).alias("h"), F.xxhash64("text").alias("tie"))
    each = min(per_language, max(1, most // max(x.agg(F.count_distinct("lang")).first()[0], 1)))
    chosen = x.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "tie"))).where(F.col("k") <= each)
    chosen = cut(chosen.groupBy("lang", "doc_id", "tie").agg(F.min("k").alias("k")), "chosen")
    same = F.col("d.lang").eqNullSafe(F.col("c.lang")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64("d.text") == F.col("c.tie"))
    sample = docs.select("lang", "doc_id", "text").alias("d").join(chosen.alias("c"), same).groupBy("c.lang", "c.k").agg(F.first("d.text").alias("text"))
    rows = sorted((r.lang, r.k, r.marks) for r in sample.mapInArrow(_marked, "lang string, k int, marks binary").where("marks is not null").collect())
    discard(chosen)
    marks = np.frombuffer(b"".join(zlib.decompress(r[2]) for r in rows), np.uint8).reshape(len(rows), PLACES // 8)
    return Model.fit(marks, [r[0] for r in rows])


def predicted(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`keep` (columns of docs) with the predicted language and its score, under `names`. Null texts and texts without a
    letter are `und`, score 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.select(*keep, F.col("text").alias("_text_")) if "text" not in keep else docs.select(*keep)
    text = "_text_" if "text" not in keep else "text"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                langs, scores = sent.value.predict(part.column(part.schema.get_field_index(text)).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in keep] + [pa.array(langs, pa.string()), pa.array(scores)], names=[*keep, *names])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return at.mapInArrow(score, f"{schema}{', ' * bool(keep)}{names[0]} string, {names[1]} double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model of the labelled documents not held out.

    Without labelled documents all are `und`. Rows that repeat a doc_id get their own rows; texts of any length are read
    whole; of languages with equal scores the first by name is predicted; an empty table gives an empty one."""
    return predicted(docs, train(docs), ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Documents, all columns as they are, of which the classifier knows the language: those go that are `und`, and those
    whose score is not above chance (one by the number of languages) by `least` of what is left to certainty, as texts
    in a script or language that it never saw. Without labelled documents there is no classifier, and only null texts and
    texts without a letter go. Rows that repeat a doc_id are judged on their own; an empty table gives an empty one."""
    cols, model = docs.columns, train(docs)
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    chance = 1 / len(model.labels)
    x = predicted(docs, model, cols, ("_nw_lang", "_nw_score"))
    return x.where((F.col("_nw_lang") != UNDECIDED) & (F.col("_nw_score") >= chance + least * (1 - chance) - 1e-9)).select(*cols)
