"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import lean

BUCKETS, DIM = 1 << 16, 16
#: Bounds of the training sample: documents, windows of each, code points of a window. Documented parameters of the model.
SAMPLE_DOCS, WINDOWS, WINDOW_CHARS = 2500, 4, 300
#: A share of sampled documents is kept from training and calibrates temperature and rejection.
CALIBRATION = 0.25
#: Rejected is a text whose best language is less likely than SLACK times what all but a share of FALSE_REJECTS of the
#: calibration documents have. Texts of fewer words than this are too short to be called foreign.
FALSE_REJECTS, SLACK, JUDGED_WORDS = 0.001, 0.9, 12
#: Foreign windows that training makes up for each real one.
FOREIGN = 1.0

#: ASCII letters stay, all other ASCII is a blank; bytes of other characters stay.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def subwords(text: str) -> np.ndarray:
    """Buckets of the 2- to 4-byte pieces of a text's words, word ends marked by a blank; none for a text without words."""
    words = text.lower().encode("utf-8", "replace").translate(LETTERS).split()
    if not words:
        return np.empty(0, np.int64)
    a = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    blank = a == 32
    two = a[:-1] * np.uint32(257) + a[1:]
    three = two[:-1] * np.uint32(65599) + a[2:]
    four = three[:-1] * np.uint32(65599) + a[3:]
    inner = ~blank[1:-2] & ~blank[2:-1]
    parts = (two, three[~blank[1:-1]], four[inner])
    return np.concatenate([((p + np.uint32(7919 * i)) * np.uint32(2654435761)) >> np.uint32(16) for i, p in enumerate(parts)])


def has_letter(text: str) -> bool:
    return bool(re.search("[A-Za-z]", text)) or any(c.isalpha() for c in text)


VOWELS = "aeiouy"
CONSONANTS = "bcdfghjklmnpqrstvwxz"


def foreign(text: str, draw: np.random.Generator) -> str:
    """A text that could be of a language nobody labelled: vowels go to vowels, consonants to consonants and other letters to
    letters of their own kind, each by a random map; so words keep their shape and lose their spelling."""
    others = sorted({c for c in text.lower() if c.isalpha() and ord(c) > 127})
    table = {}
    for kind in (VOWELS, CONSONANTS, others):
        for a, b in zip(kind, draw.permutation(list(kind)) if len(kind) else (), strict=True):
            table[ord(a)] = str(b)
    return text.lower().translate(table)


class Model(NamedTuple):
    labels: list[str]
    table: np.ndarray  # the embeddings times the output weights: a row of logits for each bucket; the last column is foreign text
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, buckets: np.ndarray) -> np.ndarray:
        total = np.zeros(self.table.shape[1], np.float64)
        for at in range(0, len(buckets), 1 << 18):
            total += self.table[buckets[at : at + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return total / max(1, len(buckets)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected); ("und", 0, True) for null, for no letters, and if nothing was learned."""
        if text is None or not self.labels or not has_letter(text):
            return "und", 0.0, True
        p = softmax(self.logits(subwords(text)) / self.temperature)
        best = int(p[:-1].argmax())
        rejected = p[best] < self.threshold and len(text.split(None, JUDGED_WORDS)) >= JUDGED_WORDS
        return self.labels[best], float(p[best]), bool(rejected)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(examples: list[tuple[int, str, str]], epochs: int = 4, rate: float = 0.5, seed: int = 11) -> Model:
    """A model from (document, language, text): SGD example by example, then temperature and threshold on kept-out documents.

    Beside the languages it learns made-up foreign text as a class of its own, which rejects and is never an answer.
    """
    labels = sorted({x[1] for x in examples})
    if not labels:
        return Model([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 1.0, 0.0)
    draw = np.random.default_rng(seed)
    kept_out = {d for d in sorted({x[0] for x in examples}) if draw.random() < CALIBRATION}
    code = {x: i for i, x in enumerate(labels)}
    texts = [(d, code[lang], text) for d, lang, text in examples]
    texts += [(d, len(labels), foreign(text, draw)) for d, _, text in texts if draw.random() < FOREIGN]
    data = [(d, y, *np.unique(subwords(text), return_counts=True), len(text.split())) for d, y, text in texts]
    data = [(d, y, u, (n / n.sum()).astype(np.float32), words) for d, y, u, n, words in data if len(u)]
    train = [x for x in data if x[0] not in kept_out] or data
    check = [x for x in data if x[0] in kept_out] or data
    emb = draw.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = draw.normal(0, 0.1, (DIM, len(labels) + 1)).astype(np.float32)
    bias = np.zeros(len(labels) + 1, np.float32)
    steps, total = 0, epochs * len(train)
    for _ in range(epochs):
        for i in draw.permutation(len(train)):
            _, y, u, w, _ = train[i]
            v = w @ emb[u]
            g = softmax(v @ out + bias)
            g[y] -= 1
            eta = np.float32(rate * (1 - steps / total))
            back = out @ g
            out -= eta * np.outer(v, g)
            bias -= eta * 0.1 * g
            emb[u] -= (eta * 10 * w)[:, None] * back
            steps += 1
    table = emb @ out
    z = np.array([w @ table[u] + bias for _, _, u, w, _ in check])
    y = np.array([x[1] for x in check])
    nll = lambda t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()
    temperature = min((float(t) for t in np.geomspace(0.05, 20, 61)), key=nll)
    # whole documents are judged, so what their windows give together is what the threshold is set by
    known = []
    for _, own in itertools.groupby(sorted(x for x in examples if x[0] in kept_out or not kept_out), key=lambda x: x[0]):
        parts = list(own)
        if sum(len(text.split()) for *_, text in parts) >= JUDGED_WORDS:
            buckets = np.concatenate([subwords(text) for *_, text in parts])
            known.append(softmax((table[buckets].mean(axis=0) + bias) / temperature)[code[parts[0][1]]] if len(buckets) else 1.0)
    threshold = SLACK * float(np.quantile(known, FALSE_REJECTS)) if known else 0.0
    return Model(labels, table, bias.astype(np.float64), temperature, threshold)


def training_sample(docs: DataFrame) -> list[tuple[int, str, str]]:
    """Windows of at most SAMPLE_DOCS labelled documents (those first by their id's hash), spread evenly over each text.

    The ids are chosen from the id column alone; their texts are then fetched by a join with that bounded list, and only
    windows reach the driver: SAMPLE_DOCS x WINDOWS x WINDOW_CHARS code points at most, whatever the input.
    """
    may = docs.where("text is not null and lang is not null and doc_id is not null").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    ids = may.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    step = F.floor(F.length("text") / WINDOWS).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda i: F.substring(F.col("text"), i * step + 1, F.least(F.greatest(step, F.lit(1)), F.lit(WINDOW_CHARS))))
    picked = may.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", parts.alias("parts"))).alias("x"))
    return sorted((r.doc_id, r.x.lang, part) for r in picked.collect() for part in r.x.parts)


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row, by a model that is fitted here if none is given.

    Only text and language of documents whose crc32(doc_id) mod 4 is not 2 are learned from; only the text is an input of a
    prediction, and all of it. Null texts and texts without a letter are "und" with score 0, and rejected. Other texts always
    have a learned language, and its probability against the other ones and against foreign text as the score; they are
    rejected if the score is under the model's threshold. Without labelled rows all is "und".
    A null doc_id is not held out. Equal rows come out as often as they come in; other columns are ignored.
    """
    model = model or fit(training_sample(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = zip(*(model.predict(x.as_py()) for x in batch.column(2)), strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(lean(run), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of docs, with all their columns, whose language is not rejected."""
    model = model or fit(training_sample(docs))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not model.predict(x.as_py())[2] for x in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
