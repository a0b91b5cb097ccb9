"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_BYTES bytes. Every passage of the whole
text is encoded as the frequencies of byte-class pairs and of distinct n-grams, and
then by a learned layer. Gated attention gives each passage a weight inside its
document; the weighted sum of the passage codes is scored. Only documents carry
labels: encoder, attention and score are learned from them together.

The model is fitted on a bounded sample (SAMPLE_ROWS labelled documents) on the
driver and is a few thousand numbers; scoring is one pass without a shuffle.

Defined results: null and empty texts are one empty passage and get a score like any
other. The share of label 1 among all labelled rows corrects the balanced sample.
Without labelled rows of both kinds every score is that share (0.5 without any).
Rows keep their order of columns; extra columns travel along untouched in `keep` and
`keep_unrejected`, which drops nothing without a fitted model.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import column_bytes, text_or_empty

PASSAGE_BYTES = 512
SAMPLE_ROWS = 3_000
FOLDS, HELD_OUT = 4, 2
PREDICT_AT = 0.7
# Below it a document is likelier bad than good.
REJECT_BELOW = 0.5
CODE = 16
ATTENTION = 8
EPOCHS = 120
# Documents are encoded together up to so many bytes, longer ones alone in parts.
BLOCK_BYTES = 1 << 19

# Byte classes: fixed values, by what a byte is in UTF-8 text.
_GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b"\r\n",
    b".,;:",
    b"!?",
    b"'\"()-",
    b"|/\\<>=_{}[]+~^`@",
    b"#$%&*",
    bytes(range(0x80, 0x100)),
]
_CLASS = np.full(256, len(_GROUPS), dtype=np.int64)
for _i, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _i
CLASSES = len(_GROUPS) + 1
_SLOTS = 512
FEATURES = CLASSES * CLASSES + 3


def _block_features(data: np.ndarray, passage: np.ndarray, count: int) -> np.ndarray:
    """Features of the passages 0..count-1 that own the bytes."""
    size = np.bincount(passage, minlength=count).astype(np.float64)
    kinds = _CLASS[data]
    pair = passage[:-1] * (CLASSES * CLASSES) + kinds[:-1] * CLASSES + kinds[1:]
    inside = passage[:-1] == passage[1:]
    pairs = np.bincount(pair[inside], minlength=count * CLASSES * CLASSES)
    pairs = pairs.reshape(count, -1) / np.maximum(size, 1)[:, None]
    # Distinct runs of eight bytes, by the share of hash slots that they fill.
    filled = np.zeros(count)
    if len(data) >= 8:
        n = len(data) - 7
        value = np.zeros(n, dtype=np.uint32)
        for j in range(8):
            value = value * np.uint32(0x01000193) + data[j : j + n]
        value ^= value >> np.uint32(15)
        slot = (value * np.uint32(0x9E3779B1)) >> np.uint32(23)
        taken = np.zeros(count * _SLOTS, dtype=bool)
        own = passage[:n] == passage[7:]
        taken[(passage[:n] * _SLOTS + slot)[own]] = True
        filled = taken.reshape(count, _SLOTS).sum(axis=1)
    expected = _SLOTS * (1 - np.exp(-np.maximum(size - 7, 0) / _SLOTS))
    distinct = np.where(expected > 0, filled / np.maximum(expected, 1e-9), 1.0)
    return np.column_stack([np.sqrt(pairs), distinct, size / PASSAGE_BYTES, size == 0])


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of passages per text."""
    counts = np.array([max(1, -(-len(t) // PASSAGE_BYTES)) for t in texts], dtype=np.int64)
    out = []
    held: list[bytes] = []
    owner: list[int] = []  # bytes of each passage in the block
    block = 0

    def flush() -> None:
        data = np.frombuffer(b"".join(held), dtype=np.uint8)
        passage = np.repeat(np.arange(len(owner)), owner)
        out.append(_block_features(data, passage, len(owner)).astype(np.float32))

    for text in texts:
        for start in range(0, max(1, len(text)), BLOCK_BYTES):
            part = text[start : start + BLOCK_BYTES]
            held.append(part)
            full, rest = divmod(len(part), PASSAGE_BYTES)
            owner += [PASSAGE_BYTES] * full + ([rest] if rest or not full else [])
            block += len(part)
            if block >= BLOCK_BYTES:
                flush()
                held, owner, block = [], [], 0
    if owner:
        flush()
    features = np.concatenate(out) if out else np.empty((0, FEATURES), dtype=np.float32)
    return features, counts


@dataclass
class Model:
    """Encoder, gated attention and score of a bag."""

    mean: np.ndarray
    scale: np.ndarray
    encoder: np.ndarray
    content: np.ndarray
    gate: np.ndarray
    attention: np.ndarray
    output: np.ndarray
    bias: float

    def forward(self, features: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        x = (features - self.mean) / self.scale
        x = np.column_stack([x, np.ones(len(x), dtype=x.dtype)])
        code = np.tanh(x @ self.encoder)
        content = np.tanh(code @ self.content)
        gate = 1 / (1 + np.exp(-(code @ self.gate)))
        raw = (content * gate) @ self.attention
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        weight = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        weight /= np.add.reduceat(weight, starts)[bag]
        mixed = np.add.reduceat(code * weight[:, None], starts, axis=0)
        score = 1 / (1 + np.exp(-np.clip(mixed @ self.output + self.bias, -30, 30)))
        return {
            "x": x, "code": code, "content": content, "gate": gate, "weight": weight,
            "mixed": mixed, "score": score, "starts": starts, "bag": bag,
        }


def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, share: float) -> Model:
    """Fit all layers by gradient descent (Adam) on the documents' labels."""
    random = np.random.default_rng(11)

    def layer(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape)

    model = Model(
        mean=features.mean(axis=0),
        scale=np.maximum(features.std(axis=0), 0.02),
        encoder=layer(FEATURES + 1, CODE),
        content=layer(CODE, ATTENTION),
        gate=layer(CODE, ATTENTION),
        attention=layer(ATTENTION),
        output=layer(CODE),
        bias=float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))),
    )
    # Weights turn the sample's shares of the labels into those of all labelled rows.
    here = labels.mean()
    importance = np.where(labels == 1, share / here, (1 - share) / (1 - here))
    importance /= importance.sum()
    names = ["encoder", "content", "gate", "attention", "output"]
    slow = {n: np.zeros_like(getattr(model, n)) for n in names}
    fast = {n: np.zeros_like(getattr(model, n)) for n in names}
    for epoch in range(1, EPOCHS + 1):
        f = model.forward(features, counts)
        error = (f["score"] - labels) * importance
        row = error[f["bag"]]
        to_mixed = row[:, None] * model.output
        along = (f["code"] * to_mixed).sum(axis=1)
        mean_along = np.add.reduceat(along * f["weight"], f["starts"])[f["bag"]]
        to_raw = f["weight"] * (along - mean_along)
        to_content = to_raw[:, None] * model.attention * f["gate"] * (1 - f["content"] ** 2)
        to_gate = (
            to_raw[:, None] * model.attention * f["content"] * f["gate"] * (1 - f["gate"])
        )
        to_code = to_mixed * f["weight"][:, None]
        to_code += to_content @ model.content.T + to_gate @ model.gate.T
        to_code *= 1 - f["code"] ** 2
        slopes = {
            "encoder": f["x"].T @ to_code + 1e-5 * model.encoder,
            "content": f["code"].T @ to_content,
            "gate": f["code"].T @ to_gate,
            "attention": (f["content"] * f["gate"]).T @ to_raw,
            "output": f["mixed"].T @ error + 1e-5 * model.output,
        }
        rate = 0.02 * np.sqrt(1 - 0.999**epoch) / (1 - 0.9**epoch)
        for n, slope in slopes.items():
            slow[n] = 0.9 * slow[n] + 0.1 * slope
            fast[n] = 0.999 * fast[n] + 0.001 * slope**2
            setattr(model, n, getattr(model, n) - rate * slow[n] / (np.sqrt(fast[n]) + 1e-9))
        model.bias -= 0.05 * float(error.sum())
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | float:
    """The model, or the one score of all documents if the labels do not differ."""

    def encoded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            features, counts = encode(list(column_bytes(batch.column(2))))
            bounds = np.concatenate([[0], np.cumsum(counts)])
            bags = [features[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column(0), batch.column(1), pa.array(bags, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "bag"])

    texts, share = labelled.sample(docs, labels, "quality", rows, FOLDS, HELD_OUT)
    bags = (
        texts.select("doc_id", F.col("label").cast("int").alias("label"), "text")
        .mapInArrow(encoded, "doc_id long, label int, bag binary")
        .collect()
    )
    labels_seen = {b["label"] for b in bags}
    if len(labels_seen) < 2:
        return share
    bags.sort(key=lambda b: (b["doc_id"], b["bag"]))  # the same sums on every run
    features = [np.frombuffer(b["bag"], dtype=np.float32).reshape(-1, FEATURES) for b in bags]
    counts = np.array([len(f) for f in features])
    return train(
        np.concatenate(features).astype(np.float64),
        counts,
        np.array([b["label"] for b in bags], dtype=np.float64),
        share,
    )


def score_texts(model: Model | float, texts: Iterable[bytes]) -> np.ndarray:
    if not isinstance(model, Model):
        return np.full(sum(1 for _ in texts), float(model))
    out, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text) + PASSAGE_BYTES
        if size >= BLOCK_BYTES:
            out.append(model.forward(*encode(held))["score"])
            held, size = [], 0
    if held:
        out.append(model.forward(*encode(held))["score"])
    return np.concatenate(out) if out else np.empty(0)


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def scored(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores = score_texts(model, column_bytes(batch.column(2)))
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64())]
            columns.append(pa.array((scores >= PREDICT_AT).astype(np.int32)))
            names = ["doc_id", "held_out", "score", "predicted"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (labelled.fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        text_or_empty("text").alias("text"),
    ).mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep(
    docs: DataFrame, model: Model | float, text_col: str = "text", at: float = PREDICT_AT
) -> DataFrame:
    """The documents that score `at` or more, with all their columns."""
    column = docs.columns.index(text_col)

    def filtered(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores = score_texts(model, column_bytes(batch.column(column)))
            yield batch.filter(pa.array(scores >= at))

    return docs.mapInArrow(filtered, docs.schema)


def keep_unrejected(docs: DataFrame, model: Model | float, text_col: str = "text") -> DataFrame:
    """All documents but those that a fitted model holds likelier bad than good."""
    if not isinstance(model, Model):
        return docs
    return keep(docs, model, text_col, REJECT_BELOW)
