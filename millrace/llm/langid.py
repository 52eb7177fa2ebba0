"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over a window, the largest response
of each filter feeds a softmax. The network is trained in numpy on a bounded, documented
sample of labelled rows; prediction is one pass over all text, in windows of one length
that cover every byte.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    TEXT_BATCH_BYTES,
    column,
    give_back_memory,
    grouped,
    prepare_workers,
    table,
    text_or_empty,
)

WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 12, 6
#: Labelled rows per language that training may use, and windows taken from each.
SAMPLE_PER_LANGUAGE, WINDOWS_PER_TEXT = 300, 6
EPOCHS, BATCH, RATE = 10, 64, 0.004
UNDETERMINED = "und"
#: How much less familiar than a labelled row (all but one in a hundred) a text may be.
FAMILIAR_SHARE = 0.75
#: Windows scored together.
TOGETHER = 512


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """Rows of ``size`` bytes that cover all of ``data``; the last one ends where it
    ends (and so may overlap), unless the data are shorter: then NULs follow."""
    n = len(data)
    if n <= size:
        return np.frombuffer(data.ljust(size, b"\0"), np.uint8)[None]
    full = np.frombuffer(data, np.uint8)
    starts = np.arange(0, n, size)
    starts[-1] = min(starts[-1], n - size)
    return full[starts[:, None] + np.arange(size)]


def normal(text: str) -> bytes:
    return text.lower().encode("utf-8")


@dataclass
class Network:
    """``embed[byte]``, a filter bank per width, and the softmax layer. ``known`` tells the
    byte pairs of the sample, ``least_familiar`` what a text in a learned language has."""

    labels: list[str]
    embed: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    known: np.ndarray
    least_familiar: float = 0.0

    @classmethod
    def fresh(cls, labels: list[str], seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        draw = lambda *shape, scale: random.normal(0, scale, shape).astype(np.float32)
        return cls(
            labels,
            draw(256, EMBEDDING, scale=0.5),
            [draw(w, EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(len(WIDTHS) * FILTERS, len(labels), scale=0.3),
            np.zeros(len(labels), np.float32),
            np.zeros(1 << 16, bool),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.banks, *self.biases, self.out, self.out_bias]

    def tables(self) -> list[np.ndarray]:
        """Response of every filter offset to every byte: embedding and bank in one."""
        return [np.einsum("be,wef->wbf", self.embed, bank) for bank in self.banks]

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response per filter, rectified, and where it was."""
        values, places = [], []
        for lookup, bias in zip(self.tables(), self.biases):
            n = rows.shape[1] - len(lookup) + 1
            response = np.take(lookup[0], rows[:, :n], axis=0)
            for k in range(1, len(lookup)):
                response += np.take(lookup[k], rows[:, k : k + n], axis=0)
            at = response.argmax(axis=1)
            best = np.take_along_axis(response, at[:, None], axis=1)[:, 0] + bias
            values.append(np.maximum(best, 0))
            places.append(at)
        return np.concatenate(values, axis=1), places

    def probabilities(self, hidden: np.ndarray) -> np.ndarray:
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        hidden, places = self.pooled(rows)
        error = self.probabilities(hidden)
        error[np.arange(len(rows)), labels] -= 1
        error /= len(rows)
        back = (error @ self.out.T) * (hidden > 0)
        embed = np.zeros_like(self.embed)
        banks, biases = [], []
        for i, bank in enumerate(self.banks):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            grad = np.zeros_like(bank)
            for k in range(len(bank)):
                byte = np.take_along_axis(rows, places[i] + k, axis=1)
                grad[k] = np.einsum("nfe,nf->ef", self.embed[byte], part)
                flow = part[:, :, None] * bank[k].T[None]
                np.add.at(embed, byte.ravel(), flow.reshape(-1, flow.shape[2]))
            banks.append(grad)
            biases.append(part.sum(axis=0))
        return [embed, *banks, *biases, hidden.T @ error, error.sum(axis=0)]

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        told = dict(known=np.packbits(self.known), least_familiar=np.array(self.least_familiar))
        np.savez(held, *self.parameters(), labels=np.array(self.labels, dtype=str), **told)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Network:
        held = np.load(io.BytesIO(data))
        p = [held[f"arr_{i}"] for i in range(3 + 2 * len(WIDTHS))]
        n = len(WIDTHS)
        told = np.unpackbits(held["known"]).astype(bool), float(held["least_familiar"])
        return cls(held["labels"].tolist(), p[0], p[1 : 1 + n], p[1 + n : 1 + 2 * n], p[-2], p[-1], *told)

    def margins(self, score: Column) -> Column:
        """``score`` from 0, chance among the labels, to 1. One label leaves no choice: 1."""
        chance = 1 / len(self.labels)
        return (score - chance) / (1 - chance) if chance < 1 else F.lit(1.0)


def byte_pairs(text: str) -> np.ndarray:
    data = np.frombuffer(normal(text), np.uint8).astype(np.uint16)
    return (data[:-1] << 8) | data[1:]


def familiarity(known: np.ndarray, text: str) -> float:
    """Share of the text's byte pairs that are known: of all of them or of the different
    ones, whichever is more, so that neither a long run nor a short passage decides."""
    pairs = byte_pairs(text)
    if not len(pairs):
        return 1.0
    seen = np.zeros(1 << 16, bool)
    seen[pairs] = True
    return float(max(known[pairs].mean(), known[seen].mean()))


def learn_pairs(network: Network, samples: list[list[str]]) -> None:
    """``known`` from all samples; ``least_familiar`` from how familiar every other sample
    is to one that knows the rest."""
    for pieces in samples[::2]:
        for piece in pieces:
            network.known[byte_pairs(piece)] = True
    rest = [familiarity(network.known, " ".join(pieces)) for pieces in samples[1::2]]
    network.least_familiar = FAMILIAR_SHARE * float(np.quantile(rest, 0.01)) if rest else 0.0
    for pieces in samples[1::2]:
        for piece in pieces:
            network.known[byte_pairs(piece)] = True


def train(samples: list[list[str]], labels: list[str], seed: int = 7) -> Network:
    """Adam on the windows of each sample's pieces of text."""
    names = sorted(set(labels))
    network, random = Network.fresh(names, seed), np.random.default_rng(seed)
    learn_pairs(network, samples)
    rows, wanted = [], []
    for pieces, label in zip(samples, labels):
        found = np.concatenate([windows(normal(piece)) for piece in pieces])
        short = found[:1].copy()  # a shorter text, so that short ones are learned too
        short[:, int(random.integers(20, 100)) :] = 0
        rows += [found, short]
        wanted += [names.index(label)] * (len(found) + 1)
    rows, wanted = np.concatenate(rows), np.array(wanted)
    # every language weighs the same, however many rows it has
    share = 1 / np.bincount(wanted, minlength=len(names))[wanted]
    parameters = network.parameters()
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(EPOCHS):
        order = random.choice(len(rows), len(rows), p=share / share.sum())
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for p, m, v, g in zip(parameters, first, second, network.gradients(rows[some], wanted[some])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def learnable(id_col: str, lang_col: str) -> Column:
    return ~held_out(id_col) & column(lang_col).isNotNull()


def held_out(id_col: str) -> Column:
    """False for a NULL id, which belongs to neither part."""
    return F.coalesce(F.crc32(column(id_col).cast("string")) % 5 == 0, F.lit(False))


def train_on(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Network | None:
    """A network from at most ``per_language`` labelled rows of each language, those that
    a hash of the id puts first, and ``WINDOWS_PER_TEXT`` pieces of each, spread evenly.
    None if no row can teach.

    Ids are chosen from narrow columns; a task keeps the first rows of each language it
    has read, so no language is gathered whole.
    """
    text = column(text_col)
    rows = df.filter(
        learnable(id_col, lang_col) & column(id_col).isNotNull() & text.rlike(r"\p{L}")
    ).select(column(id_col).alias("id"), column(lang_col).alias("lang"), text.alias("text"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (
        rows.select("id", "lang")
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= per_language)
        .select("id", "lang")
        .distinct()
    )
    room = F.greatest(F.char_length("text") - WINDOW, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(WINDOWS_PER_TEXT - 1)),
        lambda i: F.substring(
            "text", (F.floor(i * room / (WINDOWS_PER_TEXT - 1)) + 1).cast("int"), F.lit(WINDOW)
        ),
    )
    # At most per_language rows for each language.
    sample = rows.join(F.broadcast(chosen), ["id", "lang"]).select(
        "lang", "id", F.array_distinct(pieces).alias("pieces")
    )
    # Of rows that repeat an id in a language one teaches, the same in every run.
    once = sample.groupBy("id", "lang").agg(F.min("pieces").alias("pieces"))
    found = sorted((r["lang"], r["id"], r["pieces"]) for r in once.collect())
    if not found:
        return None
    return train([pieces for _, _, pieces in found], [lang for lang, _, _ in found])


def _predict(model: bytes, familiar: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.from_bytes(model)
        for batch in batches:
            names, scores, shares = [], [], []
            for texts in grouped((t.as_py() for t in batch.column("text")), 250_000):
                label, score = predict(network, texts)
                names += label
                scores += score
                if familiar:
                    shares += [familiarity(network.known, t) for t in texts]
            told = {"lang_pred": pa.array(names), "score": pa.array(scores)}
            if familiar:
                told["familiarity"] = pa.array(shares)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), *told.values()],
                [*batch.schema.names[:-1], *told],
            )
        give_back_memory()

    return run


def predict(network: Network, texts: list[str]) -> tuple[list[str], list[float]]:
    """Label and probability of each text: the mean over its windows' logarithms."""
    rows = [windows(normal(t)) for t in texts]
    counts = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    logs = np.concatenate([
        np.log(network.probabilities(network.pooled(flat[at : at + TOGETHER])[0]) + 1e-9)
        for at in range(0, len(flat), TOGETHER)
    ])
    mean = np.add.reduceat(logs, np.cumsum(counts) - counts) / counts[:, None]
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return [network.labels[b] for b in best], p[np.arange(len(p)), best].tolist()


def with_language(
    df: DataFrame,
    network: Network | None,
    text_col: str = "text",
    keep: list[str] | None = None,
    familiar: bool = False,
) -> DataFrame:
    """``keep`` (all columns by default), then ``lang_pred`` and ``score``, and with
    ``familiar`` also ``familiarity``.

    A NULL text, one without a letter, or any text if there is no network is ``und``
    with score (and familiarity) 0. Columns of these names are replaced.
    """
    prepare_workers(df.sparkSession, TEXT_BATCH_BYTES)
    added = ["lang_pred", "score", *(["familiarity"] if familiar else [])]
    keep = [c for c in (df.columns if keep is None else keep) if c not in added]
    # Numbered inside, so that no column of the table has a name that is used here.
    own = [f"c{i}" for i in range(len(keep))]
    named_again = [F.col(c).alias(name) for c, name in zip(own, keep)]
    numbered_ = [column(name).alias(c) for c, name in zip(own, keep)]
    kept = df.select(*numbered_, column(text_col).cast("string").alias("text"))
    lettered = F.col("text").rlike(r"\p{L}")
    und = [F.lit(UNDETERMINED if c == "lang_pred" else 0.0).alias(c) for c in added]
    if network is None:
        return kept.select(*named_again, *und)
    found = kept.select(
        *own, F.coalesce(~lettered, F.lit(True)).alias("und"), F.when(lettered, F.col("text")).otherwise("").alias("text")
    )
    schema = found.drop("text").schema.add("lang_pred", "string")
    for c in added[1:]:
        schema = schema.add(c, "double")
    named = found.mapInArrow(_predict(network.to_bytes(), familiar), schema)
    return named.select(
        *named_again,
        F.when(F.col("und"), UNDETERMINED).otherwise(F.col("lang_pred")).alias("lang_pred"),
        *[F.when(F.col("und"), 0.0).otherwise(F.col(c)).alias(c) for c in added[1:]],
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    named = with_language(documents, train_on(documents), keep=["doc_id"])
    return named.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
