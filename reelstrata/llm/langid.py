"""Language identification by a byte convolutional network.

Texts are cut into windows of a fixed number of bytes. Bytes are embedded, convolved with filters of several
widths, max-pooled and classified by softmax; the probabilities of the windows of a text are averaged by
their bytes. The network is trained in numpy on a bounded sample of labelled texts.

Defined results: a NULL text, or one without a letter, is `und` with score 0, as is every text when no
labelled text was there to learn from; equal texts get equal results; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstrata.llm.common import crc_mod, fresh, spread_sample

WINDOW, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
#: Labelled texts per language and windows of each that the network learns from at most.
SAMPLE, SAMPLE_WINDOWS = 200, 3
#: Windows worked on at a time.
CHUNK = 128
UNKNOWN = "und"


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray  # byte 0 pads and stays 0
    kernels: list[np.ndarray]  # width * EMBED x FILTERS
    biases: list[np.ndarray]
    out: np.ndarray
    shift: np.ndarray


def windows_of(text: bytes) -> np.ndarray:
    """The text as rows of WINDOW bytes, the last one padded with 0."""
    n = -(-len(text) // WINDOW)
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def taps(x: np.ndarray, width: int, shift: int) -> np.ndarray:
    """Every width-th stretch of `width` embedded bytes, from `shift` on."""
    n, length, size = x.shape
    count = (length - shift) // width
    return x[:, shift : shift + count * width].reshape(n, count, width * size)


def pooled(net: Net, rows: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each window."""
    x = net.embed[rows]
    best = []
    for width, kernel, bias in zip(WIDTHS, net.kernels, net.biases):
        top = None
        for shift in range(width):
            part = taps(x, width, shift)
            part = (part.reshape(-1, part.shape[2]) @ kernel).reshape(len(rows), -1, FILTERS).max(1)
            top = part if top is None else np.maximum(top, part)
        best.append(np.maximum(top + bias, 0))
    return np.concatenate(best, 1)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(1, keepdims=True))
    return scores / scores.sum(1, keepdims=True)


def probabilities(net: Net, rows: np.ndarray) -> np.ndarray:
    return softmax(pooled(net, rows) @ net.out + net.shift)


def train(texts: list[bytes], langs: list[str], rounds: int = 12, rate: float = 4e-3, batch: int = 64) -> Net:
    """Adam on cross entropy, with windows drawn evenly from each text."""
    names = sorted(set(langs))
    rng = np.random.default_rng(7)
    parts, target = [], []
    for text, lang in zip(texts, langs):
        rows = windows_of(text)
        take = rows[np.unique(np.linspace(0, len(rows) - 1, SAMPLE_WINDOWS).astype(int))] if len(rows) else rows
        parts.append(take)
        target += [names.index(lang)] * len(take)
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    embed = scale(256, EMBED) * 8
    embed[0] = 0
    net = Net(
        names,
        embed,
        [scale(w * EMBED, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        scale(FILTERS * len(WIDTHS), max(1, len(names))),
        np.zeros(max(1, len(names)), np.float32),
    )
    if not target:
        return net
    rows, y = np.concatenate(parts), np.array(target)
    share = np.bincount(y, minlength=len(names))
    cost = (len(y) / (len(names) * share))[y].astype(np.float32)
    params = [net.embed, *net.kernels, *net.biases, net.out, net.shift]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            pick = order[at : at + batch]
            some, step = rows[pick], step + 1
            x = net.embed[some]
            tops, places = [], []
            for width, kernel, bias in zip(WIDTHS, net.kernels, net.biases):
                slide = np.lib.stride_tricks.sliding_window_view(x, (width, EMBED), (1, 2))[:, :, 0]
                flat = slide.reshape(len(pick), -1, width * EMBED)
                response = flat @ kernel
                place = response.argmax(1)
                tops.append(np.maximum(np.take_along_axis(response, place[:, None], 1)[:, 0] + bias, 0))
                places.append((flat, place))
            hidden = np.concatenate(tops, 1)
            wrong = softmax(hidden @ net.out + net.shift)
            wrong[np.arange(len(pick)), y[pick]] -= 1
            wrong *= (cost[pick] / len(pick))[:, None]
            back = (wrong @ net.out.T) * (hidden > 0)
            grad_embed = np.zeros_like(net.embed)
            grad_kernels, grad_biases = [], []
            for i, (width, kernel) in enumerate(zip(WIDTHS, net.kernels)):
                flat, place = places[i]
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                taken = np.take_along_axis(flat, place[:, :, None], 1)  # windows x filters x taps
                grad_kernels.append(np.einsum("nf,nft->tf", part, taken))
                grad_biases.append(part.sum(0))
                spread = (part[:, :, None] * kernel.T[None]).reshape(len(pick), FILTERS, width, EMBED)
                for k in range(width):
                    np.add.at(grad_embed, np.take_along_axis(some, place + k, 1), spread[:, :, k])
            grad_embed[0] = 0
            grads = [grad_embed, *grad_kernels, *grad_biases, hidden.T @ wrong, wrong.sum(0)]
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def predict(net: Net, texts) -> pd.DataFrame:
    """Language and score of each text; the windows of all texts go through the network in chunks."""
    plain = [t if isinstance(t, str) and any(map(str.isalpha, t)) else None for t in texts]
    total = np.zeros((len(plain), len(net.langs)))
    size = np.zeros(len(plain))
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    count = 0

    def flush(upto: int):
        nonlocal held, owner, count
        rows, who = np.concatenate(held), np.concatenate(owner)
        for at in range(0, upto, CHUNK):
            some, whose = rows[at : min(at + CHUNK, upto)], who[at : min(at + CHUNK, upto)]
            filled = (some != 0).sum(1)
            part = probabilities(net, some) * filled[:, None]
            for k in range(len(net.langs)):
                total[:, k] += np.bincount(whose, part[:, k], len(plain))
            size[:] += np.bincount(whose, filled, len(plain))
        held, owner, count = [rows[upto:]], [who[upto:]], len(rows) - upto

    for i, text in enumerate(plain if net.langs else []):
        if text is None:
            continue
        rows = windows_of(text.encode("utf-8", "surrogatepass"))
        held.append(rows)
        owner.append(np.full(len(rows), i))
        count += len(rows)
        if count >= 32 * CHUNK:
            flush(count - count % CHUNK)
    if count:
        flush(count)
    known = size > 0
    mean = total / np.maximum(size, 1)[:, None]
    best = mean.argmax(1) if net.langs else np.zeros(len(plain), int)
    return pd.DataFrame(
        {
            "lang_pred": [net.langs[b] if k else UNKNOWN for b, k in zip(best, known)],
            "score": np.where(known, mean[np.arange(len(plain)), best], 0.0) if net.langs else np.zeros(len(plain)),
        }
    )


def language(net: Net, text: Column) -> Column:
    """A struct of the predicted language and its score."""

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return predict(net, texts)

    return run(text)


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, 4) == 2


def fit(docs: DataFrame) -> Net:
    """Train on at most SAMPLE texts of each language, of documents that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    ids = spread_sample(known, F.col("lang"), SAMPLE)
    rows = (
        known.where(F.col("doc_id").isin(ids))
        .select("doc_id", "lang", F.substring("text", 1, 20 * WINDOW).alias("text"))
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows = sorted((r.doc_id, r.lang, r.text) for r in rows)
    return train([t.encode("utf-8", "surrogatepass") for _, _, t in rows], [lang for _, lang, _ in rows])


def identify(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every text."""
    found = language(net, F.col("text")).alias("found")
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found).select("doc_id", "held_out", "found.*")


def keep_known(docs: DataFrame, net: Net, least: float = 0.4) -> DataFrame:
    """The documents whose language is known with a score of `least` or more, columns as they were."""
    mark = fresh(docs, "language_found")
    told = (F.col(mark)["lang_pred"] != UNKNOWN) & (F.col(mark)["score"] >= least)
    return docs.withColumn(mark, language(net, F.col("text"))).where(told).drop(mark)
