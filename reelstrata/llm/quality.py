"""Quality rules: a linear-chain conditional random field marks the lines of a text as content or boilerplate.

The field has two labels, weights of line features per label, and transition weights. It is trained on a
bounded sample of labelled documents, whose label all their lines take, and decoded by the Viterbi
algorithm for all texts of a batch at once. A text is kept if enough of its words stand in content lines.

Defined results: a NULL or empty text has no words, fails the base rules and is not kept; a line without a
word belongs to no label and is skipped; equal texts get equal results; no rows give no rows. Without
labelled documents of both kinds the weights stay 0, ties fall to content, and only the base rules decide.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstrata.llm.common import fresh, spread_sample

SYMBOLS = b"[#*$%&|<>]"
#: Labelled documents per label, and characters and lines of each, that the field is trained on at most.
SAMPLE, SAMPLE_CHARS, SAMPLE_LINES = 600, 8_000, 60
CONTENT, BOILERPLATE = 0, 1
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "content_words long, n_lines long, kept boolean"
)
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(SYMBOLS)] = True
BANG = np.zeros(256, bool)
BANG[33] = True
SHARES = ((LETTER, (0.6, 0.75)), (UPPER, (0.3, 0.6)), (DIGIT, (0.1, 0.3)), (SYMBOL, (0.01, 0.05, 0.15)), (BANG, (0.01, 0.05)))
#: Features of a line: constant, length in words, share of distinct words, repeated line, last character, shares of characters.
N_FEATURES = 1 + 4 + 3 + 1 + 1 + sum(len(cuts) for _, cuts in SHARES)


@dataclass(frozen=True)
class Field:
    emit: np.ndarray  # features x labels
    start: np.ndarray
    move: np.ndarray  # from x to
    content_share: float = 0.5


def lines_of(text: bytes) -> tuple[list[bytes], list[list[bytes]]]:
    """The lines that have a word, and their words."""
    lines = [(line, line.split()) for line in text.split(b"\n")]
    lines = [(line, found) for line, found in lines if found]
    return [line for line, _ in lines], [found for _, found in lines]


def features(lines: list[bytes], found: list[list[bytes]]) -> np.ndarray:
    """One row of 0/1 features for each line of a text."""
    out = np.zeros((len(lines), N_FEATURES), np.float32)
    if not lines:
        return out
    size = np.array([len(line) for line in lines])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    chars = np.frombuffer(b"".join(lines), np.uint8)
    n_words = np.array([len(w) for w in found])
    distinct = np.array([len(set(w)) for w in found]) / n_words
    seen: set[bytes] = set()
    again = [line in seen or seen.add(line) for line in lines]
    ends = np.array([line.rstrip()[-1] in b".!?" for line in lines])
    columns = [np.ones(len(lines)), n_words <= 2, n_words >= 6, n_words >= 15, n_words >= 40]
    columns += [distinct < 0.25, distinct < 0.5, distinct < 0.75, np.array(again, dtype=object).astype(bool), ends]
    for table, cuts in SHARES:
        share = np.add.reduceat(table[chars], start, dtype=np.int64) / size
        columns += [share >= cut for cut in cuts]
    return np.stack(columns, 1).astype(np.float32)


def train(texts: list[bytes], bad: list[bool], rounds: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> Field:
    """Maximum likelihood by Adam; all lines of a text carry its label. Sequences are padded and masked."""
    rows = [features(*lines_of(text))[:SAMPLE_LINES] for text in texts]
    kept = [(x, int(b)) for x, b in zip(rows, bad) if len(x)]
    theta = np.zeros(2 * N_FEATURES + 2 + 4)
    if len({b for _, b in kept}) < 2:
        return Field(np.zeros((N_FEATURES, 2)), np.zeros(2), np.zeros((2, 2)))
    steps = max(len(x) for x, _ in kept)
    x = np.zeros((len(kept), steps, N_FEATURES))
    live = np.zeros((len(kept), steps), bool)
    for i, (row, _) in enumerate(kept):
        x[i, : len(row)], live[i, : len(row)] = row, True
    y = np.array([b for _, b in kept])
    counts = Counter(y.tolist())
    weight = np.array([len(y) / (2 * counts[b]) for b in y]) / live.sum(1)
    m = v = np.zeros_like(theta)
    for step in range(1, rounds + 1):
        emit, start, move = theta[: 2 * N_FEATURES].reshape(N_FEATURES, 2), theta[-6:-4], theta[-4:].reshape(2, 2)
        score = x @ emit
        score[:, 0] += start
        alpha = np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, steps):
            ahead = np.logaddexp(alpha[:, t - 1, :1] + move[0], alpha[:, t - 1, 1:] + move[1]) + score[:, t]
            alpha[:, t] = np.where(live[:, t, None], ahead, alpha[:, t - 1])
        beta = np.zeros_like(score)
        pair = np.zeros((len(y), 2, 2))
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        for t in range(steps - 2, -1, -1):
            onward = move + (score[:, t + 1] + beta[:, t + 1])[:, None, :]
            back = np.logaddexp(onward[:, :, 0], onward[:, :, 1])
            beta[:, t] = np.where(live[:, t + 1, None], back, beta[:, t + 1])
            joint = np.exp(alpha[:, t, :, None] + onward - total[:, None, None])
            pair += np.where(live[:, t + 1, None, None], joint, 0)
        single = np.exp(alpha + beta - total[:, None, None]) * live[..., None]
        truth = np.eye(2)[y][:, None, :] * live[..., None]
        off = (truth - single) * weight[:, None, None]
        seen = np.zeros((len(y), 2, 2))
        seen[np.arange(len(y)), y, y] = live.sum(1) - 1
        grad = np.concatenate([
            np.einsum("nlf,nlk->fk", x, off).ravel(), off[:, 0].sum(0), ((seen - pair) * weight[:, None, None]).sum(0).ravel()
        ]) / len(y) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(theta[: 2 * N_FEATURES].reshape(N_FEATURES, 2), theta[-6:-4].copy(), theta[-4:].reshape(2, 2).copy())


def decode(field: Field, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best labels of all lines: `rows` holds the features of the texts one after the other, `sizes` their lines.

    Texts are taken longest first, so step t works on the texts that have more than t lines."""
    score = rows @ field.emit
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    came = np.zeros((len(rows), 2), np.int8)
    label = np.zeros(len(rows), np.int8)
    live = int((sizes > 0).sum())
    if not live:
        return label
    best = score[starts[:live]] + field.start
    lasts = np.zeros((live, 2))
    lasts[:] = best
    for t in range(1, int(sizes[0])):
        live = int((sizes > t).sum())
        step = best[:live, :, None] + field.move
        came[starts[:live] + t] = step.argmax(1)
        best = step.max(1) + score[starts[:live] + t]
        lasts[:live] = best
    live = int((sizes > 0).sum())
    now = lasts.argmax(1).astype(np.int8)
    label[starts[:live] + sizes[:live] - 1] = now
    for t in range(int(sizes[0]) - 1, 0, -1):
        live = int((sizes > t).sum())
        at = starts[:live] + t
        label[at - 1] = came[at, label[at]]
    return label


def repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has twice or more, the first ones included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    pairs = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1]
    kinds, counts = np.unique(pairs[:-1] * len(ids) + code[2:], return_inverse=True, return_counts=True)[1:]
    twice = np.flatnonzero(counts[kinds] > 1)
    if not len(twice):
        return 0
    mark = np.zeros(n, bool)
    for shift in range(3):
        mark[twice + shift] = True
    return int(mark.sum())


def base(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int, bool]:
    seen: set[bytes] = set()
    copies = 0
    for line in text.split(b"\n"):
        if line in seen and line.split():
            copies += 1
        seen.add(line)
    n, again = len(words), repeated(words)
    points = sum(len(w.decode()) for w in words) if not text.isascii() else sum(map(len, words))
    symbols = len(text) - len(text.translate(None, SYMBOLS[1:-1]))
    return n, points, symbols, copies, again, n < 50 or 100 * again > 50 * n


#: Bytes of text whose lines are decoded together.
BATCH_BYTES = 4 << 20


def judge(field: Field, texts) -> pd.DataFrame:
    """The result columns for a series of texts."""
    out, held, size = [], [], 0

    def flush():
        nonlocal held, size
        rows = np.concatenate([x for _, x, _ in held]) if held else np.zeros((0, N_FEATURES))
        labels = decode(field, rows, np.array([len(x) for _, x, _ in held], np.int64))
        at = 0
        for numbers, x, counts in held:
            content = int(counts[labels[at : at + len(x)] == CONTENT].sum())
            at += len(x)
            out.append((*numbers, content, len(x), not numbers[5] and content >= field.content_share * numbers[0]))
        held, size = [], 0

    for text in texts:
        text = (text or "").encode("utf-8", "surrogatepass")
        lines, found = lines_of(text)
        numbers = base(text, [w for line in found for w in line])
        held.append((numbers, features(lines, found), np.array([len(w) for w in found], np.int64)))
        size += len(text)
        if size > BATCH_BYTES:
            flush()
    flush()
    names = [part.split()[0] for part in RESULT.split(", ")]
    return pd.DataFrame(out, columns=names)


def verdict(field: Field, text: Column) -> Column:
    """A struct of the base numbers, the words in content lines, and whether the text is kept."""

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        return judge(field, texts)

    return run(text)


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Train on at most SAMPLE documents of each quality label; NULL labels and texts are left out."""
    quality = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    ids = spread_sample(quality, F.col("quality"), SAMPLE)
    bad = {r.doc_id: r.quality == 0 for r in quality.where(F.col("doc_id").isin(ids)).collect()}
    texts = (
        docs.where(F.col("doc_id").isin(ids) & F.col("text").isNotNull())
        .select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .dropDuplicates(["doc_id"])
        .collect()
    )
    texts = sorted((r.doc_id, r.text) for r in texts)
    return train([t.encode("utf-8", "surrogatepass") for _, t in texts], [bad[i] for i, _ in texts])


def quality_rules(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id and the verdict on every text."""
    return docs.select("doc_id", verdict(field, F.col("text")).alias("verdict")).select("doc_id", "verdict.*")


def keep_good(docs: DataFrame, field: Field) -> DataFrame:
    """The documents that are kept, columns as they were."""
    mark = fresh(docs, "quality_verdict")
    return docs.withColumn(mark, verdict(field, F.col("text"))).where(F.col(mark)["kept"]).drop(mark)
