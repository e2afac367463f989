"""Scoring texts with a language model: causal self-attention over subword ids, trained in numpy.

Texts are lower-cased (A-Z) and cut into words; every word is spelled in subwords of a byte-pair vocabulary, and a text
ends with an end identifier. The model reads windows of WINDOW subwords that overlap by OVERLAP; each subword is
scored once, in the window where it has the longer context. The softmax has two levels: the most frequent subwords of
all training documents form classes of MEMBERS, attention gives the probability of the next class and, within it, of
the member; the rest form one more class, in which a subword has its share of the corpus. Counts and weights come from all
training documents as a whole: tasks learn from the documents of their blocks, in rounds that end in the mean of their weights.

Corpus counts are gathered by blocks. A block holds the distinct words of about BLOCK_BYTES of text with their counts
in training documents, and the texts as numbers of those words. Only a block's words are shuffled, not all tokens: a
window over equal words sums their counts, and the sums go back to their blocks.

Defined results: a NULL or empty text is its end token alone; with no training document all counts are 0 and the
classes are uniform; a NULL doc_id counts as the empty text for the hold-out; repeated rows are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from math import log, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstrata.llm.common import crc_mod, stored
from reelstrata.llm.tokencount import VOCABULARY, encoder

WINDOW, OVERLAP, WIDTH = 16, 4, 16
#: Members of each class, frequent subwords in small classes; what is left is one more class.
MEMBERS = [8] * 8 + [16] * 8 + [32] * 8 + [96] * 8
CLASSES = REST = len(MEMBERS)
#: Rounds of learning: up to which of every 16 documents of a block, and the rate of its steps. Windows of a step at most, fewer
#: where a block's share of a round would not make STEPS steps.
ROUNDS, BATCH, STEPS = [(1, 1e-2), (4, 1e-2), (16, 5e-3)], 512, 128
BLOCK_BYTES = 12 << 20
#: Windows that go through attention, positions that go through the members' softmax, and through that of the classes, at a time.
CHUNK, POSITIONS, STRIP = 256, 1 << 14, 1 << 11
#: The end identifier, first free one of the vocabulary, and the number of identifiers.
END, IDS = 50256, 50257
BLOCK = (
    "block string, words array<binary>, seen array<long>, doc_ids array<long>, held array<boolean>, lengths array<int>, numbers binary, "
    "spelled binary, sizes binary, ids array<int>, spread array<long>"
)


def held_out(doc_id):
    return crc_mod(doc_id, 10) == 0


@cache
def leading(path: str) -> np.ndarray:
    """Of every identifier, whether it begins with a space."""
    spell = encoder(path).decode_single_token_bytes
    return np.array([spell(i)[:1] == b" " for i in range(END)])


def spellings(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The identifiers of all words in a row, each word after a space, and how many each has.

    Words of printable characters hold no white space, so the vocabulary's rule cuts a row of them at each space and nowhere
    across one: they are spelled in one go. The others are spelled one by one."""
    encode = encoder(path).encode_ordinary
    plain = np.fromiter(map(str.isprintable, words), bool, len(words))
    row = np.array(encode("".join(" " + w for w, p in zip(words, plain) if p)), np.uint16)
    if plain.all():
        return row, np.diff(np.append(np.flatnonzero(leading(path)[row]), len(row))).astype(np.int32)
    ends = np.append(np.flatnonzero(leading(path)[row]), len(row))
    parts = iter(np.split(row, ends[1:-1]) if plain.any() else [])
    found = [next(parts) if p else np.array(encode(" " + w), np.uint16) for w, p in zip(words, plain)]
    return np.concatenate(found), np.fromiter(map(len, found), np.int32, len(found))


# --- model ---------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    class_of: np.ndarray  # by identifier
    member: np.ndarray  # place within the class
    share: np.ndarray  # natural log of an identifier's share of the last class, 0 elsewhere


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and place in it of every identifier, the frequent ones first, and the log shares of the last class."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    ends = np.cumsum(MEMBERS)
    class_of = np.searchsorted(ends, rank, side="right")
    rest = np.where(class_of == REST, counts + 0.1, 0)
    share = np.where(class_of == REST, np.log(np.maximum(rest, 1e-9) / rest.sum()), 0.0)
    return class_of.astype(np.int32), np.where(class_of == REST, 0, rank - np.append(ends - MEMBERS, 0)[class_of]).astype(np.int32), share


def initial(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    d = WIDTH
    return {
        "token": draw(IDS, d) * np.float32(np.sqrt(IDS) * 0.3), "place": draw(WINDOW, d) * np.float32(0.3),
        "qkv": draw(d, 3 * d), "mix": draw(d, d) * np.float32(0.3), "up": draw(d, 2 * d), "lift": np.zeros(2 * d, np.float32),
        "down": draw(2 * d, d) * np.float32(0.3), "out": draw(d, CLASSES + 1) * np.float32(0.3), "bias": np.zeros(CLASSES + 1, np.float32),
        **{f"inner{c}": draw(d, n) * np.float32(0.3) for c, n in enumerate(MEMBERS)},
        **{f"tilt{c}": np.zeros(n, np.float32) for c, n in enumerate(MEMBERS)},
    }


#: Of queries, keys and values, by which the queries are divided beforehand.
SCALE = np.repeat(np.array([1 / np.sqrt(WIDTH), 1, 1], np.float32), WIDTH)
CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def forward(w: dict[str, np.ndarray], ids: np.ndarray, skip: int = 0):
    """Hidden states of a batch of windows; every position sees itself and those before it. The first skip are only seen."""
    d, n = WIDTH, ids.shape[1]
    x = np.take(w["token"], ids, axis=0, mode="clip")
    x += w["place"][:n]
    qkv = (x.reshape(-1, d) @ (w["qkv"] * SCALE)).reshape(*ids.shape, 3 * d)
    q, k, v = qkv[:, skip:, :d], qkv[..., d : 2 * d], qkv[..., 2 * d :]
    a = np.matmul(q, k.transpose(0, 2, 1))
    if a.size and a.max() > 30:
        np.minimum(a, 30, out=a)
    np.exp(a, out=a)
    a *= CAUSAL[skip:n, :n]
    a /= row_sums(a) + np.float32(1e-30)
    c = np.matmul(a, v)
    y = (c.reshape(-1, d) @ w["mix"]).reshape(c.shape)
    y += x[:, skip:]
    u = y.reshape(-1, d) @ w["up"]
    u += w["lift"]
    np.maximum(u, 0, out=u)
    f = (u @ w["down"]).reshape(c.shape)
    f += y
    return f, (x, qkv, a, c, y, u)


def row_sums(z: np.ndarray) -> np.ndarray:
    """Over the last axis, which is too short for sum() to be fast; kept as an axis of one."""
    n = z.shape[-1]
    return (z.reshape(-1, n) @ np.ones(n, z.dtype)).reshape(*z.shape[:-1], 1)


def strips(n: int) -> list[slice]:
    return [slice(k, min(k + STRIP, n)) for k in range(0, n, STRIP)]


def by_class(f: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in the order of their classes: the order, hidden states with a last column of ones for the bias, and classes."""
    order = np.argsort(kind.astype(np.uint8), kind="stable")
    wide = np.empty((len(f), WIDTH + 1), f.dtype)
    wide[:, :WIDTH] = f
    wide[:, WIDTH] = 1
    return order, np.take(wide, order, axis=0, mode="clip"), np.take(kind, order)


def alike(kind: np.ndarray) -> list[tuple[int, slice, list[tuple[int, slice]]]]:
    """Of ordered classes, runs of those with equally many members: members, where it stands, and where in it each class does."""
    ends = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    out = []
    for c in range(CLASSES):
        if ends[c] < ends[c + 1]:
            if not out or out[-1][0] != MEMBERS[c]:
                out.append((MEMBERS[c], ends[c], []))
            out[-1][2].append((c, slice(ends[c] - out[-1][1], ends[c + 1] - out[-1][1])))
    return [(n, slice(start, start + parts[-1][1].stop), parts) for n, start, parts in out]


def capped(z: np.ndarray) -> np.ndarray:
    if z.size and z.max() > 60:
        np.minimum(z, 60, out=z)
    return z


def flat(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Where the targets stand in all scores, row after row."""
    return np.arange(0, z.size, z.shape[1]) + target


def log_softmax(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of each target, from scores that are not kept."""
    found = np.take(capped(z), flat(z, target))
    return found - np.log(row_sums(np.exp(z, out=z))[:, 0])


def log_probabilities(w: dict[str, np.ndarray], f: np.ndarray, kind: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Natural log probability of each target: of its class, and of the member of its class."""
    order, wide, kind = by_class(f, kind)
    member, heads, logs = np.take(member, order), np.vstack([w["out"], w["bias"]]), np.empty(len(f), f.dtype)
    for at in strips(len(f)):
        logs[at] = log_softmax(wide[at] @ heads, kind[at])
    for n, at, parts in alike(kind):
        z, rows = np.empty((at.stop - at.start, n), f.dtype), wide[at]
        for c, part in parts:
            np.matmul(rows[part], np.vstack([w[f"inner{c}"], w[f"tilt{c}"]]), out=z[part])
        logs[at] += log_softmax(z, member[at])
    out = np.empty_like(logs)
    out[order] = logs
    return out


def odds(z: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The slope of the weighted cross entropy by the scores of a softmax, in their place."""
    np.exp(capped(z), out=z)
    z *= weight[:, None] / row_sums(z)
    z.reshape(-1)[flat(z, target)] -= weight
    return z


def softmax_gradients(w, f: np.ndarray, kind: np.ndarray, member: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
    """Of the weighted cross entropy, by the weights of both levels, and by the hidden states."""
    order, wide, kind = by_class(f, kind)
    member, weight, heads = np.take(member, order), np.take(weight, order), np.vstack([w["out"], w["bias"]])
    g, df, total = {}, np.empty(f.shape, f.dtype), np.zeros(heads.shape, f.dtype)
    for at in strips(len(f)):
        p = odds(wide[at] @ heads, kind[at], weight[at])
        total += (p.T @ wide[at]).T
        np.matmul(p, w["out"].T, out=df[at])
    g["out"], g["bias"] = total[:WIDTH], total[WIDTH]
    for n, at, parts in alike(kind):
        z, rows = np.empty((at.stop - at.start, n), f.dtype), wide[at]
        for c, part in parts:
            np.matmul(rows[part], np.vstack([w[f"inner{c}"], w[f"tilt{c}"]]), out=z[part])
        odds(z, member[at], weight[at])
        inside = np.empty((len(z), WIDTH), f.dtype)
        for c, part in parts:
            both = rows[part].T @ z[part]
            g[f"inner{c}"], g[f"tilt{c}"] = both[:WIDTH], both[WIDTH]
            np.matmul(z[part], w[f"inner{c}"].T, out=inside[part])
        df[at] += inside
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return g, np.take(df, back, axis=0, mode="clip")


def gradients(w, ids: np.ndarray, kind: np.ndarray, member: np.ndarray, live: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy over live positions."""
    f, (x, qkv, a, seen, y, u) = forward(w, ids)
    shape, d = x.shape, WIDTH
    weight = (live.ravel() / live.sum()).astype(f.dtype)
    g, df = softmax_gradients(w, f.reshape(-1, d), kind.ravel(), member.ravel(), weight)
    du = df @ w["down"].T
    du *= u > 0
    g["down"], g["up"], g["lift"] = u.T @ df, (du.T @ y.reshape(-1, d)).T, np.ones(len(du), du.dtype) @ du
    dy = df
    dy += du @ w["up"].T
    g["mix"] = seen.reshape(-1, d).T @ dy
    dc = (dy @ w["mix"].T).reshape(shape)
    q, k, v = qkv[..., :d], qkv[..., d : 2 * d], qkv[..., 2 * d :]
    ds = np.matmul(dc, v.transpose(0, 2, 1))
    ds *= a
    ds -= a * row_sums(ds)
    dqkv = np.empty_like(qkv)
    np.matmul(ds, k, out=dqkv[..., :d])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[..., d : 2 * d])
    np.matmul(a.transpose(0, 2, 1), dc, out=dqkv[..., 2 * d :])
    flat = dqkv.reshape(-1, 3 * d)
    g["qkv"] = (flat.T @ x.reshape(-1, d)).T * SCALE
    dy += flat @ (w["qkv"] * SCALE).T
    g["place"] = dy.reshape(shape).sum(0)
    g["token"] = (ids.ravel(), dy)
    return g


def spans(lengths: np.ndarray, step: int = WINDOW - OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts of the given numbers of identifiers: text, first place, places, first place that is scored."""
    count = 1 + np.maximum(0, -(-(lengths - WINDOW) // step))
    text = np.repeat(np.arange(len(lengths)), count)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    size = np.minimum(WINDOW, lengths[text] - turn * step)
    return text, turn * step, size, np.where(turn > 0, WINDOW - step, 0)


def shifted(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The identifier before each; before a text stands an end."""
    before = np.concatenate([[END], ids[:-1]]).astype(ids.dtype)
    before[starts] = END
    return before


def laid(values: np.ndarray, width: int) -> np.ndarray:
    """From each place on, as many values as a window is wide; ends stand after the last."""
    return sliding_window_view(np.append(values, np.full(width - 1, END, values.dtype)), width)


def windows(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """For texts laid out one after the other (each with its end), in chunks of windows of one shape: inputs, targets of
    the scored places, how many places before are not scored, and texts."""
    text, first, size, scored = spans(lengths)
    before, at, shape = shifted(ids, starts), starts[text] + first, size * WINDOW + scored
    order = np.argsort(shape, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(shape[order])) + 1):
        n, skip = int(size[same[0]]), int(scored[same[0]])
        inputs, targets = laid(before, n), laid(ids, n)
        for k in range(0, len(same), CHUNK):
            pick = same[k : k + CHUNK]
            yield inputs[at[pick]], targets[at[pick], skip:], skip, text[pick]


def scores(model: Model, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each text."""
    if not len(lengths):
        return np.zeros(0)
    starts = np.cumsum(lengths) - lengths
    out = np.add.reduceat(model.share[ids], starts, dtype=np.float64)
    held: list[tuple[np.ndarray, ...]] = []

    def flush():
        f, target = (np.concatenate(part) for part in list(zip(*held))[:2])
        logs, done = log_probabilities(model.weights, f, model.class_of[target], model.member[target]), 0
        for part, _, text in held:
            sums = logs[done : done + len(part)].reshape(len(text), -1).sum(1)
            out[:] += np.bincount(text, sums, len(out))
            done += len(part)
        held.clear()

    for inputs, targets, skip, text in windows(ids, starts, lengths):
        held.append((forward(model.weights, inputs, skip)[0].reshape(-1, WIDTH), targets.ravel(), text))
        if sum(len(part[1]) for part in held) >= POSITIONS:
            flush()
    if held:
        flush()
    return out / log(10)


class Learner:
    """Adam from given weights, one step for each batch of windows. Vectors of identifiers move when they are met."""

    def __init__(self, w: dict[str, np.ndarray], class_of: np.ndarray, member: np.ndarray):
        self.class_of, self.member = class_of, member
        self.names = [k for k in w if k != "token"]
        ends = np.cumsum([w[k].size for k in self.names])
        self.dense = np.concatenate([w[k].ravel() for k in self.names])
        self.weights = {k: part.reshape(w[k].shape) for k, part in zip(self.names, np.split(self.dense, ends[:-1]))} | {"token": w["token"].copy()}
        self.grad = np.zeros_like(self.dense)
        self.parts = dict(zip(self.names, np.split(self.grad, ends[:-1])))
        self.slow = [np.zeros_like(self.dense) for _ in range(2)], [np.zeros_like(w["token"]) for _ in range(2)]
        #: Steps, positions learned from, and how often each identifier was an input of one.
        self.steps, self.seen, self.met = 0, 0, np.zeros(IDS, np.int64)

    def learn(self, ids: np.ndarray, lengths: np.ndarray, rate: float) -> None:
        """From each position of the texts once, in windows that do not overlap, in a seeded order."""
        starts = np.cumsum(lengths) - lengths
        text, first, size, _ = spans(lengths, WINDOW)
        before, at = shifted(ids, starts), starts[text] + first
        rng, batch = np.random.default_rng([5, self.steps]), min(BATCH, max(32, len(text) // STEPS))
        order = rng.permutation(len(text))
        order = order[np.argsort(size[order], kind="stable")]
        batches = [order[k : k + batch] for k in range(0, len(order), batch)]
        laid_before, laid_ids = laid(before, WINDOW), laid(ids, WINDOW)
        for turn in rng.permutation(len(batches)):
            pick = batches[turn]
            n = size[pick[-1]]  # the longest of the batch
            inputs, targets = laid_before[at[pick], :n], laid_ids[at[pick], :n]
            live = np.arange(n) < size[pick][:, None]
            self.step(gradients(self.weights, inputs, self.class_of[targets], self.member[targets], live), rate)
        self.seen += len(ids)
        self.met += np.bincount(before, minlength=IDS)

    def step(self, g: dict, rate: float) -> None:
        self.steps += 1
        pace = np.float32(rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        rows, dx = g["token"]
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        rows = rows[order]
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        self.grad[:] = 0  # of members whose class was not met, and of places after the longest window
        for k, part in self.parts.items():
            if k in g:
                part[: g[k].size] = g[k].ravel()
        for (m, s), grad, at, target in zip(self.slow, (self.grad, np.add.reduceat(dx[order], starts)), (slice(None), rows[starts]), (self.dense, self.weights["token"])):
            m[at] = now = m[at] * np.float32(0.9) + grad * np.float32(0.1)
            s[at] = square = s[at] * np.float32(0.99) + grad * grad * np.float32(0.01)
            target[at] -= pace * now / (np.sqrt(square) + np.float32(1e-8))


def train(texts: list[list[int]], class_of: np.ndarray, member: np.ndarray, rate: float = 1e-2) -> dict[str, np.ndarray]:
    """The weights that one pass over the texts gives."""
    learner = Learner(initial(), class_of, member)
    if texts:
        learner.learn(np.concatenate([np.array(t, np.int32) for t in texts]), np.array([len(t) for t in texts]), rate)
    return learner.weights


# --- corpus --------------------------------------------------------------------------------------------------------


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, the numbers of the words of all texts in a row, and the words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found, lengths = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    full = pc.binary_length(found).to_numpy() > 0  # white space at an end leaves an empty one
    before = np.append(0, np.cumsum(full))
    ends = np.append(0, np.cumsum(lengths))
    coded = found.filter(pa.array(full)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int32), np.diff(before[ends])


def blocks(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Rows of BLOCK: whole documents, as numbers of the block's distinct words, and these words with their spelling."""

    def row(name: str, batches: list) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, texts, held = (table.column(i).combine_chunks() for i in range(3))
        words, numbers, lengths = split_words(texts)
        trained = ~held.to_numpy(zero_copy_only=False).astype(bool)
        seen = np.bincount(numbers[np.repeat(trained, lengths)], minlength=len(words))
        spelled, sizes = spellings(path, words.to_pylist())
        spread = np.bincount(spelled, np.repeat(seen, sizes), IDS)
        spread[END] += trained.sum()
        at = np.flatnonzero(spread)
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values).cast(kind))
        return pa.RecordBatch.from_arrays([
            pa.array([name]), one(words, pa.binary()), one(seen, pa.int64()), one(ids, pa.int64()), one(~trained, pa.bool_()), one(lengths, pa.int32()),
            *(pa.array([v.tobytes()], pa.binary()) for v in (numbers, spelled, sizes)), one(at, pa.int32()), one(spread[at].astype(np.int64), pa.int64()),
        ], schema=SCHEMA)

    def run(batches):
        from pyspark import TaskContext

        part, turn, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
            if size >= BLOCK_BYTES:
                yield row(f"{part}-{turn}", held)
                turn, size, held = turn + 1, 0, []
        if sum(b.num_rows for b in held):
            yield row(f"{part}-{turn}", held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held"))
    return rows.mapInArrow(run, BLOCK)


SCHEMA = pa.schema([
    ("block", pa.string()), ("words", pa.list_(pa.binary())), ("seen", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
    ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("numbers", pa.binary()), ("spelled", pa.binary()),
    ("sizes", pa.binary()), ("ids", pa.list_(pa.int32())), ("spread", pa.list_(pa.int64())),
])


def identifiers(row: dict, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of the kept documents of a block, each document with its end, and how many each has."""
    flat, sizes = (np.append(np.frombuffer(row[k], kind), last) for k, kind, last in (("spelled", np.uint16, END), ("sizes", np.int32, 1)))
    flat, sizes = flat.astype(np.int32), sizes.astype(np.int32)
    lengths = np.array(row["lengths"], np.int64)
    numbers = np.frombuffer(row["numbers"], np.int32)[np.repeat(keep, lengths)]
    lengths = lengths[keep]
    ends = np.cumsum(lengths)
    # the end is one more word, the last
    numbers = np.insert(numbers, ends, len(sizes) - 1)
    wide = np.take(sizes, numbers)
    per_word = np.append(0, np.cumsum(wide))
    begin = np.take(np.cumsum(sizes, dtype=np.int32) - sizes, numbers) - per_word[:-1].astype(np.int32)
    where = np.repeat(begin, wide)
    where += np.arange(len(where), dtype=np.int32)
    return np.take(flat, where), np.diff(per_word[np.append(0, ends + np.arange(1, len(ends) + 1))])


def counted(cut: DataFrame) -> DataFrame:
    """block, number of the word in it, its count in all training documents, and whether this is the first of its rows."""
    rows = cut.select("block", F.posexplode(F.arrays_zip("words", "seen")).alias("pos", "w"))
    same = Window.partitionBy("word").orderBy("block")
    rows = rows.select("block", "pos", F.col("w")["words"].alias("word"), F.col("w")["seen"].alias("seen"))
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select("block", "pos", F.sum("seen").over(every).alias("c"), (F.row_number().over(same) == 1).alias("first"))


def subword_counts(cut: DataFrame) -> np.ndarray:
    """How often each identifier stands in the training documents; the vocabulary bounds what reaches the driver."""
    rows = cut.select(F.inline(F.arrays_zip("ids", "spread"))).groupBy("ids").agg(F.sum("spread").alias("n"))
    out = np.zeros(IDS, np.float64)
    for r in rows.collect():
        out[r.ids] = r.n
    return out


def packed(w: dict[str, np.ndarray]) -> np.ndarray:
    """All weights as rows of WIDTH numbers, the vectors of the identifiers first."""
    rest = np.concatenate([v.ravel() for k, v in w.items() if k != "token"])
    return np.concatenate([w["token"], np.append(rest, np.zeros(-len(rest) % WIDTH, rest.dtype)).reshape(-1, WIDTH)])


def unpacked(rows: np.ndarray) -> dict[str, np.ndarray]:
    w, rest = initial(), rows[IDS:].ravel()
    for k, v in w.items():
        if k != "token":
            w[k], rest = rest[: v.size].reshape(v.shape), rest[v.size :]
    return w | {"token": rows[:IDS]}


def learned(cut: DataFrame, counts: np.ndarray, class_of: np.ndarray, member: np.ndarray) -> dict[str, np.ndarray]:
    """Weights from all training documents, each in one of ROUNDS: every task learns from its blocks, from the same weights as
    the others, and the weights of a round are the mean over its tasks, by the positions or inputs each has met."""
    w = initial()
    w["token"][counts == 0] = 0  # not met in training
    weights, since = packed(w), 0
    for until, rate in ROUNDS:
        now, first = weights, since

        def run(batches):
            learner = Learner(unpacked(now), class_of, member)
            for batch in batches:
                for row in batch.to_pylist():
                    turn = np.arange(len(row["held"])) % ROUNDS[-1][0]
                    keep = (turn >= first) & (turn < until) & ~np.array(row["held"], bool)
                    if keep.any():
                        learner.learn(*identifiers(row, keep), rate)
            if learner.seen:
                rows = packed(learner.weights)
                times = np.append(learner.met, np.full(len(rows) - IDS, learner.seen))
                at = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array(times[at], pa.int64()), *(pa.array(rows[at, i]) for i in range(WIDTH))], names=["at", "n", *places]
                )

        places = [f"w{i}" for i in range(WIDTH)]
        parts = cut.select("held", "lengths", "numbers", "spelled", "sizes").mapInArrow(run, f"at int, n long, {', '.join(f'{p} float' for p in places)}")
        mean = [(F.sum(F.col(p).cast("double") * F.col("n")) / F.sum("n")).alias(p) for p in places]
        weights = weights.copy()
        for r in parts.groupBy("at").agg(*mean).collect():
            weights[r[0]] = r[1:]
        since = until
    return unpacked(weights)


def score(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    cut = stored(blocks(docs, path), "blocks")
    known = stored(counted(cut), "words")
    trained = cut.select(F.explode("held").alias("held")).where("not held").count()
    facts = known.where("first and c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("c").alias("v")).first()
    total, distinct = facts.n + trained, facts.v + (trained > 0)
    spread = subword_counts(cut)
    class_of, member, share = classes(spread)
    weights = learned(cut, spread, class_of, member)
    met = np.flatnonzero(weights["token"].any(1))
    small = {k: v for k, v in weights.items() if k != "token"} | {"met": met.astype(np.int32), "rows": weights["token"][met]}
    share32, floor = share.astype(np.float32), log10(total + 0.1 * (distinct + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        token = np.zeros((IDS, WIDTH), np.float32)
        token[small["met"]] = small["rows"]
        model = Model({k: v for k, v in small.items() if k not in ("met", "rows")} | {"token": token}, class_of, member, share32)
        c = np.zeros(right.num_rows, np.int64)
        c[right.column("pos").to_numpy()] = right.column("c").to_numpy()
        logs = np.log10(c + 0.1)
        tables = []
        for row in left.to_pylist():
            numbers = np.frombuffer(row["numbers"], np.int32)
            lengths = np.array(row["lengths"], np.int64)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            n = len(lengths)
            base = np.bincount(owner, logs[numbers], n) + log10(trained + 0.1) - (lengths + 1) * floor
            hits = np.bincount(owner, c[numbers] > 0, n).astype(np.int64) + (trained > 0)
            tables.append(pa.table({
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(lengths + 1), "n_known": pa.array(hits), "train_tokens": pa.array(np.full(n, total)),
                "base_score": pa.array(base), "score": pa.array(scores(model, *identifiers(row, np.ones(n, bool)))),
            }))
        return pa.concat_tables(tables) if tables else OUT.empty_table()

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts = cut.select("block", "doc_ids", "held", "lengths", "numbers", "spelled", "sizes")
    return texts.groupBy("block").cogroup(known.select("block", "pos", "c").groupBy("block")).applyInArrow(run, schema)


OUT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])
