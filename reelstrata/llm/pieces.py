"""Encoding into the pieces of a SentencePiece vocabulary, and decoding, by a max-plus parallel scan.

The pieces of a text are the segmentation with the largest sum of piece scores. A position that no piece can
cross splits the text into segments that are solved on their own and remembered. Giant documents are cut into
chunks of a fixed number of characters, whose boundaries pieces may cross: the state at a boundary is the
number of characters of the next chunk that the crossing piece covers. Every chunk yields the max-plus
matrix of best scores from each state at its start to each state at its end; the matrices of a document
are combined associatively by a prefix scan, which fixes all boundary states; then every chunk is
backtraced on its own.

As the vocabulary file defines it, a space becomes U+2581, one more is put in front of a text that is not
empty, and characters without a piece become their bytes.

Defined results: a NULL or empty text has no pieces and comes back as the empty text; a text that itself
contains U+2581 comes back with spaces in its place (round_trip is false); where two segmentations have the
same score, the one with the longer last piece wins inside a segment; repeated rows stay repeated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstrata.llm.common import fresh, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters of a chunk. Longer documents are cut.
CHUNK = 32_768
#: Segments that a Python worker remembers at most, and the characters of the longest.
MEMORY, LONGEST = 400_000, 64
LOWEST = -1e300


@dataclass
class Pieces:
    """ids and scores by piece, bytes by id; `widest` is the length of the longest piece."""

    ids: dict[str, int]
    scores: dict[str, float]
    raw: list[bytes]
    byte_ids: list[int]
    unknown: int
    widest: int

    def __post_init__(self):
        letters = {c for piece in self.ids if len(piece) > 1 for c in piece} - {MARK}
        inside = "".join(re.escape(c) for c in sorted(letters))
        splits = any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.ids)
        # a character of no longer piece stands alone; a mark opens a segment unless a piece holds one inside
        if not letters:
            rule = "."
        elif splits:
            rule = f"[{MARK}{inside}]+|[^{MARK}{inside}]"
        else:
            rule = f"{MARK}*[{inside}]+|{MARK}+|[^{MARK}{inside}]"
        self.rule = rule
        self.lone = min(self.scores.values(), default=0.0) - 10

    @cached_property
    def trie(self) -> dict:
        """The pieces by characters; the score of a piece stands under the empty key."""
        root: dict = {}
        for piece, score in self.scores.items():
            node = root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score
        return root

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "trie"}

    def segments(self, marked: str) -> list[str]:
        return re.findall(self.rule, marked, re.DOTALL)


def load(path: str = MODEL) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(path).read_bytes())
    ids, scores, raw, byte_ids = {}, {}, [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            raw.append(b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            raw.append(piece.replace(MARK, " ").encode())
    return Pieces(ids, scores, raw, byte_ids, model.unk_id(), max(map(len, ids)))


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def best_ends(pieces: Pieces, s: str, start: int, limit: int) -> tuple[list[float], list[int]]:
    """Best score to reach each position of `s` from `start`, and where its last piece begins.

    Pieces begin before `limit` only. Earlier beginnings win ties."""
    n = len(s)
    score, origin = [LOWEST] * (n + 1), [-1] * (n + 1)
    score[start] = 0.0
    trie, lone = pieces.trie, pieces.lone
    for i in range(start, min(limit, n)):
        here = score[i]
        if here == LOWEST:
            continue
        node, j = trie.get(s[i]), i + 1
        value = here + (lone if node is None else node.get("", lone))
        if value > score[j]:
            score[j], origin[j] = value, i
        while node is not None and j < n:
            node = node.get(s[j])
            if node is None:
                break
            j += 1
            value = node.get("")
            if value is not None and here + value > score[j]:
                score[j], origin[j] = here + value, i
    return score, origin


def trace(pieces: Pieces, s: str, origin: list[int], end: int) -> list[int]:
    found: list[int] = []
    while origin[end] >= 0:
        piece = s[origin[end] : end]
        if piece in pieces.ids:
            found.append(pieces.ids[piece])
        else:
            found.extend(pieces.byte_ids[b] for b in reversed(piece.encode("utf-8", "surrogatepass")))
        end = origin[end]
    return found[::-1]


class Solved(dict):
    """Best pieces by segment; forgets everything when full."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, segment: str) -> tuple[int, ...]:
        _, origin = best_ends(self.pieces, segment, 0, len(segment))
        found = tuple(trace(self.pieces, segment, origin, len(segment)))
        if len(segment) <= LONGEST:
            if len(self) >= MEMORY:
                self.clear()
            self[segment] = found
        return found


SOLVED: dict[str, Solved] = {}


def solved(pieces: Pieces) -> Solved:
    """What this worker remembers for the vocabulary, across tasks."""
    key = f"{len(pieces.raw)}:{hash(tuple(pieces.raw))}:{hash(tuple(pieces.scores.values()))}"
    return SOLVED.setdefault(key, Solved(pieces))


def pieces_of(memory: Solved, s: str) -> np.ndarray:
    """Ids of a marked text."""
    return np.fromiter(chain.from_iterable(map(memory.__getitem__, memory.pieces.segments(s))), np.int32)


def text_of(pieces: Pieces, ids) -> str:
    """The text that the ids stand for; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join(map(pieces.raw.__getitem__, ids))
    return raw.decode("utf-8", "replace")[1:] if raw.startswith(b" ") else raw.decode("utf-8", "replace")


def frame_of(parts: list[np.ndarray], same: list[bool] | None = None) -> pa.StructArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
    columns = {"ids": ids, "n_tokens": pa.array(np.diff(offsets).astype(np.int64), pa.int64())}
    if same is not None:
        columns["round_trip"] = pa.array(same, pa.bool_())
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def whole(pieces: Pieces):
    @F.arrow_udf("ids array<int>, n_tokens long, round_trip boolean")
    def run(texts: pa.Array) -> pa.Array:
        memory, parts, same = solved(pieces), [], []
        for text in texts.to_pylist():
            text = text or ""
            parts.append(pieces_of(memory, marked(text)))
            same.append(text_of(pieces, parts[-1].tolist()) == text)
        return frame_of(parts, same)

    return run


def edges(pieces: Pieces, s: str, size: int) -> tuple[int, int]:
    """The first and the last position in 1..size that no piece crosses; (0, 0) if there is none.

    `s` is a chunk of `size` characters followed by the characters that a crossing piece may reach."""
    at, first, last = 0, 0, 0
    for segment in pieces.segments(s):
        at += len(segment)
        if at > size or at == len(s) > size:
            break
        first, last = first or at, at
    return first, last


def matrix(memory: Solved, s: str, size: int) -> np.ndarray:
    """Best scores from each state at the start of a chunk to each state at its end."""
    pieces = memory.pieces
    out = np.full((pieces.widest, pieces.widest), LOWEST)
    first, last = edges(pieces, s, size)
    begin = min(pieces.widest, size + 1)
    if not first:
        for state in range(begin):
            if state == size:
                out[state, 0] = 0.0
                continue
            score, _ = best_ends(pieces, s, state, size)
            reach = score[size : size + pieces.widest]
            out[state, : len(reach)] = reach
    else:
        inner = 0.0
        for segment in pieces.segments(s[first:last]):
            ends, _ = best_ends(pieces, segment, 0, len(segment)) if segment not in LENGTHS else (LENGTHS[segment], None)
            if len(segment) <= LONGEST:
                if len(LENGTHS) >= MEMORY:
                    LENGTHS.clear()
                LENGTHS[segment] = ends[-1:]
            inner += ends[-1]
        tail, _ = best_ends(pieces, s[last:], 0, size - last)
        reach = np.array(tail[size - last : size - last + pieces.widest])
        for state in range(min(begin, first + 1)):
            head, _ = best_ends(pieces, s[:first], state, first)
            if head[first] > LOWEST:
                out[state, : len(reach)] = np.where(reach > LOWEST, head[first] + inner + reach, LOWEST)
    return out


#: Best score of a segment, remembered by a worker.
LENGTHS: dict[str, list[float]] = {}


def backtrace(memory: Solved, s: str, size: int, state: int, out: int) -> np.ndarray:
    """Ids of the pieces that begin in a chunk, given the states at both ends."""
    pieces = memory.pieces
    first, last = edges(pieces, s, size)
    if not first:
        _, origin = best_ends(pieces, s, state, size)
        return np.array(trace(pieces, s, origin, size + out), np.int32)
    _, head = best_ends(pieces, s[:first], state, first)
    _, tail = best_ends(pieces, s[last:], 0, size - last)
    return np.concatenate([
        np.array(trace(pieces, s[:first], head, first), np.int32),
        pieces_of(memory, s[first:last]),
        np.array(trace(pieces, s[last:], tail, size - last + out), np.int32),
    ])


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of matrices in which + is max and * is +."""
    return np.maximum((a[..., :, :, None] + b[..., None, :, :]).max(-2), LOWEST)


def prefixes(matrices: np.ndarray) -> np.ndarray:
    """All prefix products, by an associative scan of logarithmic depth."""
    out, reach = matrices.copy(), 1
    while reach < len(out):
        out[reach:] = max_plus(out[:-reach], out[reach:])
        reach *= 2
    return out


def states(matrices: np.ndarray) -> list[int]:
    """The state at the start of each chunk, and 0 at the end of the last."""
    upto, after, found = prefixes(matrices), 0, [0]
    for k in range(len(matrices) - 1, 0, -1):
        after = int((upto[k - 1][0] + matrices[k][:, after]).argmax())
        found.append(after)
    return [0, *found[:0:-1], 0]


def chunked(giants: DataFrame, chunk: int, widest: int) -> DataFrame:
    """A row per chunk of the marked text: its number, the characters, and how many of them are its own."""
    s = F.concat(F.lit(MARK), F.translate("text", " ", MARK))
    size = F.length("text") + 1
    return giants.select(
        "key", s.alias("s"), size.alias("size"),
        F.explode(F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))).alias("k"),
    ).select(
        "key", "k",
        F.substring(F.col("s"), F.col("k") * chunk + 1, F.lit(chunk + widest - 1)).alias("part"),
        F.least(F.lit(chunk), F.col("size") - F.col("k") * chunk).cast("int").alias("own"),
    )


def encode_giants(giants: DataFrame, pieces: Pieces, chunk: int) -> DataFrame:
    """key and ids for rows of key and text. A document is one cell, so its chunks number 2 GB / chunk at most."""

    @F.arrow_udf("binary")
    def transfer(parts: pa.Array, own: pa.Array) -> pa.Array:
        memory = solved(pieces)
        found = [matrix(memory, s, n).tobytes() for s, n in zip(parts.to_pylist(), own.to_pylist())]
        return pa.array(found, pa.binary())

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        stack = np.stack([np.frombuffer(m).reshape(pieces.widest, pieces.widest) for m in rows["m"]])
        at = states(stack)
        return pd.DataFrame({"key": rows["key"].values, "k": rows["k"].values, "into": at[:-1], "out": at[1:]})

    @F.arrow_udf("ids array<int>, n_tokens long")
    def follow(parts: pa.Array, own: pa.Array, into: pa.Array, out: pa.Array) -> pa.Array:
        memory = solved(pieces)
        columns = [c.to_pylist() for c in (parts, own, into, out)]
        return frame_of([backtrace(memory, *row) for row in zip(*columns)])

    parts = stored(chunked(giants, chunk, pieces.widest), "chunks")
    matrices = parts.select("key", "k", transfer("part", "own").alias("m"))
    bounds = matrices.groupBy("key").applyInPandas(scan, "key string, k int, into int, out int")
    traced = parts.join(bounds, ["key", "k"]).select("key", "k", follow("part", "own", "into", "out").alias("f"))
    return (
        traced.groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("k", F.col("f")["ids"].alias("ids")))).alias("all"))
        .select("key", F.flatten(F.col("all")["ids"]).alias("ids"))
    )


def encode(docs: DataFrame, pieces: Pieces, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids, n_tokens and whether decoding the ids gives the text back, for every row."""
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    small = docs.where(~giant).select("doc_id", whole(pieces)("text").alias("f")).select("doc_id", "f.*")
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    giants = (
        docs.where(giant)
        .groupBy("doc_id", "text")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("key", F.concat_ws("/", id_text, F.sha2("text", 256)))
    )

    @F.arrow_udf("boolean")
    def same(texts: pa.Array, ids: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), ids.to_numpy(zero_copy_only=False))
        return pa.array([text_of(pieces, found.tolist()) == text for text, found in pairs], pa.bool_())

    found = encode_giants(giants.select("key", "text"), pieces, chunk)
    large = giants.join(found, "key").select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), same("text", "ids").alias("round_trip"), "times"
    )
    large = large.withColumn("times", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).drop("times")
    return small.unionByName(large)


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """The rows with a column `decoded` (or a name like it that is free) holding the text of `ids`."""

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        parts = ids.to_numpy(zero_copy_only=False)
        return pa.array(["" if p is None else text_of(pieces, p.tolist()) for p in parts], pa.string())

    return encoded.withColumn(fresh(encoded, "decoded"), run("ids"))


def vocabulary(spark: SparkSession, path: str = MODEL) -> Pieces:
    """The vocabulary read on the driver; tasks get it with their code (about 1 MB, fixed by the file)."""
    return load(path)
