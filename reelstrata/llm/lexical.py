r"""Ranked lexical search by the Best Position Algorithm.

Terms are the maximal runs of ASCII letters, digits and characters outside ASCII, with A-Z lower-cased. A document's score
for an item is the sum over the item's terms, repeats included, of the term's weight times its impact in the document;
both are whole numbers (see `weights` and `impacts`).

Items come in blocks of bounded size, each against all documents. One pass tokenises the texts and stores, per
document, its length and the frequencies of the block's terms; N, L and df come from these. A second pass deals the stored
documents out in shards. A shard holds an impact list per term, sorted by impact, and the place of every document in
each list. For an item, its lists are read in step from the top. A document met for the first time is scored
at once by direct access to the item's other lists, and its places there count as seen too. The best position of a list is
the end of its seen stretch from the top, and the weighted impacts at the best positions add up to a threshold that no
unseen document exceeds. Reading stops when the threshold is strictly below the score of the k-th result, so that
documents with equal scores are all met. The k results of a task go on from shard to shard, and the results of the tasks meet in two steps,
first per item and part of the ids, then per item.

Defined results: NULL and empty texts have no terms; documents without terms do not count into N and are no result; a row of
`benchmark` is an item of its own, with a repeated or NULL id too; items without terms, or whose terms no document holds,
have no rows; repeated documents count and rank each; among equal scores NULL ids come last.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstrata.llm.common import stored

TOP = 20
#: Term occurrences, and items, that a block of items holds at most; an item with more terms is a block of its own.
BLOCK_TERMS, BLOCK_ITEMS = 1 << 18, 4_096
#: Postings, and documents, that a shard holds at most.
SHARD_POSTINGS, SHARD_DOCS = 1 << 21, 1 << 14
#: Places that the first step reads in every list; each further step reads twice as many as the one before.
STEP = 64
#: Parts of the ids in which the results of the tasks meet first.
PARTS = 64


def _folded() -> bytes:
    """Separators become blanks, A-Z small letters, all other bytes stay."""
    kept = lambda b: b >= 0x80 or chr(b).isalnum()
    return bytes((b + 32 if 65 <= b <= 90 else b) if kept(b) else 32 for b in range(256))


FOLDED = _folded()


def terms(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return raw.translate(FOLDED).split()


def item_blocks(items: Iterable, most_terms: int = BLOCK_TERMS, most_items: int = BLOCK_ITEMS) -> Iterator[list]:
    """Lists of (number, item_id, terms) that stay within the limits of a block."""
    block, size = [], 0
    for number, row in enumerate(items):
        found = terms(row.text)
        if not found:
            continue
        if block and (size + len(found) > most_terms or len(block) >= most_items):
            yield block
            block, size = [], 0
        block.append((number, row.item_id, found))
        size += len(found)
    if block:
        yield block


# --- index ---------------------------------------------------------------------------------------------------------

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<long>"


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its id, its number of terms, and its frequencies of the vocabulary's terms."""

    def run(batches):
        for batch in batches:
            kept, sizes, found, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = terms(text.as_py())
                if not words:
                    continue
                tf = Counter(words)
                known = tf.keys() & vocabulary.keys()
                found += [vocabulary[w] for w in known]
                counts += [tf[w] for w in known]
                ends.append(len(found))
                kept.append(doc_id.as_py())
                sizes.append(len(words))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kept, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, POSTINGS)


def weights(index: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2df + 1))) per term of the block; terms that no document holds weigh nothing."""
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * n_docs + 2) / (2 * F.col("df") + 1)).cast("double")))
    found = np.zeros(size, np.int64)
    for row in df.select("term", weight.cast("long").alias("w")).collect():
        found[row.term] = row.w
    return found


def impacts(tf: np.ndarray, doc_of: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m), where m is 75 + (25 n N) div L of the document."""
    m = np.array([75 + 25 * k * n_docs // n_terms for k in n.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m[doc_of])


class Shard:
    """Impact lists of some documents: documents by falling impact, their impacts, and the places of the documents."""

    def __init__(self, doc_of: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int):
        order = np.lexsort((doc_of, -impact, term))
        self.size, self.docs, self.impact = size, doc_of[order], impact[order]
        self.words, self.start = np.unique(term[order], return_index=True)
        self.end = np.append(self.start[1:], len(order))
        self.list_of = {int(t): k for k, t in enumerate(self.words)}
        self.dense: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Place (-1 where it has none) and impact (0) of every document in list k: the direct access."""
        if k not in self.dense:
            place, value = np.full(self.size, -1, np.int32), np.zeros(self.size, np.int32)
            at = slice(self.start[k], self.end[k])
            place[self.docs[at]] = np.arange(self.end[k] - self.start[k], dtype=np.int32)
            value[self.docs[at]] = self.impact[at]
            self.dense[k] = place, value
        return self.dense[k]

    def forget(self, most: int = 512) -> None:
        """Bound the memory of the direct accesses."""
        while len(self.dense) > most:
            self.dense.pop(next(iter(self.dense)))


def best_positions(shard: Shard, lists: list[int], weight: list[int], floor: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of the shard that may be among the first k, their scores, and the places read.

    `floor` is a score that at least k documents of other shards reach or exceed; 0 if there are fewer."""
    weight = np.array(weight, np.int64)
    sizes = [int(shard.end[j] - shard.start[j]) for j in lists]
    seen = [np.zeros(n + 1, bool) for n in sizes]  # the last place stands for the end of the list and stays unseen
    best = [0] * len(lists)
    met = np.zeros(shard.size, bool)
    docs, scores = [], []
    depth, step, kth = 0, STEP, floor
    while True:
        read = [shard.docs[shard.start[j] + depth : min(shard.start[j] + depth + step, shard.end[j])] for j in lists]
        new = np.unique(np.concatenate(read))
        new = new[~met[new]]
        met[new] = True
        score = np.zeros(len(new), np.int64)
        for i, j in enumerate(lists):
            place, value = shard.places(j)
            score += weight[i] * value[new]
            at = place[new]
            seen[i][at[at >= 0]] = True
        docs.append(new)
        scores.append(score)
        depth, step = depth + step, step * 2
        threshold = 0
        for i, j in enumerate(lists):
            best[i] += int(np.argmin(seen[i][best[i] :]))
            # impacts fall along a list, so what is unseen is at most as large as the last of the seen stretch
            if best[i] < sizes[i]:
                threshold += int(weight[i]) * int(shard.impact[shard.start[j] + best[i] - 1])
        found = np.concatenate(scores)
        if len(found) >= k:
            kth = max(kth, int(np.partition(found, len(found) - k)[len(found) - k]))
        if threshold < max(kth, 1) or depth >= max(sizes):
            keep = found >= max(kth, 1)
            return np.concatenate(docs)[keep], found[keep], depth


def _searcher(items: list, vocabulary: dict[bytes, int], weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    """The task function: shards from the batches, the k results per item go on from shard to shard."""
    wanted = []
    for number, _, found in items:
        repeats = Counter(vocabulary[w] for w in found)
        wanted.append((number, [(t, c * int(weight[t])) for t, c in repeats.items() if weight[t] > 0]))

    def key(score, doc_id):
        return score, doc_id is not None, -(doc_id or 0)

    def shards(batches):
        for batch in batches:
            ends = np.append(0, np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)))
            at = 0
            while at < batch.num_rows:
                upto = int(np.searchsorted(ends, ends[at] + SHARD_POSTINGS, "right")) - 1
                upto = min(max(upto, at + 1), at + SHARD_DOCS, batch.num_rows)
                yield batch.slice(at, upto - at)
                at = upto

    def run(batches):
        top: dict[int, list] = {number: [] for number, _ in wanted}
        for part in shards(batches):
            ids = part.column(0).to_pylist()
            n = part.column(1).to_numpy()
            term = part.column(2).flatten().to_numpy()
            tf = part.column(3).flatten().to_numpy()
            doc_of = np.repeat(np.arange(len(n)), pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False))
            shard = Shard(doc_of, term, impacts(tf, doc_of, n, n_docs, n_terms), len(n))
            for number, asked in wanted:
                pairs = [(shard.list_of[t], w) for t, w in asked if t in shard.list_of]
                if not pairs:
                    continue
                held = top[number]
                floor = held[0][0][0] if len(held) == k else 0
                docs, scores, _ = best_positions(shard, [j for j, _ in pairs], [w for _, w in pairs], floor, k)
                for d, s in zip(docs.tolist(), scores.tolist()):
                    entry = key(s, ids[d]), ids[d]
                    if len(held) < k:
                        heapq.heappush(held, (entry[0], ids[d] is None, ids[d] or 0))
                    elif entry[0] > held[0][0]:
                        heapq.heapreplace(held, (entry[0], ids[d] is None, ids[d] or 0))
                shard.forget()
        rows = [(number, None if none else doc, rank[0]) for number, held in top.items() for rank, none, doc in held]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["number", "doc_id", "score"])

    return run


# --- search --------------------------------------------------------------------------------------------------------


def first_k(rows: DataFrame, k: int) -> DataFrame:
    """`number, rank, doc_id, score`: the k best per item, first within parts of the ids and then of the whole."""
    order = F.desc("score"), F.asc_nulls_last("doc_id")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    near = Window.partitionBy("number", "part").orderBy(*order)
    whole = Window.partitionBy("number").orderBy(*order)
    kept = rows.withColumn("part", part).withColumn("r", F.row_number().over(near)).where(F.col("r") <= k)
    return kept.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).select("number", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """`item_id, rank, doc_id, score`: the k best documents of every item.

    The items are the stated queries: blocks of them come to the driver one at a time and go out with the tasks."""
    spark, results = docs.sparkSession, []
    kind = items.schema["item_id"].dataType.simpleString()
    for block in item_blocks(items.select("item_id", "text").toLocalIterator()):
        vocabulary = {w: i for i, w in enumerate(sorted({w for *_, found in block for w in found}))}
        index = stored(forward(docs, vocabulary), "postings")
        whole = index.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        if not whole.n:
            continue
        weight = weights(index, whole.n, len(vocabulary))
        found = index.mapInArrow(
            _searcher(block, vocabulary, weight, whole.n, whole.l, k), "number long, doc_id long, score long"
        )
        ids = spark.createDataFrame([(number, item) for number, item, _ in block], f"number long, item_id {kind}")
        results.append(first_k(found, k).join(ids, "number").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    while len(results) > 1:
        results = [a.unionByName(b[0]) if b else a for a, *b in (results[i : i + 2] for i in range(0, len(results), 2))]
    return results[0]


# the same rows in DuckDB, from all scores
SEARCH_SQL = rf"""
WITH found AS (
  SELECT doc_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
asked AS (
  SELECT i, item_id, t, count(*) AS times FROM (
    SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)) GROUP BY ALL),
sizes AS (SELECT r, doc_id, count(*) AS n FROM found GROUP BY ALL),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
tfs AS (SELECT r, t, count(*) AS tf FROM found GROUP BY ALL),
dfs AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, whole GROUP BY t, n_docs),
scored AS (
  SELECT i, item_id, r, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN tfs USING (t) JOIN dfs USING (t) JOIN sizes USING (r), whole GROUP BY i, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
