"""Mixing sources to target weights by temperature.

Shares of source tokens are raised to an exponent between 0 (all sources alike) and 1 (natural shares) and
normalised. The exponent is bisected so that the weights reach a target entropy, then raised further if
the smallest source would be repeated more often than allowed. Each source gets its weight of the token
budget: whole passes over all its documents, then a partial pass in the order of a block permutation.

Defined results: a NULL source is a source of its own; a NULL or empty text has 0 tokens; repeated rows
count each; sources without tokens get weight 0 and no copies; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstrata.llm.common import fresh, stored, words

#: Levels of bisection answered by one pass over the source totals, and the number of passes.
LEVELS, PASSES = 5, 6


@dataclass(frozen=True)
class Mix:
    """entropy: target entropy of the weights as a share of the largest possible one. repetition: how often a
    source may be repeated at most, as far as any exponent allows it. budget: tokens of the mixture as a
    multiple of the tokens there are. block_tokens: tokens of a block of the permutation."""

    entropy: float = 0.95
    repetition: float = 4.0
    budget: float = 1.0
    block_tokens: int = 1 << 20
    seed: str = "mix"


def midpoints(low: int, high: int) -> list[int]:
    """Inner grid points of [low, high], whose length is a power of two: the tree of the next bisections."""
    step = max(1, (high - low) >> LEVELS)
    return list(range(low + step, high, step))


def exponent(shares: DataFrame, mix: Mix) -> float:
    """The least exponent on a grid of 2^30 steps that meets both the entropy and the repetition limit; 1 if none does.

    Every pass reads the shares (column share, all above 0) once and answers LEVELS steps of both bisections."""
    size = 1 << (LEVELS * PASSES)
    p, t = F.col("share"), F.col("t")

    def spread(r):  # the entropy falls as the exponent grows
        return log(r.z) - r.t * r.e / r.z <= mix.entropy * log(r.n) + 1e-12

    def repeats(r):  # of the smallest source, which is repeated most
        return mix.budget * r.least ** (r.t - 1) / r.z <= mix.repetition + 1e-12

    spans = {spread: (0, size), repeats: (0, size)}
    for _ in range(PASSES):
        grids = {test: midpoints(*span) for test, span in spans.items()}
        points = sorted({k for grid in grids.values() for k in grid})
        rows = (
            shares.select("share", F.explode(F.lit([k / size for k in points])).alias("t"))
            .groupBy("t")
            .agg(
                F.count(p).alias("n"), F.min(p).alias("least"),
                F.sum(F.pow(p, t)).alias("z"), F.sum(F.pow(p, t) * F.log(p)).alias("e"),
            )
            .collect()
        )
        found = {r.t: r for r in rows}
        if not found:
            return 1.0
        for test, grid in grids.items():
            low, high = spans[test]
            first = next((i for i, k in enumerate(grid) if test(found[k / size])), len(grid))
            spans[test] = ([low, *grid][first], [*grid, high][first])
    return round(max(high for _, high in spans.values()) / size, 6)


def block_order(mix: Mix, source: Column, block: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(mix.seed), F.coalesce(source, F.lit("\x00")), block.cast("string")))


def document_draw(mix: Mix) -> Column:
    """What decides the place of a document: its id and its text, so that rows that share an id or have none are dealt apart."""
    id_text, text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(mix.seed), id_text, F.md5(text)))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, source, n_tokens, weight of the source, passes (whole ones), copies of the document in the mixture."""
    counted = stored(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.size(words(F.col("text"))).cast("long").alias("n_tokens"),
            document_draw(mix).alias("draw"),
        ),
        "mix",
    )
    return dealt_copies(counted, mix).drop("draw")


def dealt_copies(counted: DataFrame, mix: Mix) -> DataFrame:
    """The columns of `mixed`, and the draw, for rows of doc_id, source, n_tokens and draw."""
    sources = stored(counted.groupBy("source").agg(F.sum("n_tokens").alias("total")), "sources")
    whole = sources.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("all")).first()["all"]
    shares = sources.where("total > 0").withColumn("share", F.col("total") / F.lit(float(whole or 1)))
    t = exponent(shares, mix)
    z = shares.agg(F.sum(F.pow("share", F.lit(t))).alias("z")).first().z or 1.0
    weight = F.round(F.pow(F.col("total") / F.lit(float(whole or 1)), F.lit(t)) / F.lit(z), 9)
    budget = F.floor(weight * F.lit(float(int(whole * mix.budget))))
    plan = sources.select(
        F.col("source").alias("s"),
        F.when(F.col("total") > 0, weight).otherwise(0.0).alias("weight"),
        F.when(F.col("total") > 0, F.floor(budget / F.col("total"))).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("total") > 0, budget.cast("long") % F.col("total")).otherwise(0).cast("long").alias("rest"),
        F.ceil(F.greatest(F.col("total"), F.lit(1)) / F.lit(mix.block_tokens)).cast("long").alias("n_blocks"),
    )
    draw = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    dealt = counted.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", draw % F.col("n_blocks")).drop("s")
    # a block is bounded, so a hot source is dealt over as many tasks as it has blocks
    blocks = (
        dealt.groupBy("source", "block", "rest")
        .agg(F.sum("n_tokens").alias("tokens"))
        .withColumn("turn", block_order(mix, F.col("source"), F.col("block")))
        .withColumn("part", F.substring("turn", 1, 3))
    )
    # the running total in two levels: 4,096 parts of a source, then the blocks of a part
    parts = blocks.groupBy("source", "part").agg(F.sum("tokens").alias("part_tokens"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("source").alias("p_source"),
        F.col("part").alias("p_part"),
        F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"),
    )
    inside = Window.partitionBy("source", "part").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        blocks.withColumn("start", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .join(parts, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
        .select(
            F.col("source").alias("b_source"),
            F.col("block").alias("b_block"),
            (F.col("rest") - F.col("start") - F.col("part_start")).alias("room"),
        )
    )
    upto = Window.partitionBy("source", "block").orderBy("draw", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    return (
        dealt.withColumn("upto", F.sum("n_tokens").over(upto))
        .join(placed, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block")))
        .select(
            "doc_id",
            "source",
            "n_tokens",
            "draw",
            "weight",
            "passes",
            (F.col("passes") + F.when((F.col("n_tokens") > 0) & (F.col("upto") <= F.col("room")), 1).otherwise(0)).alias("copies"),
        )
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of `docs`, each as often as the mixture holds it. Rows are told apart by id, source and text; those that
    agree in all three share their copies evenly, and what is left over goes to the first of them in the order of their other columns."""
    mark = fresh(docs, "mixed_copies")
    source, draw = F.col("source").cast("string"), document_draw(mix)
    counted = docs.select("doc_id", source.alias("source"), F.size(words(F.col("text"))).cast("long").alias("n_tokens"), draw.alias("draw"))
    copies = dealt_copies(stored(counted, "mix"), mix).groupBy("source", "draw")
    copies = stored(copies.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")), "copies")
    named = copies.select(*[F.col(c).alias(f"{mark}_{c}") for c in copies.columns])
    same = docs["source"].cast("string").eqNullSafe(F.col(f"{mark}_source")) & (draw == F.col(f"{mark}_draw"))
    met = docs.join(named, same).where(F.col(f"{mark}_copies") > 0)
    share = F.floor(F.col(f"{mark}_copies") / F.col(f"{mark}_rows"))
    rows = met.where(F.col(f"{mark}_rows") == 1).withColumn(mark, share).select(*docs.columns, mark)
    if not copies.where("rows > 1").isEmpty():
        ordered = [docs[c] for c, kind in docs.dtypes if c != "text" and "map<" not in kind and "variant" not in kind]
        turn = F.row_number().over(Window.partitionBy(f"{mark}_source", f"{mark}_draw").orderBy(*ordered))
        rest = F.col(f"{mark}_copies") - share * F.col(f"{mark}_rows")
        alike = met.where(F.col(f"{mark}_rows") > 1).withColumn(f"{mark}_turn", turn)
        alike = alike.withColumn(mark, share + F.when(F.col(f"{mark}_turn") <= rest, 1).otherwise(0))
        rows = rows.unionByName(alike.select(*docs.columns, mark))
    times = F.explode(F.array_repeat(F.lit(0), F.col(mark).cast("int")))
    return rows.where(F.col(mark) > 0).withColumn(mark, times).select(*docs.columns)


def mix_sql(mix: Mix = Mix(), table: str = "documents", prefix: str = "") -> str:
    """The same rows in DuckDB: the bisection as a recursive query over the list of shares."""
    return f"""
WITH RECURSIVE {prefix}
counted AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens,
         md5('{mix.seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS draw
  FROM {table}),
sources AS (SELECT source, sum(n_tokens)::BIGINT AS total FROM counted GROUP BY source),
whole AS (SELECT coalesce(sum(total), 0)::BIGINT AS total FROM sources),
shares AS (SELECT list(s.total / w.total::DOUBLE) AS p, len(list(s.total)) AS n FROM sources s, whole w WHERE s.total > 0),
bisection AS (
  SELECT 0 AS step, 0::BIGINT AS e_low, (1::BIGINT << 30) AS e_high, 0::BIGINT AS r_low, (1::BIGINT << 30) AS r_high
  UNION ALL
  SELECT step + 1,
    CASE WHEN e_ok THEN e_low ELSE e_mid END, CASE WHEN e_ok THEN e_mid ELSE e_high END,
    CASE WHEN r_ok THEN r_low ELSE r_mid END, CASE WHEN r_ok THEN r_mid ELSE r_high END
  FROM (
    SELECT b.*, (e_low + e_high) // 2 AS e_mid, (r_low + r_high) // 2 AS r_mid,
      ln(list_sum(list_transform(p, lambda x: pow(x, ((e_low + e_high) // 2) / (1::BIGINT << 30)::DOUBLE))))
      - ((e_low + e_high) // 2) / (1::BIGINT << 30)::DOUBLE
        * list_sum(list_transform(p, lambda x: pow(x, ((e_low + e_high) // 2) / (1::BIGINT << 30)::DOUBLE) * ln(x)))
        / list_sum(list_transform(p, lambda x: pow(x, ((e_low + e_high) // 2) / (1::BIGINT << 30)::DOUBLE)))
      <= {mix.entropy} * ln(n) + 1e-12 AS e_ok,
      {mix.budget} * pow(list_min(p), ((r_low + r_high) // 2) / (1::BIGINT << 30)::DOUBLE - 1)
        / list_sum(list_transform(p, lambda x: pow(x, ((r_low + r_high) // 2) / (1::BIGINT << 30)::DOUBLE)))
      <= {mix.repetition} + 1e-12 AS r_ok
    FROM bisection b, shares WHERE step < 30)),
exponent AS (SELECT greatest(round(e_high / (1::BIGINT << 30)::DOUBLE, 6), round(r_high / (1::BIGINT << 30)::DOUBLE, 6)) AS t
             FROM bisection WHERE step = 30),
weights AS (
  SELECT source, s.total, CASE WHEN s.total > 0
    THEN round(pow(s.total / w.total::DOUBLE, t) / list_sum(list_transform(p, lambda x: pow(x, t))), 9) ELSE 0.0 END AS weight,
    floor(w.total * {mix.budget}) AS budget
  FROM sources s, whole w, shares, exponent),
plan AS (
  SELECT source, weight, CASE WHEN total > 0 THEN floor(weight * budget)::BIGINT // total ELSE 0 END AS passes,
    CASE WHEN total > 0 THEN floor(weight * budget)::BIGINT % total ELSE 0 END AS rest,
    ceil(greatest(total, 1) / {mix.block_tokens}::DOUBLE)::BIGINT AS n_blocks
  FROM weights),
dealt AS (
  SELECT c.*, weight, passes, rest, ('0x' || substr(draw, 1, 8))::BIGINT % n_blocks AS block
  FROM counted c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source),
blocks AS (
  SELECT source AS b_source, block AS b_block, rest, sum(n_tokens) AS tokens,
    md5('{mix.seed}|' || coalesce(source, chr(0)) || '|' || block::VARCHAR) AS turn
  FROM dealt GROUP BY ALL),
placed AS (
  SELECT b_source, b_block, rest - coalesce(sum(tokens) OVER (PARTITION BY b_source ORDER BY turn, b_block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM blocks),
ranked AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, block ORDER BY draw, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM dealt)
SELECT doc_id, source, n_tokens, weight, passes,
  passes + CASE WHEN n_tokens > 0 AND upto <= room THEN 1 ELSE 0 END AS copies
FROM ranked JOIN placed ON source IS NOT DISTINCT FROM b_source AND block = b_block"""
