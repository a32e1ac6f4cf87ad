"""Mix sources to target weights by temperature.

A source with token share ``p`` gets the weight ``p ^ exponent``, normalised. The
exponent is bisected: the largest whose weights reach a target entropy, or the smallest
that repeats no source more often than a limit allows. Weights become token budgets, and a budget
is filled with permutations of the source's documents, epoch after epoch.

A permutation is the order of a hash. It is cut into blocks of about
``BLOCK_DOCS`` documents, so a running token count needs the documents of one block, the
sums of ``FAN`` blocks and the sums of such groups, and never a whole source.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranking import row_numbers
from .common import pick, saved

#: Documents of a block on average, and blocks of a group.
BLOCK_DOCS, FAN = 1024, 1024
#: Exponents tried in one job: as many as STEPS halvings need.
STEPS = 5
ROUNDS = 8
#: Epochs that one array lists at most.
EPOCHS = 1000
#: Exponents lie in this interval: 0 makes sources equal, 1 leaves their shares.
LOW, HIGH = 0.0, 1.0
WORD = r"[^\x20\x09-\x0D]+"


def source_shares(tokens: DataFrame) -> DataFrame:
    """``source, tokens, docs, share`` of every source with tokens."""
    sums = (tokens.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
        .filter("tokens > 0"))
    total = sums.agg(F.sum("tokens")).scalar()
    return sums.withColumn("total", total).select(
        "source", "tokens", "docs", (F.col("tokens") / F.col("total")).alias("share"), "total")


def _entropy(exponent: float) -> Column:
    """Entropy of the weights as a share of the largest possible."""
    w = F.pow("share", F.lit(exponent))
    h = F.log(F.sum(w)) - F.sum(w * F.lit(exponent) * F.log("share")) / F.sum(w)
    return F.when(F.count(F.lit(1)) > 1, h / F.log(F.count(F.lit(1)))).otherwise(1.0)


def _repetition(exponent: float, budget: float) -> Column:
    """How often the most repeated source is read, ``budget`` in totals."""
    w = F.pow("share", F.lit(exponent))
    return F.max(w / F.col("share")) / F.sum(w) * F.lit(budget)


def find_exponent(shares: DataFrame, target_entropy: float | None, max_repetition: float | None,
                  budget: float) -> float:
    """The exponent in [0, 1], to six places, that is nearest to the plain shares.

    With a target entropy: the largest exponent whose weights reach it. With a
    repetition limit: the smallest within it, so the sources come as close to even
    as the limit allows. With both: the largest that reaches the entropy, or, where that
    repeats a source too often, the smallest within the limit, which is the harder of the two.
    Both measures fall as the exponent grows. Every job tries all exponents that the next
    ``STEPS`` halvings may ask for.
    """
    if target_entropy is None and max_repetition is None:
        raise ValueError("give a target entropy or a repetition limit")
    found = []
    if target_entropy is not None:
        if target_entropy > 1:
            raise ValueError(f"the target entropy {target_entropy} is over 1, that of even sources")
        found.append(_bisected(shares, _entropy, target_entropy, True))
    if max_repetition is not None:
        if budget > max_repetition * (1 + 1e-9):
            raise ValueError(
                f"{budget} totals need a repetition limit of that size, not {max_repetition}")
        found.append(_bisected(shares, lambda e: _repetition(e, budget), max_repetition, False))
    return max(found)


def _bisected(shares: DataFrame, measure: Callable[[float], Column], limit: float,
              at_least: bool) -> float:
    """The largest exponent that measures ``limit`` at least, or the smallest that does at most.

    No shares at all give the plain ones.
    """
    low, high = LOW, HIGH
    ends = shares.agg(measure(low).alias("low"), measure(high).alias("high")).first()
    if ends["low"] is None or at_least and ends["high"] >= limit:
        return HIGH
    if not at_least and ends["low"] <= limit:
        return LOW
    for _ in range(ROUNDS):
        n = 1 << STEPS
        tried = [low + (high - low) * k / n for k in range(1, n)]
        found = shares.agg(*[measure(e).alias(f"m{k}") for k, e in enumerate(tried)]).first()
        first = next((k for k in range(n - 1) if found[k] <= limit), n - 1)
        low, high = [low, *tried][first], [*tried, high][first]
    return (math.floor(low * 1e6 + 1e-3) if at_least else math.ceil(high * 1e6 - 1e-3)) / 1e6


def _numbered(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``own``: what tells rows apart that share their id, or have none.

    Empty where an id is there once. Else the hash of the text and the number of the row among
    those equal in both, so that each row is drawn for itself.
    """
    ids = tokens.groupBy(F.col("doc_id").alias("_doc")).agg(F.count(F.lit(1)).alias("_n"))
    shared = ids.filter("_n > 1 OR _doc IS NULL").select("_doc")
    if shared.isEmpty():
        return tokens.withColumn("own", F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("_doc"))
    copies = row_numbers(tokens.join(shared, same, "left_semi"), ["source", "doc_id", "text_hash"],
                         ["_row"], "_copy")
    own = F.concat(F.lit("|"), F.col("text_hash").cast("string"), F.lit("|"),
                   F.col("_copy").cast("string"))
    return tokens.join(shared, same, "left_anti").withColumn("own", F.lit("")).unionByName(
        copies.withColumn("own", own).drop("_copy"))


def mix_sources(docs: DataFrame, target_entropy: float | None = None,
                max_repetition: float | None = None, budget: float = 1.0,
                block_tokens: int = 1 << 20, seed: int = 42, doc_id: str = "doc_id",
                text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, epoch, n_tokens, position, mix_block, exponent, weight``.

    One row per document and epoch that the budget of its source reaches. ``budget``
    is the size of the mix in totals of the input. The mix is in order of
    ``position`` (0 to 1), which is the same share of every source's budget, so each of
    the ``mix_block`` pieces of about ``block_tokens`` tokens has the target weights. The
    document that crosses the end of a budget is the last one in.

    Tokens are words between ASCII white space; null texts have none. A null source is
    a source of its own. A source without tokens gets no budget and no rows. A row
    that repeats is drawn as often as it is there. Rows without an id, or with the same one,
    are spread by the hashes of their texts, equal texts by a number. An empty table gives an
    empty mix. At least one limit must be given; with both, the repetition limit holds
    wherever they disagree. One that no exponent in [0, 1] meets raises ``ValueError``.
    """
    tokens = saved(pick(docs, doc_id=doc_id, source=source, text=text).select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("_row")))
    shares = saved(source_shares(tokens))
    exponent = find_exponent(shares, target_entropy, max_repetition, budget)
    power = F.pow("share", F.lit(exponent))
    norm = shares.agg(F.sum(power)).scalar()
    plan = shares.withColumn("norm", norm).select(
        F.col("source").alias("_source"), "tokens", "total", (power / F.col("norm")).alias("weight"),
        F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).alias("blocks"),
        F.floor(power / F.col("norm") * F.col("total") * F.lit(float(budget))).alias("budget"))
    epochs = F.ceil(F.col("budget") / F.col("tokens"))
    lot = F.col("_lot") * EPOCHS
    drawn = (_numbered(tokens).join(plan, F.col("source").eqNullSafe(F.col("_source")))
             .filter("budget > 0")
             # No array per row is longer than EPOCHS or a share of the epochs.
             .withColumn("_lot", F.explode(F.sequence(
                 F.lit(0).cast("bigint"), F.floor((epochs - 1) / EPOCHS))))
             .withColumn("epoch", F.explode(F.sequence(
                 lot, F.least(lot + EPOCHS, epochs) - 1)))
             .withColumn("r", F.conv(F.substring(F.md5(F.concat(
                 F.lit(f"{seed}|"), F.col("epoch").cast("string"), F.lit("|"),
                 F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "own")), 1, 15), 16, 10)
                 .cast("bigint"))
             .withColumn("block", F.floor(
                 F.col("r") / F.lit(float(1 << 60)) * F.col("blocks"))))
    group = F.floor(F.col("block") / FAN)
    sums = (drawn.groupBy("_source", "epoch", "block").agg(F.sum("n_tokens").alias("n"))
            .withColumn("group", group))

    def before(value: str, part: list[str], order: list[str]) -> Column:
        w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(w), F.lit(0))

    groups = sums.groupBy("_source", "epoch", "group").agg(F.sum("n").alias("n")).select(
        F.col("_source").alias("g_source"), F.col("epoch").alias("g_epoch"),
        F.col("group").alias("g_group"),
        before("n", ["_source", "epoch"], ["group"]).alias("before_group"))
    starts = sums.withColumn(
        "before_block", before("n", ["_source", "epoch", "group"], ["block"])).join(
        groups, F.col("_source").eqNullSafe(F.col("g_source"))
        & (F.col("epoch") == F.col("g_epoch")) & (F.col("group") == F.col("g_group"))).select(
        F.col("_source").alias("b_source"), F.col("epoch").alias("b_epoch"),
        F.col("block").alias("b_block"),
        (F.col("before_group") + F.col("before_block")).alias("before_block"))
    placed = (drawn.withColumn("inside", before(
        "n_tokens", ["_source", "epoch", "block"], ["r", "doc_id", "own", "n_tokens"]))
        .join(starts, F.col("_source").eqNullSafe(F.col("b_source"))
              & (F.col("epoch") == F.col("b_epoch")) & (F.col("block") == F.col("b_block")))
        .withColumn("start", F.col("epoch") * F.col("tokens") + F.col("before_block")
                    + F.col("inside"))
        .filter("start < budget"))
    pieces = F.ceil(F.col("total") * F.lit(float(budget)) / F.lit(block_tokens))
    position = F.col("start") / F.col("budget")
    return placed.select(
        "doc_id", "source", "epoch", "n_tokens", position.alias("position"),
        F.floor(position * pieces).alias("mix_block"),
        F.lit(exponent).alias("exponent"), F.round("weight", 9).alias("weight"))


def oracle(target_entropy: float, seed: int = 42, block_tokens: int = 1 << 20) -> str:
    """The mix of ``documents`` at a target entropy, for a budget of one total."""
    return rf"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents),
sums AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs
  FROM tokens GROUP BY source HAVING sum(n_tokens) > 0),
shares AS (
  SELECT *, tokens / (SELECT sum(tokens) FROM sums)::DOUBLE AS share,
         (SELECT sum(tokens) FROM sums)::BIGINT AS total FROM sums),
halved AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN h <= {target_entropy} THEN low ELSE mid END,
         CASE WHEN h <= {target_entropy} THEN mid ELSE high END
  FROM (SELECT step, low, high, (low + high) / 2 AS mid,
               (SELECT (ln(sum(pow(share, (low + high) / 2)))
                        - sum(pow(share, (low + high) / 2) * ((low + high) / 2) * ln(share))
                          / sum(pow(share, (low + high) / 2))) / ln(count(*))
                FROM shares) AS h
        FROM halved WHERE step < 40)),
chosen AS (
  SELECT CASE WHEN (SELECT count(*) FROM shares) < 2 OR (
                SELECT -sum(share * ln(share)) / ln(count(*)) FROM shares) >= {target_entropy}
              THEN 1.0 ELSE floor(low * 1e6 + 1e-3) / 1e6 END AS exponent
  FROM halved WHERE step = 40),
weighted AS (
  SELECT s.*, c.exponent,
         pow(share, exponent) / (SELECT sum(pow(share, exponent)) FROM shares, chosen) AS weight
  FROM shares s, chosen c),
plan AS (
  SELECT *, floor(weight * total * 1.0)::BIGINT AS budget FROM weighted),
drawn AS (
  SELECT t.doc_id, t.source, t.n_tokens, p.tokens, p.total, p.budget, p.weight, p.exponent,
         unnest(range(ceil(budget / tokens::DOUBLE)::BIGINT)) AS epoch
  FROM tokens t JOIN plan p ON t.source IS NOT DISTINCT FROM p.source WHERE p.budget > 0),
ranked AS (
  SELECT *, ('0x' || substr(md5('{seed}|' || epoch || '|' || coalesce(doc_id::VARCHAR, '')), 1, 15)
            )::BIGINT AS r FROM drawn),
placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (
              PARTITION BY source, epoch ORDER BY r, doc_id, n_tokens
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM ranked)
SELECT doc_id, source, epoch, n_tokens, start / budget::DOUBLE AS position,
       floor(start / budget::DOUBLE * ceil(total * 1.0::DOUBLE / {block_tokens}))::BIGINT AS mix_block,
       exponent, round(weight, 9) AS weight
FROM placed WHERE start < budget
"""
