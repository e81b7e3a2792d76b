"""Mixing sources to target weights by a temperature.

Source shares of the corpus' tokens p_i become weights p_i**a / sum(p**a). The
exponent a in [0, 1] is bisected: it is the largest one whose weights reach the
target entropy, lowered no further than the repetition limit allows (no source may
be asked for more than ``max_epochs`` times its own length); a = 1 keeps the shares. Lengths are in
tokens, the words of a text; ``mix`` by itself, without a ``measure``, takes characters.

The weights are realised as budgeted block permutations. Each source's documents are
hashed into blocks of about ``block_rows``; in each epoch a source's blocks, and the
documents within a block, follow that epoch's pseudo-random order. A source gives
whole epochs while its budget lasts, then whole blocks, then the documents of one
block as long as they begin within the budget. Cumulative sums run over block totals
and, in the one block at the edge, over documents, so a hot source is many blocks.

Defined results: null source is a source of its own, null or empty text has length 0
and takes part (it goes wherever its block goes). Repeated rows are rows of their
own. An empty table, or one without length, gives each row once. Extra columns pass, but
for those named ``mix_epoch``, ``mix_block`` or ``mix_order``, which the results replace.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, shared_dir, ship_package, stored, table, without

TARGET_ENTROPY = 0.97  # of the logarithm of the number of sources
MAX_EPOCHS = 4.0
BLOCK_ROWS = 512
SEED = 17
RANGE_BITS = 10


def weights(sizes: dict, exponent: float) -> dict:
    """Normalised size**exponent; sources without length get none."""
    top = max(sizes.values(), default=0)
    raw = {k: (v / top) ** exponent if v > 0 else 0.0 for k, v in sizes.items()}
    total = sum(raw.values())
    return {k: v / total if total else 0.0 for k, v in raw.items()}


def entropy(w: dict) -> float:
    return -sum(x * math.log(x) for x in w.values() if x > 0)


def solve_exponent(sizes: dict, budget: float, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS) -> float:
    """The exponent in [0, 1]; both bounds are monotone in it, so each is bisected."""
    live = {k: v for k, v in sizes.items() if v > 0}
    if len(live) < 2:
        return 1.0
    goal = target_entropy * math.log(len(live))

    def bisect(reached) -> float:
        """The largest a for which reached(a), where smaller ones reach it too."""
        if reached(1.0):
            return 1.0
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if reached(mid) else (lo, mid)
        return lo

    flat = bisect(lambda a: entropy(weights(live, a)) >= goal)
    within = lambda a: all(w * budget <= max_epochs * live[k] for k, w in weights(live, a).items())
    if within(flat):
        return flat
    # A larger exponent repeats small sources less: the smallest one within the limit.
    return 1.0 - bisect(lambda b: within(1.0 - b))


def n_tokens(text: str) -> Column:
    """Words of the text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _order(epoch: Column, *of: Column) -> Column:
    return F.xxhash64(F.lit(SEED), epoch, *of)


def _placed(rows: DataFrame, keys: list[str], order: Column, ties: list[str], length: Column, work: str) -> DataFrame:
    """``rows`` with ``at`` (their rank within the keys by the order, from 0) and ``to`` (the lengths up to and with it).

    Ranks and sums run over ranges of the order's values first, then within a range, so
    the rows of one key are many small groups.
    """
    cut = F.shiftright(order, 64 - RANGE_BITS)
    rows = rows.withColumn("__o", order).withColumn("__r", cut).withColumn("__l", length)
    ranges = rows.groupBy(*keys, "__r").agg(F.count(F.lit(1)).alias("__n"), F.sum("__l").alias("__t"))
    before = Window.partitionBy(*keys).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ranges = ranges.select(*keys, "__r", F.coalesce(F.sum("__n").over(before), zero).alias("__n"), F.coalesce(F.sum("__t").over(before), zero).alias("__t"))
    # At most 2**RANGE_BITS rows of a key.
    ranges = stored(ranges, f"{work}-ranges")
    inner = Window.partitionBy(*keys, "__r").orderBy("__o", *ties)
    rows = rows.withColumn("at", F.row_number().over(inner) - 1).withColumn("to", F.sum("__l").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.join(ranges, [*keys, "__r"])
    return rows.withColumn("at", (F.col("at") + F.col("__n")).cast("long")).withColumn("to", F.col("to") + F.col("__t")).drop("__o", "__r", "__l", "__n", "__t")


def mix(docs: DataFrame, source: str = "source", text: str = "text", identity: tuple = ("doc_id",), budget: float | None = None, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS, block_rows: int = BLOCK_ROWS, measure: Column | None = None) -> DataFrame:
    """Rows of ``docs``, one for each time a row is taken, with their place in the permutation:
    ``mix_epoch``, ``mix_block`` (rank of the block in its source's epoch, from 0) and ``mix_order``
    (a hash that orders the rows of a block in that epoch; equal for repeated rows).

    ``measure`` is a document's length (characters without it). ``budget`` is such a
    length; without it, that of all documents.
    """
    spark = docs.sparkSession
    ship_package(spark)
    work = shared_dir(spark, "mixing")
    docs = without(docs, "mix_epoch", "mix_block", "mix_order")
    columns = docs.columns
    size = F.coalesce(F.length(text) if measure is None else measure, F.lit(0)).cast("long")
    name = F.coalesce(F.col(source).cast("string"), F.lit("\x00null"))
    # Working columns have names of their own; what selects rows is written once, without texts.
    own = lambda c: F.col(f"__mix_{c}")
    key = F.xxhash64(*[F.col(c) for c in identity], F.length(text))
    marked = docs.withColumn("__mix_s", name).withColumn("__mix_h", key)
    thin = stored(marked.select(own("s").alias("s"), own("h").alias("h"), size.alias("n")), f"{work}/thin")
    totals = {r["s"]: (r["rows"], r["size"]) for r in thin.groupBy("s").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size")).collect()}
    sizes = {k: v[1] for k, v in totals.items()}
    budget = float(sum(sizes.values())) if budget is None else float(budget)
    a = solve_exponent(sizes, budget, target_entropy, max_epochs)
    w = weights(sizes, a)
    none = F.lit(0).cast("long")
    if not sum(sizes.values()):
        return docs.withColumn("mix_epoch", none).withColumn("mix_block", none).withColumn("mix_order", _order(none, key))
    # One row for each source: its rows are on the driver already, as an aggregate.
    plan = spark.createDataFrame(
        [(k, max(1, -(-v[0] // block_rows)), int(v[1]), float(w[k] * budget), int(w[k] * budget // v[1]) if v[1] else 1) for k, v in totals.items()],
        "s string, blocks long, size long, budget double, whole long",
    )
    plan = F.broadcast(plan)
    in_block = lambda h: F.pmod(h, F.col("blocks"))
    thin = thin.join(plan, "s").withColumn("b", in_block(F.col("h")))
    blocks = thin.groupBy("s", "b", "size", "budget", "whole").agg(F.sum("n").alias("len"))
    # Every block in each whole epoch and in the last, partial one.
    blocks = stored(blocks.withColumn("epoch", F.explode(F.sequence(none, F.col("whole")))), f"{work}/blocks")
    placed = _placed(blocks, ["s", "epoch"], _order(F.col("epoch"), F.col("s"), F.col("b")), ["b"], F.col("len"), f"{work}/placed")
    left = F.col("budget") - F.col("whole") * F.col("size")
    last = F.col("epoch") == F.col("whole")
    placed = placed.withColumn("all", ~last | (F.col("to") <= left)).withColumn("room", left - F.col("to") + F.col("len"))
    placed = stored(placed.where(F.col("all") | (F.col("room") > 0)).select("s", "b", "epoch", "at", "all", "room"), f"{work}/taken")
    # The edge blocks: at most one for each source, about block_rows rows each.
    edge = placed.where("not all").select("s", "b", "room")
    inner = Window.partitionBy("s", "b").orderBy(_order(F.col("whole"), F.col("h")), "h").rowsBetween(Window.unboundedPreceding, -1)
    cut = thin.join(F.broadcast(edge), ["s", "b"]).withColumn("before", F.coalesce(F.sum("n").over(inner), none))
    cut = cut.where(F.col("before") < F.col("room")).select(F.col("s").alias("__mix_s"), F.col("h").alias("__mix_h")).distinct().withColumn("__mix_in", F.lit(True))
    epochs = placed.groupBy("s", "b").agg(F.collect_list(F.struct("epoch", "at", "all")).alias("times")).select(*[F.col(c).alias(f"__mix_{c}") for c in ("s", "b", "times")])
    # A block of up to max_epochs + 1 times is about 200 bytes, its source's name aside.
    small = placed.agg(F.coalesce(F.sum(F.length("s") + 64), none).alias("n")).first()["n"] <= 32 << 20
    epochs = F.broadcast(epochs) if small else epochs
    named = F.broadcast(plan.select(F.col("s").alias("__mix_s"), F.col("blocks").alias("__mix_blocks")))
    rows = marked.join(named, "__mix_s").withColumn("__mix_b", F.pmod(own("h"), own("blocks")))
    rows = rows.join(epochs, ["__mix_s", "__mix_b"]).join(F.broadcast(cut), ["__mix_s", "__mix_h"], "left")
    rows = rows.withColumn("__mix_t", F.explode(F.filter(own("times"), lambda t: t["all"] | F.coalesce(own("in"), F.lit(False)))))
    return rows.select(*[F.col(f"`{c}`") for c in columns], own("t")["epoch"].alias("mix_epoch"), own("t")["at"].alias("mix_block"), _order(own("t")["epoch"], own("h")).alias("mix_order"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, measure=n_tokens("text")).select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "mix_epoch", "mix_block", "mix_order")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return mix(docs, measure=n_tokens("text")).select(*columns)
