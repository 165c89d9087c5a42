"""Temperature mixing of sources to target weights, in DataFrame operations alone.

Each source's share of tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are), bisected to
the largest one that meets an entropy target and a repetition limit. The normalised weights become token budgets,
and each budget is filled by passes over the source's blocks, every pass in a permutation of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import checkpointed

#: Entropy aimed at, as a part of the largest that the sources allow; the most passes over a source; tokens in a block.
ENTROPY, MAX_EPOCHS, BLOCK_TOKENS = 0.9, 2.0, 1 << 16
SEED = 20_231
#: Halvings of the exponent's range that one job looks ahead, and jobs.
AHEAD, ROUNDS = 6, 5
WORD = r"[^\x20\x09-\x0D]+"


def tokens_of(text: Column) -> Column:
    """Words and one end."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


@dataclass
class Mixture:
    """Weights are share ** exponent / norm; budget tokens are dealt out."""

    exponent: float
    norm: float
    budget: float
    total: int


def _sums(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent the sum of share ** exponent, and of that by the logarithm of the share."""
    at = shares.select("p", F.explode(F.array(*map(F.lit, exponents))).alias("x"))
    rows = at.groupBy("x").agg(F.sum(F.pow("p", "x")).alias("z"), F.sum(F.pow("p", "x") * F.log("p")).alias("s")).collect()
    return {r["x"]: (r["z"], r["s"]) for r in rows}


def solve(sources: DataFrame, entropy: float, max_epochs: float, budget: float | None) -> Mixture:
    """The mixture of sources (columns source, t): the driver gets a few numbers a job, whatever the sources' number.

    Entropy falls as the exponent grows, and so do the passes over the smallest source; where both limits can't be
    met, repetition binds. Without a budget it is the least that covers every source once.
    """
    r = sources.agg(F.sum("t").alias("t"), F.min("t").alias("low"), F.max("t").alias("high"), F.count(F.lit(1)).alias("n")).first()
    if not r["n"]:
        return Mixture(1.0, 1.0, 0.0, 0)
    total, low, high = r["t"], r["low"] / r["t"], r["high"] / r["t"]
    shares = sources.select((F.col("t") / F.lit(float(total))).alias("p"))
    import math

    goal = entropy * math.log(r["n"])

    def spent(x: float, z: float) -> float:
        return budget if budget is not None else total * z * high ** (1 - x)

    def too_even(x: float, z: float, s: float) -> bool:
        return spent(x, z) / total * low ** (x - 1) / z > max_epochs * (1 + 1e-12)

    def too_uneven(x: float, z: float, s: float) -> bool:
        return math.log(z) - x * s / z < goal

    def bisect(below) -> float:
        """Where below, true from 0 up to some exponent, turns false; the end of the range where it doesn't."""
        a, b = 0.0, 1.0
        for _ in range(ROUNDS):
            step = (b - a) / (1 << AHEAD)
            marks = [a + step * i for i in range((1 << AHEAD) + 1)]
            got = _sums(shares, marks)
            lo, hi = 0, 1 << AHEAD
            if not below(marks[lo], *got[marks[lo]]):
                return marks[lo]
            if below(marks[hi], *got[marks[hi]]):
                return marks[hi]
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if below(marks[mid], *got[marks[mid]]) else (lo, mid)
            a, b = marks[lo], marks[hi]
        return b

    x = bisect(lambda *v: not too_uneven(*v))  # the largest exponent that keeps the entropy
    floor = bisect(too_even)
    x = max(x, floor)
    z = _sums(shares, [x])[x][0]
    return Mixture(x, z, spent(x, z), total)


#: Columns that mixed() adds.
ADDED = ("mix_tokens", "mix_weight", "mix_epoch", "mix_key")


def _before(rows: DataFrame, keys: list[str], cells: Column, turn: Column, value: str) -> DataFrame:
    """rows with before: the sum of value of the rows before it in its keys' permutation, by cells and turns.

    Two levels of prefix sums: over the sums of cells, and within a cell. With as many cells as the square root of a
    group's rows no window is wider than about that. Null keys are keys like any other.
    """
    placed = rows.withColumn("turn", turn).withColumn("cell", F.pmod(F.shiftrightunsigned("turn", 20), cells))
    whole = placed.groupBy(*keys, "cell").agg(F.sum(value).alias("whole"))
    earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(*(F.col(k).alias(f"of_{k}") for k in keys), F.col("cell").alias("of_cell"), F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("ahead"))
    within = Window.partitionBy(*keys, "cell").orderBy("turn", "mix_block").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("behind", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = F.col("cell") == F.col("of_cell")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    return own.join(whole, same).withColumn("before", F.col("ahead") + F.col("behind")).drop("turn", "cell", "behind", "ahead", "of_cell", *(f"of_{k}" for k in keys))


def _taken(docs: DataFrame, entropy: float, max_epochs: float, budget: float | None) -> DataFrame:
    """mix_row (a row of docs as one struct, so that no name clashes) and the added columns."""
    hashed = F.xxhash64(F.lit(SEED), "doc_id", "text")
    sized = docs.select(F.struct("*").alias("mix_row"), "source", tokens_of(F.col("text")).alias("mix_tokens"), hashed.alias("mix_hash"))
    light = checkpointed(sized.select("source", "mix_tokens", "mix_hash"))
    sources = checkpointed(light.groupBy("source").agg(F.sum("mix_tokens").alias("t")))
    m = solve(sources, entropy, max_epochs, budget)
    weight = F.pow(F.col("t") / float(m.total or 1), F.lit(m.exponent)) / m.norm
    goals = sources.select("source", "t", weight.alias("mix_weight"), (weight * m.budget).alias("goal"), F.ceil(F.col("t") / BLOCK_TOKENS).alias("blocks"))
    goals = checkpointed(goals)

    def blocked(rows: DataFrame) -> DataFrame:
        g = goals.withColumnRenamed("source", "mix_source")
        return rows.join(g, F.col("source").eqNullSafe(F.col("mix_source"))).withColumn("mix_block", F.pmod(F.col("mix_hash"), F.col("blocks")))

    blocks = blocked(light).groupBy("source", "mix_block", "t", "mix_weight", "goal", "blocks").agg(F.sum("mix_tokens").alias("own"))
    passes = blocks.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("goal") / F.col("t") - 1e-9) - 1).cast("long"))))
    turn = F.xxhash64(F.lit(SEED), "source", "mix_epoch", "mix_block")
    placed = _before(passes, ["source", "mix_epoch"], F.ceil(F.sqrt("blocks")), turn, "own").withColumnRenamed("before", "start")
    left = F.col("goal") - F.col("mix_epoch") * F.col("t") + F.lit(1e-6) * F.col("t")
    plan = placed.withColumn("left", left).where("start < left")
    plan = checkpointed(plan.withColumns({"cut": F.col("start") + F.col("own") > F.col("left"), "mix_key": (F.col("mix_epoch") * F.col("t") + F.col("start")) / F.col("goal"), "mix_span": F.col("own") / F.col("goal")}))

    # documents of the blocks that a budget cuts through: at most one block a source
    order = F.xxhash64(F.lit(SEED), "mix_epoch", "mix_hash")
    cut = plan.where("cut").select(F.col("source").alias("s"), F.col("mix_block").alias("b"), "mix_epoch", "start", "left")
    within = blocked(light).join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("mix_block") == F.col("b"))).withColumn("o", order)
    filled = F.sum("mix_tokens").over(Window.partitionBy("source", "mix_block", "mix_epoch").orderBy("o"))
    last = within.withColumn("filled", filled).where("start + filled <= left").groupBy("source", "mix_block", "mix_epoch").agg(F.max("o").alias("last"))
    named = [F.col(c).alias(f"mix_{c}") if not c.startswith("mix_") else F.col(c) for c in ("source", "mix_block", "mix_epoch", "cut", "mix_key", "mix_span", "last")]
    last = last.select(F.col("source").alias("s"), F.col("mix_block").alias("b"), F.col("mix_epoch").alias("e"), "last")
    plan = plan.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("mix_block") == F.col("b")) & (F.col("mix_epoch") == F.col("e")), "left").select("mix_weight", *named)

    p = plan.withColumnsRenamed({"mix_source": "plan_source", "mix_block": "plan_block", "mix_weight": "plan_weight"})
    taken = blocked(sized).join(p, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("mix_block") == F.col("plan_block")))
    taken = taken.where(~F.col("mix_cut") | (order <= F.col("mix_last")))
    place = F.shiftrightunsigned(order, 11) / float(1 << 53)  # of a document in its block
    return taken.select("mix_row", "mix_tokens", "mix_weight", "mix_epoch", F.least(F.lit(1.0), F.col("mix_key") + F.col("mix_span") * place).alias("mix_key"))


def mixed(docs: DataFrame, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS, budget: float | None = None) -> DataFrame:
    """docs' rows as often as the mixture takes them, with their columns, mix_tokens, mix_weight, mix_epoch, mix_key.

    mix_key (0 to 1) orders all rows into the mixture: at any point of that order the sources have had their weights'
    part of the tokens, to a block. A pass that the budget ends within takes the first blocks of its permutation, and
    of the block cut through, documents in order of a hash while they fit. Without a budget every document is taken
    at least once and none more than max_epochs rounded up.

    Null and empty texts are one token, a very long one is as many as it has and never cut; null sources are a source
    of their own; documents are told apart by doc_id and text, so repeated rows share their fate, as null doc_ids
    with equal texts do. Blocks that tie in their turn come by number. Columns of docs named as one of ADDED give way
    to it, all others stay. An empty table gives an empty one. Blocks of a source hold about BLOCK_TOKENS, so a hot
    source is many groups, and their order's sums are taken in two levels: of a source of b blocks no window holds
    more than about the square root of b (12,400 for 10^13 tokens), nor one of documents more than a block's.
    """
    names = [F.col("mix_row.`" + c.replace("`", "``") + "`") for c in docs.columns if c not in ADDED]
    return _taken(docs, entropy, max_epochs, budget).select(*names, *ADDED)


def repeated(docs: DataFrame, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS, budget: float | None = None) -> DataFrame:
    """The rows of mixed() with the columns of docs alone, whatever their names."""
    return _taken(docs, entropy, max_epochs, budget).select("mix_row.*")


def mixing_digest(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, weight, epoch, mix_key of each row of the mixture."""
    got = mixed(docs.select("doc_id", "text", "source"))
    return got.select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_weight").alias("weight"), F.col("mix_epoch").alias("epoch"), "mix_key")
