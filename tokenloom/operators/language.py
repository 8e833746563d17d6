"""A smoothed follower model over token ids, and the loss of labelled tokens under it.

The model is one table of counts per order. The highest order counts an id after the ids before it;
every lower order is summed from the one above, so the tokens are shuffled once. A probability mixes an
order's share with that of the next lower order, which takes over whole where a context is unknown. Losses are
computed once per distinct sequence of ids, then joined to the tokens that have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.constants import IGNORE_LABEL
from tokenloom.session import stage

#: Stands before the first id of a sequence.
BEFORE = -1


def _context(order: int) -> list[str]:
    """Columns of the ids before a token, the farthest first."""
    return [f"c{i}" for i in range(order - 1, 0, -1)]


def grams(df: DataFrame, keys: Sequence[str], ids: str, order: int, kept: Column | None = None) -> DataFrame:
    """Rows (keys..., pos, c..., id): every token with the ``order`` - 1 ids before it.

    ``kept`` is a list column as long as ``ids``; positions where it is the ignored label are left out.
    """
    def before(column: Column, back: int) -> Column:
        return F.when(column > back, F.get(ids, column - 1 - back)).otherwise(BEFORE)

    wanted = F.sequence(F.lit(1), F.size(ids))
    if kept is not None:
        wanted = F.filter(wanted, lambda i: F.get(kept, i - 1) != IGNORE_LABEL)
    wanted = F.when(F.size(ids) > 0, wanted)
    items = F.transform(wanted, lambda i: F.struct(
        i.alias("pos"), *[before(i, int(name[1:])).alias(name) for name in _context(order)], F.get(ids, i - 1).alias("id")
    ))
    # Outer, because a plain explode adds a filter that would compute the ids twice.
    rows = df.select(*keys, F.explode_outer(items).alias("_t")).where("_t IS NOT NULL")
    return rows.select(*keys, (F.col("_t.pos") - 1).alias("pos"), *[f"_t.{name}" for name in _context(order)], "_t.id")


class FollowerModel:
    """Counts by order, smallest first; ``mass`` is the weight of the lower order in a mixture."""

    def __init__(self, counts: list[DataFrame], kinds: int, mass: float):
        self.counts, self.kinds, self.mass = counts, kinds, mass

    @classmethod
    def fit(cls, df: DataFrame, ids: str, kinds: int, order: int = 2, mass: float = 10.0) -> FollowerModel:
        """``kinds``: number of possible ids, those never seen included."""
        tables = []
        for k in range(order, 0, -1):
            columns = [*_context(k), "id"]
            rows = tables[-1].groupBy(*columns).agg(F.sum("n").alias("n")) if tables else grams(df, [], ids, k).groupBy(*columns).agg(F.count("*").alias("n"))
            tables.append(stage(rows, f"followers-{k}"))
        return cls(tables[::-1], kinds, mass)

    def log_probabilities(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (distinct c..., id) with ``log_prob``."""
        whole = self.counts[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        rows = wanted.join(self.counts[0].withColumnRenamed("n", "_n"), ["id"], "left")
        rows = rows.withColumn("_p", (F.coalesce("_n", F.lit(0)) + 1) / F.lit(float(whole + self.kinds))).drop("_n")
        for k, counts in enumerate(self.counts[1:], 2):
            context = _context(k)
            totals = counts.groupBy(*context).agg(F.sum("n").alias("_total"))
            rows = rows.join(counts.withColumnRenamed("n", "_n"), [*context, "id"], "left").join(totals, context, "left")
            share = (F.coalesce("_n", F.lit(0)) + self.mass * F.col("_p")) / (F.coalesce("_total", F.lit(0)) + self.mass)
            rows = rows.withColumn("_p", share).drop("_n", "_total")
        return rows.withColumn("log_prob", F.log("_p")).drop("_p")

    def token_losses(self, df: DataFrame, keys: Sequence[str], ids: str, labels: str) -> DataFrame:
        """Rows (keys..., pos, id, loss) of the tokens whose label is not the ignored one."""
        order = len(self.counts)
        tokens = stage(grams(df, keys, ids, order, F.col(labels)), "labelled-tokens")
        columns = [*_context(order), "id"]
        known = stage(self.log_probabilities(tokens.select(*columns).distinct()), "gram-losses")
        # Frequent sequences are hot on the token side only; adaptive execution splits them.
        return tokens.join(known, columns).select(*keys, "pos", "id", (-F.col("log_prob")).alias("loss"))


def masked_loss(losses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys..., n_tokens, loss, perplexity): mean over the labelled tokens of a group."""
    return losses.groupBy(*keys).agg(F.count("*").alias("n_tokens"), F.avg("loss").alias("loss")).withColumn("perplexity", F.exp("loss"))
