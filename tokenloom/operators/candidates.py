"""Next-token candidates: rows (ctx, token, weight, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.order import uniform
from tokenloom.functions.vectors import let, total
from tokenloom.operators.tokens import pretokenize
from tokenloom.session import stage

# Width of the score bands in log_sum_exp_by; far below the overflow of exp.
BAND = 64
# Most options of all lists together that are broadcast; they are counted first.
BROADCAST_OPTIONS = 500_000
# Prompts are continued apart by the number of distinct pieces in them, so a long one lengthens no other's option lists.
HISTORIES = (256, 4_096)
# Rows for which the lists of larger tables get one more salt, and most salts.
SALT_ROWS = 250_000
MAX_SALTS = 16
# A pick first looks at the head of its list: so many options more than it keeps.
LEAD = 15


def next_token_scores(df: DataFrame, text: str = "text", end_token: str | None = None) -> DataFrame:
    """Scores from follower counts: score = log(count). ``end_token`` follows every last piece."""
    pieces = pretokenize(text)
    if end_token is not None:
        pieces = F.when(F.size(pieces) > 0, F.concat(pieces, F.array(F.lit(end_token)))).otherwise(pieces)
    texts = df.select(pieces.alias("_pieces"))
    firsts = F.slice("_pieces", F.lit(1), F.greatest(F.size("_pieces") - 1, F.lit(0)))
    sides = texts.select(firsts.alias("ctx"), F.slice("_pieces", 2, F.size("_pieces")).alias("token"))
    # arrays_zip is compiled, zip_with calls its lambda for every pair.
    pairs = sides.select(F.explode(F.arrays_zip("ctx", "token")).alias("_pair"))
    counts = pairs.groupBy("_pair.ctx", "_pair.token").agg(F.count("*").alias("weight"))
    return counts.withColumn("score", F.log(F.col("weight").cast("double")))


def log_sum_exp_by(df: DataFrame, keys: Sequence[str], score: Column, out: str = "lse") -> DataFrame:
    """log(sum(exp(score))) per key in one pass with partial aggregation.

    Scores are summed relative to their band and the few band sums of a key are joined after,
    so a hot key neither overflows nor lands in one task.
    """
    banded = df.select(*keys, score.alias("_score")).withColumn("_band", F.floor(F.col("_score") / BAND))
    sums = banded.groupBy(*keys, "_band").agg(F.sum(F.exp(F.col("_score") - F.col("_band") * BAND)).alias("_sum"))
    per_key = sums.groupBy(*keys).agg(F.max("_band").alias("_top"), F.collect_list(F.struct("_band", "_sum")).alias("_sums"))
    scaled = F.transform("_sums", lambda s: s["_sum"] * F.exp((s["_band"] - F.col("_top")) * float(BAND)))
    return per_key.select(*keys, (F.col("_top") * BAND + F.log(total(scaled))).alias(out))


def softmax_by(df: DataFrame, keys: Sequence[str], score: Column, out: str = "prob") -> DataFrame:
    """Softmax of a score over all rows of a key."""
    # A hot key is hot in ``df`` only, and the sums are one plan with it: adaptive execution splits it or sends a small table of sums.
    whole = log_sum_exp_by(df, keys, score, "_lse")
    return df.join(whole, list(keys)).withColumn(out, F.exp(score - F.col("_lse"))).drop("_lse")


def temperature(df: DataFrame, value: float = 1.0) -> DataFrame:
    """Add ``prob`` = softmax(score / temperature) per context."""
    return softmax_by(df, ["ctx"], F.col("score") / F.lit(float(value)))


def _best_first() -> Window:
    return Window.partitionBy("ctx").orderBy(F.col("score").desc(), "token")


def top_k(df: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best candidates per context; ties go to the smaller token. Adds ``place``.

    Spark cuts each context to ``k`` rows before the shuffle (window group limit).
    """
    return df.withColumn("place", F.row_number().over(_best_first())).where(F.col("place") <= k)


def top_p(kept: DataFrame, p: float = 0.85, weight: str = "weight") -> DataFrame:
    """Smallest best-first prefix holding at least ``p`` of the weight; the crossing one is kept.

    Meant for the output of ``top_k``, so a context has at most k rows.
    """
    before = F.coalesce(F.sum(weight).over(_best_first().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum(weight).over(Window.partitionBy("ctx"))
    placed = kept.withColumn("_before", before).withColumn("_whole", whole)
    return placed.where(F.col("_before") < F.lit(float(p)) * F.col("_whole")).drop("_before", "_whole")


def penalized(score: Column, seen: Column, penalty: float) -> Column:
    lowered = F.when(score > 0, score / F.lit(float(penalty))).otherwise(score * F.lit(float(penalty)))
    return F.when(seen, lowered).otherwise(score)


def repetition_penalty(df: DataFrame, history: DataFrame, penalty: float = 1.2) -> DataFrame:
    """Lower the score of candidates found in ``history`` (ctx, token)."""
    seen = history.select("ctx", "token").distinct().withColumn("_seen", F.lit(True))
    marked = df.join(seen, ["ctx", "token"], "left")
    return marked.withColumn("score", penalized(F.col("score"), F.col("_seen").isNotNull(), penalty)).drop("_seen")


def greedy(df: DataFrame) -> DataFrame:
    """Best candidate per context."""
    best = F.min(F.struct((-F.col("score")).alias("_neg"), "token"))
    return df.groupBy("ctx").agg(best.alias("_best")).select("ctx", F.col("_best.token").alias("token"), (-F.col("_best._neg")).alias("score"))


def sample_candidates(kept: DataFrame, draws: int = 1, seed: int = 42, weight: str = "weight") -> DataFrame:
    """``draws`` seeded picks per context in proportion to the weight: rows (ctx, draw, token).

    Meant for the output of ``top_k`` or ``top_p``.
    """
    upto = F.sum(weight).over(_best_first().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum(weight).over(Window.partitionBy("ctx"))
    placed = kept.select("ctx", "token", F.col(weight).alias("_w"), upto.alias("_upto"), whole.alias("_whole"))
    drawn = placed.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    target = uniform(seed, "ctx", "draw") * F.col("_whole")
    return drawn.where((F.col("_upto") > target) & (F.col("_upto") - F.col("_w") <= target)).select("ctx", "draw", "token")


def candidate_lists(df: DataFrame, k: int) -> DataFrame:
    """(ctx, options): the ``k`` best candidates of a context as one list, best first; a ``place`` that is there is used."""
    listed = F.sort_array(F.collect_list(F.struct("place", "score", "token")))
    best = df.where(F.col("place") <= k) if "place" in df.columns else top_k(df, k)
    return best.groupBy("ctx").agg(listed.alias("options"))


def prepare_options(scores: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Staged option lists of ``size`` and that size, to share between several calls of ``generate``."""
    return stage(candidate_lists(scores, size).withColumnRenamed("ctx", "_on"), "options"), size


def _pick(options: Column, history: Column, allow_end: Column, end_token: str, k: int, penalty: float,
          do_sample: bool, heat: float, p: float, u: Column) -> Column:
    """Next token of one row from its option list.

    A penalty only moves options back, so with as many unseen ones at the head of the list as the pick keeps, nothing
    behind the head can come before them, and the rest of a long list is not scored.
    """
    needed = k if do_sample else 1
    head = F.slice(options, 1, needed + LEAD)

    def pick(seen: Column) -> Column:
        fresh = F.filter(head, lambda o: ((o["token"] != end_token) | allow_end) & ~F.array_contains(seen, o["token"]))
        # NULL and NaN are no scores to compare by; NaN stands first, NULL last.
        plain = ~F.isnan(F.get(options, F.lit(0))["score"]) & F.try_element_at(options, F.lit(-1))["score"].isNotNull()
        enough = (F.size(options) > needed + LEAD) & plain & (F.size(fresh) >= needed)
        return F.when(enough, of(head, seen)).otherwise(of(options, seen))

    def of(some: Column, seen: Column) -> Column:
        return _pick_of(some, seen, allow_end, end_token, k, penalty, do_sample, heat, p, u)

    # The history is put together once a row, not once an option.
    return let(history, pick)


def _pick_of(options: Column, history: Column, allow_end: Column, end_token: str, k: int, penalty: float,
             do_sample: bool, heat: float, p: float, u: Column) -> Column:
    """Next token from these options alone."""
    allowed = F.filter(options, lambda o: (o["token"] != end_token) | allow_end)
    scored = F.transform(
        allowed,
        lambda o: F.struct(
            (-penalized(o["score"], F.array_contains(history, o["token"]), penalty)).alias("neg"), o["token"].alias("token")
        ),
    )
    if not do_sample:
        return F.array_min(scored)["token"]
    ranked = F.slice(F.sort_array(scored), 1, k)

    def weigh(rows: Column) -> Column:
        best = F.get(rows, 0)["neg"]
        return let(best, lambda b: F.transform(rows, lambda r: F.struct(
            F.exp((b - r["neg"]) / F.lit(float(heat))).alias("w"), r["token"].alias("token"))))

    def keep(rows: Column) -> Column:
        """Running sums, cut after the row that reaches the share ``p``."""
        def prefix(whole: Column) -> Column:
            start = F.slice(F.transform(rows, lambda r: F.struct(F.lit(0.0).alias("upto"), r["token"].alias("token"))), 1, 0)
            def step(acc: Column, r: Column) -> Column:
                run = F.coalesce(F.try_element_at(acc, F.lit(-1))["upto"], F.lit(0.0))
                more = F.concat(acc, F.array(F.struct((run + r["w"]).alias("upto"), r["token"].alias("token"))))
                return F.when(run < F.lit(float(p)) * whole, more).otherwise(acc)
            return F.aggregate(rows, start, step)
        return let(total(F.transform(rows, lambda r: r["w"])), prefix)

    def choose(rows: Column) -> Column:
        target = u * F.try_element_at(rows, F.lit(-1))["upto"]
        return let(target, lambda t: F.get(F.filter(rows, lambda r: r["upto"] > t), F.lit(0))["token"])

    return let(let(let(ranked, weigh), keep), choose)


def generate(
    prompts: DataFrame, scores: DataFrame, keys: Sequence[str], text: str, end_token: str, max_new_tokens: int = 8,
    min_length: int = 0, do_sample: bool = False, heat: float = 1.0, k: int = 50, p: float = 1.0,
    penalty: float = 1.0, seed: int = 42, stage_every: int = 8, prepared: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """Continue all prompts at once: rows (keys..., tokens), up to the end marker.

    Every step joins the last token with its option list. Options are cut to a size that
    cannot change the result: the penalty can push out at most the tokens already seen, so
    k + (pieces seen) + max_new_tokens + 1 options always hold the k best that remain. Prompts are dealt to
    classes of similar history (``HISTORIES``), each with lists of its own length. ``prepared`` lists
    are used where they are that long, otherwise longer ones are built from ``scores``.
    """
    if penalty < 1.0:
        raise ValueError("a penalty below 1 would raise options outside the list")
    pieces = pretokenize(text)
    start = prompts.select(*keys, F.array_distinct(pieces).alias("_seen"), F.try_element_at(pieces, F.lit(-1)).alias("ctx"), F.size(pieces).alias("_len"))
    start = start.withColumn("tokens", F.array().cast("array<string>"))
    options_for = {
        "end_token": end_token, "min_length": min_length, "do_sample": do_sample, "heat": heat, "k": k, "p": p, "penalty": penalty, "seed": seed,
    }
    if penalty == 1.0:
        return _continue(start, _options(scores, k + 1, prepared), keys, max_new_tokens, stage_every, prompts.count(), **options_for)
    start = stage(start, "prompts")
    size = F.coalesce(F.size("_seen"), F.lit(0))
    group = F.lit(len(HISTORIES))
    for i, bound in reversed(list(enumerate(HISTORIES))):
        group = F.when(size <= bound, i).otherwise(group)
    classes = {row["class"]: row for row in start.groupBy(group.alias("class")).agg(F.max(size).alias("longest"), F.count("*").alias("rows")).collect()}
    wanted = {number: k + row.longest + max_new_tokens + 1 for number, row in classes.items()}
    if sum(not prepared or prepared[1] < size for size in wanted.values()) > 1:
        # The places of the longest lists serve all of them.
        scores = stage(top_k(scores, max(wanted.values())), "places")
    done = None
    for number in sorted(classes):
        part = start.where(group == number)
        own = _continue(part, _options(scores, wanted[number], prepared), keys, max_new_tokens, stage_every, classes[number].rows, **options_for)
        done = own if done is None else done.unionByName(own)
    return start.select(*keys, "tokens") if done is None else done


def _options(scores: DataFrame, wanted: int, prepared: tuple[DataFrame, int] | None) -> DataFrame:
    return prepared[0] if prepared and prepared[1] >= wanted else prepare_options(scores, wanted)[0]


def _with_options(state: DataFrame, options: DataFrame, keys: Sequence[str], small: bool, salts: int) -> DataFrame:
    """The rows with the option list of ``_on``. A frequent last piece is hot: small lists are broadcast, large ones copied to salts."""
    if small:
        return state.join(F.broadcast(options), "_on", "left")
    if salts < 2:
        return state.join(options, "_on", "left")
    salted = state.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int"))
    copies = options.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, ["_on", "_salt"], "left").drop("_salt")


def _continue(
    state: DataFrame, options: DataFrame, keys: Sequence[str], max_new_tokens: int, stage_every: int, rows: int, end_token: str, min_length: int,
    do_sample: bool, heat: float, k: int, p: float, penalty: float, seed: int,
) -> DataFrame:
    small = (options.agg(F.sum(F.size("options"))).first()[0] or 0) <= BROADCAST_OPTIONS
    salts = min(MAX_SALTS, rows // SALT_ROWS)
    for step in range(max_new_tokens):
        u = uniform(seed, *keys, F.lit(step))
        history = F.concat(F.col("_seen"), F.col("tokens"))
        chosen = _pick(F.col("options"), history, F.col("_len") + step >= min_length, end_token, k, penalty, do_sample, heat, p, u)
        # A finished row has no context: it joins on a text no piece can equal (pieces never
        # mix a control character and digits), which also spreads the finished rows.
        nowhere = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*keys), F.lit(4096)).cast("string"))
        state = _with_options(state.withColumn("_on", F.coalesce("ctx", nowhere)), options, keys, small, salts).withColumn("_next", chosen)
        state = state.withColumn("ctx", F.when(F.col("_next") != end_token, F.col("_next")))
        state = state.withColumn("tokens", F.when(F.col("ctx").isNotNull(), F.concat("tokens", F.array("ctx"))).otherwise(F.col("tokens")))
        state = state.drop("options", "_next", "_on")
        if (step + 1) % stage_every == 0 and step + 1 < max_new_tokens:
            state = stage(state, "generate")
    return state.select(*keys, "tokens")
