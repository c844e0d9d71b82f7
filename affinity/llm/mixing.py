"""Mixing sources to target weights by temperature.

Token shares p of the sources are raised to an exponent t and normalised: t = 1 keeps the shares, t = 0
makes all sources equal, t > 1 favours the large ones. The exponent is found by bisection: the flattest mix
whose entropy does not exceed the target and in which no source is repeated more often than allowed. Limits
that no exponent meets are an error, or the entropy comes as near as the repeats allow. Each weight becomes a token
budget. A source's budget is its number of whole passes and a part of one more; every pass is its own seeded
permutation of the documents in blocks, and the last pass ends where the budget is used up.

Nothing is sorted per source: the place at which a source's last pass ends is found by histograms over
successive digits of the permutation key, so a source of any size is spread over all tasks.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import staged

WORD = r"[^\x20\x09-\x0D]+"
DIGIT_BITS, DIGITS = 12, 5
GRID = 32
RESULT = ("__tokens", "__copy", "__block", "__position")


def _mix_sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float, float]]:
    """Per exponent: the sums of p^t and of p^t ln p, the largest and smallest p^(t-1), in one job."""
    lp = F.ln("p")
    aggregates = []
    for t in exponents:
        power = F.exp(lp * F.lit(t))
        again = F.exp(lp * F.lit(t - 1))
        aggregates += [F.sum(power), F.sum(power * lp), F.max(again), F.min(again)]
    row = shares.agg(*aggregates).first()
    return [tuple(row[4 * i : 4 * i + 4]) for i in range(len(exponents))]


def find_exponent(
    shares: DataFrame, target_entropy: float | None, max_repeats: float | None, budget_share: float | None, rounds: int = 5
) -> tuple[float, float, float]:
    """``(exponent, sum of p^t, budget as a share of all tokens)`` over ``shares(p)``.

    The smallest t in [0, 1] at which both limits hold, or 1 if they hold nowhere in it (``solve_exponent``
    looks beyond); entropy and repeats both fall as t grows, and at 1 the mix is the corpus itself. A round evaluates ``GRID`` points of the interval in one job (the bisection,
    five bits at a time). ``budget_share`` None: the smallest budget that passes every source at least once.
    """
    low, high = 0.0, 1.0

    def holds(t, sums):
        z, zl, top, least = sums
        entropy = math.log(z) - t * zl / z
        budget = budget_share if budget_share is not None else z / least
        fine = target_entropy is None or entropy <= target_entropy + 1e-12
        return fine and (max_repeats is None or budget * top / z <= max_repeats + 1e-12)

    at_low = _mix_sums(shares, [low])[0]
    if holds(low, at_low):
        found, sums = low, at_low
    else:
        for _ in range(rounds):
            points = [low + (high - low) * i / GRID for i in range(1, GRID + 1)]
            rows = _mix_sums(shares, points)
            first = next((i for i, (t, s) in enumerate(zip(points, rows)) if holds(t, s)), GRID - 1)
            low, high, sums = ([low] + points)[first], points[first], rows[first]
        found = high
    z, _, _, least = sums
    return found, z, budget_share if budget_share is not None else z / least


def solve_exponent(
    shares: DataFrame,
    target_entropy: float | None,
    max_repeats: float | None,
    budget_share: float | None,
    on_conflict: str = "error",
    rounds: int = 5,
) -> tuple[float, float, float]:
    """``(exponent, logarithm of the sum of p^t, budget as a share of all tokens)`` over ``shares(p)``: the
    smallest t >= 0 at which both limits hold.

    Above 1 entropy still falls as t grows, but repeats of the largest source grow. If no t meets both
    limits, ``on_conflict`` "error" raises a ValueError; "nearest" warns and takes the largest t
    that keeps the repeats. A budget that no mix can spend within ``max_repeats`` is always an error.
    """
    if budget_share is not None and max_repeats is not None and budget_share > max_repeats * (1 + 1e-12):
        raise ValueError(f"a budget of {budget_share:.6g} times the corpus cannot be spent in {max_repeats:.6g} passes of each source")
    lp = F.ln("p")
    least, top, own = shares.agg(F.min("p"), F.max("p"), -F.sum(F.col("p") * lp)).first()
    if target_entropy is None or own <= target_entropy + 1e-12:
        t, z, share = find_exponent(shares, target_entropy, max_repeats, budget_share, rounds)
        return t, math.log(z), share
    log_least, log_top = math.log(least), math.log(top)
    log_limit = math.inf if max_repeats is None else math.log(max_repeats) + 1e-12

    def evaluate(points):
        """Per exponent: itself, entropy, ln of the sum of p^t, of the budget and of the most repeats (in logarithms,
        and p over the largest, since p^t underflows)."""
        aggregates = []
        for t in points:
            power = F.exp((lp - F.lit(log_top)) * F.lit(t))
            aggregates += [F.sum(power), F.sum(power * (lp - F.lit(log_top)))]
        row = shares.agg(*aggregates).first()
        found = []
        for i, t in enumerate(points):
            z, zl = row[2 * i : 2 * i + 2]
            log_z = t * log_top + math.log(z)
            if budget_share is None:
                log_budget = log_z - (t - 1) * log_least
            else:
                log_budget = math.log(budget_share) if budget_share else -math.inf
            found.append((t, math.log(z) - t * zl / z, log_z, log_budget, log_budget + (t - 1) * log_top - log_z))
        return found

    def bracket(holds, low, high):
        """Neighbouring points, the second of which is the first where ``holds``, which holds at ``high``."""
        for _ in range(rounds):
            rows = [low, *evaluate([low[0] + (high[0] - low[0]) * i / GRID for i in range(1, GRID)]), high]
            i = next(i for i in range(1, GRID + 1) if i == GRID or holds(rows[i]))
            low, high = rows[i - 1], rows[i]
        return low, high

    reached = lambda row: row[1] <= target_entropy + 1e-12
    over = lambda row: row[4] > log_limit
    ladder = evaluate([2.0**i for i in range(33)])
    step = next((i for i, row in enumerate(ladder) if reached(row)), None)
    best = bracket(reached, ladder[step - 1], ladder[step])[1] if step is not None else None
    if best is None or over(best):
        if best is None:
            said = f"no exponent brings the entropy of the sources' shares down to {target_entropy:.6g}"
        else:
            said = f"at an entropy of {target_entropy:.6g} a source is repeated {math.exp(min(best[4], 700)):.6g} times, above the limit of {max_repeats:.6g}"
        if on_conflict == "error" or max_repeats is None:
            raise ValueError(f"{said}; shares of the corpus itself have {own:.6g}")
        end = next((i for i, row in enumerate(ladder) if over(row)), None)
        if least == top:
            best = ladder[0]
        else:
            best = ladder[-1] if end is None else bracket(over, ladder[end - 1], ladder[end])[0]
        warnings.warn(f"{said}; mixed to {best[1]:.6g} with the exponent {best[0]:.6g}", stacklevel=2)
    if best[4] > math.log(1 << 31):
        raise ValueError(f"at an entropy of {target_entropy:.6g} a source is repeated more than 2^31 times")
    return best[0], best[2], math.exp(best[3])


def _key(copy: Column, seed: int) -> Column:
    """60-bit place of a row in the permutation of one pass."""
    return F.shiftrightunsigned(F.xxhash64("__row", copy.cast("int"), F.lit(seed)), 64 - DIGIT_BITS * DIGITS)


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    target_entropy: float | None = 0.98,
    max_repeats: float | None = 4.0,
    budget_tokens: float | None = None,
    cover_all: bool = False,
    seed: int = 1,
    on_conflict: str = "error",
) -> DataFrame:
    """All columns of ``docs`` and ``__tokens, __copy, __block, __position``: a row per document and pass.

    ``target_entropy`` is a share of the entropy of equal weights, met from either side: a corpus whose own
    shares are flatter is sharpened. If it cannot be met within ``max_repeats``, ``on_conflict`` "error" raises
    a ValueError and "nearest" warns and comes as near as the repeats allow. The budget is ``budget_tokens``, or the
    corpus's own tokens, or, with ``cover_all``, the smallest at which every source is passed at least
    once. Tokens are runs of non-white space. ``__block`` (the first digit of the pass's key) and
    ``__position`` give the order of a pass. A pass that ends takes whole documents only and never more
    than the budget.

    A null source is a source of its own. Null and empty texts have no tokens; they go with each whole pass and
    with the part of a last pass before its end. Sources without tokens are passed once. Rows equal in id, source
    and text share a place and are taken or left together. An empty table gives an empty result. Columns of
    ``docs`` called like one of the four result columns are replaced by it; any other name passes through.
    """
    if target_entropy is not None and not 0 < target_entropy <= 1:
        raise ValueError("target_entropy must be above 0 and at most 1")
    if max_repeats is not None and max_repeats < 1:
        raise ValueError("max_repeats must be 1 or more")
    if budget_tokens is not None and budget_tokens < 0:
        raise ValueError("budget_tokens must not be negative")
    if on_conflict not in ("error", "nearest"):
        raise ValueError("on_conflict must be error or nearest")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    passed = [c for c in docs.columns if c not in RESULT]
    marked = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(passed)],
        F.col(source_col).cast("string").alias("__source"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(source_col).cast("string"), text).alias("__row"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("__tokens"),
    )
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(passed)]
    rows = staged(marked.select("__source", "__row", "__tokens"), "tokens")
    sources = staged(rows.groupBy("__source").agg(F.sum("__tokens").alias("t")), "sources")
    total, n = sources.where("t > 0").agg(F.sum("t"), F.count("*")).first()
    total = float(total or 0)
    if not total:
        zero = F.lit(0).cast("bigint")
        return marked.select(*own, *[(F.lit(1) if c == "__copy" else zero).alias(c) for c in RESULT])
    share = None if cover_all else (total if budget_tokens is None else float(budget_tokens)) / total
    p = sources.where("t > 0").select((F.col("t") / F.lit(total)).alias("p"))
    limit = target_entropy * math.log(n) if target_entropy is not None else None
    exponent, log_z, share = solve_exponent(p, limit, max_repeats, share, on_conflict)
    weight = F.exp(F.ln(F.col("t") / F.lit(total)) * F.lit(exponent) - F.lit(log_z))
    quota = F.round(weight * F.lit(share * total)).cast("bigint")
    quota = F.when(F.col("t") > 0, F.greatest(quota, "t") if cover_all else quota).otherwise(F.lit(0))
    plan = sources.withColumn("quota", quota).select(
        "__source",
        F.when(F.col("t") > 0, F.floor(F.col("quota") / F.col("t"))).otherwise(F.lit(1)).cast("int").alias("whole"),
        F.when(F.col("t") > 0, F.col("quota") % F.col("t")).otherwise(F.lit(0)).cast("bigint").alias("left"),
    )
    plan = _ends(rows, staged(plan, "plan"), seed)

    end = plan.select(
        F.col("__source").alias("__planned"), F.col("whole").alias("__whole"), F.col("end").alias("__end")
    )
    placed = marked.join(end, marked["__source"].eqNullSafe(end["__planned"]))
    last = F.when(_key(F.col("__whole") + 1, seed) < F.col("__end"), 1).otherwise(0)
    n = F.col("__whole") + last
    passes = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    placed = placed.withColumn("__copy", F.explode(passes)).withColumn("__position", _key(F.col("__copy"), seed))
    block = F.shiftright("__position", DIGIT_BITS * (DIGITS - 1)).alias("__block")
    return placed.select(*own, "__tokens", "__copy", block, "__position")


def _ends(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``(__source, whole, end)``: rows whose key in pass whole + 1 is below ``end`` fit into what is left.

    Digit by digit: token sums of the blocks (values of the digit) within the current boundary block, the
    first block that does not fit whole becomes the boundary.
    """
    state = plan.select("__source", "whole", "left", F.lit(0).cast("bigint").alias("end"))
    done = state.where(F.col("left") <= 0).drop("left")  # nothing is left for a last pass
    state = state.where(F.col("left") > 0)
    for digit in reversed(range(DIGITS)):
        shift = DIGIT_BITS * digit
        s = state.withColumnRenamed("__source", "__planned")
        held = rows.join(s, rows["__source"].eqNullSafe(s["__planned"])).withColumn("key", _key(F.col("whole") + 1, seed))
        upper = shift + DIGIT_BITS
        # all keys share the digits above the first; keys of 60 bits shifted by 60 are 0
        held = held.where(F.shiftright("key", upper) == F.shiftright("end", upper)) if digit < DIGITS - 1 else held
        block = F.shiftright("key", shift).alias("block")
        sums = held.groupBy("__source", "whole", "left", "end", block).agg(F.sum("__tokens").alias("n"), F.count("*").alias("rows"))
        over = F.sum("n").over(_running())
        boundary = (
            sums.withColumn("over", over)
            .where(F.col("over") > F.col("left"))
            .groupBy("__source", "whole", "left")
            .agg(F.min(F.struct("block", (F.col("over") - F.col("n")).alias("before"), "rows")).alias("b"))
        )
        found = boundary.select(
            "__source", "whole", F.col("left").alias("was"), "b.block", "b.before", F.col("b.rows").alias("rows")
        )
        found = staged(found, "boundary")
        f = found.select(F.col("__source").alias("fs"), "block", "before", "rows")
        state = state.join(f, state["__source"].eqNullSafe(f["fs"]), "left")
        # no boundary: everything left in this range fits, the end lies behind it
        behind = F.shiftleft(F.shiftright("end", upper) + 1, upper) if digit < DIGITS - 1 else F.lit(1 << (DIGIT_BITS * DIGITS))
        state = state.select(
            "__source",
            "whole",
            F.when(F.col("block").isNull(), 0).otherwise(F.col("left") - F.col("before")).alias("left"),
            F.when(F.col("block").isNull(), behind).otherwise(F.shiftleft("block", shift)).cast("bigint").alias("end"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
        state = staged(state, "ends")
        settled = state.where("rows <= 1").drop("rows", "left")
        done = done.union(settled)
        state = state.where("rows > 1").drop("rows")
        if state.isEmpty():
            break
    rest = state.select("__source", "whole", "end")
    return staged(done.union(rest), "plan_ends")


def _running():
    from pyspark.sql import Window

    return Window.partitionBy("__source").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
