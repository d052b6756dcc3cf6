"""Temperature mixing of sources, with DataFrame functions only.

The share of a source among all words is raised to an exponent between 0 (equal weights) and 1 (as
found). The exponent is bisected over the grouped sources to meet a target entropy or a limit of
repetition. A weight times the budget is the source's quota: whole passes over the source, and of one
more pass as many documents as fit, block after block in a permuted order. The place where a source
stops is found level by level (block, part of a block, document), so no window holds a whole source, and
each document is judged by its source's stop alone, without moving its text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climora.llm.storage import stored

WORD = "[^\\x20\\x09-\\x0D]+"
_POINTS = 16
_ROUNDS = 6
_BITS = 10  # of the hash, for blocks and again for parts of blocks


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet; one of ``entropy_share`` and ``max_repeat``.

    ``entropy_share``: entropy of the weights as a share of the largest possible; the exponent is the
    largest that reaches it. ``max_repeat``: how often a source may be passed over at most; the
    exponent is the smallest that holds it. ``budget_share``: words in all, as a share of those of the
    input; None takes as many as it takes to use every document once at least.
    """

    entropy_share: float | None = None
    max_repeat: float | None = None
    budget_share: float | None = 1.0


def _hash(*parts):
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("long")


def _placed(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    ).withColumn("spot", _hash(F.lit(str(seed)), F.col("id").cast("string")))


def _order(seed: int):
    """The place of a document's block in the permuted order of its source's blocks."""
    block = F.shiftright("spot", 32 - _BITS).cast("string")
    return _hash(F.lit(str(seed)), F.coalesce("source", F.lit("")), block)


def exponent(shares: DataFrame, target: Target) -> float:
    """Bisects the exponent: each round narrows its interval to one of sixteen parts in one pass over the sources.

    ``shares`` has one row per source with words: share (over 0, summing to 1).
    """
    sources = shares.count()
    if not sources:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(_ROUNDS):
        points = shares.select(
            "share", F.explode(F.sequence(F.lit(0), F.lit(_POINTS))).alias("step")
        ).withColumn("a", F.lit(low) + F.lit(high - low) * F.col("step") / F.lit(float(_POINTS)))
        sums = points.groupBy("step", "a").agg(
            F.sum(F.pow("share", "a")).alias("z"), F.sum(F.pow("share", "a") * F.log("share")).alias("l"),
            F.max(F.pow("share", F.col("a") - 1)).alias("most"), F.min(F.pow("share", F.col("a") - 1)).alias("least"),
        )
        if target.entropy_share is not None:
            met = F.log("z") - F.col("a") * F.col("l") / F.col("z") >= F.lit(target.entropy_share) * F.log(F.lit(float(sources)))
        elif target.budget_share is None:
            met = F.col("most") / F.col("least") > F.lit(float(target.max_repeat))
        else:
            met = F.lit(float(target.budget_share)) * F.col("most") / F.col("z") > F.lit(float(target.max_repeat))
        # "met" holds up to some exponent and not beyond
        reached = sums.where(met).agg(F.max("step")).first()[0]
        reached = -1 if reached is None else reached
        width = (high - low) / _POINTS
        if reached < 0:
            high = low
        elif reached == _POINTS:
            low = high
        else:
            low, high = low + width * reached, low + width * (reached + 1)
        if low == high:
            break
    return low if target.entropy_share is not None else high


def quotas(placed: DataFrame, target: Target) -> DataFrame:
    """One row per source: source, n_words, weight, passes (whole ones), rest (words of one more)."""
    totals = stored(placed.groupBy("source").agg(F.sum("n_words").alias("n_words")), "mix-sources")
    every = totals.agg(F.sum("n_words"), F.max("n_words")).first()
    words, largest = every[0] or 0, every[1] or 0
    shares = totals.where("n_words > 0").withColumn("share", F.col("n_words") / F.lit(float(words or 1)))
    a = exponent(shares, target)
    sums = shares.agg(F.sum(F.pow("share", F.lit(a)))).first()
    z = sums[0] or 1.0
    weight = F.pow(F.col("n_words") / F.lit(float(words or 1)), F.lit(a)) / F.lit(z)
    if target.budget_share is None:
        budget = largest / ((largest / words) ** a / z) if words else 0.0
    else:
        budget = float(words) * target.budget_share
    quota = F.floor(weight * F.lit(budget) + F.lit(1e-6))
    if target.budget_share is None:
        quota = F.greatest(quota, F.col("n_words"))
    passes = F.when(F.col("n_words") > 0, F.expr("quota div n_words")).otherwise(F.lit(1)).cast("long")
    return (
        totals.withColumn("weight", F.when(F.col("n_words") > 0, weight).otherwise(F.lit(0.0)))
        .withColumn("quota", F.when(F.col("n_words") > 0, quota).otherwise(F.lit(0)).cast("long"))
        .withColumn("passes", passes)
        .withColumn("rest", F.col("quota") - F.col("passes") * F.col("n_words"))
        .select("source", "n_words", "weight", "passes", F.greatest("rest", F.lit(0)).alias("rest"))
    )


def stops(placed: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """One row per source: source, passes and stop, the last (order, spot, id) that one more pass takes (null: none).

    Works on word counts of blocks, then of the parts of the block that holds the stop, then on the documents of that part.
    """
    width = 32 - 2 * _BITS
    cells = stored(
        placed.join(wanted.select("source", "rest"), placed["source"].eqNullSafe(wanted["source"]))
        .select(placed["source"], "id", "n_words", "spot", "rest").withColumn("turn", _order(seed))
        .withColumn("part", F.shiftright("spot", width)),
        "mix-documents",
    )

    def running(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        window = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return (
            frame.groupBy("source", "rest", *keys).agg(F.sum("n_words").alias("n"))
            .withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))
        )

    def level(frame: DataFrame, keys: list[str], order: list[str], held: str) -> DataFrame:
        """The one key of each source that its rest ends in, with the words before it."""
        return running(frame, keys, order).where("before <= rest AND before + n > rest").select(
            F.col("source").alias("source_"), F.struct(*order).alias(held), F.col("before").alias("before_")
        )

    blocks = stored(level(cells, ["turn"], ["turn"], "held"), "mix-blocks")
    in_block = cells.join(blocks, F.col("source").eqNullSafe(F.col("source_")) & (F.col("turn") == F.col("held.turn")))
    in_block = in_block.withColumn("rest", F.col("rest") - F.col("before_")).drop("source_", "held", "before_")
    parts = stored(level(in_block, ["turn", "part"], ["turn", "part"], "held"), "mix-parts")
    in_part = in_block.join(
        parts, F.col("source").eqNullSafe(F.col("source_")) & (F.col("turn") == F.col("held.turn")) & (F.col("part") == F.col("held.part"))
    ).withColumn("rest", F.col("rest") - F.col("before_")).drop("source_", "held", "before_")
    at = running(in_part, ["turn", "spot", "id"], ["turn", "spot", "id"]).where("before <= rest AND before + n > rest")
    stop = stored(at.select(F.col("source").alias("source_"), F.struct("turn", "spot", "id").alias("stop")), "mix-stops")
    return wanted.join(stop, F.col("source").eqNullSafe(F.col("source_")), "left").select("source", "passes", "rest", "stop")


def _copies(docs: DataFrame, id_col: str, source_col: str, text_col: str, target: Target, seed: int) -> tuple[DataFrame, object, list]:
    placed = stored(_placed(docs, id_col, source_col, text_col, seed), "mix-placed")
    wanted = stored(quotas(placed, target), "mix-quotas")
    table = stored(stops(placed, wanted, seed), "mix-judged").select(
        F.col("source").alias("_climora_source"), F.col("passes").alias("_climora_passes"),
        F.col("rest").alias("_climora_rest"), F.col("stop").alias("_climora_stop"),
    )
    # documents before the stop are taken once more; without a stop, all of a rest that is not empty
    more = F.when(F.col("_climora_stop").isNull(), F.lit(False)).otherwise(
        F.struct(_order(seed).alias("turn"), F.col("spot"), F.col("id")) < F.col("_climora_stop")
    )
    return placed, table, more


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    target: Target = Target(entropy_share=0.99, budget_share=0.75), seed: int = 0,
) -> DataFrame:
    """One row per document: ``id_col``, ``source_col``, n_words and copies, how often the mixture holds it.

    A null source is a source of its own; a null text has no words. Documents without words go with
    their neighbours in the order; those of a source without any words are taken once. Rows that
    repeat an id are taken together. A source that is the whole budget away stays out (copies 0). An
    empty table gives no rows.
    """
    placed, table, more = _copies(docs, id_col, source_col, text_col, target, seed)
    joined = placed.join(table, F.col("source").eqNullSafe(F.col("_climora_source")))
    return joined.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "n_words",
        (F.col("_climora_passes") + more.cast("long")).alias("copies"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    target: Target = Target(max_repeat=1.25, budget_share=None), seed: int = 0,
) -> DataFrame:
    """``docs`` with each row as often as the mixture holds it; columns as they were."""
    _, table, more = _copies(docs, id_col, source_col, text_col, target, seed)
    spot = _hash(F.lit(str(seed)), F.col(id_col).cast("long").cast("string"))
    names = docs.columns
    wrapped = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_climora_row"), F.col(source_col).cast("string").alias("source"),
        F.col(id_col).cast("long").alias("id"), spot.alias("spot"),
    )
    joined = wrapped.join(table, F.col("source").eqNullSafe(F.col("_climora_source")))
    times = (F.col("_climora_passes") + more.cast("long")).cast("int")
    return joined.select(F.explode(F.array_repeat("_climora_row", times)).alias("_climora_row")).select("_climora_row.*")


def _rounds_sql(share: float) -> str:
    steps, last = ["a0 AS (SELECT 0e0 AS low, 1e0 AS high)"], "a0"
    for k in range(1, _ROUNDS + 1):
        steps.append(
            f"a{k} AS (SELECT CASE WHEN reached IS NULL THEN low WHEN reached = {_POINTS} THEN high"
            f" ELSE low + (high - low) / {_POINTS} * reached END AS low,"
            f" CASE WHEN reached IS NULL THEN low WHEN reached = {_POINTS} THEN high"
            f" ELSE low + (high - low) / {_POINTS} * (reached + 1) END AS high"
            f" FROM {last}, (SELECT max(step) AS reached FROM (SELECT step, a,"
            " sum(pow(share, a)) AS z, sum(pow(share, a) * ln(share)) AS l, count(*) AS m FROM (SELECT share, step,"
            f" low + (high - low) * step / {float(_POINTS)} AS a FROM shares, {last}, range({_POINTS + 1}) r(step))"
            f" GROUP BY step, a) WHERE ln(z) - a * l / z >= {share!r}::DOUBLE * ln(m::DOUBLE)))"
        )
        last = f"a{k}"
    return ", ".join(steps)


def mix_sql(share: float = 0.99, budget: float = 0.75, seed: int = 0) -> str:
    """DuckDB SQL for ``mix`` with an entropy target, over the table ``documents``."""
    word = "'[^\\x20\\x09-\\x0D]+'"
    spot = f"CAST('0x' || substr(md5(concat_ws('/', '{seed}', CAST(doc_id AS VARCHAR))), 1, 8) AS BIGINT)"
    turn = f"CAST('0x' || substr(md5('{seed}/' || coalesce(source, '') || '/' || CAST(spot >> {32 - _BITS} AS VARCHAR)), 1, 8) AS BIGINT)"
    return f"""
    WITH placed AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {word})), 0) AS BIGINT) AS n_words,
                           {spot} AS spot FROM documents),
    turned AS (SELECT *, {turn} AS turn FROM placed),
    totals AS (SELECT source, CAST(sum(n_words) AS BIGINT) AS n FROM placed GROUP BY source),
    words AS (SELECT CAST(sum(n) AS DOUBLE) AS all_words FROM totals),
    shares AS (SELECT source, n / all_words AS share FROM totals, words WHERE n > 0),
    {_rounds_sql(share)},
    z AS (SELECT low AS a, sum(pow(share, low)) AS z FROM a{_ROUNDS}, shares GROUP BY low),
    quota AS (SELECT source, n, CASE WHEN n > 0 THEN CAST(floor(pow(n / all_words, a) / z * (all_words * {budget!r}::DOUBLE) + 1e-6) AS BIGINT) ELSE 0 END AS q
              FROM totals, words, z),
    goal AS (SELECT source, CASE WHEN n > 0 THEN q // n ELSE 1 END AS passes,
                    CASE WHEN n > 0 THEN q - (q // n) * n ELSE 0 END AS rest FROM quota),
    running AS (SELECT t.*, g.passes, g.rest, CAST(sum(n_words) OVER (PARTITION BY t.source ORDER BY turn, spot, doc_id) AS BIGINT) AS upto
                FROM turned t JOIN goal g ON t.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, source, n_words, passes + CASE WHEN upto <= rest AND rest > 0 THEN 1 ELSE 0 END AS copies FROM running
    """
