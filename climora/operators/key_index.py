"""What is kept beside each month of stored admissions: which record numbers, and from which landed folders.

Two indexes on the numbers, both without false negatives:

- zones: smallest and largest number of each leading part. Numbers are given out by state and year, so the numbers of an
  update lie in the zones of few months.
- filters: a Bloom filter per month, as rows of 64 bits. It tells months apart for updates of few numbers.

Null numbers count as empty text here, which can only name a month too many. All three are rows of one small table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY, FOLDER = "aih_number", "admission_month"
# Rows of the three kinds: (zone, low, high, records), (words, word, bits), (competence, state, records).
INDEX = f"kind string, text string, low string, high string, number bigint, spot bigint, bits bigint, {FOLDER} date"
ZONE_CHARACTERS = 7
BITS_PER_KEY, PROBES = 16, 8
# Updates with more numbers than this are told apart by zones only: a filter would err for some number of nearly every month.
PROBED_KEYS = 20_000


def _key() -> Column:
    return F.coalesce(F.col(KEY), F.lit(""))


def _zone(key: Column) -> Column:
    return F.substring(key, 1, ZONE_CHARACTERS)


def _rows(groups: DataFrame, kind: str, **columns: str) -> DataFrame:
    """Grouped rows in the columns of the index."""
    names = {"text": "string", "low": "string", "high": "string", "number": "bigint", "spot": "bigint", "bits": "bigint"}
    return groups.select(
        F.lit(kind).alias("kind"), *[F.col(columns[n]).cast(t).alias(n) if n in columns else F.lit(None).cast(t).alias(n) for n, t in names.items()], FOLDER
    )


def index(rows: DataFrame) -> DataFrame:
    """The index of some months of stored admissions."""
    return _zones(rows).unionByName(_filters(rows)).unionByName(_origins(rows))


def _zones(rows: DataFrame) -> DataFrame:
    """Smallest and largest number by leading characters and month."""
    found = rows.groupBy(FOLDER, _zone(_key()).alias("zone")).agg(
        F.min(_key()).alias("first"), F.max(_key()).alias("last"), F.count(F.lit(1)).alias("records")
    )
    return _rows(found, "zone", text="zone", low="first", high="last", number="records")


def _probes(key: Column, words: Column) -> Column:
    """Word and bit of each probe of a number, in a filter of so many words."""
    spot = [F.pmod(F.xxhash64(F.lit(i), key), words * 64) for i in range(PROBES)]
    return F.array(*[F.struct(F.floor(s / 64).alias("word"), (s % 64).cast("int").alias("bit")) for s in spot])


def _mask() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p.bit"))


def _filters(rows: DataFrame) -> DataFrame:
    """Bloom filter by month; the number of words is the power of two that gives each number ``BITS_PER_KEY`` bits."""
    sizes = rows.groupBy(FOLDER).agg(
        F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.count(F.lit(1)) * BITS_PER_KEY / 64, F.lit(1.0))))).cast("long").alias("words")
    )
    same = F.col(f"r.{FOLDER}").eqNullSafe(F.col(f"s.{FOLDER}"))
    sized = rows.select(FOLDER, _key().alias(KEY)).alias("r").join(sizes.alias("s"), same).select(f"r.{FOLDER}", KEY, "words")
    spots = sized.select(FOLDER, "words", F.explode(_probes(F.col(KEY), F.col("words"))).alias("p"))
    words = spots.groupBy(FOLDER, "words", F.col("p.word").alias("word")).agg(F.bit_or(_mask()).alias("set"))
    return _rows(words, "filter", number="words", spot="word", bits="set")


def _origins(rows: DataFrame) -> DataFrame:
    """Landed folders that the records of a month come from."""
    found = rows.groupBy("competence", "state", FOLDER).agg(F.count(F.lit(1)).alias("records"))
    return _rows(found, "origin", text="competence", low="state", number="records")


def months_of_keys(keys: DataFrame, index: DataFrame) -> list:
    """Months (None for undated records) that may hold one of the numbers ``keys`` (column of that name): none is missed."""
    zones = index.where("kind = 'zone'").select(F.col("text").alias("zone"), "low", "high", FOLDER)
    filters = index.where("kind = 'filter'").select(F.col("number").alias("words"), F.col("spot").alias("word"), "bits", FOLDER)
    own = keys.select(_key().alias("key")).distinct()
    met = own.join(zones, (_zone(F.col("key")) == F.col("zone")) & F.col("key").between(F.col("low"), F.col("high")))
    if own.limit(PROBED_KEYS + 1).count() > PROBED_KEYS:
        return [r[0] for r in met.select(FOLDER).distinct().collect()]
    sizes = filters.select(FOLDER, "words").distinct().alias("s")
    sized = met.alias("m").join(sizes, F.col(f"m.{FOLDER}").eqNullSafe(F.col(f"s.{FOLDER}")))
    probes = sized.select(
        F.col(f"m.{FOLDER}").alias("month"), "key", F.posexplode(_probes(F.col("key"), F.col("words"))).alias("i", "p")
    )
    hits = probes.join(
        filters, F.col("month").eqNullSafe(F.col(FOLDER)) & (F.col("p.word") == F.col("word")) & (F.col("bits").bitwiseAND(_mask()) != 0)
    )
    whole = hits.groupBy("month", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == PROBES)
    # Calendar months: a few hundred values at most.
    return [r[0] for r in whole.select("month").distinct().collect()]


def months_of_origins(pairs: Iterable[tuple[str, str]], index: DataFrame) -> list:
    """Months that hold records from one of the (state, competence) ``pairs``."""
    wanted = index.sparkSession.createDataFrame(sorted(set(pairs)), "state string, competence string")
    origins = index.where("kind = 'origin'").select(F.col("text").alias("competence"), F.col("low").alias("state"), FOLDER)
    return [r[0] for r in origins.join(wanted, ["state", "competence"], "left_semi").select(FOLDER).distinct().collect()]
