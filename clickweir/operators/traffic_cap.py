"""Traffic cap: drop every row of a user-minute or a session whose row
count exceeds its cap.

Both counts are taken over the same input rows and the two caps are
applied together; a group over its cap is dropped whole. Null keys form
one group (all rows with a null session share one count).

One job aggregates both key sets at once (grouping sets, map-side partial
counts: only keys and counts are shuffled) and writes the keys over their
caps to the shared folder. The rows are then kept by a left-anti join on
null-safe keys. The size of both key sets is measured on the written keys, so
it is known before the joins are planned: while both together fit
``broadcast_bytes`` they are broadcast and the rows are never shuffled.
Beyond it a Bloom filter of the keys, of bounded size, is broadcast: rows that it excludes
are kept as they are, and only possible matches are shuffled to a sort-merge join, whose
skewed partitions AQE splits. That reads the rows twice. With no violators the join is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.fs import delete_at_exit
from clickweir.functions import minute_bucket
from clickweir.session import work_path


@dataclass(frozen=True)
class Caps:
    per_user_minute: int = 30
    per_session: int = 500


# The reference's caps, 30 events per user-minute and 500
# events per session.
DEFAULT_CAPS = Caps(per_user_minute=30, per_session=500)

# Both violator key sets together are broadcast up to this many bytes (one
# budget, since both tables are live at once); above it, shuffle joins.
BROADCAST_BYTES = 64 * 1024 * 1024
# Bytes of a hashed relation entry besides strings. Null-safe keys are joined
# as (value, null flag) pairs, kept in the hashed row and again in its key: per
# entry two row headers with null bits, eight bytes for each of the four (two for sessions)
# join fields in both rows, and the hash map's slot at a load factor of one half.
ROW_HEADER = 16
FIELD = 8
MAP_SLOT = 32
MINUTE_ENTRY = 2 * (ROW_HEADER + 4 * FIELD) + MAP_SLOT
SESSION_ENTRY = 2 * (ROW_HEADER + 2 * FIELD) + MAP_SLOT

# Words of 64 bits of the Bloom filter, each an entry of the broadcast at most
# (as ``SESSION_ENTRY``: 24 MiB in all); a key sets three bits of one word.
BLOOM_WORDS = 1 << 18

MINUTE_KEYS = ("user_id", "event_minute")
SESSION_KEYS = ("user_session",)

VIOLATOR_SCHEMA = T.StructType(
    [
        T.StructField("by_minute", T.IntegerType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_minute", T.TimestampNTZType()),
        T.StructField("user_session", T.StringType()),
    ]
)


def with_minute(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    return df.withColumn("event_minute", minute_bucket(time_col))


def key_counts(df: DataFrame) -> DataFrame:
    """Rows per key, both kinds from one aggregate (lazy). Counts of disjoint
    rows add up (``merged_counts``).

    Columns: ``by_minute`` (1 = user-minute key, 0 = session key),
    ``user_id``, ``event_minute``, ``user_session``, ``n``.
    """
    keyed = with_minute(df).select(*MINUTE_KEYS, *SESSION_KEYS)
    return keyed.groupingSets([list(MINUTE_KEYS), list(SESSION_KEYS)], *MINUTE_KEYS, *SESSION_KEYS).agg(
        F.grouping("user_session").cast("int").alias("by_minute"),
        F.count(F.lit(1)).alias("n"),
    ).select("by_minute", *MINUTE_KEYS, *SESSION_KEYS, "n")


def merged_counts(parts: list[DataFrame]) -> DataFrame:
    """Sum of several tables of counts."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("by_minute", *MINUTE_KEYS, *SESSION_KEYS).agg(F.sum("n").alias("n"))


def _over(caps: Caps):
    return ((F.col("by_minute") == 1) & (F.col("n") > caps.per_user_minute)) | ((F.col("by_minute") == 0) & (F.col("n") > caps.per_session))


def violator_keys(df: DataFrame, caps: Caps = DEFAULT_CAPS) -> DataFrame:
    """Keys over their cap, both kinds (lazy): the columns of ``key_counts`` but ``n``."""
    return key_counts(df).filter(_over(caps)).drop("n")


def violators_with_history(counts: DataFrame, before: list[DataFrame], caps: Caps = DEFAULT_CAPS) -> DataFrame:
    """Keys of ``counts``, of a batch, that are over their cap together with
    the counts ``before``. Minutes before the batch's first one cannot be among its keys
    and are not read."""
    keys = ("by_minute", *MINUTE_KEYS, *SESSION_KEYS)
    first = counts.agg(F.min("event_minute")).first()[0]
    old = [p if first is None else p.filter((F.col("by_minute") == 0) | (F.col("event_minute") >= F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz"))) for p in before]
    both = counts.withColumn("own", F.lit(1))
    for p in old:
        both = both.unionByName(p.withColumn("own", F.lit(0)))
    return both.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("own").alias("own")).filter((F.col("own") == 1) & _over(caps)).select(*keys)


@dataclass(frozen=True)
class Violators:
    path: str
    minute_keys: int
    session_keys: int
    session_text_bytes: int = 0

    @property
    def hashed_bytes(self) -> int:
        """Size of both key sets as hashed relations (session text is held
        in the row and in its key)."""
        return self.minute_keys * MINUTE_ENTRY + self.session_keys * SESSION_ENTRY + 2 * self.session_text_bytes


def find_violators(df: DataFrame, caps: Caps = DEFAULT_CAPS, path: str | None = None) -> Violators:
    """Run the violator aggregate once and write it under the shared folder;
    the sizes are counted on what was written."""
    spark = df.sparkSession
    path = path or work_path(spark, "violators")
    return written_violators(violator_keys(df, caps), path)


def written_violators(keys: DataFrame, path: str) -> Violators:
    """Write the keys and count their sizes on what was written."""
    spark = keys.sparkSession
    keys.write.mode("overwrite").parquet(path)
    session = F.col("by_minute") == 0
    got = (
        spark.read.schema(VIOLATOR_SCHEMA)
        .parquet(path)
        .agg(
            F.count_if(~session).alias("minute_keys"),
            F.count_if(session).alias("session_keys"),
            F.coalesce(F.sum(F.when(session, F.octet_length("user_session"))), F.lit(0)).alias("text"),
        )
        .first()
    )
    return Violators(path, int(got["minute_keys"]), int(got["session_keys"]), int(got["text"]))


def _anti(df: DataFrame, keys: DataFrame, names: tuple[str, ...], broadcast: bool) -> DataFrame:
    renamed = keys.select(*[F.col(k).alias(f"__v_{k}") for k in names])
    if broadcast:
        renamed = F.broadcast(renamed)
    cond = [df[k].eqNullSafe(renamed[f"__v_{k}"]) for k in names]
    return df.join(renamed, cond, "left_anti")


def _bloom_bits(names: tuple[str, ...], words: int):
    """(word, bits) of a key in the filter. Nulls are values of their own."""
    h = F.xxhash64(*[c for n in names for c in (F.col(n), F.col(n).isNull())])
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63).cast("long")).cast("int")) for at in (0, 6, 12)]
    return F.pmod(F.shiftrightunsigned(h, 18), F.lit(words)).alias("__word"), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).alias("__bits")


def possible_matches(df: DataFrame, keys: DataFrame, names: tuple[str, ...], flag: str, words: int = BLOOM_WORDS) -> DataFrame:
    """``df`` with ``flag``: whether a row's key may be among ``keys``. False is
    sure. The filter has ``words`` rows at most, however many keys there are."""
    bloom = keys.select(*_bloom_bits(names, words)).groupBy("__word").agg(F.bit_or("__bits").alias("__held"))
    word, bits = _bloom_bits(names, words)
    joined = df.withColumns({"__at": word, "__own": bits}).join(F.broadcast(bloom), F.col("__at") == F.col("__word"), "left")
    maybe = F.coalesce(F.col("__held").bitwiseAND(F.col("__own")) == F.col("__own"), F.lit(False))
    return joined.withColumn(flag, maybe).drop("__at", "__own", "__word", "__held")


def drop_violators(
    df: DataFrame, violators: Violators, broadcast_bytes: int = BROADCAST_BYTES, bloom_words: int = BLOOM_WORDS
) -> DataFrame:
    """Second pass: keep rows whose keys are not in ``violators``."""
    v = violators
    keys = df.sparkSession.read.schema(VIOLATOR_SCHEMA).parquet(v.path)
    kinds = [(keys.filter(f"by_minute = {kind}"), names) for kind, names, n in ((1, MINUTE_KEYS, v.minute_keys), (0, SESSION_KEYS, v.session_keys)) if n]
    rows = with_minute(df)
    if v.hashed_bytes <= broadcast_bytes:
        for own, names in kinds:
            rows = _anti(rows, own, names, True)
        return rows.drop("event_minute")
    flags = []
    for own, names in kinds:
        flags.append(f"__maybe_{len(flags)}")
        rows = possible_matches(rows, own, names, flags[-1], bloom_words)
    some = F.greatest(*flags, F.lit(False))
    maybe = rows.filter(some)
    for own, names in kinds:
        maybe = _anti(maybe, own, names, False)
    return rows.filter(~some).unionByName(maybe).drop("event_minute", *flags)


def cap_traffic(
    df: DataFrame,
    caps: Caps = DEFAULT_CAPS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Drop capped groups. The aggregate runs here; the result is the lazy
    second pass. It reads the key table until it is used, so that table is
    deleted when the process ends (the jobs, which know when they are done,
    delete theirs themselves)."""
    violators = find_violators(df, caps)
    delete_at_exit(df.sparkSession, violators.path)
    return drop_violators(df, violators, broadcast_bytes)
