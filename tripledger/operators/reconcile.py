"""Three-way reconciliation of the bank, gateway and processor view of each payment."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import checks
from tripledger.functions.checks import CHANNELS
from tripledger.functions.scores import percentage
from tripledger.operators.skew import KeyProfile, among, not_among, profile_keys, stable_salt

FACTS = ("user_id", "event_time", "amount", "status", "source")
ROWS_PER_SALT = 2_000_000
KEY_MODES = ("coalesced", "bank")


def reconcile(
    bank: DataFrame,
    gateway: DataFrame,
    processor: DataFrame,
    *,
    key_mode: str = "coalesced",
    tolerance: float = fv.AMOUNT_TOLERANCE,
    exact: bool = False,
    dedupe: str | None = None,
    as_of: datetime | None = None,
    skew: dict[str, KeyProfile] | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """One row per matched combination of the three channels, with checks and verdict.

    `key_mode="coalesced"` matches the processor on the bank's or else the gateway's id;
    `"bank"` matches it on the bank's id only, so that a payment unknown to the bank gives
    separate rows. An id that occurs n times in a channel gives n rows, unless
    `dedupe="latest"` keeps each channel's newest row per id.

    Ids with very many rows are salted instead of meeting in one task. They are looked for
    when the inputs are large; `skew` takes a profile made before, or `{}` for none (needed on
    streams: looking for ids, and counting those of a profile, runs a small job while the plan is
    made). It changes the plan, never the rows.
    """
    if key_mode not in KEY_MODES:
        raise ValueError(f"key_mode is one of {KEY_MODES}")
    frames = dict(zip(CHANNELS, (bank, gateway, processor)))
    if dedupe == "latest":
        matched = _match_latest(frames, key_mode)
    elif dedupe is None:
        matched = _match_skewed(frames, key_mode, skew, rows_per_salt)
    else:
        raise ValueError("dedupe is None or 'latest'")
    return judge(matched, CHANNELS, tolerance, exact, as_of)


def compare_two(
    left: DataFrame,
    right: DataFrame,
    *,
    channels: tuple[str, str] = CHANNELS[:2],
    tolerance: float = fv.AMOUNT_TOLERANCE,
    exact: bool = False,
    as_of: datetime | None = None,
    skew: dict[str, KeyProfile] | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """The same report for two channels."""
    frames = dict(zip(channels, (left, right)))
    matched = _match_skewed(frames, "coalesced", skew, rows_per_salt)
    return judge(matched, channels, tolerance, exact, as_of)


def summarize(report: DataFrame) -> DataFrame:
    """Rows and share of every verdict in one pass."""
    counts = report.agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.count_if(F.col("reconciliation_status") == v).alias(f"{v}_count") for v in fv.VERDICTS],
    )
    return counts.select(
        "*", *[percentage(f"{v}_count", "total_count").alias(f"{v}_pct") for v in fv.VERDICTS]
    )


def with_row_key(report: DataFrame) -> DataFrame:
    """Adds `row_key`: the id, or for rows without one a hash of what they hold, run time aside.

    All rows of a key are one result: a table keeps them together and a later run replaces them
    together (`sources.tables.upsert_table(whole_keys=True)`)."""
    content = F.to_json(F.struct(*[c for c in report.columns if c != "reconciliation_time"]))
    return report.withColumn(
        "row_key", F.coalesce("transaction_id", F.concat(F.lit("\u0000"), F.sha2(content, 256)))
    )


def result_payload(report: DataFrame) -> DataFrame:
    """Key and JSON value of every payment that is not reconciled, for a message topic."""
    value = F.to_json(
        F.struct(
            "transaction_id",
            "user_id",
            "reconciliation_status",
            *[f"{c}_presence" for c in CHANNELS],
            *[f"{c}_amount" for c in CHANNELS],
            *[f"{c}_status" for c in CHANNELS],
        )
    )
    open_rows = report.filter(F.col("reconciliation_status") != fv.VERDICTS[-1])
    return open_rows.select(
        F.lit(fv.RESULT_TOPIC).alias("topic"), F.col("transaction_id").alias("key"), value.alias("value")
    )


# ---------------------------------------------------------------- matching


def _prefixed(df: DataFrame, channel: str) -> DataFrame:
    return df.select(
        F.col("transaction_id").alias(f"{channel}_id"),
        *[F.col(f).alias(f"{channel}_{f}") for f in FACTS],
    )


def _spread(key: Column, *other: Column) -> tuple[Column, Column]:
    """Join key that equals `key` where there is one. Rows without it match nothing, and hash by
    their other columns instead of meeting in one task."""
    alone = F.xxhash64(*other).cast("string")
    return key.isNotNull(), F.coalesce(key, alone)


def _full(left: DataFrame, key: Column, right: DataFrame, channel: str) -> DataFrame:
    """Full join on ids; NULL ids match nothing."""
    (known, left_id) = _spread(key, *[F.col(c) for c in left.columns])
    (_, right_id) = _spread(F.col(f"{channel}_id"), *[F.col(c) for c in right.columns])
    # 1 meets 1; the marks of unknown ids differ on the two sides.
    left_mark = F.when(known, F.lit(1)).otherwise(F.lit(2))
    right_mark = F.when(F.col(f"{channel}_id").isNotNull(), F.lit(1)).otherwise(F.lit(3))
    return left.join(right, (left_id == right_id) & (left_mark == right_mark), "full")


def _match(sides: dict[str, DataFrame], key_mode: str) -> DataFrame:
    first, second, *rest = sides
    ids = [F.col(f"{first}_id"), F.col(f"{second}_id")]
    matched = _full(sides[first], ids[0], sides[second], second)
    key = ids[0] if key_mode == "bank" else F.coalesce(*ids)
    for channel in rest:
        matched = _full(matched, key, sides[channel], channel)
    return matched


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _match_skewed(
    frames: dict[str, DataFrame],
    key_mode: str,
    skew: dict[str, KeyProfile] | None,
    rows_per_salt: int,
) -> DataFrame:
    if skew is None:
        skew = profile_keys(frames, "transaction_id")
    sides = {c: _prefixed(df, c) for c, df in frames.items()}
    ids = sorted({i for profile in skew.values() for i in profile.hot})
    # Identical rows without id hash alike: where there are very many, they pass the join by.
    no_id = [c for c in sides if c in skew and skew[c].null_keys > rows_per_salt]
    cold = {c: side.filter(not_among(F.col(f"{c}_id"), ids)) for c, side in sides.items()} if ids else dict(sides)
    parts = [sides[c].filter(F.col(f"{c}_id").isNull()) for c in no_id]
    for c in no_id:
        cold[c] = cold[c].filter(F.col(f"{c}_id").isNotNull())
    parts = [_match(cold, key_mode), *parts]
    if not ids:
        return _union(parts)
    for present, rows_of in _by_presence(sides, ids, key_mode).items():
        parts.append(_product({c: sides[c] for c in present}, rows_of, rows_per_salt))
    return _union(parts)


def _by_presence(
    sides: dict[str, DataFrame], ids: list[str], key_mode: str
) -> dict[tuple[str, ...], dict[str, dict[str, int]]]:
    """Channels that match each other on an id -> id -> rows in each of them, by a count of the
    listed ids (at most `max_hot` per channel, see `skew`). What a profile says about where an
    id occurs, or how often, is not relied on."""
    listed = [
        side.filter(among(F.col(f"{c}_id"), ids)).select(F.lit(c).alias("c"), F.col(f"{c}_id").alias("i"))
        for c, side in sides.items()
    ]
    rows_of: dict[str, dict[str, int]] = {}
    for c, i, n in _union(listed).groupBy("c", "i").count().collect():
        rows_of.setdefault(i, {})[c] = n
    groups: dict[tuple[str, ...], dict[str, dict[str, int]]] = {}
    for i, counts in rows_of.items():
        apart = key_mode == "bank" and CHANNELS[0] not in counts
        matching = [(c,) for c in counts] if apart else [tuple(c for c in sides if c in counts)]
        for present in matching:
            groups.setdefault(present, {})[i] = counts
    return groups


def _product(
    sides: dict[str, DataFrame], rows_of: dict[str, dict[str, int]], rows_per_salt: int
) -> DataFrame:
    """All combinations of rows of hot ids, over channels that all have rows of each id.

    Every channel's rows of an id are cut into pieces, and each combination of pieces is one
    cell of the join: a row goes to the cells that hold its piece.
    """
    first = next(iter(sides.values()))
    if len(sides) == 1:
        (c,) = sides
        return first.filter(among(F.col(f"{c}_id"), list(rows_of)))
    cuts = [(i, *[-(-counts[c] // rows_per_salt) for c in sides]) for i, counts in rows_of.items()]
    schema = "hot_id string, " + ", ".join(f"{c}_cuts long" for c in sides)
    grid = F.broadcast(first.sparkSession.createDataFrame(cuts, schema))  # one row per hot id
    celled = []
    for c, side in sides.items():
        facts = [name for name in side.columns if name != f"{c}_id"]
        placed = side.join(grid, F.col(f"{c}_id") == F.col("hot_id"))
        placed = placed.withColumn(f"{c}_cut", stable_salt(F.col(f"{c}_cuts"), *facts))
        for other in sides:
            if other != c:
                pieces = F.sequence(F.lit(0).cast("long"), F.col(f"{other}_cuts") - 1)
                placed = placed.withColumn(f"{other}_cut", F.explode(pieces))
        celled.append(placed.drop(*[f"{o}_cuts" for o in sides]))
    cell = ["hot_id", *[f"{c}_cut" for c in sides]]
    return reduce(lambda a, b: a.join(b, cell), celled).drop(*cell)


def _match_latest(frames: dict[str, DataFrame], key_mode: str) -> DataFrame:
    """Newest row per id and channel, all channels in one shuffle.

    Ties on time go to the greater amount, status, source and user. Copies of an id
    collapse before the shuffle.
    """
    newest_first = ("event_time", "amount", "status", "source", "user_id")
    tagged = _union(
        [
            df.filter(F.col("transaction_id").isNotNull()).select(
                "transaction_id",
                *[
                    (F.struct(*newest_first) if c == channel else F.lit(None)).alias(c)
                    for c in CHANNELS
                ],
            )
            for channel, df in frames.items()
        ]
    )
    newest = tagged.groupBy("transaction_id").agg(*[F.max(c).alias(c) for c in CHANNELS])
    matched = newest.select(
        *[
            column
            for c in CHANNELS
            for column in (
                F.when(F.col(c).isNotNull(), F.col("transaction_id")).alias(f"{c}_id"),
                *[F.col(f"{c}.{f}").alias(f"{c}_{f}") for f in FACTS],
            )
        ]
    )
    if key_mode == "bank":
        matched = _part_without_bank(matched)
    no_id = [_prefixed(df.filter(F.col("transaction_id").isNull()), c) for c, df in frames.items()]
    return _union([matched, *no_id])


def _part_without_bank(matched: DataFrame) -> DataFrame:
    """Split rows the bank does not know into one row per other channel."""
    bank, *others = CHANNELS
    split = F.col(f"{bank}_id").isNull()
    for c in others:
        split = split & F.col(f"{c}_id").isNotNull()
    keep = F.explode(F.when(split, F.array(*[F.lit(c) for c in others])).otherwise(F.array(F.lit("all"))))
    tagged = matched.withColumn("keep", keep)
    return tagged.select(
        *[F.col(f"{bank}_{f}") for f in ("id", *FACTS)],
        *[
            F.when(F.col("keep").isin("all", c), F.col(f"{c}_{f}")).alias(f"{c}_{f}")
            for c in others
            for f in ("id", *FACTS)
        ],
    )


# ---------------------------------------------------------------- judging


def judge(
    matched: DataFrame, channels, tolerance: float, exact: bool, as_of: datetime | None
) -> DataFrame:
    def first_known(name):
        return F.coalesce(*[F.col(f"{c}_{name}") for c in channels])

    checked = matched.select(
        first_known("id").alias("transaction_id"),
        first_known("user_id").alias("user_id"),
        first_known("event_time").alias("event_time"),
        *[F.col(f"{c}_amount") for c in channels],
        *[F.col(f"{c}_status") for c in channels],
        *[F.col(f"{c}_source") for c in channels],
        *[checks.presence(F.col(f"{c}_id")).alias(f"{c}_presence") for c in channels],
        *[
            checks.amount_check(F.col(f"{a}_amount"), F.col(f"{b}_amount"), tolerance, exact).alias(
                checks.pair_name(a, b)
            )
            for a, b in combinations(channels, 2)
        ],
        (F.lit(as_of) if as_of else F.current_timestamp()).alias("reconciliation_time"),
    )
    return checked.withColumn("reconciliation_status", checks.verdict(channels))
