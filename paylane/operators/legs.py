"""The legs of a run's window, stored once for everything that pairs them.

A leg is put under the pairing key that it shares with its counterpart: kind, transfer, both parties and value. Equal legs are
one row with a count, from here up to the written lines. The table is bucketed by the key, so pairs, charges and moving
wallets are joined and counted where the legs lie. Where one key is hot its bucket would be one task's; the buckets' sizes are
looked at once, and uneven ones are read as plain files, whose joins can be split at run time.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import on_cleanup, partitions_at_least, settings, work_dir

# Receiver leg type -> payer leg type, for main, commission and service-charge legs.
LEG_PAIRS = {"MR": "MP", "CR": "CP", "SCR": "SCP"}
ALL_KINDS = tuple(LEG_PAIRS)
PAIR_KEY = ("kind", "transfer_id", "receiver_user_id", "sender_user_id", "transfer_value")

# What a pair carries from each of its legs, besides the pairing key.
SIDE_COLUMNS = {
    "pseudo_user_id": "pseudo_user_id",
    "wallet_number": "wallet",
    "account_id": "msisdn",
    "previous_balance": "pre_balance",
    "post_balance": "post_balance",
}
# What it carries from one of them alone.
RECEIVER_COLUMNS = {"service_type": "receiver_service_type", "txn_mode": "txn_mode"}
PAYER_COLUMNS = {"service_type": "service_type", "transfer_subtype": "item_subtype", "requested_value": "requested_value"}

# What legs of a ledger carry besides the pairing key: main legs all of it, charges nothing.
MAIN_KINDS, CHARGE_KINDS = ("MR", "MP"), ("SCR", "SCP")

# Legs that a task counts in memory: there are as many buckets as keep to that.
BUCKET_ROWS = 350_000
# A task that deals legs out to many buckets holds its own in memory as well, so its input is kept small where items are joined.
DEALING_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
# Ids, parties and wallets repeat their letters and padding from row to row, which Parquet's default codec leaves in.
CODEC = "zstd"

# A bucket this many times the middle one, and of so many rows at least, holds a hot key.
UNEVEN, UNEVEN_ROWS = 5, 1_000_000


class Legs(NamedTuple):
    """A stored table of legs under their pairing key, equal ones with their number in ``copies``."""

    table: DataFrame


def carrying(items: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Items whose legs carry, of what they may carry, the given columns alone."""
    return items.drop(*sorted({*RECEIVER_COLUMNS, *PAYER_COLUMNS, *SIDE_COLUMNS} - {*columns}))


def ledger_items(items: DataFrame) -> DataFrame:
    """What a ledger asks of its legs: main legs whole, of service charges the pairing key alone, of commissions nothing.

    Charges enter as totals over the key, so their wallets, phones and balances need not be moved or kept.
    """
    main = F.col("transaction_type").isin(*MAIN_KINDS)
    carried = [c for c in items.columns if c in {*RECEIVER_COLUMNS, *PAYER_COLUMNS, *SIDE_COLUMNS}]
    return items.where(main | F.col("transaction_type").isin(*CHARGE_KINDS)).withColumns({c: F.when(main, F.col(c)) for c in carried})


def keyed(items: DataFrame) -> DataFrame:
    """Legs under their pairing key, from one pass over the items; what only the other side needs is left out.

    Items may come without columns that their pairs are not asked for; legs are stored without them then.
    """
    receives = f"transaction_type in ({', '.join(repr(k) for k in LEG_PAIRS)})"
    kinds = " ".join(f"when '{payer}' then '{kind}'" for kind, payer in LEG_PAIRS.items())
    one_sided = [c for c in dict.fromkeys([*RECEIVER_COLUMNS, *PAYER_COLUMNS]) if c in items.columns]
    return items.where(F.col("transaction_type").isin(*LEG_PAIRS, *LEG_PAIRS.values())).selectExpr(
        f"{receives} as receives",
        f"case transaction_type {kinds} else transaction_type end as kind",
        "transfer_id",
        f"if({receives}, party_id, second_party) as receiver_user_id",
        f"if({receives}, second_party, party_id) as sender_user_id",
        "transfer_value",
        *[c if c in RECEIVER_COLUMNS and c in PAYER_COLUMNS else f"if({'' if c in RECEIVER_COLUMNS else 'not '}{receives}, {c}, null) as {c}" for c in one_sided],
        *[c for c in SIDE_COLUMNS if c in items.columns],
    )


def store_legs(items: DataFrame) -> Legs:
    """Store the legs of the (already windowed) items.

    Legs are exchanged once, to their buckets, and equal ones counted there, one after the other: a key of any number of copies
    is one group, and grouping needs no exchange of its own. A task writes one bucket, so its rows are not sorted for that.
    What is joined with the legs later, by transfer and by wallet, is dealt to as many partitions.
    """
    spark = items.sparkSession
    buckets = bucket_count(items)
    legs = keyed(items).repartition(buckets, *PAIR_KEY)
    counted = legs.groupBy(*legs.columns).agg(F.count(F.lit(1)).alias("copies"))
    path, name = work_dir(spark, "legs"), f"legs_{uuid.uuid4().hex}"
    writer = counted.write.option("compression", CODEC).bucketBy(buckets, *PAIR_KEY)
    finer = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(buckets)}
    with settings(spark, {**DEALING_CONF, **finer}):
        writer.option("path", path).saveAsTable(name)
    partitions_at_least(spark, buckets)
    on_cleanup(lambda: spark.sql(f"drop table if exists {name}"))
    plain = spark.read.schema(counted.schema).parquet(path)
    return Legs(plain if uneven(plain) else spark.table(name))


def bucket_count(items: DataFrame) -> int:
    """As many buckets as there are shuffle partitions, and more where those would hold too many legs for a task's memory.

    Legs are counted first, by the few columns that tell them. Buckets of a fixed number grow with the legs, and what a task
    cannot hold is spilled, by the counting of equal legs and by the sorts of each join.
    """
    conf = items.sparkSession.conf
    wanted = -(-keyed(items).count() // BUCKET_ROWS)
    return max(int(conf.get("spark.sql.shuffle.partitions")), min(wanted, int(conf.get("spark.sql.sources.bucketing.maxBuckets"))))


def uneven(files: DataFrame) -> bool:
    """Whether one bucket is far larger than the others, from the row counts of its files."""
    sizes = files.groupBy(F.input_file_name()).count()
    facts = sizes.agg(F.max("count").alias("most"), F.percentile("count", F.lit(0.5)).alias("middle")).first()
    return (facts["most"] or 0) >= max(UNEVEN_ROWS, UNEVEN * (facts["middle"] or 0))


def receiver_legs(items: DataFrame | Legs, kinds: tuple[str, ...] = ALL_KINDS) -> DataFrame:
    """Receiver legs under their pairing key, ``_received`` times each."""
    if isinstance(items, Legs):
        mine = items.table.where(F.col("receives") & F.col("kind").isin(*kinds))
        return mine.selectExpr(*PAIR_KEY, *_renamed(RECEIVER_COLUMNS, mine), *_renamed(SIDE_COLUMNS, mine, "receiver_"), "copies as _received")
    return items.where(F.col("transaction_type").isin(*kinds)).selectExpr(
        "transaction_type as kind",
        "transfer_id",
        "party_id as receiver_user_id",
        "second_party as sender_user_id",
        "transfer_value",
        *_renamed(RECEIVER_COLUMNS, items),
        *_renamed(SIDE_COLUMNS, items, "receiver_"),
        "1L as _received",
    )


def payer_legs(items: DataFrame | Legs, kinds: tuple[str, ...] = ALL_KINDS) -> DataFrame:
    """Payer legs under the kind of the receiver leg that they pair with, ``_paid`` times each."""
    if isinstance(items, Legs):
        mine = items.table.where(~F.col("receives") & F.col("kind").isin(*kinds))
        return mine.selectExpr(*PAIR_KEY, *_renamed(PAYER_COLUMNS, mine), *_renamed(SIDE_COLUMNS, mine, "sender_"), "copies as _paid")
    kind = " ".join(f"when '{LEG_PAIRS[k]}' then '{k}'" for k in kinds)
    return items.where(F.col("transaction_type").isin(*[LEG_PAIRS[k] for k in kinds])).selectExpr(
        f"case transaction_type {kind} end as kind",
        "transfer_id",
        "second_party as receiver_user_id",
        "party_id as sender_user_id",
        "transfer_value",
        *_renamed(PAYER_COLUMNS, items),
        *_renamed(SIDE_COLUMNS, items, "sender_"),
        "1L as _paid",
    )


def _renamed(columns: dict[str, str], held: DataFrame, prefix: str = "") -> list[str]:
    return [f"{c} as {prefix}{new}" for c, new in columns.items() if c in held.columns]


def expanded(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.withColumn("_copy", times).drop("_copy", "copies")
