"""Packed auction queues: parsing, explosion, winners, per-ad per-day statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.schemas import TRAIN_ENTRY, QueueLayout

ENTRY_SEP, FIELD_SEP = ";", ","
STAT_COLUMNS = [
    "requestion_num", "user_num", "filter_rate", "total_ecpm", "q_ecpm", "pctr",
    "rival_epcm", "rival_pctr", "rival_q_epcm", "rival_filter_rate", "rival_max_epcm", "rival_num",
]


def raw_entries(packed: Column | str = "ad_info") -> Column:
    return F.split(packed, ENTRY_SEP, -1)


def entry_ad(entry: Column) -> Column:
    return F.substring_index(entry, FIELD_SEP, 1)


def parse_queue(log: DataFrame, layout: QueueLayout = TRAIN_ENTRY, strict: bool = True,
                packed: str = "ad_info", into: str = "queue") -> DataFrame:
    """Replace the packed text by an array of typed entries.

    ``strict`` raises on a malformed number or a short entry; otherwise the field
    becomes null (see ``quarantine_log``).
    """
    def pick(fields: Column, position: int, kind: str) -> Column:
        if strict:
            return F.element_at(fields, position).cast(kind)
        return F.try_element_at(fields, F.lit(position)).try_cast(kind)

    def typed(fields: Column) -> Column:
        columns = [pick(fields, 1, "bigint").alias("ad_id")]
        columns += [pick(fields, at, "double").alias(name) for name, at in layout.numeric.items()]
        if layout.exposed is not None:
            columns.append(pick(fields, layout.exposed, "int").alias("exposed"))
        return F.struct(*columns)

    # Each entry is split once; the typed struct is built from the pieces.
    pieces = F.transform(raw_entries(packed), lambda e: F.split(e, FIELD_SEP, -1))
    return log.withColumn(into, F.transform(pieces, typed)).drop(packed)


def explode_queue(parsed: DataFrame, queue: str = "queue", position: str | None = None) -> DataFrame:
    """One row per (request, entry); an ad listed twice in a queue gives two rows.

    The outer form is used because the inner one lets the optimizer add a filter on the
    array's size, which would parse every queue a second time. Its extra rows, for a
    missing queue, have no position.
    """
    rest = [c for c in parsed.columns if c != queue]
    rows = parsed.select(*rest, F.posexplode_outer(queue).alias("_at", "_e")).filter("_at is not null")
    return rows.select(*rest, *([F.col("_at").alias(position)] if position else []), "_e.*")


def _mean(queue: str, field: str) -> Column:
    total = F.aggregate(F.col(queue)[field], F.lit(0.0), lambda acc, x: acc + x)
    return total / F.size(queue)


def queue_profile(parsed: DataFrame, floor_max: float | None, queue: str = "queue") -> DataFrame:
    """Per-request averages over the whole queue (the ad itself included).

    Worked out inside the array, before any explosion, so it needs no shuffle.
    ``floor_max`` is the lowest value of the queue maximum (None: no floor).
    """
    top = F.array_max(F.col(queue)["total_ecpm"])
    if floor_max is not None:
        top = F.greatest(top, F.lit(float(floor_max)))
    return parsed.withColumns({
        "rival_epcm": _mean(queue, "total_ecpm"),
        "rival_pctr": _mean(queue, "pctr"),
        "rival_q_epcm": _mean(queue, "q_ecpm"),
        "rival_filter_rate": _mean(queue, "filter_flag"),
        "rival_max_epcm": top,
        "rival_num": F.size(queue).cast("double"),
    })


def is_parsed(log: DataFrame) -> bool:
    """Whether the log holds typed queues (``parse_queue``) instead of packed text."""
    return "queue" in log.columns


def user_rows(log: DataFrame, packed: str = "ad_info") -> DataFrame:
    """(days, user_id, ad_id) of every queue entry; of a parsed queue only the ads are read."""
    ads = F.col("queue.ad_id") if is_parsed(log) else F.transform(raw_entries(packed), lambda e: entry_ad(e).cast("bigint"))
    return log.select("days", "user_id", F.posexplode_outer(ads).alias("_at", "ad_id")).filter("_at is not null").drop("_at")


def ad_day_users(log: DataFrame, keys: list[str] | None = None, packed: str = "ad_info") -> DataFrame:
    """Distinct users whose queues contain the ad, per day."""
    return user_rows(log, packed).groupBy(*(keys or ["ad_id", "days"])).agg(F.countDistinct("user_id").alias("user_num"))


# Statistic and the column of a queue's profile that it averages.
AVERAGED = {
    "filter_rate": "filter_flag", "total_ecpm": "total_ecpm", "q_ecpm": "q_ecpm",
    "pctr": "pctr", "rival_epcm": "rival_epcm", "rival_pctr": "rival_pctr",
    "rival_q_epcm": "rival_q_epcm", "rival_filter_rate": "rival_filter_rate",
    "rival_max_epcm": "rival_max_epcm", "rival_num": "rival_num",
}


def ad_day_sums(log: DataFrame, layout: QueueLayout = TRAIN_ENTRY) -> DataFrame:
    """Requests and sums of the averaged values per (ad, day); sums of parts of a day add up."""
    parsed = log.select("days", "queue") if is_parsed(log) else parse_queue(log.select("days", "ad_info"), layout)
    rows = explode_queue(queue_profile(parsed, floor_max=0.0))
    return rows.groupBy("ad_id", "days").agg(
        F.count(F.lit(1)).alias("requestion_num"), *[F.sum(source).alias(name) for name, source in AVERAGED.items()])


def averaged(sums: DataFrame) -> DataFrame:
    """``ad_day_sums`` as averages: one shared count, half the aggregation buffer of separate ones."""
    return sums.select("ad_id", "days", "requestion_num", *[(F.col(n) / F.col("requestion_num")).alias(n) for n in AVERAGED])


def ad_day_request_stats(log: DataFrame, layout: QueueLayout = TRAIN_ENTRY) -> DataFrame:
    """The twelve per-ad per-day request and competition statistics.

    ``log`` has ``days``, ``user_id`` and the parsed ``queue`` or the packed ``ad_info``. The averages are one aggregation
    with map-side combine. The distinct users are counted in a second, narrow one: as
    part of the first it would spread the partial sums over (ad, day, user) and shuffle
    them nearly uncombined.
    """
    stats = averaged(ad_day_sums(log, layout))
    return stats.join(ad_day_users(log), ["ad_id", "days"]).select("ad_id", "days", *STAT_COLUMNS)


def winner(packed: Column | str = "ad_info") -> Column:
    """Ad of the first entry whose last character is 1; null when nothing won."""
    won = F.filter(raw_entries(packed), lambda e: F.endswith(e, F.lit("1")))
    return entry_ad(F.get(won, F.lit(0)))


def parsed_winner() -> Column:
    """The same of a parsed queue; only the ads and the flags are read."""
    won = F.array_position(F.transform(F.col("queue.exposed"), lambda x: x % 10 == 1), True)
    return F.get("queue.ad_id", (won - 1).cast("int"))


def exposed_ad(log: DataFrame, strict: bool = True) -> DataFrame:
    """Replace the queue by the ad that was shown; ``strict`` raises on a queue without one."""
    ad = parsed_winner() if is_parsed(log) else winner()
    if strict:
        ad = F.coalesce(ad, F.raise_error(F.lit("queue without an exposed entry"))).cast("bigint")
    else:
        ad = ad.try_cast("bigint")
    return log.withColumn("exposed_ad_id", ad).drop("ad_info", "queue")


def quarantine_log(log: DataFrame, layout: QueueLayout = TRAIN_ENTRY) -> DataFrame:
    """The log with a ``reason`` column: null for usable rows, otherwise why strict parsing fails."""
    parsed = parse_queue(log.withColumn("_raw", F.col("ad_info")), layout, strict=False, packed="_raw")
    fields = ["ad_id", *layout.numeric]
    broken = F.exists("queue", lambda e: F.array_contains(
        F.array(*[e[f].isNull() for f in fields]), True))
    reason = F.when(broken, "bad number")
    if layout.exposed is not None:
        reason = reason.when(winner().isNull(), "no exposed entry")
    return parsed.withColumn("reason", reason).drop("queue")


def label_counts(exposure: DataFrame) -> DataFrame:
    """Exposures per (ad, day): the label."""
    return (exposure.groupBy(F.col("exposed_ad_id").alias("ad_id"), "days")
            .agg(F.count("user_id").alias("Y")))


def label_join(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels onto the statistics; a day without exposure counts 0, as does any other gap."""
    return stats.join(labels, ["ad_id", "days"], "left").na.fill(0)
