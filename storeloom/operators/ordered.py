"""Global order without a one-task window: ranks, running sums, quantiles, point-in-time sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.session import cut_lineage


def ordered_scan(df: DataFrame, order_by: Sequence[Column | str], number: str | None = None,
                 running: dict[str, str] | None = None, total: str | None = None,
                 within: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Row number and running sums over the whole table in the given order.

    The rows are range-partitioned by ``order_by`` (which must identify a row, so that equal
    values cannot pile up in one range), sorted, numbered and stored in one pass. The totals of the
    ranges before it are added to each row: one row per range, a number fixed by the shuffle
    settings and not by the data. Row numbers need no further exchange; running sums bring each
    stored range together again.

    ``ranges`` is their number where the shuffle setting is not right for the table: choose it so that
    a range fits a task.

    ``running`` maps new columns to the columns they sum, and adds the sum over all rows as
    ``<new column>_total``; ``total`` names a row-count column. With ``within``, the leading
    columns of the order, everything starts anew in each of their groups.
    """
    running = running or {}
    # The number of a row has its partition in the upper bits and counts up within it.
    dealt = [ranges] if ranges else []
    ranged = cut_lineage(df.repartitionByRange(*dealt, *within, *order_by)
                         .sortWithinPartitions(*within, *order_by)
                         .withColumn("_row", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_row", 33))
    sizes = ranged.groupBy("_range", *within).agg(
        F.count("*").alias("_rows"), F.min("_row").alias("_first"),
        *[F.sum(c).alias(f"_sum_{name}") for name, c in running.items()])
    whole = Window.partitionBy(*within)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_range").alias("_start_range"), "_first", *[F.col(c).alias(f"_start_{c}") for c in within],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(whole).alias("_all_rows"),
        *[F.sum(f"_sum_{name}").over(before).alias(f"_before_{name}") for name in running],
        *[F.sum(f"_sum_{name}").over(whole).alias(f"_all_{name}") for name in running])
    out = ranged
    if running:
        upto = (Window.partitionBy("_range", *within).orderBy("_row")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = ranged.repartitionByRange(*dealt, "_range").withColumns(
            {f"_upto_{name}": F.sum(c).over(upto) for name, c in running.items()})
    same = F.col("_range") == F.col("_start_range")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_start_{c}"))
    # Without groups there is one row per range; with groups Spark goes by the measured size.
    out = out.join(starts if within else F.broadcast(starts), same)
    keep = [F.col(c) for c in df.columns]
    if number:
        at = F.col("_row") - F.col("_first") + 1
        keep.append((F.col("_rows_before") + at).alias(number))
    for name, c in running.items():
        kind = df.select(F.sum(c)).schema[0].dataType
        parts = [F.coalesce(F.col(f"_{p}_{name}").cast(kind), F.lit(0).cast(kind))
                 for p in ("before", "upto")]
        keep += [(parts[0] + parts[1]).cast(kind).alias(name),
                 F.col(f"_all_{name}").cast(kind).alias(f"{name}_total")]
    if total:
        keep.append(F.col("_all_rows").alias(total))
    return out.select(*keep)


def ntile(df: DataFrame, order_by: Sequence[Column | str], n: int, name: str,
          within: Sequence[str] = ()) -> DataFrame:
    """``NTILE(n)`` over the whole table, or each group ``within``; the first ``rows mod n`` tiles
    get one row more."""
    scan = ordered_scan(df, order_by, number="_nr", total="_rows", within=within)
    at, size, extra = F.col("_nr") - 1, F.floor(F.col("_rows") / n), F.col("_rows") % n
    wide = extra * (size + 1)
    tile = F.when(at < wide, F.floor(at / (size + 1)) + 1).otherwise(
        extra + F.floor(F.try_divide(at - wide, size)) + 1)
    return scan.select(*df.columns, tile.cast("int").alias(name))


def value_positions(df: DataFrame, value: str, by: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """The exact empirical distribution per ``by`` group, one row per distinct non-NULL value:
    its rows ``n``, the rows up to and including it ``upto``, and all rows ``upto_total``. A row
    stands for ``weight`` rows where that is given."""
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*by, value)
              .agg((F.sum(weight) if weight else F.count("*")).alias("n")))
    return ordered_scan(counts, [value], running={"upto": "n"}, within=by)


def quantile_values(df: DataFrame, value: str, shares: Sequence[float],
                    by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours, long form:
    ``by..., share, quantile``. Needs no group to fit in one task."""
    spread = value_positions(df, value, by, weight)
    # Every quantile lies between two neighbouring rows; a distinct value keeps the shares for
    # which it holds one of them, and nearly all values keep none.
    first, last = F.col("upto") - F.col("n") + 1, F.col("upto")
    at = lambda share: (F.col("upto_total") - 1) * share + 1
    holds = lambda row: (row >= first) & (row <= last)
    mine = F.filter(F.array(*[F.lit(float(s)) for s in shares]),
                    lambda s: holds(F.floor(at(s))) | holds(F.ceil(at(s))))
    hit = (spread.withColumn("share", F.explode(mine))
           .withColumn("_frac", at(F.col("share")) - F.floor(at(F.col("share")))))
    low, high = F.min(value).cast("double"), F.max(value).cast("double")
    return hit.groupBy(*by, "share").agg(
        (low + F.max("_frac") * (high - low)).alias("quantile"))


def history_before(points: DataFrame, events: DataFrame, key: str, at: str,
                   measures: Sequence[str], grain: str = "month",
                   carry: Sequence[str] | None = None) -> DataFrame:
    """For each distinct ``(key, at)`` of ``points``: sums over the events strictly before it. With
    ``carry``, for each row of ``points``, with those columns.

    Running sums work inside ``(key, grain)`` slots, and the totals of the slots are carried forward by
    a second window that sees one row per slot, so a key with a large share of the rows is spread over
    its slots; that second window has as many rows as a key has slots, twelve for a year of months.
    """
    nil, slot = F.lit(0), F.date_trunc(grain, at).alias("_slot")
    zeros = [nil.cast(events.schema[m].dataType).alias(m) for m in measures]
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    asked = points.filter(known).select(key, at, slot, F.struct(*(carry or [key])).alias("_carried"))
    if carry is None:
        asked = asked.dropDuplicates([key, at])
    nobody = F.lit(None).cast(asked.schema["_carried"].dataType).alias("_carried")
    told = events.filter(known).select(key, at, slot, *measures)
    # Points come before the events of their own instant.
    line = asked.select(key, at, "_slot", *zeros, "_carried", F.lit(0).alias("_kind")).unionByName(
        told.select("*", nobody, F.lit(1).alias("_kind")))
    earlier = Window.unboundedPreceding, -1
    inside = Window.partitionBy(key, "_slot").orderBy(at, "_kind").rowsBetween(*earlier)
    across = Window.partitionBy(key).orderBy("_slot").rowsBetween(*earlier)
    totals = told.drop(at).unionByName(points.filter(known).select(key, slot, *zeros))
    slots = (totals.groupBy(key, "_slot").agg(*[F.sum(m).alias(f"_slot_{m}") for m in measures])
             .select(key, "_slot", *[F.sum(f"_slot_{m}").over(across).alias(f"_before_{m}")
                                     for m in measures]))
    line = line.withColumns({f"_in_{m}": F.sum(m).over(inside) for m in measures})
    return (line.filter(F.col("_kind") == 0).join(slots, [key, "_slot"])
            .select(key, at, *[F.col(f"_carried.{c}").alias(c) for c in carry or []],
                    *[(F.coalesce(F.col(f"_in_{m}"), nil)
                       + F.coalesce(F.col(f"_before_{m}"), nil)).alias(m) for m in measures]))


def version_at(facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, stop: str,
               columns: Sequence[str], grain: str = "month") -> DataFrame:
    """As-of join: each fact with ``columns`` of the version of its key that is valid at its instant
    (``start <= at < stop``; no end where ``stop`` is NULL), NULL where none is.

    One sorted union of facts and versions, no range join. The line of a key is cut into slots of
    ``grain``, and each slot begins with the version that its key had before it, so that a key with a
    large share of the facts is spread over its slots. Versions of a key must not overlap. Pass
    ``facts`` as a stored table; it is read twice.
    """
    day = lambda c: F.col(c).cast("timestamp_ntz")
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    version = F.struct(day(stop).alias("_stop"), *columns)
    told = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), day(start).alias("_at"), version.alias("_version"))
    kind = told.schema["_version"].dataType
    asked = facts.filter(known).select(
        F.col(key).alias("_key"), day(at).alias("_at"), F.lit(None).cast(kind).alias("_version"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"))

    slot = F.date_trunc(grain, "_at").cast("timestamp_ntz")
    slots = (told.unionByName(asked.drop("_fact")).groupBy("_key", slot.alias("_slot"))
             .agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_at"))).alias("_last")))
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.withColumn("_version", F.last("_last", ignorenulls=True).over(before)).filter(
        F.col("_version").isNotNull())

    nobody = F.lit(None).cast(asked.schema["_fact"].dataType).alias("_fact")
    first = carried.select("_key", F.col("_slot").alias("_at"), "_version", nobody, F.lit(0).alias("_kind"))
    later = told.select("_key", "_at", "_version", nobody, F.lit(1).alias("_kind"))
    line = first.unionByName(later).unionByName(asked.withColumn("_kind", F.lit(2)))
    upto = (Window.partitionBy("_key", "_slot").orderBy("_at", "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (line.withColumn("_slot", slot)
             .withColumn("_valid", F.last("_version", ignorenulls=True).over(upto))
             .filter(F.col("_kind") == 2))
    open_then = F.col("_valid._stop").isNull() | (F.col("_at") < F.col("_valid._stop"))
    out = found.select("_fact.*", *[F.when(open_then, F.col(f"_valid.{c}")).alias(c) for c in columns])
    unknown = facts.filter(~known).select(
        "*", *[F.lit(None).cast(out.schema[c].dataType).alias(c) for c in columns])
    return out.unionByName(unknown)
