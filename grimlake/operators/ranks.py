"""Distributed ranking and partition statistics.

Spark plans ``row_number() OVER (ORDER BY ...)`` with no partition as an
``Exchange SinglePartition`` over every row, and ``OVER (PARTITION BY k)``
puts a whole group into one task, so one hot key (a third of the rows) or a
low-cardinality key (six decades) serialises the job. The operators here
compute the same exact values and pick the plan from measured sizes:

``group_profiles``
    one grouping-sets job giving, per partitioning, the number of groups and
    (group, order value) cells and the largest of each - the numbers every
    plan choice below is made from.

``partition_columns`` / ``Work``
    row numbers and whole-partition aggregates: ordinary windows when the
    largest group fits one task, otherwise ``shared_order_ranks``; grouped
    tables joined back (broadcast only under a measured row bound).

``shared_order_ranks`` / ``row_number_frame``
    row number = (rows of the group ordered before this row's order value)
    + (rows of the same value in earlier tie ranges) + (number inside its
    cell). All ranks over one order column share ONE repartition by (order
    value[, tie range]); tie ranges come from ``approxQuantile`` and split a
    hot value. Cut points only affect balance, never the result.

``ordered_cells``, ``cell_histogram`` / ``cell_table``, ``cell_ranks``
    rows in range cells of a whole order, so that ties and nulls are split by
    the columns after them, and one histogram of (group, value, cell) for rank
    offsets, ``percent_rank`` and group means of several partitionings.

``lag_over``
    ``lag(x, 1)``: windows inside cells of the order, with each cell's last
    value carried over to the next cell.

``dominant_value``
    most frequent value per group (count desc, value asc, nulls last) as two
    partial aggregations.

Only tables that are already aggregated (histograms, cell counts, mart rows)
are ever ordered without a partition key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.operators.joins import broadcast_rows_limit, few, not_broadcast
from grimlake.sources.stage import stored_table

TIE_BUCKET = "_tb"
#: Type in which scores are summed: exact, whatever the order of the rows.
EXACT = "decimal(18,3)"


def _cols(names: Sequence[str] | str | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (window semantics)."""
    keys = list(keys)
    if not keys:
        # A global aggregate is exactly one row of scalars: fetch that row (a
        # bounded result, like any aggregate action) and attach its values as
        # typed literals - no join, no cartesian product.
        row = right.first()
        return left.withColumns({f.name: F.lit(None if row is None else row[f.name])
                                 .cast(f.dataType) for f in right.schema.fields})
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = term if cond is None else cond & term
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def _order(c: str, desc: bool) -> Column:
    return F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last()


def tie_splits(df: DataFrame, tie: str, n_buckets: int,
               rel_err: float | None = None) -> list[float]:
    """Range cut points of ``tie`` for ``n_buckets`` buckets: one
    ``approxQuantile`` pass; a bounded list of ``n_buckets - 1`` numbers
    reaches the driver. Only balance depends on them, never the result."""
    cuts: list[float] = []
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        err = rel_err if rel_err is not None else 1.0 / (4 * n_buckets)
        v = df.select(F.col(tie).cast("double").alias("_v")).where(F.col("_v").isNotNull())
        cuts = v.approxQuantile("_v", probs, err)
    return [float("-inf")] + sorted(set(c for c in cuts if c == c)) + [float("inf")]


def apply_tie_bucket(df: DataFrame, tie: str, splits: list[float],
                     out: str = TIE_BUCKET) -> DataFrame:
    """Bucket of ``tie`` from frozen cut points (``Bucketizer``: a JVM binary
    search). Non-decreasing in ``tie``; a null tie goes to the last bucket,
    matching NULLS LAST."""
    if len(splits) <= 2:  # one range
        return df.withColumn(out, F.lit(0))
    tmp = f"{out}_v"
    staged = df.withColumn(tmp, F.coalesce(F.col(tie).cast("double"), F.lit(float("nan"))))
    bucketizer = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return bucketizer.transform(staged).withColumn(out, F.col(out).cast("int")).drop(tmp)


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str] | str | None,
           how: str = "left", rows: int | None = None) -> DataFrame:
    """Join a per-key table onto rows with null-safe key equality (a null
    group is one group, as in a window partition). ``rows`` is the table's
    measured row count: at or under the broadcast bounds (``joins.few``) the table is
    broadcast (the rows are not shuffled); otherwise it is a shuffle join, whatever
    Spark makes of the table's files."""
    if rows is not None:
        table = F.broadcast(table) if few(table, rows) else not_broadcast(table)
    return _null_safe_join(df, table, _cols(keys), how)


MAX_ROWS_CONF = "spark.grimlake.window.maxRowsPerTask"
DEFAULT_MAX_ROWS_PER_TASK = 4_000_000


def max_rows_per_task(spark) -> int:
    """Largest group one task may sort for a window (session setting)."""
    return int(spark.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS_PER_TASK)))


@dataclass(frozen=True)
class Profile:
    groups: int      # distinct partition values
    cells: int       # distinct (partition, order value) pairs
    max_group: int   # rows of the largest group
    max_cell: int    # rows of the largest (partition, order value) pair


def _profile_key(partition, order) -> tuple:
    return (tuple(_cols(partition)), order)


def group_profiles(df: DataFrame, sets: Sequence[tuple]) -> dict[tuple, Profile]:
    """Profiles of several (partition, order) pairs from ONE aggregation job
    (grouping sets over the union of their columns); memoised on ``df``."""
    memo = df.__dict__.setdefault("_grimlake_profiles", {})
    wanted = [_profile_key(p, o) for p, o in sets]
    missing = list(dict.fromkeys(k for k in wanted if k not in memo))
    if missing:
        cols = list(dict.fromkeys(c for P, o in missing for c in (*P, o)))
        gids = {}
        for P, o in missing:
            grouped = set(P) | {o}
            gids[(P, o)] = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols)
                               if c not in grouped)
        cells = (df.groupingSets([[*P, o] for P, o in missing], *cols)
                 .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid")))
        # For one set the columns outside it are constant null, so grouping by
        # all of them and the set id gives that set's groups.
        part_cols = [c for c in cols if any(c in P for P, _ in missing)]
        per_group = cells.groupBy("_gid", *part_cols).agg(
            F.sum("_n").alias("_g"), F.max("_n").alias("_m"), F.count(F.lit(1)).alias("_c"))
        # The order column is not a group key here; only partition columns are.
        rows = per_group.groupBy("_gid").agg(
            F.count(F.lit(1)).alias("groups"), F.sum("_c").alias("cells"),
            F.max("_g").alias("g"), F.max("_m").alias("m")).collect()
        by_gid = {r["_gid"]: r for r in rows}
        for k in missing:
            r = by_gid.get(gids[k])
            memo[k] = (Profile(0, 0, 0, 0) if r is None else
                       Profile(int(r["groups"]), int(r["cells"]), int(r["g"]), int(r["m"])))
    return {k: memo[k] for k in wanted}


def group_profile(df: DataFrame, partition: Sequence[str] | str | None,
                  order: str) -> Profile:
    """Sizes that decide a plan (see ``Profile``); one aggregation job."""
    return group_profiles(df, [(partition, order)])[_profile_key(partition, order)]


@dataclass(frozen=True)
class RankSpec:
    """``row_number() OVER (PARTITION BY partition ORDER BY order [DESC]
    NULLS LAST, ties ASC NULLS LAST)`` written to column ``out``."""
    partition: tuple
    order: str
    desc: bool
    ties: tuple
    out: str

    @classmethod
    def of(cls, partition, order, desc, ties, out) -> "RankSpec":
        return cls(tuple(_cols(partition)), order, desc, tuple(_cols(ties)), out)

    def window(self) -> Window:
        return Window.partitionBy(*self.partition).orderBy(
            _order(self.order, self.desc), *[F.col(t).asc_nulls_last() for t in self.ties])


class Work:
    """Everything computed over one partitioning: an optional row number
    (``rank``) and aggregates over the whole partition (``aggs``)."""

    def __init__(self, partition, order: str, rank: RankSpec | None = None,
                 aggs: dict[str, Column] | None = None, shared: bool = False):
        self.partition = tuple(_cols(partition))
        self.order = order
        self.rank = rank
        self.aggs = dict(aggs or {})
        self.shared = shared  # ranked with the others of its order, in one exchange, at every size


def partition_columns(df: DataFrame, works: Sequence[Work], key: str = "_rk",
                      limit: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """Add the row numbers and partition aggregates of ``works`` to ``df``,
    choosing each plan from measured sizes (one profiling job for all):

    * aggregates only, few groups (at most the broadcast bound): a grouped
      table broadcast onto the rows - the rows are not shuffled;
    * largest group fits one task (``limit`` rows): ordinary windows; the
      row number and the aggregates of one partitioning share one exchange;
    * otherwise (and always for a global row number and ``shared`` works): ``shared_order_ranks``
      in line - all such ranks over one order column share one exchange
      (cell windows plus offset tables) - and aggregates as a grouped table
      joined back (broadcast when small); no task ever holds a whole group.
    """
    spark = df.sparkSession
    limit = limit or max_rows_per_task(spark)
    bcast = broadcast_rows_limit(spark)
    src = df if source is None else source  # same rows; profiles and tables come from it
    orders = {((), w.order): None for w in works if w.shared}  # sizes that the shared ranks ask for
    profiles = group_profiles(src, [*[(w.partition, w.order) for w in works], *orders])
    out, window_cols, frames, tables = df, {}, [], []
    for w in works:
        prof = profiles[_profile_key(w.partition, w.order)]
        fits = bool(w.partition) and prof.max_group <= limit and not w.shared
        if w.rank is None and w.aggs and (prof.groups <= bcast or not fits):
            tables.append((w, prof))
        elif fits:
            if w.rank is not None:
                window_cols[w.rank.out] = F.row_number().over(w.rank.window()).cast("bigint")
            part = Window.partitionBy(*w.partition)
            window_cols.update({n: c.over(part) for n, c in w.aggs.items()})
        else:
            if w.rank is not None:
                frames.append((w, prof))
            if w.aggs:
                tables.append((w, prof))
    by_order: dict[tuple, list] = {}
    for w, prof in frames:
        by_order.setdefault((w.rank.order, w.rank.ties[0]), []).append((w.rank, prof))
    for (order, tie), members in by_order.items():
        out = shared_order_ranks(out, src, order, tie, members, limit)
    if window_cols:
        out = out.withColumns(window_cols)
    for w, prof in tables:
        out = attach(out, group_stats(src, w.partition, w.aggs), w.partition, rows=prof.groups)
    return out


def cell_offsets(src: DataFrame, partition: Sequence[str], order: str, desc: bool,
                 tie_bucket: str | None) -> DataFrame:
    """Per cell (group, order value[, tie range]): the rows that precede the
    cell in the group's order. Running sums over the cell table and the
    (group, value) histogram - both already aggregated."""
    P = list(partition)
    cell_keys = P + [order] + ([tie_bucket] if tie_bucket else [])
    cells = src.groupBy(*cell_keys).agg(F.count(F.lit(1)).alias("_cell_n"))
    if tie_bucket:
        w_cell = (Window.partitionBy(*P, order).orderBy(F.col(tie_bucket).asc())
                  .rowsBetween(Window.unboundedPreceding, -1))
        cells = cells.withColumn("_in_value",
                                 F.coalesce(F.sum("_cell_n").over(w_cell), F.lit(0)))
        hist = cells.groupBy(*P, order).agg(F.sum("_cell_n").alias("_value_n"))
    else:
        cells = cells.withColumn("_in_value", F.lit(0).cast("bigint"))
        hist = cells.select(*P, order, F.col("_cell_n").alias("_value_n"))
    w_hist = (Window.partitionBy(*P).orderBy(_order(order, desc))
              .rowsBetween(Window.unboundedPreceding, -1))
    hist = hist.withColumn("_before", F.coalesce(F.sum("_value_n").over(w_hist), F.lit(0)))
    if not tie_bucket:
        return hist.select(*P, order, F.col("_before").alias("_off"))
    offsets = _null_safe_join(cells, hist.select(*P, order, "_before"), P + [order], "inner")
    return offsets.select(*cell_keys, (F.col("_before") + F.col("_in_value")).alias("_off"))


def shared_order_ranks(out: DataFrame, src: DataFrame, order: str, tie: str,
                       members: Sequence[tuple], limit: int) -> DataFrame:
    """Distributed row numbers of several partitionings that share an order
    column: the rows are hash-partitioned ONCE by (order value[, tie
    range]); every rank is then a window inside that partitioning (a
    (group, value) cell never spans partitions) shifted by its cell offsets.
    The tie ranges are added when one order value alone (over all groups)
    exceeds ``limit`` rows. ``members`` are (RankSpec, Profile) pairs."""
    top = group_profile(src, None, order).max_cell
    buckets = 1 if top <= limit else -(-top // limit) * 4
    tb = None
    if buckets > 1:
        tb = f"_tb_{order}"
        splits = tie_splits(src, tie, buckets)
        out = apply_tie_bucket(out, tie, splits, tb)
        src = apply_tie_bucket(src, tie, splits, tb)
    out = out.repartition(*([order] + ([tb] if tb else [])))
    for spec, prof in members:
        P, name = list(spec.partition), spec.out
        cell_keys = P + [order] + ([tb] if tb else [])
        w_local = Window.partitionBy(*cell_keys).orderBy(
            *[F.col(t).asc_nulls_last() for t in spec.ties])
        out = out.withColumn(f"_local_{name}", F.row_number().over(w_local))
        offsets = cell_offsets(src, P, order, spec.desc, tb).withColumnRenamed(
            "_off", f"_off_{name}")
        out = attach(out, offsets, cell_keys, "left", rows=prof.cells * buckets)
        out = out.withColumn(name, (F.col(f"_off_{name}") + F.col(f"_local_{name}"))
                             .cast("bigint")).drop(f"_off_{name}", f"_local_{name}")
    return out.drop(tb) if tb else out


def row_number_frame(df: DataFrame, partition: Sequence[str] | str | None, order: str,
                     desc: bool, ties: Sequence[str] | str, out: str, key: str = "_rk",
                     limit: int | None = None) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY p ORDER BY order [DESC] NULLS
    LAST, ties ASC NULLS LAST)`` as a two-column frame (``key``, ``out``),
    computed with ``shared_order_ranks`` on a projection of ``df``; ``key``
    must be unique per row."""
    spec = RankSpec.of(partition, order, desc, ties, out)
    rows = df.select(*dict.fromkeys([key, *spec.partition, order, *spec.ties]))
    prof = group_profile(df, spec.partition, order)
    limit = limit or max_rows_per_task(df.sparkSession)
    return shared_order_ranks(rows, df, order, spec.ties[0], [(spec, prof)], limit
                              ).select(key, out)


CELL, PLACE = "_cell", "_place"


def group_place(column: str) -> str:
    """Name under which ``ordered_cells`` gives a row's number in its group and cell."""
    return f"_place_{column}"


def with_group_places(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with each row's number (from 1) among the rows of the same value of a
    column that come up to it in its partition; null is a value. Rows stay
    where they are: a task counts on, and keeps one number a value."""
    names = [group_place(c) for c in columns]

    def run(batches):
        seen: list[dict] = [{} for _ in columns]
        for batch in batches:
            numbers = []
            for c, counts in zip(columns, seen):
                coded = batch.column(batch.schema.get_field_index(c)).dictionary_encode(null_encoding="encode")
                code, values = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
                order = np.argsort(code, kind="stable")
                size = np.bincount(code, minlength=len(values))
                place = np.empty(len(code), np.int64)
                place[order] = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
                before = np.array([counts.get(v, 0) for v in values], np.int64)
                numbers.append(pa.array(place + before[code] + 1 if len(code) else place))
                counts.update(zip(values, (before + size).tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], [*batch.schema.names, *names])

    fields = [T.StructField(name, T.LongType()) for name in names]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def ordered_cells(df: DataFrame, order: Sequence[Column], limit: int | None = None, path: str | None = None,
                  groups: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``_cell`` and ``_place``, written once: the rows range-partitioned
    by the whole ``order``, each one's cell and its place (from 0) in it; for each
    column of ``groups`` its number (from 1) among the cell's rows of its value.

    Cells follow each other in the order. Their bounds are whole keys, not
    values of one column, so rows that tie in the leading columns, nulls
    included, are split further by the columns after them; with a unique last
    column no cell is bounded from below by ties. There are as many cells as
    keep each at about half of ``limit`` rows. The write fixes both columns: the
    bounds, which Spark samples, are used once.
    """
    spark = df.sparkSession
    limit = limit or max_rows_per_task(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * df.count() // limit))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = with_group_places(ranged, groups) if groups else ranged
    # The id holds the partition above 33 bits and the row's place in it below.
    at = stored_table(ranged.withColumn("_at", F.monotonically_increasing_id()), "cells", path)
    return at.select(*ranged.columns, F.shiftright("_at", 33).alias(CELL),
                     F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias(PLACE))


def labels_coded(df: DataFrame, columns: Sequence[str], code: str) -> DataFrame | None:
    """Stored (columns, code): a number for every row of values that ``columns`` have, to
    ``attach`` by them or by the code; None where they are too many to broadcast.
    ``df`` should be stored."""
    table = stored_table(df.select(*columns).distinct().withColumn(code, F.monotonically_increasing_id()), "labels")
    return table if few(table) else None


def cell_histogram(cells: DataFrame, partitions: Sequence[Sequence[str]], value: str) -> DataFrame:
    """Stored (partition columns, value, cell, _n, _s, _gid): rows and exact sums of
    ``value`` per group, value and cell, for several partitionings in one
    aggregation. Every rank offset, percent rank and mean follows from it."""
    cols = [*dict.fromkeys(c for P in partitions for c in P), value, CELL]
    return stored_table(cells.groupingSets([[*P, value, CELL] for P in partitions], *cols).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(value).cast(EXACT)).alias("_s"), F.grouping_id().alias("_gid")),
        "cell_histogram")


def cell_table(histogram: DataFrame, partitions: Sequence[Sequence[str]], partition: Sequence[str], value: str) -> DataFrame:
    """Per (group, value, cell) of one partitioning: ``_before`` (rows of the group
    in earlier cells), ``_before_asc`` (rows with a smaller value), ``_group_n`` and
    ``_group_sum``. The empty partitioning is summed up from the first of the others."""
    cols = [*dict.fromkeys(c for P in partitions for c in P), value, CELL]
    P = tuple(partition)
    source = P or tuple(partitions[0])
    gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in {*source, value, CELL})
    h = histogram.where(F.col("_gid") == gid)
    if not P:
        h = h.groupBy(value, CELL).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    group = Window.partitionBy(*P)
    upto = group.orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = group.orderBy(CELL).rangeBetween(Window.unboundedPreceding, -1)
    return h.select(*P, value, CELL, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                    (F.sum("_n").over(upto) - F.sum("_n").over(Window.partitionBy(*P, value))).alias("_before_asc"),
                    F.sum("_n").over(group).alias("_group_n"), F.sum("_s").over(group).alias("_group_sum"))


def place_in(partition: Sequence[str] | str) -> Column:
    """A row's number (from 1) among the rows of its group in its cell."""
    return F.row_number().over(Window.partitionBy(*_cols(partition), CELL).orderBy(PLACE))


def cell_ranks(cells: DataFrame, rows: DataFrame, partition: Sequence[str] | str, out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition ORDER BY the cells' order)`` on
    ``rows``, which have ``_cell`` and ``_place``: the place in the cell, moved by
    the group's rows in earlier cells. No task holds more of a group than a cell has."""
    P = _cols(partition)
    counts = cells.groupBy(*P, CELL).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*P).orderBy(CELL).rangeBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*P, CELL, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = _null_safe_join(rows.withColumn(out, place_in(P)), counts, [*P, CELL])
    return placed.withColumn(out, (F.col(out) + F.col("_before")).cast("bigint")).drop("_before")


def percent_from(before_asc: Column, group_n: Column) -> Column:
    """``percent_rank`` from the rows before and the group size."""
    return F.when(group_n <= 1, F.lit(0.0)).otherwise(before_asc.cast("double") / (group_n - 1))


def lag_over(df: DataFrame, partition: Sequence[str] | str, order: Sequence[str], out: str,
             limit: int | None = None) -> DataFrame:
    """``lag(value, 1) OVER (PARTITION BY partition ORDER BY order ASC NULLS
    LAST)``, where ``value`` is the last column of ``order`` and the order is
    total up to rows that are equal in all columns of ``df``.

    One form at every size. The rows are dealt once, to cells of (group,
    order columns but the last two, range of the last but one); equal rows of
    a cell are counted as one. The lag is a window inside a cell, and a cell's
    first row takes the last value of the cell before, from the table of
    cells. A group of any size is spread over its cells; ``limit`` (rows per
    cell, about) only moves their bounds. ``df`` is read more than once: it should
    be stored, and hold few columns.
    """
    limit = limit or max_rows_per_task(df.sparkSession)
    P, lead, tie, value = _cols(partition), list(order[:-2]), order[-2], order[-1]
    biggest = df.count()  # of stored rows: from the files' footers
    if biggest > limit:
        biggest = (df.groupBy(*P, *lead).agg(F.count(F.lit(1)).alias("n"))
                   .agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"])
    dealt = apply_tie_bucket(df, tie, tie_splits(df, tie, max(1, -(-int(biggest) // limit))))
    cell = [*P, *lead, TIE_BUCKET]
    inner = [F.col(tie).asc_nulls_last(), F.col(value).asc_nulls_last()]
    w = Window.partitionBy(*cell).orderBy(*inner)
    # Grouping by all columns stays inside the cells' partitioning: no second shuffle.
    rows = (dealt.repartition(*cell).groupBy(*dealt.columns).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumns({"_before": F.lag(value, 1).over(w), "_nth": F.row_number().over(w)}))
    last = F.max(F.struct(F.col(tie).isNull().alias("a"), F.col(tie).alias("b"),
                          F.col(value).isNull().alias("c"), F.col(value).alias("v")))
    cells = dealt.groupBy(*cell).agg(last.alias("_last"))
    by_cell = Window.partitionBy(*P).orderBy(*[F.col(c).asc_nulls_last() for c in [*lead, TIE_BUCKET]])
    carried = cells.select(*cell, F.lag(F.col("_last.v"), 1).over(by_cell).alias("_carried"))
    rows = _null_safe_join(rows, carried, cell)
    first = F.when(F.col("_nth") == 1, F.col("_carried")).otherwise(F.col("_before"))
    # Of equal rows the first follows the row before them, the others follow each other.
    rows = rows.withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)")))
    return rows.withColumn(out, F.when(F.col("_copy") == 1, first).otherwise(F.col(value))).select(*df.columns, out)


def group_stats(df: DataFrame, partition: Sequence[str] | str | None,
                aggs: dict[str, Column]) -> DataFrame:
    """``agg OVER (PARTITION BY p)`` as a per-group table (map-side partial
    aggregation); ``attach`` it to the rows."""
    P = _cols(partition)
    return df.groupBy(*P).agg(*[c.alias(name) for name, c in aggs.items()])


def dominant_value(df: DataFrame, partition: Sequence[str] | str, value: str,
                   out: str) -> DataFrame:
    """Most frequent ``value`` per group: count desc, then value asc with
    nulls last. Returns one row per group (partition columns + ``out``)."""
    P = _cols(partition)
    counts = df.groupBy(*P, value).agg(F.count(F.lit(1)).alias("_cnt"))
    key = F.struct((-F.col("_cnt")).alias("c"), F.col(value).isNull().alias("n"),
                   F.col(value).alias("v"))
    return counts.groupBy(*P).agg(F.min_by(F.col(value), key).alias(out))


def global_row_number(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``row_number() OVER (ORDER BY ...)`` for small, already aggregated mart
    tables (tens to hundreds of rows): one partition is fine here only."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
