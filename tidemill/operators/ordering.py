"""Positions, ranks, neighbours and medians that hold when one group has most of the rows.

A plain window puts a whole group in one task. Each function here first measures the largest
group (one scan of the key, order and value columns, combined before the shuffle). Up to
``max_group_rows`` the plain window is used. Above it, rows are told apart by borders in keys *and*
order, so a hot group covers many chunks; every chunk is worked on alone, and what crosses a border
is carried over from a small summary with one row per chunk. Borders are values, taken once from a
sketch of the key and order columns and stored as a small table, so a row falls into the same chunk
however often it is read, and no frame is written. ``max_group_rows=None`` skips the measuring, for
keys known to have small groups.

Order columns must give a total order (end with a unique column) for results to be repeatable,
and for a run of equal values to be splittable.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.session import materialise

# What one task sorts in good time; also the size of a chunk. Wide rows reach the second limit first.
MAX_GROUP_ROWS = 2_000_000
MAX_GROUP_BYTES = 2 << 30
CHUNK = "_chunk"
# Sampled values for each chunk to be made: their spread decides how even chunks are.
SKETCH = 64
# Buckets of one round of narrowing, and bytes of the texts in one array.
BUCKETS = 1_000
MAX_PART_BYTES = 64 << 20
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@dataclass(frozen=True)
class Order:
    """A column to order by: ascending with nulls last, or descending with nulls first."""

    name: str
    descending: bool = False

    @property
    def column(self) -> Column:
        return F.col(self.name).desc_nulls_first() if self.descending else F.col(self.name).asc_nulls_last()

    @property
    def reverse(self) -> Order:
        return Order(self.name, not self.descending)

    def after(self, left: Column, right: Column) -> Column:
        """Whether ``left`` comes after ``right``, which differs from it."""
        if self.descending:
            return F.coalesce(left < right, right.isNull())
        return F.coalesce(left > right, left.isNull())


def asc(name: str) -> Order:
    """Ascending, nulls last."""
    return Order(name)


def desc(name: str) -> Order:
    """Descending, nulls first."""
    return Order(name, True)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: texts as long as they are, other values 8."""
    sized = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    return reduce(lambda a, b: a + b, sized, F.lit(8 * len(df.columns))).cast("long")


def measured(df: DataFrame, keys: list[str], order_by: list[Order], column: str | None = None) -> DataFrame:
    """The columns that decide how large groups are: keys, order and value."""
    return df.select(*dict.fromkeys([*keys, *[o.name for o in order_by], *([column] if column else [])]))


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int, int, int]:
    """Rows in the largest group and in all, and bytes of the heaviest group and of all."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(row_bytes(df)).alias("b"))
    return tuple(n or 0 for n in counts.agg(F.max("n"), F.sum("n"), F.max("b"), F.sum("b")).first())


def chunks_needed(df: DataFrame, keys: list[str], max_group_rows: int | None) -> int:
    """Into how many chunks the rows must be split; 0 when a plain window will do."""
    if max_group_rows is None:
        return 0
    largest, total, heaviest, weight = group_sizes(df, keys)
    if largest <= max_group_rows and heaviest <= MAX_GROUP_BYTES:
        return 0
    return max(math.ceil(total / max(max_group_rows, 1)), math.ceil(weight / MAX_GROUP_BYTES))


def same(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of two column lists."""
    return reduce(lambda a, b: a & b, (l.eqNullSafe(r) for l, r in zip(left, right)), F.lit(True))


def borders_of(df: DataFrame, along: list[Order], chunks: int) -> DataFrame:
    """The values, numbered ``_i`` in order, at which about ``chunks`` equal chunks begin.

    A value is in the sketch if its hash is low enough, so about ``SKETCH`` distinct ones come for each chunk, with the
    number of their rows as weight: a bounded number, which one task puts in order."""
    names = [o.name for o in along]
    total, hashed = df.count(), F.xxhash64(*names)
    chosen = F.pmod(hashed, F.lit(max(total, 1))) < SKETCH * chunks
    sketch = df.select(*names).where(chosen).groupBy(*names).agg(F.count("*").alias("_w"))
    order = Window.orderBy(*[o.column for o in along])
    before = F.coalesce(F.sum("_w").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = max(1, math.ceil((sketch.agg(F.sum("_w")).first()[0] or 0) / chunks))
    place = sketch.withColumn("_piece", F.floor(before / size)).withColumn("_last", F.lag("_piece").over(order))
    starts = place.where("_piece > coalesce(_last, 0)").select(*names, F.row_number().over(order).alias("_i"))
    return materialise(starts, "borders")


def chunk_of(borders: DataFrame, along: list[Order]) -> Column:
    """The number of borders at or before a row, found by halving. The borders are one constant of the plan."""
    cells = F.array_sort(F.collect_list(F.struct("_i", *[F.col(o.name).alias(f"c{i}") for i, o in enumerate(along)]))).alias("cells")
    made = borders.agg(cells)
    text, n = made.select(F.to_json("cells", _EXACT), F.size("cells")).first()
    listed = F.from_json(F.lit(text), made.schema["cells"].dataType, _EXACT)

    def reached(border: Column) -> Column:
        found = F.lit(True)
        for i, o in reversed(list(enumerate(along))):
            own, other = F.col(o.name), border[f"c{i}"]
            found = F.when(own.eqNullSafe(other), found).otherwise(o.after(own, other))
        return found

    steps = F.array(*[F.lit(1 << k) for k in range(max(n, 1).bit_length() - 1, -1, -1)])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= n) & reached(F.get(listed, at + step - 1)), at + step).otherwise(at)
    )


def split_ranges(df: DataFrame, keys: list[str], order_by: list[Order], chunks: int) -> DataFrame:
    """Adds the chunk of each row; chunk numbers rise along (keys, order). Nothing is moved or written."""
    along = [*[asc(k) for k in keys], *order_by]
    return df.withColumn(CHUNK, chunk_of(borders_of(df, along, chunks), along))


def _attach(df: DataFrame, borders: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Joins the per-chunk ``values``. A chunk border falls inside one key at most, so ``borders``
    has no more rows than there are chunks and may be broadcast."""
    on = [*keys, CHUNK]
    borders = borders.select(*[F.col(k).alias(f"_b_{k}") for k in on], *values)
    match = same([df[k] for k in on], [borders[f"_b_{k}"] for k in on])
    return df.join(F.broadcast(borders), match, "left").drop(*[f"_b_{k}" for k in on])


def _carried(ranged: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """For each chunk but a key's first, the ``sums`` over the key's earlier chunks."""
    totals = ranged.groupBy(*keys, CHUNK).agg(*[s.alias(name) for name, s in sums.items()])
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    before = {name: F.sum(name).over(along.rowsBetween(Window.unboundedPreceding, -1)) for name in sums}
    return totals.withColumn("_later", F.row_number().over(along) > 1).withColumns(before).filter("_later")


def prefix_sums(
    df: DataFrame, keys: list[str], order_by: list[Order], weights: dict[str, Column], max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Adds, for each named weight, its sum over the rows of the key before this one.

    ``df`` is read more than once; a costly one should be stored first.
    """
    earlier, order = (Window.unboundedPreceding, -1), [o.column for o in order_by]
    chunks = chunks_needed(measured(df, keys, order_by), keys, max_group_rows)
    if not chunks:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*earlier)
        return df.withColumns({n: F.coalesce(F.sum(w).over(window), F.lit(0)) for n, w in weights.items()})

    ranged = split_ranges(df, keys, order_by, chunks)
    carried = _carried(ranged, keys, {f"_carried_{n}": F.sum(w) for n, w in weights.items()})
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(*earlier)
    local = ranged.withColumns({f"_local_{n}": F.coalesce(F.sum(w).over(inside), F.lit(0)) for n, w in weights.items()})
    joined = _attach(local, carried, keys, *[f"_carried_{n}" for n in weights])
    added = {n: F.col(f"_local_{n}") + F.coalesce(f"_carried_{n}", F.lit(0)) for n in weights}
    return joined.withColumns(added).drop(*[f"_{kind}_{n}" for n in weights for kind in ("local", "carried")], CHUNK)


def prefix_sum(
    df: DataFrame,
    keys: list[str],
    order_by: list[Order],
    weight: Column | None = None,
    name: str = "before",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Adds the sum of ``weight`` (default: row count) over the rows of the key before this one."""
    weight = F.lit(1).cast("long") if weight is None else weight
    return prefix_sums(df, keys, order_by, {name: weight}, max_group_rows)


def number_rows(
    df: DataFrame, order_by: list[Order], keys: list[str] = (), name: str = "row_number",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Row number from 1 over the whole frame, or over each key."""
    keys = list(keys)
    counted = prefix_sum(df, keys, order_by, None, name, max_group_rows)
    return counted.withColumn(name, F.col(name) + 1)


def rank_rows(
    df: DataFrame, column: str, descending: bool = True, name: str = "rank",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Rank by one column; ties share a rank and the next rank leaves a gap.

    Above the limit, borders are values, and the values that fill a chunk by themselves are borders too. Rows that
    equal a border make a chunk of their own between two others: they all share one rank, so they can be dealt
    over many tasks.
    """
    order = Order(column, descending)
    chunks = chunks_needed(df.select(column), [], max_group_rows)
    if not chunks:
        return df.withColumn(name, F.rank().over(Window.orderBy(order.column)).cast("long"))

    frequent = df.groupBy(column).agg(F.count("*").alias("_n")).filter(F.col("_n") > max(max_group_rows, 1)).select(column)
    values = borders_of(df, [order], chunks).select(column).unionByName(frequent).distinct()
    numbered = values.select(column, F.row_number().over(Window.orderBy(order.column)).alias("_i"))
    borders = materialise(numbered, "borders")  # at most one for each chunk and each value that fills one
    reached = chunk_of(borders, [order])
    ranged = df.withColumn("_reached", reached)
    starts = borders.select(F.col("_i").alias("_at"), F.col(column).alias("_start"))
    placed = ranged.join(F.broadcast(starts), F.col("_reached") == F.col("_at"), "left")
    equal = F.col("_at").isNotNull() & F.col(column).eqNullSafe(F.col("_start"))
    placed = placed.withColumn(CHUNK, 2 * F.col("_reached") + F.when(equal, 0).otherwise(1))
    placed = placed.withColumn("_deal", F.when(equal, F.spark_partition_id()).otherwise(-1)).drop("_reached", "_at", "_start")
    carried = _carried(placed, [], {"_carried": F.count("*")})
    local = placed.withColumn(name, F.rank().over(Window.partitionBy(CHUNK, "_deal").orderBy(order.column)))
    ranked = _attach(local, carried, [], "_carried")
    return ranked.withColumn(name, (F.col(name) + F.coalesce("_carried", F.lit(0))).cast("long")).drop("_carried", "_deal", CHUNK)


def prev_value(df: DataFrame, part: list[str], order_by: list[Order], column: str, name: str,
               max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Value of ``column`` in the row before, within the same ``part``."""
    return _neighbour(df, part, order_by, column, name, -1, max_group_rows)


def next_value(df: DataFrame, part: list[str], order_by: list[Order], column: str, name: str,
               max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Value of ``column`` in the row after, within the same ``part``."""
    return _neighbour(df, part, order_by, column, name, 1, max_group_rows)


def _neighbour(df, part, order_by, column, name, step, max_group_rows):
    shift, order = F.lead if step > 0 else F.lag, [o.column for o in order_by]
    chunks = chunks_needed(measured(df, part, order_by, column), part, max_group_rows)
    if not chunks:
        return df.withColumn(name, shift(column).over(Window.partitionBy(*part).orderBy(*order)))

    ranged = split_ranges(df, part, order_by, chunks)
    # the row of each chunk next to the border: a first row of its group, so each task sends on one per chunk
    near = [o.column if step > 0 else o.reverse.column for o in order_by]
    place = Window.partitionBy(*part, CHUNK).orderBy(*near)
    ends = ranged.select(*part, CHUNK, F.struct(column).alias("_end"), F.row_number().over(place).alias("_place")).filter("_place = 1")
    along = Window.partitionBy(*part).orderBy(CHUNK)
    borders = ends.withColumn("_border", shift("_end").over(along)).filter(F.col("_border").isNotNull())

    inside = Window.partitionBy(*part, CHUNK).orderBy(*order)
    marked = ranged.withColumns({name: shift(column).over(inside), "_inner": shift(F.lit(True), 1, False).over(inside)})
    value = F.when(F.col("_inner"), F.col(name)).otherwise(F.col(f"_border.{column}"))
    return _attach(marked, borders, part, "_border").withColumn(name, value).drop("_inner", "_border", CHUNK)


def ordered_array(
    df: DataFrame, keys: list[str], column: str, keep_nulls: bool = True, name: str = "items",
    max_items: int = 10_000, max_group_rows: int | None = MAX_GROUP_ROWS, max_bytes: int = MAX_PART_BYTES,
) -> DataFrame:
    """Values of each key in ascending order, nulls last, in arrays of up to ``max_items`` and, for texts, about
    ``max_bytes``.

    A key with more values has several rows, with rising numbers ``part`` from 0; set end to end they
    are the whole list. No value is left out and no array outgrows a row.
    """
    rows = df.select(*keys, column)
    rows = rows if keep_nulls else rows.filter(F.col(column).isNotNull())
    weights = {"_pos": F.lit(1).cast("long")}
    texts = rows.schema[column].dataType.typeName() in ("string", "binary")
    if texts:
        weights["_bytes"] = F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    placed = prefix_sums(rows, keys, [asc(column)], weights, max_group_rows)
    part = F.floor(F.col("_pos") / max_items)
    if texts:  # neither number ever falls along the list, so their sum changes when either does
        part = part + F.floor(F.col("_bytes") / max_bytes)
    cells = F.array_sort(F.collect_list(F.struct("_pos", column)))
    return placed.groupBy(*keys, part.cast("int").alias("part")).agg(F.transform(cells, lambda x: x[column]).alias(name))


def string_list(
    df: DataFrame, keys: list[str], column: str, sep: str = ", ", name: str = "items",
    max_items: int = 10_000, max_group_rows: int | None = MAX_GROUP_ROWS, max_bytes: int = MAX_PART_BYTES,
) -> DataFrame:
    """Values of each key joined into text, ascending, nulls left out; parts as in ordered_array."""
    lists = ordered_array(df, keys, column, False, name, max_items, max_group_rows, max_bytes)
    return lists.withColumn(name, F.array_join(name, sep))


def histogram(rows: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """For each key of ``bounds`` and each of ``BUCKETS`` equal steps between its ``_min`` and ``_max``: rows, least and
    greatest value. Tasks send on a row per key and step at most."""
    if keys:
        on = bounds.withColumnsRenamed({k: f"_s_{k}" for k in keys})
        held = rows.join(F.broadcast(on), same([rows[k] for k in keys], [on[f"_s_{k}"] for k in keys]))
    else:
        held = rows.withColumns({c: F.lit(v).cast(bounds.schema[c].dataType) for c, v in bounds.first().asDict().items()})
    held = held.filter("_v >= _min AND _v <= _max")
    finite = "_min > double('-infinity') AND _max < double('infinity')"
    step = F.expr(f"""
        CASE WHEN NOT ({finite}) THEN CASE WHEN _v = double('-infinity') THEN 0 WHEN _v < double('infinity') THEN 1 WHEN _v = double('infinity') THEN 2 ELSE 3 END
             WHEN _max / 2 - _min / 2 > 0 THEN least({BUCKETS - 1}, CAST(floor((_v / 2 - _min / 2) / (_max / 2 - _min / 2) * {BUCKETS}) AS INT))
             WHEN _v = _min THEN 0 ELSE 1 END""")
    return held.groupBy(*keys, step.alias("_step"), "_below", "_low", "_high").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )


def _narrowed(rows: DataFrame, bounds: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Medians of the keys of ``bounds``: the step that holds the middle becomes the next round's bounds, until the
    middle value, or the two on either side of it, are known. Each round ends with fewer different values."""
    found = None
    while True:
        steps = histogram(rows, bounds, keys)
        along = Window.partitionBy(*keys).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
        placed = steps.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_n").over(along), F.lit(0)))
        low, high = (((F.col("_from") <= F.col(c)) & (F.col(c) < F.col("_from") + F.col("_n"))) for c in ("_low", "_high"))
        middle = placed.filter(low | high).groupBy(*keys, "_low", "_high").agg(
            F.max(F.when(low, F.col("_max"))).alias("_left"), F.min(F.when(high, F.col("_min"))).alias("_right"),
            F.max(F.when(low, F.col("_from"))).alias("_below"), F.count("*").alias("_steps"),
        )
        middle = materialise(middle, "median-bounds")
        # two steps: the middle lies between them; one value in the step: it is the middle
        known = (F.col("_steps") == 2) | (F.col("_left") == F.col("_right"))
        part = middle.filter(known).select(*keys, (F.col("_left") * 0.5 + F.col("_right") * 0.5).alias(name))
        found = part if found is None else found.unionByName(part)
        bounds = middle.filter(~known).select(*keys, "_low", "_high", "_below", F.col("_right").alias("_min"), F.col("_left").alias("_max"))
        if bounds.isEmpty():
            return found


def median_by(
    df: DataFrame, keys: list[str], column: str, name: str = "median",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact median of each key, the mean of the two middle values for an even count.

    ``percentile`` holds a group's distinct values in one task, so it serves small groups. Keys with more rows than
    the limit, of which there are few, are narrowed down by histograms instead: no sort, and no shuffle of values.
    Nulls do not count; a group of nothing else has the median null. NaN is above all other values.
    """
    rows = df.select(*keys, F.col(column).cast("double").alias("_v"))
    plain = lambda part: part.groupBy(*keys).agg(F.percentile("_v", 0.5).alias(name))
    if not chunks_needed(rows, keys, max_group_rows):
        return plain(rows)

    counts = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    large = counts.filter(F.col("_n") > max_group_rows).select(
        *keys, F.expr("(_n - 1) div 2").alias("_low"), F.expr("_n div 2").alias("_high"), F.lit(0).cast("long").alias("_below"), "_min", "_max",
    )
    large = materialise(large, "median-bounds")  # at most one row for each max_group_rows rows
    if large.isEmpty():  # the rows were nulls
        return plain(rows)
    found = _narrowed(rows, large, keys, name)
    if not keys:
        return found
    side = large.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    small = rows.join(F.broadcast(side), same([rows[k] for k in keys], [side[f"_s_{k}"] for k in keys]), "left_anti")
    return plain(small).unionByName(found)


def sort_by(df: DataFrame, *columns: str | Order | Column) -> DataFrame:
    """Sorts by one or more columns; plain names sort ascending with nulls last."""
    orders = [asc(c) if isinstance(c, str) else c for c in columns]
    return df.orderBy(*[o.column if isinstance(o, Order) else o for o in orders])


def top_by_count(df: DataFrame, keys: list[str], k: int, name: str = "n") -> DataFrame:
    """The ``k`` keys with most rows; keys break ties."""
    counted = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counted.orderBy(F.desc(name), *[asc(c).column for c in keys]).limit(k)


def arg_max(df: DataFrame, column: str, columns: list[str], tie: list[str] = (), lowest: bool = False) -> DataFrame:
    """The chosen columns of the row with the largest (or lowest) value; ``tie`` picks among equals."""
    first = F.col(column).asc_nulls_last() if lowest else F.col(column).desc_nulls_last()
    return df.orderBy(first, *[asc(c).column for c in tie]).limit(1).select(*columns)


def rows_at_extreme(df: DataFrame, column: str, which: str = "max", tie: list[str] | None = None) -> DataFrame:
    """All rows holding the extreme value, or with ``tie`` the first of them in that order."""
    extreme = df.agg((F.max if which == "max" else F.min)(column)).scalar()
    found = df.filter(F.col(column) == extreme)
    return found if tie is None else found.orderBy(*[asc(c).column for c in tie]).limit(1)
