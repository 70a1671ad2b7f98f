"""The next row in sort order, for groups of any size.

A window function sends a whole group to one task. Here a group that holds more than its share of the rows
is cut into chunks along the sort order, whatever the size of the table, and the window runs per chunk. The
cuts are rows of the group, so the row after the last one of a chunk is the next cut itself, and no second
look at the data is needed: every row crosses the network once.

Which groups and values are heavy is told by a mergeable sketch of frequent items, where the cuts lie by a
sample of the heavy groups' rows. Both only decide how rows are dealt out, never what comes out. Rows of one
heavy value are counted before they are sent, so no value can fill a chunk.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.columns import quoted
from millrace.literals import literal_texts
from millrace.session import shuffle_partitions, stage

NEXT, COPIES = "__next", "__copies"
#: Chunks per shuffle partition, so that partitions come out even, and sampled rows per chunk.
CHUNKS_PER_PARTITION, SAMPLED_PER_CHUNK = 4, 32
#: The sketch tracks at least so many items, and so many per partition; it finds all that hold twice 3.5 / tracked of the rows.
TRACKED, TRACKED_PER_PARTITION, MOST_TRACKED = 10_000, 20, 1_000_000
_SAMPLE_SPACE = 1 << 30
#: Cuts of a table without groups that are found by conditions on literals; among more, a search in an array goes on.
TREE_CUTS = 63
LITERAL_TYPES = ("byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz", "string", "boolean")


def with_next(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Group and order columns of rows, with the next row's order columns as struct ``__next``.

    ``__next`` is NULL on the last row of a group; NULL sorts last. Each row of the result stands for
    ``__copies`` equal ones. Rows that are equal to a sort but written differently (letter case under a
    collation, signed zeros) stay apart. The table is read once for the sketch and once for the result, and
    two or three times more where a group is heavy; stage it first if it is expensive to make.
    """
    rows = df.select([quoted(c) for c in group + order])
    inside = Window.partitionBy(*[quoted(c) for c in group]).orderBy(*_ascending(order))
    total, groups = _heavy(rows, group or order)
    if group and not groups:
        return rows.withColumn(NEXT, F.lead(_values(order)).over(inside)).withColumn(COPIES, F.expr("1L"))
    # A value can only be heavy in a heavy group.
    values = _heavy(rows.where(_hash(group).isin(groups)), group + order, total)[1] if group else groups
    counted = _with_heavy_values_counted(rows, group + order, values)
    first = _first_rows(rows, group, order, total, groups, values)
    if not group and all(rows.schema[c].dataType.typeName() in LITERAL_TYPES for c in order):
        near = _in_chunks_by_literals(counted, first, order)
    else:
        near = _in_chunks_by_search(counted, first, group, order)
    return _one_row_per_successor(near, group, order) if values else near


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _hash(names: list[str]) -> Column:
    return F.expr(f"xxhash64({', '.join(map(_name, names))})")


def _ascending(names: list[str]) -> list[Column]:
    return [quoted(c).asc_nulls_last() for c in names]


def _values(names: list[str]) -> Column:
    return F.struct(*[quoted(c).alias(c) for c in names])


def _sortable(names: list[str]) -> str:
    """The columns as one value that sorts as they do, NULLs last: ``n0``, whether the first is NULL, ``v0``, its value, and so on."""
    parts = [f"'n{i}', {_name(n)} is null, 'v{i}', {_name(n)}" for i, n in enumerate(names)]
    return f"named_struct({', '.join(parts)})"


def _heavy(rows: DataFrame, names: list[str], total: int | None = None) -> tuple[int, list[int]]:
    """Number of rows, and hashes of the columns' values that may hold more than a partition's share of ``total`` rows, or of these."""
    partitions = shuffle_partitions(rows.sparkSession)
    tracked = min(MOST_TRACKED, max(TRACKED, TRACKED_PER_PARTITION * partitions))
    sketch = f"approx_top_k(xxhash64({', '.join(map(_name, names))}), {min(2 * partitions, tracked)}, {tracked}) as items"
    found = rows.selectExpr("count(*) as total", sketch).first()
    whole = found.total if total is None else total
    return found.total, [i.item for i in found["items"] or [] if i["count"] * partitions > whole]


def _spelling(df: DataFrame, names: list[str]) -> list[Column]:
    """Texts that tell apart what grouping would merge: collated texts and signed zeros."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [quoted(n).cast("string" if kinds[n] in ("float", "double") else "binary").alias(f"__spelt{i}")
            for i, n in enumerate(names) if kinds[n] in ("float", "double") or kinds[n].startswith("string collate")]


def _with_heavy_values_counted(rows: DataFrame, keys: list[str], values: list[int]) -> DataFrame:
    """The rows with ``__copies``; those of the given hashes are counted, by a grouping that combines before the shuffle."""
    if not values:
        return rows.withColumn(COPIES, F.expr("1L"))
    heavy = _hash(keys).isin(values)
    spelt = _spelling(rows, keys)
    counted = rows.where(heavy).groupBy(*[quoted(c) for c in keys], *spelt).agg(
        F.count(F.lit(1)).alias(COPIES), *[F.first(quoted(c)).alias(f"__as_is_{c}") for c in keys if spelt])
    counted = counted.select(*[quoted(f"__as_is_{c}" if spelt else c).alias(c) for c in keys], COPIES)
    return rows.where(~heavy).withColumn(COPIES, F.lit(1).cast("long")).union(counted)


def _first_rows(rows: DataFrame, group: list[str], order: list[str], total: int, groups: list[int], values: list[int]) -> DataFrame:
    """The first rows of all chunks of heavy groups but the first chunk: group and order columns, and ``__slot``, which rises with them.

    Every value has the same chance to be drawn, by its hash, and weighs as often as it occurs. There are about
    as many rows as chunks, whatever the size of the table.
    """
    chunks = CHUNKS_PER_PARTITION * shuffle_partitions(rows.sparkSession)
    mine, sort = [_name(c) for c in group], ", ".join(f"{_name(c)} asc nulls last" for c in order)
    share = min(1.0, SAMPLED_PER_CHUNK * chunks / max(1, total))
    every = f"xxhash64({', '.join(map(_name, group + order))})"
    drawn = rows.where(f"pmod({every}, {_SAMPLE_SPACE}) < {int(share * _SAMPLE_SPACE)}")
    if group:
        drawn = drawn.where(_hash(group).isin(groups))
    if values:
        drawn = drawn.where(~_hash(group + order).isin(values))
    weighed = drawn.groupBy(*[quoted(c) for c in group + order]).agg(F.expr("count(*) as __weight"))
    inside = f"partition by {', '.join(mine)}" if mine else ""
    along = f"({inside} order by {sort} rows between unbounded preceding and 1 preceding)"
    placed = weighed.selectExpr("*", f"coalesce(sum(__weight) over {along}, 0L) as __before", f"sum(__weight) over ({inside}) as __whole")
    slots = f"ceil(__whole / {share!r}D * {chunks} / {max(1, total)})"
    placed = placed.selectExpr("*", f"floor(__before * {slots} / __whole) as __slot")
    first = placed.selectExpr("*", f"lag(__slot, 1, 0L) over ({inside} order by {sort}) as __last").where("__slot > __last")
    return first.select(*[quoted(c) for c in group + order], "__slot")


def _next_in_chunk(placed: DataFrame, marks: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The window per chunk. Each cut also stands, marked, at the end of the chunk before it, so the window sees what comes next."""
    inside = Window.partitionBy("__chunk", *[quoted(c) for c in group]).orderBy(*_ascending(order))
    near = placed.unionAll(marks).withColumn(NEXT, F.lead(_values(order)).over(inside))
    return near.where("not __mark").select(*[quoted(c) for c in group + order], NEXT, COPIES)


def _search(cuts: str, start: str, left: int, order: list[str]) -> str:
    """How many cuts of a sorted array do not lie behind a row, by binary search from ``start`` on among ``left`` more."""
    steps = ", ".join(str(1 << k) for k in reversed(range(left.bit_length())))
    return f"aggregate(array({steps}), {start}, (c, s) -> if(try_element_at({cuts}, c + s) <= {_sortable(order)}, c + s, c))" if steps else start


def _in_chunks_by_literals(rows: DataFrame, first: DataFrame, order: list[str]) -> DataFrame:
    """A table without groups: the cuts are literals of the plan."""
    found = literal_texts(first.selectExpr("__slot", *[f"{_name(c)} as c{j}" for j, c in enumerate(order)]))
    found.sort(key=lambda cut: int(cut["__slot"].split("'")[1]))
    stride = -(-len(found) // (TREE_CUTS + 1)) or 1
    block = f"{_block(found[stride - 1::stride], order)} * {stride}"
    values = [[cut[f"c{j}"] for j in range(len(order))] for cut in found]
    sortable = ", ".join("named_struct(" + ", ".join(f"'n{j}', {v} is null, 'v{j}', {v}" for j, v in enumerate(cut)) + ")" for cut in values)
    chunk = _search(f"array({sortable})", block, stride - 1, order)
    placed = rows.selectExpr(*map(_name, order), COPIES, f"{chunk} as __chunk", "false as __mark")
    named = ", ".join("named_struct(" + ", ".join(f"'v{j}', {v}" for j, v in enumerate(cut)) + f", 'place', {i})" for i, cut in enumerate(values))
    if not found:
        return _next_in_chunk(placed, placed.limit(0), [], order)
    marks = rows.sparkSession.range(1).selectExpr(f"inline(array({named}))").selectExpr(
        *[f"v{j} as {_name(c)}" for j, c in enumerate(order)], f"1L as {COPIES}", "place as __chunk", "true as __mark")
    return _next_in_chunk(placed, marks, [], order)


def _in_chunks_by_search(rows: DataFrame, first: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Heavy groups among others: the cuts of a group come as an array, two rows per shuffle partition at most."""
    mine = [_name(c) for c in group]
    cuts = first.selectExpr(*[f"{c} as __g{i}" for i, c in enumerate(mine)], f"{_sortable(order)} as __cut").groupBy(
        *[f"__g{i}" for i in range(len(group))]).agg(F.expr("sort_array(collect_list(__cut)) as __cuts"))
    cuts = stage(cuts, "cuts")
    left = cuts.selectExpr("max(size(__cuts))").first()[0] or 0
    if group:
        same = reduce(operator.and_, [quoted(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(group)])
        dealt = rows.join(F.broadcast(cuts), same, "left")
    else:
        dealt = rows.withColumn("__cuts", cuts.select("__cuts").scalar())
    chunk = f"if(__cuts is null, 0, {_search('__cuts', '0', left, order)})"
    placed = dealt.selectExpr(*mine, *map(_name, order), COPIES, f"{chunk} as __chunk", "false as __mark")
    marks = cuts.selectExpr("*", "posexplode(__cuts) as (__place, __cut)").selectExpr(
        *[f"__g{i} as {c}" for i, c in enumerate(mine)], *[f"__cut.v{j} as {_name(c)}" for j, c in enumerate(order)],
        f"1L as {COPIES}", "__place as __chunk", "true as __mark")
    return _next_in_chunk(placed, marks, group, order)


def _block(cuts: list[dict[str, str]], order: list[str]) -> str:
    """How many of the cuts do not lie behind a row, as nested conditions on literals."""

    def before(cut: dict[str, str]) -> str:
        out = "false"
        for j, name in reversed(list(enumerate(map(_name, order)))):
            value = cut[f"c{j}"]
            less = f"coalesce({name} < {value}, {name} is not null and {value} is null)"
            out = f"({less} or ({name} <=> {value} and {out}))" if out != "false" else less
        return out

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"if({before(cuts[middle])}, {tree(low, middle)}, {tree(middle + 1, high)})"

    return tree(0, len(cuts))


def _one_row_per_successor(near: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """All copies of a row but the last are followed by the row itself."""
    last = F.struct(F.col(NEXT).alias("next"), F.lit(1).cast("long").alias("n"))
    others = F.struct(_values(order).alias("next"), (F.col(COPIES) - 1).alias("n"))
    followers = F.when(F.col(COPIES) > 1, F.array(last, others)).otherwise(F.array(last))
    return near.withColumn("__f", F.explode(followers)).select(
        *[quoted(c) for c in group + order], F.col("__f.next").alias(NEXT), F.col("__f.n").alias(COPIES))
