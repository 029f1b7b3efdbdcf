"""Lookups of mapping rules in reference data.

Keys and outputs at the root are a left join, broadcast while the table's measured size is within the limit. Beyond it one pass over the keys tells
how many are null and which ones many rows share: those rows aren't shuffled (nulls find nothing, unless they may; the few rows of the table that are in demand
are broadcast), the others are.

Where keys or outputs are in an array, the row carries the part of the table that it may need as small maps and the lookup is an expression in the array, so
arrays are neither exploded nor put together again. Consecutive rules on one array share a pass: their keys are gathered side by side and their outputs written
together.

* a table of at most ``MAP_ROWS`` rows travels as one broadcast row of ``BUCKETS`` maps, of which a key is looked up in one;
* larger ones within the limit are broadcast once to each Python worker, which gives every row the entries of its own keys in Arrow batches, for all rules of
  a pass at once. Only the rows' keys go there, nothing is shuffled, and it works on streams;
* for one beyond the limit the rows are written once, with a number each; the numbers and their distinct keys alone meet the table in a join like the one at the
  root, and the entries found come back by the number. Such a table can't be used on a stream.

What is chosen from a table (by filter, keys and targets) is aggregated once and kept with the table, with its rows, bytes and repeated keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import errors, paths, sizes
from millrace.functions.paths import Reader
from millrace.session import shared_path

from .rules import Mapping, RuleError

#: Rows of a table that is sent along with every row, and the maps that it is dealt to, since a map is searched from its start.
MAP_ROWS, BUCKETS = 256, 64
#: Bytes of a table that is broadcast.
BROADCAST_BYTES = 10 << 20
#: A key is in demand if this share of the rows has it, so there are no more such keys than its inverse; what the count of keys keeps track of.
SHARE, TRACKED = 1 / 500, 10_000


@dataclass
class Table:
    """Reference data: its rows, default expressions by target attribute (``*`` for any other) and its own filter."""

    rows: DataFrame
    defaults: dict[str, str] = field(default_factory=dict)
    own_filter: object | None = None
    #: What to do about rows with the same key: "fail", or "largest" to take the largest values.
    duplicates: str = "fail"
    #: What was chosen from it so far.
    chosen: dict[tuple, Chosen] = field(default_factory=dict, repr=False, compare=False)


@dataclass
class Chosen:
    """Keys k0.. and a struct ``v`` of the targets, one row for each key; how many rows and bytes."""

    rows: DataFrame
    count: int
    size: int


def _selected(rule: Mapping, table: Table) -> Chosen:
    """What the rule looks up in the table, kept with it for other rules that choose the same."""
    override = rule.override_own_filter and rule.filter is not None
    wanted = (repr(rule.filter), override, tuple(k for k, _ in rule.keys), tuple(rule.targets.values()), rule.null_safe, table.duplicates)
    if wanted not in table.chosen:
        table.chosen[wanted] = _chosen(rule, table)
    return table.chosen[wanted]


def _chosen(rule: Mapping, table: Table) -> Chosen:
    rows = table.rows
    if table.own_filter is not None and not (rule.override_own_filter and rule.filter is not None):
        rows = rows.where(table.own_filter.condition())
    if rule.filter is not None:
        rows = rows.where(rule.filter.condition())
    for _, target in rule.targets.items():
        kind = paths.type_at(rows.schema, target)
        if kind is None or isinstance(kind, T.ArrayType) or paths.arrays_of(rows.schema, target):
            raise RuleError(f"rule {rule.order}: '{target}' of {rule.table} is missing or in an array")
    read = paths.reader({})
    keys = [read(k).alias(f"k{i}") for i, (k, _) in enumerate(rule.keys)]
    value = F.struct(*(read(t).alias(f"t{i}") for i, t in enumerate(rule.targets.values())))
    chosen = rows.select(*keys, value.alias("v"))
    names = [f"k{i}" for i in range(len(rule.keys))]
    if not rule.null_safe:
        for n in names:
            chosen = chosen.where(F.col(n).isNotNull())
    grouped = chosen.groupBy(*names).agg(F.max("v").alias("v"), F.count("*").alias("n"))
    size = sum((sizes.of_value(F.col(f.name), f.dataType) for f in grouped.schema.fields if f.name != "n"), F.lit(0))
    twice = F.max_by(F.to_json(F.struct(*names)) if names else F.lit("{}"), F.when(F.col("n") > 1, F.col("n")))
    seen = grouped.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.max("n").alias("most"), twice.alias("key")).first()
    if table.duplicates == "fail" and (seen.most or 0) > 1:
        raise RuleError(f"rule {rule.order}: {rule.table} has several rows for the key {seen.key}")
    return Chosen(grouped.drop("n"), seen.rows, seen.bytes)


def _has_default(table: Table, target: str) -> bool:
    return target in table.defaults or "*" in table.defaults


def _default(rule: Mapping, table: Table, target: str, kind: T.DataType) -> Column:
    expression = table.defaults.get(target, table.defaults.get("*"))
    return F.lit(None).cast(kind) if expression is None else F.expr(expression).cast(kind)


def check_default(expression: str, kind: T.DataType, rows: DataFrame) -> None:
    """Refuse a default expression that isn't of the target's type."""
    found = rows.limit(0).select(F.expr(expression).alias("d")).schema["d"].dataType
    fits = found == kind or isinstance(found, T.NullType) or isinstance(found, T.NumericType) and isinstance(kind, T.NumericType)
    if not fits:
        raise RuleError(f"the default {expression} is {found.simpleString()}, the target is {kind.simpleString()}")


@dataclass
class Lookup:
    """A rule with its table."""

    rule: Mapping
    table: Table


def nested(schema: T.StructType, rule: Mapping) -> bool:
    """Whether a rule reads or writes within an array."""
    return any(paths.arrays_of(schema, p) for p in [*rule.inputs, *rule.outputs])


def together(schema: T.StructType, lookups: list[Lookup], rule: Mapping) -> bool:
    """Whether a rule can share the pass of some others: all within the same arrays, and none of what it reads or writes is written by them."""
    around = paths.arrays_of(schema, rule.output)
    low = [p.lower() for p in [*rule.inputs, *rule.outputs]]
    written = [o.lower() for x in lookups for o in x.rule.outputs]
    apart = all(p != w and not p.startswith(f"{w}.") and not w.startswith(f"{p}.") for p in low for w in written)
    return apart and bool(around) and all(paths.arrays_of(schema, x.rule.output) == around for x in lookups)


def apply(df: DataFrame, rule: Mapping, table: Table, broadcast_bytes: int = BROADCAST_BYTES, map_rows: int = MAP_ROWS) -> DataFrame:
    """``df`` with the outputs of the rule and its errors."""
    return apply_all(df, [Lookup(rule, table)], broadcast_bytes, map_rows)


def apply_all(df: DataFrame, lookups: list[Lookup], broadcast_bytes: int = BROADCAST_BYTES, map_rows: int = MAP_ROWS) -> DataFrame:
    """``df`` with the outputs of rules that may share a pass, and their errors."""
    schema = df.schema
    for x in lookups:
        for target in x.rule.targets.values():
            kind = paths.type_at(x.table.rows.schema, target)
            if kind is not None and (default := x.table.defaults.get(target, x.table.defaults.get("*"))):
                check_default(default, kind, x.table.rows)
    chosen = [_selected(x.rule, x.table) for x in lookups]
    if len(lookups) == 1 and not nested(schema, lookups[0].rule):
        return _joined(df, lookups[0].rule, lookups[0].table, chosen[0], broadcast_bytes)
    return _looked_up(df, lookups, chosen, broadcast_bytes, map_rows)


def _kinds(rule: Mapping, table: Table) -> list[T.DataType]:
    return [paths.type_at(table.rows.schema, t) for t in rule.targets.values()]


def _errors(rule: Mapping, keys: list[Column]) -> Column:
    return errors.error(errors.CONF_MAP, ",".join(rule.outputs), keys, rule.keys)


def _joined(df: DataFrame, rule: Mapping, table: Table, chosen: Chosen, broadcast_bytes: int) -> DataFrame:
    """All keys and outputs are outside arrays."""
    read, kinds = paths.reader({}), _kinds(rule, table)
    names = [f"__k{i}" for i in range(len(rule.keys))]
    right = chosen.rows.select(*(F.col(f"k{i}").alias(n) for i, n in enumerate(names)), F.col("v").alias("__v"))
    keys = [read(column).cast(chosen.rows.schema[f"k{i}"].dataType) for i, (_, column) in enumerate(rule.keys)]
    if chosen.size <= broadcast_bytes:
        found = df.join(F.broadcast(right), _matching(keys, names, rule.null_safe), "left")
    else:
        found = spread_join(df, right, keys, names, "__v", rule.null_safe)
    missing = F.col("__v").isNull()
    columns: dict[str, Column] = {}
    for i, (output, target) in enumerate(rule.targets.items()):
        value = F.when(missing, _default(rule, table, target, kinds[i])).otherwise(F.col("__v").getField(f"t{i}"))
        root = output.split(".")[0]
        columns[root] = paths.write(df.schema, output, lambda _, value=value: value, columns.get(root))
    raw = [read(c) for _, c in rule.keys]
    columns[errors.ERRORS] = F.when(missing, errors.joined(F.col(errors.ERRORS), F.array(_errors(rule, raw)))).otherwise(F.col(errors.ERRORS))
    return found.withColumns(columns).drop("__v", *names)


def _matching(keys: list[Column], names: list[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for mine, name in zip(keys, names, strict=True):
        condition = condition & (mine.eqNullSafe(F.col(name)) if null_safe else mine == F.col(name))
    return condition


def spread_join(df: DataFrame, right: DataFrame, keys: list[Column], names: list[str], value: str, null_safe: bool = False, share: float = SHARE) -> DataFrame:
    """Left join of ``df`` by ``keys`` to a large ``right`` with one row for each key (its columns ``names``), however the rows are dealt to keys.

    A pass over the keys finds those that at least a ``share`` of the rows has. Rows of such keys, and rows whose keys are null (they find nothing), stay where
    they are: the former meet a broadcast of at most 1 / share rows. If these are few, all is one shuffle join.
    """
    condition = _matching(keys, names, null_safe)
    if df.isStreaming or not keys:
        return df.join(right, condition, "left")
    null = F.lit(False)
    for key in () if null_safe else keys:
        null = null | key.isNull()
    of = F.xxhash64(*keys)
    most = max(2, int(1 / share))
    seen = df.select(of.alias("h"), null.alias("none")).agg(
        F.count("*").alias("rows"), F.count_if("none").alias("none"), F.expr(f"approx_top_k(IF(none, NULL, h), {most}, {TRACKED})").alias("top")
    ).first()
    hot = [t["item"] for t in seen["top"] if t["item"] is not None and t["count"] >= share * seen["rows"]]
    unshuffled = seen["none"] + sum(t["count"] for t in seen["top"] if t["item"] in hot)
    if unshuffled < share * max(1, seen["rows"]):
        return df.join(right, condition, "left")
    there = F.xxhash64(*(F.col(n) for n in names))
    demanded = F.broadcast(right.where(there.isin(hot)))
    stays = null | of.isin(hot)
    return df.where(stays).join(demanded, condition, "left").unionByName(df.where(~stays).join(right.where(~there.isin(hot)), condition, "left"))


def _reachable(rule: Mapping, schema: T.StructType) -> bool:
    """Whether every key is an element of an array around the output, or outside of arrays."""
    around = set(paths.arrays_of(schema, rule.output))
    return all(set(paths.arrays_of(schema, p)) <= around for p in rule.inputs)


class _InArrays:
    """A rule's lookup in the maps that a row carries."""

    def __init__(self, number: int, schema: T.StructType, lookup: Lookup, chosen: Chosen):
        self.rule, self.table, self.chosen, self.schema = lookup.rule, lookup.table, chosen, schema
        self.kinds = _kinds(self.rule, self.table)
        self.column = f"__map{number}"
        self.reachable = _reachable(self.rule, schema)
        names = [f"k{i}" for i in range(len(self.rule.keys))]
        kinds = chosen.rows.schema
        self.key_kind = T.StructType([T.StructField(n, kinds[n].dataType) for n in names]) if names else T.StructType([T.StructField("k", T.IntegerType())])
        self.entries = chosen.rows.select(F.struct(*(names or [F.lit(0).alias("k")])).cast(self.key_kind.simpleString()).alias("key"), "v")
        self.map_kind = T.MapType(self.key_kind, kinds["v"].dataType)
        self.at: Callable[[Reader], Column] = lambda read: F.col(self.column)

    def key(self, read: Reader) -> Column:
        columns = [read(c).cast(self.chosen.rows.schema[f"k{i}"].dataType).alias(f"k{i}") for i, (_, c) in enumerate(self.rule.keys)]
        return F.struct(*columns).cast(self.key_kind.simpleString()) if columns else F.struct(F.lit(0).alias("k"))

    def wanted(self) -> Column:
        """The distinct keys of a row."""
        return F.array_distinct(paths.gather(self.schema, self.rule.output, self.key, F.array().cast(T.ArrayType(self.key_kind).simpleString())))

    def dealt(self) -> DataFrame:
        """One row with the whole table as maps, of which a key is in one."""
        dealt = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.map_from_entries(F.filter("all", lambda e: _bucket(e["key"]) == b)))
        self.at = lambda read: F.get(F.col(self.column), _bucket(self.key(read)).cast("int"))
        return self.entries.agg(F.collect_list(F.struct("key", "v")).alias("all")).select(dealt.alias(self.column))

    def hit(self, read: Reader) -> Column:
        """The table's values for a key, null where it has none."""
        if not self.reachable:  # a key in an array that isn't around the output has no single value
            return F.lit(None).cast(self.map_kind.valueType)
        value = F.try_element_at(self.at(read), self.key(read))
        for _, c in () if self.rule.null_safe else self.rule.keys:
            value = F.when(read(c).isNotNull(), value)
        return value

    def outputs(self) -> dict[str, Callable[[Reader], Column]]:
        def value(read: Reader, i: int, target: str) -> Column:
            if _has_default(self.table, target):
                return F.when(self.hit(read).isNull(), _default(self.rule, self.table, target, self.kinds[i])).otherwise(self.hit(read).getField(f"t{i}"))
            return self.hit(read).getField(f"t{i}")

        return {output: lambda read, i=i, target=target: value(read, i, target) for i, (output, target) in enumerate(self.rule.targets.items())}

    def problems(self) -> Column:
        return paths.gather(self.schema, self.rule.output, lambda read: F.when(self.hit(read).isNull(), _errors(self.rule, [read(c) for _, c in self.rule.keys])), errors.none())


def _looked_up(df: DataFrame, lookups: list[Lookup], chosen: list[Chosen], broadcast_bytes: int, map_rows: int) -> DataFrame:
    steps = [_InArrays(i, df.schema, x, c) for i, (x, c) in enumerate(zip(lookups, chosen, strict=True))]
    carried, known = df, [s for s in steps if s.reachable]
    large = [s for s in known if s.chosen.count > map_rows and s.chosen.size > broadcast_bytes]
    if large and df.isStreaming:
        raise RuleError(f"rule {large[0].rule.order}: {large[0].rule.table} takes {large[0].chosen.size} bytes, too many for a lookup in arrays of a stream")
    if large:
        carried = _by_rows(carried, large)
    if sent := [s for s in known if s not in large and s.chosen.count > map_rows]:
        own = _own_entries([s.entries for s in sent], [s.map_kind for s in sent])(*(s.wanted() for s in sent))
        carried = carried.withColumn("__maps", own)
        for i, s in enumerate(sent):
            s.at = lambda read, i=i: F.col("__maps").getField(f"m{i}")
    for s in known:
        if s.chosen.count <= map_rows:
            carried = carried.crossJoin(F.broadcast(s.dealt()))
    columns = paths.write_together(df.schema, {o: v for s in steps for o, v in s.outputs().items()})
    columns[errors.ERRORS] = errors.joined(F.col(errors.ERRORS), *(s.problems() for s in steps))
    return carried.withColumns(columns).drop("__maps", *(s.column for s in steps))


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def _own_entries(entries: list[DataFrame], kinds: list[T.MapType]) -> Callable[..., Column]:
    """A function of arrays of keys, one for each table, that gives a struct of maps of the tables' entries for them. Their sizes were checked before."""
    sent = [e.sparkSession.sparkContext.broadcast(e.toArrow()) for e in entries]

    def own(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        tables = [[b.value[name].combine_chunks() for name in ("key", "v")] for b in sent]
        places = [_finder(known) for known, _ in tables]
        for columns in batches:
            maps = []
            for keys, place, (known, found) in zip(columns if isinstance(columns, tuple) else (columns,), places, tables, strict=True):
                sizes = pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False)
                at = place(keys.flatten())
                hits = np.bincount(np.repeat(np.arange(len(keys)), sizes)[at >= 0], minlength=len(keys))
                ends, taken = np.concatenate(([0], np.cumsum(hits))).astype(np.int32), pa.array(at[at >= 0])
                maps.append(pa.MapArray.from_arrays(pa.array(ends), known.take(taken), found.take(taken)))
            yield pa.StructArray.from_arrays(maps, [f"m{i}" for i in range(len(maps))])

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return own(batches)

    def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return own(batches)

    return F.arrow_udf(one if len(entries) == 1 else many, T.StructType([T.StructField(f"m{i}", k) for i, k in enumerate(kinds)]))


def _finder(known: pa.StructArray) -> Callable[[pa.StructArray], np.ndarray]:
    """A function of keys that gives the places of equal ones among the known, -1 for others. Null equals null.

    Column by column, what was found so far and the next value become one number each, for all keys of a batch at once.
    """
    steps: list[tuple[pa.Array, pa.Array]] = []
    codes = np.zeros(len(known), np.int64)
    for column in known.flatten():
        values = pc.unique(column)
        pairs = codes * max(1, len(values)) + pc.index_in(column, value_set=values, skip_nulls=False).to_numpy(zero_copy_only=False)
        dense = pc.unique(pa.array(pairs))
        codes = pc.index_in(pa.array(pairs), value_set=dense).to_numpy(zero_copy_only=False).astype(np.int64)
        steps.append((values, dense))
    place = np.full(len(known), -1, np.int64)
    place[codes] = np.arange(len(known))

    def find(keys: pa.StructArray) -> np.ndarray:
        here = np.zeros(len(keys), np.int64)
        for (values, dense), column in zip(steps, keys.flatten(), strict=True):
            value = pc.fill_null(pc.index_in(column, value_set=values, skip_nulls=False), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            pairs = np.where((here < 0) | (value < 0), -1, here * max(1, len(values)) + value)
            here = pc.fill_null(pc.index_in(pa.array(pairs), value_set=dense), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(here < 0, -1, place[here]) if len(place) else np.full(len(keys), -1)

    return find


def _by_rows(df: DataFrame, steps: list[_InArrays]) -> DataFrame:
    """Each row gets its own entries of tables of any size. Rows are written with a number, so that they are computed once and keep it."""
    spark, nullable = df.sparkSession, df.schema[errors.ERRORS].nullable
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    numbered = df.drop(*void).withColumns({"__row": F.monotonically_increasing_id(), **{f"__keys{i}": s.wanted() for i, s in enumerate(steps)}})
    numbered.write.parquet(at := shared_path(spark, "rows"))
    rows = spark.read.schema(numbered.schema).parquet(at)
    out = rows.drop(*(f"__keys{i}" for i in range(len(steps))))
    for i, s in enumerate(steps):
        pairs = rows.select("__row", F.explode(f"__keys{i}").alias("key"))
        names = [f.name for f in s.key_kind.fields]
        right = s.entries.select(*(F.col("key").getField(n).alias(f"__{n}") for n in names), "v")
        found = spread_join(pairs, right, [F.col("key").getField(n) for n in names], [f"__{n}" for n in names], "v", True).where(F.col("v").isNotNull())
        maps = found.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("key", "v"))).alias(s.column))
        out = out.join(maps, "__row", "left")
    out = errors.with_nullability(out.drop("__row"), nullable)
    return out.select(*(F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns), *(s.column for s in steps))
