"""Replacing values by rules, applied one after another."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.functions.columns import col, is_numeric, present
from prepframe.guards import categories_of, require, with_categories
from prepframe.operators.lookup import fit_lookups
from prepframe.operators.rowid import with_row_id
from prepframe.scratch import stored

MAX_RULES = 100_000
CASE_RULES = 50
RULE_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    column: str
    old: object
    new: object


def _is_missing(value) -> bool:
    return (
        value is None
        or (isinstance(value, float) and math.isnan(value))
        or (isinstance(value, str) and value.lower() == "nan")
    )


# A literal typed by a user is a whole number, a decimal one with a dot, or text.
_WHOLE, _DECIMAL = r"^[+-]?\d+$", r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$"
_LONG = 2**63


def _number(value):
    """The number a literal stands for (whole ones beyond 64 bits are rounded to a double); ValueError if none."""
    if isinstance(value, str):
        text = value.strip()
        if re.match(_WHOLE, text, re.ASCII):
            value = int(text)
        elif re.match(_DECIMAL, text, re.ASCII):
            value = float(text)
        else:
            raise ValueError(f"{value!r} is not a number")
    if isinstance(value, int) and not -_LONG <= value < _LONG:
        value = float(value)
    return value


def _fractional(dtype: T.DataType) -> bool:
    return is_numeric(dtype) and not isinstance(dtype, T.IntegralType)


def make_rules(df: DataFrame, rules: Mapping[str, Mapping]) -> list[Rule]:
    """Rules for known columns; an old value that cannot occur in a numeric column drops its rule."""
    made = []
    for c, pairs in rules.items():
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        for old, new in pairs.items():
            if _is_missing(old):
                old = None
            elif is_numeric(dtype):
                try:
                    old = _number(old)
                except ValueError:
                    continue
                if _fractional(dtype) and old != float(old):  # such a column holds its rounded form at best
                    old = float(old)
            if is_numeric(dtype) and new is not None:
                try:
                    new = _number(new)
                except ValueError:
                    pass
            made.append(Rule(c, old, new))
    return made


def _widened(dtype: T.DataType, news: list) -> T.DataType:
    """The narrowest type that holds the column and every new value."""
    news = [n for n in news if n is not None]
    if not is_numeric(dtype):
        return dtype
    if any(isinstance(n, str) for n in news):
        return T.StringType()
    if isinstance(dtype, T.IntegralType):
        if any(isinstance(n, float) and (n != int(n) or not -_LONG <= n < _LONG) for n in news):
            return T.DoubleType()
        top = {T.ByteType: 2**7, T.ShortType: 2**15, T.IntegerType: 2**31}.get(type(dtype))
        if top and any(not -top <= n < top for n in news):
            return T.LongType()
    return dtype


def resolve(rules: list[Rule]) -> dict[str, dict]:
    """For each column, where every old value ends up after all rules have been applied in turn.

    Old values that have become the same are one group from then on, so a rule moves a group and not its members.
    """
    starts: dict[str, dict] = {}
    groups: list[list] = []  # the number of the group it went into (its own if none), and its value

    def top(g: int) -> int:
        while groups[g][0] != g:
            groups[g][0] = groups[groups[g][0]][0]
            g = groups[g][0]
        return g

    at: dict[str, dict] = {}
    for rule in rules:
        mine, here = starts.setdefault(rule.column, {}), at.setdefault(rule.column, {})
        group = here.pop(rule.old, None)
        if rule.old not in mine:
            own = len(groups)
            groups.append([own, rule.old])
            mine[rule.old] = own
            if group is None:
                group = own
            else:
                groups[own][0] = group
        if group is None:
            continue
        there = here.get(rule.new)
        if there is None:
            groups[group][1] = rule.new
            here[rule.new] = group
        else:
            groups[group][0] = there
    return {c: {old: groups[top(g)][1] for old, g in mine.items()} for c, mine in starts.items()}


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Few rules become one CASE per column; many become a broadcast join, whose keys have the column's own type."""
    ends = resolve(rules)
    big = [c for c, m in ends.items() if len(m) > CASE_RULES]
    for i, c in enumerate(big):
        source = df.schema[c].dataType
        kind = "double" if _fractional(source) else "long" if is_numeric(source) else "string"
        rows = []
        for old, new in ends[c].items():
            if old is not None and (kind != "long" or old == int(old)):
                old = {"double": float, "long": int, "string": str}[kind](old)
                whole = isinstance(new, int) and not isinstance(new, bool)
                rows.append((old, new if whole else None, new if isinstance(new, float) else None, None if new is None or whole or isinstance(new, float) else f"{new}"))
        table = df.sparkSession.createDataFrame(rows, f"_old{i} {kind}, _whole{i} long, _part{i} double, _text{i} string")
        if kind == "string" and not isinstance(source, T.StringType):
            table = table.withColumn(f"_old{i}", F.col(f"_old{i}").try_cast(source)).where(F.col(f"_old{i}").isNotNull())
            at = present(df, c)
        else:
            at = present(df, c).cast(kind)
        df = df.withColumn(f"_at{i}", at).join(F.broadcast(table), F.col(f"_at{i}") == F.col(f"_old{i}"), "left")

    def replaced(c: str):
        if c not in ends:
            return col(c)
        source = df.schema[c].dataType
        dtype = _widened(source, list(ends[c].values()))
        value = present(df, c).cast(dtype)
        if c in big:
            i = big.index(c)
            new = F.coalesce(*[F.col(f"_{part}{i}").cast(dtype) for part in _PARTS if _castable(part, dtype)])
            out = F.when(F.col(f"_old{i}").isNotNull(), new)
            if None in ends[c]:
                out = out.when(present(df, c).isNull(), F.lit(ends[c][None]).cast(dtype))
        else:
            out = F
            for old, new in ends[c].items():
                test = present(df, c).isNull() if old is None else _equals(c, old, source)
                out = out.when(test, F.lit(new).cast(dtype))
        return out.otherwise(value).alias(c, metadata=with_categories(df, c, list(ends[c].values())))

    helpers = {f"_{part}{i}" for i in range(len(big)) for part in ("at", "old", *_PARTS)}
    return df.select(*[replaced(c) for c in df.columns if c not in helpers])


_PARTS = ("whole", "part", "text")


def _castable(part: str, dtype: T.DataType) -> bool:
    return is_numeric(dtype) or isinstance(dtype, T.StringType) if part != "text" else not is_numeric(dtype)


def _equals(c: str, old, dtype: T.DataType):
    if isinstance(dtype, T.StringType) and not isinstance(old, str):
        return F.lit(False)
    if isinstance(dtype, T.IntegralType):  # a fraction, or a number beyond 64 bits, is in no such column
        return col(c) == F.lit(int(old)) if old == int(old) and -_LONG <= old < _LONG else F.lit(False)
    if is_numeric(dtype):
        return col(c).cast("double") == F.lit(float(old))
    return col(c) == F.lit(old).try_cast(dtype)


@dataclass(frozen=True)
class Replacement:
    """Rules ready to be applied, to a stream as well."""

    rules: tuple[Rule, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        return apply_rules(df, list(self.rules))


def fit_replacement(df: DataFrame, rules: Mapping[str, Mapping]) -> Replacement:
    return Replacement(tuple(make_rules(df, rules)))


def replace_values(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Apply `{column: {old: new}}` in the order given: a→b followed by b→c turns a into c.

    None, NaN or "nan" as the old value means missing cells. A numeric column is widened (whole number to
    double to text) when a new value does not fit it.
    """
    return apply_rules(df, make_rules(df, rules))


def replace_from_table(df: DataFrame, table: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """Apply rules given as rows (column, old, new, seq), all text, in the order of seq (then old, new).

    Up to max_rules, of up to RULE_BYTES, are resolved by the driver; more are resolved and joined as tables, with the
    same literals, key types and metadata.
    """
    require(table, ["column", "old", "new", "seq"])
    rules = table.select("column", "old", "new", "seq")
    width = F.octet_length(F.concat_ws("", "column", "old", "new"))
    rows, size = rules.limit(max_rules + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    if rows > max_rules or size > RULE_BYTES:
        return _replace_large(df, rules)
    made: list[Rule] = []
    order = lambda r: (r["seq"], r["old"] is not None, r["old"] or "", r["new"] is not None, r["new"] or "")
    for r in sorted(rules.collect(), key=order):
        made += make_rules(df, {r["column"]: {r["old"]: r["new"]}})
    return apply_rules(df, made)


#: What missing cells are looked up by; no text of a cell or rule is this.
_MISSING = "\0missing"


def _whole(text: Column) -> Column:
    """A literal's whole number, null if it is none or beyond 64 bits."""
    return F.when(F.btrim(text).rlike(_WHOLE), F.btrim(text).try_cast("decimal(38,0)").try_cast("long"))


def _double(text: Column) -> Column:
    number = F.btrim(text).rlike(_WHOLE) | F.btrim(text).rlike(_DECIMAL)
    return F.when(number, F.btrim(text).try_cast("double"))


def _number_key(whole: Column, double: Column) -> Column:
    """Numbers that are equal have equal keys: digits for whole ones within 64 bits, else the double as text."""
    is_whole = (double == F.floor(double)) & (F.abs(double) < float(_LONG))
    return F.coalesce(whole.cast("string"), F.when(is_whole, double.try_cast("long").cast("string")), (double + 0.0).cast("string"))


def _cell_key(df: DataFrame, c: str) -> Column:
    value, dtype = present(df, c), df.schema[c].dataType
    nothing = F.lit(None).cast("long")
    key = _number_key(nothing, value.cast("double")) if _fractional(dtype) else value.cast("string")
    return F.when(value.isNull(), F.lit(_MISSING)).otherwise(key)


def _literal_key(df: DataFrame, names: list[str], text: str, missing: Column) -> Column:
    """The key of a literal in the rule's column, null if no cell and no other literal can be equal to it."""
    out = F.when(missing, F.lit(_MISSING))
    for c in names:
        dtype, t, mine = df.schema[c].dataType, F.col(text), F.col("column") == c
        if _fractional(dtype):
            key = _number_key(F.lit(None).cast("long"), _double(t))
        elif is_numeric(dtype):
            key = _number_key(_whole(t), _double(t))
        else:
            key = t if isinstance(dtype, T.StringType) else t.try_cast(dtype).cast("string")
        out = out.when(mine, key)
    return out


def _resolved(df: DataFrame, table: DataFrame) -> DataFrame:
    """(column, key, new, first) after all rules have run in turn.

    Each rule points to the rule that next takes up what it makes; pointers are doubled until none moves, so a chain of
    n rules takes log2 n rounds.
    """
    names = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))]
    missing = F.col("old").isNull() | (F.lower("old") == "nan")
    keyed = table.where(F.col("column").isin(names)).select(
        "column",
        "new",
        "seq",
        "old",
        _literal_key(df, names, "old", missing).alias("key"),
        _literal_key(df, names, "new", F.col("new").isNull()).alias("made"),
    )
    rules = stored(with_row_id(keyed.where("key IS NOT NULL"), ["seq", "old", "new", "column"], "at"), "rules")
    # Beside each value's rules in order: of what a rule makes, the first rule that comes later.
    takes = rules.select("column", F.col("key").alias("value"), "at", F.col("at").alias("taker"))
    makes = rules.select("column", F.col("made").alias("value"), "at", F.lit(None).cast("long").alias("taker")).where("value IS NOT NULL")
    later = Window.partitionBy("column", "value").orderBy("at").rowsBetween(1, Window.unboundedFollowing)
    found = takes.union(makes).withColumn("next", F.first("taker", ignorenulls=True).over(later))
    pointers = stored(found.where("taker IS NULL AND next IS NOT NULL").select("at", "next"), "rules")
    while True:
        onward = pointers.select(F.col("at").alias("next"), F.col("next").alias("after"))
        moved = pointers.join(onward, "next", "left").select("at", F.coalesce("after", "next").alias("next"), F.col("after").isNotNull().alias("moves"))
        moved = stored(moved, "rules")
        if moved.where("moves").isEmpty():
            break
        pointers = moved.drop("moves")
    first = rules.groupBy("column", "key").agg(F.min("at").alias("at"))
    ends = first.join(pointers, "at", "left").select("column", "key", F.col("at").alias("first"), F.coalesce("next", "at").alias("at"))
    return ends.join(rules.select("at", "new"), "at").select("column", "key", "new", "first")


def _replace_large(df: DataFrame, table: DataFrame) -> DataFrame:
    ends = stored(_resolved(df, table), "rules")
    whole, double = _whole(F.col("new")), _double(F.col("new"))
    facts = ends.groupBy("column").agg(
        F.bool_or(F.col("new").isNotNull() & double.isNull()).alias("text"),
        F.bool_or(whole.isNull() & ((double != F.floor(double)) | (F.abs(double) >= float(_LONG)))).alias("fraction"),
        F.min(F.coalesce(whole, double.try_cast("long"))).alias("low"),
        F.max(F.coalesce(whole, double.try_cast("long"))).alias("high"),
    )
    types, news = {}, {}
    for r in facts.collect():
        kinds = ["text"] if r["text"] else [0.5] if r["fraction"] else [v for v in (r["low"], r["high"]) if v is not None]
        types[r["column"]] = _widened(df.schema[r["column"]].dataType, kinds)
    cols = [c for c in df.columns if c in types]
    for c in cols:
        if categories_of(df, c) is not None:  # what a column's categories are is part of its schema
            rows = ends.where((F.col("column") == c) & F.col("new").isNotNull()).groupBy("new").agg(F.min("first").alias("first"))
            news[c] = [r["new"] for r in rows.orderBy("first").collect()]
    counted = (
        df.select(*[_cell_key(df, c).alias(c) for c in cols])
        .unpivot([], [col(c) for c in cols], "column", "key")
        .groupBy("column", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hits = counted.join(ends.drop("first"), ["column", "key"]).withColumn("hit", F.lit(True))
    lookups, out = fit_lookups(hits, cols), df
    for i, c in enumerate(cols):
        out = lookups.attach(out, c, _cell_key(df, c), {"new": f"_new{i}", "hit": f"_hit{i}"})

    def replaced(c: str) -> Column:
        if c not in types:
            return col(c)
        i, dtype = cols.index(c), types[c]
        new = F.col(f"_new{i}")
        if is_numeric(df.schema[c].dataType):
            whole, double = _whole(new), _double(new)
            if is_numeric(dtype):
                new = F.coalesce(whole.try_cast(dtype), double.try_cast(dtype))
            else:
                new = F.coalesce(whole.cast("string"), double.cast("string"), new)
        changed = F.when(F.col(f"_hit{i}"), new.cast(dtype)).otherwise(present(df, c).cast(dtype))
        return changed.alias(c, metadata=with_categories(df, c, news.get(c, [])))

    return out.select(*[replaced(c) for c in df.columns])


def replace_report(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """(seq, column, old, new, changed): cells each rule really changes, all counted in one aggregation."""
    made = make_rules(df, rules)
    schema = "seq int, column string, old string, new string, changed long"
    if not made:
        return df.sparkSession.createDataFrame([], schema)
    counts, seen = [], {}
    for rule in made:
        now = seen.setdefault(rule.column, {})
        # original values that have become `old` by the time this rule runs
        starts = [s for s, v in now.items() if v == rule.old]
        if rule.old not in now:
            starts.append(rule.old)
        hits = F.lit(False)
        if rule.new != rule.old:
            for s in starts:
                hits = hits | (
                    present(df, rule.column).isNull()
                    if s is None
                    else F.coalesce(_equals(rule.column, s, df.schema[rule.column].dataType), F.lit(False))
                )
        counts.append(F.count_if(hits))
        for s in starts:
            now[s] = rule.new
    row = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(counts)]).first()

    def text(v):
        return None if v is None else str(v)

    rows = [(i, r.column, text(r.old), text(r.new), row[f"n{i}"]) for i, r in enumerate(made)]
    return df.sparkSession.createDataFrame(rows, schema)
