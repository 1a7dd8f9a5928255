"""Schema constraints as jobs: what violates them, and what to do with it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Rules


class ConstraintViolation(Exception):
    """Raised by ``on_violation="fail"``."""


def conform(
    rows: DataFrame, schema: T.StructType, rules: Rules, on_violation: str = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rows cast to ``schema``, and rows that break a constraint of their own.

    Values are rounded to the scale of their column; one that does not fit
    counts as a violation, as do nulls, values outside a domain and texts that
    are too long. ``rejected`` keeps the values given and lists ``violations``.
    With ``on_violation="fail"`` any violation raises instead.
    """
    marked = mark_violations(rows, schema, rules)
    clean = F.size("violations") == 0
    rejected = marked.filter(~clean)
    if on_violation == "fail" and (sample := rejected.select("violations").first()):
        raise ConstraintViolation(f"rows violate {sample.violations}")
    return fit(marked.filter(clean).drop("violations"), schema), rejected


def mark_violations(rows: DataFrame, schema: T.StructType, rules: Rules) -> DataFrame:
    """Add ``violations``: what each row breaks by itself."""
    found = [_violation(F.col(f.name), f, rules) for f in schema if f.name in rows.columns]
    return rows.withColumn("violations", F.array_compact(F.array(*found)))


def mark_orphans(marked: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Add to ``violations`` where ``column`` has a value that is no key of ``parent``.

    Parent keys are grouped by more than the join needs, so that they are dealt
    out again for the join: only then can Spark split a frequent key.
    """
    key = F.col(parent_column)
    keys = parent.select(key.alias("_key"), F.pmod(F.hash(key), F.lit(7)).alias("_salt")).distinct().select("_key")
    joined = marked.join(keys, F.col(column) == F.col("_key"), "left")
    orphan = F.col(column).isNotNull() & F.col("_key").isNull()
    unknown = F.when(orphan, F.array(F.lit(f"{column}: unknown"))).otherwise(F.array().cast("array<string>"))
    return joined.withColumn("violations", F.concat("violations", unknown)).drop("_key")


def fit(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns that ``schema`` has, keep the others."""
    types = {field.name: field.dataType for field in schema}
    return rows.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in rows.columns])


def _violation(column: Column, field: T.StructField, rules: Rules) -> Column:
    name = field.name
    checks = F.when(F.lit(False), F.lit(""))
    if name in rules.not_null:
        checks = checks.when(column.isNull(), f"{name}: null")
    checks = checks.when(column.isNotNull() & column.try_cast(field.dataType).isNull(), f"{name}: does not fit")
    if name in rules.domain:
        checks = checks.when(~column.isin(rules.domain[name]), f"{name}: not allowed")
    if name in rules.max_length:
        checks = checks.when(F.length(column) > rules.max_length[name], f"{name}: too long")
    return checks


def split_foreign(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> tuple[DataFrame, DataFrame]:
    """``(known, orphans)`` by whether ``column`` is null or a key of ``parent``."""
    keys = parent.select(F.col(parent_column).alias(column))
    orphans = rows.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
    known = rows.join(keys, column, "left_semi").unionByName(rows.filter(F.col(column).isNull()))
    return known, orphans.select(*rows.columns)


def cascade_delete(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The rows of ``child`` that survive deletions in ``parent``."""
    return split_foreign(child, column, parent, parent_column)[0].select(*child.columns)


@dataclass(frozen=True)
class Deletion:
    """What becomes of the rows of a table: ``refused`` ones were to go, but something that stays needs them."""

    kept: DataFrame
    deleted: DataFrame
    refused: DataFrame


def delete_rows(tables: dict[str, DataFrame], rules: dict[str, Rules], table: str, doomed: Column) -> dict[str, Deletion]:
    """Delete the rows of ``table`` for which ``doomed`` holds, as the foreign keys allow, row by row.

    First the keys to delete are followed down the cascading references. A row that a
    restricting reference needs is refused, and so is every row above it, up to
    the row asked for; then what depends on a refused row stays as well. Only distinct keys travel
    between tables, and a table is read by semi joins. References form no cycle.
    """
    children = [
        (child, column, *rules[child].foreign[column], column in rules[child].cascades)
        for child in tables
        for column in rules[child].foreign
        if column in tables[child].columns
    ]
    below = _below(table, children)

    def referring(child: str, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
        keys = parents.select(F.col(parent_column).alias(column)).dropna().distinct()
        return tables[child].join(keys, column, "left_semi").select(*tables[child].columns)

    def followed(root: DataFrame) -> dict[str, DataFrame]:
        going = {table: root}
        for name in below[1:]:
            parts = [referring(c, col, going[p], pc) for c, col, p, pc, cascade in children if c == name and cascade and p in going]
            going[name] = parts[0] if len(parts) == 1 else _distinct_rows(parts)
        return going

    def refused_among(going: dict[str, DataFrame]) -> DataFrame:
        """Rows of ``table`` that are needed, from the lowest tables upwards."""
        refused: dict[str, DataFrame] = {}
        for name in reversed(below):
            rows, needed = going[name], None
            for child, column, parent, parent_column, cascade in children:
                if parent != name or (cascade and child not in refused):
                    continue
                holders = refused[child] if cascade else tables[child]
                keys = holders.select(F.col(column).alias(parent_column)).dropna().distinct()
                found = rows.join(keys, parent_column, "left_semi").select(*rows.columns)
                needed = found if needed is None else _distinct_rows([needed, found])
            refused[name] = rows.limit(0) if needed is None else needed
        return refused[table]

    asked = tables[table].filter(doomed)
    refused = refused_among(followed(asked))
    gone = followed(_without(asked, refused))
    out = {table: Deletion(tables[table].filter(~F.coalesce(doomed, F.lit(False))).unionByName(refused), gone[table], refused)}
    for name in below[1:]:
        kept = tables[name]
        for child, column, parent, parent_column, cascade in children:
            if child == name and cascade and parent in gone:
                keys = gone[parent].select(F.col(parent_column).alias(column)).dropna().distinct()
                kept = kept.join(keys, column, "left_anti").select(*tables[name].columns)
        out[name] = Deletion(kept, gone[name], tables[name].limit(0))
    return out


def _below(table: str, children: list[tuple]) -> list[str]:
    """``table`` and all tables that cascade from it, parents before children."""
    found = [table]
    for name in found:
        for child, _, parent, _, cascade in children:
            if parent == name and cascade:
                if child in found:
                    found.remove(child)
                found.append(child)
    return found


def _distinct_rows(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.distinct()


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows that are not among ``gone``; nulls are equal."""
    other = gone.select(*[F.col(c).alias(f"_{c}") for c in rows.columns]).distinct()
    same = None
    for c in rows.columns:
        equal = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = equal if same is None else same & equal
    return rows.join(other, same, "left_anti")


def audit(tables: dict[str, DataFrame], rules: dict[str, Rules], schemas: dict[str, T.StructType] | None = None) -> DataFrame:
    """Violation counts of stored tables: table_name, kind, target, violations.

    Null, domain, fit and length counts of a table share one pass. Keys are
    counted before they are compared with a parent, so a frequent key is one row.
    """
    parts = []
    for table, df in tables.items():
        rule, schema = rules[table], (schemas or {}).get(table)
        parts.append(_row_counts(table, df, rule, schema))
        parts += [_duplicates(table, df, key) for key in rule.unique if set(key) <= set(df.columns)]
        for column, (parent, parent_column) in rule.foreign.items():
            if parent in tables and column in df.columns:
                parts.append(_orphans(table, df, column, tables[parent], parent_column))
    counted = [part for part in parts if part is not None]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


def _row_counts(table: str, df: DataFrame, rules: Rules, schema: T.StructType | None) -> DataFrame | None:
    tests: dict[tuple[str, str], Column] = {}
    for name in rules.not_null:
        tests["not null", name] = F.col(name).isNull()
    for name, allowed in rules.domain.items():
        tests["domain", name] = ~F.col(name).isin(allowed)
    for name, length in rules.max_length.items():
        tests["length", name] = F.length(name) > length
    for field in schema or []:
        if field.name in df.columns and df.schema[field.name].dataType != field.dataType:
            column = F.col(field.name)
            tests["fit", field.name] = column.isNotNull() & column.try_cast(field.dataType).isNull()
    tests = {key: test for key, test in tests.items() if key[1] in df.columns}
    if not tests:
        return None
    counts = df.agg(*[F.count_if(test).alias(f"{kind}|{name}") for (kind, name), test in tests.items()])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(name).alias("target"),
            F.col(f"`{kind}|{name}`").alias("violations"),
        )
        for kind, name in tests
    ]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _labelled(counted: DataFrame, table: str, kind: str, target: str) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(target).alias("target"), "violations"
    )


def _duplicates(table: str, df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key; as in SQL, keys with a null never collide."""
    copies = df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    surplus = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    return _labelled(surplus, table, "unique", ", ".join(key))


def _orphans(table: str, df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    lost = keys.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")
    return _labelled(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")), table, "foreign", column)
