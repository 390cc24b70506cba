"""Warehouse constraints as DataFrame checks.

The warehouse declares NOT NULL, primary/unique keys, foreign keys, CHECK
domains and VARCHAR lengths.  Here each is a check that returns the violating
rows (or keys) instead of failing a bulk load, so a load can be gated on
them and the violations kept.  As in SQL, a null passes a CHECK, a foreign
key and a length limit.

All checks are single passes: a filter, a grouped count (combined map-side,
so a hot key does not land whole in one task), or an anti join against the
referenced dimension.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import MANUFACTURERS


def _violated(flags: Mapping[str, Column]) -> Column:
    """Comma-separated names of the flags that are true."""
    return F.concat_ws(",", *[F.when(c, F.lit(name)) for name, c in flags.items()])


def _any(flags: Mapping[str, Column]) -> Column:
    out = F.lit(False)
    for c in flags.values():
        out = out | c
    return out


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a null in any of ``cols``; ``violated`` names them."""
    flags = {c: F.col(c).isNull() for c in cols}
    return df.filter(_any(flags)).withColumn("violated", _violated(flags))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count ``n``.
    Rows with a null key part are not compared (SQL UNIQUE)."""
    keep = F.lit(True)
    for k in keys:
        keep = keep & F.col(k).isNotNull()
    return (
        df.filter(keep)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def check_foreign_key(
    df: DataFrame, cols: Sequence[str], ref: DataFrame, ref_cols: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose (non-null) reference is missing from ``ref``.

    ``ref`` (a dimension) may be hinted for broadcast by the caller after a
    size check; otherwise this is a shuffle anti join.
    """
    ref_cols = list(ref_cols or cols)
    keys = ref.select(*[F.col(r).alias(c) for c, r in zip(cols, ref_cols)]).distinct()
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return df.filter(present).join(keys, list(cols), "left_anti")


def check_domain(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """C4: rows failing any rule (a rule that is null passes, as a CHECK)."""
    flags = {name: ~F.coalesce(rule, F.lit(True)) for name, rule in rules.items()}
    return df.filter(_any(flags)).withColumn("violated", _violated(flags))


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows whose text is longer than the declared VARCHAR length."""
    flags = {c: F.coalesce(F.length(c) > F.lit(n), F.lit(False)) for c, n in limits.items()}
    return df.filter(_any(flags)).withColumn("violated", _violated(flags))


# --- the declared constraints of the six tables ------------------------------------------


@dataclass(frozen=True)
class TableConstraints:
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, str], ...] = ()  # (column, referenced table); same column name there
    domain: Mapping[str, Column] = field(default_factory=dict)
    length: Mapping[str, int] = field(default_factory=dict)


def warehouse_constraints() -> dict[str, TableConstraints]:
    """The constraints the warehouse declares, per table."""
    c = F.col
    return {
        "Aircrafts": TableConstraints(
            not_null=("Aircraft_ID", "Aircraft_Registration_Code"),
            unique=(("Aircraft_ID",), ("Aircraft_Registration_Code",)),
            domain={"Aircraft_Manufacturer_Class_enum": c("Aircraft_Manufacturer_Class").isin(*MANUFACTURERS)},
            length={"Aircraft_Registration_Code": 10, "Manufacturer_Serial_Number": 20, "Aircraft_Model": 50},
        ),
        "Dates": TableConstraints(
            not_null=("Date_ID", "Full_Date", "Day_Num", "Month_Num", "Year"),
            unique=(("Date_ID",), ("Full_Date",), ("Day_Num", "Month_Num", "Year")),
        ),
        "Months": TableConstraints(
            not_null=("Month_ID", "Month_Num", "Year"),
            unique=(("Month_ID",), ("Year", "Month_Num")),
            domain={"Month_Num_1_12": c("Month_Num").between(1, 12)},
        ),
        "Flight_Operations_Daily": TableConstraints(
            not_null=("Date_ID", "Aircraft_ID", "FH", "Takeoffs", "DFC", "CFC", "TDM"),
            unique=(("Date_ID", "Aircraft_ID"),),
            foreign=(("Date_ID", "Dates"), ("Aircraft_ID", "Aircrafts")),
            domain={
                "Takeoffs_ge_0": c("Takeoffs") >= 0,
                "DFC_ge_0": c("DFC") >= 0,
                "CFC_ge_0": c("CFC") >= 0,
                "TDM_ge_0": c("TDM") >= 0,
            },
        ),
        "Aircraft_Monthly_Summary": TableConstraints(
            not_null=("Month_ID", "Aircraft_ID", "ADIS", "ADOSS", "ADOSU"),
            unique=(("Month_ID", "Aircraft_ID"),),
            foreign=(("Month_ID", "Months"), ("Aircraft_ID", "Aircrafts")),
            domain={"ADIS_ge_0": c("ADIS") >= 0, "ADOSS_ge_0": c("ADOSS") >= 0, "ADOSU_ge_0": c("ADOSU") >= 0},
        ),
        "Logbooks": TableConstraints(
            not_null=("Month_ID", "Aircraft_ID", "Airport", "Log_Count"),
            unique=(("Month_ID", "Aircraft_ID", "Airport"),),
            foreign=(("Month_ID", "Months"), ("Aircraft_ID", "Aircrafts")),
            domain={"Log_Count_gt_0": c("Log_Count") > 0},
            length={"Airport": 10},
        ),
    }


def _row_level_counts(table: str, df: DataFrame, cons: TableConstraints) -> DataFrame | None:
    """NOT NULL, CHECK and length violations of one table in one scan: a
    single aggregation of conditional counts, unpivoted into rows."""
    checks: list[tuple[str, str, Column]] = []
    checks += [("not_null", c, F.col(c).isNull()) for c in cons.not_null]
    checks += [("domain", n, ~F.coalesce(rule, F.lit(True))) for n, rule in cons.domain.items()]
    checks += [("length", f"{c}<={n}", F.coalesce(F.length(c) > F.lit(n), F.lit(False))) for c, n in cons.length.items()]
    if not checks:
        return None
    counts = df.agg(
        *[F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"_c{i}") for i, (_, _, bad) in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(kind).alias("kind"),
                F.lit(name).alias("constraint_name"),
                F.col(f"_c{i}").alias("violations"),
            )
            for i, (kind, name, _) in enumerate(checks)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violation counts of every declared constraint over the given tables:
    (table_name, kind, constraint_name, violations), zeros included.

    Row-level checks of a table share one scan; each UNIQUE is one grouped
    count and each FOREIGN KEY one anti join against its dimension.
    """
    parts: list[DataFrame] = []

    def count(table: str, kind: str, name: str, rows: DataFrame) -> None:
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(table).alias("table_name"),
                F.lit(kind).alias("kind"),
                F.lit(name).alias("constraint_name"),
                "violations",
            )
        )

    for table, cons in warehouse_constraints().items():
        if table not in tables:
            continue
        df = tables[table]
        row_level = _row_level_counts(table, df, cons)
        if row_level is not None:
            parts.append(row_level)
        for keys in cons.unique:
            count(table, "unique", "+".join(keys), check_unique(df, keys))
        for col, ref in cons.foreign:
            if ref in tables:
                count(table, "foreign_key", f"{col}->{ref}", check_foreign_key(df, [col], tables[ref]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def named_rows(rows: DataFrame, table: str, names: Column) -> DataFrame:
    """(table_name, kind, constraint_name, row): one per row and element of
    ``names`` (kind, name), the row as JSON."""
    columns = [c for c in rows.columns if c != "violated"]
    return rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"), F.explode(names).alias("v")).select(
        F.lit(table).alias("table_name"), F.col("v.kind").alias("kind"), F.col("v.name").alias("constraint_name"), "row"
    )


def violating_rows(tables: Mapping[str, DataFrame], failed: set[tuple[str, str, str]]) -> DataFrame | None:
    """The rows behind the ``failed`` (table_name, kind, constraint_name) of ``check_tables``.

    NOT NULL, CHECK and length share one scan of a table, in which a row
    names all it breaks; of a UNIQUE all rows of a repeated key are kept, found by
    a semi join with the repeated keys.
    """
    parts: list[DataFrame] = []
    for table, cons in warehouse_constraints().items():
        if table not in tables:
            continue
        df = tables[table]
        flags = [("not_null", c, F.col(c).isNull()) for c in cons.not_null]
        flags += [("domain", n, ~F.coalesce(rule, F.lit(True))) for n, rule in cons.domain.items()]
        flags += [("length", f"{c}<={n}", F.coalesce(F.length(c) > F.lit(n), F.lit(False))) for c, n in cons.length.items()]
        flags = [f for f in flags if (table, f[0], f[1]) in failed]
        if flags:
            named = [F.when(bad, F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"))) for kind, name, bad in flags]
            parts.append(named_rows(df, table, F.array_compact(F.array(*named))))
        for keys in cons.unique:
            name = "+".join(keys)
            if (table, "unique", name) in failed:
                again = df.join(check_unique(df, keys).select(*keys), list(keys), "left_semi").select(*df.columns)
                parts.append(named_rows(again, table, F.array(F.struct(F.lit("unique").alias("kind"), F.lit(name).alias("name")))))
        for col, ref in cons.foreign:
            name = f"{col}->{ref}"
            if ref in tables and (table, "foreign_key", name) in failed:
                lost = check_foreign_key(df, [col], tables[ref]).select(*df.columns)
                parts.append(named_rows(lost, table, F.array(F.struct(F.lit("foreign_key").alias("kind"), F.lit(name).alias("name")))))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out
