"""Data-quality rules Q1-Q8 and the two-sided key difference J2.

Rules for one table are evaluated in **one** aggregate (a ``count_if`` per rule),
instead of one job per rule. Results are a DataFrame with the columns
(tabela, regra, status, detalhe); status is PASSOU or FALHOU.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import column_sum

PASSED, FAILED = "PASSOU", "FALHOU"
RESULT_COLUMNS = ["tabela", "regra", "status", "detalhe"]


@dataclass
class Rule:
    """A row-level rule: ``violation`` is true for a failing row."""
    regra: str
    violation: Column
    unit: str = "fora"
    applies: Column | None = None       # rows the rule looks at; none -> note instead
    empty_note: str | None = None


def check_not_null(cols: Sequence[str]) -> Rule:
    """Q1."""
    bad = None
    for c in cols:
        bad = F.col(c).isNull() if bad is None else bad | F.col(c).isNull()
    return Rule(f"{'/'.join(cols)} não nulos", bad, "nulos")


def check_range(col: str, lo: float, hi: float) -> Rule:
    """Q2: nulls are ignored."""
    c = F.col(col)
    return Rule(f"{col} em [{lo:g}, {hi:g}]", c.isNotNull() & ((c < lo) | (c > hi)), "fora")


def check_monotonic(cols: Sequence[str]) -> list[Rule]:
    """Q4: one rule per adjacent pair a <= b (pairs with a null are skipped)."""
    rules = []
    for a, b in zip(cols, cols[1:]):
        ca, cb = F.col(a), F.col(b)
        rules.append(Rule(f"{a} <= {b}", ca.isNotNull() & cb.isNotNull() & (ca > cb), "violações"))
    return rules


def check_sum(cols: Sequence[str], target: float = 100.0, tol: float = 2.0,
              null_as_zero: bool = False) -> Rule:
    """Q5: family sums to target +- tol on rows where the first member is set."""
    total = column_sum(cols, null_as_zero)
    return Rule(f"soma de {cols[0]}.. = {target:g} ± {tol:g}", F.abs(total - F.lit(target)) > tol, "fora",
                applies=F.col(cols[0]).isNotNull(), empty_note="(sem dados)")


def run_checks(df: DataFrame, table: str, rules: Sequence[Rule], unique_keys: Sequence[str] | None = None) -> DataFrame:
    """Evaluate row rules in a single aggregate and return one result row per rule.

    With ``unique_keys`` the same pass also checks the natural key (Q3): rows are
    grouped by the key with every rule counter carried along (partial aggregation
    before the shuffle), then summed; the table is read once for all its rules.
    That widens every shuffled row by the counters, so for narrow columnar scans the
    default is two passes: a global aggregate (no shuffle) plus ``check_unique``.
    """
    counters = []
    for i, r in enumerate(rules):
        scope = r.applies if r.applies is not None else F.lit(True)
        counters.append((f"_v{i}", scope & r.violation))
        counters.append((f"_n{i}", scope))
    if unique_keys:
        per_key = df.groupBy(*unique_keys).agg(F.count(F.lit(1)).alias("_rows"),
                                               *[F.count_if(c).alias(n) for n, c in counters])
        counts = per_key.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("_t"),
                             F.count(F.lit(1)).alias("_d"),
                             *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n, _ in counters])
    else:
        counts = df.agg(*[F.count_if(c).alias(n) for n, c in counters])
    rows = []
    for i, r in enumerate(rules):
        v, n = F.col(f"_v{i}"), F.col(f"_n{i}")
        detail = F.concat(F.lit("("), v.cast("string"), F.lit(f" {r.unit})"))
        if r.empty_note is not None:
            detail = F.when(n == 0, F.lit(r.empty_note)).otherwise(detail)
        rows.append(F.struct(F.lit(table).alias("tabela"), F.lit(r.regra).alias("regra"),
                             F.when(v == 0, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("status"),
                             detail.alias("detalhe")))
    if unique_keys:
        rows.append(_unique_row(table, unique_keys, F.col("_t"), F.col("_d")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _unique_row(table: str, keys: Sequence[str], total: Column, distinct: Column) -> Column:
    return F.struct(F.lit(table).alias("tabela"), F.lit(f"sem duplicatas ({'+'.join(keys)})").alias("regra"),
                    F.when(total == distinct, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("status"),
                    F.concat(F.lit("("), total.cast("string"), F.lit(" total, "), distinct.cast("string"),
                             F.lit(" distintos)")).alias("detalhe"))


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Q3: total rows vs distinct keys, from one ``groupBy(keys).count()``."""
    return run_checks(df, table, [], unique_keys=keys)


def key_mismatch(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
                 sides: tuple[str, str] = ("esquerda", "direita")) -> DataFrame:
    """Keys present on only one side, as (chave, lado).

    Keys are made distinct on each side first (partial aggregate), so the anti
    joins see each key once per side however skewed the inputs are.
    """
    right_key = right_key or left_key
    a = left.select(F.col(left_key).alias("chave")).where(F.col("chave").isNotNull()).distinct()
    b = right.select(F.col(right_key).alias("chave")).where(F.col("chave").isNotNull()).distinct()
    only_a = a.join(b, "chave", "left_anti").withColumn("lado", F.lit(sides[0]))
    only_b = b.join(a, "chave", "left_anti").withColumn("lado", F.lit(sides[1]))
    return only_a.unionByName(only_b)


def check_keys_match(left: DataFrame, right: DataFrame, table: str, key: str,
                     sides: tuple[str, str] = ("esquerda", "direita")) -> DataFrame:
    """Q6: both-sided key consistency as one result row."""
    mm = key_mismatch(left, right, key, key, sides)
    s = mm.agg(F.count_if(F.col("lado") == sides[0]).alias("a"), F.count_if(F.col("lado") == sides[1]).alias("b"))
    ok = (F.col("a") == 0) & (F.col("b") == 0)
    return s.select(F.lit(table).alias("tabela"), F.lit(f"{key} consistente entre tabelas").alias("regra"),
                    F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("status"),
                    F.concat(F.lit(f"(só {sides[0]}: "), F.col("a").cast("string"),
                             F.lit(f", só {sides[1]}: "), F.col("b").cast("string"), F.lit(")")).alias("detalhe"))


def quality_report(results: DataFrame) -> DataFrame:
    """Q7: totals, share passed and the failed rules (sorted) in one row."""
    failed = F.filter(F.array_sort(F.collect_list(F.when(F.col("status") == FAILED,
                                                         F.concat_ws(" — ", "tabela", "regra")))),
                      lambda x: x.isNotNull())
    out = results.agg(F.count(F.lit(1)).alias("total_regras"),
                      F.count_if(F.col("status") == PASSED).alias("passou"),
                      F.count_if(F.col("status") == FAILED).alias("falhou"),
                      failed.alias("regras_falhas"))
    return out.withColumn("pct_passou", F.round(F.try_divide(F.col("passou") * 100.0, F.col("total_regras")), 2))


def assert_quality(results: DataFrame) -> None:
    """``fail_on="error"``: raise if any rule failed (collects only the failed rows)."""
    bad = results.where(F.col("status") == FAILED).collect()
    if bad:
        lines = "; ".join(f"{r.tabela} — {r.regra} {r.detalhe}" for r in bad)
        raise AssertionError(f"quality rules failed: {lines}")


def reject_reasons(df: DataFrame, rules: Sequence[tuple[str, Column]], ok_label: str = "ok") -> DataFrame:
    """Q8: tag each row with the first rule it fails (rules given in application order)."""
    tag = None
    for name, failing in rules:
        tag = F.when(failing, F.lit(name)) if tag is None else tag.when(failing, F.lit(name))
    return df.withColumn("motivo", tag.otherwise(F.lit(ok_label)))


def reject_counts(df: DataFrame, rules: Sequence[tuple[str, Column]], ok_label: str = "ok") -> DataFrame:
    """Q8: rows per first-failed rule (including the rows that pass)."""
    return reject_reasons(df, rules, ok_label).groupBy("motivo").agg(F.count(F.lit(1)).alias("registros"))
