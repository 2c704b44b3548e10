"""Aggregations A1-A14.

All are ``groupBy().agg()`` with built-in aggregates, so Spark runs a partial
aggregate in every map task before the shuffle: a hot key costs one row per task.
Exact quantiles use value positions (see ``windows.value_positions``); ``percentile``, which
gathers every distinct value of a group in one task, only where all rows fit one slice (A8).
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import literate_flag
from ..functions.numeric import percent, ratio, round_half_even, round_half_up
from .slices import slice_count
from .windows import value_positions


def _wavg(value: str | Column, weight: str | None) -> Column:
    """Plain or weighted mean; the weighted one ignores rows whose value or weight is null."""
    v = F.col(value) if isinstance(value, str) else value
    if weight is None:
        return F.avg(v)
    w = F.when(v.isNotNull(), F.col(weight))
    return F.try_divide(F.sum(v * w), F.sum(w))


def exact_mean(score: str) -> Column:
    """Mean through a decimal sum (nine places): the same whatever the order of the rows, so a tie rounds one way."""
    v = F.col(score).try_cast("decimal(28,9)")  # a value that does not fit (NaN, huge) counts neither above nor below the line
    return F.try_divide(F.sum(v).cast("double"), F.count(v))


def student_indicators(df: DataFrame, keys: Sequence[str], *, present: str = "in_presenca_lp",
                       literate: str = "in_alfabetizado", score: str = "vl_proficiencia_lp",
                       with_minmax: bool = True, scale: int = 2, weight: str | None = None) -> DataFrame:
    """A1/A2: pupils present, literate, mean (min, max) score and literacy rate per key.

    The rate divides by pupils present, also those with a null flag (``sum`` skips it).
    With ``weight`` (e.g. the pupil sample weight) the mean score and the rate are
    weighted; the counts stay plain counts.
    """
    if weight is None:
        return indicators_of(indicator_states(df, keys, present=present, literate=literate, score=score), keys,
                             with_minmax=with_minmax, scale=scale)
    w = F.coalesce(F.col(weight), F.lit(0.0))
    aggs = [F.count(F.lit(1)).alias("total_alunos_avaliados"),
            F.sum(literate).cast("bigint").alias("total_alfabetizados"), _wavg(score, weight).alias("media_proficiencia"),
            F.try_divide(F.sum(F.coalesce(F.col(literate), F.lit(0)) * w), F.sum(w)).alias("_wrate")]
    if with_minmax:
        aggs += [F.min(score).alias("min_proficiencia"), F.max(score).alias("max_proficiencia")]
    out = df.where(F.col(present) == 1).groupBy(*keys).agg(*aggs)
    return (out.withColumn("taxa_alfabetizacao", round_half_up(F.col("_wrate") * 100, scale))
            .withColumn("media_proficiencia", round_half_up("media_proficiencia", scale)).drop("_wrate"))


#: How the columns of a state merge. Counts and decimal sums do so exactly, whatever the order.
STATE_MERGES = {"total_alunos_avaliados": F.sum, "total_alfabetizados": F.sum, "soma": F.sum, "com_nota": F.sum,
                "min_proficiencia": F.min, "max_proficiencia": F.max}


def indicator_states(df: DataFrame, keys: Sequence[str], *, present: str = "in_presenca_lp", literate: str = "in_alfabetizado",
                     score: str = "vl_proficiencia_lp") -> DataFrame:
    """A1/A2 as partial aggregates to store: counts, the score's decimal sum and number, least and greatest score per key.

    States of disjoint rows merge (``merge_states``) to the state of all of them. Least and
    greatest cannot be subtracted, so rows are taken back by replacing the states of the
    unit they came in (a day, a folder): let ``keys`` hold it.
    """
    v = F.col(score).try_cast("decimal(28,9)")
    return df.where(F.col(present) == 1).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_alunos_avaliados"), F.sum(literate).cast("bigint").alias("total_alfabetizados"),
        F.sum(v).alias("soma"), F.count(v).alias("com_nota"), F.min(score).alias("min_proficiencia"), F.max(score).alias("max_proficiencia"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States by ``keys``, some or all of those that ``states`` has."""
    return states.groupBy(*keys).agg(*[merge(c).alias(c) for c, merge in STATE_MERGES.items()])


def indicators_of(states: DataFrame, keys: Sequence[str], with_minmax: bool = True, scale: int = 2) -> DataFrame:
    """The indicators of ``student_indicators`` from one state per key."""
    mean = F.try_divide(F.col("soma").cast("double"), F.col("com_nota"))
    return states.select(
        *keys, "total_alunos_avaliados", "total_alfabetizados", round_half_up(mean, scale).alias("media_proficiencia"),
        *(["min_proficiencia", "max_proficiencia"] if with_minmax else []),
        percent("total_alfabetizados", "total_alunos_avaliados", scale).alias("taxa_alfabetizacao"))


def flag_literacy(df: DataFrame, score: str, out: str = "in_alfabetizado", cutoff: float = 743) -> DataFrame:
    """C11 applied as a column."""
    return df.withColumn(out, literate_flag(score, cutoff))


def regional_inequality(df: DataFrame, keys: Sequence[str], rate: str, target: str,
                        scale: int = 2, weight: str | None = None) -> DataFrame:
    """A3 + C10: rounded mean rate and target, min, max, count; gap of the rounded means.

    Means are unweighted (each state counts once) unless ``weight`` names a column.
    """
    out = df.groupBy(*keys).agg(
        round_half_up(_wavg(rate, weight), scale).alias("media_taxa_alfabetizacao"),
        round_half_up(_wavg(target, weight), scale).alias("media_meta_2030"),
        F.min(rate).alias("min_taxa"), F.max(rate).alias("max_taxa"),
        F.count(F.lit(1)).alias("total_ufs"))
    return (out.withColumn("gap_medio_meta_2030",
                           round_half_up(F.col("media_meta_2030") - F.col("media_taxa_alfabetizacao"), scale))
            .withColumn("amplitude", round_half_up(F.col("max_taxa") - F.col("min_taxa"), scale)))


def rollup_indicators(df: DataFrame, key: Sequence[str], scale: int = 1, weight: str | None = None) -> DataFrame:
    """A4: re-aggregate indicator rows: sums, mean of means (weighted by ``weight``,
    e.g. pupils per row, if given), recomputed rate (half-even)."""
    out = df.groupBy(*key).agg(F.sum("total_alunos_avaliados").alias("total_alunos"),
                               F.sum("total_alfabetizados").alias("total_alfabetizados"),
                               _wavg("media_proficiencia", weight).alias("media_prof"))
    return out.withColumn("taxa", round_half_even(ratio("total_alfabetizados", "total_alunos") * 100, scale))


def label_counts(df: DataFrame, label: str, order: Sequence[str], count_col: str = "n") -> DataFrame:
    """A5: frequency per label, nulls and absent labels dropped, with the label's rank."""
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(label)).cast("int")
    return (df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias(count_col))
            .withColumn("ordem", rank))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` x ``col`` with a fixed column list; missing cells are 0."""
    out = df.where(F.col(row).isNotNull()).groupBy(row).pivot(col, list(values)).count()
    return out.na.fill(0, subset=list(values))


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column], keys: Sequence[str] = (),
                       share_scale: int = 6, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One pass of ``count_if`` per predicate plus its share of all rows in %.

    ``extra`` adds further aggregate expressions to the same pass.
    """
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(p).alias(name) for name, p in predicates.items()]
    aggs += [e.alias(name) for name, e in (extra or {}).items()]
    out = df.groupBy(*keys).agg(*aggs)
    for name in predicates:
        out = out.withColumn(f"pct_{name}", percent(name, "total", share_scale))
    return out


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, slice_rows: int | None = None,
              approx_accuracy: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, per group.

    For probability p with n values, h = (n-1)p; the result interpolates between the
    values at positions floor(h) and ceil(h). Positions come from ``value_positions``,
    so a group is never gathered into one task. Nulls are ignored.

    ``approx_accuracy`` switches to ``percentile_approx`` (one pass, a bounded sketch
    per group and task; rank error about 1/accuracy, no interpolation).
    """
    by = list(by)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    if approx_accuracy is not None:
        q = F.percentile_approx(F.col(value), [float(p) for p in probs], approx_accuracy)
        out = df.groupBy(*by).agg(q.alias("_q"))
        return out.select(*by, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    pos = value_positions(df.where(F.col(value).isNotNull()), by, value, slice_rows=slice_rows)
    last = F.col("_total") - 1
    cols, aggs = [], [F.max("_total").alias("_n")]
    for p, name in zip(probs, names):
        h = last * F.lit(float(p))
        for tag, idx in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            hit = (idx >= F.col("_before")) & (idx < F.col("_before") + F.col("_cnt"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{tag}_{name}"))
        cols.append(name)
    out = pos.groupBy(*by).agg(*aggs)
    for p, name in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        frac = h - F.floor(h)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out = out.withColumn(name, lo + frac * (hi - lo))
    return out.select(*by, *cols)


def quantile_sketches(df: DataFrame, value: str, keys: Sequence[str], size: int = 400) -> DataFrame:
    """A9, approximate and mergeable: one KLL sketch of ``value`` per key, e.g. per group and day.

    Returns ``keys + [esboco]``, a binary column to store. Nulls are ignored. The rank error shrinks with
    ``size``: about 0.7 % of the rows for 400 (99 % confidence), of a merged sketch as well.
    """
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("esboco"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored sketches of several days (or parts) as one per key; no value is read again, and a replaced day is left out by a filter."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("esboco").alias("esboco"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """Number of values and quantiles of each sketch (values of the data, not interpolated; null for a sketch without values)."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    n = F.kll_sketch_get_n_double("esboco")
    found = {name: F.when(n > 0, F.kll_sketch_get_quantile_double("esboco", F.lit(float(p)))) for p, name in zip(probs, names)}
    return sketches.withColumns({"n": n, **found}).drop("esboco")


def describe(df: DataFrame, value: str, by: Sequence[str] = (), scale: int = 6, slice_rows: int | None = None) -> DataFrame:
    """A8 + A9: count, mean, median, sample std, min, max and quartiles of one measure.

    Input of no more rows than one slice holds (counted when the operator is called) is
    one aggregate over one read: its exact ``percentile`` then keeps that many values at
    most. Beyond, the moment statistics and the quantiles are two aggregates; they are
    stacked in long form and pivoted back to one row per group (no join between them).
    """
    by = list(by)
    if slice_count(df, slice_rows)[1] == 1:
        out = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("media"), F.stddev_samp(value).alias("desvio_padrao"),
                                  F.min(value).cast("double").alias("minimo"), F.max(value).cast("double").alias("maximo"),
                                  F.percentile(value, [0.25, 0.5, 0.75]).alias("_q"))
        out = out.select(*by, "n", "media", "desvio_padrao", "minimo", "maximo",
                         *[F.get("_q", F.lit(i)).alias(c) for i, c in enumerate(["q1", "mediana", "q3"])])
        return out.withColumns({c: round_half_up(c, scale) for c in out.columns[len(by) + 1:]})
    names = ["n", "media", "desvio_padrao", "minimo", "maximo", "q1", "mediana", "q3"]
    stats = df.groupBy(*by).agg(F.count(value).cast("double").alias("n"), F.avg(value).alias("media"),
                                F.stddev_samp(value).alias("desvio_padrao"),
                                F.min(value).cast("double").alias("minimo"),
                                F.max(value).cast("double").alias("maximo"))
    q = quantiles(df, value, [0.25, 0.5, 0.75], by, ["q1", "mediana", "q3"], slice_rows)

    def long(frame: DataFrame, cols: Sequence[str]) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("v")) for c in cols]
        return frame.select(*by, F.explode(F.array(*cells)).alias("_c")).select(*by, "_c.stat", "_c.v")

    both = long(stats, names[:5]).unionByName(long(q, names[5:]))
    out = both.groupBy(*by).pivot("stat", names).agg(F.first("v"))
    out = out.withColumn("n", F.coalesce(F.col("n"), F.lit(0.0)).cast("bigint"))
    for c in names[1:]:
        out = out.withColumn(c, round_half_up(c, scale))
    return out


def histogram(df: DataFrame, value: str, bins: int, scale: int = 6) -> DataFrame:
    """A10: equal-width bins over [min, max], last bin closed; empty bins omitted.

    min and max come from a scalar subquery, evaluated once; no join with the data.
    """
    bounds = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    v = F.col(value)
    width = hi - lo
    raw = F.floor((v - lo) / width * F.lit(bins)).cast("int") + 1
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    out = df.where(v.isNotNull()).select(b.alias("bin"), lo.alias("_lo"), hi.alias("_hi"))
    out = out.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"),
                                 F.first("_hi").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return out.select("bin", round_half_up(F.col("_lo") + (F.col("bin") - 1) * step, scale).alias("limite_inferior"),
                      round_half_up(F.col("_lo") + F.col("bin") * step, scale).alias("limite_superior"), "n")


def corr_matrix(df: DataFrame, cols: Sequence[str], scale: int = 6) -> DataFrame:
    """Pairwise Pearson correlations of ``cols`` in one aggregate; long format."""
    pairs = list(itertools.combinations(cols, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                     round_half_up(F.col(f"{a}__{b}"), scale).alias("correlacao")) for a, b in pairs]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def totals(df: DataFrame, count_col: str, positive_col: str, scale: int = 2) -> DataFrame:
    """Grand totals and overall rate."""
    out = df.agg(F.sum(count_col).cast("bigint").alias("total"),
                 F.sum(positive_col).cast("bigint").alias("positivos"))
    return out.withColumn("taxa", percent("positivos", "total", scale))


def class_balance(df: DataFrame, flag: str, scale: int = 2) -> DataFrame:
    """Positives, negatives and share of positives of a 0/1 flag."""
    out = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag) == 1).alias("positivos"))
    return (out.withColumn("negativos", F.col("total") - F.col("positivos"))
            .withColumn("pct_positivos", percent("positivos", "total", scale)))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (one small job per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabela"), "registros")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pace(df: DataFrame, group: Sequence[str], year: str, rate: str, target: float = 80.0,
         horizon: int = 2030, scale: int = 6) -> DataFrame:
    """W4 + C13: first/last rate of a yearly series, mean change, needed change, verdict."""
    out = df.groupBy(*group).agg(F.min_by(rate, year).alias("taxa_inicial"), F.max_by(rate, year).alias("taxa_atual"),
                                 F.max(year).alias("ultimo_ano"), F.count(F.lit(1)).alias("anos_dados"))
    total = F.col("taxa_atual") - F.col("taxa_inicial")
    mean = F.when(F.col("anos_dados") > 1, total / (F.col("anos_dados") - 1)).otherwise(F.lit(0.0))
    gap = F.lit(float(target)) - F.col("taxa_atual")
    left = F.lit(horizon) - F.col("ultimo_ano")
    needed = F.when(left > 0, gap / left).otherwise(F.lit(0.0))
    out = (out.withColumn("crescimento_total", total).withColumn("crescimento_medio", mean)
           .withColumn("gap_atual", gap).withColumn("anos_restantes", left.cast("int"))
           .withColumn("crescimento_necessario", needed))
    out = out.withColumn("vai_atingir", (F.col("crescimento_medio") >= F.col("crescimento_necessario")).cast("int"))
    for c in ["crescimento_total", "crescimento_medio", "gap_atual", "crescimento_necessario"]:
        out = out.withColumn(c, round_half_up(c, scale))
    return out


def best_worst(df: DataFrame, group: Sequence[str], label: str, value: str, gap_col: str | None = None,
               scale: int = 6) -> DataFrame:
    """C14: best and worst label by value (ties -> larger label), spread and gap ratio."""
    key = F.struct(F.col(value), F.col(label))
    low = F.struct(-F.col(value), F.col(label))
    aggs = [F.max_by(label, key).alias("melhor"), F.max(value).alias("valor_melhor"),
            F.max_by(label, low).alias("pior"), F.min(value).alias("valor_pior")]
    if gap_col:
        aggs += [F.max_by(gap_col, key).alias("_gap_melhor"), F.max_by(gap_col, low).alias("_gap_pior")]
    out = df.groupBy(*group).agg(*aggs).withColumn(
        "diferenca", round_half_up(F.col("valor_melhor") - F.col("valor_pior"), scale))
    if gap_col:
        out = out.withColumn("razao_gap", round_half_up(ratio("_gap_pior", "_gap_melhor"), scale)) \
                 .drop("_gap_melhor", "_gap_pior")
    return out
