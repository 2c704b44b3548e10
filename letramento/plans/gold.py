"""Silver -> gold (G1-G9). Each builder is a pure DataFrame function; ``run_gold``
reads silver, builds every table whose inputs exist and writes it partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dims
from ..functions import measures as M
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import windows as W
from ..sources.io import read_optional, write_layer
from ..sources.versions import Version, commit_numbers, current_version, partition_values, read_commit, read_version
from ..sources.schemas import LEVEL_COLUMNS, TARGET_COLUMNS
from .concurrency import DEFAULT_WORKERS, run_all
from .silver import BUCKET, STUDENT_PARTITIONS, STUDENT_TABLE

T, M30, M26 = "taxa_alfabetizacao", "meta_alfabetizacao_2030", "meta_alfabetizacao_2026"
PANORAMA_COLUMNS = ["ano", "rede", T, *TARGET_COLUMNS, "percentual_participacao"]


def panorama(meta_brasil: DataFrame, meta_uf: DataFrame, meta_municipio: DataFrame) -> DataFrame:
    """G1: three grains in one layout with gap, attainment and reached flag for 2030."""
    parts = [C.conform(meta_brasil, "Brasil", F.lit("BR"), F.lit("Brasil"), PANORAMA_COLUMNS),
             C.conform(meta_uf, "UF", F.col("sigla_uf"), F.col("sigla_uf"), PANORAMA_COLUMNS),
             C.conform(meta_municipio, "Municipio", F.col("id_municipio"), F.col("id_municipio"), PANORAMA_COLUMNS)]
    df = C.union_by_name(parts)
    df = (df.withColumn("gap_meta_2030", M.gap(M30, T))
          .withColumn("percentual_atingimento_2030", M.attainment(T, M30, positive_target_only=True))
          .withColumn("meta_atingida_2030", M.reached(T, M30)))
    return C.stamp_layer(df, "gold")


def evolucao(avaliacao_uf: DataFrame) -> DataFrame:
    """Evaluation by state with the proficiency levels present."""
    df = C.select_existing(avaliacao_uf, ["ano", "sigla_uf", "serie", "rede", T, "media_portugues"], LEVEL_COLUMNS)
    return C.stamp_layer(df, "gold")


def ranking(avaliacao_municipio: DataFrame) -> DataFrame:
    """Municipality rank and percentile by rate within (year, state, network)."""
    df = avaliacao_municipio.withColumn("co_uf", dims.state_prefix("id_municipio"))
    df = df.withColumn("sigla_uf", dims.uf_from_code("co_uf"))
    df = C.require_keys(df, [T])
    df = W.rank_within(df, ["ano", "sigla_uf", "rede"], T, descending=True)
    df = df.select("ano", "sigla_uf", "id_municipio", "serie", "rede", T, "media_portugues", "ranking", "percentil")
    return C.stamp_layer(df, "gold")


UF_KEYS = ["nu_ano_avaliacao", "sg_uf", "tp_dependencia"]
MUNICIPALITY_KEYS = ["nu_ano_avaliacao", "sg_uf", "co_municipio", "no_municipio", "tp_dependencia"]


def indicadores_alunos(students: DataFrame) -> DataFrame:
    """Pupil indicators by (year, state, network)."""
    return C.stamp_layer(A.student_indicators(students, UF_KEYS), "gold")


def indicadores_alunos_municipio(students: DataFrame) -> DataFrame:
    """Pupil indicators by municipality."""
    return C.stamp_layer(A.student_indicators(students, MUNICIPALITY_KEYS, with_minmax=False), "gold")


def indicadores_from_states(states: DataFrame) -> dict[str, DataFrame]:
    """G4 and G5 from stored states: the states of a municipality merge to its row, and to the row of its state."""
    return {"indicadores_alunos": C.stamp_layer(A.indicators_of(A.merge_states(states, UF_KEYS), UF_KEYS), "gold"),
            "indicadores_alunos_municipio": C.stamp_layer(
                A.indicators_of(A.merge_states(states, MUNICIPALITY_KEYS), MUNICIPALITY_KEYS, with_minmax=False), "gold")}


def features_ml(meta_municipio: DataFrame) -> DataFrame:
    """Model features per municipality."""
    df = C.require_keys(meta_municipio, [T, M30, "id_municipio"])
    df = (df.withColumn("gap_meta_2030", M.gap(M30, T))
          .withColumn("percentual_atingimento", M.attainment(T, M30))
          .withColumn("distancia_meta_2026", F.when(F.col(M26).isNotNull(), M.gap(M26, T)))
          .withColumn("ja_atingiu_meta", M.reached(T, M30)))
    df = df.select("ano", "id_municipio", "rede", T, *TARGET_COLUMNS, "nivel_alfabetizacao",
                   "percentual_participacao", "gap_meta_2030", "percentual_atingimento", "distancia_meta_2026",
                   "ja_atingiu_meta")
    return C.stamp_layer(df, "gold")


def desigualdade(meta_uf: DataFrame) -> DataFrame:
    """Regional inequality by (year, region, network)."""
    df = C.require_keys(meta_uf, [T]).withColumn("regiao", dims.region_from_uf("sigla_uf"))
    return C.stamp_layer(A.regional_inequality(df, ["ano", "regiao", "rede"], T, M30), "gold")


def criticos(meta_municipio: DataFrame) -> DataFrame:
    """Municipalities with gap, attainment, state, region and criticality class."""
    df = C.require_keys(meta_municipio, [T, M30])
    df = (df.withColumn("gap_meta_2030", M.gap(M30, T))
          .withColumn("percentual_atingimento", M.attainment(T, M30))
          .withColumn("co_uf", dims.state_prefix("id_municipio")))
    df = df.withColumn("sigla_uf", dims.uf_from_code("co_uf"))
    df = df.withColumn("regiao", dims.region_from_uf("sigla_uf"))
    df = df.withColumn("nivel_criticidade", M.criticality("gap_meta_2030"))
    df = df.select("ano", "id_municipio", "sigla_uf", "regiao", "rede", T, M30, "gap_meta_2030",
                   "percentual_atingimento", "nivel_criticidade", "percentual_participacao")
    return C.stamp_layer(df, "gold")


def tendencia(meta_uf: DataFrame, status_order: str = "reference", per_year: bool = False) -> DataFrame:
    """Yearly change, years to target, projected year and status per (state, network).

    The change is against the previous *available* year; ``per_year`` divides it by
    the number of years between the two.
    """
    df = C.require_keys(meta_uf, [T]).select("ano", "sigla_uf", "rede", T, M30)
    df = df.withColumn("_pair", F.struct(F.col(T).alias("t"), F.col("ano").alias("a")))
    df = W.lag_within(df, ["sigla_uf", "rede"], ["ano"], "_pair", "_prev")
    gap = (F.col("ano") - F.col("_prev.a")) if per_year else None
    df = (df.withColumn("variacao_anual", M.yearly_change(T, F.col("_prev.t"), years_between=gap))
          .withColumn("anos_para_meta", M.years_to_target(T, M30, "variacao_anual"))
          .withColumn("ano_projetado_atingimento", M.projected_year("ano", "anos_para_meta")))
    df = df.withColumn("vai_atingir_2030", M.projection_status(T, M30, "ano_projetado_atingimento",
                                                               "variacao_anual", status_order=status_order))
    return C.stamp_layer(df.drop("_pair", "_prev"), "gold")


GOLD_PARTITIONS = {
    "panorama_alfabetizacao": ["ano", "granularidade"], "evolucao_proficiencia": ["ano"],
    "ranking_municipios": ["ano"], "indicadores_alunos": ["nu_ano_avaliacao"],
    "indicadores_alunos_municipio": ["nu_ano_avaliacao"], "features_ml": ["ano"],
    "desigualdade_regional": ["ano"], "municipios_criticos": ["ano"], "tendencia_temporal": ["ano"],
}


def build_gold(spark: SparkSession, silver_root: str, years: Sequence[int] | None = None) -> dict[str, DataFrame]:
    """All gold tables whose silver inputs exist (S5: a missing table skips its dependants).

    With ``years`` only those years are built: the silver reads carry a filter on the
    year partition column, so Spark prunes every other year folder. The trend table
    looks backwards (previous available year), so it reads every year up to the last
    requested one and keeps the requested years afterwards.
    """
    def read(table: str, upto_only: bool = False) -> DataFrame | None:
        df = read_optional(spark, silver_root, table)
        if df is None or years is None:
            return df
        y = F.col("nu_ano_avaliacao" if table == "Ts_aluno" else "ano")
        return df.where(y <= max(years)) if upto_only else df.where(y.isin(list(years)))

    s = {t: read(t) for t in ["Meta_brasil", "Meta_uf", "Meta_municipio", "Avaliacao_uf", "Avaliacao_municipio",
                               "Ts_aluno"]}
    out: dict[str, DataFrame] = {}
    if all(s[t] is not None for t in ["Meta_brasil", "Meta_uf", "Meta_municipio"]):
        out["panorama_alfabetizacao"] = panorama(s["Meta_brasil"], s["Meta_uf"], s["Meta_municipio"])
    if s["Avaliacao_uf"] is not None:
        out["evolucao_proficiencia"] = evolucao(s["Avaliacao_uf"])
    if s["Avaliacao_municipio"] is not None:
        out["ranking_municipios"] = ranking(s["Avaliacao_municipio"])
    if s["Ts_aluno"] is not None:
        out["indicadores_alunos"] = indicadores_alunos(s["Ts_aluno"])
        out["indicadores_alunos_municipio"] = indicadores_alunos_municipio(s["Ts_aluno"])
    if s["Meta_municipio"] is not None:
        out["features_ml"] = features_ml(s["Meta_municipio"])
        out["municipios_criticos"] = criticos(s["Meta_municipio"])
    if s["Meta_uf"] is not None:
        out["desigualdade_regional"] = desigualdade(s["Meta_uf"])
        trend = tendencia(read("Meta_uf", upto_only=True))
        out["tendencia_temporal"] = trend if years is None else trend.where(F.col("ano").isin(list(years)))
    return out


STUDENT_GOLD = {"indicadores_alunos", "indicadores_alunos_municipio"}
#: States of the pupil indicators (``aggregates.indicator_states``), one folder for each folder of silver pupils.
STATES_TABLE = "_estados_alunos"


def _in_years(version: Version, years: Sequence[int] | None) -> Version:
    if years is None:
        return version
    wanted = {str(y) for y in years}
    return replace(version, folders={f: p for f, p in version.folders.items() if partition_values(f)["nu_ano_avaliacao"] in wanted})


def refresh_states(spark: SparkSession, silver_root: str, gold_root: str) -> Version | None:
    """Bring the stored states up to silver pupils; their commit, None if there are no pupils.

    Only silver folders whose files differ from those the states were made of are read, and
    their states replaced. What came late, was replaced or went away is thereby taken back
    and counted anew, exactly. All folders are read where there are no states yet, or where
    the silver commit they were made of has been removed.
    """
    path, states = f"{silver_root.rstrip('/')}/{STUDENT_TABLE}", f"{gold_root.rstrip('/')}/{STATES_TABLE}"
    now, last = current_version(spark, path), current_version(spark, states)
    if now is None:
        return None
    known = last is not None and last.notes["silver"] in commit_numbers(spark, path)
    changed = now.changed_since(read_commit(spark, path, last.notes["silver"]) if known else None)
    if known and not changed:
        return last
    rows = read_version(spark, path, replace(now, folders={f: p for f, p in now.folders.items() if f in changed}))
    write_layer(A.indicator_states(rows, [*MUNICIPALITY_KEYS, BUCKET]), gold_root, STATES_TABLE, STUDENT_PARTITIONS, base=last if known else None,
                replace=[tuple(partition_values(f)[c] for c in STUDENT_PARTITIONS) for f in sorted(changed)] if known else None,
                notes={"silver": now.number})
    return current_version(spark, states)


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, only: set[str] | None = None,
             years: Sequence[int] | None = None, workers: int = DEFAULT_WORKERS, built_from: int | None = None) -> list[str]:
    """Write the gold tables (all, or the names in ``only``), tables concurrently.

    With ``years``, only those year partitions are recomputed and replaced (a year that
    has no rows any more ends up empty); the other years of each table stay as they are.
    The pupil tables' commits note up to which commit of silver ``Ts_aluno`` they hold
    everything. They are merged from the stored states when all years are built or
    ``built_from`` names that commit, and else, for single years, read from silver.
    """
    tables = {n: df for n, df in build_gold(spark, silver_root, years).items() if only is None or n in only}
    if built_from is not None or (years is None and STUDENT_GOLD & tables.keys()):
        states = refresh_states(spark, silver_root, gold_root)
        built_from = states.notes["silver"] if built_from is None else built_from
        stored = indicadores_from_states(read_version(spark, f"{gold_root.rstrip('/')}/{STATES_TABLE}", _in_years(states, years)))
        tables.update({n: df for n, df in stored.items() if only is None or n in only})

    def notes(name: str) -> dict:
        if name not in STUDENT_GOLD:
            return {}
        if built_from is not None or years is None:
            return {"silver": built_from}
        last = current_version(spark, f"{gold_root.rstrip('/')}/{name}")
        return last.notes if last else {}

    def write(name: str, df: DataFrame) -> str:
        parts = GOLD_PARTITIONS[name]
        if name == "municipios_criticos":
            # already range-partitioned and sorted for the write; keep that layout
            write_layer(W.sort_for_write(df, parts, [F.col("gap_meta_2030").desc()]), gold_root, name, parts,
                        rebalance=False, replace=years)
        else:
            write_layer(df, gold_root, name, parts, replace=years, notes=notes(name))
        return name

    return list(run_all({n: (lambda n=n, df=df: write(n, df)) for n, df in tables.items()}, workers).values())


def stale_years(spark: SparkSession, silver_root: str, gold_root: str) -> tuple[list[int] | None, int | None]:
    """Years whose silver pupils changed since the pupil gold tables were built (None: all), and silver's commit.

    Found by comparing the two commits of silver, so a refresh that stopped between silver
    and gold is made up for by the next one.
    """
    path = f"{silver_root.rstrip('/')}/Ts_aluno"
    now = current_version(spark, path)
    if now is None:
        return [], None
    known, years = set(commit_numbers(spark, path)), set()
    for name in STUDENT_GOLD:
        last = current_version(spark, f"{gold_root.rstrip('/')}/{name}")
        done = last.notes.get("silver") if last else None
        if done not in known:
            return None, now.number
        years |= {int(partition_values(f)["nu_ano_avaliacao"]) for f in now.changed_since(read_commit(spark, path, done))}
    return sorted(years), now.number


def refresh_gold_students(spark: SparkSession, silver_root: str, gold_root: str) -> list[str]:
    """ST11, G4, G5: the pupil gold tables brought up to silver.

    Pupils are read from the silver folders that changed, to renew their states; the
    changed years of the tables are then merged from states.
    """
    years, number = stale_years(spark, silver_root, gold_root)
    if years == []:
        return []
    return run_gold(spark, silver_root, gold_root, only=STUDENT_GOLD, years=years, built_from=number)
