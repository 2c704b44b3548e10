"""DuckDB SQL twins of the catalogue queries (the correctness oracle).

Rounding works once, on the shortest decimal text of the double, divisions
are guarded with NULLIF, integer casts of doubles use ``trunc`` (DuckDB's cast
rounds), and counts / sums are cast to the types Spark produces.
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def RE(expr: str, n: int) -> str:
    return f"CAST(round_even(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def MEAN(col: str) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(28,9))) AS DOUBLE) / NULLIF(count({col}), 0)"


def PCT(num: str, den: str, n: int = 2) -> str:
    return R(f"CAST({num} AS DOUBLE) / NULLIF({den}, 0) * 100", n)


ROWS = """kpi_rows AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS ano, n.n_name AS uf, r.r_name AS regiao,
         c.c_mktsegment AS rede, (o.o_orderstatus = 'F') AS ok, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

KPI = ROWS + f""",
kpi AS (
  SELECT ano, uf, regiao, rede, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok,
         {PCT("count(*) FILTER (WHERE ok)", "count(*)")} AS taxa, CAST(60 AS DOUBLE) AS meta
  FROM kpi_rows GROUP BY ano, uf, regiao, rede)"""

PUPIL = """pupil AS (
  SELECT event_id AS id_aluno, CAST(year(ts) AS INTEGER) AS ano, CAST(user_id % 25 AS INTEGER) AS co_uf,
         user_id AS co_municipio, 'M' || CAST(user_id AS VARCHAR) AS no_municipio, event_type AS rede,
         CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS presente, value AS score,
         CASE WHEN value IS NULL THEN NULL WHEN value >= 50 THEN 1 ELSE 0 END AS flag
  FROM events)"""

CRIT = KPI + f""",
crit AS (
  SELECT ano, uf, regiao, rede, taxa, meta, {R("meta - taxa", 2)} AS gap_meta,
         {R("taxa / NULLIF(meta, 0) * 100", 2)} AS percentual_atingimento,
         CASE WHEN {R("meta - taxa", 2)} >= 60 THEN 'Crítico' WHEN {R("meta - taxa", 2)} >= 40 THEN 'Muito Alto'
              WHEN {R("meta - taxa", 2)} >= 25 THEN 'Alto' WHEN {R("meta - taxa", 2)} >= 10 THEN 'Moderado'
              ELSE 'Baixo' END AS nivel_criticidade
  FROM kpi WHERE taxa IS NOT NULL AND meta IS NOT NULL)"""

TREND = KPI + f""",
t0 AS (SELECT ano, uf, rede, taxa, meta, lag(taxa) OVER (PARTITION BY uf, rede ORDER BY ano) AS prev
       FROM kpi WHERE taxa IS NOT NULL),
t1 AS (SELECT *, CASE WHEN prev IS NOT NULL THEN {R("taxa - prev", 2)} END AS variacao_anual FROM t0),
t2 AS (SELECT *, CASE WHEN variacao_anual > 0 AND meta IS NOT NULL
                      THEN {R("(meta - taxa) / variacao_anual", 1)} END AS anos_para_meta FROM t1),
t3 AS (SELECT *, CASE WHEN anos_para_meta > 0 THEN CAST(trunc(ano + anos_para_meta) AS INTEGER) END
                 AS ano_projetado_atingimento FROM t2),
trend AS (SELECT ano, uf, rede, taxa, meta, variacao_anual, anos_para_meta, ano_projetado_atingimento,
                 CASE WHEN ano_projetado_atingimento IS NULL THEN 'Sem dados' WHEN taxa >= meta THEN 'Já atingiu'
                      WHEN ano_projetado_atingimento <= 2030 THEN 'Sim' ELSE 'Não no ritmo atual' END AS vai_atingir_2030
          FROM t3)"""

IND_UF = PUPIL + f""",
ind AS (
  SELECT ano, co_uf, rede, count(*) AS total_alunos_avaliados, CAST(sum(flag) AS BIGINT) AS total_alfabetizados,
         {R(MEAN("score"), 2)} AS media_proficiencia, min(score) AS min_proficiencia, max(score) AS max_proficiencia,
         {PCT("sum(flag)", "count(*)")} AS taxa_alfabetizacao
  FROM pupil WHERE presente = 1 GROUP BY ano, co_uf, rede)"""

LEVELS = ROWS + f""",
lv AS (
  SELECT ano, uf,
         {PCT("count(*) FILTER (WHERE o_orderpriority = '1-URGENT')", "count(*)")} AS proporcao_aluno_nivel_0,
         {PCT("count(*) FILTER (WHERE o_orderpriority = '2-HIGH')", "count(*)")} AS proporcao_aluno_nivel_1,
         {PCT("count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM')", "count(*)")} AS proporcao_aluno_nivel_2,
         {PCT("count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED')", "count(*)")} AS proporcao_aluno_nivel_3,
         {PCT("count(*) FILTER (WHERE o_orderpriority = '5-LOW')", "count(*)")} AS proporcao_aluno_nivel_4
  FROM kpi_rows GROUP BY ano, uf)"""

RAW_NET = "[' publica', 'PÚBLICA ', 'Municipal', ' ESTADUAL', 'federal ', 'Privada', '  Outra  ']"
REDE_NAME_CASE = """CASE upper(trim({x})) WHEN 'PUBLICA' THEN 'Publica' WHEN 'PÚBLICA' THEN 'Publica'
  WHEN 'MUNICIPAL' THEN 'Municipal' WHEN 'ESTADUAL' THEN 'Estadual' WHEN 'FEDERAL' THEN 'Federal'
  WHEN 'PRIVADA' THEN 'Privada' ELSE trim({x}) END"""

UF_VALUES = """uf_dim(co_uf, sigla_uf, regiao) AS (VALUES
  (11, 'RO', 'Norte'), (12, 'AC', 'Norte'), (13, 'AM', 'Norte'), (14, 'RR', 'Norte'), (15, 'PA', 'Norte'),
  (16, 'AP', 'Norte'), (17, 'TO', 'Norte'), (21, 'MA', 'Nordeste'), (22, 'PI', 'Nordeste'),
  (23, 'CE', 'Nordeste'), (24, 'RN', 'Nordeste'), (25, 'PB', 'Nordeste'), (26, 'PE', 'Nordeste'),
  (27, 'AL', 'Nordeste'), (28, 'SE', 'Nordeste'), (29, 'BA', 'Nordeste'), (31, 'MG', 'Sudeste'),
  (32, 'ES', 'Sudeste'), (33, 'RJ', 'Sudeste'), (35, 'SP', 'Sudeste'), (41, 'PR', 'Sul'), (42, 'SC', 'Sul'),
  (43, 'RS', 'Sul'), (50, 'MS', 'Centro-Oeste'), (51, 'MT', 'Centro-Oeste'), (52, 'GO', 'Centro-Oeste'),
  (53, 'DF', 'Centro-Oeste'))"""

TYPED_CUST = f"""raw_c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 40 + 1990 AS VARCHAR) END AS ano,
         ' ' || lower(c_mktsegment) || ' ' AS uf,
         {RAW_NET}[CAST(c_custkey % 7 AS INTEGER) + 1] AS rede,
         CAST(CAST(round(CAST(c_acctbal / CAST(90 AS DOUBLE) AS DECIMAL(38,6)), 2) AS DECIMAL(12,2)) AS VARCHAR) AS taxa,
         CAST(c_nationkey % 6 AS VARCHAR) AS tp_dependencia
  FROM customer),
typed_c AS (
  SELECT c_custkey, TRY_CAST(ano AS INTEGER) AS ano, upper(trim(uf)) AS uf, {REDE_NAME_CASE.format(x="rede")} AS rede,
         TRY_CAST(taxa AS DOUBLE) AS taxa, TRY_CAST(tp_dependencia AS INTEGER) AS tp_dependencia
  FROM raw_c)"""


def _describe(by: str | None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return CRIT + f"""
SELECT {g}count(gap_meta) AS n, {R("avg(gap_meta)", 6)} AS media, {R("stddev_samp(gap_meta)", 6)} AS desvio_padrao,
       {R("min(gap_meta)", 6)} AS minimo, {R("max(gap_meta)", 6)} AS maximo,
       {R("quantile_cont(gap_meta, 0.25)", 6)} AS q1, {R("quantile_cont(gap_meta, 0.5)", 6)} AS mediana,
       {R("quantile_cont(gap_meta, 0.75)", 6)} AS q3
FROM crit {grp}"""


def _histogram(cte: str, rel: str, col: str, bins: int) -> str:
    return cte + f""",
b AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {rel}),
h AS (SELECT CASE WHEN hi - lo = 0 THEN 1
                  ELSE least(CAST(floor(({col} - lo) / (hi - lo) * {bins}) AS INTEGER) + 1, {bins}) END AS bin, lo, hi
      FROM {rel}, b WHERE {col} IS NOT NULL)
SELECT bin, {R(f"lo + (bin - 1) * ((hi - lo) / {bins})", 6)} AS limite_inferior,
       {R(f"lo + bin * ((hi - lo) / {bins})", 6)} AS limite_superior, count(*) AS n
FROM h GROUP BY bin, lo, hi"""


def _corr() -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "p_retailprice"]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = ", ".join(f"corr({a}, {b}) AS {a}__{b}" for a, b in pairs)
    body = " UNION ALL ".join(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {R(f'{a}__{b}', 6)} AS correlacao FROM c"
                              for a, b in pairs)
    return f"""WITH c AS (SELECT {aggs} FROM lineitem JOIN part ON l_partkey = p_partkey) {body}"""


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

QUALITY = LEVELS.replace("WITH ", "") + ",\n" + KPI.split(ROWS + ",\n", 1)[1] + """,
kc AS (SELECT count(*) FILTER (WHERE ano IS NULL OR uf IS NULL OR rede IS NULL) AS nn,
              count(*) FILTER (WHERE taxa IS NOT NULL AND (taxa < 0 OR taxa > 100)) AS rg,
              count(*) FILTER (WHERE n_ok IS NOT NULL AND n IS NOT NULL AND n_ok > n) AS m1,
              count(*) FILTER (WHERE taxa IS NOT NULL AND meta IS NOT NULL AND taxa > meta) AS m2 FROM kpi),
ku AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS t, count(*) AS d FROM (SELECT count(*) AS c FROM kpi GROUP BY ano, uf, rede)),
ls AS (SELECT count(*) FILTER (WHERE proporcao_aluno_nivel_0 IS NOT NULL) AS a,
              count(*) FILTER (WHERE proporcao_aluno_nivel_0 IS NOT NULL AND abs(proporcao_aluno_nivel_0 + proporcao_aluno_nivel_1
                  + proporcao_aluno_nivel_2 + proporcao_aluno_nivel_3 + proporcao_aluno_nivel_4 - 100) > 2) AS v FROM lv),
lc AS (SELECT count(*) FILTER (WHERE l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.1)) AS rg,
              count(*) FILTER (WHERE l_orderkey IS NULL) AS nn FROM lineitem),
lu AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS t, count(*) AS d FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)),
ka AS (SELECT DISTINCT o_custkey AS chave FROM orders WHERE o_custkey IS NOT NULL),
kb AS (SELECT DISTINCT c_custkey AS chave FROM customer WHERE c_custkey IS NOT NULL),
km AS (SELECT (SELECT count(*) FROM ka WHERE chave NOT IN (SELECT chave FROM kb)) AS a,
              (SELECT count(*) FROM kb WHERE chave NOT IN (SELECT chave FROM ka)) AS b),
res AS (
  SELECT 'kpi' AS tabela, 'ano/uf/rede não nulos' AS regra, CASE WHEN nn = 0 THEN 'PASSOU' ELSE 'FALHOU' END AS status,
         '(' || CAST(nn AS VARCHAR) || ' nulos)' AS detalhe FROM kc
  UNION ALL SELECT 'kpi', 'taxa em [0, 100]', CASE WHEN rg = 0 THEN 'PASSOU' ELSE 'FALHOU' END, '(' || CAST(rg AS VARCHAR) || ' fora)' FROM kc
  UNION ALL SELECT 'kpi', 'n_ok <= n', CASE WHEN m1 = 0 THEN 'PASSOU' ELSE 'FALHOU' END, '(' || CAST(m1 AS VARCHAR) || ' violações)' FROM kc
  UNION ALL SELECT 'kpi', 'taxa <= meta', CASE WHEN m2 = 0 THEN 'PASSOU' ELSE 'FALHOU' END, '(' || CAST(m2 AS VARCHAR) || ' violações)' FROM kc
  UNION ALL SELECT 'kpi', 'sem duplicatas (ano+uf+rede)', CASE WHEN t = d THEN 'PASSOU' ELSE 'FALHOU' END,
         '(' || CAST(t AS VARCHAR) || ' total, ' || CAST(d AS VARCHAR) || ' distintos)' FROM ku
  UNION ALL SELECT 'niveis', 'soma de proporcao_aluno_nivel_0.. = 100 ± 2', CASE WHEN v = 0 THEN 'PASSOU' ELSE 'FALHOU' END,
         CASE WHEN a = 0 THEN '(sem dados)' ELSE '(' || CAST(v AS VARCHAR) || ' fora)' END FROM ls
  UNION ALL SELECT 'lineitem', 'l_discount em [0, 0.1]', CASE WHEN rg = 0 THEN 'PASSOU' ELSE 'FALHOU' END, '(' || CAST(rg AS VARCHAR) || ' fora)' FROM lc
  UNION ALL SELECT 'lineitem', 'l_orderkey não nulos', CASE WHEN nn = 0 THEN 'PASSOU' ELSE 'FALHOU' END, '(' || CAST(nn AS VARCHAR) || ' nulos)' FROM lc
  UNION ALL SELECT 'lineitem', 'sem duplicatas (l_orderkey+l_linenumber)', CASE WHEN t = d THEN 'PASSOU' ELSE 'FALHOU' END,
         '(' || CAST(t AS VARCHAR) || ' total, ' || CAST(d AS VARCHAR) || ' distintos)' FROM lu
  UNION ALL SELECT 'pedidos vs clientes', 'chave consistente entre tabelas', CASE WHEN a = 0 AND b = 0 THEN 'PASSOU' ELSE 'FALHOU' END,
         '(só pedidos: ' || CAST(a AS VARCHAR) || ', só clientes: ' || CAST(b AS VARCHAR) || ')' FROM km)"""

SQL: dict[str, str] = {
    "gap_attainment": KPI + f"""
SELECT ano, uf, regiao, rede, taxa, meta, {R("meta - taxa", 2)} AS gap_meta,
       {R("taxa / NULLIF(meta, 0) * 100", 2)} AS percentual_atingimento,
       CASE WHEN ano >= 1998 THEN {R("CAST(50 AS DOUBLE) - taxa", 2)} END AS distancia_meta_2026,
       CASE WHEN taxa >= meta THEN 1 ELSE 0 END AS meta_atingida
FROM kpi""",
    "criticality": CRIT + "\nSELECT * FROM crit",
    "criticality_counts": CRIT + """
SELECT nivel_criticidade, count(*) AS n,
       CAST(CASE nivel_criticidade WHEN 'Crítico' THEN 1 WHEN 'Muito Alto' THEN 2 WHEN 'Alto' THEN 3
            WHEN 'Moderado' THEN 4 WHEN 'Baixo' THEN 5 END AS INTEGER) AS ordem
FROM crit WHERE nivel_criticidade IS NOT NULL GROUP BY nivel_criticidade""",
    "rate_band": KPI + """,
fb AS (SELECT CASE WHEN taxa IS NULL THEN NULL WHEN taxa >= 80 THEN '>=80' WHEN taxa >= 65 THEN '65-80'
                   WHEN taxa >= 50 THEN '50-65' ELSE '<50' END AS faixa FROM kpi)
SELECT faixa, count(*) AS n,
       CAST(CASE faixa WHEN '<50' THEN 1 WHEN '50-65' THEN 2 WHEN '65-80' THEN 3 WHEN '>=80' THEN 4 END AS INTEGER) AS ordem
FROM fb WHERE faixa IS NOT NULL GROUP BY faixa""",
    "rank_within_group": KPI + f"""
SELECT ano, regiao, rede, uf, taxa,
       CAST(rank() OVER (PARTITION BY ano, regiao, rede ORDER BY taxa DESC) AS INTEGER) AS ranking,
       {R("percent_rank() OVER (PARTITION BY ano, regiao, rede ORDER BY taxa DESC) * 100", 2)} AS percentil
FROM kpi WHERE taxa IS NOT NULL""",
    "rank_by_text": f"""
SELECT event_id, event_type, props, CAST(rank() OVER w AS INTEGER) AS ranking, {R("percent_rank() OVER w * 100", 2)} AS percentil
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY props NULLS FIRST)""",
    "lag_by_text": """
SELECT event_id, props, "value", lag("value") OVER (ORDER BY props NULLS FIRST, event_id NULLS FIRST) AS valor_anterior FROM events""",
    "sliced_quantiles": f"""
SELECT event_type, count("value") AS n, {R('avg("value")', 6)} AS media, {R('stddev_samp("value")', 6)} AS desvio_padrao,
       {R('min("value")', 6)} AS minimo, {R('max("value")', 6)} AS maximo, {R('quantile_cont("value", 0.25)', 6)} AS q1,
       {R('quantile_cont("value", 0.5)', 6)} AS mediana, {R('quantile_cont("value", 0.75)', 6)} AS q3
FROM events GROUP BY event_type""",
    "merged_sketches": """
SELECT event_type, count("value") AS n, TRUE AS q25_no_limite, TRUE AS mediana_no_limite, TRUE AS q95_no_limite FROM events GROUP BY event_type""",
    "yearly_trend": TREND + "\nSELECT * FROM trend",
    "top_changes": TREND + """
SELECT ano, uf, rede, variacao_anual, vai_atingir_2030 FROM trend WHERE variacao_anual IS NOT NULL
ORDER BY variacao_anual DESC, ano DESC, uf, rede LIMIT 3""",
    "regressions": TREND + "\nSELECT ano, uf, rede, variacao_anual FROM trend WHERE variacao_anual < 0",
    "first_last_pace": KPI + f""",
s AS (SELECT rede, ano, {R("avg(taxa)", 2)} AS taxa FROM kpi GROUP BY rede, ano),
f AS (SELECT rede, arg_min(taxa, ano) AS taxa_inicial, arg_max(taxa, ano) AS taxa_atual, max(ano) AS ultimo_ano,
             count(*) AS anos_dados FROM s GROUP BY rede),
g AS (SELECT *, taxa_atual - taxa_inicial AS ct,
             CASE WHEN anos_dados > 1 THEN (taxa_atual - taxa_inicial) / (anos_dados - 1) ELSE CAST(0 AS DOUBLE) END AS cm,
             CAST(80 AS DOUBLE) - taxa_atual AS ga, 2030 - ultimo_ano AS ar FROM f),
h AS (SELECT *, CASE WHEN ar > 0 THEN ga / ar ELSE CAST(0 AS DOUBLE) END AS cn FROM g)
SELECT rede, taxa_inicial, taxa_atual, ultimo_ano, anos_dados, {R("ct", 6)} AS crescimento_total,
       {R("cm", 6)} AS crescimento_medio, {R("ga", 6)} AS gap_atual, CAST(ar AS INTEGER) AS anos_restantes,
       {R("cn", 6)} AS crescimento_necessario, CASE WHEN cm >= cn THEN 1 ELSE 0 END AS vai_atingir
FROM h""",
    "student_indicators_uf": IND_UF + "\nSELECT * FROM ind",
    "student_indicators_fine": PUPIL + f"""
SELECT ano, co_uf, co_municipio, no_municipio, rede, count(*) AS total_alunos_avaliados,
       CAST(sum(flag) AS BIGINT) AS total_alfabetizados, {R(MEAN("score"), 2)} AS media_proficiencia,
       {PCT("sum(flag)", "count(*)")} AS taxa_alfabetizacao
FROM pupil WHERE presente = 1 GROUP BY ano, co_uf, co_municipio, no_municipio, rede""",
    "indicator_rollup": IND_UF + f"""
SELECT co_uf, CAST(sum(total_alunos_avaliados) AS BIGINT) AS total_alunos,
       CAST(sum(total_alfabetizados) AS BIGINT) AS total_alfabetizados, {R("avg(media_proficiencia)", 6)} AS media_prof,
       {RE("CAST(sum(total_alfabetizados) AS DOUBLE) / NULLIF(sum(total_alunos_avaliados), 0) * 100", 1)} AS taxa
FROM ind GROUP BY co_uf""",
    "totals": IND_UF + f"""
SELECT CAST(sum(total_alunos_avaliados) AS BIGINT) AS total, CAST(sum(total_alfabetizados) AS BIGINT) AS positivos,
       {PCT("sum(total_alfabetizados)", "sum(total_alunos_avaliados)")} AS taxa FROM ind""",
    "regional_inequality": KPI + f""",
ri AS (SELECT ano, regiao, rede, {R("avg(taxa)", 2)} AS media_taxa_alfabetizacao, {R("avg(meta)", 2)} AS media_meta_2030,
              min(taxa) AS min_taxa, max(taxa) AS max_taxa, count(*) AS total_ufs
       FROM kpi WHERE taxa IS NOT NULL GROUP BY ano, regiao, rede)
SELECT *, {R("media_meta_2030 - media_taxa_alfabetizacao", 2)} AS gap_medio_meta_2030,
       {R("max_taxa - min_taxa", 2)} AS amplitude FROM ri""",
    "best_worst_spread": KPI + f""",
b AS (SELECT ano, regiao, {R("avg(taxa)", 2)} AS media, {R("avg(meta) - avg(taxa)", 2)} AS gap FROM kpi GROUP BY ano, regiao),
w AS (SELECT ano, first(regiao ORDER BY media DESC, regiao DESC) AS melhor, max(media) AS valor_melhor,
             first(regiao ORDER BY media ASC, regiao DESC) AS pior, min(media) AS valor_pior,
             first(gap ORDER BY media DESC, regiao DESC) AS gm, first(gap ORDER BY media ASC, regiao DESC) AS gp
      FROM b GROUP BY ano)
SELECT ano, melhor, valor_melhor, pior, valor_pior, {R("valor_melhor - valor_pior", 6)} AS diferenca,
       {R("gp / NULLIF(gm, 0)", 6)} AS razao_gap FROM w""",
    "crosstab_region_level": CRIT + """
SELECT regiao, count(*) FILTER (WHERE nivel_criticidade = 'Crítico') AS "Crítico",
       count(*) FILTER (WHERE nivel_criticidade = 'Muito Alto') AS "Muito Alto",
       count(*) FILTER (WHERE nivel_criticidade = 'Alto') AS "Alto",
       count(*) FILTER (WHERE nivel_criticidade = 'Moderado') AS "Moderado",
       count(*) FILTER (WHERE nivel_criticidade = 'Baixo') AS "Baixo"
FROM crit WHERE regiao IS NOT NULL GROUP BY regiao""",
    "conditional_shares": CRIT + f""",
cc AS (SELECT regiao, count(*) AS total, count(*) FILTER (WHERE taxa < 20) AS taxa_lt_20,
              count(*) FILTER (WHERE taxa < 50) AS taxa_lt_50, count(*) FILTER (WHERE taxa >= 80) AS taxa_ge_80,
              count(*) FILTER (WHERE gap_meta > 50) AS gap_gt_50, count(*) FILTER (WHERE gap_meta < 10) AS gap_lt_10,
              {R("avg(gap_meta) / 6", 6)} AS ritmo_necessario
       FROM crit GROUP BY regiao)
SELECT *, {PCT("taxa_lt_20", "total", 6)} AS pct_taxa_lt_20, {PCT("taxa_lt_50", "total", 6)} AS pct_taxa_lt_50,
       {PCT("taxa_ge_80", "total", 6)} AS pct_taxa_ge_80, {PCT("gap_gt_50", "total", 6)} AS pct_gap_gt_50,
       {PCT("gap_lt_10", "total", 6)} AS pct_gap_lt_10 FROM cc""",
    "describe_quantiles": _describe(None),
    "describe_by_region": _describe("regiao"),
    "histogram30": _histogram(KPI, "kpi", "taxa", 30),
    "histogram12": _histogram("WITH " + PUPIL, "pupil", "score", 12),
    "corr_matrix": _corr(),
    "class_balance": KPI + """,
f AS (SELECT CASE WHEN taxa >= meta THEN 1 ELSE 0 END AS meta_atingida FROM kpi)
SELECT count(*) AS total, count(*) FILTER (WHERE meta_atingida = 1) AS positivos,
       count(*) - count(*) FILTER (WHERE meta_atingida = 1) AS negativos,
       """ + PCT("count(*) FILTER (WHERE meta_atingida = 1)", "count(*)") + " AS pct_positivos FROM f",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS registros FROM {t}" for t in TABLES),
    "conform_union": ROWS + f""",
g0 AS (SELECT ano, rede, count(*) AS n, count(*) FILTER (WHERE ok) AS k FROM kpi_rows GROUP BY ano, rede),
g1 AS (SELECT ano, regiao, rede, count(*) AS n, count(*) FILTER (WHERE ok) AS k FROM kpi_rows GROUP BY ano, regiao, rede),
g2 AS (SELECT ano, uf, rede, count(*) AS n, count(*) FILTER (WHERE ok) AS k FROM kpi_rows GROUP BY ano, uf, rede),
u AS (SELECT ano, 'Mundo' AS granularidade, 'ALL' AS codigo, 'Mundo' AS nome, rede, {PCT("k", "n")} AS taxa_alfabetizacao FROM g0
      UNION ALL SELECT ano, 'Regiao', regiao, regiao, rede, {PCT("k", "n")} FROM g1
      UNION ALL SELECT ano, 'Nacao', uf, uf, rede, {PCT("k", "n")} FROM g2)
SELECT ano, granularidade, codigo, nome, rede, taxa_alfabetizacao, CAST(60 AS DOUBLE) AS meta_alfabetizacao_2030,
       {R("60 - taxa_alfabetizacao", 2)} AS gap_meta_2030,
       CASE WHEN 60 > 0 THEN {R("taxa_alfabetizacao / 60 * 100", 2)} END AS percentual_atingimento_2030,
       CASE WHEN taxa_alfabetizacao >= 60 THEN 1 ELSE 0 END AS meta_atingida_2030
FROM u""",
    "canonicalise": f"""
WITH o AS (SELECT o_orderkey, {RAW_NET}[CAST(o_orderkey % 7 AS INTEGER) + 1] AS rede_bruta FROM orders)
SELECT o_orderkey, rede_bruta, {REDE_NAME_CASE.format(x="rede_bruta")} AS rede FROM o""",
    "canonicalise_code": """
WITH o AS (SELECT o_orderkey, CAST(o_orderkey % 7 AS INTEGER) AS codigo FROM orders)
SELECT o_orderkey, codigo, CASE CAST(codigo AS VARCHAR) WHEN '2' THEN 'Estadual' WHEN '3' THEN 'Municipal'
       WHEN '5' THEN 'Publica' WHEN '0' THEN 'Total' ELSE CAST(codigo AS VARCHAR) END AS rede FROM o""",
    "prefix_lookup": "WITH " + UF_VALUES + """,
c AS (SELECT c_custkey, (c_custkey % 45 + 10) * 100000 + c_custkey % 100000 AS id_municipio FROM customer),
p AS (SELECT *, TRY_CAST(substr(CAST(id_municipio AS VARCHAR), 1, 2) AS INTEGER) AS co_uf FROM c)
SELECT p.c_custkey, p.id_municipio, p.co_uf, d.sigla_uf, d.regiao FROM p LEFT JOIN uf_dim d ON p.co_uf = d.co_uf""",
    "clean_keys_ranges": "WITH " + TYPED_CUST + """
SELECT c_custkey, ano, uf, rede, taxa, tp_dependencia FROM typed_c
WHERE ano IS NOT NULL AND uf IS NOT NULL AND rede IS NOT NULL AND (taxa IS NULL OR taxa BETWEEN 0 AND 100)
  AND tp_dependencia IN (1, 2, 3, 4)""",
    "reject_counts": "WITH " + TYPED_CUST + """,
m AS (SELECT CASE WHEN ano IS NULL OR uf IS NULL OR rede IS NULL THEN 'chave_nula'
                  WHEN taxa IS NOT NULL AND NOT (taxa BETWEEN 0 AND 100) THEN 'fora_do_intervalo'
                  WHEN NOT coalesce(tp_dependencia IN (1, 2, 3, 4), false) THEN 'fora_do_dominio'
                  ELSE 'ok' END AS motivo FROM typed_c)
SELECT motivo, count(*) AS registros FROM m GROUP BY motivo""",
    "dedup_latest": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
             l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
             l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "slice_with_fallback": KPI + """
SELECT ano, uf, regiao, rede, n, taxa FROM kpi
WHERE ano = (SELECT CASE WHEN bool_or(ano = 2030) THEN 2030 ELSE 2001 END FROM kpi)""",
    "assign_day": """
WITH e AS (SELECT event_id,
                  CASE WHEN event_type IN ('view', 'click') THEN 'base_dos_dados' WHEN event_type = 'error' THEN NULL
                       ELSE 'kinesis_streaming' END AS _fonte,
                  CASE WHEN event_type = 'signup' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS data_ingestao FROM events)
SELECT event_id, _fonte, coalesce(CASE WHEN _fonte = 'base_dos_dados' THEN '2026-07-09' ELSE data_ingestao END,
                                  'data_desconhecida') AS data_ingestao FROM e""",
    "level_distribution": LEVELS + f"""
SELECT *, {R("proporcao_aluno_nivel_0 + proporcao_aluno_nivel_1 + proporcao_aluno_nivel_2 + proporcao_aluno_nivel_3 + proporcao_aluno_nivel_4", 2)} AS soma_niveis,
       CASE WHEN abs({R("proporcao_aluno_nivel_0 + proporcao_aluno_nivel_1 + proporcao_aluno_nivel_2 + proporcao_aluno_nivel_3 + proporcao_aluno_nivel_4", 2)} - 100) <= 2 THEN 1 ELSE 0 END AS dentro_tolerancia
FROM lv""",
    "key_mismatch": """
WITH a AS (SELECT DISTINCT o_custkey AS chave FROM orders WHERE o_custkey IS NOT NULL),
     b AS (SELECT DISTINCT c_custkey AS chave FROM customer WHERE c_custkey IS NOT NULL)
SELECT chave, 'pedidos' AS lado FROM a WHERE chave NOT IN (SELECT chave FROM b)
UNION ALL SELECT chave, 'clientes' FROM b WHERE chave NOT IN (SELECT chave FROM a)""",
    "quality_report": QUALITY + "\nSELECT * FROM res",
    "quality_summary": QUALITY + """
SELECT count(*) AS total_regras, count(*) FILTER (WHERE status = 'PASSOU') AS passou,
       count(*) FILTER (WHERE status = 'FALHOU') AS falhou,
       coalesce(string_agg(CASE WHEN status = 'FALHOU' THEN tabela || ' — ' || regra END, '; '
                           ORDER BY CASE WHEN status = 'FALHOU' THEN tabela || ' — ' || regra END), '') AS regras_falhas,
       round(CAST(count(*) FILTER (WHERE status = 'PASSOU') AS DOUBLE) * 100 / count(*), 2) AS pct_passou
FROM res""",
}


UF_CODE_LIST = "[11, 12, 13, 14, 15, 16, 17, 21, 22, 23, 24, 25, 26, 27, 28, 29, 31, 32, 33, 35, 41, 42, 43, 50, 51, 52, 53]"

EVENTS = "WITH " + UF_VALUES + f""",
ev AS (SELECT *, json_extract_string(props, '$.k') AS k, event_type <> 'error' AS present,
              {UF_CODE_LIST}[CAST(user_id % 27 AS INTEGER) + 1] AS code FROM events),
sc AS (SELECT ev.*, d.sigla_uf AS sigla,
              CASE WHEN present THEN {R("CAST(400 AS DOUBLE) + value * CAST(1.5 AS DOUBLE)", 2)} END AS score
       FROM ev LEFT JOIN uf_dim d ON ev.code = d.co_uf)"""

_BLOCKS = ",\n".join(
    f"""CASE WHEN present THEN CAST((event_id + {b}) % 30 + 1 AS INTEGER) END AS co_bloco_{b},
       CASE WHEN present THEN upper(substr(sha256(CAST(event_id AS VARCHAR)), 1, 9)) END AS tx_resposta_bloco_{b},
       CASE WHEN present THEN 'ABCDEABCD' END AS tx_gabarito_bloco_{b}""" for b in range(1, 5))

STUDENT_RECORD = EVENTS + f"""
SELECT CAST(year(ts) AS INTEGER) AS nu_ano_avaliacao, CAST(code AS INTEGER) AS co_uf, ' ' || lower(sigla) AS sg_uf,
       event_id AS id_aluno, 2 AS tp_serie, user_id * 10 + 1 AS id_escola, CAST(event_id % 5 AS INTEGER) AS tp_dependencia,
       CAST(code * 100000 + user_id AS INTEGER) AS co_municipio,
       CASE WHEN event_type = 'signup' THEN NULL ELSE 'Cidade ' || CAST(user_id AS VARCHAR) END AS no_municipio,
       CASE WHEN present THEN 1 ELSE 0 END AS in_presenca_lp, CASE WHEN present THEN 1 ELSE 0 END AS in_preenchimento_lp,
       CASE WHEN present THEN CAST(TRY_CAST(k AS INTEGER) % 24 + 1 AS INTEGER) END AS co_caderno_lp,
       {_BLOCKS},
       CASE WHEN present THEN CAST(1.2 AS DOUBLE) END AS vl_peso_aluno_lp, score AS vl_proficiencia_lp,
       CASE WHEN score IS NOT NULL THEN CASE WHEN score >= 743 THEN 1 ELSE 0 END END AS in_alfabetizado,
       'kinesis_streaming' AS _fonte, 'stream_kinesis' AS _arquivo_original
FROM sc WHERE coalesce(k, '') NOT IN ('0', '1')"""

SQL["sql_criticality"] = CRIT + "\nSELECT * FROM crit"
SQL["stream_decode"] = STUDENT_RECORD
SQL["stream_ingest"] = STUDENT_RECORD
SQL["stream_metrics"] = EVENTS + """
SELECT count(*) AS registros, count(*) FILTER (WHERE coalesce(k, '') IN ('0', '1')) AS rejeitados,
       CAST(count(*) FILTER (WHERE coalesce(k, '') IN ('0', '1')) AS DOUBLE) / count(*) AS taxa_erro,
       CAST(count(*) FILTER (WHERE coalesce(k, '') IN ('0', '1')) AS DOUBLE) / count(*) > 0.05 AS acima_limite
FROM sc"""


# --- gold tables: the silver layer rebuilt from the same extracts ---------------------------

def _targets(base: str) -> str:
    cols = []
    for y in range(2024, 2031):
        v = R(f"{base} + CAST({2 * (y - 2024)} AS DOUBLE)", 2)
        if y == 2026:
            v = f"CASE WHEN ano > 1995 THEN {v} END"
        cols.append(f"{v} AS meta_alfabetizacao_{y}")
    return ", ".join(cols)


_LEVELS = ", ".join(f"count(*) FILTER (WHERE nivel = {i}) AS l{i}" for i in range(9))
_LEVEL_PCT = ", ".join(f"{PCT(f'l{i}', 'n')} AS proporcao_aluno_nivel_{i}" for i in range(9))
_AGG = f"count(*) AS n, count(*) FILTER (WHERE ok) AS k, count(*) FILTER (WHERE part) AS p, avg(nota) AS nota, {_LEVELS}"
_REDE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Publica' WHEN 'BUILDING' THEN 'Municipal'
  WHEN 'FURNITURE' THEN 'Estadual' WHEN 'HOUSEHOLD' THEN 'Federal' WHEN 'MACHINERY' THEN 'Privada' END"""
_REDE_CODE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Estadual' WHEN 'BUILDING' THEN 'Municipal'
  WHEN 'FURNITURE' THEN 'Publica' WHEN 'HOUSEHOLD' THEN 'Total' WHEN 'MACHINERY' THEN '9' END"""

SILVER = "WITH " + UF_VALUES + f""",
facts0 AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS ano, o.o_orderstatus = 'F' AS ok,
         o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS part,
         CAST(least(floor(o.o_totalprice / 60000), 8) AS INTEGER) AS nivel, o.o_totalprice / 1000 AS nota,
         c.c_mktsegment, c.c_custkey, {UF_CODE_LIST}[CAST(c.c_nationkey % 27 AS INTEGER) + 1] AS co_uf
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
facts AS (SELECT f.*, d.sigla_uf AS sigla, CAST(f.co_uf * 100000 + f.c_custkey % 100000 AS INTEGER) AS id_municipio
          FROM facts0 f LEFT JOIN uf_dim d ON f.co_uf = d.co_uf),
g_br AS (SELECT ano, c_mktsegment, {_AGG} FROM facts GROUP BY ano, c_mktsegment),
g_uf AS (SELECT ano, sigla, c_mktsegment, {_AGG} FROM facts GROUP BY ano, sigla, c_mktsegment),
g_mu AS (SELECT ano, id_municipio, c_mktsegment, {_AGG} FROM facts GROUP BY ano, id_municipio, c_mktsegment),
s_meta_brasil AS (
  SELECT ano, {_REDE} AS rede, {PCT("k", "n")} AS taxa_alfabetizacao, {_targets("CAST(50 AS DOUBLE)")},
         {PCT("p", "n")} AS percentual_participacao FROM g_br),
s_meta_uf AS (
  SELECT ano, sigla AS sigla_uf, {_REDE} AS rede, {PCT("k", "n")} AS taxa_alfabetizacao,
         {_targets("CAST(50 AS DOUBLE) + length(sigla)")}, {PCT("p", "n")} AS percentual_participacao FROM g_uf),
s_meta_municipio AS (
  SELECT * FROM (
    SELECT ano, id_municipio, {_REDE} AS rede,
           CASE WHEN id_municipio % 97 = 0 THEN CAST(150 AS DOUBLE) ELSE {PCT("k", "n")} END AS taxa_alfabetizacao,
           {_targets("CAST(50 AS DOUBLE) + id_municipio % 7")},
           CAST(least(floor({PCT("k", "n")} / 20) + 1, 5) AS INTEGER) AS nivel_alfabetizacao,
           {PCT("p", "n")} AS percentual_participacao FROM g_mu)
  WHERE taxa_alfabetizacao IS NULL OR taxa_alfabetizacao BETWEEN 0 AND 100),
s_avaliacao_uf AS (
  SELECT ano, sigla AS sigla_uf, 2 AS serie, {_REDE_CODE} AS rede, {PCT("k", "n")} AS taxa_alfabetizacao,
         {R("nota", 2)} AS media_portugues, {_LEVEL_PCT} FROM g_uf),
s_avaliacao_municipio AS (
  SELECT ano, id_municipio, 2 AS serie, {_REDE_CODE} AS rede, {PCT("k", "n")} AS taxa_alfabetizacao,
         {R("nota", 2)} AS media_portugues, {_LEVEL_PCT} FROM g_mu),
pev AS (SELECT *, json_extract_string(props, '$.k') AS k, event_type <> 'error' AS present,
               {UF_CODE_LIST}[CAST(user_id % 27 AS INTEGER) + 1] AS code FROM events),
s_students AS (
  SELECT CAST(year(ts) AS INTEGER) AS nu_ano_avaliacao, d.sigla_uf AS sg_uf, event_id AS id_aluno,
         CAST(event_id % 5 AS INTEGER) AS tp_dependencia, CAST(code * 100000 + user_id AS INTEGER) AS co_municipio,
         CASE WHEN event_type = 'signup' THEN NULL ELSE 'Cidade ' || CAST(user_id AS VARCHAR) END AS no_municipio,
         CASE WHEN present THEN 1 ELSE 0 END AS in_presenca_lp,
         CASE WHEN present THEN {R("CAST(400 AS DOUBLE) + value * CAST(1.5 AS DOUBLE)", 2)} END AS vl_proficiencia_lp
  FROM pev LEFT JOIN uf_dim d ON pev.code = d.co_uf),
s_students_ok AS (
  SELECT *, CASE WHEN vl_proficiencia_lp IS NOT NULL THEN CASE WHEN vl_proficiencia_lp >= 743 THEN 1 ELSE 0 END END
              AS in_alfabetizado
  FROM s_students WHERE tp_dependencia IN (1, 2, 3, 4)
    AND (vl_proficiencia_lp IS NULL OR vl_proficiencia_lp BETWEEN 400 AND 1000)),
uf_prefix AS (SELECT m.*, d.sigla_uf AS m_sigla, d.regiao AS m_regiao
              FROM s_meta_municipio m LEFT JOIN uf_dim d
              ON TRY_CAST(substr(CAST(m.id_municipio AS VARCHAR), 1, 2) AS INTEGER) = d.co_uf)"""

_M = ", ".join(f"meta_alfabetizacao_{y}" for y in range(2024, 2031))
_CRIT_CASE = """CASE WHEN g >= 60 THEN 'Crítico' WHEN g >= 40 THEN 'Muito Alto' WHEN g >= 25 THEN 'Alto'
  WHEN g >= 10 THEN 'Moderado' ELSE 'Baixo' END"""

SQL["gold_panorama_alfabetizacao"] = SILVER + f""",
u AS (SELECT ano, 'Brasil' AS granularidade, 'BR' AS codigo, 'Brasil' AS nome, rede, taxa_alfabetizacao, {_M}, percentual_participacao FROM s_meta_brasil
      UNION ALL SELECT ano, 'UF', sigla_uf, sigla_uf, rede, taxa_alfabetizacao, {_M}, percentual_participacao FROM s_meta_uf
      UNION ALL SELECT ano, 'Municipio', CAST(id_municipio AS VARCHAR), CAST(id_municipio AS VARCHAR), rede,
                       taxa_alfabetizacao, {_M}, percentual_participacao FROM s_meta_municipio)
SELECT *, {R("meta_alfabetizacao_2030 - taxa_alfabetizacao", 2)} AS gap_meta_2030,
       CASE WHEN meta_alfabetizacao_2030 > 0 THEN {R("taxa_alfabetizacao / NULLIF(meta_alfabetizacao_2030, 0) * 100", 2)} END
         AS percentual_atingimento_2030,
       CASE WHEN taxa_alfabetizacao >= meta_alfabetizacao_2030 THEN 1 ELSE 0 END AS meta_atingida_2030
FROM u"""
SQL["gold_evolucao_proficiencia"] = SILVER + "\nSELECT * FROM s_avaliacao_uf"
SQL["gold_ranking_municipios"] = SILVER + f""",
r AS (SELECT a.*, d.sigla_uf FROM s_avaliacao_municipio a LEFT JOIN uf_dim d
      ON TRY_CAST(substr(CAST(a.id_municipio AS VARCHAR), 1, 2) AS INTEGER) = d.co_uf
      WHERE a.taxa_alfabetizacao IS NOT NULL)
SELECT ano, sigla_uf, id_municipio, serie, rede, taxa_alfabetizacao, media_portugues,
       CAST(rank() OVER (PARTITION BY ano, sigla_uf, rede ORDER BY taxa_alfabetizacao DESC) AS INTEGER) AS ranking,
       {R("percent_rank() OVER (PARTITION BY ano, sigla_uf, rede ORDER BY taxa_alfabetizacao DESC) * 100", 2)} AS percentil
FROM r"""
SQL["gold_indicadores_alunos"] = SILVER + f"""
SELECT nu_ano_avaliacao, sg_uf, tp_dependencia, count(*) AS total_alunos_avaliados,
       CAST(sum(in_alfabetizado) AS BIGINT) AS total_alfabetizados, {R(MEAN("vl_proficiencia_lp"), 2)} AS media_proficiencia,
       min(vl_proficiencia_lp) AS min_proficiencia, max(vl_proficiencia_lp) AS max_proficiencia,
       {PCT("sum(in_alfabetizado)", "count(*)")} AS taxa_alfabetizacao
FROM s_students_ok WHERE in_presenca_lp = 1 GROUP BY nu_ano_avaliacao, sg_uf, tp_dependencia"""
SQL["gold_indicadores_alunos_municipio"] = SILVER + f"""
SELECT nu_ano_avaliacao, sg_uf, co_municipio, no_municipio, tp_dependencia, count(*) AS total_alunos_avaliados,
       CAST(sum(in_alfabetizado) AS BIGINT) AS total_alfabetizados, {R(MEAN("vl_proficiencia_lp"), 2)} AS media_proficiencia,
       {PCT("sum(in_alfabetizado)", "count(*)")} AS taxa_alfabetizacao
FROM s_students_ok WHERE in_presenca_lp = 1 GROUP BY nu_ano_avaliacao, sg_uf, co_municipio, no_municipio, tp_dependencia"""
SQL["gold_features_ml"] = SILVER + f"""
SELECT ano, id_municipio, rede, taxa_alfabetizacao, {_M}, nivel_alfabetizacao, percentual_participacao,
       {R("meta_alfabetizacao_2030 - taxa_alfabetizacao", 2)} AS gap_meta_2030,
       {R("taxa_alfabetizacao / NULLIF(meta_alfabetizacao_2030, 0) * 100", 2)} AS percentual_atingimento,
       CASE WHEN meta_alfabetizacao_2026 IS NOT NULL THEN {R("meta_alfabetizacao_2026 - taxa_alfabetizacao", 2)} END
         AS distancia_meta_2026,
       CASE WHEN taxa_alfabetizacao >= meta_alfabetizacao_2030 THEN 1 ELSE 0 END AS ja_atingiu_meta
FROM s_meta_municipio
WHERE taxa_alfabetizacao IS NOT NULL AND meta_alfabetizacao_2030 IS NOT NULL AND id_municipio IS NOT NULL"""
SQL["gold_desigualdade_regional"] = SILVER + f""",
ri AS (SELECT ano, d.regiao, rede, {R("avg(taxa_alfabetizacao)", 2)} AS media_taxa_alfabetizacao,
              {R("avg(meta_alfabetizacao_2030)", 2)} AS media_meta_2030, min(taxa_alfabetizacao) AS min_taxa,
              max(taxa_alfabetizacao) AS max_taxa, count(*) AS total_ufs
       FROM s_meta_uf u LEFT JOIN uf_dim d ON u.sigla_uf = d.sigla_uf
       WHERE taxa_alfabetizacao IS NOT NULL GROUP BY ano, d.regiao, rede)
SELECT *, {R("media_meta_2030 - media_taxa_alfabetizacao", 2)} AS gap_medio_meta_2030,
       {R("max_taxa - min_taxa", 2)} AS amplitude FROM ri"""
SQL["gold_municipios_criticos"] = SILVER + f""",
c AS (SELECT *, {R("meta_alfabetizacao_2030 - taxa_alfabetizacao", 2)} AS g FROM uf_prefix
      WHERE taxa_alfabetizacao IS NOT NULL AND meta_alfabetizacao_2030 IS NOT NULL)
SELECT ano, id_municipio, m_sigla AS sigla_uf, m_regiao AS regiao, rede, taxa_alfabetizacao, meta_alfabetizacao_2030,
       g AS gap_meta_2030, {R("taxa_alfabetizacao / NULLIF(meta_alfabetizacao_2030, 0) * 100", 2)} AS percentual_atingimento,
       {_CRIT_CASE} AS nivel_criticidade, percentual_participacao FROM c"""
SQL["gold_tendencia_temporal"] = SILVER + f""",
t0 AS (SELECT ano, sigla_uf, rede, taxa_alfabetizacao AS taxa, meta_alfabetizacao_2030 AS meta,
              lag(taxa_alfabetizacao) OVER (PARTITION BY sigla_uf, rede ORDER BY ano) AS prev
       FROM s_meta_uf WHERE taxa_alfabetizacao IS NOT NULL),
t1 AS (SELECT *, CASE WHEN prev IS NOT NULL THEN {R("taxa - prev", 2)} END AS variacao_anual FROM t0),
t2 AS (SELECT *, CASE WHEN variacao_anual > 0 AND meta IS NOT NULL
                      THEN {R("(meta - taxa) / variacao_anual", 1)} END AS anos_para_meta FROM t1),
t3 AS (SELECT *, CASE WHEN anos_para_meta > 0 THEN CAST(trunc(ano + anos_para_meta) AS INTEGER) END
                 AS ano_projetado_atingimento FROM t2)
SELECT ano, sigla_uf, rede, taxa AS taxa_alfabetizacao, meta AS meta_alfabetizacao_2030, variacao_anual, anos_para_meta,
       ano_projetado_atingimento,
       CASE WHEN ano_projetado_atingimento IS NULL THEN 'Sem dados' WHEN taxa >= meta THEN 'Já atingiu'
            WHEN ano_projetado_atingimento <= 2030 THEN 'Sim' ELSE 'Não no ritmo atual' END AS vai_atingir_2030
FROM t3"""
SQL["roundtrip_layers"] = SILVER + "\nSELECT * FROM s_meta_uf"


def _rule(table: str, rule: str, violations: str, unit: str, source: str) -> str:
    return (f"SELECT '{table}' AS tabela, '{rule}' AS regra, CASE WHEN v = 0 THEN 'PASSOU' ELSE 'FALHOU' END AS status, "
            f"'(' || CAST(v AS VARCHAR) || ' {unit})' AS detalhe FROM (SELECT count(*) FILTER (WHERE {violations}) AS v FROM {source})")


def _unique(table: str, keys: list[str], source: str) -> str:
    k = ", ".join(keys)
    return (f"SELECT '{table}' AS tabela, 'sem duplicatas ({'+'.join(keys)})' AS regra, "
            f"CASE WHEN t = d THEN 'PASSOU' ELSE 'FALHOU' END AS status, "
            f"'(' || CAST(t AS VARCHAR) || ' total, ' || CAST(d AS VARCHAR) || ' distintos)' AS detalhe "
            f"FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS t, count(*) AS d FROM (SELECT count(*) AS c FROM {source} GROUP BY {k}))")


def _silver_quality() -> str:
    years = list(range(2024, 2031))
    mono = [_rule("meta_uf", f"meta_alfabetizacao_{a} <= meta_alfabetizacao_{b}",
                  f"meta_alfabetizacao_{a} IS NOT NULL AND meta_alfabetizacao_{b} IS NOT NULL AND "
                  f"meta_alfabetizacao_{a} > meta_alfabetizacao_{b}", "violações", "s_meta_uf")
            for a, b in zip(years, years[1:])]
    levels = " + ".join(f"proporcao_aluno_nivel_{i}" for i in range(9))
    parts = [
        _rule("meta_brasil", "ano/rede não nulos", "ano IS NULL OR rede IS NULL", "nulos", "s_meta_brasil"),
        _rule("meta_uf", "ano/sigla_uf/rede não nulos", "ano IS NULL OR sigla_uf IS NULL OR rede IS NULL", "nulos", "s_meta_uf"),
        _rule("meta_uf", "taxa_alfabetizacao em [0, 100]",
              "taxa_alfabetizacao IS NOT NULL AND (taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100)", "fora", "s_meta_uf"),
        *mono,
        _rule("meta_municipio", "ano/id_municipio não nulos", "ano IS NULL OR id_municipio IS NULL", "nulos", "s_meta_municipio"),
        _rule("meta_municipio", "taxa_alfabetizacao em [0, 100]",
              "taxa_alfabetizacao IS NOT NULL AND (taxa_alfabetizacao < 0 OR taxa_alfabetizacao > 100)", "fora",
              "s_meta_municipio"),
        _unique("meta_uf", ["ano", "sigla_uf", "rede"], "s_meta_uf"),
        _unique("meta_municipio", ["ano", "id_municipio", "rede"], "s_meta_municipio"),
        f"""SELECT 'avaliacao_uf' AS tabela, 'soma de proporcao_aluno_nivel_0.. = 100 ± 2' AS regra,
                   CASE WHEN v = 0 THEN 'PASSOU' ELSE 'FALHOU' END AS status,
                   CASE WHEN a = 0 THEN '(sem dados)' ELSE '(' || CAST(v AS VARCHAR) || ' fora)' END AS detalhe
            FROM (SELECT count(*) FILTER (WHERE proporcao_aluno_nivel_0 IS NOT NULL) AS a,
                         count(*) FILTER (WHERE proporcao_aluno_nivel_0 IS NOT NULL AND abs({levels} - 100) > 2) AS v
                  FROM s_avaliacao_uf)""",
        """SELECT 'meta_uf vs avaliacao_uf' AS tabela, 'sigla_uf consistente entre tabelas' AS regra,
                  CASE WHEN a = 0 AND b = 0 THEN 'PASSOU' ELSE 'FALHOU' END AS status,
                  '(só meta: ' || CAST(a AS VARCHAR) || ', só avaliação: ' || CAST(b AS VARCHAR) || ')' AS detalhe
           FROM (SELECT (SELECT count(DISTINCT sigla_uf) FROM s_meta_uf WHERE sigla_uf IS NOT NULL
                         AND sigla_uf NOT IN (SELECT sigla_uf FROM s_avaliacao_uf WHERE sigla_uf IS NOT NULL)) AS a,
                        (SELECT count(DISTINCT sigla_uf) FROM s_avaliacao_uf WHERE sigla_uf IS NOT NULL
                         AND sigla_uf NOT IN (SELECT sigla_uf FROM s_meta_uf WHERE sigla_uf IS NOT NULL)) AS b)""",
        _rule("ts_aluno", "vl_proficiencia_lp em [400, 1000]",
              "vl_proficiencia_lp IS NOT NULL AND (vl_proficiencia_lp < 400 OR vl_proficiencia_lp > 1000)", "fora",
              "s_students_ok"),
        _unique("ts_aluno", ["nu_ano_avaliacao", "id_aluno"], "s_students_ok"),
    ]
    return SILVER + "\n" + "\nUNION ALL ".join(parts)


SQL["silver_quality"] = _silver_quality()

PANEL = """
WITH a AS (SELECT DISTINCT o_custkey AS chave FROM orders WHERE year(o_orderdate) = 1995 AND o_custkey IS NOT NULL),
     b AS (SELECT DISTINCT o_custkey AS chave FROM orders WHERE year(o_orderdate) = 1996 AND o_custkey IS NOT NULL),
     m AS (SELECT chave, '1995' AS lado FROM a WHERE chave NOT IN (SELECT chave FROM b)
           UNION ALL SELECT chave, '1996' FROM b WHERE chave NOT IN (SELECT chave FROM a))"""
SQL["key_panel_mismatch"] = PANEL + "\nSELECT chave, lado FROM m"
SQL["key_panel_check"] = PANEL + """,
n AS (SELECT count(*) FILTER (WHERE lado = '1995') AS a, count(*) FILTER (WHERE lado = '1996') AS b FROM m)
SELECT '1995 vs 1996' AS tabela, 'cliente consistente entre tabelas' AS regra,
       CASE WHEN a = 0 AND b = 0 THEN 'PASSOU' ELSE 'FALHOU' END AS status,
       '(só 1995: ' || CAST(a AS VARCHAR) || ', só 1996: ' || CAST(b AS VARCHAR) || ')' AS detalhe FROM n"""
SQL["slice_wanted_year"] = KPI + """
SELECT ano, uf, regiao, rede, n, taxa FROM kpi
WHERE ano = (SELECT CASE WHEN bool_or(ano = 1997) THEN 1997 ELSE 1994 END FROM kpi)"""
SQL["first_last_points"] = KPI + """
SELECT uf, rede, arg_min(taxa, ano) AS primeiro_taxa, arg_max(taxa, ano) AS ultimo_taxa, arg_min(n, ano) AS primeiro_n,
       arg_max(n, ano) AS ultimo_n, min(ano) AS primeiro_ano, max(ano) AS ultimo_ano, count(*) AS n_pontos
FROM kpi GROUP BY uf, rede"""
SQL["ordered_year"] = KPI + """
SELECT ano, uf, rede, taxa FROM kpi WHERE ano = 1996 ORDER BY taxa DESC, uf, rede"""
SQL["stream_refresh"] = SQL["gold_indicadores_alunos"].replace(
    "FROM s_students WHERE ", "FROM s_students WHERE id_aluno IN (SELECT event_id FROM pev WHERE coalesce(k, '') NOT IN ('0', '1')) AND ")
SQL["stream_dedup"] = STUDENT_RECORD
SQL["stream_running_rate"] = SQL["stream_metrics"]
SQL["stream_replay"] = STUDENT_RECORD.replace("'stream_kinesis'", "'quarentena'").replace("coalesce(k, '') NOT IN ('0', '1')", "k = '2'")
SQL["silver_merged"] = SILVER + """
SELECT nu_ano_avaliacao, sg_uf, id_aluno, tp_dependencia, co_municipio, no_municipio, in_presenca_lp, vl_proficiencia_lp, in_alfabetizado
FROM s_students_ok WHERE id_aluno IN (SELECT event_id FROM pev WHERE coalesce(k, '') NOT IN ('0', '1'))"""
SQL["merged_states"] = SQL["student_indicators_uf"].replace("FROM events)", "FROM events WHERE day(ts) > 15 OR event_type IN ('view', 'click'))")
SQL["replaced_years"] = KPI + """
SELECT * FROM kpi WHERE ano NOT IN (1997, 1998) OR (ano = 1997 AND regiao = 'ASIA') OR (ano = 1998 AND regiao = 'EUROPE')"""

SQL = {k: (v if v.lstrip().upper().startswith(("WITH", "SELECT")) else "WITH " + v) for k, v in SQL.items()}
