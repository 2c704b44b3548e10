"""SQL functions and views equal the DataFrame functions."""

from pyspark.sql import functions as F

from letramento.functions import measures as M
from letramento.plans.sql import register_functions, register_gold_views
from letramento.plans.testbed import kpi

SF = "/root/testdata/sf0.001"


def test_sql_functions_equal_column_functions(spark):
    register_functions(spark)
    k = kpi(spark, SF).withColumn("meta", F.when(F.col("n") % 5 == 0, F.lit(0.0)).otherwise(F.col("meta")))
    k = k.withColumn("var", F.col("taxa") - 30).withColumn("nota", F.col("taxa") * 10)
    k.createOrReplaceTempView("k")
    sql = spark.sql("""SELECT ano, uf, rede, lt_gap(meta, taxa) g, lt_atingimento(taxa, meta) a, lt_meta_atingida(taxa, meta) r,
                              lt_criticidade(lt_gap(meta, taxa)) c, lt_faixa_taxa(taxa) f, lt_alfabetizado(nota, 300) l,
                              lt_anos_para_meta(taxa, meta, var) y,
                              lt_ano_projetado(ano, lt_anos_para_meta(taxa, meta, var)) p,
                              lt_status_projecao(taxa, meta, lt_ano_projetado(ano, lt_anos_para_meta(taxa, meta, var))) s
                       FROM k""")
    y = M.years_to_target("taxa", "meta", "var")
    df = k.select("ano", "uf", "rede", M.gap("meta", "taxa").alias("g"), M.attainment("taxa", "meta").alias("a"),
                  M.reached("taxa", "meta").alias("r"), M.criticality(M.gap("meta", "taxa")).alias("c"),
                  M.rate_band("taxa").alias("f"), M.literate_flag("nota", 300).alias("l"), y.alias("y"),
                  M.projected_year("ano", y).alias("p"),
                  M.projection_status("taxa", "meta", M.projected_year("ano", y)).alias("s"))
    assert sorted(map(tuple, sql.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_gold_views(spark):
    from letramento.plans.pipeline import run_pipeline
    names = register_gold_views(spark, f"{run_pipeline(spark, SF)}/gold")
    assert len(names) == 9
    assert spark.sql("SELECT count(*) FROM municipios_criticos").first()[0] > 0
