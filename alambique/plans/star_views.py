"""Dirty star-schema views over the given TPC-H-like tables.

Each text runs unchanged on Spark SQL and DuckDB. Faults are planted by
arithmetic on the keys, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alambique.schemas import DATE_DIM, FACT, PRODUCT_DIM, STORE_DIM

#: Labels of the region view; ``middle east`` is left to the fallback.
VIEW_REGIONS = {
    "africa": "Africa",
    "america": "America",
    "asia": "Asia",
    "europe": "Europe",
}

VIEWS = {
    FACT: """
WITH h AS (SELECT *, (l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey*3) % 1000 AS h,
  CAST(year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) AS STRING) AS ymd FROM {lineitem})
SELECT CAST(CASE WHEN h = 500 THEN NULL WHEN h BETWEEN 501 AND 503 THEN l_suppkey + 1000000 ELSE l_suppkey END AS INT) AS Tienda_ID,
 CAST(CASE WHEN h BETWEEN 510 AND 513 THEN l_partkey + 10000000 ELSE l_partkey END AS INT) AS Producto_ID,
 CASE WHEN h < 5 THEN NULL WHEN h < 10 THEN 'ID_ERRONEO' WHEN h < 15 THEN '2024-X-01' WHEN h < 20 THEN concat(' ', ymd, ' ') ELSE ymd END AS Fecha_ID,
 1 - l_discount AS Distribucion_Numerica,
 CASE WHEN h % 50 = 0 THEN NULL ELSE 1 - l_tax END AS Distribucion_Ponderada,
 CASE WHEN h BETWEEN 100 AND 109 THEN NULL WHEN h BETWEEN 110 AND 119 THEN CAST(-0.5 AS DOUBLE) WHEN h BETWEEN 120 AND 124 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / l_quantity END AS Precio,
 CASE WHEN h % 20 = 0 THEN 1 ELSE 0 END AS Out_Of_Stock_Flag,
 CAST(CASE WHEN h BETWEEN 200 AND 219 THEN 0 WHEN h BETWEEN 220 AND 229 THEN NULL WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS Ventas_Volumen,
 CASE WHEN h BETWEEN 200 AND 214 THEN CAST(0 AS DOUBLE) WHEN h BETWEEN 230 AND 239 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS Ventas_Valor
FROM h""",
    DATE_DIM: """
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS f FROM {lineitem}),
x AS (SELECT f, year(f)*10000+month(f)*100+day(f) AS ymd, lpad(CAST(month(f) AS STRING),2,'0') AS mm, lpad(CAST(day(f) AS STRING),2,'0') AS dd,
  CASE month(f) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril' WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END AS nm FROM d),
y AS (SELECT ymd, CASE WHEN ymd % 97 = 1 THEN NULL WHEN ymd % 97 = 2 THEN 'ID_ERRONEO' WHEN ymd % 97 = 3 THEN concat(' ', CAST(ymd AS STRING)) ELSE CAST(ymd AS STRING) END AS Fecha_ID,
  CASE WHEN ymd % 89 = 1 THEN NULL WHEN ymd % 89 = 2 THEN concat(dd,'/',mm,'/',CAST(year(f) AS STRING)) WHEN ymd % 89 = 3 THEN CAST(ymd AS STRING) WHEN ymd % 89 = 4 THEN 'FECHA_INCORRECTA' ELSE CAST(f AS STRING) END AS Fecha,
  CAST(year(f) AS INT) AS Anio, CAST(month(f) AS INT) AS Mes,
  CASE ymd % 10 WHEN 1 THEN upper(nm) WHEN 2 THEN concat(upper(substring(nm,1,3)),'.') WHEN 3 THEN concat(' ',nm,' ') WHEN 4 THEN lower(substring(nm,1,3)) ELSE nm END AS Nombre_Mes,
  CAST(weekofyear(f) AS INT) AS Numero_Semana, concat(CAST(year(f) AS STRING),'Q',CAST(quarter(f) AS STRING)) AS Trimestre,
  round(cos((dayofyear(f) - 180) * 2 * pi() / 365), 6) AS Estacionalidad_Factor FROM x)
SELECT Fecha_ID, Fecha, Anio, Mes, Nombre_Mes, Numero_Semana, Trimestre, Estacionalidad_Factor FROM y
UNION ALL SELECT Fecha_ID, Fecha, Anio, Mes, Nombre_Mes, Numero_Semana, Trimestre, Estacionalidad_Factor FROM y WHERE ymd % 50 = 1""",
    STORE_DIM: """
WITH x AS (SELECT CAST(s_suppkey AS INT) AS Tienda_ID,
  CASE s_suppkey % 5 WHEN 1 THEN lower(r_name) WHEN 2 THEN concat(r_name,' ') WHEN 3 THEN replace(r_name,'E','É') WHEN 4 THEN replace(lower(r_name),'a','á') ELSE r_name END AS Region,
  CASE s_suppkey % 3 WHEN 0 THEN 'Supermercado' WHEN 1 THEN 'Tienda_Especializada' ELSE 'Tienda_Conveniencia' END AS Formato_Tienda,
  (50 + s_suppkey % 100) / CAST(100 AS DOUBLE) AS Atractivo_Factor
  FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey)
SELECT * FROM x UNION ALL SELECT * FROM x WHERE Tienda_ID % 10 = 0""",
    PRODUCT_DIM: """
WITH x AS (SELECT CAST(p_partkey AS INT) AS Producto_ID, CASE WHEN p_partkey % 100 = 9 THEN NULL ELSE p_brand END AS Marca, p_type AS Segmento, p_name AS Sabor,
  CASE p_partkey % 4 WHEN 0 THEN 'Botella_PET' WHEN 1 THEN 'Lata' WHEN 2 THEN 'Carton' ELSE 'Vidrio' END AS Tipo_Envase, concat(CAST(p_size AS STRING),'ml') AS Tamano,
  CASE WHEN p_partkey % 100 = 7 THEN CAST(-0.25 AS DOUBLE) WHEN p_partkey % 100 = 8 THEN NULL ELSE p_retailprice END AS Precio_Base,
  (80 + p_partkey % 41) / CAST(100 AS DOUBLE) AS Demanda_Factor FROM {part})
SELECT * FROM x UNION ALL SELECT * FROM x WHERE Producto_ID % 50 = 0""",
}

_TABLES = ("region", "nation", "supplier", "part", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One dirty table over the parquet files in ``sf_dir``."""
    text = VIEWS[name]
    used = [t for t in _TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir, name) for name in VIEWS}


def duckdb_text(name: str) -> str:
    """The view's text over tables registered under their own names."""
    return VIEWS[name].format(**{t: t for t in _TABLES})
