"""The registered queries again, as SQL for DuckDB over the same tables."""

from __future__ import annotations

import re

from alambique.plans.star_views import VIEWS, duckdb_text

# Fixed values, written out here so that an error in the package's own shows.
FACT = "fact_ventas"
FACT_KEY = ("Producto_ID", "Tienda_ID", "Fecha_ID", "Tipo_Transaccion")
KEYS = {"dim_tiempo": "Fecha_ID", "dim_tienda": "Tienda_ID", "dim_producto": "Producto_ID"}
TARGET_NAMES = {
    "dim_producto": "tbl_producto",
    "dim_tienda": "tbl_tienda",
    "dim_tiempo": "tbl_fecha",
    "fact_ventas": "tbl_facts",
}
CLASSES = (
    "VENTA_NORMAL", "DEVOLUCION", "AJUSTE_INVENTARIO", "VENTA_PERDIDA",
    "REGISTRO_SIN_VENTA", "ANOMALO",
)
COST_CLASSES = ("DEVOLUCION", "AJUSTE_INVENTARIO", "ANOMALO")
FLAGS = {
    "Es_Devolucion": "DEVOLUCION",
    "Es_Ajuste": "AJUSTE_INVENTARIO",
    "Es_Venta_Normal": "VENTA_NORMAL",
    "Es_Anomalo": "ANOMALO",
}
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
    "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
VIEW_REGIONS = {
    "africa": "Africa", "america": "America", "asia": "Asia", "europe": "Europe",
}
_ENGLISH = (
    "january february march april may june july august september october november december"
).split()
MONTH_LABELS = {
    label: name
    for name, english in zip(MONTHS, _ENGLISH)
    for label in (name.lower(), name[:3].lower(), f"{name[:3].lower()}.", english)
}
PRIME, SEED, FAULTS = 2147483647, 7, 0.05


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _digits(expression: str, scale: int = 10_000) -> str:
    return f"floor(({expression}) * {scale} + 0.5e0) / {float(scale)}e0"


def _label(key: str, labels: dict[str, str]) -> str:
    """Look a cleaned label up, else capitalise each of its words."""
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    words = (
        "array_to_string([upper(left(w, 1)) || substr(w, 2) "
        f"for w in string_split({key}, ' ')], ' ')"
    )
    return f"CASE {key} {cases} ELSE {words} END"


def _folded(text: str) -> str:
    return f"translate({text}, 'áàäâéèëêíìïîóòöôúùüû', 'aaaaeeeeiiiioooouuuu')"


def _parsed(text: str) -> str:
    """First of the formats that fits, as a date."""
    formats = ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y%m%d", "%Y/%m/%d", "%d-%m-%Y")
    tries = ", ".join(f"try_strptime({text}, '{f}')" for f in formats)
    return f"CAST(coalesce({tries}) AS DATE)"


def _valid(key: str) -> str:
    return f"coalesce(regexp_full_match({key}, '[0-9]{{8}}'), false)"


def _uniform(row_id: str, stream: int, seed: int = SEED) -> str:
    a = 48271 * (2 * stream + 1) % PRIME
    b = (69621 * seed + 40692 * stream) % PRIME
    row = f"CAST({row_id} AS BIGINT)"
    x = f"(({row} % {PRIME}) * {a} + {b} + ({row} // {PRIME}) % {PRIME} * 40692 % {PRIME}) % {PRIME}"
    x = f"(({x}) * ({x}) + {a}) % {PRIME}"
    x = f"(({x}) * 16807 + {b}) % {PRIME}"
    x = f"(({x}) * ({x}) + {a}) % {PRIME}"
    return f"(({x}) / {float(PRIME)}e0)"


_KIND = """CASE WHEN Ventas_Volumen < 0 AND Precio > 0 THEN 'DEVOLUCION'
  WHEN Ventas_Volumen < 0 AND (Precio <= 0 OR Precio IS NULL) THEN 'AJUSTE_INVENTARIO'
  WHEN Ventas_Volumen = 0 AND Out_Of_Stock_Flag = 1
       AND (Ventas_Valor = 0 OR Ventas_Valor IS NULL) THEN 'VENTA_PERDIDA'
  WHEN Ventas_Volumen = 0 AND Out_Of_Stock_Flag = 0
       AND (Ventas_Valor = 0 OR Ventas_Valor IS NULL) THEN 'REGISTRO_SIN_VENTA'
  WHEN Ventas_Volumen > 0 AND Precio > 0 AND Ventas_Valor > 0 THEN 'VENTA_NORMAL'
  ELSE 'ANOMALO' END"""
_FLAGS = ", ".join(f"Tipo_Transaccion = '{c}' AS {f}" for f, c in FLAGS.items())


def _one_per_key(source: str, key: str, columns: list[str]) -> str:
    rest = [c for c in columns if c not in key.split(", ")]
    order = ", ".join(f"{c} NULLS LAST" for c in rest)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


_DATE_COLUMNS = (
    "Fecha_ID Fecha Anio Mes Nombre_Mes Numero_Semana Trimestre Estacionalidad_Factor"
).split()
_STORE_COLUMNS = (
    "Tienda_ID Region Formato_Tienda Atractivo_Factor Region_original"
).split()
_PRODUCT_COLUMNS = (
    "Producto_ID Marca Segmento Sabor Tipo_Envase Tamano Precio_Base Demanda_Factor"
).split()
_RAW_COLUMNS = (
    "Tienda_ID Producto_ID Fecha_ID Distribucion_Numerica Distribucion_Ponderada Precio "
    "Out_Of_Stock_Flag Ventas_Volumen Ventas_Valor"
).split()
_FACT_COLUMNS = (
    "Producto_ID Tienda_ID Fecha_ID Distribucion_Numerica Distribucion_Ponderada Precio "
    "Out_Of_Stock_Flag Ventas_Volumen Ventas_Valor Fecha_ID_original "
    "Precio_Promedio_Producto Tipo_Transaccion Es_Devolucion Es_Ajuste Es_Venta_Normal "
    "Es_Anomalo Precio_Original Ventas_Valor_Original"
).split()

_CTES: dict[str, str] = {name: duckdb_text(name) for name in VIEWS}
_CTES["fechas"] = f"""
SELECT * REPLACE ({_parsed("Fecha")} AS Fecha,
    CASE WHEN {_valid("trim(Fecha_ID)")} THEN trim(Fecha_ID)
         ELSE strftime({_parsed("Fecha")}, '%Y%m%d') END AS Fecha_ID,
    {_label("lower(trim(Nombre_Mes))", MONTH_LABELS)} AS Nombre_Mes),
  Fecha_ID AS clave0, Fecha AS fecha0 FROM dim_tiempo"""
_CTES["c_tiempo"] = _one_per_key(
    "(SELECT * FROM fechas WHERE Fecha_ID IS NOT NULL)", "Fecha_ID", _DATE_COLUMNS
)
_CTES["regiones"] = f"""
SELECT * REPLACE ({_label(_folded("lower(trim(Region))"), VIEW_REGIONS)} AS Region),
  Region AS Region_original FROM dim_tienda"""
_CTES["c_tienda"] = _one_per_key("regiones", "Tienda_ID", _STORE_COLUMNS)
_CTES["c_producto"] = _one_per_key(
    "(SELECT * FROM dim_producto WHERE Producto_ID IS NOT NULL "
    "AND Marca IS NOT NULL AND Precio_Base > 0)",
    "Producto_ID",
    _PRODUCT_COLUMNS,
)
_CTES["f_clave"] = f"""
SELECT * REPLACE (CASE WHEN {_valid("trim(Fecha_ID)")} THEN trim(Fecha_ID)
    ELSE '19000101' END AS Fecha_ID), Fecha_ID AS Fecha_ID_original FROM fact_ventas"""
_CTES["f_media"] = """
SELECT Producto_ID, avg(Precio) AS media FROM fact_ventas
WHERE Ventas_Volumen > 0 AND Precio > 0 AND Out_Of_Stock_Flag = 0 GROUP BY Producto_ID"""
_CTES["f_mediana"] = (
    "SELECT quantile_disc(Precio, 0.5) AS mediana FROM fact_ventas WHERE Precio > 0"
)
_CTES["f_promedio"] = """
SELECT f.*, coalesce(media, mediana) AS Precio_Promedio_Producto
FROM f_clave f LEFT JOIN f_media m ON f.Producto_ID = m.Producto_ID CROSS JOIN f_mediana"""
_CTES["f_tipo"] = f"SELECT *, {_KIND} AS Tipo_Transaccion FROM f_promedio"
_CTES["f_precio"] = f"""
SELECT * REPLACE (CASE WHEN Precio IS NULL OR (Precio <= 0 AND Ventas_Volumen > 0)
    THEN Precio_Promedio_Producto ELSE Precio END AS Precio),
  Precio AS Precio_Original, {_FLAGS} FROM f_tipo"""
_CTES["f_valor"] = """
SELECT * REPLACE (CASE WHEN Tipo_Transaccion IN ('VENTA_PERDIDA', 'REGISTRO_SIN_VENTA')
    THEN 0e0 ELSE Precio * Ventas_Volumen END AS Ventas_Valor),
  Ventas_Valor AS Ventas_Valor_Original FROM f_precio"""
_CTES["f_sin_recalculo"] = (
    "SELECT *, Ventas_Valor AS Ventas_Valor_Original FROM f_precio"
)


def _fact(source: str, condition: str, distribution: str | None = None) -> str:
    """Filtered rows with the distribution imputed from those rows, keys required."""
    rows = f"(SELECT * FROM {source} WHERE {condition})"
    median = f"(SELECT quantile_disc(Distribucion_Ponderada, 0.5) FROM {rows})"
    return f"""
SELECT {", ".join(_FACT_COLUMNS)} FROM (
  SELECT * REPLACE (coalesce(Distribucion_Ponderada, {median}) AS Distribucion_Ponderada)
  FROM {rows}) WHERE Tienda_ID IS NOT NULL AND Producto_ID IS NOT NULL"""


_CTES["f_limpio"] = _fact("f_valor", "true")
_CTES["f_estricto"] = _fact("f_valor", "Precio > 0 AND Ventas_Volumen IS NOT NULL")
_CTES["f_limites"] = """
SELECT avg(Ventas_Volumen) AS media, stddev_samp(Ventas_Volumen) AS desviacion
FROM fact_ventas"""
_USUAL = """Ventas_Volumen BETWEEN
  (SELECT media - 1.5e0 * desviacion FROM f_limites)
  AND (SELECT media + 1.5e0 * desviacion FROM f_limites)"""
_CTES["f_atipicos"] = _fact("f_sin_recalculo", _USUAL)


def _exists(dim: str, key: str, rows: str = "f") -> str:
    return f"EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = {rows}.{key})"


_INTEGRITY = " AND ".join(
    _exists(d, k)
    for d, k in (
        ("c_tiempo", "Fecha_ID"),
        ("c_tienda", "Tienda_ID"),
        ("c_producto", "Producto_ID"),
    )
)
_CTES["f_integro"] = f"SELECT f.* FROM f_estricto f WHERE {_INTEGRITY}"

_CTES["huerfanos"] = f"""
SELECT f.*, CASE WHEN NOT {_exists("c_tiempo", "Fecha_ID")} THEN 'Fecha_ID'
    WHEN NOT {_exists("c_tienda", "Tienda_ID")} THEN 'Tienda_ID'
    WHEN NOT {_exists("c_producto", "Producto_ID")} THEN 'Producto_ID' END AS clave_huerfana
FROM fact_ventas f"""

_CTES["clasificado"] = f"""
SELECT *, {_FLAGS} FROM (SELECT *, {_KIND} AS Tipo_Transaccion FROM f_clave)"""
_CTES["destino"] = """
SELECT * FROM clasificado WHERE Producto_ID % 3 <> 2"""
_CTES["etapa0"] = """
SELECT * FROM clasificado WHERE Producto_ID % 3 <> 0 OR Producto_ID IS NULL"""
_CTES["etapa"] = """
SELECT * FROM etapa0 UNION ALL SELECT * FROM etapa0 WHERE Producto_ID % 100 = 0"""
_SAME = " AND ".join(f"t.{k} = s.{k}" for k in FACT_KEY)
_KEYED = " AND ".join(f"s.{k} IS NOT NULL" for k in FACT_KEY)
_CTES["nuevos"] = f"""
SELECT s.* FROM etapa s WHERE {_KEYED}
  AND NOT EXISTS (SELECT 1 FROM destino t WHERE {_SAME})"""
_LOAD_COLUMNS = [
    *_RAW_COLUMNS,
    "Fecha_ID_original",
    "Tipo_Transaccion",
    *FLAGS,
]

_KNOWN = {
    "dim_producto": ("c_producto", "Tipo_Envase <> 'Lata'"),
    "dim_tienda": ("c_tienda", "Region <> 'Asia'"),
    "dim_tiempo": ("c_tiempo", "Fecha_ID < '20000101'"),
}


def _select(text: str) -> str:
    """The query with the common tables it needs, in their order."""
    needed: set[str] = set()
    pending = [text]
    while pending:
        body = pending.pop()
        for name in _CTES:
            if name not in needed and re.search(rf"\b{name}\b", body):
                needed.add(name)
                pending.append(_CTES[name])
    ctes = ", ".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in needed)
    return f"WITH {ctes} {text}" if ctes else text


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _computed(source: str) -> str:
    rounded = ", ".join(
        f"{_digits(c)} AS {c}"
        for c in ("Precio", "Precio_Promedio_Producto", "Ventas_Valor")
    )
    return f"SELECT * REPLACE ({rounded}) FROM {source}"


def _describe(column: str) -> str:
    text = column == "Fecha_ID"
    number = f"TRY_CAST({column} AS DOUBLE)"
    low, high = f"min({number})", f"max({number})"
    none = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{column}' AS columna, count({column}) AS n,
  {_digits(f"avg({number})")} AS media, {_digits(f"stddev_samp({number})")} AS desviacion,
  {none[0] if text else low} AS minimo, {none[0] if text else high} AS maximo,
  {f"min({column})" if text else none[1]} AS minimo_texto,
  {f"max({column})" if text else none[1]} AS maximo_texto FROM fact_ventas"""


def _key_class(key: str) -> str:
    return f"""CASE WHEN {key} IS NULL THEN 'NULL'
  WHEN regexp_full_match({key}, '[0-9]{{8}}') THEN 'Numérico_8_digitos'
  WHEN regexp_full_match({key}, '[0-9]+') THEN 'Numérico_otro' ELSE 'No_numérico' END"""


_NORMAL = "Ventas_Valor > 0 AND Ventas_Volumen > 0 AND Precio > 0 AND Out_Of_Stock_Flag = 0"
_NO_VALUE = "Ventas_Valor IS NULL"
_SCENARIOS = {
    "venta_normal": _NORMAL,
    "devolucion": "Ventas_Volumen < 0 AND Precio > 0",
    "ajuste_inventario": "Ventas_Volumen < 0 AND Precio > 0 AND Out_Of_Stock_Flag = 1",
    "venta_perdida_ref": "Ventas_Volumen = 0 AND Out_Of_Stock_Flag = 1 "
    f"AND Ventas_Valor = 0 OR {_NO_VALUE}",
    "registro_sin_venta_ref": "Ventas_Volumen = 0 AND Out_Of_Stock_Flag = 0 "
    f"AND Ventas_Valor = 0 OR {_NO_VALUE}",
    "venta_perdida": "Ventas_Volumen = 0 AND Out_Of_Stock_Flag = 1 "
    f"AND (Ventas_Valor = 0 OR {_NO_VALUE})",
    "registro_sin_venta": "Ventas_Volumen = 0 AND Out_Of_Stock_Flag = 0 "
    f"AND (Ventas_Valor = 0 OR {_NO_VALUE})",
}
_IN_TOTAL = list(_SCENARIOS)[:5]


def _scenarios() -> str:
    counts = {n: f"count(*) FILTER ({c})" for n, c in _SCENARIOS.items()}
    counts["total"] = " + ".join(counts[n] for n in _IN_TOTAL)
    return _union(
        f"SELECT '{n}' AS escenario, CAST({c} AS BIGINT) AS filas, "
        f"CAST({c} AS DOUBLE) / count(*) AS proporcion FROM fact_ventas"
        for n, c in counts.items()
    )


def _metrics(table: str, source: str, metrics: dict[str, str]) -> str:
    initial = metrics["initial_count"]
    return _union(
        f"SELECT '{table}' AS tabla, '{n}' AS metrica, CAST({m} AS BIGINT) AS valor, "
        f"({m}) * (100e0 / ({initial})) AS porcentaje FROM {source}"
        for n, m in metrics.items()
    )


def _dim_metrics(table, source, key, valid, faults) -> str:
    unique = f"count(DISTINCT CASE WHEN {valid} THEN {key} END)"
    repeated = (
        f"(SELECT count(*) FROM (SELECT {key} FROM {source} WHERE {valid} "
        f"GROUP BY {key} HAVING count(*) > 1))"
    )
    return _metrics(
        table,
        source,
        {
            "initial_count": "count(*)",
            "final_count": unique,
            "removed": f"count(*) - {unique}",
            "duplicates": f"max({repeated})",
            **{n: f"count(*) FILTER ({c})" for n, c in faults.items()},
        },
    )


def _report() -> str:
    clean = "trim(clave0)"
    kept = (
        "Precio > 0 AND Ventas_Volumen IS NOT NULL "
        "AND Tienda_ID IS NOT NULL AND Producto_ID IS NOT NULL"
    )
    raw = "trim(Fecha_ID_original)"
    change = "abs(Ventas_Valor - Ventas_Valor_Original) > abs(Ventas_Valor_Original * 0.01e0)"
    conditions = {
        "fecha_id_nulos": "Fecha_ID_original IS NULL",
        "fecha_id_malformados": f"Fecha_ID_original IS NOT NULL AND NOT {_valid(raw)}",
        "precio_nulo_antes": "Precio_Original IS NULL",
        "precio_no_positivo_antes": "Precio_Original <= 0",
        "precio_imputados": "Precio IS DISTINCT FROM Precio_Original",
        "precio_nulo_despues": "Precio IS NULL",
        "precio_no_positivo_despues": "Precio <= 0",
        "volumen_nulo": "Ventas_Volumen IS NULL",
        "dist_ponderada_nula": "Distribucion_Ponderada IS NULL",
        "valor_discrepancias": change,
        "outliers_removed": "false",
        **{
            f"tipo_{c.lower()}": f"{kept} AND Tipo_Transaccion = '{c}'"
            for c in CLASSES
        },
    }
    fact = {
        "initial_count": "count(*)",
        "final_count": f"count(*) FILTER ({kept})",
        "removed": f"count(*) - count(*) FILTER ({kept})",
        **{n: f"count(*) FILTER ({c})" for n, c in conditions.items()},
    }
    return _union(
        [
            _dim_metrics(
                "dim_tiempo",
                "fechas",
                "Fecha_ID",
                "Fecha_ID IS NOT NULL",
                {
                    "fecha_sin_formato": "Fecha IS NULL AND fecha0 IS NOT NULL",
                    "fecha_id_nulos": "clave0 IS NULL",
                    "fecha_id_malformados": f"clave0 IS NOT NULL AND NOT {_valid(clean)}",
                    "fecha_id_corregidos": f"Fecha_ID IS DISTINCT FROM {clean} "
                    "AND Fecha_ID IS NOT NULL",
                },
            ),
            _dim_metrics(
                "dim_tienda",
                "regiones",
                "Tienda_ID",
                "true",
                {"region_normalizadas": "Region IS DISTINCT FROM Region_original"},
            ),
            _dim_metrics(
                "dim_producto",
                "dim_producto",
                "Producto_ID",
                "Producto_ID IS NOT NULL AND Marca IS NOT NULL AND Precio_Base > 0",
                {
                    "marca_nulos": "Marca IS NULL",
                    "precio_base_nulos": "Precio_Base IS NULL",
                    "precio_base_no_positivo": "Precio_Base <= 0",
                },
            ),
            _metrics(FACT, "f_valor", fact),
        ]
    )


def _counts(names: dict[str, str], extra: str = "") -> str:
    return _union(
        f"SELECT '{n}' AS tabla, count(*) AS registros{extra} FROM {s}"
        for n, s in names.items()
    )


_CLEAN = {
    "dim_tiempo": "c_tiempo",
    "dim_tienda": "c_tienda",
    "dim_producto": "c_producto",
    FACT: "f_integro",
}

# -- Synthetic data -----------------------------------------------------------

_CTES["por_dia"] = """
SELECT CAST(l_shipdate AS DATE) AS dia, count(*) AS hechos FROM lineitem GROUP BY 1"""
_CTES["dias"] = """
SELECT CAST(unnest(generate_series(min(dia), max(dia), INTERVAL 1 DAY)) AS DATE) AS dia
FROM por_dia"""
_MONTH = f"([{_list(MONTHS)}])[month(dia)]"
_CTES["calendario"] = f"""
SELECT strftime(dia, '%Y%m%d') AS Fecha_ID, CAST(dia AS VARCHAR) AS Fecha,
  CAST(year(dia) AS INT) AS Anio, CAST(month(dia) AS INT) AS Mes, {_MONTH} AS Nombre_Mes,
  CAST(weekofyear(dia) AS INT) AS Numero_Semana,
  concat(year(dia), 'Q', quarter(dia)) AS Trimestre,
  {_digits("cos((dayofyear(dia) - 180) * 2 * pi() / 365)", 1_000_000)}
    AS Estacionalidad_Factor, coalesce(hechos, 0) AS filas
FROM dias LEFT JOIN por_dia USING (dia)"""


def _inject(value: str, draw: str, *faults: str) -> str:
    """A share of FAULTS for each fault, one after the other."""
    cases = " ".join(
        f"WHEN {draw} < {round(FAULTS * (i + 1), 9)!r}e0 THEN {f}" for i, f in enumerate(faults)
    )
    return f"CASE {cases} ELSE {value} END"


_O, _PK, _C = "o_orderkey", "p_partkey", "c_custkey"
_SEGMENT = "(upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)))"

# -- Reports ------------------------------------------------------------------

_MONEY = "DECIMAL(20,4)"
_COST = (
    f"coalesce(sum(CAST(abs(Ventas_Valor) AS {_MONEY})) "
    f"FILTER (Tipo_Transaccion IN ({_list(COST_CLASSES)})), 0)"
)
_SALES = (
    f"coalesce(sum(CAST(Ventas_Valor AS {_MONEY})) "
    "FILTER (Tipo_Transaccion = 'VENTA_NORMAL'), 0)"
)


def _sums(source: str, by: str = "") -> str:
    group = f" GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"SELECT {lead}{_COST} AS c, {_SALES} AS v FROM {source}{group}"


_RATE = (
    "CAST(c AS DOUBLE) AS costo, CAST(v AS DOUBLE) AS ventas, "
    + _digits("CAST(c AS DOUBLE) / nullif(CAST(v AS DOUBLE), 0)")
    + " AS tasa_impacto"
)


def _worst(dim: str, key: str, columns: str) -> str:
    return f"""SELECT {key}, {columns}, {_RATE}, posicion FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY c DESC, {key}) AS INT) AS posicion
  FROM ({_sums("f_integro", key)})) JOIN {dim} USING ({key}) WHERE posicion <= 20"""


_RAW_DAY = "NOT regexp_full_match(Fecha, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"
_FACT_RULES = {
    "Fecha_ID hasta 50": "length(Fecha_ID) > 50",
    "Precio no nulo": "Precio IS NULL",
    "Out_Of_Stock_Flag permitido": "Out_Of_Stock_Flag NOT IN (0, 1)",
}
_DERIVED = (
    "Precio_Promedio_Producto", "Tipo_Transaccion", "Es_Devolucion", "Es_Ajuste",
    "Es_Venta_Normal", "Es_Anomalo",
)
_BROKEN = [
    (
        "dim_tiempo",
        "dim_tiempo",
        {
            "Fecha_ID hasta 50": "length(Fecha_ID) > 50",
            "Fecha es fecha": _RAW_DAY,
            "Nombre_Mes hasta 50": "length(Nombre_Mes) > 50",
            "Trimestre hasta 10": "length(Trimestre) > 10",
        },
    ),
    (
        "dim_tienda",
        "dim_tienda",
        {
            "Region hasta 100": "length(Region) > 100",
            "Formato_Tienda hasta 50": "length(Formato_Tienda) > 50",
            "Region_original presente": "true",
        },
    ),
    (
        "dim_producto",
        "dim_producto",
        {
            **{
                f"{c} hasta 100": f"length({c}) > 100"
                for c in ("Marca", "Segmento", "Sabor", "Tipo_Envase")
            },
            "Tamano hasta 50": "length(Tamano) > 50",
        },
    ),
    (
        FACT,
        FACT,
        {
            **_FACT_RULES,
            "Fecha_ID_original presente": "true",
            "Precio_Original presente": "true",
            "Ventas_Valor_Original presente": "true",
            **{f"{c} presente": "true" for c in _DERIVED},
        },
    ),
    (
        f"{FACT} limpio",
        "f_integro",
        {
            **_FACT_RULES,
            "Fecha_ID_original hasta 50": "length(Fecha_ID_original) > 50",
            **{f"{c} no nulo": f"{c} IS NULL" for c in _DERIVED},
            "Tipo_Transaccion hasta 50": "length(Tipo_Transaccion) > 50",
            "Tipo_Transaccion permitido": f"Tipo_Transaccion NOT IN ({_list(CLASSES)})",
        },
    ),
    (
        "etl_log",
        "(SELECT unnest(range(3)))",
        {
            "Tabla_Origen hasta 100": "false",
            "Tabla_Destino hasta 100": "false",
            "Estado hasta 20": "false",
            "Usuario hasta 100": "false",
            "Estado permitido": "false",
        },
    ),
]

# -- The queries --------------------------------------------------------------

_TEXTS = {
    "csv_roundtrip": "SELECT * REPLACE (trim(Fecha_ID) AS Fecha_ID) FROM fact_ventas",
    "csv_quarantine": """
SELECT concat_ws(',', l_suppkey, l_partkey, strftime(l_shipdate, '%Y%m%d'), '0.5', '0.5',
    l_linenumber, '0', vol, valor) AS registro_corrupto,
  CAST(l_suppkey AS INT) AS Tienda_ID, CAST(l_partkey AS INT) AS Producto_ID,
  TRY_CAST(CASE WHEN regexp_full_match(vol, '[0-9]+') THEN vol END AS INT) AS Ventas_Volumen
FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'abc'
          WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN '2.0'
          ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS vol,
        CASE WHEN l_linestatus = 'O' AND l_linenumber = 3 THEN NULL ELSE '1.5' END AS valor
      FROM lineitem)
WHERE vol IN ('abc', '2.0') OR valor IS NULL""",
    "load_star": _union(
        f"SELECT '{n}' AS tabla, count(*) AS registros, count(DISTINCT {k}) AS claves FROM {n}"
        for n, k in {
            "dim_tiempo": "trim(Fecha_ID)",
            "dim_tienda": "Tienda_ID",
            "dim_producto": "Producto_ID",
            FACT: "trim(Fecha_ID)",
        }.items()
    ),
    "load_star_missing": _counts({n: n for n in VIEWS if n != "dim_producto"}),
    "export_append": """
SELECT Producto_ID, count(*) AS filas, CAST(sum(Ventas_Volumen) AS BIGINT) AS volumen
FROM (SELECT * FROM fact_ventas UNION ALL SELECT * FROM fact_ventas WHERE Ventas_Volumen < 0)
GROUP BY Producto_ID""",
    "table_counts": _counts({n: n for n in VIEWS}),
    "export_star": _union(
        f"SELECT '{n}' AS tabla, true AS exito, count(*) AS filas_escritas, "
        f"count(*) AS filas_leidas FROM {s}"
        for n, s in _CLEAN.items()
    ),
    "export_stats": _union(
        f"SELECT '{n}' AS tabla, count(*) > 0 AS exito, count(*) AS filas, "
        "'overwrite' AS modo, CAST(NULL AS INT) AS archivos, CAST(NULL AS VARCHAR) AS compresion, "
        f"CAST(1 AS INT) AS intentos FROM {s}"
        for n, s in {
            **{n: n for n in VIEWS},
            "sin_filas": "(SELECT * FROM dim_tienda WHERE Tienda_ID < 0)",
        }.items()
    ),
    "parquet_partitioned": """
SELECT CAST(left(Fecha_ID, 4) AS INT) AS Anio, CAST(substr(Fecha_ID, 5, 2) AS INT) AS Mes,
  count(*) AS filas, CAST(sum(Ventas_Volumen) AS BIGINT) AS volumen
FROM f_clave GROUP BY 1, 2""",
    "profile_describe": _union(_describe(c) for c in _RAW_COLUMNS),
    "profile_nulls": _union(
        f"SELECT '{c}' AS columna, count(*) - count({c}) AS nulos FROM fact_ventas"
        for c in _RAW_COLUMNS
    ),
    "profile_key_pattern": f"""
SELECT {_key_class("Fecha_ID")} AS clase, count(*) AS filas FROM fact_ventas GROUP BY 1""",
    "profile_examples": f"""
SELECT * FROM (SELECT clase, Fecha_ID, CAST(row_number() OVER
    (PARTITION BY clase ORDER BY Fecha_ID NULLS LAST) AS INT) AS posicion
  FROM (SELECT {_key_class("Fecha_ID")} AS clase, Fecha_ID FROM fact_ventas))
WHERE posicion <= 5""",
    "profile_distinct": "SELECT DISTINCT Nombre_Mes FROM dim_tiempo",
    "profile_distinct_counts": _union(
        f"SELECT '{c}' AS columna, count(DISTINCT {c}) + "
        f"max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distintos FROM fact_ventas"
        for c in ("Tienda_ID", "Producto_ID", "Fecha_ID")
    ),
    "profile_freq": "SELECT Region, count(*) AS filas FROM dim_tienda GROUP BY Region",
    "scenario_shares": _scenarios(),
    "dup_keys": _union(
        f"SELECT '{n}' AS tabla, CAST({k} AS VARCHAR) AS clave, count(*) AS filas "
        f"FROM {n} GROUP BY {k} HAVING count(*) > 1"
        for n, k in KEYS.items()
    ),
    "cleaning_report": _report(),
    "cleaning_summary": f"""
SELECT tabla, max(valor) FILTER (metrica = 'initial_count') AS initial_count,
  max(valor) FILTER (metrica = 'final_count') AS final_count,
  max(valor) FILTER (metrica = 'removed') AS removed,
  max(porcentaje) FILTER (metrica = 'removed') AS porcentaje
FROM ({_report()}) GROUP BY tabla""",
    "date_key_clean": f"""
SELECT Fecha_ID, trim(Fecha_ID) AS clave, {_valid("trim(Fecha_ID)")} AS valida,
  {_key_class("trim(Fecha_ID)")} AS clase FROM fact_ventas""",
    "date_parse_multi": f"""
SELECT o_orderkey, texto, CAST({_parsed("texto")} AS VARCHAR) AS fecha FROM (
  SELECT o_orderkey, CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
    WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 5 THEN strftime(o_orderdate, '%d-%m-%Y')
    WHEN 6 THEN 'FECHA_INCORRECTA' END AS texto FROM orders)""",
    "dim_tiempo_clean": "SELECT * REPLACE (CAST(Fecha AS VARCHAR) AS Fecha) FROM c_tiempo",
    "dim_tiempo_unknown": f"""
SELECT * REPLACE (CAST(Fecha AS VARCHAR) AS Fecha,
  {_digits("Estacionalidad_Factor", 1_000_000)} AS Estacionalidad_Factor)
FROM (SELECT * FROM c_tiempo UNION ALL SELECT '19000101', DATE '1900-01-01', 1900, 1, 'Enero',
  1, '1900Q1', cos((1 - 180) * 2 * pi() / 365))""",
    "dim_tienda_clean": "SELECT * FROM c_tienda",
    "dim_producto_clean": "SELECT * FROM c_producto",
    "month_normalize": f"""
SELECT Nombre_Mes, {_label("lower(trim(Nombre_Mes))", MONTH_LABELS)} AS mes FROM dim_tiempo""",
    "region_normalize": """
SELECT Tienda_ID, Region_original AS Region, Region AS region_normal FROM regiones""",
    "accent_fold": """
SELECT doc_id, translate(text, 'áéíóúÁÉÍÓÚñÑ', 'aeiouAEIOUnN') AS texto FROM documents""",
    "fact_date_sentinel": """
SELECT Producto_ID, Tienda_ID, Fecha_ID, Fecha_ID_original FROM f_clave""",
    "classify_tx": f"""
SELECT Producto_ID, Tienda_ID, Ventas_Volumen, Tipo_Transaccion, {_FLAGS}
FROM (SELECT *, {_KIND} AS Tipo_Transaccion FROM fact_ventas)""",
    "price_impute": f"""
SELECT Producto_ID, Ventas_Volumen, {_digits("Precio_Original")} AS Precio_Original,
  {_digits("Precio")} AS Precio,
  {_digits("Precio_Promedio_Producto")} AS Precio_Promedio_Producto FROM f_precio""",
    "value_recalc": f"""
SELECT Producto_ID, Tienda_ID, CASE WHEN Tipo_Transaccion IN
    ('VENTA_PERDIDA', 'REGISTRO_SIN_VENTA') THEN 0e0 ELSE Precio * Ventas_Volumen END
    AS Ventas_Valor, Ventas_Valor AS Ventas_Valor_Original
FROM (SELECT *, {_KIND} AS Tipo_Transaccion FROM fact_ventas)""",
    "value_discrepancy": f"""
SELECT Producto_ID, Tienda_ID, Fecha_ID, {_digits("Ventas_Valor")} AS Ventas_Valor,
  Ventas_Valor_Original FROM f_valor
WHERE abs(Ventas_Valor - Ventas_Valor_Original) > abs(Ventas_Valor_Original * 0.01e0)""",
    "season_factor": f"""
SELECT Fecha_ID, {_digits('''CASE WHEN md = 0 THEN 1e0
  ELSE cos((md - 601) * 2 * pi() / 1200) END''', 1_000_000)} AS factor
FROM (SELECT Fecha_ID, CASE WHEN regexp_full_match(substr(Fecha_ID, 5, 4), ' *[0-9]+ *')
    THEN CAST(substr(Fecha_ID, 5, 4) AS INT) ELSE 0 END AS md FROM fact_ventas)""",
    "calendar_dim": "SELECT * FROM calendario",
    "fact_clean": _computed("f_limpio"),
    "fact_clean_strict": _computed("f_estricto"),
    "fact_clean_outliers": _computed("f_atipicos"),
    "fact_clean_ri": _computed("f_integro"),
    "price_avg": f"""
SELECT Producto_ID, {_digits("media")} AS Precio_Promedio_Producto FROM f_media""",
    "price_avg_join": f"""
SELECT Tienda_ID, Producto_ID, fact_original AS Fecha_ID,
  {_digits("Precio_Promedio_Producto")} AS Precio_Promedio_Producto
FROM (SELECT *, Fecha_ID_original AS fact_original FROM f_promedio)""",
    "price_missing_products": """
SELECT count(*) AS productos_sin_precio FROM (SELECT DISTINCT f.Producto_ID
  FROM fact_ventas f LEFT JOIN f_media m ON f.Producto_ID = m.Producto_ID
  WHERE media IS NULL)""",
    "median_price": """
SELECT count(*) AS filas, quantile_disc(Precio, 0.5) AS mediana
FROM fact_ventas WHERE Precio > 0""",
    "quantiles_value": _union(
        f"SELECT count(*) AS filas, quantile_disc(Ventas_Valor, {q}) AS valor, "
        f"{q}e0 AS cuantil FROM fact_ventas"
        for q in (0.01, 0.25, 0.5, 0.75, 0.99)
    ),
    "dist_impute": """
SELECT Producto_ID, Tienda_ID, Distribucion_Ponderada AS original,
  coalesce(Distribucion_Ponderada, (SELECT quantile_disc(Distribucion_Ponderada, 0.5)
    FROM fact_ventas)) AS Distribucion_Ponderada FROM fact_ventas""",
    "outlier_bounds": f"""
SELECT {_digits("media")} AS mean, {_digits("desviacion")} AS stddev,
  {_digits("media - 3e0 * desviacion")} AS low, {_digits("media + 3e0 * desviacion")} AS high
FROM f_limites""",
    "outlier_filter": f"""
SELECT Producto_ID, Tienda_ID, Fecha_ID, Ventas_Volumen FROM fact_ventas WHERE {_USUAL}""",
    "tx_distribution": f"""
SELECT {_KIND} AS Tipo_Transaccion, count(*) AS filas FROM fact_ventas GROUP BY 1""",
    "dedup_key": """
SELECT * EXCLUDE (rn) REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate)
FROM (SELECT *, row_number() OVER
  (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST,
   l_quantity NULLS LAST, l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST,
   l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""",
    "ri_enforce": f"SELECT f.* FROM fact_ventas f WHERE {_INTEGRITY}",
    "ri_orphans": _union(
        f"SELECT '{k}' AS clave, count(*) AS huerfanos FROM huerfanos WHERE {c}"
        for k, c in {
            **{k: f"clave_huerfana = '{k}'" for k in ("Fecha_ID", "Tienda_ID", "Producto_ID")},
            "total": "clave_huerfana IS NOT NULL",
        }.items()
    ),
    "ri_orphan_rows": """
SELECT Producto_ID, Tienda_ID, Fecha_ID, clave_huerfana FROM huerfanos
WHERE clave_huerfana IS NOT NULL""",
    "dim_lookup": """
SELECT f.Producto_ID, f.Tienda_ID, Atractivo_Factor, Demanda_Factor, Precio_Base
FROM fact_ventas f LEFT JOIN c_tienda t ON t.Tienda_ID = f.Tienda_ID
LEFT JOIN c_producto p ON p.Producto_ID = f.Producto_ID""",
    "load_dim_new": _union(
        f"SELECT '{n}' AS tabla, CAST({KEYS[n]} AS VARCHAR) AS clave FROM {s} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {s} t WHERE {c} AND t.{KEYS[n]} = s.{KEYS[n]})"
        for n, (s, c) in _KNOWN.items()
    ),
    "load_dim_existing": _union(
        f"SELECT '{n}' AS tabla, CAST({KEYS[n]} AS VARCHAR) AS clave FROM {s} s "
        f"WHERE EXISTS (SELECT 1 FROM {s} t WHERE {c} AND t.{KEYS[n]} = s.{KEYS[n]})"
        for n, (s, c) in _KNOWN.items()
    ),
    "load_fact_new": "SELECT * FROM nuevos",
    "load_fact_first": _one_per_key("nuevos", ", ".join(FACT_KEY), _LOAD_COLUMNS),
    "staging_remainder": f"""
WITH guardado AS MATERIALIZED (SELECT {", ".join(FACT_KEY)}, Ventas_Volumen FROM etapa),
viejas AS MATERIALIZED (SELECT DISTINCT {", ".join(FACT_KEY)} FROM destino),
nuevas AS MATERIALIZED (SELECT DISTINCT {", ".join(f"s.{k}" for k in FACT_KEY)}
  FROM guardado s ANTI JOIN viejas t ON {_SAME} WHERE {_KEYED})
SELECT s.* FROM guardado s ANTI JOIN viejas t ON {_SAME} ANTI JOIN nuevas u
  ON {_SAME.replace("t.", "u.")}""",
    "load_key_filter": f"""
SELECT count(*) AS filas, count(*) FILTER (EXISTS (SELECT 1 FROM etapa s WHERE {_SAME}))
  AS coinciden, CAST(0 AS BIGINT) AS perdidas, true AS dentro_del_limite
FROM destino t WHERE {_KEYED.replace("s.", "t.")}""",
    "load_log": _union(
        [
            *[
                f"""SELECT 'clean_{n}' AS Tabla_Origen, '{TARGET_NAMES[n]}' AS Tabla_Destino,
  count(*) AS Registros_Procesados, count(*) FILTER (NOT coalesce({c}, false))
    AS Registros_Insertados, count(*) FILTER ({c}) AS Registros_Existentes,
  CAST(0 AS BIGINT) AS Registros_Duplicados, CAST(0 AS BIGINT) AS Registros_Errores,
  'EXITOSO' AS Estado, 'keep_first' AS Observaciones FROM {s}"""
                for n, (s, c) in _KNOWN.items()
            ],
            f"""SELECT 'clean_{FACT}', '{TARGET_NAMES[FACT]}', (SELECT count(*) FROM etapa),
  (SELECT count(*) FROM (SELECT DISTINCT {", ".join(FACT_KEY)} FROM nuevos)),
  (SELECT count(*) FROM etapa s WHERE EXISTS (SELECT 1 FROM destino t WHERE {_SAME})),
  (SELECT count(*) FROM nuevos)
    - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(FACT_KEY)} FROM nuevos)),
  (SELECT count(*) FROM etapa s WHERE NOT ({_KEYED})),
  CASE WHEN (SELECT count(*) FROM etapa s WHERE NOT ({_KEYED})) > 0
    THEN 'ADVERTENCIA' ELSE 'EXITOSO' END, 'keep_first'""",
        ]
    ),
    "conform_fact": _computed(
        f"(SELECT {', '.join(_FACT_COLUMNS)} FROM f_valor "
        "WHERE Tienda_ID IS NOT NULL AND Producto_ID IS NOT NULL)"
    ),
    "contract_violations": _union(
        f"SELECT '{t}' AS tabla, '{r}' AS regla, count(*) FILTER ({c}) AS filas FROM {source}"
        for t, source, broken in _BROKEN
        for r, c in broken.items()
    ),
    "error_detail": f"""
WITH malos AS (
  SELECT 'INTEGRIDAD' AS Tipo_Error, CASE WHEN NOT {_exists("c_tiempo", "Fecha_ID")}
      THEN 'Fecha_ID' WHEN NOT {_exists("c_tienda", "Tienda_ID")} THEN 'Tienda_ID'
      ELSE 'Producto_ID' END || ' sin dimensión' AS Descripcion, f.* FROM
    (SELECT {", ".join(FACT_KEY)} FROM etapa) f WHERE NOT ({_INTEGRITY})
  UNION ALL SELECT 'DUPLICADO', 'clave repetida', {", ".join(FACT_KEY)} FROM etapa s
    WHERE {_KEYED} GROUP BY {", ".join(FACT_KEY)} HAVING count(*) > 1
  UNION ALL SELECT 'VALIDACION', 'Precio nulo', {", ".join(FACT_KEY)} FROM etapa
    WHERE Precio IS NULL),
puestos AS (SELECT *, row_number() OVER (PARTITION BY Tipo_Error, Descripcion
    ORDER BY {", ".join(f"{k} NULLS LAST" for k in FACT_KEY)}) AS rn,
  concat('{{"Producto_ID":', coalesce(CAST(Producto_ID AS VARCHAR), 'null'), ',"Tienda_ID":',
    coalesce(CAST(Tienda_ID AS VARCHAR), 'null'), ',"Fecha_ID":"', Fecha_ID,
    '","Tipo_Transaccion":"', Tipo_Transaccion, '"}}') AS texto FROM malos)
SELECT 'clean_fact_ventas' AS Tabla, Tipo_Error, Descripcion,
  count(*) AS Registros_Afectados,
  '[' || string_agg(texto, ',' ORDER BY rn) FILTER (rn <= 3) || ']' AS Datos_Ejemplo
FROM puestos GROUP BY Tipo_Error, Descripcion""",
    "fault_nulls": f"""
SELECT o_orderkey, {_inject("o_totalprice", _uniform(_O, 1), "NULL")} AS o_totalprice
FROM orders""",
    "fault_keys": f"""
SELECT o_orderkey, CASE WHEN {_uniform(_O, 1)} < 0.025e0 THEN NULL
  WHEN {_uniform(_O, 1)} < 0.05e0
    THEN strftime(o_orderdate, '%Y') || '-X-' || strftime(o_orderdate, '%d')
  ELSE strftime(o_orderdate, '%Y%m%d') END AS Fecha_ID FROM orders""",
    "fault_numbers": f"""
SELECT p_partkey, {_inject("p_retailprice", _uniform(_PK, 1), "-p_retailprice", "0e0")}
    AS p_retailprice,
  {_inject("p_size", _uniform(_PK, 2), "0")} AS p_size FROM part""",
    "fault_labels": f"""
SELECT c_custkey, {_inject(_SEGMENT, _uniform(_C, 1), f"upper({_SEGMENT})",
    f"upper(left({_SEGMENT}, 3)) || '.'", f"replace({_SEGMENT}, 'u', 'ú')",
    f"{_SEGMENT} || ' '")} AS segmento
FROM customer""",
    "union_parts": "SELECT * FROM f_clave",
    "row_shuffle": """
SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders""",
    "impact_rate": f"SELECT {_RATE} FROM ({_sums('f_integro')})",
    "impact_by_month": f"""
SELECT Anio, Mes, {_RATE} FROM ({_sums(
        "(SELECT f.*, Anio, Mes FROM f_integro f JOIN c_tiempo USING (Fecha_ID))", "Anio, Mes"
    )})""",
    "loss_by_cause": f"""
SELECT Tipo_Transaccion, CASE Tipo_Transaccion WHEN 'DEVOLUCION' THEN 'Calidad'
    WHEN 'AJUSTE_INVENTARIO' THEN 'Proceso' ELSE 'Dato' END AS causa, transacciones,
  CAST(c AS DOUBLE) AS costo, {_digits(
      "CAST(c AS DOUBLE) / nullif(CAST(sum(c) OVER () AS DOUBLE), 0)"
  )} AS participacion
FROM (SELECT Tipo_Transaccion, count(*) AS transacciones, {_COST} AS c FROM f_integro
  WHERE Tipo_Transaccion IN ({_list(COST_CLASSES)}) GROUP BY Tipo_Transaccion)""",
    "risk_stores": _worst("c_tienda", "Tienda_ID", "Region, Formato_Tienda"),
    "risk_products": _worst("c_producto", "Producto_ID", "Marca, Segmento"),
    "risk_map": f"""
SELECT Region, Segmento, CAST(ntile(4) OVER (ORDER BY c DESC, Region NULLS LAST,
    Segmento NULLS LAST) AS INT) AS cuartil, {_RATE}
FROM ({_sums('''(SELECT f.*, Region, Segmento FROM f_integro f
  JOIN c_tienda USING (Tienda_ID) JOIN c_producto USING (Producto_ID))''', "Region, Segmento")})""",
}

# The cube's reports are the same ones.
_TEXTS.update(
    {
        f"cube_{name}": _TEXTS[name]
        for name in (
            "impact_rate", "impact_by_month", "loss_by_cause", "risk_stores", "risk_products",
            "risk_map",
        )
    }
)
# So are the fits from states; a sketch has to come as near as its bound.
_TEXTS["state_bounds"] = _TEXTS["outlier_bounds"]
_TEXTS["state_price_avg"] = _TEXTS["price_avg"]
_TEXTS["state_median_price"] = f"SELECT *, true AS dentro_del_limite FROM ({_TEXTS['median_price']})"
_TEXTS["profile_distinct_sketch"] = (
    f"SELECT *, true AS dentro_del_limite FROM ({_TEXTS['profile_distinct_counts']})"
)
_TEXTS["profile_heavy_values"] = """
SELECT Producto_ID, count(*) AS filas FROM fact_ventas WHERE Producto_ID IS NOT NULL
GROUP BY Producto_ID ORDER BY filas DESC, Producto_ID LIMIT 20"""
_TEXTS["versioned_load"] = f"""
SELECT {", ".join(FACT_KEY)}, Ventas_Volumen FROM f_integro WHERE Producto_ID % 3 <> 2
UNION ALL SELECT {", ".join(FACT_KEY)}, Ventas_Volumen FROM f_integro s
WHERE Producto_ID % 3 <> 0 AND NOT EXISTS (
  SELECT 1 FROM f_integro t WHERE t.Producto_ID % 3 <> 2 AND {_SAME})"""


def _with_own_ctes(text: str) -> str:
    """Merge a text that starts with WITH into the common tables it needs."""
    text = text.strip()
    if not text.startswith("WITH "):
        return _select(text)
    merged = _select("SELECT 0 /* " + text + " */")
    common = merged[: merged.index("SELECT 0 /* ")]
    return common.rstrip() + ", " + text[5:] if common else text


ORACLES: dict[str, str] = {name: _with_own_ctes(text) for name, text in _TEXTS.items()}
