"""The data contract of the star schema.

Column names and types of the source files, and of the tables they are loaded
into, must equal those of the data they describe.
"""

from __future__ import annotations

from pyspark.sql import types as T

DATE_DIM = "dim_tiempo"
STORE_DIM = "dim_tienda"
PRODUCT_DIM = "dim_producto"
FACT = "fact_ventas"
DIMENSIONS = (DATE_DIM, STORE_DIM, PRODUCT_DIM)
TABLES = (*DIMENSIONS, FACT)
LOG = "etl_log"

#: Primary key of each dimension.
KEYS = {DATE_DIM: "Fecha_ID", STORE_DIM: "Tienda_ID", PRODUCT_DIM: "Producto_ID"}

#: Natural key of a classified fact row.
FACT_KEY = ("Producto_ID", "Tienda_ID", "Fecha_ID", "Tipo_Transaccion")

#: Key given to facts whose date is unknown.
UNKNOWN_DATE = "19000101"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
    "decimal(10,2)": T.DecimalType(10, 2),
}

_SOURCE_DDL = {
    DATE_DIM: "Fecha_ID string, Fecha string, Anio int, Mes int, Nombre_Mes string, "
    "Numero_Semana int, Trimestre string, Estacionalidad_Factor double",
    STORE_DIM: "Tienda_ID int, Region string, Formato_Tienda string, "
    "Atractivo_Factor double",
    PRODUCT_DIM: "Producto_ID int, Marca string, Segmento string, Sabor string, "
    "Tipo_Envase string, Tamano string, Precio_Base double, Demanda_Factor double",
    FACT: "Tienda_ID int, Producto_ID int, Fecha_ID string, "
    "Distribucion_Numerica double, Distribucion_Ponderada double, Precio double, "
    "Out_Of_Stock_Flag int, Ventas_Volumen int, Ventas_Valor double",
}

_TARGET_DDL = {
    DATE_DIM: "Fecha_ID string, Fecha date, Anio int, Mes int, Nombre_Mes string, "
    "Numero_Semana int, Trimestre string, Estacionalidad_Factor double",
    STORE_DIM: "Tienda_ID int, Region string, Formato_Tienda string, "
    "Atractivo_Factor double, Region_original string",
    PRODUCT_DIM: _SOURCE_DDL[PRODUCT_DIM],
    FACT: "Producto_ID int, Tienda_ID int, Fecha_ID string, "
    "Distribucion_Numerica double, Distribucion_Ponderada double, "
    "Precio double not null, Out_Of_Stock_Flag int, Ventas_Volumen int, "
    "Ventas_Valor double, Fecha_ID_original string, "
    "Precio_Promedio_Producto double not null, Tipo_Transaccion string not null, "
    "Es_Devolucion boolean not null, Es_Ajuste boolean not null, "
    "Es_Venta_Normal boolean not null, Es_Anomalo boolean not null, "
    "Precio_Original double, Ventas_Valor_Original double",
}

#: Table each cleaned table is loaded into.
TARGET_NAMES = {
    PRODUCT_DIM: "tbl_producto",
    STORE_DIM: "tbl_tienda",
    DATE_DIM: "tbl_fecha",
    FACT: "tbl_facts",
}

LOAD_LOG = (
    "Ejecucion_ID string, Tabla_Origen string, Tabla_Destino string, "
    "Registros_Procesados long, Registros_Insertados long, "
    "Registros_Existentes long, Registros_Duplicados long, Registros_Errores long, "
    "Duracion_Segundos decimal(10,2), Estado string, Observaciones string, "
    "Mensaje string, Usuario string, Fecha_Inicio timestamp, Fecha_Fin timestamp"
)

ERROR_DETAIL = (
    "Ejecucion_ID string, Tabla string, Tipo_Error string, Descripcion string, "
    "Registros_Afectados long, Datos_Ejemplo string, Fecha_Error timestamp"
)

#: Longest texts the target tables take.
LENGTHS = {
    **dict.fromkeys(("Marca", "Segmento", "Sabor", "Tipo_Envase"), 100),
    **dict.fromkeys(("Region", "Region_original", "Tabla_Origen", "Tabla_Destino"), 100),
    **dict.fromkeys(("Tamano", "Formato_Tienda", "Fecha_ID", "Nombre_Mes"), 50),
    **dict.fromkeys(("Fecha_ID_original", "Tipo_Transaccion"), 50),
    "Trimestre": 10,
    "Estado": 20,
    "Usuario": 100,
}

#: Allowed values of the load log's ``Estado``.
LOAD_STATES = ("EXITOSO", "ERROR", "ADVERTENCIA", "EN_PROCESO")

#: Allowed values of the error detail's ``Tipo_Error``.
ERROR_TYPES = ("DUPLICADO", "INTEGRIDAD", "VALIDACION", "SISTEMA")


def source_schema(table: str) -> T.StructType:
    """Schema of a source file; a name outside ``TABLES`` is an error."""
    return _schema(_SOURCE_DDL, table)


def target_schema(table: str) -> T.StructType:
    """Schema of the table a cleaned table is loaded into, or of the load log."""
    return _schema({**_TARGET_DDL, LOG: LOAD_LOG}, table)


def _schema(texts: dict[str, str], table: str) -> T.StructType:
    """Schema from its text; unlike Spark's own parser this needs no session."""
    if table not in texts:
        raise ValueError(f"no schema for {table!r}; known tables: {', '.join(texts)}")
    fields = []
    for text in texts[table].split(", "):
        name, kind, *rest = text.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], rest != ["not", "null"]))
    return T.StructType(fields)
