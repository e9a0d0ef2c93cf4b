"""The registered queries: every operator over the given tables.

Each takes (spark, sf_dir) and returns a DataFrame. Money and averages whose
last digits depend on the order of summation are rounded by ``_digits``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alambique.functions import dates, rules, text
from alambique.functions.draws import uniform
from alambique.operators import integrity, load, profile, stats, synth
from alambique.operators.bloom import FALSE_POSITIVES, prune
from alambique.operators.dedup import duplicate_keys, keep_one
from alambique.operators.joins import skew_join
from alambique.operators.quantiles import exact_quantile, exact_quantiles
from alambique.plans import cleaning, reports
from alambique.plans.cube import Cube
from alambique.plans.fit_state import RANK_ERROR, FitState, rank_errors
from alambique.plans.loading import run_load
from alambique.plans.star_views import VIEW_REGIONS, star, table, view
from alambique.plans.versioned_load import VersionedTarget
from alambique.schemas import (
    DATE_DIM,
    FACT,
    FACT_KEY,
    KEYS,
    LOG,
    PRODUCT_DIM,
    STORE_DIM,
    TARGET_NAMES,
    target_schema,
)
from alambique.session import tune
from alambique.sinks import export
from alambique.sources import files
from alambique.storage import materialize_all, materialize_measured, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Options of the queries that plant faults.
SEED, FAULTS = 7, 0.05


def query(run: Query) -> Query:
    """Register a query; it runs in a session tuned for the operators."""

    @wraps(run)
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(tune(spark), sf_dir)

    QUERIES[run.__name__] = tuned
    return tuned


def _digits(df: DataFrame, *columns: str, scale: int = 10_000) -> DataFrame:
    rounded = {c: F.floor(F.col(c) * scale + 0.5) / float(scale) for c in columns}
    return df.withColumns(rounded)


def _day(column: str):
    """A date as text, the same in both engines."""
    return F.date_format(column, "yyyy-MM-dd")


def _text_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("Fecha", F.col("Fecha").cast("string"))


def _clean_dims(spark, sf_dir):
    """Clean dimensions as the tables they are to what follows."""
    clean = {
        DATE_DIM: cleaning.clean_dim_tiempo(view(spark, sf_dir, DATE_DIM)),
        STORE_DIM: cleaning.clean_dim_tienda(
            view(spark, sf_dir, STORE_DIM), VIEW_REGIONS
        ),
        PRODUCT_DIM: cleaning.clean_dim_producto(view(spark, sf_dir, PRODUCT_DIM)),
    }
    return {name: m.df for name, m in materialize_all(clean).items()}


def _clean_star(spark, sf_dir):
    return cleaning.clean_all(star(spark, sf_dir), region_labels=VIEW_REGIONS)


# -- Sources and sinks --------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    fact = view(spark, sf_dir, FACT)
    export.export_to_csv(fact, path, compression="gzip")
    return files.load_table(spark, FACT, path)


@query
def csv_quarantine(spark, sf_dir):
    lines = spark.sql(
        """SELECT concat_ws(',', l_suppkey, l_partkey, date_format(l_shipdate, 'yyyyMMdd'),
             '0.5', '0.5', CAST(l_linenumber AS STRING), '0',
             CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'abc'
                  WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN '2.0'
                  ELSE CAST(CAST(l_quantity AS INT) AS STRING) END,
             CASE WHEN l_linestatus = 'O' AND l_linenumber = 3 THEN NULL ELSE '1.5' END) AS line
           FROM {lineitem}""",
        lineitem=table(spark, sf_dir, "lineitem"),
    )
    path = scratch_path(spark, "lines")
    lines.write.options(lineSep="\n").text(path)
    # No header in these files: a header option would drop the first line of each.
    read = files.load_table(spark, FACT, path, keep_corrupt=True, header=False)
    _, bad = files.split_corrupt(read)
    return bad.select(files.CORRUPT, "Tienda_ID", "Producto_ID", "Ventas_Volumen")


@query
def load_star(spark, sf_dir):
    base = scratch_path(spark, "star")
    for name, df in star(spark, sf_dir).items():
        export.export_to_csv(df, f"{base}/{files.PREFIX}_{name}.csv")
    loaded = files.load_all_tables(spark, base)
    keys = {**KEYS, FACT: "Fecha_ID"}
    counts = [
        df.agg(
            F.lit(name).alias("tabla"),
            F.count("*").alias("registros"),
            F.count_distinct(keys[name]).alias("claves"),
        )
        for name, df in loaded.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def load_star_missing(spark, sf_dir):
    """A folder in which one table's file is missing: the others are loaded."""
    base = scratch_path(spark, "partial-star")
    tables = star(spark, sf_dir)
    for name in (DATE_DIM, STORE_DIM, FACT):
        export.export_to_csv(tables[name], f"{base}/{files.PREFIX}_{name}.csv")
    return files.table_counts(files.load_all_tables(spark, base))


@query
def export_append(spark, sf_dir):
    """Overwritten twice, then appended to, and read back."""
    path = scratch_path(spark, "append")
    fact = view(spark, sf_dir, FACT)
    returned = fact.filter(F.col("Ventas_Volumen") < 0)
    for rows, mode in ((returned, "overwrite"), (fact, "overwrite"), (returned, "append")):
        export.export_to_csv(rows, path, mode=mode)
    back = files.load_table(spark, FACT, path)
    return back.groupBy("Producto_ID").agg(
        F.count("*").alias("filas"), F.sum("Ventas_Volumen").alias("volumen")
    )


@query
def table_counts(spark, sf_dir):
    return files.table_counts(star(spark, sf_dir))


@query
def export_star(spark, sf_dir):
    clean, base = _clean_star(spark, sf_dir), scratch_path(spark, "export")
    done = export.export_multiple_tables_to_csv(clean, base)
    rows = []
    for name, outcome in done.items():
        back = spark.read.schema(target_schema(name)).csv(f"{base}/{name}", header=True)
        rows.append(
            back.agg(
                F.lit(name).alias("tabla"),
                F.lit(outcome.exito).alias("exito"),
                F.lit(outcome.filas).cast("long").alias("filas_escritas"),
                F.count("*").alias("filas_leidas"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


@query
def export_stats(spark, sf_dir):
    tables, base = star(spark, sf_dir), scratch_path(spark, "stats")
    tables["sin_filas"] = tables[STORE_DIM].filter(F.col("Tienda_ID") < 0)
    done = export.export_multiple_tables_to_csv(tables, base)
    name = F.element_at(F.split("destino", "/"), -1).alias("tabla")
    shown = ["exito", "filas", "modo", "archivos", "compresion", "intentos"]
    return export.export_stats(spark, done.values()).select(name, *shown)


@query
def parquet_partitioned(spark, sf_dir):
    fact = cleaning.with_date_key(view(spark, sf_dir, FACT)).withColumns(
        {
            "Anio": F.substring("Fecha_ID", 1, 4).cast("int"),
            "Mes": F.substring("Fecha_ID", 5, 2).cast("int"),
        }
    )
    path = scratch_path(spark, "by-month")
    export.export_to_parquet(fact, path, partition_by=["Anio", "Mes"])
    back = spark.read.schema(fact.schema).parquet(path)
    return back.groupBy("Anio", "Mes").agg(
        F.count("*").alias("filas"), F.sum("Ventas_Volumen").alias("volumen")
    )


# -- Profiling ----------------------------------------------------------------


@query
def profile_describe(spark, sf_dir):
    return _digits(profile.describe(view(spark, sf_dir, FACT)), "media", "desviacion")


@query
def profile_nulls(spark, sf_dir):
    return profile.null_counts(view(spark, sf_dir, FACT))


@query
def profile_key_pattern(spark, sf_dir):
    return profile.key_patterns(view(spark, sf_dir, FACT))


@query
def profile_examples(spark, sf_dir):
    return profile.key_examples(view(spark, sf_dir, FACT))


@query
def profile_distinct(spark, sf_dir):
    return profile.distinct_values(view(spark, sf_dir, DATE_DIM), "Nombre_Mes")


@query
def profile_distinct_counts(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    return profile.distinct_counts(fact, "Tienda_ID", "Producto_ID", "Fecha_ID")


@query
def profile_freq(spark, sf_dir):
    return profile.frequencies(view(spark, sf_dir, STORE_DIM), "Region", by_value=True)


@query
def scenario_shares(spark, sf_dir):
    return profile.scenario_shares(view(spark, sf_dir, FACT))


@query
def dup_keys(spark, sf_dir):
    found = [
        duplicate_keys(view(spark, sf_dir, name), key).select(
            F.lit(name).alias("tabla"), F.col(key).cast("string").alias("clave"), "filas"
        )
        for name, key in KEYS.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(
        star(spark, sf_dir), region_labels=VIEW_REGIONS
    )


@query
def cleaning_summary(spark, sf_dir):
    return cleaning.summary(cleaning_report(spark, sf_dir))


# -- Scalar functions ---------------------------------------------------------


@query
def date_key_clean(spark, sf_dir):
    key = F.col("Fecha_ID")
    clean = dates.trimmed_key(key)
    return view(spark, sf_dir, FACT).select(
        key,
        clean.alias("clave"),
        dates.is_date_key(clean).alias("valida"),
        dates.key_class(clean).alias("clase"),
    )


@query
def date_parse_multi(spark, sf_dir):
    written = spark.sql(
        """SELECT o_orderkey, CASE o_orderkey % 8
             WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
             WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy')
             WHEN 2 THEN date_format(o_orderdate, 'MM/dd/yyyy')
             WHEN 3 THEN date_format(o_orderdate, 'yyyyMMdd')
             WHEN 4 THEN date_format(o_orderdate, 'yyyy/MM/dd')
             WHEN 5 THEN date_format(o_orderdate, 'dd-MM-yyyy')
             WHEN 6 THEN 'FECHA_INCORRECTA' END AS texto
           FROM {orders}""",
        orders=table(spark, sf_dir, "orders"),
    )
    return written.withColumn(
        "fecha", dates.parse_date(F.col("texto")).cast("string")
    )


@query
def dim_tiempo_clean(spark, sf_dir):
    return _text_dates(cleaning.clean_dim_tiempo(view(spark, sf_dir, DATE_DIM)))


@query
def dim_tiempo_unknown(spark, sf_dir):
    dates_ = cleaning.clean_dim_tiempo(
        view(spark, sf_dir, DATE_DIM), add_unknown_date=True
    )
    return _digits(
        _text_dates(dates_), "Estacionalidad_Factor", scale=1_000_000
    )


@query
def dim_tienda_clean(spark, sf_dir):
    return cleaning.clean_dim_tienda(view(spark, sf_dir, STORE_DIM), VIEW_REGIONS)


@query
def dim_producto_clean(spark, sf_dir):
    return cleaning.clean_dim_producto(view(spark, sf_dir, PRODUCT_DIM))


@query
def month_normalize(spark, sf_dir):
    return view(spark, sf_dir, DATE_DIM).select(
        "Nombre_Mes", text.month_label(F.col("Nombre_Mes")).alias("mes")
    )


@query
def region_normalize(spark, sf_dir):
    return view(spark, sf_dir, STORE_DIM).select(
        "Tienda_ID",
        "Region",
        text.region_label(F.col("Region"), VIEW_REGIONS).alias("region_normal"),
    )


@query
def accent_fold(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.fold_accents(F.col("text")).alias("texto"))


@query
def fact_date_sentinel(spark, sf_dir):
    keyed = cleaning.with_date_key(view(spark, sf_dir, FACT))
    return keyed.select("Producto_ID", "Tienda_ID", "Fecha_ID", "Fecha_ID_original")


@query
def classify_tx(spark, sf_dir):
    return cleaning.with_class(view(spark, sf_dir, FACT)).select(
        "Producto_ID", "Tienda_ID", "Ventas_Volumen", "Tipo_Transaccion", *rules.FLAGS
    )


@query
def price_impute(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    priced = cleaning.with_average_price(fact, cleaning.fit_prices(fact))
    columns = ["Precio_Original", "Precio", "Precio_Promedio_Producto"]
    fixed = cleaning.with_repaired_price(priced)
    return _digits(fixed.select("Producto_ID", "Ventas_Volumen", *columns), *columns)


@query
def value_recalc(spark, sf_dir):
    fact = cleaning.with_class(view(spark, sf_dir, FACT))
    return cleaning.with_value(fact).select(
        "Producto_ID", "Tienda_ID", "Ventas_Valor", "Ventas_Valor_Original"
    )


@query
def value_discrepancy(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    repaired = cleaning.repair_fact(fact, cleaning.fit_prices(fact))
    new, old = F.col("Ventas_Valor"), F.col("Ventas_Valor_Original")
    changed = repaired.filter(rules.value_changed(new, old))
    return _digits(
        changed.select("Producto_ID", "Tienda_ID", "Fecha_ID", new, old), "Ventas_Valor"
    )


@query
def season_factor(spark, sf_dir):
    key = F.col("Fecha_ID")
    fact = view(spark, sf_dir, FACT).select(key, dates.season_of_key(key).alias("factor"))
    return _digits(fact, "factor", scale=1_000_000)


@query
def calendar_dim(spark, sf_dir):
    days = synth.calendar(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return _digits(_text_dates(days), "Estacionalidad_Factor", scale=1_000_000)


# -- Fact cleaning ------------------------------------------------------------

_COMPUTED = ("Precio", "Precio_Promedio_Producto", "Ventas_Valor")


@query
def fact_clean(spark, sf_dir):
    clean = cleaning.clean_fact_ventas(view(spark, sf_dir, FACT))
    return _digits(clean, *_COMPUTED)


@query
def fact_clean_strict(spark, sf_dir):
    clean = cleaning.clean_fact_ventas(
        view(spark, sf_dir, FACT), remove_null_precio=True, remove_null_volumen=True
    )
    return _digits(clean, *_COMPUTED)


@query
def fact_clean_outliers(spark, sf_dir):
    clean = cleaning.clean_fact_ventas(
        view(spark, sf_dir, FACT),
        recalculate_valor=False,
        remove_outliers=True,
        outlier_std_threshold=1.5,
    )
    return _digits(clean, *_COMPUTED)


@query
def fact_clean_ri(spark, sf_dir):
    return _digits(_clean_star(spark, sf_dir)[FACT], *_COMPUTED)


# -- Aggregates and joins -----------------------------------------------------


@query
def price_avg(spark, sf_dir):
    averages = stats.average_prices(view(spark, sf_dir, FACT))
    return _digits(averages, "Precio_Promedio_Producto")


@query
def price_avg_join(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    joined = cleaning.with_average_price(fact, cleaning.fit_prices(fact))
    return _digits(
        joined.select("Tienda_ID", "Producto_ID", "Fecha_ID", "Precio_Promedio_Producto"),
        "Precio_Promedio_Producto",
    )


@query
def price_missing_products(spark, sf_dir):
    products = stats.product_profile(view(spark, sf_dir, FACT))
    missing = F.col("Precio_Promedio_Producto").isNull() | F.col("Producto_ID").isNull()
    return products.agg(F.count_if(missing).alias("productos_sin_precio"))


@query
def median_price(spark, sf_dir):
    priced = view(spark, sf_dir, FACT).filter(F.col("Precio") > 0)
    found = exact_quantiles(priced, "Precio", [0.5])
    return spark.createDataFrame(
        [(found.rows, found.values[0.5])], "filas long, mediana double"
    )


@query
def quantiles_value(spark, sf_dir):
    found = exact_quantiles(
        view(spark, sf_dir, FACT), "Ventas_Valor", (0.01, 0.25, 0.5, 0.75, 0.99)
    )
    rows = [(found.rows, value, q) for q, value in found.values.items()]
    return spark.createDataFrame(rows, "filas long, valor double, cuantil double")


@query
def dist_impute(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    median = exact_quantile(fact, "Distribucion_Ponderada")
    filled = cleaning.impute("Distribucion_Ponderada", median)
    return fact.select(
        "Producto_ID",
        "Tienda_ID",
        F.col("Distribucion_Ponderada").alias("original"),
        filled.alias("Distribucion_Ponderada"),
    )


@query
def outlier_bounds(spark, sf_dir):
    bounds = stats.bounds_frame(view(spark, sf_dir, FACT), "Ventas_Volumen", 3.0)
    return _digits(bounds, *bounds.columns)


@query
def outlier_filter(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    bounds = stats.outlier_bounds(fact, "Ventas_Volumen", 1.5)
    kept = fact.filter(stats.within_bounds(F.col("Ventas_Volumen"), bounds))
    return kept.select("Producto_ID", "Tienda_ID", "Fecha_ID", "Ventas_Volumen")


@query
def tx_distribution(spark, sf_dir):
    classed = cleaning.with_class(view(spark, sf_dir, FACT))
    return profile.frequencies(classed, "Tipo_Transaccion")


@query
def dedup_key(spark, sf_dir):
    kept = keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return kept.withColumn("l_shipdate", _day("l_shipdate"))


@query
def ri_enforce(spark, sf_dir):
    return integrity.enforce(view(spark, sf_dir, FACT), _clean_dims(spark, sf_dir))


@query
def ri_orphans(spark, sf_dir):
    return integrity.orphan_counts(view(spark, sf_dir, FACT), _clean_dims(spark, sf_dir))


@query
def ri_orphan_rows(spark, sf_dir):
    found = integrity.orphans(view(spark, sf_dir, FACT), _clean_dims(spark, sf_dir))
    return found.select("Producto_ID", "Tienda_ID", "Fecha_ID", "clave_huerfana")


@query
def dim_lookup(spark, sf_dir):
    dims = _clean_dims(spark, sf_dir)
    found = synth.with_factors(
        view(spark, sf_dir, FACT), dims[STORE_DIM], dims[PRODUCT_DIM]
    )
    factors = ["Atractivo_Factor", "Demanda_Factor", "Precio_Base"]
    return found.select("Producto_ID", "Tienda_ID", *factors)


# -- Load ---------------------------------------------------------------------


def _fact_load(spark, sf_dir):
    """Staged facts and the target so far: a third of the products each way.

    Products tell them apart, so facts of any date are staged, those of the
    unknown date too. A third of the staged facts are in the target already, and
    some are staged twice.
    """
    fact = cleaning.with_class(cleaning.with_date_key(view(spark, sf_dir, FACT)))
    group, product = F.col("Producto_ID") % 3, F.col("Producto_ID")
    target = fact.filter(group != 2)
    staged = fact.filter(F.coalesce(group != 0, F.lit(True)))
    staged = staged.unionByName(staged.filter(product % 100 == 0))
    # Derived from the fact once, however often a load reads it.
    return materialize_measured(staged, "staged-facts"), target


def _dim_loads(spark, sf_dir):
    """Staged dimension, its target and its key: members known so far."""
    known = {
        PRODUCT_DIM: F.col("Tipo_Envase") != "Lata",
        STORE_DIM: F.col("Region") != "Asia",
        DATE_DIM: F.col("Fecha_ID") < "20000101",
    }
    dims = _clean_dims(spark, sf_dir)
    return {n: (dims[n], dims[n].filter(c), (KEYS[n],)) for n, c in known.items()}


def _keys_of(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(
        F.lit(name).alias("tabla"), F.col(KEYS[name]).cast("string").alias("clave")
    )


@query
def load_dim_new(spark, sf_dir):
    loads = _dim_loads(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [_keys_of(load.new_rows(*parts), name) for name, parts in loads.items()],
    )


@query
def load_dim_existing(spark, sf_dir):
    loads = _dim_loads(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [_keys_of(load.existing_rows(*parts), name) for name, parts in loads.items()],
    )


@query
def load_fact_new(spark, sf_dir):
    staging, target = _fact_load(spark, sf_dir)
    return load.new_rows(staging, target, FACT_KEY, prune_by="Fecha_ID")


@query
def load_fact_first(spark, sf_dir):
    staging, target = _fact_load(spark, sf_dir)
    return load.new_rows(staging, target, FACT_KEY, load.KEEP_FIRST, "Fecha_ID")


@query
def staging_remainder(spark, sf_dir):
    staging, target = _fact_load(spark, sf_dir)
    loaded = target.unionByName(load.new_rows(staging, target, FACT_KEY, prune_by="Fecha_ID"))
    rest = load.purge_loaded(staging, loaded, FACT_KEY)
    return rest.select(*FACT_KEY, "Ventas_Volumen")


@query
def load_key_filter(spark, sf_dir):
    """How many target rows the staged keys' filter lets pass to the shuffle."""
    staged, target = _fact_load(spark, sf_dir)
    keyed = target.select(*FACT_KEY).dropna()
    passed = prune(keyed, staged, FACT_KEY)
    known = staged.df.select(*FACT_KEY).dropna().distinct()
    matches = skew_join(keyed, known, FACT_KEY, "left_semi")
    kept = skew_join(passed, known, FACT_KEY, "left_semi")
    frames = {"filas": keyed, "pasan": passed, "coinciden": matches, "quedan": kept}
    named = [df.select(F.lit(name).alias("tipo")) for name, df in frames.items()]
    counts = reduce(DataFrame.union, named).agg(
        *[F.count_if(F.col("tipo") == name).alias(name) for name in frames]
    )
    others = F.col("filas") - F.col("coinciden")
    extra = F.col("pasan") - F.col("coinciden")
    return counts.select(
        "filas",
        "coinciden",
        (F.col("coinciden") - F.col("quedan")).alias("perdidas"),
        (extra <= others * FALSE_POSITIVES).alias("dentro_del_limite"),
    )


@query
def load_log(spark, sf_dir):
    loads = _dim_loads(spark, sf_dir)
    loads[FACT] = (*_fact_load(spark, sf_dir), FACT_KEY)
    entries = []
    for name, (staging, target, keys) in loads.items():
        prune = "Fecha_ID" if name == FACT else None
        marked = load.mark_staging(staging, target, keys, prune)
        counts = load.load_counts(marked, keys, load.KEEP_FIRST)
        entries.append(
            load.log_entry(counts, f"clean_{name}", TARGET_NAMES[name], "keep_first")
        )
    return reduce(DataFrame.unionByName, entries)


@query
def conform_fact(spark, sf_dir):
    fact = view(spark, sf_dir, FACT)
    fit = cleaning.FactFit(
        cleaning.FactOptions(), cleaning.fit_prices(fact), None, None
    )
    reordered = cleaning.apply_fact(fact, fit)
    reordered = reordered.select(*sorted(reordered.columns))
    return _digits(cleaning.conform(reordered, FACT), *_COMPUTED)


def _dimension_run(spark, sf_dir):
    """The log of a run that loads the clean dimensions into new targets."""
    dims, base = _clean_dims(spark, sf_dir), scratch_path(spark, "targets")
    targets = {name: f"{base}/{name}" for name in dims}
    return run_load(dims, targets, f"{base}/log")


@query
def contract_violations(spark, sf_dir):
    """Rules broken in all tables before cleaning, in the clean fact, in the log."""
    raw, clean = star(spark, sf_dir), _clean_star(spark, sf_dir)
    checked = {
        **{name: (df, name) for name, df in raw.items()},
        f"{FACT} limpio": (clean[FACT], FACT),
        LOG: (_dimension_run(spark, sf_dir), LOG),
    }
    found = [
        load.contract_violations(df, contract).select(F.lit(name).alias("tabla"), "*")
        for name, (df, contract) in checked.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def error_detail(spark, sf_dir):
    (staged, _), dims = _fact_load(spark, sf_dir), _clean_dims(spark, sf_dir)
    staging = staged.df
    sample = list(FACT_KEY)
    missing = integrity.orphans(staging, dims)
    repeated = duplicate_keys(staging.dropna(subset=sample), sample)
    unpriced = staging.filter(F.col("Precio").isNull())
    broken = F.concat(F.col("clave_huerfana"), F.lit(" sin dimensión"))
    errors = [
        load.error_rows(missing, "INTEGRIDAD", broken, sample),
        load.error_rows(repeated, "DUPLICADO", F.lit("clave repetida"), sample),
        load.error_rows(unpriced, "VALIDACION", F.lit("Precio nulo"), sample),
    ]
    return load.error_detail("clean_fact_ventas", errors, sample)


# -- Planted faults -----------------------------------------------------------


@query
def fault_nulls(spark, sf_dir):
    price = F.col("o_totalprice")
    draw = uniform(F.col("o_orderkey"), SEED, 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", synth.inject(price, draw, [(FAULTS, None)]).alias("o_totalprice")
    )


@query
def fault_keys(spark, sf_dir):
    key = dates.date_key(F.col("o_orderdate"))
    broken = F.concat(F.substring(key, 1, 4), F.lit("-X-"), F.substring(key, 7, 2))
    faults = [(FAULTS / 2, None), (FAULTS / 2, broken)]
    draw = uniform(F.col("o_orderkey"), SEED, 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", synth.inject(key, draw, faults).alias("Fecha_ID")
    )


@query
def fault_numbers(spark, sf_dir):
    part, price, size = F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size")
    prices = [(FAULTS, -price), (FAULTS, F.lit(0.0))]
    sizes = [(FAULTS, F.lit(0))]
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        synth.inject(price, uniform(part, SEED, 1), prices).alias("p_retailprice"),
        synth.inject(size, uniform(part, SEED, 2), sizes).alias("p_size"),
    )


@query
def fault_labels(spark, sf_dir):
    name = F.initcap("c_mktsegment")
    faults = [
        (FAULTS, F.upper(name)),
        (FAULTS, text.abbreviate(name)),
        (FAULTS, F.replace(name, F.lit("u"), F.lit("ú"))),
        (FAULTS, F.concat(name, F.lit(" "))),
    ]
    draw = uniform(F.col("c_custkey"), SEED, 1)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", synth.inject(name, draw, faults).alias("segmento")
    )


@query
def union_parts(spark, sf_dir):
    """Months of the fact table kept as separate frames, appended again."""
    fact = cleaning.with_date_key(view(spark, sf_dir, FACT))
    unknown = F.col("Fecha_ID") == "19000101"
    late = fact.filter(unknown).select(*reversed(fact.columns))
    return synth.append_frames([fact.filter(~unknown), late])


@query
def row_shuffle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderdate", _day("o_orderdate"))
    return synth.shuffle_rows(orders, "o_orderkey", SEED)


# -- Reports ------------------------------------------------------------------


@query
def impact_rate(spark, sf_dir):
    return _digits(reports.impact_rate(_clean_star(spark, sf_dir)), "tasa_impacto")


@query
def impact_by_month(spark, sf_dir):
    return _digits(reports.impact_by_month(_clean_star(spark, sf_dir)), "tasa_impacto")


@query
def loss_by_cause(spark, sf_dir):
    return _digits(reports.loss_by_cause(_clean_star(spark, sf_dir)), "participacion")


@query
def risk_stores(spark, sf_dir):
    return _digits(reports.risk_stores(_clean_star(spark, sf_dir)), "tasa_impacto")


@query
def risk_products(spark, sf_dir):
    return _digits(reports.risk_products(_clean_star(spark, sf_dir)), "tasa_impacto")


@query
def risk_map(spark, sf_dir):
    return _digits(reports.risk_map(_clean_star(spark, sf_dir)), "tasa_impacto")


# -- Versions and the cube ----------------------------------------------------


@query
def versioned_load(spark, sf_dir):
    """The target after two drains: facts of a product group that both bring, and of
    the second one only those with a new key."""
    fact = cleaning.conform(_clean_star(spark, sf_dir)[FACT], FACT)
    group = F.col("Producto_ID") % 3
    base = scratch_path(spark, "versions")
    target = VersionedTarget(spark, f"{base}/target")
    for name, part in {"first": fact.filter(group != 2), "second": fact.filter(group != 0)}.items():
        part.write.parquet(f"{base}/{name}")
        target.drain(f"{base}/{name}")
    return target.read().select(*FACT_KEY, "Ventas_Volumen")


def _cube(spark, sf_dir):
    """The cube after a first load and one more, and the dimensions."""
    clean = _clean_star(spark, sf_dir)
    cube = Cube(spark, scratch_path(spark, "cube"))
    first = F.col("Producto_ID") % 3 != 2
    cube.add(clean[FACT].filter(first))
    cube.add(clean[FACT].filter(~first))
    return cube, clean


@query
def cube_impact_rate(spark, sf_dir):
    cube, _ = _cube(spark, sf_dir)
    return _digits(cube.impact_rate(), "tasa_impacto")


@query
def cube_impact_by_month(spark, sf_dir):
    cube, dims = _cube(spark, sf_dir)
    return _digits(cube.impact_by_month(dims), "tasa_impacto")


@query
def cube_loss_by_cause(spark, sf_dir):
    cube, _ = _cube(spark, sf_dir)
    return _digits(cube.loss_by_cause(), "participacion")


@query
def cube_risk_stores(spark, sf_dir):
    cube, dims = _cube(spark, sf_dir)
    return _digits(cube.risk_stores(dims), "tasa_impacto")


@query
def cube_risk_products(spark, sf_dir):
    cube, dims = _cube(spark, sf_dir)
    return _digits(cube.risk_products(dims), "tasa_impacto")


@query
def cube_risk_map(spark, sf_dir):
    cube, dims = _cube(spark, sf_dir)
    return _digits(cube.risk_map(dims), "tasa_impacto")


def _fit_state(spark, sf_dir):
    """States of all months; one of them was first measured with other volumes."""
    fact, month = view(spark, sf_dir, FACT), F.substring("Fecha_ID", 1, 6)
    one = F.coalesce(month == "199502", F.lit(False))
    state = FitState(spark, scratch_path(spark, "fit-state"))
    state.update(fact.withColumn("Ventas_Volumen", F.when(one, 9).otherwise(F.col("Ventas_Volumen"))))
    state.update(fact.filter(one))
    return state


@query
def state_bounds(spark, sf_dir):
    bounds = _fit_state(spark, sf_dir).bounds_frame(3.0)
    return _digits(bounds, *bounds.columns)


@query
def state_price_avg(spark, sf_dir):
    return _digits(_fit_state(spark, sf_dir).average_prices(), "Precio_Promedio_Producto")


@query
def state_median_price(spark, sf_dir):
    """The exact median, and whether the sketches' median is as near as stated."""
    priced = view(spark, sf_dir, FACT).filter(F.col("Precio") > 0)
    found = exact_quantiles(priced, "Precio", [0.5])
    errors = rank_errors(priced, "Precio", _fit_state(spark, sf_dir).price_quantiles([0.5]))
    return errors.select(
        F.lit(found.rows).cast("long").alias("filas"),
        F.lit(found.values[0.5]).cast("double").alias("mediana"),
        (F.col("error") <= RANK_ERROR).alias("dentro_del_limite"),
    )


@query
def profile_distinct_sketch(spark, sf_dir):
    """Exact distinct counts, and whether merged sketches come as near as stated."""
    columns = ["Tienda_ID", "Producto_ID", "Fecha_ID"]
    fact = view(spark, sf_dir, FACT)
    parts = [fact.filter(F.col("Out_Of_Stock_Flag") == flag) for flag in (0, 1)]
    sketches = reduce(DataFrame.union, [profile.distinct_sketches(p, *columns) for p in parts])
    near = profile.sketched_counts(profile.merged_sketches(sketches, *columns), *columns)
    exact = profile.distinct_counts(fact, *columns)
    apart = F.abs(F.col("cerca") - F.col("distintos"))
    return exact.join(near.withColumnRenamed("distintos", "cerca"), "columna").select(
        "columna",
        "distintos",
        (apart <= F.col("distintos") * profile.SKETCH_ERROR).alias("dentro_del_limite"),
    )


@query
def profile_heavy_values(spark, sf_dir):
    return profile.heavy_values(view(spark, sf_dir, FACT), "Producto_ID", 20)
