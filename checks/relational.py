"""Readers, sinks, projections, filters, joins, aggregates, windows and set operations over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import fixed, measures, text
from matchloom.operators import aggregates as A
from matchloom.operators import filters as FL
from matchloom.operators import joins as J
from matchloom.operators import quality as QA
from matchloom.operators import ranking as R
from matchloom.operators import resolve as RS
from matchloom.operators import sets as U
from matchloom.operators import shape as P
from matchloom.plans import bronze
from matchloom.session import scratch_dir
from matchloom.sources import pending, readers, writers
from matchloom.streaming import ingest

from .registry import query, table

# ---- sources ---------------------------------------------------------------------------


@query("S01_pipe_csv", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def _(s, sf):
    path = scratch_dir(s)
    table(s, sf, "customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).option("sep", "|").csv(path)
    return readers.read_pipe_csv(s, path)


@query("S02_catalog_csv", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def _(s, sf):
    path = scratch_dir(s)
    table(s, sf, "nation").select("n_nationkey", "n_name").write.option("header", True).option("sep", ";").csv(path)
    return readers.read_catalog_csv(s, path)


def _documents(s, sf):
    """One multi-line document per nation: envelope with a list of two rows."""
    path = scratch_dir(s)
    body = F.concat(F.lit('{\n "fuente": "x",\n "temporada": '), F.col("n_nationkey").cast("string"), F.lit(',\n "data": [{"equipo": "'), "n_name",
                    F.lit('", "url": ""},\n {"equipo": "B '), "n_name", F.lit('", "url": "u"}]\n}'))
    table(s, sf, "nation").select("n_nationkey", body.alias("value")).write.partitionBy("n_nationkey").text(path)
    return path


@query("S03_json_document", "SELECT 'x' AS fuente, CAST(n_nationkey AS BIGINT) AS temporada, 2 AS n FROM nation")
def _(s, sf):
    docs = readers.read_json_document(s, _documents(s, sf) + "/*", "fuente string, temporada bigint, data array<struct<equipo:string,url:string>>")
    return docs.select("fuente", "temporada", F.size("data").alias("n"))


@query("S04_json_rows", "SELECT n_name AS equipo, '' AS url FROM nation UNION ALL SELECT 'B ' || n_name, 'u' FROM nation")
def _(s, sf):
    return readers.read_json_rows(s, _documents(s, sf) + "/*")


@query("S05_parquet", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(s, sf):
    return readers.read_parquet(s, f"{sf}/orders.parquet").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("S06_table_or_nothing", "SELECT n_nationkey, n_name, 1 AS missing_is_none FROM nation")
def _(s, sf):
    gone = readers.read_table(s, f"{sf}/no_such_table.parquet") is None and readers.read_table(s, "no_such_table") is None
    return readers.read_table(s, f"{sf}/nation.parquet").select("n_nationkey", "n_name", F.lit(int(gone)).alias("missing_is_none"))


def _landed(s, sf):
    """Events written by type, and a registry in which two types are pending."""
    base = scratch_dir(s)
    table(s, sf, "events").withColumn("kind", F.col("event_type")).write.partitionBy("kind").parquet(base)
    kinds = table(s, sf, "events").select("event_type").distinct()
    registry = kinds.select(
        F.abs(F.xxhash64("event_type")).alias("id"), F.lit("eventos").alias("entidad"), F.lit("INCREMENTAL").alias("modoejecucion"),
        F.lit("2024").alias("periodo"), F.concat(F.lit(base + "/kind="), "event_type").alias("rutaraw"),
        F.when(F.col("event_type").isin("click", "view"), "N").otherwise("S").alias("flg_udv"))
    return registry


@query("S07_pending_rows", """SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'view')
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def _(s, sf):
    rows, _todo = pending.read_pending(s, _landed(s, sf), "eventos", "INCREMENTAL", ["user_id"], loaded="ts")
    return rows.select("event_id", "user_id", "event_type")


@query("S07_acknowledge", "SELECT event_type, 'S' AS flg_udv FROM events GROUP BY 1")
def _(s, sf):
    registry = _landed(s, sf)
    done = pending.acknowledge(registry, pending.pending_paths(registry, "eventos", "INCREMENTAL"))
    return done.select(F.regexp_extract("rutaraw", "kind=(.*)$", 1).alias("event_type"), "flg_udv")


@query("S08_year_folders", "SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1")
def _(s, sf):
    base = scratch_dir(s)
    for y in (1996, 1997, 1999):
        table(s, sf, "orders").filter(F.year("o_orderdate") == y).write.parquet(f"{base}/stg/{y}/curated")
    found = s.read.parquet(*readers.discover_year_paths(s, base, 1995, 1999))
    return found.groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("S09_files_of_year", "SELECT DISTINCT 'partidos_' || year(o_orderdate) || '.csv' AS archivo FROM orders WHERE year(o_orderdate) = 1997")
def _(s, sf):
    files = table(s, sf, "orders").select(F.concat(F.lit("partidos_"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("archivo")).distinct()
    return readers.filter_files_by_year(files, 1997)


@query("S10_resolved_folders", """SELECT modo, CAST(y AS INT) AS y, count(*) AS n, modo || '/' || destino AS destino FROM orders JOIN (VALUES ('HISTORICO', 1996, 'rdv/pedidos/stg/1996/curated'), ('REPROCESO', 1997, 'rdv/pedidos/1997/01/01/data'),
    ('INCREMENTAL', 1995, 'rdv/pedidos/1995/03/04/data')) AS m(modo, y, destino) ON year(o_orderdate) = y GROUP BY 1, 2, 4""")
def _(s, sf):
    """A year of orders is written to the source folder of each mode, read from it, curated to its target and read again."""
    out = None
    for mode, year in (("HISTORICO", 1996), ("REPROCESO", 1997), ("INCREMENTAL", 1995)):
        base = scratch_dir(s)
        source, target = readers.resolve_input_path(mode, "pedidos", year, f"{year}-03-04 10:11:12", "rdv")
        table(s, sf, "orders").filter(F.year("o_orderdate") == year).write.parquet(f"{base}/{source}")
        s.read.parquet(f"{base}/{source}").withColumn("modo", F.lit(mode)).write.parquet(f"{base}/{target}")
        rows = s.read.parquet(f"{base}/{target}").groupBy("modo", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n")).withColumn("destino", F.concat_ws("/", "modo", F.lit(target)))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("S11_params", "SELECT max(CASE WHEN r_name = 'ASIA' THEN n_name END) AS \"ASIA\", max(CASE WHEN r_name = 'EUROPE' THEN n_name END) AS \"EUROPE\" FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(s, sf):
    rows = table(s, sf, "nation").join(table(s, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return readers.read_params(rows, ["ASIA", "EUROPE"], "r_name", "n_name")


@query("S12_year_range", "SELECT CAST(unnest(range(min(year(o_orderdate)), max(year(o_orderdate)))) AS INT) AS anio FROM orders")
def _(s, sf):
    ends = table(s, sf, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    return readers.year_range(s, ends.select("a").scalar(), ends.select("b").scalar())


@query("S13_csv_to_parquet", "SELECT CAST(c_custkey AS INT) AS id, c_name AS nombre FROM customer")
def _(s, sf):
    src, dst = scratch_dir(s), scratch_dir(s)
    table(s, sf, "customer").select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Name (full)")).write.option("header", True).option("sep", "|").csv(src)
    return readers.copy_csv_to_parquet(s, src, dst, {"cust_key": "id", "name_full": "nombre"}, {"id": "int", "nombre": "string"})


# ---- sinks -----------------------------------------------------------------------------


@query("K01_write_parquet", "SELECT n_nationkey, n_name, 0 AS wrote_empty FROM nation")
def _(s, sf):
    path = scratch_dir(s)
    n = table(s, sf, "nation")
    writers.write_parquet(n, path)
    empty = writers.write_parquet(n.filter("n_nationkey < 0"), path)
    return s.read.parquet(path).select("n_nationkey", "n_name", F.lit(int(empty)).alias("wrote_empty"))


@query("K02_overwrite", "SELECT c_custkey, c_name || '!' AS c_name FROM customer")
def _(s, sf):
    path = scratch_dir(s)
    table(s, sf, "customer").select("c_custkey", "c_name").write.parquet(path)
    writers.write_overwrite(s.read.parquet(path).withColumn("c_name", F.concat("c_name", F.lit("!"))), path)
    return s.read.parquet(path)


@query("K03_dynamic_partitions", "SELECT CAST(year(o_orderdate) AS INT) AS periodo, CASE WHEN year(o_orderdate) >= 1999 THEN 'new' ELSE 'old' END AS v, count(*) AS n FROM orders GROUP BY 1, 2")
def _(s, sf):
    path = scratch_dir(s)
    rows = table(s, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("periodo"))
    writers.write_dynamic_partitions(rows.withColumn("v", F.lit("old")), path, ["periodo"])
    writers.write_dynamic_partitions(rows.filter("periodo >= 1999").withColumn("v", F.lit("new")), path, ["periodo"])
    return s.read.parquet(path).groupBy("periodo", "v").agg(F.count(F.lit(1)).alias("n"))


@query("K04_replace_where", "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def _(s, sf):
    rows = table(s, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    fresh = rows.filter("y = 1998").withColumn("o_orderstatus", F.lit("new"))
    return writers.replace_where(rows, fresh, F.col("y") == 1998).drop("y")


def _merge_sides(s, sf):
    """Existing customers, and an update with every second key, blanks and placeholders, and new keys."""
    c = table(s, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    src = c.select((k * 2).alias("c_custkey"), F.when(k % 3 == 0, "").when(k % 3 == 1, "sin informacion").otherwise("nuevo").alias("c_name"),
                   F.col("c_mktsegment"), F.when(k % 5 > 0, F.col("c_nationkey") + 100).alias("c_nationkey"))
    return c, src


_SRC = """(SELECT c_custkey * 2 AS k, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'sin informacion' ELSE 'nuevo' END AS n, c_mktsegment AS m,
    CASE WHEN c_custkey % 5 > 0 THEN c_nationkey + 100 END AS a FROM customer) s"""


@query("K04_replace_where_into", "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def _(s, sf):
    path = scratch_dir(s)
    rows = table(s, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    writers.write_dynamic_partitions(rows, path, ["y"])
    writers.replace_where_into(path, rows.filter("y = 1998").withColumn("o_orderstatus", F.lit("new")), F.col("y") == 1998, ["y"])
    return s.read.parquet(path).drop("y")


@query("K07_update_into", """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 AND c_nationkey < 7 THEN 'P' || c_nationkey ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def _(s, sf):
    path, c = scratch_dir(s), table(s, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    writers.write_dynamic_partitions(c, path, ["c_nationkey"])
    patch = c.filter("c_custkey % 5 = 0 and c_nationkey < 7").select(F.col("c_custkey").alias("k"), F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("c_mktsegment"))
    writers.update_into(path, patch, F.col("c_custkey"), "k", ["c_nationkey"])
    return s.read.parquet(path).select("c_custkey", "c_mktsegment")


@query("K11_replace_by_key_into", "SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'B' ELSE 'A' END AS v FROM customer")
def _(s, sf):
    path, c = scratch_dir(s), table(s, sf, "customer").select("c_custkey", "c_nationkey", F.lit("A").alias("v"))
    writers.write_dynamic_partitions(c, path, ["c_nationkey"])
    writers.replace_by_key_into(path, c.filter("c_nationkey < 10").withColumn("v", F.lit("B")), ["c_custkey", "c_nationkey"], ["c_nationkey"])
    return s.read.parquet(path).select("c_custkey", "v")


@query("K05_merge_upsert", f"""SELECT coalesce(c_custkey, k) AS c_custkey, CASE WHEN k IS NULL THEN c_name ELSE n END AS c_name,
    CASE WHEN k IS NULL THEN c_mktsegment ELSE m END AS c_mktsegment, CASE WHEN k IS NULL THEN c_nationkey ELSE a END AS c_nationkey
    FROM customer FULL JOIN {_SRC} ON c_custkey = k""")
def _(s, sf):
    return writers.merge_upsert(*_merge_sides(s, sf), ["c_custkey"])


@query("K06_merge_coalesce", f"""SELECT coalesce(c_custkey, k) AS c_custkey,
    CASE WHEN c_custkey IS NULL THEN n WHEN n IN ('', 'sin informacion') OR n IS NULL THEN c_name ELSE n END AS c_name,
    CASE WHEN k IS NULL THEN c_mktsegment ELSE m END AS c_mktsegment, CASE WHEN c_custkey IS NULL THEN a ELSE coalesce(a, c_nationkey) END AS c_nationkey
    FROM customer FULL JOIN {_SRC} ON c_custkey = k""")
def _(s, sf):
    return writers.merge_coalesce(*_merge_sides(s, sf), ["c_custkey"])


@query("K07_merge_update_only", """SELECT c_custkey, c_name, coalesce(v, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN
    (SELECT lower(trim(c_name)) AS j, CASE WHEN c_nationkey % 2 = 0 THEN 'P' || c_nationkey END AS v FROM customer WHERE c_acctbal > 0) ON lower(trim(c_name)) = j""")
def _(s, sf):
    c = table(s, sf, "customer")
    patch = c.filter("c_acctbal > 0").select(text.join_name("c_name").alias("j"), F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("P"), F.col("c_nationkey").cast("string"))).alias("c_mktsegment"))
    return writers.merge_update_only(c.select("c_custkey", "c_name", "c_mktsegment"), patch, text.join_name("c_name"), "j")


@query("K08_reject_records", """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS datos_registro, 'clientes' AS entidad, 'UDV' AS capa, 7 AS pipeline_id,
    'SALDO' AS razon_rechazo, 'HISTORICO' AS modoejecucion, CAST(NULL AS VARCHAR) AS periodo FROM customer WHERE c_acctbal < 0""")
def _(s, sf):
    path = scratch_dir(s)
    bad = table(s, sf, "customer").filter("c_acctbal < 0").select("c_custkey", "c_name")
    records = QA.reject_records(bad, "clientes", "UDV", "SALDO", "HISTORICO", None, 7)
    lost = writers.append_rejects(records, path)
    if lost:
        raise lost
    return readers.read_parquet(s, path)


@query("K09_quality_metrics", """SELECT 1 AS id_ejecucion, CAST(NULL AS INT) AS id_ejecucion_e2e, 3 AS pipeline_id, 'UDV' AS capa, 'orders' AS tabla_nombre,
    (SELECT count(*) FROM lineitem) AS registros_entrada, (SELECT count(*) FROM orders) AS registros_salida,
    abs((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders)) AS registros_descartados, CAST(0 AS BIGINT) AS registros_nulos_clave,
    (SELECT count(*) - count(DISTINCT o_custkey) FROM orders) AS registros_duplicados, 'x' AS observaciones""")
def _(s, sf):
    return QA.quality_metrics(table(s, sf, "lineitem"), table(s, sf, "orders"), "orders", "UDV", "o_custkey", 3, 1, None, "x")


@query("K10_export_csv", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def _(s, sf):
    path = scratch_dir(s)
    out = writers.export_csv({"nation": table(s, sf, "nation").select("n_nationkey", "n_name")}, path)
    return s.read.option("header", True).csv(out[0])


@query("K11_replace_by_key", "SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'B' ELSE 'A' END AS v FROM customer")
def _(s, sf):
    c = table(s, sf, "customer").select("c_custkey", "c_nationkey", F.lit("A").alias("v"))
    return writers.replace_by_key(c, c.filter("c_nationkey < 10").withColumn("v", F.lit("B")), ["c_custkey"]).drop("c_nationkey")


# ---- schema and projection ------------------------------------------------------------------


def _odd(s, sf):
    return table(s, sf, "customer").select(F.col("c_custkey").alias("Año Único"), F.col("c_name").alias("Valor (€), %"), F.col("c_mktsegment").alias("Ñu  X"))


@query("P01_normalize_headers", 'SELECT c_custkey AS ano_unico, c_name AS "valor_(),_%", c_mktsegment AS nu__x FROM customer')
def _(s, sf):
    return P.normalize_headers(_odd(s, sf))


@query("P02_sanitize_headers", "SELECT c_custkey AS ano_unico, c_name AS valor, c_mktsegment AS nu_x FROM customer")
def _(s, sf):
    return P.sanitize_headers(_odd(s, sf))


@query("P03_lower_headers", 'SELECT c_custkey AS "año único", c_name AS "valor (€), %", c_mktsegment AS "ñu  x" FROM customer')
def _(s, sf):
    return P.lower_headers(_odd(s, sf))


@query("P04_rename", "SELECT n_nationkey AS id, n_name, n_regionkey AS region FROM nation")
def _(s, sf):
    return P.rename_columns(table(s, sf, "nation"), {"n_nationkey": "id", "n_regionkey": "region", "unknown": "x"})


@query("P05_cast_schema", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS INT) AS c_name, CAST(NULL AS VARCHAR) AS falta, CAST(NULL AS DOUBLE) AS numero,
    '2024-01-05' AS dia, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer""")
def _(s, sf):
    df = table(s, sf, "customer").withColumn("dia", F.lit("05/01/2024"))
    return P.cast_schema(df, {"c_custkey": "string", "c_name": "int", "falta": "date", "numero": "double", "dia": "date", "c_acctbal": "decimal(20,4)"}, "dd/MM/yyyy")


@query("P06_select_or_null", "SELECT c_name, CAST(NULL AS VARCHAR) AS nada FROM customer")
def _(s, sf):
    return P.select_or_null(table(s, sf, "customer"), ["c_name", "nada"])


@query("P07_dual_columns", "SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN c_name ELSE c_mktsegment END AS nombre, c_mktsegment AS otro, CAST(NULL AS VARCHAR) AS sin FROM customer")
def _(s, sf):
    df = table(s, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") < 12, F.col("c_name")).alias("nombre"), F.col("c_mktsegment").alias("name"))
    return P.coalesce_dual_columns(df, ["c_custkey", "nombre", "otro", "sin"], {"nombre": "name", "otro": "name"})


@query("P08_project_by_rules", "SELECT l_orderkey, l_linenumber, CAST(l_quantity / 100.0 AS DOUBLE) AS l_quantity_pct, 1 AS fija FROM lineitem")
def _(s, sf):
    rules = [(lambda n: n.endswith("_pct"), lambda n: F.col(n.removesuffix("_pct")) / F.lit(100.0)), (lambda n: n == "fija", lambda n: F.lit(1))]
    return P.project_by_rules(table(s, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity_pct", "fija"], rules)


@query("P09_case_rule", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'sin informacion' ELSE o_orderstatus END AS estado, o_orderpriority FROM orders")
def _(s, sf):
    rules = {"estado": "CASE WHEN {col} = 'P' THEN 'sin informacion' ELSE {col} END"}
    return table(s, sf, "orders").select("o_orderkey", P.case_rule("o_orderstatus", "estado", rules), P.case_rule("o_orderpriority", "o_orderpriority", rules))


@query("P10_missing_metadata", "SELECT n_name AS fuente, '2024' AS temporada FROM nation")
def _(s, sf):
    df = table(s, sf, "nation").select(F.col("n_name").alias("fuente"))
    return P.add_missing_metadata(df, 2024, F.lit("2024-06-30").cast("timestamp"))


@query("P11_complex_to_json", """SELECT o_orderkey, '["' || o_orderstatus || '"]' AS a, '{"p":"' || o_orderpriority || '"}' AS b FROM orders""")
def _(s, sf):
    return P.complex_to_json(table(s, sf, "orders").select("o_orderkey", F.array("o_orderstatus").alias("a"), F.struct(F.col("o_orderpriority").alias("p")).alias("b")))


@query("P12_project_excluding", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(s, sf):
    return P.project_excluding(table(s, sf, "orders"), ["o_orderdate", "o_totalprice", "o_orderstatus"])


@query("P13_control_columns", "SELECT n_nationkey, 20240630 AS dia, '2024-06-30 00:00:00' AS carga FROM nation")
def _(s, sf):
    df = P.add_control_columns(table(s, sf, "nation").select("n_nationkey"), F.lit("2024-06-30 00:00:00").cast("timestamp"))
    return df.withColumnsRenamed({"periododia": "dia", "fecha_carga": "carga"})


@query("P14_select_existing", "SELECT n_name, n_regionkey FROM nation")
def _(s, sf):
    return P.select_existing(table(s, sf, "nation"), ["n_name", "absent", "n_regionkey"])


_MESSY = "CASE c_custkey % 5 WHEN 0 THEN ' ÑANDÚ  ' || c_name WHEN 1 THEN '-' WHEN 2 THEN 'N/A' WHEN 3 THEN c_mktsegment || ' 5%' ELSE c_name END"


@query("P15_clean_values", """SELECT CAST(c_custkey AS VARCHAR) AS clave, CASE c_custkey % 5 WHEN 0 THEN 'nandu ' || lower(c_name) WHEN 3 THEN lower(c_mktsegment) || ' 5%' WHEN 4 THEN lower(c_name) END AS nombre,
    CASE c_custkey % 5 WHEN 0 THEN 'nandu ' || lower(c_name) WHEN 3 THEN lower(c_mktsegment) || ' 5' WHEN 4 THEN lower(c_name) END AS ratio,
    CASE c_custkey % 5 WHEN 0 THEN 'ÑANDÚ  ' || c_name WHEN 3 THEN c_mktsegment || ' 5%' WHEN 4 THEN c_name WHEN 2 THEN 'N/A' END AS fecha_x FROM customer""")
def _(s, sf):
    m = F.expr(_MESSY)
    return bronze.curate_csv(table(s, sf, "customer").select(F.col("c_custkey").cast("string").alias("Clave"), m.alias("Nombre"), m.alias("Ratio"), m.alias("Fecha X")))


@query("P16_clean_catalog_values", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha, lower(o_orderpriority) AS texto FROM orders""")
def _(s, sf):
    df = table(s, sf, "orders").select(F.col("o_orderkey").cast("string").alias("O OrderKey"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha"), F.col("o_orderpriority").alias("Texto"))
    return bronze.curate_catalog(df).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("P17_zero_fill", "SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN c_nationkey ELSE 0 END AS n, CASE WHEN c_nationkey > 9 THEN c_acctbal ELSE 0.0 END AS v FROM customer")
def _(s, sf):
    df = table(s, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")).alias("n"), F.when(F.col("c_nationkey") > 9, F.col("c_acctbal")).alias("v"))
    return P.zero_fill_by_type(df, {"n": "int", "v": "double", "z": "int"})


# ---- filters ---------------------------------------------------------------------------------


def _gappy(s, sf):
    return table(s, sf, "orders").select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("id"), "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("temporada"), "o_totalprice")


@query("F01_null_key_split", "SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'CLAVE_NULA' ELSE 'ok' END AS razon, count(*) AS n FROM orders GROUP BY 1")
def _(s, sf):
    ok, bad = FL.split_null_key(_gappy(s, sf), "id")
    return ok.select(F.lit("ok").alias("razon")).unionByName(bad.select(F.col("razon_rechazo").alias("razon"))).groupBy("razon").agg(F.count(F.lit(1)).alias("n"))


@query("F02_business_rule_split", "SELECT o_orderkey, 'REGLA_NEGOCIO' AS razon_rechazo FROM orders WHERE o_orderpriority = '5-LOW' OR o_totalprice < 1000")
def _(s, sf):
    o = table(s, sf, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("p"))
    return FL.split_rule(o, F.col("p") >= 1000)[1].drop("p")


@query("F03_only_true", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount > 0.05")
def _(s, sf):
    return FL.only_true(table(s, sf, "lineitem").withColumn("f", F.col("l_discount") > 0.05), "f").select("l_orderkey", "l_linenumber", "l_partkey")


@query("F04_period", "SELECT 1998 AS p, count(*) AS n FROM orders WHERE year(o_orderdate) = 1998 UNION ALL SELECT 0, count(*) FROM orders")
def _(s, sf):
    g = _gappy(s, sf)
    return FL.for_period(g, 1998, "temporada").agg(F.lit(1998).alias("p"), F.count(F.lit(1)).alias("n")).unionByName(FL.for_period(g, 0, "temporada").agg(F.lit(0).alias("p"), F.count(F.lit(1)).alias("n")))


@query("F05_threshold", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 30")
def _(s, sf):
    return FL.at_least(table(s, sf, "lineitem"), "l_quantity", 30).select("l_orderkey", "l_linenumber", "l_quantity")


@query("F06_name_words", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%red%' AND lower(p_name) LIKE '%bolt%'")
def _(s, sf):
    return table(s, sf, "part").filter(text.name_matches("p_name", "Bolt de RED")).select("p_partkey", "p_name")


@query("F07_contains", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%gear%'")
def _(s, sf):
    return table(s, sf, "part").filter(text.contains_ci("p_name", "GEAR")).select("p_partkey", "p_name")


@query("F08_between", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def _(s, sf):
    return FL.between_opt(_gappy_keys(s, sf), "temporada", 1996, 1998).select("o_orderkey")


def _gappy_keys(s, sf):
    return table(s, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("temporada"))


@query("F09_latest_season", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS temporada FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders WHERE o_orderstatus = 'F')")
def _(s, sf):
    return FL.latest_season(_gappy_keys(s, sf), cond=F.col("o_orderstatus") == "F").drop("o_orderstatus")


@query("F10_any_value", "SELECT c_custkey FROM customer WHERE c_nationkey > 20 OR c_acctbal > 5000")
def _(s, sf):
    df = table(s, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 20, 1).alias("a"), F.when(F.col("c_acctbal") > 5000, 1).alias("b"))
    return FL.any_not_null(df, ["a", "b"]).select("c_custkey")


@query("F11_non_blank", "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_mktsegment <> 'HOUSEHOLD'")
def _(s, sf):
    seg = F.col("c_mktsegment")
    df = table(s, sf, "customer").select("c_custkey", F.when(seg == "MACHINERY", "  ").when(seg != "HOUSEHOLD", seg).alias("k"))
    return FL.non_blank(df, "k").select("c_custkey")


@query("F12_having", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 30 AND max(l_quantity) > 45")
def _(s, sf):
    g = table(s, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("m"))
    return FL.having(g, (F.col("n") >= 30) & (F.col("m") > 45)).drop("m")


# ---- joins -------------------------------------------------------------------------------------


def _dim(s, sf):
    """Suppliers with several names each."""
    k = F.col("s_suppkey")
    return table(s, sf, "supplier").select(k.cast("int").alias("id"), F.concat(F.lit(" "), F.upper("s_name")).alias("n1"), F.concat(F.lit("Súp "), k.cast("string")).alias("n2"),
                                           F.concat(F.lit("Alias "), (k + 1).cast("string")).alias("n3"))


def _named_lines(s, sf):
    k = F.col("l_suppkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"))).when(k % 3 == 1, F.concat(F.lit("sup "), k.cast("string"))).otherwise(F.concat(F.lit("ALIAS "), (k + 1).cast("string")))
    return table(s, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", name.alias("club"))


@query("J01_join_by_name", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey AS INT) AS id FROM lineitem WHERE l_suppkey % 3 = 0")
def _(s, sf):
    return J.join_by_name(_named_lines(s, sf), _dim(s, sf).select("id", "n1"), "club", "n1").select("l_orderkey", "l_linenumber", "l_partkey", "id")


@query("J02_lookup_default", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Final' ELSE 'sin informacion' END AS a, CASE WHEN o_orderstatus = 'F' THEN 'Final' ELSE o_orderstatus END AS b FROM orders")
def _(s, sf):
    o = table(s, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("a"), F.col("o_orderstatus").alias("b"))
    pairs = table(s, sf, "orders").filter("o_orderstatus = 'F'").select(F.lit(" f ").alias("raw"), F.lit("Final").alias("es")).distinct()
    return J.lookup(J.lookup(o, pairs, "a", "raw", "es", fixed.NO_INFO), pairs, "b", "raw", "es")


@query("J03_any_of_three_names", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey AS INT) AS id FROM lineitem")
def _(s, sf):
    return J.join_any_name(_named_lines(s, sf), _dim(s, sf), "club", ["n1", "n2", "n3"], "id").select("l_orderkey", "l_linenumber", "l_partkey", "id")


@query("J04_two_roles", "SELECT l_orderkey, a.n_name AS de, b.n_name AS a FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON a.n_nationkey = s_nationkey JOIN nation b ON b.n_nationkey = c_nationkey")
def _(s, sf):
    t = lambda n: table(s, sf, n)
    f = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return J.join_roles(f, t("nation"), "n_nationkey", {"s_nationkey": {"n_name": "de"}, "c_nationkey": {"n_name": "a"}}, "inner").select("l_orderkey", "de", "a")


@query("J05_match_split", "SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'ok' ELSE 'SIN_MATCH_CATALOGO' END AS r, count(*) AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1")
def _(s, sf):
    rows = _named_lines(s, sf).withColumn("k", text.join_name("club"))
    ok, bad = J.match_split(rows, _dim(s, sf).withColumn("k", text.join_name("n1")), {"k": "k"}, "SIN_MATCH_CATALOGO", ["id"])
    both = ok.select(F.lit("ok").alias("r"), "l_partkey").unionByName(bad.select(F.col("razon_rechazo").alias("r"), "l_partkey"))
    return both.groupBy("r").agg(F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("p"))


@query("J06_composite_key", "SELECT l.l_partkey, l.l_suppkey, n, m FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) l LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) r ON l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey")
def _(s, sf):
    g = lambda d, n: d.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias(n))
    li = table(s, sf, "lineitem")
    return J.join_keys(g(li, "n"), g(li.filter("l_returnflag = 'R'"), "m"), ["l_partkey", "l_suppkey"])


@query("J07_star_join", "SELECT c_custkey, n_name, r_name, o FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS o FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def _(s, sf):
    t = lambda n: table(s, sf, n)
    nat = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    reg = t("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    cnt = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("o"))
    return J.star_join(t("customer"), [(nat, ["c_nationkey"]), (reg, ["n_regionkey"]), (cnt, ["c_custkey"])]).select("c_custkey", "n_name", "r_name", "o")


@query("J08_priority_names", """SELECT nombre, id FROM (SELECT nombre, id, row_number() OVER (PARTITION BY nombre ORDER BY p, id) AS rn FROM (
    SELECT lower(n_name) AS nombre, n_nationkey AS id, 0 AS p FROM nation UNION ALL SELECT lower(r_name), n_nationkey, 1 FROM nation JOIN region ON n_regionkey = r_regionkey)) WHERE rn = 1""")
def _(s, sf):
    d = table(s, sf, "nation").join(table(s, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return J.priority_lookup(d, "n_nationkey", ["n_name", "r_name"]).select(F.col("_name").alias("nombre"), F.col("n_nationkey").alias("id"))


@query("J09_fallback_key", "SELECT c_custkey, c_mktsegment FROM customer")
def _(s, sf):
    c = table(s, sf, "customer")
    key = F.when(F.col("c_nationkey") > 12, F.col("c_custkey").cast("string"))
    a = c.select("c_custkey", key.alias("ext"), F.upper("c_name").alias("nom"))
    return J.join_fallback_key(a, c.select(key.alias("ext"), F.col("c_name").alias("nom"), "c_mktsegment"), "ext", "nom").select("c_custkey", "c_mktsegment")


@query("J10_rank_equals_slot", """SELECT o_custkey, o_orderkey, r_name FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    JOIN (SELECT r_name, r_regionkey + 1 AS slot FROM region) ON rn = slot""")
def _(s, sf):
    ranked = R.first_rows(table(s, sf, "orders"), ["o_custkey"], [("o_totalprice", "desc"), ("o_orderkey", "asc")], 5, name="player_rank")
    slots = table(s, sf, "region").select("r_name", (F.col("r_regionkey") + 1).alias("slot_rank"))
    return J.assign_slots(ranked, slots, keys=()).select("o_custkey", "o_orderkey", "r_name")


@query("J11_restrict_top_n", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY sum(CAST(o_totalprice * 100 AS BIGINT)) DESC, o_custkey LIMIT 5)")
def _(s, sf):
    return J.restrict_top_n(table(s, sf, "orders").withColumn("m", F.round(F.col("o_totalprice") * 100).cast("bigint")), "o_custkey", "m", 5).select("o_orderkey", "o_custkey")


@query("J12_rival_name", "SELECT l_orderkey, l_partkey, s_name AS rival FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def _(s, sf):
    teams = table(s, sf, "supplier").select(F.col("s_suppkey").alias("id_equipo"), F.col("s_name").alias("nombre_equipo"))
    return J.with_rival(table(s, sf, "lineitem").withColumn("id_rival", F.col("l_suppkey")), teams).select("l_orderkey", "l_partkey", "rival")


@query("J13_join_dedup", "SELECT c_custkey, o_orderkey FROM customer JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1) ON c_custkey = o_custkey")
def _(s, sf):
    o = table(s, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return J.join_dedup(table(s, sf, "customer"), o, "c_custkey", [("o_orderdate", "desc"), ("o_orderkey", "asc")]).select("c_custkey", "o_orderkey")


@query("J14_missing_from", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(s, sf):
    seen = table(s, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.missing_from(table(s, sf, "customer").select("c_custkey", "c_name"), seen, "c_custkey")


_TYPO = "CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN left(p_name, 2) || right(p_name, 5) WHEN 2 THEN 'the ' || p_name || ' club' ELSE reverse(p_name) END"
_BAG = "list_distinct(list_transform(range(1, length({x})), lambda i: substr(replace({x}, ' ', '_'), CAST(i AS INT), 2)))"


@query("J15_fuzzy_names", f"""WITH t AS (SELECT DISTINCT lower(trim({_TYPO})) AS t FROM part), k AS (SELECT DISTINCT lower(trim(p_name)) AS n FROM part),
    c AS (SELECT t, n, len(list_intersect({_BAG.format(x='t')}, {_BAG.format(x='n')})) AS o, len({_BAG.format(x='t')}) AS a, len({_BAG.format(x='n')}) AS b FROM t, k),
    o AS (SELECT t, n, CASE WHEN t = n THEN 0 WHEN contains(t, n) OR contains(n, t) THEN 1 WHEN o / (a + b - o) > 0.55 THEN 2 END AS s,
          CASE WHEN t = n OR contains(t, n) OR contains(n, t) THEN -length(n) ELSE -(o / (a + b - o)) END AS r FROM c),
    best AS (SELECT t, n FROM o WHERE s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY s, r, n) = 1)
    SELECT p_partkey, {_TYPO} AS texto, n AS resuelto FROM part LEFT JOIN best ON t = lower(trim({_TYPO}))""")
def _(s, sf):
    p = table(s, sf, "part")
    return RS.fuzzy_lookup(p.select("p_partkey", F.expr(_TYPO).alias("texto")), p.select(F.col("p_name").alias("nombre")), "texto")


@query("J16_common_values", "SELECT o_custkey, y FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS y FROM orders WHERE o_orderstatus IN ('F', 'P')) WHERE y IN (SELECT year(o_orderdate) FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT year(o_orderdate) FROM orders WHERE o_orderstatus = 'P')")
def _(s, sf):
    o = table(s, sf, "orders").select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    return J.common_values(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'"), "y").drop("o_orderstatus")


# ---- aggregates ------------------------------------------------------------------------------


def _points(s, sf):
    q = F.col("l_quantity").cast("int")
    return table(s, sf, "lineitem").select(F.col("l_suppkey").alias("id_equipo"), F.year("l_shipdate").alias("temporada"), F.col("l_returnflag").alias("tipo_tabla"),
                                           q.alias("partidos_jugados"), (q % 3).alias("partidos_ganados"), (q % 4).alias("partidos_empatados"), (q % 5).alias("partidos_perdidos"),
                                           (q % 6).alias("goles_favor"), (q % 7).alias("goles_contra"), (q % 8).alias("puntos"))


@query("A01_season_totals", """SELECT l_suppkey AS id_equipo, CAST(year(l_shipdate) AS INT) AS temporada, count(*) AS torneos_disputados, CAST(sum(q) AS BIGINT) AS total_pj,
    CAST(sum(q % 3) AS BIGINT) AS total_pg, CAST(sum(q % 4) AS BIGINT) AS total_pe, CAST(sum(q % 5) AS BIGINT) AS total_pp, CAST(sum(q % 6) AS BIGINT) AS total_goles_favor,
    CAST(sum(q % 7) AS BIGINT) AS total_goles_contra, CAST(sum(q % 8) AS BIGINT) AS total_puntos, CAST(sum(q % 6) - sum(q % 7) AS BIGINT) AS total_diferencia_goles
    FROM (SELECT *, CAST(l_quantity AS INT) AS q FROM lineitem) GROUP BY 1, 2""")
def _(s, sf):
    return A.season_totals(_points(s, sf))


@query("A02_player_totals", """SELECT l_partkey AS id_jugador, CAST(sum(q) AS BIGINT) AS partidos_jugados, round(avg(q % 4), 6) AS ppp, CAST(sum(q % 5) + sum(CASE WHEN q > 20 THEN 1 ELSE 0 END) AS BIGINT) AS goles,
    CAST(bool_or(q > 48) AS INT) AS datos FROM (SELECT *, CAST(l_quantity AS INT) AS q FROM lineitem) GROUP BY 1""")
def _(s, sf):
    q = F.col("l_quantity").cast("int")
    rows = table(s, sf, "lineitem").select(F.col("l_partkey").alias("id_jugador"), (q % 4).alias("ppp"), (q % 5).alias("goles"), F.when(q > 20, 1).alias("penaltis_anotados"),
                                           (q > 48).alias("datos_disponibles"), *[q.alias(c) for c in A.PLAYER_MEASURES])
    return A.player_totals(rows, ["id_jugador"]).select("id_jugador", "partidos_jugados", F.round("ppp", 6).alias("ppp"), "goles", F.col("datos_disponibles").alias("datos"))


@query("A03_max_per_key", "SELECT o_custkey, max(o_totalprice) AS o_totalprice, max(o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1")
def _(s, sf):
    return A.max_per_key(table(s, sf, "orders"), ["o_custkey"], ["o_totalprice", "o_orderstatus"])


@query("A04_guarded_ratio_of_sums", "SELECT l_suppkey, round(sum(CAST(l_quantity AS INT) % 3) * 1.0 / nullif(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0), 2)::DOUBLE AS r FROM lineitem GROUP BY 1")
def _(s, sf):
    q = F.col("l_quantity").cast("int")
    return table(s, sf, "lineitem").groupBy("l_suppkey").agg(measures.safe_ratio(F.sum(q % 3), F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)), 1.0, 2).alias("r"))


@query("A05_conditional_counts", "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1")
def _(s, sf):
    st = F.col("o_orderstatus")
    return table(s, sf, "orders").groupBy("o_custkey").agg(measures.count_when(st == "F").alias("f"), measures.count_when(st == "O").alias("o"))


@query("A06_distinct_counts", "SELECT l_suppkey, count(DISTINCT year(l_shipdate)) AS y, count(DISTINCT l_partkey) AS p FROM lineitem GROUP BY 1")
def _(s, sf):
    return table(s, sf, "lineitem").groupBy("l_suppkey").agg(measures.n_distinct(F.year("l_shipdate")).alias("y"), measures.n_distinct("l_partkey").alias("p"))


@query("A07_rounded_averages", "SELECT l_suppkey, round(avg(CAST(l_quantity AS INT)), 1) AS a, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1")
def _(s, sf):
    return table(s, sf, "lineitem").groupBy("l_suppkey").agg(measures.avg_round(F.col("l_quantity").cast("int"), 1).alias("a"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("A08_dedup_by_max", "SELECT l_partkey, l_suppkey, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2")
def _(s, sf):
    return A.dedup_max(table(s, sf, "lineitem"), ["l_partkey", "l_suppkey"], ["l_quantity"])


@query("A09_global_max", "SELECT max(o_totalprice) AS o_totalprice FROM orders")
def _(s, sf):
    return A.scalar_max(table(s, sf, "orders"), "o_totalprice")


@query("A10_distinct", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def _(s, sf):
    return A.distinct_values(table(s, sf, "orders"), "o_orderpriority", "o_orderstatus")


@query("A11_latest_load_wins", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def _(s, sf):
    return R.dedup_latest(table(s, sf, "orders"), ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "asc")]).select("o_custkey", "o_orderkey")


@query("A12_key_profile", """SELECT 'orders' AS tabla, count(*) AS total, count(*) FILTER (id IS NULL) AS nulos_pk, count(*) - (count(DISTINCT id) + CAST(bool_or(id IS NULL) AS INT)) AS duplicados_pk, 'WARN' AS status
    FROM (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS id FROM orders)
    UNION ALL SELECT 'customer', count(*), 0, 0, 'OK' FROM customer""")
def _(s, sf):
    o = table(s, sf, "orders").select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("id"))
    return QA.validation_report({"orders": (o, "id"), "customer": (table(s, sf, "customer"), "c_custkey")})


@query("A13_rows_per_season", "SELECT CAST(year(o_orderdate) AS INT) AS temporada, count(*) AS filas FROM orders GROUP BY 1")
def _(s, sf):
    return A.rows_per(_gappy_keys(s, sf), "temporada")


@query("A14_median_fill", "SELECT p_partkey, CAST(coalesce(v, (SELECT median(CASE WHEN p_brand <> 'Brand#3' THEN p_size END) FROM part)) AS DOUBLE) AS v FROM (SELECT p_partkey, CASE WHEN p_brand <> 'Brand#3' THEN p_size END AS v FROM part)")
def _(s, sf):
    return A.fill_median(table(s, sf, "part").select("p_partkey", F.when(F.col("p_brand") != "Brand#3", F.col("p_size").cast("double")).alias("v")), "v")


@query("A15_correlation", "SELECT l_suppkey, round(corr(l_quantity, l_extendedprice), 6) AS correlacion FROM lineitem GROUP BY 1")
def _(s, sf):
    return A.corr_by(table(s, sf, "lineitem"), "l_suppkey", "l_quantity", "l_extendedprice").withColumn("correlacion", F.round("correlacion", 6))


@query("A16_covariances", """SELECT label, count(*) AS n, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(avg(e[i + 1]), 8) AS media_i, round(avg(e[j + 1]), 8) AS media_j, round(covar_pop(e[i + 1], e[j + 1]), 8) AS cov
    FROM (SELECT label, embedding::DOUBLE[] AS e FROM embeddings), (SELECT unnest(range(0, 64)) AS i), (SELECT unnest(range(0, 64)) AS j) WHERE i <= j GROUP BY label, i, j""")
def _(s, sf):
    out = A.covariances_of_vectors(table(s, sf, "embeddings"), "label", "embedding")
    return out.select("label", "n", "i", "j", *[F.round(c, 8).alias(c) for c in ("media_i", "media_j", "cov")])


@query("A17_mode_per_key", """SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1""")
def _(s, sf):
    return A.mode_map(table(s, sf, "orders"), "o_custkey", "o_orderpriority")


@query("A17_contradicting_rows", """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey % 7 AS club, CAST((l_suppkey % 7 + CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS VARCHAR) AS ext FROM lineitem),
    one AS (SELECT l_partkey FROM r GROUP BY 1 HAVING min(club) = max(club)), m AS (SELECT club, ext FROM r WHERE l_partkey IN (SELECT l_partkey FROM one) GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY club ORDER BY count(*) DESC, ext) = 1)
    SELECT r.l_orderkey, r.l_linenumber, r.l_partkey FROM r LEFT JOIN m ON r.club = m.club WHERE m.ext IS NULL OR m.ext = r.ext""")
def _(s, sf):
    club = F.col("l_suppkey") % 7
    r = table(s, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", club.alias("club"), (club + F.when(F.col("l_quantity") > 40, 1).otherwise(0)).cast("string").alias("ext"))
    return A.keep_matching_mode(r, "club", "ext", "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("A19_missing_inputs", """SELECT 'orders_' || y || '.csv' AS archivo FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) WHERE y NOT IN (SELECT year(o_orderdate) FROM orders GROUP BY 1 HAVING count(*) > (SELECT count(*) / 8 FROM orders))""")
def _(s, sf):
    name = F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".csv"))
    o = table(s, sf, "orders").groupBy(name.alias("archivo")).agg(F.count(F.lit(1)).alias("n"))
    total = table(s, sf, "orders").agg(F.count(F.lit(1)) / 8).scalar()
    expected = o.select("archivo", F.lit("orders").alias("entidad"))
    return QA.missing_inputs(expected, o.filter(F.col("n") > total), ["nothing"]).select("archivo")


# ---- windows -------------------------------------------------------------------------------------


@query("W01_latest_row", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey) = 1")
def _(s, sf):
    o = table(s, sf, "orders").withColumn("y", F.year("o_orderdate"))
    return R.latest_per_key(o, ["o_custkey"], [("y", "desc"), ("o_orderkey", "asc")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("W02_latest_non_blank", """SELECT o_custkey AS k, arg_max(p, (o_orderdate, -o_orderkey)) FILTER (p IS NOT NULL) AS p, arg_max(st, (o_orderdate, -o_orderkey)) FILTER (st IS NOT NULL) AS st FROM
    (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS p, CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS st FROM orders) GROUP BY 1""")
def _(s, sf):
    o = table(s, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("p"),
                                      F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).otherwise("0,0").alias("st"))
    return R.latest_non_blank(o, "o_custkey", [("o_orderdate", "desc"), ("o_orderkey", "asc")], ["p", "st"]).withColumnRenamed("_key", "k")


@query("W03_league_position", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS posicion FROM orders")
def _(s, sf):
    return R.rank_table(table(s, sf, "orders"), ["o_orderstatus"], [("o_totalprice", "desc"), ("o_orderkey", "asc")]).select("o_orderkey", "posicion")


@query("W04_dense_rank", "SELECT l_orderkey, l_linenumber, l_partkey, rango FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_partkey) AS INT) AS rango FROM lineitem) WHERE rango <= 11")
def _(s, sf):
    return R.dense_rank_in(table(s, sf, "lineitem"), ["l_suppkey"], [("l_quantity", "desc"), ("l_partkey", "asc")], 11).select("l_orderkey", "l_linenumber", "l_partkey", "rango")


@query("W05_slot_numbers", "SELECT n_nationkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INT) AS slot_rank FROM nation")
def _(s, sf):
    n = table(s, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("id_formacion"), F.lit("X").alias("posicion_xi"), F.col("n_nationkey").alias("orden"))
    return R.number_slots(n).select("n_nationkey", "slot_rank")


@query("W06_keep_best_priority", "SELECT c_mktsegment, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_custkey) = 1")
def _(s, sf):
    return R.keep_best_priority(table(s, sf, "customer"), ["c_mktsegment"], [("c_nationkey", "asc"), ("c_custkey", "asc")]).select("c_mktsegment", "c_custkey")


@query("W07_best_per_slot", "SELECT l_suppkey, l_orderkey, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey) = 1")
def _(s, sf):
    return R.best_per(table(s, sf, "lineitem"), ["l_suppkey"], [("l_extendedprice", "desc"), ("l_orderkey", "asc"), ("l_partkey", "asc")]).select("l_suppkey", "l_orderkey", "l_partkey")


@query("W08_duplicate_split", "SELECT o_custkey, o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 THEN 'ok' ELSE 'DUPLICADO_CLAVE' END AS r FROM orders")
def _(s, sf):
    kept, rej = R.split_duplicates(table(s, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], [("o_orderkey", "asc")])
    return kept.withColumn("r", F.lit("ok")).unionByName(rej.withColumnRenamed("razon_rechazo", "r"))


@query("W09_minmax_scale", """SELECT c_custkey, round(CASE WHEN max(v) OVER w > min(v) OVER w THEN (v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w) * 100 ELSE 50 END, 6) AS score_100
    FROM (SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 3 THEN 7.0 ELSE c_acctbal END AS v FROM customer) WINDOW w AS (PARTITION BY c_nationkey)""")
def _(s, sf):
    c = table(s, sf, "customer").withColumn("v", F.when(F.col("c_nationkey") == 3, 7.0).otherwise(F.col("c_acctbal")))
    return R.minmax_by(c, "c_nationkey", "v", digits=6).select("c_custkey", "score_100")


@query("W10_most_complete", """SELECT o_custkey, o_orderkey FROM (SELECT *, CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END + CASE WHEN o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END AS n FROM orders)
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderkey) = 1""")
def _(s, sf):
    o = table(s, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("a"), F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("b"))
    return R.most_complete(o, ["o_custkey"], ["a", "b"], "o_orderkey").select("o_custkey", "o_orderkey")


@query("W11_streaks", """SELECT l_suppkey, CAST(min(a) AS INT) AS desde, CAST(max(a) AS INT) AS hasta, count(*) AS racha FROM (SELECT *, a - row_number() OVER (PARTITION BY l_suppkey ORDER BY a) AS g FROM
    (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS a FROM lineitem) WHERE l_quantity > 15) GROUP BY l_suppkey, g""")
def _(s, sf):
    order = [(c, "asc") for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return R.streaks(table(s, sf, "lineitem"), ["l_suppkey"], order, F.col("l_quantity") > 15)


# ---- order, limit, sets ---------------------------------------------------------------------------


@query("T01_ordered_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(s, sf):
    return R.top_n(table(s, sf, "orders").select("o_orderkey", "o_totalprice"), [("o_totalprice", "desc"), ("o_orderkey", "asc")], 20)


@query("T02_parametric_top_n", "SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 7")
def _(s, sf):
    return R.top_n(table(s, sf, "customer"), [("c_acctbal", "desc"), ("c_custkey", "asc")], 7).select("c_custkey")


@query("U01_unpivot_roles", "SELECT l_orderkey, l_linenumber, 'A' AS rol, l_partkey AS id FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'B', l_suppkey FROM lineitem")
def _(s, sf):
    return U.unpivot_roles(table(s, sf, "lineitem"), ["l_orderkey", "l_linenumber"], {"A": {"id": F.col("l_partkey")}, "B": {"id": F.col("l_suppkey")}}, "rol")


@query("U02_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(s, sf):
    return U.union_distinct([table(s, sf, "customer").select(F.col("c_nationkey").alias("k")), table(s, sf, "supplier").select(F.col("s_nationkey").alias("k"))])


@query("U03_union_by_name", "SELECT c_custkey AS k, c_name AS n, CAST(NULL AS DOUBLE) AS b FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def _(s, sf):
    return U.union_by_name([table(s, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n")), table(s, sf, "supplier").select(F.col("s_acctbal").alias("b"), F.col("s_suppkey").alias("k"))])


@query("U04_intersect", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def _(s, sf):
    return U.intersect_values(table(s, sf, "customer").select(F.col("c_custkey").alias("k")), table(s, sf, "orders").select(F.col("o_custkey").alias("k")))


@query("U05_except", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def _(s, sf):
    return U.except_values(table(s, sf, "part").select(F.col("p_partkey").alias("k")), table(s, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("k")))


@query("U06_several_entities", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt%' OR p_name LIKE '%anvil%'")
def _(s, sf):
    return U.for_entities(table(s, sf, "part"), "p_name", ["BOLT", "anvil"]).select("p_partkey", "p_name")


@query("U07_entities_of_roles", "SELECT l_partkey AS equipo FROM lineitem UNION SELECT l_suppkey FROM lineitem")
def _(s, sf):
    return U.entities_from_roles(table(s, sf, "lineitem"), ["l_partkey", "l_suppkey"])


# ---- incremental --------------------------------------------------------------------------------------


def _arrivals(s, sf):
    base = scratch_dir(s)
    table(s, sf, "events").withColumn("day", F.to_date("ts").cast("string")).repartition("day").write.partitionBy("day").parquet(base)
    return base


@query("X01_incremental_upsert", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def _(s, sf):
    src, out, ckpt = _arrivals(s, sf), scratch_dir(s), scratch_dir(s)
    rows = ingest.landing_stream(s, src, table(s, sf, "events").schema, max_files=200).drop("day")
    q = ingest.ingest_stream(rows, ckpt, ingest.upsert_into(out, ["user_id", "bucket"], lambda d: d.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(8))), latest="ts", newest=True, by=["bucket"]))
    q.awaitTermination()
    return s.read.parquet(out).select("user_id", "event_id", "event_type")


@query("X02_quality_in_stream", "SELECT count(*) FILTER (event_type <> 'error') AS kept, count(*) FILTER (event_type = 'error') AS rejected, count(*) AS entrada FROM events")
def _(s, sf):
    src, out, ckpt, rej, met = (_arrivals(s, sf), *[scratch_dir(s) for _ in range(4)])
    rows = ingest.landing_stream(s, src, table(s, sf, "events").schema).drop("day")
    handle = ingest.with_quality(ingest.upsert_into(out, ["event_id"]), lambda b: FL.split_rule(b, F.col("event_type") != "error"), "eventos", "UDV", "event_id", rej, met)
    ingest.ingest_stream(rows, ckpt, handle).awaitTermination()
    kept = s.read.parquet(out).agg(F.count(F.lit(1)).alias("n")).scalar()
    bad = s.read.parquet(rej).agg(F.count(F.lit(1)).alias("n")).scalar()
    return s.read.parquet(met).agg(F.sum("registros_entrada").alias("entrada")).select(kept.alias("kept"), bad.alias("rejected"), "entrada")
