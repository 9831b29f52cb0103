"""The library's operators as queries over the relational tables, with SQL.

The tables hold no workbooks, so relations are lifted into cells (sources.grid)
or labels, merges and formulas are constructed from their keys; both sides
construct the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import formulas, hashing, headers, text, values
from .functions.geometry import Rect, a1, column_letters, column_number
from .operators import aggregates, spatial, windows
from .plans import clean, detect, export, structure
from .sources.grid import grid

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Constructed inputs, in both languages.

NATION = """ng AS (
  SELECT 'R' || n_regionkey AS sheet, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) + 1 AS row, n_nationkey, n_name, n_regionkey FROM nation
), nc AS (
  SELECT sheet, row, 1 AS col, 'integer' AS kind, NULL AS v_str, CAST(n_nationkey AS DOUBLE) AS v_num FROM ng
  UNION ALL SELECT sheet, row, 2, 'text', n_name, NULL FROM ng
  UNION ALL SELECT sheet, row, 3, 'integer', NULL, CAST(n_regionkey AS DOUBLE) FROM ng
  UNION ALL SELECT DISTINCT sheet, 1, c.col, 'text', c.name, NULL FROM ng, (VALUES (1, 'n_nationkey'), (2, 'n_name'), (3, 'n_regionkey')) c(col, name)
)"""


def nation_grid(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation")
    return grid(n, F.concat(F.lit("R"), F.col("n_regionkey").cast("string")), ["n_nationkey"], ["n_nationkey", "n_name", "n_regionkey"])


ORDERS = """og AS (
  SELECT o_orderpriority AS sheet, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) + 1 AS row, * FROM orders
), oc AS (
  SELECT sheet, row, 1 AS col, 'integer' AS kind, CAST(NULL AS VARCHAR) AS v_str, CAST(o_orderkey AS DOUBLE) AS v_num FROM og
  UNION ALL SELECT sheet, row, 2, 'text', o_orderstatus, NULL FROM og
  UNION ALL SELECT sheet, row, 3, 'number', NULL, o_totalprice FROM og
  UNION ALL SELECT DISTINCT sheet, 1, c.col, 'text', c.name, NULL FROM og, (VALUES (1, 'o_orderkey'), (2, 'o_orderstatus'), (3, 'o_totalprice')) c(col, name)
)"""


def orders_grid(spark, sf) -> DataFrame:
    return grid(table(spark, sf, "orders"), F.col("o_orderpriority"), ["o_orderkey"], ["o_orderkey", "o_orderstatus", "o_totalprice"])


SUPPLIER = """sc AS (
  SELECT 'wb' AS workbook, 'S' || s_nationkey % 5 || '_0' AS sheet, CAST(s_suppkey // 7 + 1 AS INTEGER) AS row, CAST(s_suppkey * 5 % 17 + 1 AS INTEGER) AS col, s_suppkey, s_name, s_acctbal FROM supplier
)"""


def supplier_cells(spark, sf) -> DataFrame:
    """A sparse sheet: suppliers at positions that follow from their keys."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.lit("wb").alias("workbook"), F.concat(F.lit("S"), (F.col("s_nationkey") % 5).cast("string"), F.lit("_0")).alias("sheet"), (F.floor(k / 7) + 1).cast("int").alias("row"), (k * 5 % 17 + 1).cast("int").alias("col"), "s_suppkey", F.lit("text").alias("kind"), F.col("s_name").alias("v_str"), F.col("s_acctbal").alias("v_num"),
    )


RECTS = """pr AS (
  SELECT 'wb' AS workbook, 'S' || p_partkey % 5 || '_' || p_partkey // 1000000 AS sheet, p_partkey AS id, CAST(p_partkey // 100 % 10000 * 100 + p_partkey * 7 % 97 + 1 AS INTEGER) AS min_row, CAST(p_partkey * 5 % 41 + 1 AS INTEGER) AS min_col,
         CAST(p_partkey // 100 % 10000 * 100 + p_partkey * 7 % 97 + 1 + p_size % 6 AS INTEGER) AS max_row, CAST(p_partkey * 5 % 41 + 1 + p_size % 4 AS INTEGER) AS max_col
  FROM part
)"""


def part_rects(spark, sf) -> DataFrame:
    """Rectangles whose place and size follow from the parts' keys: all parts,
    a hundred on every hundred rows of five sheets."""
    k, s = F.col("p_partkey"), F.col("p_size")
    r, c = F.floor(k / 100) % 10000 * 100 + k * 7 % 97 + 1, k * 5 % 41 + 1
    sheet = F.concat(F.lit("S"), (k % 5).cast("string"), F.lit("_"), F.floor(k / 1_000_000).cast("string"))
    return table(spark, sf, "part").select(F.lit("wb").alias("workbook"), sheet.alias("sheet"), k.alias("id"), *[x.cast("int").alias(n) for x, n in ((r, "min_row"), (c, "min_col"), (r + s % 6, "max_row"), (c + s % 4, "max_col"))])


SPECIAL = """CASE l_linenumber + l_orderkey % 4 WHEN 1 THEN '-' WHEN 2 THEN ' N/A ' WHEN 3 THEN 'tbd' WHEN 4 THEN '#REF!' WHEN 5 THEN NULL WHEN 6 THEN 'plain' ELSE '' || l_linenumber END"""


def special_values(spark, sf) -> DataFrame:
    """lineitem with texts of every state, some numbers, some formulas."""
    key = F.col("l_linenumber") + F.col("l_orderkey") % 4
    t = F.when(key == 1, "-").when(key == 2, " N/A ").when(key == 3, "tbd").when(key == 4, "#REF!").when(key == 5, None).when(key == 6, "plain").otherwise(F.col("l_linenumber").cast("string"))
    number = F.col("l_partkey") % 3 == 0
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(number, "number").when(t.isNull(), "blank").otherwise("text").alias("kind"), t.alias("v_str"), F.when(number, F.col("l_quantity") % 2).alias("v_num"),
        F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("=A"), F.col("l_linenumber").cast("string"), F.lit("+'My Sheet'!$B$"), (F.col("l_partkey") % 50 + 1).cast("string"))).alias("formula"), F.when(F.col("l_suppkey") % 8 == 0, "present").otherwise("missing").alias("cache_status"),
    )


SPECIAL_SQL = f"""lv AS (
  SELECT l_orderkey, l_linenumber, l_partkey, {SPECIAL} AS v_str, CASE WHEN l_partkey % 3 = 0 THEN 'number' WHEN ({SPECIAL}) IS NULL THEN 'blank' ELSE 'text' END AS kind,
         CASE WHEN l_partkey % 3 = 0 THEN l_quantity % 2 END AS v_num, CASE WHEN l_suppkey % 4 = 0 THEN '=A' || l_linenumber || '+''My Sheet''!$B$' || (l_partkey % 50 + 1) END AS formula,
         CASE WHEN l_suppkey % 8 = 0 THEN 'present' ELSE 'missing' END AS cache_status
  FROM lineitem
)"""

STATE_SQL = """CASE WHEN formula IS NOT NULL AND cache_status <> 'present' THEN 'formula_cache_missing' WHEN kind = 'blank' THEN 'blank' WHEN kind = 'number' THEN CASE WHEN v_num = 0 THEN 'zero' ELSE 'number' END
  WHEN trim(v_str) = '-' THEN 'dash' WHEN lower(trim(v_str)) IN ('ns', 'n/s', 'n.a.', 'n/a', 'na') THEN 'ns' WHEN lower(trim(v_str)) IN ('xxx', 'xxxx', 'tbd', 'to be completed') THEN 'placeholder'
  WHEN trim(v_str) LIKE '#%' THEN 'excel_error' ELSE 'text' END"""


# Tables with groups, sections, formulas and remarks: one for each customer's
# nation, one row for every order; three kinds of tables by nation.
MIXED = """mo AS (
  SELECT 'N' || c_nationkey AS sheet, c_nationkey % 3 AS g, o_orderkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) + 1 AS row FROM orders JOIN customer ON o_custkey = c_custkey
), mr AS (
  SELECT *, (row - 2) % 7 = 0 AS is_section, g = 1 AND (row - 2) % 7 > 0 AS tall, (row - 2) // 7 AS block FROM mo
), ms AS (
  SELECT *, CASE WHEN is_section THEN 'section_header' WHEN k % 5 = 0 THEN 'total' ELSE 'data' END AS what, CASE WHEN is_section THEN 'block ' || block ELSE CASE WHEN k % 5 = 0 THEN 'Total ' ELSE 'item ' END || k END AS nm, 'BLOCK ' || block AS sect, 'group ' || block AS anchor FROM mr
), mx AS (
  SELECT sheet, g, k, row, 1 AS col, CASE WHEN is_section THEN 'text' WHEN g = 1 AND (row - 2) % 7 > 1 THEN 'blank' ELSE 'text' END AS kind, CASE WHEN is_section THEN upper(nm) WHEN g = 1 AND (row - 2) % 7 > 1 THEN NULL ELSE anchor END AS v_str, CAST(NULL AS DOUBLE) AS v_num, CAST(NULL AS VARCHAR) AS formula, false AS cached, tall, what, nm, sect, anchor FROM ms
  UNION ALL SELECT sheet, g, k, row, 2, 'text', nm, NULL, NULL, false, tall, what, nm, sect, anchor FROM ms WHERE NOT is_section
  UNION ALL SELECT sheet, g, k, row, 3, 'integer', NULL, k % 4, NULL, false, tall, what, nm, sect, anchor FROM ms WHERE NOT is_section
  UNION ALL SELECT sheet, g, k, row, 4, CASE WHEN g = 2 OR k % 2 = 0 THEN 'integer' ELSE 'formula' END, NULL, CASE WHEN g = 2 OR k % 2 = 0 THEN k % 3 END, CASE WHEN g < 2 THEN '=C' || row || '*2' END, k % 2 = 0, tall, what, nm, sect, anchor FROM ms WHERE NOT is_section
  UNION ALL SELECT sheet, g, k, row, 5, 'text', CASE WHEN g = 2 THEN repeat('remark ', 20) || k ELSE 'plain ' || k END, NULL, NULL, false, tall, what, nm, sect, anchor FROM ms WHERE NOT is_section AND (g <> 2 OR (row - 2) % 7 = 3 AND row < 12)
  UNION ALL SELECT DISTINCT sheet, g, CAST(NULL AS BIGINT), CAST(1 AS BIGINT), h.col, 'text', h.name, CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), false, false, 'header', h.name, NULL, NULL FROM ms,
    LATERAL (VALUES (1, 'Group'), (2, 'Name'), (3, 'Actual 2025'), (4, CASE WHEN g = 0 THEN 'B2026 vs PLAN 2026' ELSE 'PLAN 2026' END), (5, 'Remark')) h(col, name)
)"""


def mixed_tables(spark, sf) -> DataFrame:
    """Each nation's orders as a messy table: section bands, totals, formulas
    with and without a stored result, in some a merged group column, in some a
    column of remarks."""
    c = F.col
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), c("o_custkey") == c("c_custkey"))
    row = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("o_orderkey")) + 1
    o = o.select(F.concat(F.lit("N"), c("c_nationkey").cast("string")).alias("sheet"), (c("c_nationkey") % 3).alias("g"), c("o_orderkey").alias("k"), row.alias("row"))
    step, block = (c("row") - 2) % 7, F.floor((c("row") - 2) / 7).cast("string")
    band, even = step == 0, c("k") % 2 == 0
    none = lambda kind: F.lit(None).cast(kind)
    name = F.concat(F.when(c("k") % 5 == 0, "Total ").otherwise("item "), c("k").cast("string"))

    def cell(when, col, kind, text=None, number=None, formula=None, cached=None, tall=None):
        inner = F.struct(F.lit(col).alias("col"), kind.alias("kind"), (none("string") if text is None else text).alias("v_str"), (none("double") if number is None else number.cast("double")).alias("v_num"), (none("string") if formula is None else formula).alias("formula"), F.when(F.lit(False) if formula is None else formula.isNotNull(), F.when(F.lit(False) if cached is None else cached, "present").otherwise("missing")).otherwise("not_applicable").alias("cache_status"), (F.lit(False) if tall is None else tall).alias("tall"))
        return F.when(when, inner)

    lent, calc = (c("g") == 1) & (step > 1), c("g") < 2
    cells = F.array_compact(F.array(
        cell(F.lit(True), 1, F.when(~band & lent, "blank").otherwise("text"), F.when(band, F.concat(F.lit("BLOCK "), block)).when(~lent, F.concat(F.lit("group "), block)), tall=(c("g") == 1) & ~band),
        cell(~band, 2, F.lit("text"), name), cell(~band, 3, F.lit("integer"), number=c("k") % 4),
        cell(~band, 4, F.when(~calc | even, "integer").otherwise("formula"), number=F.when(~calc | even, c("k") % 3), formula=F.when(calc, F.concat(F.lit("=C"), c("row").cast("string"), F.lit("*2"))), cached=even),
        cell(~band & ((c("g") != 2) | ((step == 3) & (c("row") < 12))), 5, F.lit("text"), F.when(c("g") == 2, F.concat(F.repeat(F.lit("remark "), F.lit(20)), c("k").cast("string"))).otherwise(F.concat(F.lit("plain "), c("k").cast("string")))),
    ))
    body = o.select("sheet", "row", "g", F.explode(cells).alias("x")).select("sheet", "row", "x.*")
    heads = F.array(*[F.struct(F.lit(k).alias("col"), n.alias("v_str")) for k, n in ((1, F.lit("Group")), (2, F.lit("Name")), (3, F.lit("Actual 2025")), (4, F.when(c("g") == 0, "B2026 vs PLAN 2026").otherwise("PLAN 2026")), (5, F.lit("Remark")))])
    top = o.select("sheet", "g").distinct().select("sheet", F.lit(1).alias("row"), F.explode(heads).alias("x"))
    top = top.select("sheet", "row", "x.col", F.lit("text").alias("kind"), "x.v_str", none("double").alias("v_num"), none("string").alias("formula"), F.lit("not_applicable").alias("cache_status"), F.lit(False).alias("tall"))
    first = F.when(c("tall"), c("row") - (c("row") - 2) % 7 + 1).cast("int")
    place, anchor = c("row") + c("col"), F.concat(F.lit("group "), block)
    return top.unionByName(body).select(
        F.lit("wb").alias("workbook"), "sheet", c("row").cast("int").alias("row"), "col", a1(c("row"), c("col")).alias("coord"), "kind", "v_str", "v_num", "formula", "cache_status", (place % 5).cast("int").alias("border_edges"), F.lit(False).alias("has_fill"), (c("row") == 1).alias("bold"),
        none("string").alias("style_hash"), first.alias("m_row"), F.when(c("tall"), 1).alias("m_col"), (first + 5).alias("m_row2"), F.when(c("tall"), 1).alias("m_col2"), *[F.when(c("tall"), anchor).alias(n) for n in ("a_said", "a_text", "a_head", "a_shown")],
        c("tall").alias("a_full"), F.lit(False).alias("a_measure"), none("string").alias("a_formula"),
    )


# --- sources and scalar expressions


@query(f"WITH {NATION} SELECT sheet, row, col, chr(64 + col) || row AS coord, kind, v_str, v_num FROM nc")
def grid_cells(spark, sf):
    return nation_grid(spark, sf).select("sheet", "row", "col", "coord", "kind", "v_str", "v_num")


@query("""WITH n AS (SELECT p_partkey, p_partkey % 16384 + 1 AS k FROM part), x AS (
  SELECT p_partkey, k, CASE WHEN k <= 26 THEN chr(CAST(64 + k AS INTEGER)) WHEN k <= 702 THEN chr(CAST(65 + (k - 27) // 26 AS INTEGER)) || chr(CAST(65 + (k - 27) % 26 AS INTEGER))
    ELSE chr(CAST(65 + (k - 703) // 676 AS INTEGER)) || chr(CAST(65 + (k - 703) // 26 % 26 AS INTEGER)) || chr(CAST(65 + (k - 703) % 26 AS INTEGER)) END AS letters FROM n)
SELECT p_partkey, letters, k AS number_back, letters || p_partkey AS coord FROM x""")
def a1_encode(spark, sf):
    k = F.col("p_partkey") % 16384 + 1
    return table(spark, sf, "part").select("p_partkey", column_letters(k).alias("letters"), column_number(column_letters(k)).cast("long").alias("number_back"), F.concat(column_letters(k), F.col("p_partkey").cast("string")).alias("coord"))


@query("""SELECT p_partkey, CAST(p_size + 1 AS INTEGER) AS min_row, 2 AS min_col, CAST(p_size + 1 + p_partkey % 9 AS INTEGER) AS max_row, 28 AS max_col,
  'B' || (p_size + 1) || ':AB' || (p_size + 1 + p_partkey % 9) AS ref FROM part""")
def a1_parse(spark, sf):
    low, high = F.col("p_size") + 1, F.col("p_size") + 1 + F.col("p_partkey") % 9
    ref = F.concat(F.lit("'My Sheet'!$ab$"), high.cast("string"), F.lit(":B"), low.cast("string"))
    r = Rect.parse(ref)
    return table(spark, sf, "part").select("p_partkey", *r.columns(), r.ref.alias("ref"))


@query(f"""WITH {RECTS} SELECT a.id AS left_id, b.id AS right_id, greatest(0, least(a.max_row, b.max_row) - greatest(a.min_row, b.min_row) + 1) * greatest(0, least(a.max_col, b.max_col) - greatest(a.min_col, b.min_col) + 1) AS both,
  greatest(0, a.min_row - b.max_row, b.min_row - a.max_row) + greatest(0, a.min_col - b.max_col, b.min_col - a.max_col) AS distance,
  least(a.min_row, b.min_row) AS min_row, least(a.min_col, b.min_col) AS min_col, greatest(a.max_row, b.max_row) AS max_row, greatest(a.max_col, b.max_col) AS max_col
FROM pr a JOIN pr b ON b.id = a.id + 20""")
def bounds_geometry(spark, sf):
    rects = part_rects(spark, sf)
    a, b = rects.alias("a"), rects.alias("b")
    ra, rb = Rect.of(alias="a"), Rect.of(alias="b")
    return a.join(b, F.col("b.id") == F.col("a.id") + 20).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), ra.intersection_area(rb).alias("both"), ra.distance(rb).alias("distance"), *ra.union(rb).columns())


@query(f"WITH {SPECIAL_SQL} SELECT l_orderkey, l_linenumber, l_partkey, {STATE_SQL} AS state FROM lv")
def value_state(spark, sf):
    c = F.col
    return special_values(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", values.value_state(c("kind"), c("v_str"), c("v_num"), c("formula"), c("cache_status")).alias("state"))


@query(f"WITH {SPECIAL_SQL} SELECT kind, {STATE_SQL} AS state, count(*) AS n FROM lv GROUP BY ALL")
def value_kind_histogram(spark, sf):
    c = F.col
    return special_values(spark, sf).groupBy("kind", values.value_state(c("kind"), c("v_str"), c("v_num"), c("formula"), c("cache_status")).alias("state")).agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '=B1' END AS formula, CASE WHEN o_orderkey % 2 = 0 THEN 'present' ELSE 'missing' END AS st, o_orderstatus AS cached, o_orderpriority AS literal FROM orders)
SELECT o_orderkey, CASE WHEN formula IS NULL THEN literal WHEN st = 'present' THEN cached END AS effective, CASE WHEN formula IS NULL THEN literal WHEN st = 'present' THEN cached ELSE formula END AS display,
  CASE WHEN formula IS NULL THEN literal WHEN st = 'present' THEN cached ELSE '∅ cache' END AS preview, coalesce(formula, literal) AS export_formula FROM x""")
def effective_value(spark, sf):
    key = F.col("o_orderkey")
    x = table(spark, sf, "orders").select("o_orderkey", F.when(key % 3 == 0, "=B1").alias("formula"), F.when(key % 2 == 0, "present").otherwise("missing").alias("st"), F.col("o_orderstatus").alias("cached"), F.col("o_orderpriority").alias("literal"))
    args = [F.col(n) for n in ("formula", "st", "cached", "literal")]
    shown = values.effective(*args)
    return x.select("o_orderkey", shown.alias("effective"), values.display_value(*args).alias("display"), values.preview(*args).alias("preview"), values.clean_export(shown, F.col("formula"), F.col("literal"), True).alias("export_formula"))


@query(r"""SELECT doc_id, trim(regexp_replace(text, '[\s\v\x1c-\x1f\x{85}\x{a0}\p{Z}]+', ' ', 'g')) AS normal FROM documents""")
def normalize_ws(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize_ws(F.col("text")).alias("normal"))


@query(r"""WITH s AS (SELECT p_partkey, p_name, trim(regexp_replace(lower(p_name || ' / ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS t FROM part)
SELECT p_partkey, rtrim(substr(t, 1, 20), '-') AS slug, CASE WHEN p_partkey % 4 = 0 THEN '''=' || p_name ELSE p_name END AS guarded FROM s""")
def slug_and_guard(spark, sf):
    both = F.concat(F.col("p_name"), F.lit(" / "), F.col("p_brand"))
    risky = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("="), F.col("p_name"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", text.slug(both, limit=20).alias("slug"), text.csv_guard(risky).alias("guarded"))


@query("""SELECT n_nationkey, 'cell_' || substr(sha256('{"coordinate":"A' || n_nationkey || '","sheet":"' || n_name || '"}'), 1, 18) AS cell_id FROM nation""")
def cell_ids(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", hashing.cell_id(F.col("n_name"), F.concat(F.lit("A"), F.col("n_nationkey").cast("string"))).alias("cell_id"))


@query("""SELECT DISTINCT l_returnflag AS fill, l_linestatus AS font, sha256('{"fill":"' || l_returnflag || '","font":"' || l_linestatus || '"}') AS style_hash FROM lineitem""")
def style_dictionary(spark, sf):
    one = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("fill"), F.col("l_linestatus").alias("font")).distinct()
    return one.withColumn("style_hash", hashing.stable_hash(fill=F.col("fill"), font=F.col("font")))


LABELS = """CASE o_orderkey % 8 WHEN 0 THEN 'Actual ' WHEN 1 THEN 'B ' WHEN 2 THEN 'F3 ' WHEN 3 THEN 'PLAN ' WHEN 4 THEN 'Target ' WHEN 5 THEN 'Delta ' WHEN 6 THEN 'FTE nb ' ELSE 'Cost keur ' END || year(o_orderdate) % 100 + 2000"""


@query(f"""WITH x AS (SELECT o_orderkey, {LABELS} AS label, o_orderkey % 8 AS k, CAST(year(o_orderdate) % 100 + 2000 AS INTEGER) AS y FROM orders)
SELECT o_orderkey, label, CASE k WHEN 0 THEN 'actual' WHEN 1 THEN 'budget' WHEN 2 THEN 'forecast' WHEN 3 THEN 'plan' WHEN 4 THEN 'target' WHEN 5 THEN 'comparison' END AS scenario, y AS year,
  CASE WHEN k = 5 THEN 'variance' END AS comparison_kind, CASE k WHEN 6 THEN 'FTE' WHEN 7 THEN 'K€' END AS unit, CASE WHEN k = 6 THEN 'FTE' WHEN k = 7 THEN 'Cost' ELSE 'OPEX' END AS measure FROM x""")
def header_semantics(spark, sf):
    k = F.col("o_orderkey") % 8
    names = ["Actual ", "B ", "F3 ", "PLAN ", "Target ", "Delta ", "FTE nb ", "Cost keur "]
    label = F.concat(F.element_at(F.array(*[F.lit(n) for n in names]), (k + 1).cast("int")), (F.year("o_orderdate") % 100 + 2000).cast("string"))
    x = table(spark, sf, "orders").select("o_orderkey", label.alias("label"))
    return x.select("o_orderkey", "label", *headers.semantics(F.array("label"), F.lit("OPEX")))


NOISE = """CASE conv_id % 6 WHEN 0 THEN 'Please copy the table below' WHEN 1 THEN 'Source: ledger' WHEN 2 THEN 'Fill in all cells' WHEN 3 THEN 'Note 1 applies' WHEN 4 THEN 'TOTAL' ELSE 'Revenue' END"""


@query(f"""WITH x AS (SELECT conv_id, turn, {NOISE} AS label, CASE turn % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'section_header' WHEN 2 THEN 'unknown' ELSE 'spacer' END AS role, conv_id % 6 AS k FROM conversations),
n AS (SELECT *, CASE k WHEN 0 THEN 'banner' WHEN 1 THEN 'source' WHEN 2 THEN 'instruction' WHEN 3 THEN 'note' END AS kind FROM x)
SELECT conv_id, turn, kind, CASE role WHEN 'section_header' THEN 'section' WHEN 'spacer' THEN 'spacer' WHEN 'data' THEN NULL ELSE kind END AS reason FROM n""")
def noise_and_drop_reason(spark, sf):
    k = F.col("conv_id") % 6
    names = ["Please copy the table below", "Source: ledger", "Fill in all cells", "Note 1 applies", "TOTAL", "Revenue"]
    label = F.element_at(F.array(*[F.lit(n) for n in names]), (k + 1).cast("int"))
    t = F.col("turn") % 4
    role = F.when(t == 0, "data").when(t == 1, "section_header").when(t == 2, "unknown").otherwise("spacer")
    texts = F.when(role == "data", F.array(label, F.lit("Margin"))).otherwise(F.array(label))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.noise_kind(label).alias("kind"), text.row_drop_reason(role, texts, F.lit(0)).alias("reason"))


@query(f"""WITH {SPECIAL_SQL} SELECT l_orderkey, l_linenumber, l_partkey, 'A' || l_linenumber || ',''My Sheet''!$B$' || (l_partkey % 50 + 1) AS operands,
  '=R[' || (l_linenumber - (l_partkey % 100 + 1)) || ']C[-2]+''My Sheet''!R' || (l_partkey % 50 + 1) || 'C2' AS signature FROM lv WHERE formula IS NOT NULL""")
def formula_signature(spark, sf):
    f = special_values(spark, sf).where("formula is not null")
    return f.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(formulas.dependencies_udf("formula"), ",").alias("operands"), formulas.signature_udf("formula", (F.col("l_partkey") % 100 + 1).cast("int"), F.lit(3)).alias("signature"))


@query(f"""WITH {SPECIAL_SQL} SELECT l_orderkey, l_linenumber, l_partkey, 'My Sheet' AS sheet FROM lv WHERE formula IS NOT NULL""")
def dependency_missing(spark, sf):
    f = special_values(spark, sf).where("formula is not null")
    named = f.select("l_orderkey", "l_linenumber", "l_partkey", F.explode(formulas.referenced_sheets(formulas.simple_dependencies(F.col("formula")))).alias("sheet"))
    catalog = table(spark, sf, "nation").select(F.col("n_name").alias("sheet"))
    return named.join(catalog, "sheet", "left_anti").select("l_orderkey", "l_linenumber", "l_partkey", "sheet")


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'broken' WHEN 1 THEN 'dynamic_unresolved' WHEN 2 THEN 'external_unresolved' WHEN 3 THEN 'static' ELSE 'raw' END AS status FROM part""")
def name_status(spark, sf):
    k = F.col("p_partkey") % 5
    definition = F.when(k == 0, "Sheet1!#REF!").when(k == 1, "OFFSET(Sheet1!A1,1,1)").when(k == 2, "[1]Sheet1!A1").when(k == 3, F.concat(F.lit("Sheet1!$A$1:$B$"), (F.col("p_size") + 1).cast("string"))).otherwise("0.19")
    status = formulas.name_status(definition)
    r = Rect.parse(definition)
    static = definition.contains("!") & r.r1.isNotNull() & (r.area <= 1000) & ~r.is_full_axis
    return table(spark, sf, "part").select("p_partkey", F.when((status == "raw") & F.coalesce(static, F.lit(False)), "static").otherwise(status).alias("status"))


@query("""SELECT n_nationkey + 1 AS position, n_name AS sheet FROM nation WHERE n_name GLOB '*A*' OR n_nationkey + 1 IN (2, 3, 5)""")
def sheet_selection(spark, sf):
    from .selection import select_sheets

    catalog = table(spark, sf, "nation").select((F.col("n_nationkey") + 1).alias("position"), F.col("n_name").alias("sheet"), F.lit("visible").alias("state"))
    return select_sheets(catalog, globs=["*A*"], indexes="2-3,5").select("position", "sheet")


# --- spatial joins


@query(f"""WITH {NATION} SELECT nc.sheet, nc.row, nc.col, CASE WHEN nc.col = 2 AND nc.row >= 2 THEN (nc.row - 2) // 2 * 2 + 2 END AS merge_row, coalesce(nc.col = 2 AND nc.row >= 2 AND nc.row % 2 = 0, false) AS is_anchor,
  coalesce(a.v_str, CASE WHEN nc.col = 2 AND nc.row >= 2 THEN NULL ELSE nc.v_str END) AS resolved FROM nc LEFT JOIN nc a ON nc.col = 2 AND nc.row >= 2 AND a.sheet = nc.sheet AND a.col = 2 AND a.row = (nc.row - 2) // 2 * 2 + 2""")
def merge_resolve(spark, sf):
    cells = nation_grid(spark, sf)
    merges = cells.where("col = 2 and row >= 2 and row % 2 = 0").select("workbook", "sheet", F.col("row").alias("min_row"), F.lit(2).alias("min_col"), (F.col("row") + 1).alias("max_row"), F.lit(2).alias("max_col"))
    out = spatial.resolve_merges(cells, merges)
    return out.select("sheet", "row", "col", Rect.parse(F.col("merge_ref")).r1.alias("merge_row"), F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"), F.col("resolved_str").alias("resolved"))


@query(f"""WITH {SUPPLIER}, {RECTS} SELECT sc.s_suppkey, coalesce(string_agg('v' || pr.id, ',' ORDER BY 'v' || pr.id), '') AS members, count(pr.id) AS n
FROM sc LEFT JOIN pr ON sc.sheet = pr.sheet AND sc.row BETWEEN pr.min_row AND pr.max_row AND sc.col BETWEEN pr.min_col AND pr.max_col GROUP BY sc.s_suppkey""")
def validation_membership(spark, sf):
    ranges = part_rects(spark, sf).withColumn("name", F.concat(F.lit("v"), F.col("id").cast("string")))
    out = spatial.memberships(supplier_cells(spark, sf), ranges, "name")
    return out.select("s_suppkey", F.array_join("members", ",").alias("members"), F.size("members").cast("long").alias("n"))


@query(f"""WITH {SUPPLIER}, {RECTS} SELECT DISTINCT ON (s_suppkey) s_suppkey, pr.id FROM sc JOIN pr ON sc.sheet = pr.sheet AND sc.row BETWEEN pr.min_row AND pr.max_row AND sc.col BETWEEN pr.min_col AND pr.max_col
ORDER BY s_suppkey, (max_row - min_row + 1) * (max_col - min_col + 1), min_row, min_col, pr.id""")
def smallest_merge(spark, sf):
    cells = supplier_cells(spark, sf)
    found = spatial.smallest_containing(cells, part_rects(spark, sf), "id")
    return cells.join(found, ["workbook", "sheet", "row", "col"]).select("s_suppkey", "id")


@query(f"""WITH {SUPPLIER}, {RECTS} SELECT s_suppkey FROM sc WHERE EXISTS (SELECT 1 FROM pr WHERE sc.sheet = pr.sheet AND sc.row BETWEEN pr.min_row AND pr.max_row AND sc.col BETWEEN pr.min_col AND pr.max_col)""")
def candidate_cells(spark, sf):
    return spatial.cells_in_rects(supplier_cells(spark, sf), part_rects(spark, sf), "left_semi").select("s_suppkey")


@query(f"""WITH {SUPPLIER}, {RECTS} SELECT s_suppkey FROM sc WHERE NOT EXISTS (SELECT 1 FROM pr WHERE sc.sheet = pr.sheet AND sc.row BETWEEN pr.min_row AND pr.max_row AND sc.col BETWEEN pr.min_col AND pr.max_col)""")
def unassigned_cells(spark, sf):
    return spatial.cells_in_rects(supplier_cells(spark, sf), part_rects(spark, sf), "left_anti").select("s_suppkey")


@query(f"""WITH {SUPPLIER} SELECT s_suppkey, row % 3 = 0 AS row_hidden, col BETWEEN 4 AND 6 OR col BETWEEN 10 AND 11 AS column_hidden FROM sc""")
def dim_hidden(spark, sf):
    cells = supplier_cells(spark, sf)
    rows = cells.select("workbook", "sheet", "row").distinct().withColumn("hidden", F.col("row") % 3 == 0)
    spans = cells.select("workbook", "sheet").distinct().select("workbook", "sheet", F.explode(F.array(F.struct(F.lit(4).alias("min_col"), F.lit(6).alias("max_col")), F.struct(F.lit(10).alias("min_col"), F.lit(11).alias("max_col")))).alias("s"), F.lit(True).alias("hidden")).select("workbook", "sheet", "s.*", "hidden")
    return spatial.hidden_cells(cells, rows, spans).select("s_suppkey", "row_hidden", "column_hidden")


@query(f"""WITH {RECTS}, a AS (SELECT *, id AS note FROM pr WHERE id % 40 = 0), b AS (SELECT *, id AS table_id FROM pr WHERE id % 40 <> 0),
d AS (SELECT a.note, b.table_id, greatest(0, a.min_row - b.max_row, b.min_row - a.max_row) + greatest(0, a.min_col - b.max_col, b.min_col - a.max_col) AS distance, b.min_row, b.min_col FROM a JOIN b USING (sheet))
SELECT DISTINCT ON (note) note, table_id, distance FROM d ORDER BY note, distance, min_row, min_col""")
def nearest_table(spark, sf):
    r = part_rects(spark, sf)
    notes, tables = r.where("id % 40 = 0").withColumnRenamed("id", "note"), r.where("id % 40 <> 0").withColumnRenamed("id", "table_id")
    return spatial.nearest(notes, tables, "note", "table_id").select("note", "table_id", "distance")


@query(f"""WITH {RECTS} SELECT a.id AS left_id, b.id AS right_id, round(i / (aa + ba - i), 6) AS iou FROM (
  SELECT a.id, b.id AS id2, 0 FROM pr a, pr b WHERE false) z(x, y, w) RIGHT JOIN (SELECT * FROM pr) a ON false JOIN pr b ON a.sheet = b.sheet AND a.id < b.id,
  LATERAL (SELECT CAST(greatest(0, least(a.max_row, b.max_row) - greatest(a.min_row, b.min_row) + 1) * greatest(0, least(a.max_col, b.max_col) - greatest(a.min_col, b.min_col) + 1) AS DOUBLE) AS i,
    (a.max_row - a.min_row + 1) * (a.max_col - a.min_col + 1) AS aa, (b.max_row - b.min_row + 1) * (b.max_col - b.min_col + 1) AS ba) WHERE i > 0""")
def overlap_pairs(spark, sf):
    return spatial.overlap_pairs(part_rects(spark, sf), "id").select("left_id", "right_id", "iou")


@query(f"""WITH {ORDERS}, strong AS (SELECT * FROM oc WHERE (row * 3 + col) % 11 = 0), weak AS (SELECT * FROM oc WHERE (row * 3 + col) % 11 <> 0)
SELECT sheet, row, col FROM weak w WHERE EXISTS (SELECT 1 FROM strong s WHERE s.sheet = w.sheet AND s.row = w.row AND s.col IN (w.col - 1, w.col + 1)) OR EXISTS (SELECT 1 FROM strong s WHERE s.sheet = w.sheet AND s.col = w.col AND s.row IN (w.row - 1, w.row + 1))""")
def weak_style_adjacency(spark, sf):
    cells = orders_grid(spark, sf)
    return spatial.weak_style_cells(cells.where("(row * 3 + col) % 11 = 0"), cells.where("(row * 3 + col) % 11 <> 0")).select("sheet", "row", "col")


@query(f"""WITH {RECTS}, rs AS (SELECT sheet, CAST(unnest(range(min_row, max_row + 1)) AS INTEGER) AS row, min_col, max_col FROM pr WHERE (max_row - min_row + 1) * (max_col - min_col + 1) <= 12)
SELECT DISTINCT sheet, row, CAST(unnest(range(min_col, max_col + 1)) AS INTEGER) AS col FROM rs""")
def bounded_materialise(spark, sf):
    return spatial.materialise(part_rects(spark, sf), 12).select("sheet", "row", "col")


@query(f"""WITH {SUPPLIER}, d AS (SELECT DISTINCT sheet, row, col FROM sc), n AS (SELECT *, lead(col) OVER (PARTITION BY sheet, row ORDER BY col) AS next FROM d)
SELECT sheet, row, col, next, next - col - 1 AS gap FROM n WHERE next - col - 1 <= 2""")
def gap_edges(spark, sf):
    cells = supplier_cells(spark, sf).select("workbook", "sheet", "row", "col").distinct()
    return spatial.gap_edges(cells, "horizontal", 2).select("sheet", "row", "col", "next", "gap")


@query(f"""WITH RECURSIVE {SUPPLIER}, d AS (SELECT DISTINCT sheet, row, col, row * 1000 + col AS id FROM sc),
e AS (SELECT a.sheet, a.id AS x, b.id AS y FROM d a JOIN d b ON a.sheet = b.sheet AND ((a.row = b.row AND abs(a.col - b.col) = 1) OR (a.col = b.col AND abs(a.row - b.row) = 1))),
r(sheet, id, root) AS (SELECT sheet, id, id FROM d UNION SELECT r.sheet, e.y, r.root FROM r JOIN e ON e.sheet = r.sheet AND e.x = r.id),
m AS (SELECT sheet, id, min(root) AS root FROM r GROUP BY ALL)
SELECT sheet, CAST(min(id // 1000) AS INTEGER) AS min_row, CAST(min(id % 1000) AS INTEGER) AS min_col, CAST(max(id // 1000) AS INTEGER) AS max_row, CAST(max(id % 1000) AS INTEGER) AS max_col, count(*) AS cells FROM m GROUP BY sheet, root""")
def components_bbox(spark, sf):
    cells = supplier_cells(spark, sf).select("workbook", "sheet", "row", "col").distinct()
    return spatial.components(cells).drop("workbook")


# --- aggregates, windows and sets


@query(f"WITH {ORDERS} SELECT sheet, min(row) AS min_row, min(col) AS min_col, max(row) AS max_row, max(col) AS max_col FROM oc WHERE kind = 'number' GROUP BY sheet")
def content_bounds(spark, sf):
    return spatial.content_bounds(orders_grid(spark, sf), F.col("kind") == "number").drop("workbook")


NOTHING = "cached_formulas uncached_formulas merged_cells merges validated conditional comments hyperlinks in_hidden_rows in_hidden_columns".split()


@query(f"""WITH {ORDERS} SELECT sheet, count(*) AS cells, count(*) FILTER (kind <> 'blank') AS values, 0 AS formulas, count(*) FILTER ((row + col) % 5 > 0) AS bordered, count(*) FILTER ((row + col) % 3 = 0) AS filled,
  count(*) FILTER (kind IN ('integer', 'number')) AS numeric, max(row) AS last_row, max(col) AS last_col, count(*) FILTER (kind = 'text') AS texts, 0 AS booleans, 0 AS datetimes, 0 AS errors, 0 AS blanks, count(*) FILTER (row = 1) AS bold,
  {', '.join(f'0 AS {n}' for n in NOTHING)}, count(DISTINCT (row + col) % 2) AS styles FROM oc GROUP BY sheet""")
def sheet_counts(spark, sf):
    return aggregates.sheet_counts(orders_grid(spark, sf)).drop("workbook")


@query(f"""WITH {MIXED}, body AS (SELECT * FROM mx WHERE row > 1) SELECT sheet, col, count(*) FILTER (kind = 'text') AS text, count(*) FILTER (kind = 'text' AND length(v_str) >= 80) AS long_text, count(*) FILTER (kind IN ('integer', 'number')) AS numeric, count(formula) AS formula,
  count(*) FILTER ((row + col) % 5 > 0) AS border, 0 AS validation, count(*) FILTER (col = 1 AND tall) AS vertical_merge FROM body GROUP BY sheet, col""")
def column_stats(spark, sf):
    made = structure.infer(mixed_tables(spark, sf))
    return structure.body_counts(made.cells, made.tables).drop("workbook")


@query(f"""WITH {MIXED}, s AS (SELECT sheet, col, g, count(*) FILTER (kind = 'text') AS text, count(*) FILTER (kind = 'text' AND length(v_str) >= 80) AS long_text, count(*) FILTER (kind IN ('integer', 'number')) AS numeric, count(formula) AS formula, bool_or(tall) AS tall FROM mx WHERE row > 1 GROUP BY ALL)
SELECT sheet, col, CASE WHEN col = 1 AND tall THEN 'row_group' WHEN col <= 2 THEN 'row_label' WHEN col = 3 THEN 'measure' WHEN col = 4 AND g = 0 THEN 'variance' WHEN col = 4 AND formula > numeric THEN 'formula_measure' WHEN col = 4 THEN 'measure'
  WHEN long_text > numeric + formula THEN 'annotation' ELSE 'dimension' END AS role FROM s""")
def column_roles(spark, sf):
    return structure.infer(mixed_tables(spark, sf)).columns.select("sheet", "col", "role")


@query(f"""WITH {NATION} SELECT sheet, row, count(*) FILTER (kind = 'integer') AS values, count(DISTINCT v_str) AS texts, count(*) FILTER ((row + col) % 5 > 0) AS bordered, arg_min(v_str, col) FILTER (kind = 'text') AS first_text FROM nc GROUP BY sheet, row""")
def row_stats(spark, sf):
    out = aggregates.row_stats(nation_grid(spark, sf))
    return out.select("sheet", "row", "values", F.col("texts").cast("long").alias("texts"), "bordered", "first_text")


@query(f"""WITH {MIXED} SELECT sheet, row, any_value(what) AS role, max(CASE WHEN what = 'section_header' THEN upper(nm) ELSE sect END) AS section FROM mx WHERE row > 1 GROUP BY sheet, row""")
def row_roles(spark, sf):
    return structure.infer(mixed_tables(spark, sf)).rows.select("sheet", "row", "role", "section")


@query(f"WITH {MIXED} SELECT DISTINCT sheet, 1 AS first_header, 1 AS last_header, 'Group' AS title, 3 AS first_period, CASE g WHEN 0 THEN 'comparison' ELSE 'plan' END AS last_scenario FROM mx")
def header_band(spark, sf):
    made = structure.infer(mixed_tables(spark, sf))
    period = made.columns.where("year is not null").groupBy("sheet").agg(F.min("col").alias("first_period"), F.max_by("scenario", "col").alias("last_scenario"))
    return made.tables.join(period, "sheet").select("sheet", F.array_min("header_rows").alias("first_header"), F.array_max("header_rows").alias("last_header"), "title", "first_period", "last_scenario")


@query("""SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus || o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS section FROM orders""")
def section_carry(spark, sf):
    mark = F.when(F.col("o_orderkey") % 7 == 0, F.concat("o_orderstatus", F.col("o_orderkey").cast("string")))
    return windows.carry_forward(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", mark, "section").select("o_orderkey", "section")


@query("""WITH s AS (SELECT o_custkey, o_orderstatus AS title, o_orderkey AS start_row, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nxt FROM orders WHERE o_orderkey % 5 = 0),
b AS (SELECT o_custkey, max(o_orderkey) AS bottom FROM orders GROUP BY 1) SELECT o_custkey, title, start_row, coalesce(nxt - 1, bottom) AS end_row FROM s JOIN b USING (o_custkey)""")
def section_ranges(spark, sf):
    return windows.section_ranges(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", F.col("o_orderkey") % 5 == 0, F.col("o_orderstatus"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey) - 1 AS occurrence,
  l_returnflag || CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey) > 1 THEN ' (' || row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey) || ')' ELSE '' END AS label FROM lineitem""")
def occurrence_keys(spark, sf):
    keyed = windows.occurrence(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"], ["l_linenumber", "l_partkey"])
    keyed = windows.unique_labels(keyed.withColumn("at", F.struct("l_linenumber", "l_partkey")), ["l_orderkey"], "l_returnflag", "at", "label")
    return keyed.select("l_orderkey", "l_linenumber", "l_partkey", F.col("occurrence").cast("long").alias("occurrence"), "label")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, min(l_linestatus) AS v FROM lineitem GROUP BY ALL),
i AS (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey, v ORDER BY l_linenumber) AS island FROM x)
SELECT l_orderkey, v, min(l_linenumber) AS "start", max(l_linenumber) AS "end", count(*) AS size FROM i GROUP BY l_orderkey, v, island""")
def value_runs(spark, sf):
    one = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_linestatus").alias("v"))
    return windows.runs(one, ["l_orderkey"], "l_linenumber", "v")


@query(f"""WITH {SUPPLIER}, r AS (SELECT sheet, row, list(DISTINCT col) AS cols FROM sc GROUP BY ALL), p AS (SELECT *, lag(cols) OVER (PARTITION BY sheet ORDER BY row) AS b FROM r)
SELECT sheet, round(avg(len(list_intersect(cols, b)) / len(list_distinct(list_concat(cols, b)))), 6) AS regularity FROM p WHERE b IS NOT NULL GROUP BY sheet""")
def row_jaccard(spark, sf):
    return windows.adjacent_jaccard(supplier_cells(spark, sf), ["sheet"])


@query("""SELECT event_type, user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def warning_dedup(spark, sf):
    return aggregates.warning_dedup(table(spark, sf, "events"), ["event_type", "user_id"], ["ts", "event_id"]).select("event_type", "user_id", "event_id", "value")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
SELECT event_type, count(*) AS n, arg_min(props, event_id) AS first_message, string_agg(event_id, ',' ORDER BY event_id) FILTER (rn <= 5) AS examples FROM r GROUP BY event_type""")
def warning_summary(spark, sf):
    return aggregates.warning_summary(table(spark, sf, "events"), "event_type", "event_id", "props")


@query("""WITH r AS (SELECT l_returnflag, l_orderkey, sha256(string_agg(l_linenumber || ':' || l_partkey, chr(10) ORDER BY l_linenumber, l_linenumber || ':' || l_partkey)) AS h FROM lineitem GROUP BY ALL),
b AS (SELECT l_returnflag, l_orderkey // 4096 AS block, sha256(string_agg(h, chr(10) ORDER BY l_orderkey)) AS h FROM r GROUP BY ALL)
SELECT l_returnflag, sha256(string_agg(h, chr(10) ORDER BY block)) AS digest FROM b GROUP BY l_returnflag""")
def sheet_digest(spark, sf):
    payload = F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    return aggregates.digest(table(spark, sf, "lineitem"), payload, ["l_returnflag"], ["l_linenumber"], "l_orderkey")


@query("""SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 120""")
def preview_topn(spark, sf):
    return windows.top_n(table(spark, sf, "orders"), ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 120).select("o_orderpriority", "o_orderkey", "o_totalprice", "rank")


@query(f"""WITH {SPECIAL_SQL}, a AS (SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n, max(formula) AS f FROM lv WHERE formula IS NOT NULL AND l_linenumber <> 3 GROUP BY ALL),
b AS (SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n, max(formula) AS f FROM lv WHERE formula IS NOT NULL AND l_linenumber <> 1 GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN b.n IS NULL THEN 'raw_only' WHEN a.n IS NULL THEN 'sheet_only' WHEN a.f = b.f THEN 'both' ELSE 'different' END AS side FROM a FULL JOIN b USING (l_orderkey, l_linenumber, l_partkey)""")
def formula_reconcile(spark, sf):
    f = special_values(spark, sf).where("formula is not null").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.max("formula").alias("formula"))
    return aggregates.reconcile(f.where("l_linenumber <> 3"), f.where("l_linenumber <> 1"), ["l_orderkey", "l_linenumber", "l_partkey"], "formula")


# --- detection, structure, cleaning, export


@query()
def candidate_score(spark, sf):
    """Metrics, confidence and decision of the tables found on the grids."""
    found = detect.detect_tables(orders_grid(spark, sf).unionByName(nation_grid(spark, sf)))
    return found.withColumns({n: F.array_join(n, "; ") for n in ("methods", "reasons")})


@query(f"""WITH {SUPPLIER}, d AS (SELECT sheet, CAST(avg(row) * 100 AS INTEGER) % 100 / 100.0 AS confidence FROM sc GROUP BY sheet)
SELECT sheet, CAST(confidence AS DOUBLE) AS confidence, CASE WHEN confidence >= 0.5 THEN 'accepted' WHEN confidence >= 0.35 THEN 'uncertain' ELSE 'rejected' END AS decision FROM d""")
def threshold_split(spark, sf):
    d = supplier_cells(spark, sf).groupBy("sheet").agg((F.round(F.avg("row") * 100).cast("int") % 100 / 100).alias("confidence"))
    return detect.split(d)


@query()
def suppressed_candidates(spark, sf):
    r = part_rects(spark, sf).withColumn("candidate", F.col("id").cast("string")).withColumn("forced", F.col("id") % 200 == 0).withColumn("confidence", F.col("id") % 97 / 100).drop("id")
    return detect.suppress(r)


@query(f"""WITH RECURSIVE {RECTS}, c AS (SELECT * FROM pr WHERE id % 40 = 0), m AS (SELECT * FROM pr WHERE id % 40 <> 0),
g(sheet, id, r1, c1, r2, c2) AS (SELECT sheet, id, min_row, min_col, max_row, max_col FROM c UNION
  SELECT g.sheet, g.id, min(least(g.r1, m.min_row)), min(least(g.c1, m.min_col)), max(greatest(g.r2, m.max_row)), max(greatest(g.c2, m.max_col))
  FROM g JOIN m ON m.sheet = g.sheet AND m.min_row <= g.r2 AND m.max_row >= g.r1 AND m.min_col <= g.c2 AND m.max_col >= g.c1 GROUP BY g.sheet, g.id, g.r1, g.c1, g.r2, g.c2)
SELECT id AS candidate, min(r1) AS min_row, min(c1) AS min_col, max(r2) AS max_row, max(c2) AS max_col FROM g GROUP BY id""")
def snap_bounds(spark, sf):
    r = part_rects(spark, sf)
    out = detect.snap_to_merges(r.where("id % 40 = 0").withColumnRenamed("id", "candidate"), r.where("id % 40 <> 0"))
    return out.select("candidate", "min_row", "min_col", "max_row", "max_col")


@query(f"""WITH {MIXED}, l AS (SELECT sheet, row, any_value(mx.what) AS what, max(CASE WHEN g = 2 THEN nm ELSE 'plain ' || k END) FILTER (mx.what <> 'section_header') AS label, max(CASE WHEN mx.what = 'section_header' THEN upper(nm) ELSE sect END) AS section FROM mx WHERE row > 1 GROUP BY sheet, row)
SELECT mx.sheet, mx.row, mx.col, l.label AS row_label, l.section, CASE WHEN col = 3 THEN 'Actual 2025' WHEN g = 0 THEN 'B2026 vs PLAN 2026' ELSE 'PLAN 2026' END AS column_header, CASE WHEN col = 3 THEN 'actual' WHEN g = 0 THEN 'comparison' ELSE 'plan' END AS scenario,
  CASE WHEN formula IS NULL OR cached THEN CASE WHEN v_num = 0 THEN 'zero' ELSE 'number' END ELSE 'formula_cache_missing' END AS value_state, formula, CASE WHEN formula IS NULL OR cached THEN CAST(v_num AS BIGINT) END AS value, l.what AS row_role
FROM mx JOIN l USING (sheet, row) WHERE row > 1 AND col IN (3, 4) AND l.what <> 'section_header'""")
def long_records(spark, sf):
    out = export.long_records(structure.infer(mixed_tables(spark, sf)))
    return out.select("sheet", "row", "col", "row_label", "section", "column_header", "scenario", "value_state", "formula", F.col("value").cast("long").alias("value"), "row_role")


@query(f"""WITH {NATION} SELECT sheet, row, max(v_str) AS row_label, CAST(CAST(max(v_num) FILTER (col = 1) AS BIGINT) AS VARCHAR) AS n_nationkey, CAST(CAST(max(v_num) FILTER (col = 3) AS BIGINT) AS VARCHAR) AS n_regionkey FROM nc WHERE row > 1 GROUP BY sheet, row""")
def values_wide(spark, sf):
    return export.values_wide(export.long_records(structure.infer(nation_grid(spark, sf))), ["n_nationkey", "n_regionkey"]).drop("workbook")


@query(f"""WITH {MIXED}, l AS (SELECT sheet, row, max(CASE WHEN what = 'section_header' THEN upper(nm) ELSE sect END) AS section FROM mx WHERE row > 1 GROUP BY sheet, row),
k AS (SELECT *, CASE WHEN formula IS NOT NULL AND NOT cached THEN formula WHEN v_num IS NOT NULL THEN CAST(CAST(v_num AS BIGINT) AS VARCHAR) ELSE v_str END AS own FROM mx WHERE row > 1 AND what <> 'section_header' AND NOT (col = 5 AND g = 2))
SELECT k.sheet, k.row, k.col, l.section, CASE k.col WHEN 1 THEN CASE g WHEN 1 THEN 'Entity' ELSE 'Activity' END WHEN 2 THEN 'Name' WHEN 3 THEN 'Actual 2025' WHEN 4 THEN CASE WHEN g = 0 THEN 'B2026 vs PLAN 2026' ELSE 'PLAN 2026' END ELSE 'Remark' END AS label,
  CASE WHEN col = 1 AND tall THEN coalesce(own, anchor) ELSE own END AS value, col = 1 AND tall AND own IS NULL AS inherited FROM k JOIN l USING (sheet, row)""")
def clean_table(spark, sf):
    return clean.clean(structure.infer(mixed_tables(spark, sf))).cells.select("sheet", "row", "col", "section", "label", "value", "inherited")


@query(f"WITH {MIXED} SELECT DISTINCT sheet, row, CASE WHEN row = 1 THEN 'header' ELSE 'section' END AS reason FROM mx WHERE row = 1 OR what = 'section_header'")
def dropped_rows(spark, sf):
    return clean.clean(structure.infer(mixed_tables(spark, sf))).dropped_rows.select("sheet", "row", "reason")


@query(f"WITH {MIXED} SELECT DISTINCT sheet, col, 'annotation' AS reason FROM mx WHERE col = 5 AND g = 2")
def dropped_columns(spark, sf):
    return clean.clean(structure.infer(mixed_tables(spark, sf))).dropped_columns.select("sheet", "col", "reason")


@query("""WITH x AS (SELECT n_nationkey, n_nationkey % 3 AS g, n_nationkey % 2 AS s, n_nationkey % 4 AS v, n_nationkey % 2 AS l, n_nationkey % 5 AS p, n_nationkey % 3 AS d FROM nation)
SELECT n_nationkey, CASE WHEN g > 0 AND s > 0 THEN 'compound_matrix' WHEN g > 0 THEN 'horizontal_compound_matrix' WHEN s > 0 AND v >= 2 THEN 'sectioned_matrix' WHEN v >= 2 AND l > 0 THEN 'matrix' WHEN d > 0 AND p = d THEN 'input_grid' WHEN v = 1 AND l > 0 THEN 'list' ELSE 'region' END AS layout FROM x""")
def layout_kind(spark, sf):
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").select("n_nationkey", structure.layout_kind(k % 3, k % 2, k % 4, k % 2, k % 5, k % 3).alias("layout"))


@query()
def workbook_scan(spark, sf):
    """A workbook written from the nation table and read back by the reader."""
    from .sources import ooxml
    from .sources.ooxml_writer import write_sample

    return ooxml.read_cells(spark, write_sample(spark, sf)).select("workbook", "sheet", "row", "col", "coord", "kind", "v_str", "v_num", "formula", "cache_status")


@query()
def zip_parts(spark, sf):
    from .sources import ooxml
    from .sources.ooxml_writer import write_sample

    return ooxml.read_parts(spark, write_sample(spark, sf)).select("workbook", "name", "content_type", "size", "sha256", "kind")

