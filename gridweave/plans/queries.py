"""Queries over the relational test tables, each with the SQL that gives the same rows.

The tables hold no Markdown tables, HTML tables or page images, so each query builds its input from base rows: what a table, page or response made of those rows has
to yield is then known from the rows themselves, and the SQL says it directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..functions.base import table
from ..functions.cleanup import corrected, corrected_table, fixes
from ..functions.layout import absorb_header_rows, compact_header, demote_false_header, realign_rows, split_multi_value
from ..functions.names import grid_names, parser_names, response_names
from ..functions.rendering import markdown_table, plain_grid
from ..functions.similarity import jaccard, similarity
from ..operators import assembly, geometry, grids, markdown, prose, responses
from ..operators.folds import fold_tables, stitch_outline, stitch_responses
from ..sources import pages as sources_pages
from ..sources import readers, writers
from ..sources.backends import grid_backend, html_backend
from .jobs import cascade, classic, classify, flagged_pages, unified

QUERIES: dict = {}
SQL: dict[str, str] = {}


#: One row for each order, under the names that several queries use: a key, a name that holds the key, a group.
_KEYED = "select o_orderkey as n_nationkey, 'SALE_' || o_orderkey as n_name, o_custkey as n_regionkey from orders"


def query(sql: str | None):
    if sql and " keyed" in sql:
        sql = f"with keyed as ({_KEYED})" + (f", {sql[5:]}" if sql.startswith("with ") else f" {sql}")

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr("o_orderkey as n_nationkey", "concat('SALE_', o_orderkey) as n_name", "o_custkey as n_regionkey")


def e(text: str):
    return F.expr(text)


def strings(*items: str):
    return F.array(*[F.lit(x) for x in items])


def ordered(rows: DataFrame, key: str, order: str, **columns: str) -> DataFrame:
    """For each key the columns' values as arrays, in the order."""
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o_"), *[e(x).alias(c) for c, x in columns.items()]))).alias("p"))
    return packed.select(key, *[e(f"transform(p, x -> x.{c})").alias(c) for c in columns])


_LINES = r"""(select doc_id, i, parts[i] as line from (select doc_id, parts, unnest(range(1, case when parts[-1] = '' then len(parts) else len(parts) + 1 end)) as i from (select doc_id, string_split(text, chr(10)) as parts from documents)))"""
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_TABLEISH = r"({0} <> '' and (regexp_matches({0}, '\p{{Nd}}{{1,3}}(?:\.\p{{Nd}}{{3}}){{2,}}') or regexp_matches({0}, '^(?:[IVX]+|\p{{Nd}}+(?:[./⁄]\p{{Nd}}+)*)(?:\s|$)') or contains({0}, '|') or regexp_full_match({0}, '[A-G1-7]')))"


@query(f"select doc_id, cast(count(*) as bigint) as n_lines, cast(sum(length(line)) as bigint) as n_chars from {_LINES} group by doc_id")
def md_lines(spark, sf_dir):
    return markdown.lines(read(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line").cast("long")).alias("n_chars"))


@query(rf"select doc_id, cast(count_if(contains(line, '|')) as bigint) as n_pipe, cast(count_if(regexp_matches(line, '^\s*\|?\s*:?-{{2,}}:?\s*(\|\s*:?-{{2,}}:?\s*)+\|?\s*$')) as bigint) as n_separator, cast(count_if({_TABLEISH.format('s')}) as bigint) as n_tableish from (select doc_id, line, {_STRIP.format('line')} as s from {_LINES}) group by doc_id")
def md_line_classes(spark, sf_dir):
    line = F.col("line")
    return markdown.lines(read(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count_if(P.has_pipe(line)).alias("n_pipe"), F.count_if(P.is_separator(line)).alias("n_separator"), F.count_if(P.is_tableish(T.stripped(line))).alias("n_tableish"))


def order_markdown(spark, sf_dir) -> DataFrame:
    """(doc_id, text): for each customer prose, a table of orders, prose."""
    rows = ordered(read(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", line="concat('| ', o_orderkey, ' | ', o_orderstatus, ' | ', o_orderpriority, ' |')")
    text = F.concat_ws("\n", e("concat('# Customer ', o_custkey)"), F.lit("A lone | stays prose."), F.lit(""), F.lit("| Order | Status | Priority |"), F.lit("|---|:---:|---|"), F.array_join("line", "\n"), F.lit(""), F.lit("The end."))
    return rows.select(F.col("o_custkey").alias("doc_id"), text.alias("text"))


def segmented(docs: DataFrame) -> DataFrame:
    n = lambda c: F.coalesce(F.size(c).cast("long"), F.lit(0))
    return markdown.blocks(docs).select("doc_id", F.col("block_no").cast("long"), "kind", F.when(F.col("table").isNull(), 0).otherwise(n("table.rows")).alias("n_rows"), F.when(F.col("table").isNull(), 0).otherwise(n("table.header")).alias("n_cols"))


@query("select o_custkey as doc_id, b as block_no, case b when 1 then 'table' else 'text' end as kind, case b when 1 then n else 0 end as n_rows, case b when 1 then 3 else 0 end::bigint as n_cols from (select o_custkey, count(*) as n from orders group by 1), (select unnest([0, 1, 2])::bigint as b)")
def md_segment_tables(spark, sf_dir):
    return segmented(order_markdown(spark, sf_dir))


# A row whose four cells all have one or two characters counts as noise.
@query("""with r as (select *, (row_number() over (partition by l_orderkey order by l_linenumber, concat('| ', l_linenumber, ' | P', l_partkey, ' |', l_returnflag, '| ', l_linestatus, ' |')) - 1)::bigint as k from lineitem where l_partkey > 9)
select l_orderkey as doc_id, k as row_no, unnest([0, 1, 2, 3])::bigint as col_no, unnest([l_linenumber::varchar, 'P' || l_partkey, l_returnflag, l_linestatus]) as text from r
union all select doc_id, -1, unnest([0, 1, 2, 3])::bigint, unnest(['Line', 'Part', 'Flag', 'Status']) from (select distinct l_orderkey as doc_id from r)""")
def md_table_cells(spark, sf_dir):
    rows = ordered(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", line="concat('| ', l_linenumber, ' | P', l_partkey, ' |', l_returnflag, '| ', l_linestatus, ' |')")
    docs = rows.select(F.col("l_orderkey").alias("doc_id"), F.concat_ws("\n", F.lit("Line | Part | Flag | Status"), F.lit("--- | --- | --- | ---"), F.array_join("line", "\n")).alias("text"))
    found = markdown.cells(markdown.blocks(docs).where("kind = 'table'"), "doc_id")
    return found.select("doc_id", F.col("row_no").cast("long"), F.col("col_no").cast("long"), "text")


@query("""select r, k, page, name, second, third from (select n_regionkey as r, (row_number() over (partition by n_regionkey order by n_nationkey) - 1)::bigint as k, (n_regionkey + 1)::varchar as page, n_name as name, '' as second, 'N ' || n_nationkey as third from keyed)
union all select distinct n_regionkey, -1, 'page', 'Name', 'Column_2', 'Name_2' from keyed""")
def grid_to_table(spark, sf_dir):
    rows = ordered(keyed(spark, sf_dir), "n_regionkey", "n_nationkey", row="array(concat(' ', n_name), cast(null as string), concat('N\\n', n_nationkey))")
    raw = rows.select(F.col("n_regionkey").alias("doc_id"), F.col("n_regionkey").alias("page_no"), F.lit(0).alias("index_on_page"), F.concat(F.array(F.array(F.lit("Name"), F.lit(None).cast("string"), F.lit("Name"))), "row").alias("rows"))
    found = grids.grid_tables(raw, provenance=True)
    lines = found.select("doc_id", F.posexplode(F.concat(F.array("table.header"), "table.rows")).alias("k", "c"))
    return lines.select(F.col("doc_id").alias("r"), (F.col("k") - 1).cast("long").alias("k"), *[F.col("c")[i].alias(n) for i, n in ((0, "page"), (2, "name"), (3, "second"), (4, "third"))])


_NTH = "row_number() over (partition by p_size, p_brand order by p_partkey)"


@query(f"select p_size, p_partkey, case when n = 1 then p_brand else p_brand || '_' || (n - 1) end as parser_name, case when n = 1 then p_brand else p_brand || '_' || n end as grid_name, case when n = 1 then p_brand else p_brand || '_' || n end as response_name from (select *, {_NTH} as n from part)")
def dedupe_headers(spark, sf_dir):
    rows = ordered(read(spark, sf_dir, "part"), "p_size", "p_partkey", p_partkey="p_partkey", b="p_brand")
    named = rows.select("p_size", "p_partkey", parser_names(F.col("b")).alias("a"), grid_names(F.col("b")).alias("g"), response_names(F.col("b")).alias("r"))
    return named.select("p_size", F.explode(F.arrays_zip("p_partkey", "a", "g", "r")).alias("z")).select("p_size", "z.p_partkey", F.col("z.a").alias("parser_name"), F.col("z.g").alias("grid_name"), F.col("z.r").alias("response_name"))


_CODES = "concat(l_suppkey % 20, '.', l_linenumber)", "concat(cast(l_quantity as int), case when l_linenumber % 2 = 0 then '.000' else ',5' end)", "case l_linenumber % 3 when 0 then 'IV' when 1 then 'x' else 'Part IV' end"


@query(rf"""select l_orderkey, l_linenumber, k, text, regexp_full_match(text, '(?i:[IVXLCDM]+)|\p{{Nd}}+(?:\.\p{{Nd}}+)*') as is_code, regexp_full_match(text, '-?\p{{Nd}}{{1,3}}(?:[.,]\p{{Nd}}{{3}})+(?:[.,]\p{{Nd}}+)?|-?\p{{Nd}}+[.,]\p{{Nd}}{{1,2}}') as is_money
from (select l_orderkey, l_linenumber, unnest([0, 1, 2])::bigint as k, unnest([{', '.join(_CODES)}]) as text from lineitem)""")
def outline_money_flags(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.posexplode(F.array(*map(e, _CODES))).alias("k", "text"))
    return rows.select("l_orderkey", "l_linenumber", F.col("k").cast("long"), "text", P.is_outline_code(F.col("text")).alias("is_code"), P.is_money_like(F.col("text")).alias("is_money"))


_PAIRS = [("the ", "teh "), ("teh ", "then "), ("que", "qve"), ("qve\n", "QUE "), ("ung", "")]


@query("select doc_id, md5(x) as digest, x <> text as changed from (select doc_id, text, replace(replace(replace(replace(replace(text, 'the ', 'teh '), 'teh ', 'then '), 'que', 'qve'), 'qve' || chr(10), 'QUE '), 'ung', '') as x from documents)")
def ocr_replace(spark, sf_dir):
    fixed = corrected(F.col("text"), _PAIRS)
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(fixed.cast("binary")).alias("digest"), (fixed != F.col("text")).alias("changed"))


@query(rf"""with s as (select doc_id, i, {_STRIP.format('line')} as line from {_LINES}), t as (select *, min(case when {_TABLEISH.format('line')} then i end) over (partition by doc_id) as stop, coalesce(sum(case when line <> '' then 1 else 0 end) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as before from s)
select d.doc_id, coalesce(md5({_STRIP.format('x')}), md5('')) as digest from documents d left join (select doc_id, string_agg(line, chr(10) order by i) as x from t where i < coalesce(stop, 1000000000) and before < 24 group by doc_id) using (doc_id)""")
def prose_header_lines(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(prose.header_lines(F.col("text")).cast("binary")).alias("digest"))


@query(rf"""with s as (select doc_id, i, {_STRIP.format('line')} as line from {_LINES}), f as (select * from s where line <> '' and not {_TABLEISH.format('line')} and length(array_to_string(regexp_extract_all(line, '[A-Za-zÀ-ỹĂÂÊÔƠƯăâêôơưĐđ]{{3,}}'), '')) >= 6)
select d.doc_id, md5(coalesce(x, '')) as digest, coalesce(n, 0)::bigint as n_lines from documents d left join (select doc_id, string_agg(line, chr(10) order by i) as x, count(*) as n from f group by doc_id) using (doc_id)""")
def footer_filter(spark, sf_dir):
    kept = prose.clean_footer(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(kept.cast("binary")).alias("digest"), F.when(kept == "", 0).otherwise(F.size(F.split(kept, "\n"))).cast("long").alias("n_lines"))


@query("select n_nationkey, n_name || chr(10) || 'of region ' || n_regionkey || ', seen' || chr(10) || chr(10) || n_name || ' ends' as plain from keyed")
def md_to_plain(spark, sf_dir):
    text = e("concat('## ', n_name, '\\n![stamp](a.jpeg)\\nof region<br>', n_regionkey, ',<br/>seen ![x](y.png)\\n\\n\\n\\n', n_name, ' ends\\n![](z.png)\\n')")
    return keyed(spark, sf_dir).select("n_nationkey", T.markdown_to_plain(text).alias("plain"))


_TOKENS = r"list_distinct(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_./%+-]+'))"


@query(f"select doc_id, item_id, case when len(a) = 0 or len(b) = 0 then 0.0 else len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b))) end as overlap from (select doc_id, item_id, {_TOKENS.format('d.text')} as a, {_TOKENS.format('k.text')} as b from documents d join (select *, row_number() over (order by item_id) - 1 as place, count(*) over () as n from benchmark) k on place = doc_id % n)")
def token_jaccard(spark, sf_dir):
    """Every document with an item; all items have their turn, however many there are."""
    items = read(spark, sf_dir, "benchmark")
    n = items.count()
    # The items' places: the benchmark is the small table here, and its ids alone are ordered.
    place = items.select("item_id", (F.row_number().over(Window.orderBy("item_id")) - 1).alias("place"))
    items = items.join(place, "item_id").select("item_id", "place", F.array_distinct(T.tokens(F.col("text"))).alias("b"))
    docs = read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % n).alias("place"), F.array_distinct(T.tokens(F.col("text"))).alias("a"))
    return docs.join(items, "place").select("doc_id", "item_id", jaccard(F.col("a"), F.col("b")).alias("overlap"))


def shaped(cols: str, rows: str):
    """A table of so many columns c1, c2, ... and rows, all of whose cells are v."""
    header = f"transform(sequence(1, cast({cols} as int)), i -> concat('c', i))"
    body = f"case when {rows} > 0 then transform(sequence(1, cast({rows} as int)), r -> transform({header}, i -> 'v')) else cast(array() as array<array<string>>) end"
    return table(e(header), e(body))


def _score_sql(cm: str, rm: str, ce: str, re: str) -> str:
    content = f"(least({cm}, {ce}) + case when {rm} > 0 and {re} > 0 then 1 else 0 end)::double / (greatest({cm}, {ce}) + case when {rm} > 0 or {re} > 0 then 1 else 0 end)"
    col = f"case when {cm} = {ce} then 1.0::double when abs({cm} - {ce}) = 1 then 0.7::double * (least({cm}, {ce})::double / greatest({cm}, {ce})) else 0.35::double * (least({cm}, {ce})::double / greatest({cm}, {ce})) end"
    ratio = f"(least({rm}, {re})::double / greatest({rm}, {re}))"
    row = f"case when greatest({rm}, {re}) = 0 then 1.0::double when {re} > {rm} * 2 and {rm} > 0 then greatest({ratio}, 0.55::double) else {ratio} end"
    return f"round(0.5::double * ({col}) + 0.25::double * ({row}) + 0.25::double * ({content}), 9)"


_SHAPE = ("p_size % 4 + 1", "p_partkey % 5", "p_size // 7 % 4 + 1", "p_partkey % 7")


@query(f"select p_partkey, {_score_sql(*(f'({x})' for x in _SHAPE))} as score from part")
def table_similarity(spark, sf_dir):
    m, x = shaped(*_SHAPE[:2]), shaped(_SHAPE[2].replace("//", "div"), _SHAPE[3])
    return read(spark, sf_dir, "part").select("p_partkey", F.round(similarity(m, x), 9).alias("score"))


@query(f"select p_partkey as doc_id, j as table_no, s as score from (select *, row_number() over (partition by p_partkey order by s desc, j) as k from (select p_partkey, j, {_score_sql('(p_size % 4 + 1)', '(p_partkey % 5)', '(j + 1)', '(j * 2)')} as s from part, (select unnest([0, 1, 2])::bigint as j))) where k = 1")
def best_match(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    own = part.select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("block_no"), F.lit("table").alias("kind"), shaped(*_SHAPE[:2]).alias("table"))
    found = part.select(F.col("p_partkey").alias("doc_id"), F.explode(e("array(0, 1, 2)")).alias("j")).select("doc_id", F.col("j").cast("long").alias("table_no"), shaped("j + 1", "j * 2").alias("table"))
    return assembly.matches(own, found).where("rank = 1").select("doc_id", "table_no", F.round("score", 9).alias("score"))


def _two_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """For each customer two table blocks that share the orders between them, and one extracted table with all of them and proper values."""
    rows = ordered(read(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", rough="concat('| ', o_orderkey, ' | ?', o_orderstatus, ' |')", fine="array(cast(o_orderkey as string), concat(o_orderstatus, ' ', o_orderpriority))").where(F.size("fine") > 1)
    head, half = "| Order | Status and priority |\n|---|---|\n", "cast(ceil(size(rough) / 2) as int)"
    text = F.concat(F.lit(head), e(f"array_join(slice(rough, 1, {half}), '\\n')"), F.lit("\n\nBetween them.\n\n" + head), e(f"array_join(slice(rough, {half} + 1, size(rough)), '\\n')"))
    docs = rows.select(F.col("o_custkey").alias("doc_id"), text.alias("text"))
    return docs, rows.select(F.col("o_custkey").alias("doc_id"), F.lit(0).alias("table_no"), table(strings("Order", "Status and priority"), F.col("fine")).alias("table"))


@query("""with o as (select o_custkey, o_orderkey, o_orderstatus, o_orderpriority, row_number() over (partition by o_custkey order by o_orderkey) as k, count(*) over (partition by o_custkey) as n from orders), p as (select *, ceil(n / 2)::bigint as h from o where n > 1)
select o_custkey as doc_id, 0::bigint as part_no, k - 1 as row_no, o_orderkey::varchar as code, o_orderstatus || ' ' || o_orderpriority as value from p where k <= h or n <= h + 2
union all select o_custkey, 2, k - h - 1, o_orderkey::varchar, case when n <= h + 2 then '?' || o_orderstatus else o_orderstatus || ' ' || o_orderpriority end from p where k > h""")
def greedy_assign(spark, sf_dir):
    docs, found = _two_tables(spark, sf_dir)
    parts = assembly.documents(markdown.blocks(docs), found, [])
    lines = parts.select("doc_id", F.posexplode("parts").alias("p", "b")).where("b.kind = 'table'").select("doc_id", F.col("p").cast("long").alias("part_no"), F.posexplode("b.table.rows").alias("r", "c"))
    return lines.select("doc_id", "part_no", F.col("r").cast("long").alias("row_no"), F.col("c")[0].alias("code"), F.col("c")[1].alias("value"))


@query("select c_custkey as doc_id, case when n > 0 then 1 else 2 end::bigint as n_tables, case when n > 0 then 'Order' else 'Left' end as first_name from (select c_custkey, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by 1)")
def leftover_tables(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id")).distinct()
    sold = order_markdown(spark, sf_dir).join(customers, "doc_id", "left_semi")
    docs = sold.unionByName(customers.join(read(spark, sf_dir, "orders"), e("o_custkey = doc_id"), "left_anti").select("doc_id", F.lit("Only prose here.").alias("text")))
    # Four of six cells with a digit: with five the row would pass for one of column codes and go into the header.
    orphan = lambda k: table(strings("Left", "Over", "Wide", "Table", "Nobody", "Wants"), F.array(strings("1", f"row {k}", "2", "3", "4", "none")))
    found = docs.select("doc_id", F.posexplode(F.array(orphan(1), orphan(2))).alias("table_no", "table"))
    parts = assembly.documents(markdown.blocks(docs), found, []).select("doc_id", F.filter("parts", lambda b: b["kind"] == "table").alias("t"))
    # Orphans carry codes 1 and 1, so the second goes on with the first only if its header were open; it isn't.
    return parts.select("doc_id", F.size("t").cast("long").alias("n_tables"), F.col("t")[0]["table"]["header"][0].alias("first_name"))


_CODE = "concat(l_suppkey, '.', l_linenumber)"


@query("""select l_orderkey, l_linenumber, case when k = 0 then code else code end as c0, 'part ' || l_partkey as c1, case when k = 0 then '25.000' when k = 1 then '' else '' end as c2, case when k = 2 then '7.500' else '' end as c3 from (select *, l_suppkey || '.' || l_linenumber as code, l_linenumber % 3 as k from lineitem)""")
def realign_rows_query(spark, sf_dir):
    row = e(f"case l_linenumber % 3 when 0 then array('25.000', {_CODE}, concat('part ', l_partkey), '') when 1 then array('', {_CODE}, concat('part ', l_partkey), '') else array({_CODE}, concat('part ', l_partkey), '', '7.500') end")
    fixed = F.get(realign_rows(table(strings("No", "Item", "Due", "Paid"), F.array(row)))["rows"], F.lit(0))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[fixed[i].alias(f"c{i}") for i in range(4)])


@query("select n_nationkey, n_nationkey % 2 = 0 as demoted, case when n_nationkey % 2 = 0 then 'Column_1' else n_name end as name, case when n_nationkey % 2 = 0 then 2 else 1 end::bigint as n_rows, case when n_nationkey % 2 = 0 then '1.' || n_nationkey else 'a' end as first_cell, case when n_nationkey % 2 = 0 then '' else 'c' end as third_cell from keyed")
def demote_header(spark, sf_dir):
    header = e("case when n_nationkey % 2 = 0 then array(concat('1.', n_nationkey), concat('Nation ', n_name), 'Column_3') else array(n_name, 'text', 'Column_3') end")
    t = F.col("t")
    return keyed(spark, sf_dir).select("n_nationkey", demote_false_header(table(header, F.array(strings("a", "b", "c")))).alias("t")).select("n_nationkey", (t["header"][0] == "Column_1").alias("demoted"), t["header"][0].alias("name"), F.size(t["rows"]).cast("long").alias("n_rows"), t["rows"][0][0].alias("first_cell"), t["rows"][0][2].alias("third_cell"))


@query("select n_nationkey, n_name || '|second||' as names from keyed")
def compact_header_query(spark, sf_dir):
    return keyed(spark, sf_dir).select("n_nationkey", F.array_join(compact_header(table(F.array(F.lit(""), F.lit(""), F.col("n_name"), F.lit("second")), F.array(strings("1", "2", "3", "4"))))["header"], "|").alias("names"))


@query("select n_nationkey, n_name || ' A|Label ' || n_nationkey || ' B|second label 1|2' as names, 1::bigint as n_rows from keyed")
def absorb_header(spark, sf_dir):
    rows = F.array(e("array('', concat('Label ', n_nationkey), 'second label', '')"), strings("A", "B", "1", "2"), e("array(concat(n_nationkey, '.1'), 'text', '5', '6')"))
    fixed = absorb_header_rows(table(F.array(F.col("n_name"), F.lit(""), F.lit("Column_3"), F.lit("Column_4")), rows))
    # A generic name gives way to the code alone.
    return keyed(spark, sf_dir).select("n_nationkey", F.array_join(fixed["header"], "|").alias("names"), F.size(fixed["rows"]).cast("long").alias("n_rows"))


@query("select s_suppkey, case when s_suppkey % 2 = 0 then 'No|Due|Due_2|Note' else 'No|Due|Note' end as names, case when s_suppkey % 2 = 0 then s_suppkey || '|10.000|' || s_suppkey || ',5|x y' else s_suppkey || '|10.000|x y' end as cells from supplier")
def split_multi_value_query(spark, sf_dir):
    due = e("case when s_suppkey % 2 = 0 then concat('10.000   ', s_suppkey, ',5') else '10.000' end")
    t = split_multi_value(table(strings("No", "Due", "Note"), F.array(F.array(F.col("s_suppkey").cast("string"), due, F.lit("x y")))))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(t["header"], "|").alias("names"), F.array_join(t["rows"][0], "|").alias("cells"))


def _pages(spark, sf_dir):
    """(l_orderkey, tables): each order's lines in tables of two rows, those behind the first with made-up names."""
    rows = ordered(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", row="array(cast(l_linenumber as string), concat('Part ', l_partkey), concat('x', l_quantity))")
    t = lambda names, at: table(names, F.slice(F.col("row"), at, 2))
    generic = strings("Column_1", "Column_2", "Column_3")
    return rows.select("l_orderkey", F.transform(F.sequence(F.lit(1), F.size("row"), F.lit(2)), lambda i: F.when(i == 1, t(strings("No", "Item", "Amount"), i)).otherwise(t(generic, i))).alias("tables"))


_STITCHED = "select l_orderkey, (row_number() over (partition by l_orderkey order by l_linenumber, 'Part ' || l_partkey) - 1)::bigint as k, 'No' as name, l_linenumber::varchar as code, 'Part ' || l_partkey as item from lineitem"


def _unrolled(stitched: DataFrame) -> DataFrame:
    one = stitched.select("l_orderkey", F.explode("t").alias("t")).select("l_orderkey", F.col("t.header")[0].alias("name"), F.posexplode("t.rows").alias("k", "c"))
    return one.select("l_orderkey", F.col("k").cast("long"), "name", F.col("c")[0].alias("code"), F.col("c")[1].alias("item"))


@query(_STITCHED)
def stitch_pages(spark, sf_dir):
    return _unrolled(_pages(spark, sf_dir).select("l_orderkey", fold_tables(F.col("tables"), stitch_outline).alias("t")))


@query(_STITCHED)
def stitch_model_tables(spark, sf_dir):
    return _unrolled(_pages(spark, sf_dir).select("l_orderkey", fold_tables(F.col("tables"), stitch_responses).alias("t")))


@query("""select n_regionkey as doc_id, (row_number() over (partition by n_regionkey order by n_nationkey) - 1)::bigint as k, 'Region' as h0, 'Nation' as h1, 'Nation_2' as h2, n_regionkey::varchar as c0, n_name as c1, n_nationkey || '.000' as c2 from keyed""")
def html_tables(spark, sf_dir):
    rows = ordered(keyed(spark, sf_dir), "n_regionkey", "n_nationkey", row="concat('<td> ', n_name, '</td><td>', n_nationkey, '.000</td></tr>')")
    html = F.concat(F.lit("Sure: <table><tr><th>Region</th><th colspan='2'>Nation</th></tr><tr><td rowspan='"), F.size("row").cast("string"), F.lit("'>"), F.col("n_regionkey").cast("string"), F.lit("</td>"), F.array_join("row", "<tr>"), F.lit("</table><p>done"))
    found = responses.with_tables(rows.select(F.col("n_regionkey").alias("doc_id"), F.lit(0).alias("page_no"), html.alias("response"))).select("doc_id", F.explode("tables").alias("t"))
    lines = found.select("doc_id", F.col("t.header").alias("h"), F.posexplode("t.rows").alias("k", "c"))
    return lines.select("doc_id", F.col("k").cast("long"), *[F.col("h")[i].alias(f"h{i}") for i in range(3)], *[F.col("c")[i].alias(f"c{i}") for i in range(3)])


@query("""select n_nationkey as doc_id, shape, case when shape = 'D' then 'key' else 'Key' end as h0, n_nationkey || '.50' as c0, n_name as c1 from keyed, (select unnest(['A', 'B', 'C', 'D', 'E']) as shape)""")
def json_payloads(spark, sf_dir):
    grid = "concat('{\"headers\": [\"Key\", \"Name\"], \"rows\": [[\"', n_nationkey, '.50\", \"', n_name, '\"], [\"x\"]]}')"
    shapes = {"A": f"concat('[', {grid}, ']')", "B": f"concat('Here: ', {grid})", "C": "concat('```json\\n[[\"Key\", \"Name\"], [\"', n_nationkey, '.50\", \"', n_name, '\"]]\\n```')", "D": "concat('[{\"key\": \"', n_nationkey, '.50\", \"name\": \"', n_name, '\"}]')", "E": f"concat('{{\"tables\": [', {grid}, ']}}')"}
    texts = keyed(spark, sf_dir).select(F.col("n_nationkey").alias("doc_id"), F.explode(F.create_map(*[x for k, v in shapes.items() for x in (F.lit(k), e(v))])).alias("shape", "response"))
    found = texts.select("doc_id", "shape", F.explode(responses.tables_of(F.col("response"))).alias("t"))
    return found.select("doc_id", "shape", F.col("t.header")[0].alias("h0"), F.col("t.rows")[0][0].alias("c0"), F.col("t.rows")[0][1].alias("c1"))


_PROFILE = "select user_id as doc_id, 0 as page_no, 'row' as axis, cast(event_id % 997 as int) as idx, 1.0 as frac from events group by 1, 2, 3, 4"


@query(f"select doc_id, min(idx) as first_idx, max(idx) as last_idx from (select *, sum(new) over (partition by doc_id order by idx) as band from (select doc_id, idx, case when idx - lag(idx) over (partition by doc_id order by idx) > 3 then 1 else 0 end as new from ({_PROFILE}))) group by doc_id, band")
def gap_clusters(spark, sf_dir):
    profile = read(spark, sf_dir, "events").selectExpr("user_id as doc_id", "0 as page_no", "'row' as axis", "cast(event_id % 997 as int) as idx", "1.0D as frac").distinct()
    return geometry.bands(profile).select("doc_id", F.col("start").alias("first_idx"), F.col("end").alias("last_idx"))


@query("select n_nationkey as doc_id, round(greatest(0, 10 - (floor((60 + w) * 0.02) + 5)) * 0.48, 6)::double as x0, round((20 - 6) * 0.48, 6)::double as y0, round((70 + w + floor((60 + w) * 0.02) + 5) * 0.48, 6)::double as x1, round((80 + 6) * 0.48, 6)::double as y1 from (select *, n_nationkey % 25 as w from keyed) where n_nationkey % 3 <> 0")
def table_bbox(spark, sf_dir):
    cols = e("array(10, 25, 40, 55, cast(70 + doc_id % 25 as int))")
    rows = e("case when doc_id % 3 = 0 then array(20, 35, 50, 65) else array(20, 35, 50, 65, 80) end")
    pages = keyed(spark, sf_dir).select(F.col("n_nationkey").alias("doc_id"), F.lit(0).alias("page_no"))
    line = lambda axis, x: pages.select("doc_id", "page_no", F.lit(axis).alias("axis"), F.explode(x).alias("idx"), F.lit(0.9).alias("frac"))
    boxes = geometry.table_boxes(line("col", cols).union(line("row", rows)), pages.select("doc_id", "page_no", F.lit(1000).alias("width"), F.lit(1200).alias("height")))
    return boxes.select("doc_id", *[F.round(k, 6).alias(k) for k in ("x0", "y0", "x1", "y1")])


_ROWS = "(select p_size, list(['' || p_partkey, p_name] order by p_partkey) as r from part group by 1)"


@query(f"select p_size, '| ' || rpad('Key', w0, ' ') || ' | ' || rpad('Name', w1, ' ') || ' |' || chr(10) || array_to_string(list_transform(r, lambda x: '| ' || rpad(x[1], w0, ' ') || ' | ' || rpad(x[2], w1, ' ') || ' |'), chr(10)) as grid from (select p_size, r, greatest(3, list_max(list_transform(r, lambda x: length(x[1]))))::int as w0, greatest(4, list_max(list_transform(r, lambda x: length(x[2]))))::int as w1 from {_ROWS})")
def render_plain(spark, sf_dir):
    rows = ordered(read(spark, sf_dir, "part"), "p_size", "p_partkey", row="array(cast(p_partkey as string), p_name)")
    return rows.select("p_size", plain_grid(table(strings("Key", "Name"), F.col("row"))).alias("grid"))


@query(f"select p_size, '| Key | Name |' || chr(10) || '| --- | --- |' || chr(10) || array_to_string(list_transform(r, lambda x: '| ' || x[1] || '\\|' || ' | ' || x[2] || ' |'), chr(10)) as md from {_ROWS}")
def render_markdown(spark, sf_dir):
    rows = ordered(read(spark, sf_dir, "part"), "p_size", "p_partkey", row="array(concat(p_partkey, '|'), p_name)")
    return rows.select("p_size", markdown_table(table(strings("Key", "Name"), F.col("row"))).alias("md"))


@query("""with o as (select *, greatest(5, max(length(o_orderkey::varchar)) over (partition by o_custkey))::int as w, greatest(8, max(length(o_orderpriority)) over (partition by o_custkey))::int as v from orders)
select o_custkey as doc_id, 'Customer ' || o_custkey || chr(10) || 'A lone | stays prose.' || chr(10) || chr(10) || '| ' || rpad('Order', any_value(w), ' ') || ' | Status | ' || rpad('Priority', any_value(v), ' ') || ' |' || chr(10) || string_agg('| ' || rpad(o_orderkey::varchar, w, ' ') || ' | ' || rpad(o_orderstatus, 6, ' ') || ' | ' || rpad(o_orderpriority, v, ' ') || ' |', chr(10) order by o_orderkey) || chr(10) || chr(10) || 'The end.' || chr(10) as text from o group by o_custkey""")
def compose_txt(spark, sf_dir):
    docs = order_markdown(spark, sf_dir)
    none = docs.select("doc_id", F.lit(0).alias("table_no"), shaped("1", "1").alias("table")).where("false")
    return assembly.documents(markdown.blocks(docs), none, []).select("doc_id", assembly.composed(F.col("parts")).alias("text"))


@query("select c_custkey as doc_id, case when exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F') then 'HAS_TABLES' else 'TEXT_ONLY' end as route from customer")
def classify_docs(spark, sf_dir):
    pages = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"))
    return classify(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id")), pages)


@query("select n_nationkey as doc_id, case when n_nationkey % 3 = 0 then 'paddle' else 'grid' end as backend, 0::bigint as table_no, n_name as cell from keyed where n_nationkey % 3 < 2")
def backend_cascade(spark, sf_dir):
    html = e("case when n_nationkey % 3 = 0 then concat('{\"table_res_list\": [{\"pred_html\": \"\"}, {\"html\": {\"pred\": \"<tr><td>H</td></tr><tr><td>', n_name, '</td></tr>\"}}]}') else '{}' end")
    rows = e("case when n_nationkey % 3 = 2 then cast(array() as array<array<string>>) else array(array('H'), array(n_name)) end")
    pages = keyed(spark, sf_dir).select(F.col("n_nationkey").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0).alias("index_on_page"), html.alias("page_result"), rows.alias("rows"))
    found = cascade(pages, [html_backend(), grid_backend()])
    return found.select("doc_id", "backend", F.col("table_no").cast("long"), F.col("table.rows")[0][0].alias("cell"))


@query("""with o as (select o_custkey, o_orderkey::varchar as code, '?' || o_orderstatus as rough, o_orderstatus || ' ' || o_orderpriority as fine, row_number() over (partition by o_custkey order by o_orderkey) as k, count(*) over (partition by o_custkey) as n from orders), p as (select *, ceil(n / 2)::bigint as h from o where n > 1),
c as (select o_custkey, 0 as part, k, code, fine as value from p where k <= h or n <= h + 2 union all select o_custkey, 1, k, code, case when n <= h + 2 then rough else fine end from p where k > h),
w as (select *, greatest(5, max(length(code)) over (partition by o_custkey, part))::int as a, greatest(19, max(length(value)) over (partition by o_custkey, part))::int as b from c),
g as (select o_custkey, part, count(*) as n, '| ' || rpad('Order', any_value(a), ' ') || ' | ' || rpad('Status and priority', any_value(b), ' ') || ' |' || chr(10) || string_agg('| ' || rpad(code, a, ' ') || ' | ' || rpad(value, b, ' ') || ' |', chr(10) order by k) as grid from w group by 1, 2)
select x.o_custkey as doc_id, 2::bigint as table_count, x.n as n_first, y.n as n_second, 'grid' as backend, false as used_marker_fallback, x.grid || chr(10) || chr(10) || 'Between them.' || chr(10) || chr(10) || y.grid || chr(10) as text from g x join g y on x.o_custkey = y.o_custkey and x.part = 0 and y.part = 1""")
def unified_results(spark, sf_dir):
    docs, found = _two_tables(spark, sf_dir)
    flagged = docs.select("doc_id", F.lit(0).alias("page_no"))
    rows = unified(docs, flagged, found.withColumn("backend", F.lit("grid")), [])
    n = lambda k: F.size(F.get("tables", F.lit(k))["rows"]).cast("long")
    return rows.select("doc_id", F.col("table_count").cast("long"), n(0).alias("n_first"), n(1).alias("n_second"), "backend", "used_marker_fallback", "text")


def _sales(spark, sf_dir) -> DataFrame:
    """(doc_id, tables): one table of orders for each customer."""
    rows = ordered(keyed(spark, sf_dir), "n_regionkey", "n_nationkey", row="array(concat(n_nationkey, '.000'), n_name)")
    return rows.select(F.col("n_regionkey").alias("doc_id"), F.array(table(strings("Key", "Name, long"), F.col("row"))).alias("tables"))


@query("select n_regionkey::bigint as doc_id, (row_number() over (partition by n_regionkey order by n_nationkey) - 1)::bigint as k, n_nationkey || '.000' as code, n_name as name from keyed")
def workbook_round_trip(spark, sf_dir):
    back = readers.workbook_tables(writers.workbooks(_sales(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("long"))))
    return back.select("doc_id", F.posexplode(F.get("tables", F.lit(0))["rows"]).alias("k", "c")).select("doc_id", F.col("k").cast("long"), F.col("c")[0].alias("code"), F.col("c")[1].alias("name"))


@query("""select n_regionkey::bigint as doc_id, md5(chr(65279) || 'Key,"Name, long"' || chr(10) || string_agg(n_nationkey || '.000,' || n_name || chr(10), '' order by n_nationkey)) as digest from keyed group by 1""")
def csv_export(spark, sf_dir):
    return writers.csv_files(_sales(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("long"))).select("doc_id", F.md5("content").alias("digest"))


@query("""select n_regionkey as doc_id, '# Tables preview' || chr(10) || chr(10) || '## Table 1' || chr(10) || chr(10) || '| Key | Name, long |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || '.000 | ' || n_name || ' |', chr(10) order by n_nationkey) || chr(10) as preview from keyed group by 1""")
def markdown_preview(spark, sf_dir):
    return writers.previews(_sales(spark, sf_dir)).select("doc_id", F.decode("content", "UTF-8").alias("preview"))


@query("select n_regionkey as doc_id, cast(sum(case when contains(n_name, 'A') or contains(n_name, '1') then 1 else 0 end + case when contains(n_nationkey || '.000', '1') then 1 else 0 end) as bigint) as n_fixed from keyed group by 1")
def correction_counts(spark, sf_dir):
    t = F.get("tables", F.lit(0))
    return _sales(spark, sf_dir).select("doc_id", fixes(t, corrected_table(t, [("A", "E"), ("1", "one")])).alias("n_fixed"))


@query("select distinct o_custkey as doc_id, o_orderkey as page_no from orders where o_orderstatus = 'F' union select distinct o_custkey, o_orderkey from orders o where o_orderstatus = 'O' and not exists (select 1 from orders f where f.o_custkey = o.o_custkey and f.o_orderstatus = 'F')")
def table_page_detection(spark, sf_dir):
    pages = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"), "o_orderstatus")
    return geometry.table_pages(pages.where("o_orderstatus = 'F'"), pages.where("o_orderstatus = 'O'"))


@query("select l_orderkey as doc_id, l_linenumber as page_no, l_quantity from lineitem where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'P')")
def page_pruning(spark, sf_dir):
    pages = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_no"), "l_quantity")
    open_orders = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey")
    flagged = pages.join(open_orders, F.col("doc_id") == F.col("o_orderkey"), "left_semi")
    return flagged_pages(pages, flagged)


@query("select o_custkey as doc_id, 1::bigint as table_count, '# Customer ' || o_custkey || chr(10) || 'A lone | stays prose.' || chr(10) || chr(10) || chr(10) || 'The end.' || chr(10) as text from orders group by 1")
def classic_parse(spark, sf_dir):
    return classic(order_markdown(spark, sf_dir)).select("doc_id", F.col("table_count").cast("long"), "text")


_CELLS = {"noise": "case k % 4 when 0 then ['a', 'b', 'c'] when 1 then ['1', '2', '3', '4'] when 2 then ['1', '2', 'c'] else ['1', '2', '3', 'longer text'] end", "first": "case k % 3 when 0 then [k || '.1', 'a text of its own', 'x', '1'] when 1 then [k || '.1', 'short', 'x', '1'] else ['word', 'a text of its own', 'x', '1'] end", "sub": "case k % 3 when 0 then ['', '', 'x', 'Label', 'Other'] when 1 then ['', 'a', 'x', 'Label', 'Other'] else ['', '', '', 'ab', 'cd'] end", "blank": "case k % 3 when 0 then ['', '', '', 'x', 'y'] when 1 then ['', '', 'v', 'x', 'y'] else cast([] as varchar[]) end"}


@query(f"""select n_nationkey, k % 4 < 2 as noise, k % 3 = 0 as headerless, k % 3 = 0 as subheader, k % 3 <> 1 as mostly_empty, k % 4 <> 1 as garbled from (select n_nationkey, n_nationkey % 1000 as k from keyed)""")
def row_predicates(spark, sf_dir):
    """What a row is, told from its cells."""
    cells = {c: e(x.replace("k || '.1'", "concat(k, '.1')").replace("cast([] as varchar[])", "cast(array() as array<string>)").replace("[", "array(").replace("]", ")")) for c, x in _CELLS.items()}
    header = e("case k % 4 when 0 then array('ab', 'c d', 'ef') when 1 then array('Order number', 'Amount due') when 2 then cast(array() as array<string>) else array('a', 'b', 'c', 'd') end")
    rows = keyed(spark, sf_dir).selectExpr("n_nationkey", "n_nationkey % 1000 as k").select("n_nationkey", header.alias("header"), *[x.alias(c) for c, x in cells.items()])
    return rows.select("n_nationkey", P.is_noise_row(F.col("noise")).alias("noise"), P.is_headerless_row(F.col("first")).alias("headerless"), P.is_subheader_row(F.col("sub")).alias("subheader"), P.is_mostly_empty(F.col("blank")).alias("mostly_empty"), P.is_garbled(F.col("header")).alias("garbled"))


@query("select n_nationkey as doc_id, 0 as page_no from keyed where n_nationkey % 3 <> 0 and n_nationkey % 97 < 3")
def scanned_table_pages(spark, sf_dir):
    """Rasters of 40 x 40 pixels with five ruled lines each way, or four rows only."""
    lines = "case when doc_id % 3 = 0 then array(2, 10, 18, 26) else array(2, 10, 18, 26, 34) end"
    byte = f"case when array_contains({lines}, cast(floor(i / 40) as int)) or array_contains(array(2, 10, 18, 26, 34), cast(i % 40 as int)) then '00' else 'FF' end"
    pages = keyed(spark, sf_dir).selectExpr("n_nationkey as doc_id").where("doc_id % 97 < 3").select("doc_id", F.lit(0).alias("page_no"), F.lit(40).alias("width"), F.lit(40).alias("height"), e(f"unhex(array_join(transform(sequence(0, 1599), i -> {byte}), ''))").alias("pixels"))
    return geometry.scanned_table_pages(geometry.ink(pages))


@query("""select n_regionkey as doc_id, page, k, name, item from (select n_regionkey, 0 as page, (row_number() over (partition by n_regionkey order by n_nationkey) - 1)::bigint as k, n_name as name, 'No ' || n_nationkey as item from keyed)""")
def ruled_line_tables(spark, sf_dir):
    """Words within ruled lines, one row for each order of a customer."""
    own = ordered(keyed(spark, sf_dir), "n_regionkey", "n_nationkey", name="n_name", item="concat('No ', n_nationkey)").withColumnRenamed("n_regionkey", "doc_id")
    lines = own.select("doc_id", F.size("name").alias("n")).select("doc_id", F.lit(0).alias("page_no"), F.explode(e("concat(transform(sequence(0, n + 1), i -> named_struct('x0', 10.0D, 'y0', 20.0D + 15 * i, 'x1', 210.0D, 'y1', 20.0D + 15 * i)), transform(array(10.0D, 110.0D, 210.0D), x -> named_struct('x0', x, 'y0', 20.0D, 'x1', x, 'y1', 20.0D + 15 * (n + 1))))")).alias("l")).select("doc_id", "page_no", "l.*")
    word = lambda x, y, text: f"named_struct('x0', {x}, 'y0', 22.0D + 15 * ({y}), 'x1', {x} + 10.0D, 'y1', 32.0D + 15 * ({y}), 'text', {text})"
    cells = f"flatten(transform(name, (x, i) -> array({word('20.0D', 'i + 1', 'x')}, {word('120.0D', 'i + 1', 'split(item[i], chr(32))[0]')}, {word('140.0D', 'i + 1', 'split(item[i], chr(32))[1]')})))"
    words = own.select("doc_id", F.lit(0).alias("page_no"), F.explode(e(f"concat(array({word('20.0D', '0', chr(39) + 'Name' + chr(39))}, {word('120.0D', '0', chr(39) + 'Item' + chr(39))}), {cells})")).alias("w")).select("doc_id", "page_no", "w.*")
    found = grids.grid_tables(sources_pages.ruled_tables(lines, words))
    return found.select("doc_id", F.col("page_no").alias("page"), F.posexplode("table.rows").alias("k", "c")).select("doc_id", "page", F.col("k").cast("long"), F.col("c")[0].alias("name"), F.col("c")[1].alias("item"))


@query("""select n_nationkey as doc_id, case when n_nationkey % 2 = 0 then 'Some words of ' || n_name || chr(10) || chr(10) || 'Signed by the person' else 'Some words of ' || n_name || chr(10) || 'and no more of them' end as text from keyed""")
def text_layer(spark, sf_dir):
    """Text around a table's box, or a whole page where there is no table."""
    own = keyed(spark, sf_dir).select(F.col("n_nationkey").alias("doc_id"), F.lit(0).alias("page_no"), "n_name")
    line = lambda y, text, n: e(f"named_struct('y0', {y}D, 'y1', {y + 10}D, 'line_no', {n}, 'text', {text})")
    boxed = F.array(line(20.0, "concat('Some words of ', n_name)", 0), line(100.0, "'| a | b |'", 1), line(300.0, "'Signed by the person'", 2), line(320.0, "'1.2'", 3))
    plain = F.array(line(20.0, "concat('Some words of ', n_name)", 0), line(40.0, "'and no more of them'", 1), line(60.0, "'| 1 | x |'", 2), line(80.0, "'behind the table'", 3))
    words = own.select("doc_id", "page_no", F.explode(F.when(F.col("doc_id") % 2 == 0, boxed).otherwise(plain)).alias("w")).select("doc_id", "page_no", "w.*")
    boxes = own.where("doc_id % 2 = 0").select("doc_id", "page_no", F.lit(90.0).alias("y0"), F.lit(250.0).alias("y1"))
    return sources_pages.text_layer(words, boxes, own.select("doc_id", "page_no", F.lit(400.0).alias("height")))

