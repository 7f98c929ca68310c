"""Statements of scripts derived from the supplied texts, and batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge import BatchOptions, read_scripts, run_batch, run_script_folder, statement_table
from tableforge.functions.script_text import (
    preview,
    strip_block_comments,
    strip_line_comments,
)
from tableforge.names import column_list
from tableforge.sources.catalog import raw_columns
from tableforge.workspace import new_folder
from workload.staging import TEXT_TABLES, new_database, staged, staged_tables, table

# Scripts around whole texts: line and block comments, separators, empty statements.
DOCUMENT_SCRIPT = (
    "concat('-- ', text, chr(10), '  -- kept', chr(10), ';', chr(9), ';', chr(13), chr(10), "
    "'/* ', text, chr(10), '*/SELECT ''', source, ';', text, ''';', chr(10), '--', text, "
    "chr(10), '/**/', chr(10), text, chr(10), chr(1))"
)
PAGE_SCRIPT = (
    "concat('--', html, chr(10), 'SELECT ''', url, ''';', chr(10), html, chr(10), '/*', html, "
    "chr(10), '*/', chr(10), ' ; ', html, chr(13), chr(10), '--', url)"
)


def script_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts are dealt out before the scripts, three times as long, are built of them."""
    tasks = spark.sparkContext.defaultParallelism
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return statement_table(
        documents.repartition(tasks).selectExpr("doc_id AS script_id", f"{DOCUMENT_SCRIPT} AS script")
    )


def script_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    scripts = table(spark, sf_dir, "pages").selectExpr(
        "page_id AS script_id", f"{PAGE_SCRIPT} AS script"
    )
    return statement_table(scripts).select(
        "script_id",
        "statement_no",
        preview(F.col("statement")).alias("preview"),
        F.length("statement").alias("statement_length"),
    )


def script_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of comment removed by itself."""
    scripts = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"replace({DOCUMENT_SCRIPT}, chr(13), '') AS script"
    )
    return scripts.select(
        "doc_id",
        strip_line_comments(F.col("script")).alias("no_line_comments"),
        strip_block_comments(F.col("script")).alias("no_block_comments"),
    )


#: Stands between the scripts of a file; no page has this control character.
SCRIPT_END = "\x1e"


def script_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many scripts in each file, read back one by one; the first line has the page."""

    def write(folder: str) -> None:
        pages = table(spark, sf_dir, "pages").selectExpr(
            f"concat('--', page_id, chr(10), {PAGE_SCRIPT}) AS script"
        )
        pages.write.option("lineSep", SCRIPT_END).text(folder)

    folder = staged(spark, sf_dir, "scripts", write)
    scripts = read_scripts(spark, folder, glob="*.txt", separator=SCRIPT_END)
    page_id = F.regexp_extract("script", r"^--(\d+)", 1).cast("bigint")
    found = statement_table(scripts.select(page_id.alias("script_id"), "script"))
    return found.withColumnRenamed("script_id", "page_id")


#: Whole texts between quotes of each kind and in a hint, with ``;`` and comment marks all over.
QUOTED_TEXT = "replace(replace(text, chr(92), repeat(chr(92), 2)), chr(39), concat(chr(92), chr(39)))"
QUOTED_PARTS = {
    "single": f"concat('SELECT ', chr(39), {QUOTED_TEXT}, ';--', chr(39))",
    "hint": "concat('SELECT /*+ ', replace(text, '*/', '* /'), ';*/ 1')",
    "double": "concat('SELECT ', chr(34), replace(replace(text, chr(92), ''), chr(34), ''), ';/*', chr(34))",
    "backtick": "concat('SELECT ', chr(96), replace(text, chr(96), ''), chr(92), chr(96), ' - 1 / 2')",
}


def script_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separators and comment marks between quotes are text; comments go wherever they start."""
    texts = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "replace(coalesce(text, ''), chr(13), '') AS text"
    )
    comments = [
        "concat('--', replace(text, chr(10), ' '), ';', chr(10))",
        "concat('/* ', replace(text, '*/', '* /'), ';*/')",
    ]
    parts = [f"{part}, {comments[k % 2]}" for k, part in enumerate(QUOTED_PARTS.values())]
    script = f"concat({', chr(59), '.join(parts)})"
    return statement_table(texts.selectExpr("doc_id AS script_id", f"{script} AS script"), quotes=True)


SAMPLE_SCRIPT = """;
SELECT avg(p_retailprice) AS mean_price, max(p_size) AS largest FROM part_of_sample;
   -- segments and their balances, only named ones
SELECT c_mktsegment, sum(c_acctbal) AS balance, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt
   FROM customer_of_sample WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment;/*
;*/SELECT p_partkey, p_retailprice / (SELECT max(p_retailprice) FROM part_of_sample) AS share
   FROM part_of_sample
   WHERE p_size = (SELECT min(p_size) FROM part_of_sample)
;
SELECT c.c_custkey, o.o_orderkey FROM customer_of_sample AS c, orders_of_sample AS o
   WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 0 AND o.o_orderpriority <> '1-URGENT';;
"""


def sample_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates, groups, subqueries and a join as one script: rows told, and rows written."""

    def write(folder: str) -> None:
        spark.createDataFrame([(SAMPLE_SCRIPT,)], "value string").coalesce(1).write.text(folder)

    folder, out = staged(spark, sf_dir, "samples", write), new_folder(spark, "results")
    for name in ("orders", "customer", "part"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"{name}_of_sample")
    options = BatchOptions(result_format="parquet")
    report = run_script_folder(spark, f"{folder}/*.txt", out, options)
    totals = {
        1: "CAST(sum(largest) AS BIGINT)",
        2: "sum(in_debt)",
        3: "sum(p_partkey)",
        4: "sum(o_orderkey)",
    }
    written = None
    for number, total in totals.items():
        back = spark.read.parquet(f"{out}/{number}").selectExpr(
            f"{number} AS statement_no", "count(*) AS rows_written", f"{total} AS total"
        )
        written = back if written is None else written.union(back)
    return report.select("statement_no", "has_results", "row_count").join(written, "statement_no")


INSERT_FORMS = (
    "INSERT INTO {t} SELECT s_suppkey, 'select' FROM supplier_in_forms",
    "INSERT INTO {t} (form, id) (SELECT 'brackets', s_suppkey FROM supplier_in_forms)",
    "INSERT INTO {t} WITH q AS (SELECT s_suppkey AS k FROM supplier_in_forms) SELECT k, 'with' FROM q",
    "WITH q AS (SELECT s_suppkey AS k FROM supplier_in_forms) INSERT INTO {t} SELECT k, 'before' FROM q",
    "INSERT INTO {t} TABLE two_in_forms",
    "INSERT INTO {t} FROM supplier_in_forms SELECT s_suppkey, 'from'",
    "INSERT INTO {t} BY NAME SELECT 'by name' AS form, s_suppkey AS id FROM supplier_in_forms",
    "  -- indented; it stays\n/* and this */ INSERT INTO {t} VALUES (1, 'values'), (2, 'values')",
)


def insert_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each way of writing an INSERT, with the rows it told and the rows that are there."""
    suppliers = table(spark, sf_dir, "supplier")
    suppliers.createOrReplaceTempView("supplier_in_forms")
    suppliers.selectExpr("s_suppkey", "'table' AS form").createOrReplaceTempView("two_in_forms")
    database = new_database(spark, "forms")
    create = f"CREATE TABLE {database}.t (id BIGINT, form STRING) USING parquet"
    report = run_batch(spark, [create, *(form.format(t=f"{database}.t") for form in INSERT_FORMS)])
    forms = ("select", "brackets", "with", "before", "table", "from", "by name", "values")
    names = spark.createDataFrame(list(enumerate(forms, start=2)), "statement_no int, form string")
    stored = spark.table(f"{database}.t").groupBy("form").agg(F.count(F.lit(1)).alias("stored"))
    told = report.join(names, "statement_no").join(stored, "form")
    return told.select("form", F.col("row_count").cast("string").alias("told"), "stored")


def insert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default values, several targets of one query, and partitions replaced: the writes count."""
    database = new_database(spark, "counts")
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_in_counts")
    few = "SELECT c_custkey, c_mktsegment FROM customer_in_counts WHERE c_acctbal < 0"
    report = run_batch(
        spark,
        [
            "CREATE TABLE all_of (id BIGINT, segment STRING DEFAULT 'none') USING parquet",
            "CREATE TABLE by_segment (id BIGINT, segment STRING) USING parquet PARTITIONED BY (segment)",
            "INSERT INTO all_of VALUES (-1, DEFAULT), (-2, 'x')",
            "INSERT INTO all_of (id) SELECT c_custkey FROM customer_in_counts",
            "FROM customer_in_counts INSERT INTO all_of SELECT c_custkey, c_mktsegment "
            "INSERT INTO by_segment SELECT c_custkey, c_mktsegment WHERE c_acctbal < 0",
            f"INSERT OVERWRITE by_segment PARTITION (segment = 'few') SELECT c_custkey FROM ({few})",
            "SELECT segment FROM all_of WHERE segment = 'none'",
            "SELECT id FROM by_segment",
        ],
        options=BatchOptions(database=database),
    )
    return _printed(report.select("statement_no", "has_results", "row_count"))


def declare_between_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count with quoted names, declare a table over text, count that."""
    database, out = new_database(spark, "between"), new_folder(spark, "results")
    columns = column_list(raw_columns(TEXT_TABLES["orders"]))
    location = f"{staged_tables(spark, sf_dir, 'orders')}/orders"
    customers = f"{sf_dir}/customer.parquet"
    spark.catalog.createTable(f"{database}.customer", path=customers, source="parquet")
    run_batch(
        spark,
        [
            f'SELECT count(*) AS row_count FROM "{database}"."customer" LIMIT 10',
            f"CREATE TABLE IF NOT EXISTS {database}.orders ({columns.replace('`', '')}) USING csv "
            f"OPTIONS (sep '|', quote '') LOCATION '{location}' "
            "TBLPROPERTIES ('classification' = 'csv')",
            f'SELECT count(*) AS row_count FROM "{database}"."orders" LIMIT 10',
        ],
        out,
        BatchOptions(result_format="parquet", double_quoted_names=True),
    )
    first, second = (
        spark.read.parquet(f"{out}/{n}").select(F.lit(n).alias("statement_no"), "row_count")
        for n in (1, 3)
    )
    return first.unionByName(second)


BATCH_SCRIPT = """-- totals of the day
SELECT count(*) AS order_count FROM orders_in_batch;
/* by priority,
   largest first */
SELECT o_orderpriority, count(*) AS order_count, round(avg(o_totalprice), 2) AS avg_price FROM orders_in_batch
GROUP BY o_orderpriority ORDER BY order_count DESC;
;
CREATE TABLE big_orders (o_orderkey BIGINT, o_totalprice DOUBLE) USING parquet;
INSERT INTO big_orders
SELECT o_orderkey, o_totalprice FROM orders_in_batch
WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders_in_batch);
SELECT * FROM big_orders
"""


def _run_batch_script(spark: SparkSession, sf_dir: str, **kwargs) -> tuple[DataFrame, str]:
    """Run the script from its file; returns the report and the result location."""

    def write(folder: str) -> None:
        spark.createDataFrame([(BATCH_SCRIPT,)], "value string").coalesce(1).write.text(folder)

    folder, out = staged(spark, sf_dir, "batch", write), new_folder(spark, "results")
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_in_batch")
    options = BatchOptions(database=new_database(spark, "batch"), **kwargs)
    return run_script_folder(spark, f"{folder}/*.txt", out, options), out


def _printed(report: DataFrame) -> DataFrame:
    """The report with its counts as text; a statement without rows has none."""
    return report.withColumn("row_count", F.col("row_count").cast("string"))


def sql_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed(_run_batch_script(spark, sf_dir)[0])


def sql_batch_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the second statement left in the output location, as text with a header."""
    _, out = _run_batch_script(spark, sf_dir)
    return spark.read.csv(f"{out}/2", header=True)


def sql_batch_result_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, out = _run_batch_script(spark, sf_dir, result_format="parquet")
    return spark.read.parquet(f"{out}/5")


def sql_batch_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of a corpus run in order: each sees what the one before it did."""
    database = new_database(spark, "ordered")
    table(spark, sf_dir, "part").createOrReplaceTempView("part_in_batch")
    report = run_batch(
        spark,
        [
            "CREATE TABLE sizes USING parquet AS SELECT p_size FROM part_in_batch",
            "SELECT DISTINCT p_size FROM sizes",
            "INSERT INTO sizes SELECT p_size + 1000 FROM part_in_batch WHERE p_brand = 'Brand#2'",
            "SELECT p_size FROM sizes",
            "INSERT OVERWRITE TABLE sizes SELECT max(p_size) FROM part_in_batch",
            "SELECT p_size FROM sizes",
            "DROP TABLE sizes",
        ],
        options=BatchOptions(database=database),
    )
    return _printed(report)


QUERIES = {
    "script_statements": script_statements,
    "script_comments": script_comments,
    "script_files": script_files,
    "script_previews": script_previews,
    "script_quotes": script_quotes,
    "sample_script": sample_script,
    "insert_forms": insert_forms,
    "insert_counts": insert_counts,
    "declare_between_counts": declare_between_counts,
    "sql_batch_report": sql_batch_report,
    "sql_batch_result": sql_batch_result,
    "sql_batch_result_typed": sql_batch_result_typed,
    "sql_batch_in_order": sql_batch_in_order,
}


def _statements_oracle(source: str, id_column: str, id_name: str, script: str) -> str:
    return rf"""
        WITH cleaned AS (
            SELECT {id_column} AS id,
                   regexp_replace(regexp_replace(regexp_replace(
                       {script}, '\r\n?', chr(10), 'g'),
                       '(?m)^--.*$', '', 'g'), '(?s)/\*.*?\*/', '', 'g') AS script
            FROM {source}
        ), split AS (
            SELECT id, list_filter(
                list_transform(string_split(script, ';'),
                    lambda s: regexp_replace(s, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')),
                lambda s: s <> '') AS found
            FROM cleaned
        )
        SELECT id AS {id_name}, CAST(generate_subscripts(found, 1) AS INTEGER) AS statement_no,
               unnest(found) AS statement
        FROM split
    """


def _preview(text: str) -> str:
    cut = text if len(text) <= 100 else text[:100] + "..."
    return "'" + cut.replace("'", "''") + "'"


def _batch_rows(rows: list[tuple[str, bool, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({number} AS INTEGER) AS statement_no, {_preview(text)} AS preview, "
        f"{str(has_results).lower()} AS has_results, CAST(({count}) AS VARCHAR) AS row_count"
        for number, (text, has_results, count) in enumerate(rows, start=1)
    )


BIG_ORDERS = "FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)"

ORACLES = {
    "script_statements": _statements_oracle("documents", "doc_id", "script_id", DOCUMENT_SCRIPT),
    "script_comments": rf"""
        SELECT doc_id, regexp_replace(script, '(?m)^--.*$', '', 'g') AS no_line_comments,
               regexp_replace(script, '(?s)/\*.*?\*/', '', 'g') AS no_block_comments
        FROM (SELECT doc_id, replace({DOCUMENT_SCRIPT}, chr(13), '') AS script FROM documents)
    """,
    "script_files": _statements_oracle("pages", "page_id", "page_id", PAGE_SCRIPT),
    "script_previews": f"""
        SELECT script_id, statement_no,
               CASE WHEN length(statement) > 100 THEN substr(statement, 1, 100) || '...'
                    ELSE statement END AS preview,
               CAST(length(statement) AS INTEGER) AS statement_length
        FROM ({_statements_oracle("pages", "page_id", "script_id", PAGE_SCRIPT)})
    """,
    "script_quotes": f"""
        WITH texts AS (SELECT doc_id, replace(coalesce(text, ''), chr(13), '') AS text FROM documents)
        {" UNION ALL ".join(
            f"SELECT doc_id AS script_id, CAST({number} AS INTEGER) AS statement_no, {part} AS statement FROM texts"
            for number, part in enumerate(QUOTED_PARTS.values(), start=1)
        )}
    """,
    "sample_script": """
        SELECT CAST(statement_no AS INTEGER) AS statement_no, true AS has_results,
               CAST(rows AS BIGINT) AS row_count, CAST(rows AS BIGINT) AS rows_written,
               CAST(total AS BIGINT) AS total
        FROM (SELECT 1 AS statement_no, 1 AS rows, max(p_size) AS total FROM part
              UNION ALL SELECT 2, count(DISTINCT c_mktsegment), count(*) FILTER (c_acctbal < 0)
                        FROM customer WHERE c_mktsegment IS NOT NULL
              UNION ALL SELECT 3, count(*), sum(p_partkey) FROM part
                        WHERE p_size = (SELECT min(p_size) FROM part)
              UNION ALL SELECT 4, count(*), sum(o_orderkey) FROM customer, orders
                        WHERE c_custkey = o_custkey AND c_acctbal < 0
                          AND o_orderpriority <> '1-URGENT')
    """,
    "insert_forms": """
        SELECT form, CAST(count(*) AS VARCHAR) AS told, count(*) AS stored
        FROM (SELECT unnest(['select', 'brackets', 'with', 'before', 'table', 'from', 'by name'])
                     AS form FROM supplier
              UNION ALL SELECT unnest(['values', 'values']))
        GROUP BY form
    """,
    "insert_counts": """
        WITH n AS (SELECT count(*) AS everyone, count(*) FILTER (c_acctbal < 0) AS few FROM customer)
        SELECT CAST(k AS INTEGER) AS statement_no, k > 6 AS has_results,
               CAST(CASE k WHEN 3 THEN 2 WHEN 4 THEN everyone WHEN 5 THEN everyone + few WHEN 6 THEN few
                    WHEN 7 THEN everyone + 1 WHEN 8 THEN 2 * few END AS VARCHAR) AS row_count
        FROM n, range(1, 9) AS r(k)
    """,
    "declare_between_counts": """
        SELECT CAST(1 AS INTEGER) AS statement_no, count(*) AS row_count FROM customer
        UNION ALL SELECT CAST(3 AS INTEGER), count(*) FROM orders
    """,
    "sql_batch_report": _batch_rows(
        [
            ("SELECT count(*) AS order_count FROM orders_in_batch", True, "1"),
            (
                "SELECT o_orderpriority, count(*) AS order_count, round(avg(o_totalprice), 2) "
                "AS avg_price FROM orders_in_batch\n",
                True,
                "SELECT count(DISTINCT o_orderpriority) FROM orders",
            ),
            (
                "CREATE TABLE big_orders (o_orderkey BIGINT, o_totalprice DOUBLE) USING parquet",
                False,
                "NULL",
            ),
            (
                "INSERT INTO big_orders\nSELECT o_orderkey, o_totalprice FROM orders_in_batch\n"
                "WHERE o_totalprice > (SELECT",
                False,
                f"SELECT count(*) {BIG_ORDERS}",
            ),
            ("SELECT * FROM big_orders", True, f"SELECT count(*) {BIG_ORDERS}"),
        ]
    ),
    "sql_batch_result": """
        SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS order_count,
               CAST(round(avg(o_totalprice), 2) AS VARCHAR) AS avg_price
        FROM orders GROUP BY o_orderpriority
    """,
    "sql_batch_result_typed": f"SELECT o_orderkey, o_totalprice {BIG_ORDERS}",
    "sql_batch_in_order": _batch_rows(
        [
            (
                "CREATE TABLE sizes USING parquet AS SELECT p_size FROM part_in_batch",
                False,
                "NULL",
            ),
            (
                "SELECT DISTINCT p_size FROM sizes",
                True,
                "SELECT count(DISTINCT p_size) FROM part",
            ),
            (
                "INSERT INTO sizes SELECT p_size + 1000 FROM part_in_batch "
                "WHERE p_brand = 'Brand#2'",
                False,
                "SELECT count(*) FROM part WHERE p_brand = 'Brand#2'",
            ),
            (
                "SELECT p_size FROM sizes",
                True,
                "SELECT count(*) + count(*) FILTER (p_brand = 'Brand#2') FROM part",
            ),
            (
                "INSERT OVERWRITE TABLE sizes SELECT max(p_size) FROM part_in_batch",
                False,
                "1",
            ),
            ("SELECT p_size FROM sizes", True, "1"),
            ("DROP TABLE sizes", False, "NULL"),
        ]
    ),
}
