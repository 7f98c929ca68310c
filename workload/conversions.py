"""Conversions of text derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge import (
    ConversionOptions,
    TextFormat,
    convert_database,
    convert_dataset,
    declare_database,
    declare_text_table,
)
from tableforge.names import columns_of
from tableforge.plans.reports import totals_by
from tableforge.sources.catalog import raw_columns
from tableforge.sources.text import RAW_TABLE_FORMAT
from tableforge.workspace import new_folder
from workload.staging import (
    COMPRESSED,
    TEXT_TABLES,
    as_text,
    comparable,
    file_names,
    new_database,
    staged,
    staged_table,
    staged_tables,
    table,
    write_text,
)

PLAIN = RAW_TABLE_FORMAT
WITH_HEADER = TextFormat(header=True)
QUOTED = TextFormat(sep="|", multi_line=True)
#: Texts with quotes, escapes and separators before, between and after lines.
SPLIT_TEXT = (
    "concat(chr(34), '|', text, chr(10), chr(10), source, chr(92), chr(34), chr(10), '|', text, chr(34), 'end')"
)


def converted(
    spark: SparkSession, in_path: str, dataset: str, target: str | list | None, **kwargs
) -> DataFrame:
    """Rows of ``dataset`` after conversion of its plain ``|``-delimited text."""
    kwargs.setdefault("options", ConversionOptions(text_format=PLAIN))
    columns = columns_of(target) if target is not None else None
    out = new_folder(spark, "parquet")
    return convert_dataset(spark, dataset, in_path, out, target=columns, **kwargs).frame


def convert_declared(
    spark: SparkSession,
    in_path: str,
    dataset: str,
    text_format: TextFormat = RAW_TABLE_FORMAT,
    **kwargs,
) -> DataFrame:
    """Rows of ``dataset`` after conversion through a declared raw table."""
    database = new_database(spark, "raw")
    typed = columns_of(TEXT_TABLES[dataset])
    location = f"{in_path}/{dataset}"
    declare_text_table(
        spark, f"{database}.{dataset}", raw_columns(typed), location, text_format
    )
    return converted(spark, in_path, dataset, typed, source_db=database, **kwargs)


def derived_text(spark: SparkSession, sf_dir: str, label: str, source: str, columns: dict) -> str:
    """Text dataset ``label`` with one column per SQL expression over a supplied table."""
    rows = table(spark, sf_dir, source).selectExpr(
        *(f"CAST({sql} AS STRING) AS {name}" for name, sql in columns.items())
    )
    return staged_table(spark, sf_dir, label, rows, PLAIN, **COMPRESSED)


def convert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(convert_declared(spark, staged_tables(spark, sf_dir, "orders"), "orders"))


def convert_orders_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = convert_declared(spark, staged_tables(spark, sf_dir, "orders"), "orders")
    totals = totals_by(orders, "o_orderpriority", "o_totalprice")
    return totals.select(
        "o_orderpriority",
        F.col("row_count").alias("order_count"),
        F.round(F.col("avg_amount").cast("double"), 2).alias("avg_price"),
    )


def convert_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(convert_declared(spark, staged_tables(spark, sf_dir, "lineitem"), "lineitem"))


#: Text that does not fit its type in known rows: name and SQL over orders.
LOSSY_TEXTS = {
    "o_orderkey": "o_orderkey",
    "number": "CASE WHEN o_orderkey % 7 = 0 THEN 'seven' WHEN o_orderkey % 5 = 0 THEN NULL "
    "ELSE concat(CAST(o_custkey AS STRING), '.5') END",
    "day": "CASE WHEN o_orderkey % 3 = 0 THEN '2024-1-5' ELSE '2024-01-05' END",
    "price": "CASE WHEN o_orderpriority = '1-URGENT' THEN '12 EUR' ELSE '12' END",
    "status": "o_orderstatus",
}
LOSSY_TYPES = "o_orderkey bigint, number int, day date, price decimal(15,2), status string"


def convert_lost_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values lost in casts, by column: a declared partitioned database, and plain text."""
    base = derived_text(spark, sf_dir, "lossy", "orders", LOSSY_TEXTS)
    raw, typed, out = new_database(spark, "raw"), new_database(spark, "typed"), new_folder(spark, "lossy")
    declare_database(spark, "raw", raw, {"lossy": LOSSY_TYPES}, base)
    declare_database(spark, "typed", typed, {"lossy": LOSSY_TYPES}, out, partition_by={"lossy": ["status"]})
    options = ConversionOptions(text_format=PLAIN, count_losses=True)
    report = convert_database(spark, raw, typed, base, out, options=options)
    told = report.select(F.lit("declared").alias("way"), "rows_read", F.explode("lost").alias("name", "lost"))
    plain = convert_dataset(
        spark, "lossy", base, new_folder(spark, "plain"), target=columns_of(LOSSY_TYPES), options=options
    )
    rows = [("plain", plain.rows_read, name, lost) for name, lost in plain.lost.items()]
    return told.union(spark.createDataFrame(rows, told.schema))


# Texts around the borders of the number rule: name and SQL over lineitem.
NUMBER_TEXTS = {
    "plain": "CAST(l_orderkey AS STRING)",
    "padded": "concat(' ', CAST(l_partkey AS STRING), ' ')",
    "signed": "concat('+', CAST(l_linenumber AS STRING))",
    "negative": "concat('-', CAST(l_suppkey AS STRING))",
    "cut": "concat(CAST(l_partkey AS STRING), '.', CAST(l_suppkey AS STRING))",
    "negative_cut": "concat('-', CAST(l_partkey AS STRING), '.9')",
    "point_last": "concat(CAST(l_suppkey AS STRING), '.')",
    "point_first": "concat('.', CAST(l_suppkey AS STRING))",
    "negative_point_first": "concat('-.', CAST(l_suppkey AS STRING))",
    "exponent": "concat(CAST(l_linenumber AS STRING), 'e2')",
    "big": "concat(CAST(l_orderkey + 1 AS STRING), '0000000')",
    "huge": "concat(CAST(l_partkey + 1 AS STRING), '00000000000000000000')",
    "word": "l_returnflag",
    "grouped": "concat(CAST(l_linenumber AS STRING), ',', CAST(l_suppkey AS STRING))",
    "two_points": "concat(CAST(l_linenumber AS STRING), '.', CAST(l_suppkey AS STRING), '.1')",
    "point_only": "concat('.', '')",
}
NUMBER_KEY = {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}


def _number_casts(spark: SparkSession, sf_dir: str, type_name: str) -> DataFrame:
    base = derived_text(spark, sf_dir, "numbers", "lineitem", {**NUMBER_KEY, **NUMBER_TEXTS})
    target = [("l_orderkey", "bigint"), ("l_linenumber", "int")]
    target += [(name, type_name) for name in NUMBER_TEXTS]
    return converted(spark, base, "numbers", target)


def _printed_numbers(rows: DataFrame) -> DataFrame:
    """The numbers as text, with their type: columns of whole numbers have NULLs here."""
    return rows.select(
        *NUMBER_KEY,
        *(F.col(name).cast("string").alias(name) for name in NUMBER_TEXTS),
        F.typeof("plain").alias("number_type"),
    )


def convert_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed_numbers(_number_casts(spark, sf_dir, "INT"))


def convert_cast_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed_numbers(_number_casts(spark, sf_dir, "long"))


def convert_cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _number_casts(spark, sf_dir, "float")


def _whole_number_oracle(type_name: str, number_type: str) -> str:
    """The number rule, in SQL: cut off a fraction, everything else NULL."""
    casts = ",\n".join(
        rf"""CAST(CASE WHEN regexp_matches({name}, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$')
             THEN TRY_CAST(CASE WHEN regexp_extract({name}, '^\s*([+-]?[0-9]*)(\.[0-9]*)?\s*$', 1)
                                     IN ('', '+', '-') THEN '0'
                           ELSE regexp_extract({name}, '^\s*([+-]?[0-9]*)(\.[0-9]*)?\s*$', 1) END
                  AS {type_name}) END AS VARCHAR) AS {name}"""
        for name in NUMBER_TEXTS
    )
    return f"""
        SELECT l_orderkey, l_linenumber, {casts}, '{number_type}' AS number_type
        FROM ({_number_texts()})
    """


def _number_texts() -> str:
    texts = ", ".join(f"{sql} AS {name}" for name, sql in NUMBER_TEXTS.items())
    return f"SELECT l_orderkey, l_linenumber, {texts} FROM lineitem"


def _double_oracle() -> str:
    casts = ", ".join(f"TRY_CAST({name} AS DOUBLE) AS {name}" for name in NUMBER_TEXTS)
    return f"SELECT l_orderkey, l_linenumber, {casts} FROM ({_number_texts()})"


DECIMAL_TEXTS = {
    "price": "CAST(l_extendedprice AS STRING)",
    "rounded": "concat(CAST(l_partkey AS STRING), '.', CAST(l_linenumber AS STRING), '49')",
    "too_big": "concat(CAST(l_orderkey + 1 AS STRING), '00000000000.5')",
    "word": "l_linestatus",
}


def convert_cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = derived_text(spark, sf_dir, "decimals", "lineitem", {**NUMBER_KEY, **DECIMAL_TEXTS})
    target = "l_orderkey bigint, l_linenumber int, " + ", ".join(
        f"{name} decimal(15,2)" for name in DECIMAL_TEXTS
    )
    return comparable(converted(spark, base, "decimals", target))


DATE_TEXTS = {
    "good": "strftime(o_orderdate, '%Y-%m-%d')",
    "short": "concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate))",
    "late_february": "concat(year(o_orderdate), '-02-', strftime(o_orderdate, '%d'))",
    "with_time": "strftime(o_orderdate, '%Y-%m-%d 00:00:00')",
    "word": "o_orderpriority",
}


def _spark_dates(sql: str) -> str:
    for duck, spark in (("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd")):
        sql = sql.replace(duck, spark)
    return sql.replace("strftime", "date_format")


def convert_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = {name: _spark_dates(sql) for name, sql in DATE_TEXTS.items()}
    base = derived_text(spark, sf_dir, "dates", "orders", {"o_orderkey": "o_orderkey", **texts})
    target = "o_orderkey bigint, " + ", ".join(f"{name} date" for name in DATE_TEXTS)
    return comparable(converted(spark, base, "dates", target))


def convert_cast_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = {
        "event_id": "event_id",
        "good": "date_format(ts, 'HH:mm:ss')",
        "short": "date_format(ts, 'H:m:s')",
        "shifted": "concat(lpad(CAST(hour(ts) + 9 AS STRING), 2, '0'), date_format(ts, ':mm:ss'))",
        "full": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    }
    base = derived_text(spark, sf_dir, "times", "events", texts)
    target = [("event_id", "bigint"), ("good", "timestamp"), ("short", "TIMESTAMP")]
    target += [("shifted", "timestamp with time zone"), ("full", "timestamp")]
    return comparable(converted(spark, base, "times", target))


def convert_missing_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target column the text lacks, and text columns the target lacks."""
    rows = as_text(table(spark, sf_dir, "customer"))
    base = staged_table(spark, sf_dir, "customer_header", rows, WITH_HEADER)
    return converted(
        spark,
        base,
        "customer_header",
        "c_custkey bigint, c_absent int, c_nationkey int",
        options=ConversionOptions(text_format=WITH_HEADER),
    )


def convert_no_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = as_text(table(spark, sf_dir, "orders"))
    base = staged_table(spark, sf_dir, "orders_header", rows, WITH_HEADER)
    return converted(
        spark,
        base,
        "orders_header",
        None,
        target_db=new_database(spark, "typed"),
        options=ConversionOptions(text_format=WITH_HEADER),
    )


def convert_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = as_text(table(spark, sf_dir, "customer"))
    base = staged_table(spark, sf_dir, "customer_header", rows, WITH_HEADER)
    options = ConversionOptions(text_format=WITH_HEADER)
    return converted(spark, base, "customer_header", TEXT_TABLES["customer"], options=options)


def convert_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = staged_tables(spark, sf_dir, "customer")
    return converted(spark, base, "customer", TEXT_TABLES["customer"])


def convert_quote_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with delimiters, quotes, escapes and line breaks in them."""
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string"),
        F.concat(F.lit('|"'), F.col("text"), F.lit('" | '), F.col("source")).alias("text"),
    )
    base = staged_table(spark, sf_dir, "documents_quoted", rows, QUOTED)
    return converted(
        spark,
        base,
        "documents_quoted",
        "doc_id bigint, text string",
        options=ConversionOptions(text_format=QUOTED),
    )


def convert_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and escapes, from files that are read in splits."""
    texts = table(spark, sf_dir, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS doc_id", f"replace({SPLIT_TEXT}, chr(13), '') AS text", "source"
    )
    base = staged_table(spark, sf_dir, "documents_split", texts, QUOTED)
    split = TextFormat(sep="|", multi_line=True, split_records=True)
    target = "doc_id bigint, text string, source string"
    return converted(spark, base, "documents_split", target, options=ConversionOptions(text_format=split))


def convert_uneven_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three to seven values under two named columns; the others are kept as a list."""

    def write(folder: str) -> None:
        lines = as_text(table(spark, sf_dir, "lineitem"))
        more = [F.when(F.col("l_linenumber") > k, F.concat(F.col("l_partkey"), F.lit(f"-{k}"))) for k in range(1, 6)]
        values = [F.col(name) for name in ("l_orderkey", "l_linenumber", "l_returnflag")]
        lines.select(F.concat_ws("|", *values, *more).alias("value")).write.text(f"{folder}/uneven")

    base = staged(spark, sf_dir, "uneven", write)
    database = new_database(spark, "raw")
    columns = [("l_orderkey", "bigint"), ("l_linenumber", "int")]
    declare_text_table(spark, f"{database}.uneven", columns, f"{base}/uneven", PLAIN)
    options = ConversionOptions(text_format=PLAIN, extra_values="keep")
    rows = converted(spark, base, "uneven", columns_of("l_orderkey bigint, l_linenumber int"), source_db=database, options=options)
    return rows.select("l_orderkey", "l_linenumber", F.concat_ws(",", "extra_values").alias("further"))


def convert_declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table that declares its partitions, without naming them, read through the catalog."""
    base, out = staged_tables(spark, sf_dir, "lineitem"), new_folder(spark, "parquet")
    raw, typed = new_database(spark, "raw"), new_database(spark, "typed")
    schemas = {"lineitem": TEXT_TABLES["lineitem"]}
    declare_database(spark, "raw", raw, schemas, base)
    declare_database(spark, "typed", typed, schemas, out, partition_by={"lineitem": ["l_linestatus", "l_returnflag"]})
    convert_dataset(spark, "lineitem", base, out, raw, typed)
    return comparable(spark.table(f"{typed}.lineitem"))


# Types of a declared table, and texts of good and bad values for them: SQL over lineitem.
DECLARED_TEXTS = {
    "as_float": ("FLOAT", "CASE WHEN l_linenumber = 3 THEN 'x' ELSE CAST(l_quantity AS STRING) END"),
    "as_double": ("DOUBLE", "CASE WHEN l_linenumber = 3 THEN '1,5' ELSE CAST(l_tax AS STRING) END"),
    "as_decimal": ("DECIMAL(9,2)", "concat(CAST(l_orderkey AS STRING), repeat('0', CAST(l_linenumber AS INT)), '.25')"),
    "as_smallint": ("SMALLINT", "CAST(l_suppkey * 1000 AS STRING)"),
    "as_tinyint": ("TINYINT", "CAST(l_linenumber * 40 AS STRING)"),
    "as_boolean": ("BOOLEAN", "CASE WHEN l_linenumber = 1 THEN 'true' WHEN l_linenumber = 2 THEN 'FALSE' ELSE l_returnflag || '?' END"),
    "as_date": ("DATE", "CASE WHEN l_linenumber = 2 THEN '2024-02-30' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END"),
    "as_timestamp": ("TIMESTAMP", "concat(lpad(CAST(l_linenumber * 4 AS STRING), 2, '0'), ':00:59')"),
    "as_varchar": ("VARCHAR(3)", "l_returnflag"),
}


def convert_declared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text into a table with a column of each type, read through the catalog."""
    texts = {name: sql for name, (_, sql) in DECLARED_TEXTS.items()}
    base = derived_text(spark, sf_dir, "declared", "lineitem", {**NUMBER_KEY, **texts})
    typed, out = new_database(spark, "typed"), new_folder(spark, "parquet")
    schema = "l_orderkey BIGINT, l_linenumber INT, " + ", ".join(f"{name} {kind}" for name, (kind, _) in DECLARED_TEXTS.items())
    spark.sql(f"CREATE TABLE {typed}.declared ({schema}) USING parquet LOCATION '{out}/declared'")
    convert_dataset(spark, "declared", base, out, target_db=typed, options=ConversionOptions(text_format=PLAIN))
    rows = spark.table(f"{typed}.declared")
    types = F.concat_ws(", ", *(F.typeof(name) for name in DECLARED_TEXTS if name != "as_varchar"))
    # Numbers of one byte, two bytes and four bytes as text: DuckDB has them as other types.
    return rows.select(*NUMBER_KEY, *(F.col(name).cast("string").alias(name) if name not in ("as_float",) else F.col(name).cast("double").alias(name) for name in DECLARED_TEXTS), types.alias("types"))


def convert_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in folders of different depth below the dataset's folder."""

    def write(folder: str) -> None:
        orders = as_text(table(spark, sf_dir, "orders"))
        finished = F.col("o_orderstatus").eqNullSafe("F")
        write_text(orders.filter(finished), f"{folder}/orders/finished", PLAIN)
        write_text(orders.filter(~finished), f"{folder}/orders/other/open", PLAIN)

    base = staged(spark, sf_dir, "nested", write)
    return comparable(convert_declared(spark, base, "orders"))


def convert_trailing_delimiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that end with the delimiter, with ``NULL`` written as a marker."""

    def write(folder: str) -> None:
        orders = as_text(table(spark, sf_dir, "orders"))
        values = [F.col(name) for name in orders.columns if name != "o_orderpriority"]
        marked = F.when(F.col("o_orderpriority") == "1-URGENT", r"\N").otherwise(
            F.col("o_orderpriority")
        )
        lines = orders.select(F.concat_ws("|", *values, marked, F.lit("")).alias("value"))
        lines.write.text(f"{folder}/orders")

    base = staged(spark, sf_dir, "trailing", write)
    text_format = TextFormat(sep="|", quote="", null_value=r"\N")
    return comparable(convert_declared(spark, base, "orders", text_format=text_format))


def _with_codec(spark: SparkSession, sf_dir: str, codec: str) -> DataFrame:
    """Order count and value, with the codec that the file names show."""
    base, out = staged_tables(spark, sf_dir, "orders"), new_folder(spark, "parquet")
    done = convert_dataset(
        spark,
        "orders",
        base,
        out,
        target=columns_of(TEXT_TABLES["orders"]),
        options=ConversionOptions(text_format=PLAIN, compression=codec),
    )
    # One of three codecs per file name, so three rows at most.
    suffix = F.regexp_extract("file_name", r"\.(snappy|gz)\.parquet$", 1)
    codecs = file_names(spark, done.path).select(
        F.when(suffix == "", "none").otherwise(suffix).alias("codec")
    )
    total = done.frame.agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("o_totalprice").cast("string").alias("total_price"),
        F.sum("o_custkey").alias("custkey_sum"),
    )
    return total.select(
        "*",
        F.lit(done.rows_read).cast("bigint").alias("rows_read"),
        F.lit(",".join(sorted(r["codec"] for r in codecs.distinct().collect()))).alias("codec"),
    )


def convert_snappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_codec(spark, sf_dir, "Snappy")


def convert_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_codec(spark, sf_dir, "gzip")


def convert_uncompressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_codec(spark, sf_dir, "none")


def convert_bad_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_codec(spark, sf_dir, "brotli-9")


def convert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = staged_tables(spark, sf_dir, "lineitem")
    rows = convert_declared(
        spark, base, "lineitem", partition_keys=" l_returnflag , l_linestatus,"
    )
    return comparable(rows.filter(F.col("l_returnflag") == "R"))


def convert_partitioned_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = staged_tables(spark, sf_dir, "lineitem")
    return comparable(convert_declared(spark, base, "lineitem", partition_keys=["l_linenumber"]))


def convert_uneven_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, quoted, in rows of two columns: some have a value more, some one less."""
    one_line = F.translate(F.coalesce("text", F.lit("")), "\n\r\\", "  /")
    quoted = F.concat(F.lit(',"'), F.replace(one_line, F.lit('"'), F.lit('\\"')), F.lit('"'))
    more = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(',"more, of '), "doc_id", F.lit('"')))
    line = F.concat(
        F.col("doc_id").cast("string"),
        F.when(F.col("doc_id") % 5 == 1, "").otherwise(F.concat(quoted, F.coalesce(more, F.lit("")))),
    )

    def write(folder: str) -> None:
        table(spark, sf_dir, "documents").select(line.alias("value")).write.text(f"{folder}/notes")

    base = staged(spark, sf_dir, "uneven-texts", write)
    database, columns = new_database(spark, "raw"), "doc_id bigint, note string"
    declare_text_table(spark, f"{database}.notes", columns, f"{base}/notes", TextFormat())
    options = ConversionOptions(extra_values="keep")
    rows = converted(spark, base, "notes", columns, source_db=database, options=options)
    return rows.select(
        "doc_id",
        F.length(F.coalesce("note", F.lit(""))).cast("long").alias("n_chars"),
        F.md5(F.coalesce("note", F.lit("")).cast("binary")).alias("note_md5"),
        F.array_join("extra_values", "; ").alias("extra"),
    )


QUERIES = {
    "convert_split_records": convert_split_records,
    "convert_lost_values": convert_lost_values,
    "convert_uneven_texts": convert_uneven_texts,
    "convert_orders": convert_orders,
    "convert_orders_report": convert_orders_report,
    "convert_lineitem": convert_lineitem,
    "convert_cast_int": convert_cast_int,
    "convert_cast_bigint": convert_cast_bigint,
    "convert_cast_double": convert_cast_double,
    "convert_cast_decimal": convert_cast_decimal,
    "convert_cast_date": convert_cast_date,
    "convert_cast_time": convert_cast_time,
    "convert_missing_extra": convert_missing_extra,
    "convert_no_target": convert_no_target,
    "convert_header": convert_header,
    "convert_headerless": convert_headerless,
    "convert_quote_escape": convert_quote_escape,
    "convert_uneven_rows": convert_uneven_rows,
    "convert_declared_keys": convert_declared_keys,
    "convert_declared_types": convert_declared_types,
    "convert_recursive": convert_recursive,
    "convert_trailing_delimiter": convert_trailing_delimiter,
    "convert_snappy": convert_snappy,
    "convert_gzip": convert_gzip,
    "convert_uncompressed": convert_uncompressed,
    "convert_bad_codec": convert_bad_codec,
    "convert_partitioned": convert_partitioned,
    "convert_partitioned_all": convert_partitioned_all,
}

ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority,
           'o_orderdate date, o_totalprice decimal(15,2)' AS types
    FROM orders
"""
LINEITEM_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(CAST(l_quantity AS DECIMAL(15,2)) AS VARCHAR) AS l_quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS l_extendedprice,
           CAST(CAST(l_discount AS DECIMAL(5,2)) AS VARCHAR) AS l_discount,
           CAST(CAST(l_tax AS DECIMAL(5,2)) AS VARCHAR) AS l_tax,
           l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
           'l_discount decimal(5,2), l_extendedprice decimal(15,2), l_quantity decimal(15,2), '
           || 'l_shipdate date, l_tax decimal(5,2)' AS types
    FROM lineitem
"""


def _codec_oracle(codec: str) -> str:
    return f"""
        SELECT count(*) AS order_count,
               CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS VARCHAR) AS total_price,
               CAST(sum(o_custkey) AS BIGINT) AS custkey_sum,
               count(*) AS rows_read, '{codec}' AS codec
        FROM orders
    """


def _time_oracle() -> str:
    texts = {
        "good": "strftime(ts, '%H:%M:%S')",
        "short": "concat(hour(ts), ':', minute(ts), ':', second(ts))",
        "shifted": "concat(lpad(CAST(hour(ts) + 9 AS VARCHAR), 2, '0'), strftime(ts, ':%M:%S'))",
        "full": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    }
    selected = ", ".join(
        f"CASE WHEN regexp_full_match({sql}, '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') "
        f"THEN '1970-01-01 ' || {sql} END AS {name}"
        for name, sql in texts.items()
    )
    types = ", ".join(f"{name} timestamp" for name in sorted(texts))
    return f"SELECT event_id, {selected}, '{types}' AS types FROM events"


def _date_oracle() -> str:
    selected = ", ".join(
        f"CASE WHEN regexp_full_match({sql}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(TRY_CAST({sql} AS DATE) AS VARCHAR) END AS {name}"
        for name, sql in DATE_TEXTS.items()
    )
    types = ", ".join(f"{name} date" for name in sorted(DATE_TEXTS))
    return f"SELECT o_orderkey, {selected}, '{types}' AS types FROM orders"


def _decimal_oracle() -> str:
    selected = ", ".join(
        f"CAST(TRY_CAST({sql} AS DECIMAL(15,2)) AS VARCHAR) AS {name}"
        for name, sql in DECIMAL_TEXTS.items()
    )
    types = ", ".join(f"{name} decimal(15,2)" for name in sorted(DECIMAL_TEXTS))
    return f"SELECT l_orderkey, l_linenumber, {selected}, '{types}' AS types FROM lineitem"


def _declared_oracle() -> str:
    sql = {name: text.replace("AS STRING", "AS VARCHAR") for name, (_, text) in DECLARED_TEXTS.items()}
    printed = {
        "as_float": "CAST(TRY_CAST({} AS FLOAT) AS DOUBLE)",
        "as_timestamp": "CASE WHEN l_linenumber * 4 < 24 THEN '1970-01-01 ' || {} END",
        "as_varchar": "{}",
    }
    columns = ", ".join(
        printed.get(name, "CAST(TRY_CAST({} AS " + kind + ") AS VARCHAR)").format(sql[name]) + f" AS {name}"
        for name, (kind, _) in DECLARED_TEXTS.items()
    )
    types = ", ".join(kind.lower() for name, (kind, _) in DECLARED_TEXTS.items() if name != "as_varchar")
    return f"SELECT l_orderkey, l_linenumber, {columns}, '{types}' AS types FROM lineitem"


ORACLES = {
    "convert_split_records": f"""
        SELECT doc_id, replace({SPLIT_TEXT.replace("concat(", "", 1)[:-1].replace(", ", " || ")}, chr(13), '') AS text, source
        FROM documents
    """,
    "convert_lost_values": """
        WITH found AS (
            SELECT count(*) AS rows_read, count(*) FILTER (o_orderkey % 7 = 0) AS number,
                   count(*) FILTER (o_orderkey % 3 = 0) AS day,
                   count(*) FILTER (o_orderpriority = '1-URGENT') AS price FROM orders
        )
        SELECT way, rows_read, name, lost
        FROM (UNPIVOT found ON number, day, price INTO NAME name VALUE lost),
             (VALUES ('declared'), ('plain')) AS ways(way)
    """,
    "convert_uneven_texts": r"""
        SELECT doc_id, length(note) AS n_chars, md5(note) AS note_md5,
               CASE WHEN doc_id % 3 = 0 AND doc_id % 5 <> 1 THEN 'more, of ' || doc_id END AS extra
        FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN '' ELSE
                translate(coalesce(text, ''), chr(10) || chr(13) || '\', '  /') END AS note
              FROM documents)
    """,
    "convert_declared_keys": LINEITEM_SQL,
    "convert_declared_types": _declared_oracle(),
    "convert_uneven_rows": """
        SELECT l_orderkey, l_linenumber, concat_ws(',', l_returnflag,
            CASE WHEN l_linenumber > 1 THEN l_partkey || '-1' END,
            CASE WHEN l_linenumber > 2 THEN l_partkey || '-2' END,
            CASE WHEN l_linenumber > 3 THEN l_partkey || '-3' END,
            CASE WHEN l_linenumber > 4 THEN l_partkey || '-4' END,
            CASE WHEN l_linenumber > 5 THEN l_partkey || '-5' END) AS further
        FROM lineitem
    """,
    "convert_orders": ORDERS_SQL,
    "convert_orders_report": """
        SELECT o_orderpriority, count(*) AS order_count, round(avg(o_totalprice), 2) AS avg_price
        FROM orders GROUP BY o_orderpriority ORDER BY order_count DESC
    """,
    "convert_lineitem": LINEITEM_SQL,
    "convert_cast_int": _whole_number_oracle("INTEGER", "int"),
    "convert_cast_bigint": _whole_number_oracle("BIGINT", "bigint"),
    "convert_cast_double": _double_oracle(),
    "convert_cast_decimal": _decimal_oracle(),
    "convert_cast_date": _date_oracle(),
    "convert_cast_time": _time_oracle(),
    "convert_missing_extra": """
        SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
               c_mktsegment
        FROM customer
    """,
    "convert_no_target": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
        FROM orders
    """,
    "convert_header": "SELECT * FROM customer",
    "convert_headerless": "SELECT * FROM customer",
    "convert_quote_escape": r"""
        SELECT doc_id,
               '|"' || text || '" | ' || source AS text
        FROM documents
    """,
    "convert_recursive": ORDERS_SQL,
    "convert_trailing_delimiter": ORDERS_SQL.replace(
        "o_orderpriority", "nullif(o_orderpriority, '1-URGENT') AS o_orderpriority"
    ),
    "convert_snappy": _codec_oracle("snappy"),
    "convert_gzip": _codec_oracle("gz"),
    "convert_uncompressed": _codec_oracle("none"),
    "convert_bad_codec": _codec_oracle("snappy"),
    "convert_partitioned": LINEITEM_SQL + " WHERE l_returnflag = 'R'",
    "convert_partitioned_all": LINEITEM_SQL,
}
