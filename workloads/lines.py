"""Snapshot lines built from the driver's tables.

One builder per entity.  Each returns (file_key, line_no, value): JSON lines as a
snapshot holds them, with the irregularities the reader must cope with spread
over the keys, so that plain SQL on the same tables can say what must come out.

Lines are built as text: a NULL piece is a missing key, which is not the same as
an explicit ``null``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_FILE = 0
LATER_FILE = 1

# Lines have many times the size of the rows of numbers they are made from.
ROWS_PER_TASK = 25_000


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by their key, at any size.

    The tables are files of one row group, which a single task reads, and each
    row becomes a line of many times its size.
    """
    return rows.repartition(*keys)


def tasks_for(rows: DataFrame) -> int:
    """Tasks for narrow rows that become lines: counted from the footers of their files.

    Sizes of narrow rows say little about that of the lines.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt out by their key, the more tasks the more rows."""
    return rows.repartition(tasks_for(rows), *keys)


def fill(template: str, *values: str) -> Column:
    """``template`` with each ``%s`` replaced by an expression (NULL if one is NULL)."""
    texts = template.split("%s")
    parts = [F.lit(texts[0])]
    for value, after in zip(values, texts[1:], strict=True):
        parts += [F.expr(value).cast("string"), F.lit(after)]
    return F.concat(*parts)


def quoted(value: str) -> str:
    """SQL for a string as JSON text, with escapes."""
    return f"to_json(cast({value} as variant))"


def pick(by: str, *choices: Column | None) -> Column:
    """The choice whose place equals ``by``; the last one also beyond; None is NULL."""
    column = F.lit(None).cast("string") if choices[-1] is None else choices[-1]
    for place in reversed(range(len(choices) - 1)):
        choice = F.lit(None) if choices[place] is None else choices[place]
        column = F.when(F.expr(by) == place, choice).otherwise(column)
    return column


def pair(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), value)


def record(id: Column, name: Column, *pairs: Column) -> Column:
    return F.concat(
        F.lit('{"id":"'), id, F.lit('"'), F.concat_ws("", F.concat(F.lit(","), name)),
        F.lit(","), F.concat_ws(",", *pairs), F.lit("}"),
    )


def name_pair(value: Column) -> Column:
    """display_name, missing for k % 7 = 1 and a number for k % 7 = 2."""
    return pair("display_name", pick("k % 7", value, None, F.lit("42"), value))


def count_pair(value: str) -> Column:
    """works_count, as 3.0 for k % 9 = 4 and as a string for k % 9 = 5."""
    n = F.expr(value).cast("string")
    return pair("works_count", pick("k % 9", n, n, n, n, F.lit("3.0"), F.lit('"7"'), n))


def snapshot(rows: DataFrame, id: Column, name: Column, *pairs: Column) -> DataFrame:
    """Lines of rows that have a unique key ``k``.

    For k % 10 = 0 a second record of the same id lies in a later file; lines
    without a usable id, blank lines and lines that are no objects are mixed in.
    """
    def line(file_key: int, value: Column) -> Column:
        return F.struct(F.lit(file_key).cast("long").alias("file_key"), value.alias("value"))

    # The texts are made in a step of their own: inside the generator they would
    # not be compiled.
    texts = rows.select(
        "k",
        record(id, name, *pairs).alias("first"),
        F.when(
            F.expr("k % 10 = 0"), record(id, pair("display_name", F.lit('"DUP"')), *pairs)
        ).alias("later"),
    )
    lines = F.array(
        line(FIRST_FILE, F.col("first")),
        F.when(F.col("later").isNotNull(), line(LATER_FILE, F.col("later"))),
        F.when(F.expr("k % 13 = 5"), line(FIRST_FILE, fill('{"id":%s}', "k"))),
        F.when(F.expr("k % 11 = 3"), line(FIRST_FILE, F.lit("  \t"))),
        F.when(F.expr("k % 17 = 6"), line(FIRST_FILE, fill('[%s,"x"]', "k"))),
    )
    return texts.select(F.col("k").alias("line_no"), F.inline(F.array_compact(lines)))


def author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per customer and year first, so the list of a customer is as long
    # as the calendar, however many orders there are.
    yearly = (
        read(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
        .groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("k")
        .agg(
            F.sum("n").alias("orders"),
            F.concat_ws(
                ",",
                F.collect_list(
                    fill('{"year":%s,"works_count":%s,"cited_by_count":"x"}', "y", "n")
                ),
            ).alias("years"),
        )
    )
    customers = read(
        spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    ).withColumnRenamed("c_custkey", "k")
    ids = fill('{"openalex":"A%s","mag":%s,"orcid":"0-%s","scopus":null}', "k", "k", "c_nationkey")
    return snapshot(
        customers.join(yearly, "k", "left"),
        fill("A%s", "k"),
        name_pair(fill('"%s"', "c_name")),
        count_pair("coalesce(orders, 0)"),
        pair("orcid", pick("k % 3", fill('"https://o/%s"', "k"), fill("%s", "k"), None)),
        pair("cited_by_count", pick("k % 4", fill("-%s", "k"), F.lit("null"), fill("%s", "k"))),
        pair(
            "display_name_alternatives",
            pick("k % 4", None, F.lit("null"), fill('[ "%s", "x" ]', "c_mktsegment")),
        ),
        pair(
            "last_known_institution",
            pick("k % 6", F.lit("null"), F.lit('{"id":9}'), fill('{"id":"I%s"}', "c_nationkey")),
        ),
        pair("works_api_url", fill('"https://api/A%s"', "k")),
        pair("updated_date", pick("k % 8", None, fill('"d%s"', "k"))),
        pair("ids", pick("k % 5", None, F.lit("null"), ids)),
        pair(
            "counts_by_year",
            fill('[{"year":"2000"},{"works_count":1},5%s]', "coalesce(',' || nullif(years, ''), '')"),
        ),
    )


def institution_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        .join(read(spark, sf_dir, "nation", "*"), F.expr("s_nationkey = n_nationkey"))
        .join(read(spark, sf_dir, "region", "*"), F.expr("n_regionkey = r_regionkey"))
        .withColumnRenamed("s_suppkey", "k")
    )
    rows = spread(rows, "k")
    latitude = pick(
        "k % 4",
        fill('"%s"', "s_acctbal"),
        fill("%s", "cast(s_acctbal as bigint)"),
        fill("%s", "s_acctbal"),
    )
    geo = F.concat(
        fill('{"city":"%s","country":%s,"region":"%s",', "n_name", "k", "r_name"),
        F.lit('"latitude":'), latitude, fill(',"longitude":-%s}', "k"),
    )
    return snapshot(
        rows,
        fill("I%s", "k"),
        name_pair(fill('"%s"', "s_name")),
        count_pair("k"),
        pair("ror", pick("k % 3", None, fill('"ror/%s"', "k"))),
        pair("country_code", pick("k % 2", fill('"N%s"', "s_nationkey"), F.lit("[]"))),
        pair("type", fill('"%s"', "r_name")),
        pair("homepage_url", fill('"http://h/%s"', "k")),
        pair("image_url", pick("k % 4", None, F.lit("null"), fill('"http://i/%s"', "k"))),
        pair("display_name_acronyms", pick("k % 3", None, F.lit("[]"), fill('["S%s", 1]', "k"))),
        pair("display_name_alternatives", pick("k % 3", F.lit("true"), fill('[["%s"]]', "k"))),
        pair("cited_by_count", fill("%s", "k * 10")),
        pair("works_api_url", fill('"http://w/%s"', "k")),
        pair("updated_date", fill('"u%s"', "k")),
        pair("geo", pick("k % 5", None, F.lit("null"), geo)),
    )


def publisher_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "pages", "page_id", "url", "html").withColumnRenamed("page_id", "k")
    return snapshot(
        dealt(rows, "k"),
        fill("P%s", "k"),
        name_pair(fill("%s", quoted("url"))),
        count_pair("k"),
        pair("alternate_titles", fill("[ %s ]", quoted("html"))),
        pair("country_codes", pick("k % 3", None, F.lit("null"), fill('["C%s"]', "k % 25"))),
        pair(
            "hierarchy_level",
            pick("k % 4", None, F.lit("1.5"), fill("%s", "k % 3"), fill("%s", "k + 4294967296")),
        ),
        pair("parent_publisher", pick("k % 2", F.lit('{"id":"P0"}'), F.lit('"P0"'))),
        pair("cited_by_count", fill("%s", "length(html)")),
        pair("sources_api_url", fill('"http://s/%s"', "k")),
        pair("updated_date", pick("k % 6", F.lit("20240101"), fill('"u%s"', "k"))),
    )


def topic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(
        spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    ).withColumnRenamed("p_partkey", "k")
    return snapshot(
        spread(rows, "k"),
        fill("T%s", "k"),
        name_pair(fill('"%s"', "p_name")),
        count_pair("p_size"),
        pair("subfield", pick("k % 3", F.lit("null"), fill('{"id":"%s"}', "p_brand"))),
        pair("field", pick("k % 4", None, F.lit('"x"'), fill('{"display_name":"%s"}', "p_type"))),
        pair("domain", fill('{"id":%s,"display_name":"D%s"}', "k", "p_size")),
        pair("description", pick("k % 2", fill('"about %s"', "p_name"), F.lit("false"))),
        pair(
            "keywords",
            pick(
                "k % 5",
                None,
                F.lit("[]"),
                F.lit('"x"'),
                fill('["%s",7,null,"%s"]', "p_brand", "p_type"),
                fill('["%s","%s"]', "p_type", "p_name"),
            ),
        ),
        pair("works_api_url", fill('"http://t/%s"', "k")),
        pair("ids", pick("k % 2", fill('{"wikipedia":"wiki/%s"}', "k"), F.lit('{"openalex":"x"}'))),
        pair("cited_by_count", fill("%s", "p_size * 100")),
        pair("updated_date", F.lit('"decoy"')),
        pair("updated", fill('"u%s"', "k")),
        pair("siblings", pick("k % 4", None, F.lit("null"), fill('[{"id":"T%s","a":[1, 2]}]', "k + 1"))),
    )


# Works come from line items, one line each.  (l_orderkey, l_linenumber) repeats,
# so about a quarter of the lines are later copies with other content.
WORK_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_shipdate",
)


def work_rows(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """Line items with k, n, p, s, d and their place: ship date, then line_no.

    ``odd`` marks the records, one in eight, that have values of unexpected types.
    ``in_order``: dealt out by ranges of their place, not by their key.
    """
    items = read(spark, sf_dir, "lineitem", *WORK_COLUMNS)
    tasks = tasks_for(items)
    rows = items if in_order else items.repartition(tasks, "l_orderkey", "l_linenumber")
    placed = rows.selectExpr(
        "l_orderkey as k",
        "l_linenumber as n",
        "l_partkey as p",
        "l_suppkey as s",
        "l_discount as d",
        "cast(l_shipdate as date) as shipped",
        "(l_partkey * 10000000 + l_suppkey) * 100 + cast(round(l_discount * 100) as bigint)"
        " as line_no",
        "l_orderkey % 8 = 7 as odd",
    )
    return placed.repartitionByRange(tasks, "shipped", "line_no") if in_order else placed


def work_value() -> Column:
    """The JSON line of a row of ``work_rows``."""

    def odd(unexpected: Column, usual: Column) -> Column:
        return F.when(F.col("odd"), unexpected).otherwise(usual)

    location = F.concat(
        fill('{"source":{"id":"S%s"},"landing_page_url":"http://l/%s",', "s", "p"),
        pick("p % 3", F.lit(""), fill('"pdf_url":"http://f/%s",', "k")),
        F.lit('"is_oa":'), pick("p % 2", F.lit("true"), odd(F.lit("1"), F.lit("null"))),
        fill(',"version":"v%s","license":', "n"), pick("n % 2", F.lit("null"), F.lit('"by"')),
        F.lit("}"),
    )
    access = F.concat(
        F.lit('{"is_oa":'), pick("p % 2", F.lit("true"), F.lit("false")),
        F.lit(',"oa_status":"gold","oa_url":'), odd(F.lit("7"), fill('"http://o/%s"', "p")),
        F.lit(',"any_repository_has_fulltext":'),
        pick("s % 2", F.lit("true"), odd(F.lit('"yes"'), F.lit("null"))),
        F.lit("}"),
    )
    first_author = F.concat(
        fill('{"author":{"id":"A%s"}', "s"),
        pick("n", None, F.lit(""), fill(',"author_position":"p%s"', "n")),
        F.lit(',"institutions":'),
        pick(
            "n % 4",
            F.lit("[]"),
            F.lit("null"),
            odd(
                fill('[{"id":null},7,{"id":5},{"id":"I%s"},{"id":"I99"}]', "s % 25"),
                fill('[{"id":null},{},{"id":"I%s","ror":"x"},{"id":"I99"}]', "s % 25"),
            ),
        ),
        F.lit("}"),
    )
    second_author = fill(
        '{"author":{"id":"A%s"},"author_position":"last","raw_affiliation_string":"R%s"}', "p", "n"
    )
    year, p = fill("%s", "year(shipped)"), fill("%s", "p")
    pairs = (
        pair("doi", pick("n % 3", None, F.lit("null"), fill('"10.1/%s"', "k"))),
        pair("title", odd(p, fill('"Title %s"', "p"))),
        pair(
            "publication_year",
            pick(
                "k % 3",
                year,
                fill("%s", "year(shipped) + 4294967296"),
                odd(fill("%s.0", "year(shipped)"), year),
            ),
        ),
        pair("publication_date", fill('"%s"', "shipped")),
        pair("type", fill('"type%s"', "n")),
        pair(
            "cited_by_count",
            odd(
                pick(
                    "p % 4",
                    F.lit("3.0"), F.lit('"7"'), F.lit("9223372036854775808"), fill("-%s", "p"),
                ),
                p,
            ),
        ),
        pair("is_retracted", pick("k % 4", F.lit("true"), F.lit("null"), None, odd(F.lit('"true"'), None))),
        pair("is_paratext", pick("k % 4", F.lit("false"), F.lit("true"), None, odd(F.lit("1"), None))),
        pair("cited_by_api_url", pick("k % 5", None, fill('"http://c/%s"', "k"))),
        pair(
            "abstract_inverted_index",
            pick(
                "p % 4", None, F.lit("null"),
                fill('{"zeta":[0],"Alpha":[0, 2],"zeta":[ %s ]}', "p"),
            ),
        ),
        pair("language", odd(F.lit('["en"]'), F.lit('"en"'))),
        pair(
            "primary_location",
            pick(
                "k % 6", F.lit("null"), F.lit('{"source":null}'),
                odd(F.lit('{"source":{"id":5}}'), F.lit('{"source":{}}')),
                location,
            ),
        ),
        pair(
            "open_access",
            pick("k % 9", None, F.lit("null"), odd(F.lit("[1]"), F.lit("{}")), access),
        ),
        pair(
            "authorships",
            F.concat(
                F.lit("["), first_author,
                odd(F.lit(',{"author":{}},"x",{"author":{"id":7}},'), F.lit(',{"author":{}},null,')),
                second_author, F.lit("]"),
            ),
        ),
        pair(
            "topics",
            F.concat(
                odd(
                    fill('[{"id":1},"x",{"id":"T%s","score":"0.5"},', "s"),
                    fill('[{"score":1},{"id":"T%s"},', "s"),
                ),
                fill('{"id":"T%s","score":%s},{"id":"T%s","score":%s}]', "p", "d", "s", "n"),
            ),
        ),
        pair(
            "referenced_works",
            odd(
                fill('[7,null,"W%s","W%s",{"a":1},"W%s"]', "p", "p", "s"),
                fill('["W%s",null,"W%s","W%s"]', "p", "p", "s"),
            ),
        ),
    )
    name = pair(
        "display_name",
        pick("p % 7", fill('"Work %s"', "k"), None, odd(F.lit("42"), F.lit("null")), fill('"Work %s"', "k")),
    )
    return record(fill("W%s-%s", "k", "n"), name, *pairs)


# What is mixed in with the line of a row, by its key.
OTHER_LINES = (("k % 13 = 5", '{"id":%s}', "k"), ("k % 11 = 3", "  \t"), ("k % 17 = 6", '[%s,"x"]', "k"))


def other_lines() -> list[Column]:
    return [F.when(F.expr(where), fill(*line)) for where, *line in OTHER_LINES]


def work_lines(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """The ship date numbers the file."""
    texts = work_rows(spark, sf_dir, in_order).select(
        F.unix_date("shipped").cast("long").alias("file_key"),
        "line_no",
        "k",
        work_value().alias("work"),
    )
    lines = F.array(F.col("work"), *other_lines())
    return texts.select("file_key", "line_no", F.explode(F.array_compact(lines)).alias("value"))


def work_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of ``work_lines`` as text (month, value), all lines of a row in one value.

    Rows of numbers are put in order, before they become lines of many times their size; the
    tasks have ranges of them, and the rows of a task are sorted by month and place.
    """
    some = " or ".join(["n is not null", *(where for where, *_ in OTHER_LINES)])
    rows = (
        work_rows(spark, sf_dir, in_order=True)
        .where(f"k is not null and ({some})")  # others have no line
        .withColumn("month", month("shipped"))
        .sortWithinPartitions("month", "shipped", "line_no")
    )
    return rows.select("month", F.concat_ws("\n", work_value(), *other_lines()).alias("value"))


def month(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works with whole texts: as title, inside an abstract, and word by word as references."""
    words = quoted("split(text, ' ', -1)")
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    return dealt(docs, "doc_id").select(
        F.lit(FIRST_FILE).cast("long").alias("file_key"),
        F.col("doc_id").alias("line_no"),
        record(
            fill("W%s", "doc_id"),
            pair("display_name", F.lit("null")),
            pair("title", fill("%s", quoted("text"))),
            pair("language", fill('"%s"', "lang")),
            pair(
                "abstract_inverted_index",
                fill('{"text": %s, "chars": [%s]}', quoted("text"), "n_chars"),
            ),
            pair("referenced_works", fill("%s", words)),
        ).alias("value"),
    )


LINES = {
    "authors": author_lines,
    "institutions": institution_lines,
    "publishers": publisher_lines,
    "topics": topic_lines,
    "works": work_lines,
}
