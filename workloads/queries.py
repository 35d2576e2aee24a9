"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import scholarlake
from scholarlake.__main__ import main as command_line
from scholarlake.functions import strict_json as js
from scholarlake.operators import first_per_id, parse_records
from scholarlake.plans import job as plan
from scholarlake.sinks import scratch
from workloads import lines as L

# Spark names its own files part-00000-..., with a dash.
SPARK_FILES = "updated_date*/part*.gz"

# About what a file of a child table has in job_file_sizes.
FILE_BYTES = 256 << 10

# Lines that fail a run, with the order's key, and why.
MALFORMED = (
    ('{"id":"O%s"', "not one JSON value"),
    ("{'id':'O%s'}", "not one JSON value"),
    ('{"id":"O%s",}', "not one JSON value"),
    ('{"id":"O%s","works_count":NaN}', "not one JSON value"),
    ('{"id":"O%s","unread":01}', "not one JSON value"),
    ('{"id":"O%s"} x', "not one JSON value"),
    ('{"id":"O%s"},{"id":"b"}', "not one JSON value"),
    ('{"id":"O%s"}]} {', "not one JSON value"),
    ("[%s", "not one JSON value"),
    ("%s 2", "not one JSON value"),
    ('"%s" y', "not one JSON value"),
    ("null%s", "not one JSON value"),
    ('{"id":"O%s\\ud800"}', "half a surrogate pair"),
    ('{"id":"O%s","geo":{"latitude":1e999}}', "a number beyond double range"),
    ('{"id":"O%s","display_name_acronyms":[-1e999]}', "a number beyond double range"),
)

# Keys per file in the snapshot of file_scan_limit, and how many files it reads.
KEYS_PER_FILE = 5_000
FILES_READ = 2


def table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """One output table from the lines of its entity."""
    entity = next(e for e, tables in scholarlake.ENTITIES.items() if name in {t.name for t in tables})

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scholarlake.configure(spark)
        return scholarlake.entity_table(L.LINES[entity](spark, sf_dir), name)

    return query


def document_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through string fields and through JSON text."""
    scholarlake.configure(spark)
    works = scholarlake.entity_table(L.document_lines(spark, sf_dir), "works")
    return works.select("id", "title", "display_name", "language", "abstract_inverted_index")


def document_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every text as a reference."""
    scholarlake.configure(spark)
    return scholarlake.entity_table(L.document_lines(spark, sf_dir), "works_citations")


def dedup_first_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user, by day and event number; a user has many."""
    scholarlake.configure(spark)
    events = L.read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    events = L.dealt(events, "event_id")
    lines = events.select(
        F.unix_date(F.col("ts").cast("date")).cast("long").alias("file_key"),
        F.col("event_id").alias("line_no"),
        L.fill(
            '{"id":"U%s","works_count":%s,"updated_date":"%s"}', "user_id", "event_id", "event_type"
        ).alias("value"),
    )
    return scholarlake.entity_table(lines, "authors").select(
        "id", F.col("works_count").alias("event_id"), F.col("updated_date").alias("event_type")
    )


def blank_and_bad_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order gives lines of every kind; the two with a string id survive."""
    scholarlake.configure(spark)
    kinds = [
        L.fill('{"id":"O%s"}', "o_orderkey"),
        L.fill(' \t{"id":"R%s"}\r', "o_orderkey"),
        L.fill('{"id":%s}', "o_orderkey"),
        L.fill('{"id":null,"ids":"%s"}', "o_orderkey"),
        L.fill('{"id":{"id":"%s"}}', "o_orderkey"),
        L.fill('["%s"]', "o_orderkey"),
        L.fill(' "%s"', "o_orderkey"),
        L.fill("%s", "o_orderkey"),
        F.lit("null"),
        F.lit(""),
        F.lit(" \t\r"),
        F.lit(" \u0085　"),
    ]
    lines = L.dealt(L.read(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey").select(
        F.lit(0).cast("long").alias("file_key"),
        F.col("o_orderkey").alias("line_no"),
        F.explode(F.array(*kinds)).alias("value"),
    )
    return scholarlake.entity_table(lines, "publishers").select("id")


def malformed_line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order gives a line of every kind of MALFORMED and some that are fine."""
    scholarlake.configure(spark)
    fine = ['{"id":"O%s"}', "%s", "[%s]", ' "%s"', '{"id":"O%s","unread":1e999}']
    kinds = [*(template for template, _ in MALFORMED), *fine]
    texts = [L.fill(template, "o_orderkey") for template in kinds]
    bytes_of_none = F.concat(F.encode(texts[0], "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    lines = L.spread(L.read(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey").select(
        F.lit(0).cast("long").alias("file_key"),
        F.posexplode(F.array(*texts, F.lit(" \t"), bytes_of_none)).alias("kind", "value"),
        "o_orderkey",
    )
    numbered = lines.select(
        "file_key", (F.col("o_orderkey") * 100 + F.col("kind")).alias("line_no"), "value"
    )
    return scholarlake.malformed_lines(numbered, "institutions").select("line_no", "reason")


def strict_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An integer, a decimal, a string and an object, each read as every type."""
    scholarlake.configure(spark)
    events = L.read(spark, sf_dir, "events", "event_id", "value", "event_type", "props")
    events = L.dealt(events, "event_id")
    parsed = events.select(
        "event_id",
        F.parse_json(
            L.fill('{"s":"%s","d":%s,"p":%s}', "event_type", "value", "props")
        ).alias("v"),
    )
    integer, decimal = js.at(F.col("v"), "p.k"), js.at(F.col("v"), "d")
    string, thing = js.at(F.col("v"), "s"), js.at(F.col("v"), "p")
    return parsed.select(
        "event_id",
        js.text(integer).alias("integer_text"),
        js.whole(integer).alias("integer_whole"),
        js.wrapped(js.whole(integer)).alias("integer_whole32"),
        js.number(integer).alias("integer_number"),
        js.truth(integer).alias("integer_truth"),
        js.compact(integer).alias("integer_json"),
        js.whole(decimal).alias("decimal_whole"),
        js.number(decimal).alias("decimal_number"),
        js.text(string).alias("string_text"),
        js.whole(string).alias("string_whole"),
        js.number(string).alias("string_number"),
        js.compact(string).alias("string_json"),
        js.text(thing).alias("object_text"),
        js.compact(thing).alias("object_json"),
        js.present(js.at(thing, "absent")).alias("absent_present"),
    )


def json_text_sorted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested values as compact JSON text with sorted keys; numbers as they must look."""
    scholarlake.configure(spark)
    value = L.fill(
        '{"id":"C%s","display_name_alternatives": {"z": [1, {"y":"%s", "b":null}], "a": "%s",'
        ' "M": {"k":%s, "é":true, "k2":[]}, "a0":%s, "n": [5.0,1e2,0.1, %s.50, -0, 1E+30,'
        ' 1%s000000.0, 2e-7, 0.00010, 18446744073709551616, "7.0,1E9"]} }',
        "c_custkey", "c_name", "c_mktsegment", "c_custkey", "c_nationkey", "c_custkey",
        "c_nationkey",
    )
    customers = L.read(
        spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    )
    lines = L.spread(customers, "c_custkey").select(
        F.lit(0).cast("long").alias("file_key"),
        F.col("c_custkey").alias("line_no"),
        value.alias("value"),
    )
    return scholarlake.entity_table(lines, "authors").select("id", "display_name_alternatives")


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique records per entity, and citation edges; the works are read once."""
    scholarlake.configure(spark)
    counted = []
    for entity, lines in L.LINES.items():
        tables = [t for t in scholarlake.ENTITIES[entity] if t.name in (entity, "works_citations")]
        records = first_per_id(parse_records(lines(spark, sf_dir), tables))
        sums = {entity: F.count(F.lit(1))}
        if len(tables) > 1:
            edges = F.size(F.array_compact("referenced_works"))
            sums["works_citations"] = F.coalesce(F.sum(F.greatest(edges, F.lit(0))), F.lit(0))
        counted.append(
            records.agg(*(total.cast("long").alias(name) for name, total in sums.items())).select(
                F.inline(
                    F.array(
                        *(
                            F.struct(F.lit(name).alias("counted"), F.col(name).alias("n"))
                            for name in sums
                        )
                    )
                )
            )
        )
    return functools.reduce(DataFrame.unionAll, counted)


# ---- over files


def write_snapshot(lines: DataFrame, path: str) -> None:
    """Gzip files in one directory per month of file_key, here a number of days.

    The order of their paths is that of the lines.
    """
    month = L.month(F.date_from_unix_date(F.col("file_key").cast("int")))
    write_texts(
        lines.repartitionByRange("file_key", "line_no")
        .withColumn("month", month)
        .sortWithinPartitions("month", "file_key", "line_no"),
        path,
    )


def write_texts(texts: DataFrame, path: str) -> None:
    """The same from values that are in order already."""
    (
        texts.select(F.col("month").alias("updated_date"), "value")
        .write.partitionBy("updated_date")
        .option("compression", "gzip")
        .text(path)
    )


def job(
    spark: SparkSession, sf_dir: str, *entities: str, **options
) -> tuple[str, scholarlake.RunReport]:
    """Write a snapshot, convert it, and return where the tables are."""
    folder = scratch.new_folder(spark, "workload")
    scholarlake.configure(spark)
    for entity in entities:
        path = f"{folder}/in/{entity}"
        with plan.settings(spark, plan.FREED):
            if entity == "works":
                write_texts(L.work_texts(spark, sf_dir), path)
            else:
                write_snapshot(L.LINES[entity](spark, sf_dir), path)
    report = scholarlake.run(
        spark, f"{folder}/in", f"{folder}/out", entities, pattern=SPARK_FILES, **options
    )
    return f"{folder}/out", report


def job_table(name: str, entity: str, **options) -> Callable[[SparkSession, str], DataFrame]:
    """One table as the job wrote it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out, _ = job(spark, sf_dir, entity, **options)
        return spark.read.parquet(f"{out}/{name}.parquet")

    return query


def job_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities in one run: rows per table, counted and as read back."""
    out, report = job(spark, sf_dir, *L.LINES)
    counts = [
        spark.read.parquet(f"{out}/{name}.parquet").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.lit(report.rows[name]).cast("long").alias("reported"),
        )
        for name in scholarlake.TABLES
    ]
    return functools.reduce(DataFrame.unionAll, counts)


def job_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table of the works: its rows, files beyond three times the wanted size, and whether
    there are more than twice as many files as its bytes need, and one."""
    out, _ = job(spark, sf_dir, "works", file_bytes=FILE_BYTES)
    sized = [
        spark.read.parquet(f"{out}/{table.name}.parquet")
        .groupBy(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.lit(table.name).alias("table_name"),
            F.sum("rows").alias("n"),
            F.count_if(F.col("size") > 3 * FILE_BYTES).alias("oversized"),
            (F.count(F.lit(1)) > 1 + 2 * F.ceil(F.sum("size") / FILE_BYTES)).alias("too_many"),
        )
        for table in scholarlake.ENTITIES["works"][1:]
    ]
    return functools.reduce(DataFrame.unionAll, sized)


def file_scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first files of a snapshot that has KEYS_PER_FILE orders in each."""
    scholarlake.configure(spark)
    folder = scratch.new_folder(spark, "workload")
    (
        L.read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
        .select(
            F.format_string("%012d", F.expr(f"o_orderkey div {KEYS_PER_FILE}")).alias(
                "updated_date"
            ),
            L.fill('{"id":"O%s","type":"%s"}', "o_orderkey", "o_orderstatus").alias("value"),
        )
        .repartition("updated_date")
        .write.partitionBy("updated_date")
        .option("compression", "gzip")
        .text(f"{folder}/works")
    )
    lines = scholarlake.read_lines(spark, folder, "works", FILES_READ, SPARK_FILES)
    works = scholarlake.entity_table(lines, "works")
    return works.select("id", "type")


def job_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command line, twice into one folder: all files, then the first one only.

    The snapshot has a file per month of orders, a file of zero bytes, files
    outside the pattern, and no authors at all.  What was reported is compared
    with what is there.
    """
    folder = scratch.new_folder(spark, "workload")
    orders = L.read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("updated_date"),
        L.fill('{"id":"P%s"}', "o_orderkey").alias("value"),
    )
    gzip = orders.repartition("updated_date").write.option("compression", "gzip")
    gzip.partitionBy("updated_date").text(f"{folder}/in/publishers")
    orders.limit(9).select("value").write.text(f"{folder}/in/publishers/other=1")
    orders.where("false").select("value").coalesce(1).write.text(
        f"{folder}/in/publishers/updated_date=0000-00"
    )
    rows = []
    for number, limit in ((1, "0"), (2, "1")):
        report = command_line(
            ["-i", f"{folder}/in", "-o", f"{folder}/out", "-e", "publishers, authors,nothing",
             "-f", limit, "--pattern", "updated_date*/part*"]
        )
        rows.append((number, "files", report.files_processed, None))
        for name, reported in report.rows.items():
            there = spark.read.parquet(f"{folder}/out/{name}.parquet").count()
            rows.append((number, name, reported, there))
    scratch.remove(spark, folder)
    return spark.createDataFrame(rows, "run int, what string, reported long, found long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "works_citations": table("works_citations"),
    "works_topics": table("works_topics"),
    "works_authorships": table("works_authorships"),
    "works_parent": table("works"),
    "works_locations": table("works_locations"),
    "works_open_access": table("works_open_access"),
    "authors_parent": table("authors"),
    "authors_ids": table("authors_ids"),
    "authors_counts_by_year": table("authors_counts_by_year"),
    "institutions_parent": table("institutions"),
    "institutions_geo": table("institutions_geo"),
    "publishers_parent": table("publishers"),
    "topics_parent": table("topics"),
    "document_works": document_works,
    "document_references": document_references,
    "dedup_first_per_id": dedup_first_per_id,
    "blank_and_bad_id_filter": blank_and_bad_id_filter,
    "malformed_line_report": malformed_line_report,
    "strict_scalars": strict_scalars,
    "json_text_sorted_keys": json_text_sorted_keys,
    "entity_counts": entity_counts,
    "file_scan_limit": file_scan_limit,
    "job_table_counts": job_table_counts,
    "job_file_sizes": job_file_sizes,
    "job_works_citations": job_table("works_citations", "works"),
    # No broadcast: duplicates are dropped by the shuffle join on ranks.
    "job_works_authorships": job_table("works_authorships", "works", broadcast_bytes=0),
    "job_twice": job_twice,
    "job_authors_ids": job_table("authors_ids", "authors"),
}
