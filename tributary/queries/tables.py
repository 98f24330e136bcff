"""Each operator applied to whole test tables: name -> function(spark, folder)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.fixed_values import COMPANY_A, COMPANY_B, ROSTER_A, ROSTER_B
from tributary.functions import dates, money, text
from tributary.operators import aggregates, clean, conform, dedup, linkage, quality, quantiles, reconcile
from tributary.plans import charts
from tributary.plans.deduplicate import deduplicate, fuzzy_step
from tributary.queries.workbook_files import workbook
from tributary.sinks import exports
from tributary.sources import readers
from tributary.sources.flatten import flatten
from tributary.staging import stage, staging_path

AS_OF = "2000-01-01"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# --- conforming, codes and cleaning -----------------------------------------


def parties(spark, folder):
    """Customers as roster A and suppliers as roster B in the canonical schema."""
    customers = _read(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    suppliers = _read(spark, folder, "supplier").select(
        F.concat(F.lit("ACQ_"), "s_suppkey").alias("s_id"), "s_name", "s_nationkey"
    )
    return conform.stack([
        conform.conform(customers, ROSTER_A, {
            "c_custkey": "employee_id", "c_name": "last_name",
            "c_mktsegment": "department", "c_nationkey": "manager_id"}),
        conform.conform(suppliers, ROSTER_B, {
            "s_id": "employee_id", "s_name": "last_name", "s_nationkey": "manager_id"}),
    ])


def source_counts(spark, folder):
    return aggregates.value_counts(parties(spark, folder), "source")


def format_ids(spark, folder):
    formatted = clean.namespace_ids(parties(spark, folder))
    return formatted.select("source", "last_name", "employee_id", "manager_id")


def other_origins(spark, folder):
    """Customers of three origins, one of them of neither company: its ids stay as they are."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    origin = F.when(segment == "BUILDING", COMPANY_A).when(segment == "MACHINERY", COMPANY_B)
    customers = _read(spark, folder, "customer").select(
        F.col("c_custkey"), F.when(segment == "FURNITURE", None).otherwise(F.coalesce(origin, F.lit("ThirdCo"))).alias("company_origin"),
        F.when(segment == "MACHINERY", F.concat(F.lit("ACQ_"), key)).otherwise(key).alias("employee_id"),
        F.col("c_nationkey").cast("string").alias("manager_id"))
    return clean.namespace_ids(customers)


def party_report(spark, folder):
    """Conform, stack, namespace, deduplicate and check: one small job end to end."""
    formatted = clean.namespace_ids(parties(spark, folder))
    distinct = dedup.exact_dedup(formatted, "employee_id", "last_name")
    checks = [
        quality.not_null("employee_id", "id"),
        quality.unique("employee_id", "id"),
        quality.matches("employee_id", r"^(GT|AC)-\d{6}$", "id"),
        quality.not_null("department", "segment"),
        quality.min_row_count(1000, "rows"),
    ]
    return quality.quality_report(distinct, checks)


def code_map(spark, folder):
    orders = _read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return conform.map_codes(orders, "o_orderstatus", {"F": "Finished", "O": "Open"})


def code_map_table(spark, folder):
    nations = _read(spark, folder, "nation").where("n_regionkey < 3").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("value")
    )
    customers = _read(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation")
    )
    return conform.map_codes_from(customers, "nation", nations)


def unmapped_values(spark, folder):
    orders = _read(spark, folder, "orders")
    return conform.unmapped_values(orders, "o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2})


def clean_names(spark, folder):
    """Names with hyphens, quotes, ordinals and a decomposed accent put in."""
    parts = _read(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit(" 3rd  "), F.replace("p_name", F.lit(" "), F.lit("-"))).alias("first_name"),
        F.concat(F.lit("o'"), "p_brand", F.lit(",élan "), "p_type", F.lit(" ")).alias("last_name"),
    )
    return clean.clean_names(parts)


def parse_dates(spark, folder):
    """Order dates as good, short and unreadable text."""
    day = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy-M-d"))
        .otherwise(F.date_format(day, "yyyy/MM/dd"))
    )
    orders = _read(spark, folder, "orders").select("o_orderkey", written.alias("hire_date"))
    return clean.standardize_dates(orders, as_of=AS_OF)


def _payroll(spark, folder):
    """Customer balances as pay: amounts as text, currency and frequency by codes."""
    symbol = F.when(F.col("c_mktsegment") == "MACHINERY", "£").otherwise("$")
    nation = F.col("c_nationkey")
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("employee_id"),
        F.lit(COMPANY_A).alias("company_origin"),
        F.concat(symbol, F.format_number("c_acctbal", 2)).alias("base_salary"),
        F.when(nation < 10, "Annual").when(nation < 15, "Monthly").when(nation < 20, "Bi-Weekly")
        .otherwise("Daily").alias("pay_frequency"),
        text.mapped(F.col("c_mktsegment"), {
            "MACHINERY": "GBP", "BUILDING": "EUR", "AUTOMOBILE": "USD", "FURNITURE": "JPY"}).alias("currency"),
    )


def annual_amount(spark, folder):
    return clean.clean_payroll(_payroll(spark, folder)).select("employee_id", "salary_usd_annual")


def payroll_counts(spark, folder):
    paid = clean.clean_payroll(_payroll(spark, folder))
    amount = money.parsed_amount(F.col("base_salary"))
    return aggregates.conditional_counts(paid, {
        "unparsed": amount.isNull(),
        "no_currency": F.col("currency").isNull(),
        "computed": F.col("salary_usd_annual").isNotNull(),
        "daily": F.col("pay_frequency") == "Daily",
    })


def benefit_ids(spark, folder):
    orders = _read(spark, folder, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey"), F.lit(7)).cast("string").alias("employee_id")
    )
    return clean.clean_benefits(orders)


def unknown_category(spark, folder):
    known = ["ECONOMY", "LARGE", "MEDIUM", "PROMO"]
    return clean.unknown_categories(_read(spark, folder, "part"), "p_type", "p_partkey", known)


def unknown_category_table(spark, folder):
    known = _read(spark, folder, "nation").where("n_regionkey < 3").select("n_nationkey")
    return clean.unknown_categories_from(
        _read(spark, folder, "customer"), "c_nationkey", "c_custkey", known
    ).select("c_custkey", "c_nationkey")


def flatten_json(spark, folder):
    events = _read(spark, folder, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"),
        F.struct(F.struct(F.col("event_type").alias("type")).alias("kind"), "value").alias("body"),
    )
    return flatten(events)


def page_stats(spark, folder):
    turns = _read(spark, folder, "conversations").select("conv_id", "turn")
    return readers.page_statistics(turns, ("conv_id",), "turn", page_size=3)


# --- duplicates and merges ---------------------------------------------------


def exact_dedup(spark, folder):
    documents = _read(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return dedup.exact_dedup(documents, "text", "doc_id").select("doc_id", "lang", "source", "n_chars")


def exact_dedup_null_key(spark, folder):
    events = _read(spark, folder, "events").select(
        "event_id", "event_type",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
    )
    return dedup.exact_dedup(events, "user_id", "event_id")


def _hosts(spark, folder):
    """Pages with their host as merge key, differently spelled for https, and their language."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    spelled = F.when(F.col("url").startswith("https"), F.concat(F.lit(" "), F.upper(host))).otherwise(host)
    language = F.regexp_extract("url", "^https?://[^/]+/([^/]+)", 1)
    return _read(spark, folder, "pages").select(
        "page_id", F.when(language != "es", spelled).alias("host"), language.alias("source")
    )


LANGUAGE_PRIORITY = {"en": 1, "fr": 2}


def priority_dedup(spark, folder):
    return dedup.priority_dedup(_hosts(spark, folder), "host", "page_id", priorities=LANGUAGE_PRIORITY)


def priority_edges(spark, folder):
    edges = dedup.priority_edges(
        _hosts(spark, folder), "host", "page_id", "page_id", priorities=LANGUAGE_PRIORITY
    )
    return edges.select(*dedup.EDGE_COLUMNS)


def shared_hosts(spark, folder):
    return dedup.shared_key_rows(_hosts(spark, folder), "host", "page_id")


def order_merge(spark, folder):
    """Best order of each customer by priority, the earliest key on a tie."""
    orders = _read(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"), "o_orderpriority"
    )
    return dedup.priority_dedup(
        orders, "customer", "o_orderkey", "o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    )


def drop_rows(spark, folder):
    toxic = _read(spark, folder, "labels").where("toxic = 1")
    documents = _read(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return dedup.drop_rows(documents, toxic, "doc_id")


# --- linkage -------------------------------------------------------------------


def part_roster(spark, folder):
    """Parts as records of three sources; type, size and maker number give ids and dates."""
    brand = F.col("p_brand")
    source = F.when(brand.startswith("Brand#1"), ROSTER_A).when(brand.startswith("Brand#2"), ROSTER_B).otherwise("other")
    contact = F.concat_ws("/", "p_name", "p_type", "p_size")
    return _read(spark, folder, "part").select(
        F.col("p_partkey").alias("_ord"),
        F.concat_ws("/", "p_brand", "p_type", "p_size").alias("employee_id"),
        F.when(brand.startswith("Brand#1"), F.upper(contact)).otherwise(contact).alias("email"),
        F.substring_index("p_name", " ", 1).alias("first_name"),
        F.substring_index("p_name", " ", -1).alias("last_name"),
        F.col("p_name").alias("employee_name"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size") * 3).alias("hire_date"),
        source.alias("source"),
    )


def _linked_parts(spark, folder):
    return fuzzy_step(part_roster(spark, folder))


def linkage_candidates(spark, folder):
    linked = fuzzy_step(part_roster(spark, folder), row_id="_ord")
    return linkage.candidate_list(linked)


def linkage_matches(spark, folder):
    linked = fuzzy_step(part_roster(spark, folder), row_id="_ord")
    return linkage.match_edges(linked).select(*dedup.EDGE_COLUMNS)


def linkage_review(spark, folder):
    return linkage.review_list(fuzzy_step(part_roster(spark, folder), row_id="_ord"))


def review_export(spark, folder):
    return exports.review_report(linkage.review_list(_linked_parts(spark, folder)))


def review_actions(spark, folder):
    return exports.action_counts(review_export(spark, folder))


def _url_roster(spark, folder):
    """Pages with https as roster A and http as roster B; the address is the name."""
    address = F.regexp_replace("url", "^https?://", "")
    return _read(spark, folder, "pages").select(
        F.col("page_id").alias("_ord"),
        F.col("page_id").alias("employee_id"),
        address.alias("employee_name"),
        address.alias("last_name"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("page_id").cast("int")).alias("hire_date"),
        F.when(F.col("url").startswith("https"), ROSTER_A).otherwise(ROSTER_B).alias("source"),
    )


def url_candidates(spark, folder):
    return linkage.candidate_list(fuzzy_step(_url_roster(spark, folder)))


def url_matches(spark, folder):
    return linkage.match_edges(fuzzy_step(_url_roster(spark, folder))).select(*dedup.EDGE_COLUMNS)


def url_review(spark, folder):
    return linkage.review_list(fuzzy_step(_url_roster(spark, folder)))


def _three_passes(spark, folder):
    roster = stage(part_roster(spark, folder), "roster")
    payroll = _read(spark, folder, "part").select(
        F.concat_ws("/", "p_brand", "p_type", F.col("p_size") + 1).alias("employee_id"),
        F.col("p_retailprice").alias("salary_usd_annual"),
    )
    return roster, deduplicate(roster, payroll)


def golden_provenance(spark, folder):
    _, result = _three_passes(spark, folder)
    return result.golden.select("_ord", "employee_id", "source", "source_systems", "dedup_method")


def match_edges(spark, folder):
    _, result = _three_passes(spark, folder)
    return result.edges.select(*dedup.EDGE_COLUMNS)


def removed_by_step(spark, folder):
    roster, result = _three_passes(spark, folder)
    return aggregates.removed_by_step(result.edges, roster, result.distinct_ids)


def stage_summary(spark, folder):
    roster, result = _three_passes(spark, folder)
    return aggregates.stage_summary({
        "input_records": roster, "golden_records": result.golden,
        "review_candidates": result.review, "ghost_records": result.ghosts,
        "merged_ghosts": reconcile.merged_ghosts(result.ghosts, result.edges),
    })


# --- reconciliation ----------------------------------------------------------------


def _order_ghosts(spark, folder):
    """Orders as payroll; customers with a positive balance as golden records."""
    orders = _read(spark, folder, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey"), F.lit(5)).alias("employee_id"), "o_totalprice"
    )
    customers = _read(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("employee_id")
    )
    return reconcile.ghosts(orders, customers), orders


def ghosts(spark, folder):
    return _order_ghosts(spark, folder)[0]


def ghost_rate(spark, folder):
    return reconcile.ghost_rate(*_order_ghosts(spark, folder))


def ghost_export(spark, folder):
    return exports.ghost_report(ghosts(spark, folder), salary="o_totalprice")


# --- deliverables, written and read back -----------------------------------------------


def _csv_back(spark, path, fields):
    return spark.read.schema(fields).options(header=True, quote='"', escape='"', enforceSchema=False).csv(path)


def ghost_file(spark, folder):
    found = ghosts(spark, folder).withColumnRenamed("o_totalprice", "salary_usd_annual")
    path = exports.write_ghost_report(found, staging_path(spark, "ghost-file"))
    return _csv_back(spark, path, "payroll_employee_id long, name string, salary_usd_annual double, ghost_flag_reason string")


def review_file(spark, folder):
    review = linkage.review_list(_linked_parts(spark, folder))
    path = exports.write_review_report(review, staging_path(spark, "review-file"))
    return _csv_back(spark, path, "record_1_id string, record_2_id string, similarity_score double, "
                                  "hire_date_diff_days int, recommended_action string")


def report_file(spark, folder):
    """Rows of the quality file; their place in it is the order of the checks."""
    path = exports.write_quality_report(standard_report(spark, folder), staging_path(spark, "report-file"))
    rows = _csv_back(spark, path, "check string, description string, total long, passed long, failed long, pass_rate double, status string")
    return rows.select((F.monotonically_increasing_id() + 1).alias("position"), "*")  # one file, one task


def page_file(spark, folder):
    """What the head of the HTML page counts, and how many rows of each outcome follow."""
    path = exports.write_quality_page(standard_report(spark, folder), staging_path(spark, "page-file"))
    line = F.col("value")
    counts = [F.max(F.regexp_extract(line, f"{name}: ([0-9]+)", 1).try_cast("bigint")).alias(alias)
              for name, alias in (("Total checks", "total"), ("Passed", "passed"), ("Failed", "failed"))]
    rows = [F.count_if(line.contains(f"<b>{status}</b>")).alias(alias) for status, alias in (("PASS", "passed_rows"), ("FAIL", "failed_rows"))]
    return spark.read.text(path).agg(*counts, *rows)


def exported_files(spark, folder):
    """All deliverables of the three passes: rows of each file, null where none is written."""
    _, result = _three_passes(spark, folder)
    golden = result.golden.withColumn("company_origin", F.col("source"))
    files = exports.export_all(golden, result.review, result.ghosts.where("false"), staging_path(spark, "deliverables"))
    rows = []
    for name, path in files.items():
        read = spark.read.option("header", True)
        count = None if path is None else F.count("*")
        table = spark.range(1) if path is None else read.parquet(path) if name == "golden" else read.csv(path)
        rows.append(table.agg(F.lit(name).alias("file"), F.lit(None).cast("bigint").alias("rows") if count is None else count.alias("rows")))
    return rows[0].union(rows[1]).union(rows[2])


# --- quality ---------------------------------------------------------------------------


def quality_report(spark, folder):
    orders = _read(spark, folder, "orders").select(
        F.format_string("GT-%06d", "o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("state"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return quality.quality_report(orders, [
        quality.not_null("priority", "filled"),
        quality.not_null("state", "filled", threshold=0.5),
        quality.unique("id", "one row per id"),
        quality.unique("customer", "one order per customer"),
        quality.matches("priority", "[12]-[A-Z]", "urgent"),
        quality.in_set("state", ["F"], "finished"),
        quality.date_range("day", "1996-01-01", "2000-12-31", "period"),
        quality.flag_rate("state", "F", 0.25, "few finished"),
        quality.flag_rate("priority", "1-URGENT", 0.5, "not mostly urgent"),
        quality.column_present(orders, "day", "has a date"),
        quality.column_present(orders, "salary", "has a salary"),
        quality.min_row_count(1000, "enough rows"),
        quality.min_row_count(1_000_000_000, "many rows"),
        quality.ghost_rate(ghosts(spark, folder), "known customers"),
    ])


def _customer_golden(spark, folder):
    """Customers in the shape of the golden table."""
    departments = {"BUILDING": "Engineering", "MACHINERY": "Manufacturing", "AUTOMOBILE": "Sales",
                   "FURNITURE": "Interior"}
    return _read(spark, folder, "customer").select(
        F.format_string("GT-%06d", "c_custkey").alias("employee_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_acctbal") > 0, F.concat("c_name", F.lit("@example.org"))).alias("email"),
        text.mapped(F.col("c_mktsegment"), departments).alias("department"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.col("c_acctbal").cast("int") * 2).alias("hire_date"),
        F.lit(ROSTER_A).alias("source_systems"),
    )


def standard_report(spark, folder):
    golden = _customer_golden(spark, folder)
    return quality.quality_report(golden, quality.standard_checks(golden, ghosts(spark, folder), AS_OF))


def quality_gate(spark, folder):
    return quality.gate_result(standard_report(spark, folder))


def all_passed(spark, folder):
    return quality.all_passed(standard_report(spark, folder))


def check_labels(spark, folder):
    return charts.quality_summary(standard_report(spark, folder))


def quality_page(spark, folder):
    """Rows of the HTML report, one per check."""
    page = exports.quality_page(standard_report(spark, folder))
    lines = page.select(F.explode(F.split("value", "\n")).alias("line"))
    return lines.where(F.col("line").startswith("<tr style"))


# --- counts, distributions and charts -------------------------------------------


def value_counts(spark, folder):
    return charts.headcount_by_department(_read(spark, folder, "part"), "p_type")


def top15(spark, folder):
    return charts.headcount_by_country(_read(spark, folder, "customer"), "c_nationkey")


def distinct_count(spark, folder):
    return aggregates.distinct_count(_read(spark, folder, "documents"), "text")


def distinct_labels(spark, folder):
    return aggregates.distinct_labels(_read(spark, folder, "orders"), "o_orderpriority")


def _employments(spark, folder):
    golden = _read(spark, folder, "customer").select(
        F.nullif(F.col("c_custkey"), F.lit(3)).alias("k"),
        F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("segment"),
    )
    payroll = _read(spark, folder, "orders").select(
        F.nullif(F.col("o_custkey"), F.lit(4)).alias("k"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    return golden, payroll


COLUMNS = {"key": "k", "group": "segment", "value": "price"}


def box_stats(spark, folder):
    boxes = charts.salary_by_employment_type(*_employments(spark, folder), **COLUMNS)
    rounded = [F.round(c, 4).alias(c) for c in ("whisker_low", "q1", "median", "q3", "whisker_high")]
    return boxes.select("segment", "n", *rounded, "outliers")


def box_outliers(spark, folder):
    """Text lengths beyond the whiskers of their language."""
    documents = _read(spark, folder, "documents").select("lang", "n_chars")
    boxes = quantiles.box_statistics(documents, "n_chars", "lang")
    return quantiles.box_outliers(documents, "n_chars", "lang", boxes)


def tenure_hist(spark, folder):
    return charts.tenure_distribution(_read(spark, folder, "orders"), AS_OF, "o_orderdate")


def median_tenure(spark, folder):
    return charts.median_tenure(_read(spark, folder, "orders"), AS_OF, "o_orderdate")


def tenure_years(spark, folder):
    return _read(spark, folder, "orders").select(
        "o_orderkey", dates.tenure_years(F.col("o_orderdate"), AS_OF).alias("tenure_years"))


def enrollment_rate(spark, folder):
    golden = _read(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    large = _read(spark, folder, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("k"))
    rates = charts.enrollment_by_department(golden, large, "k", "c_mktsegment")
    return rates.select("c_mktsegment", F.round("enrollment_rate", 6).alias("enrollment_rate"), "target")


# --- files ----------------------------------------------------------------------------


def csv_roundtrip(spark, folder):
    """Whole texts with quotes and line breaks through CSV; `de` becomes an NA token."""
    path = staging_path(spark, "csv")
    documents = _read(spark, folder, "documents").select(
        "doc_id", "text", F.when(F.col("lang") == "de", "n/a").otherwise(F.col("lang")).alias("lang"))
    documents.write.csv(
        path, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    read = readers.read_delimited(spark, path, "documents", ["doc_id", "text", "lang"])
    return read.rows.select(
        F.col("doc_id").cast("bigint"), F.md5("text").alias("text_md5"), "lang", "source")


def csv_mixed_headers(spark, folder):
    """Files of one folder whose columns stand in different orders or are partly absent."""
    path = staging_path(spark, "csv")
    documents = _read(spark, folder, "documents")
    layouts = {"en": ["doc_id", "text", "lang"], "de": ["lang", "doc_id", "text"],
               "fr": ["text", "lang", "doc_id"], "es": ["text", "doc_id"]}
    for lang, columns in layouts.items():
        documents.where(F.col("lang") == lang).select(*columns).write.csv(
            f"{path}/{lang}", header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    read = readers.read_delimited(spark, f"{path}/*", "documents", ["doc_id", "text", "lang"])
    rows = read.rows.select(
        F.col("doc_id").cast("bigint"), F.md5("text").alias("text_md5"), "lang", "source")
    issues = read.schema_issues.select(
        F.lit(-1).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text_md5"),
        F.col("column").alias("lang"), "source")
    return rows.unionAll(issues)


def csv_dead_letters(spark, folder):
    """Orders as lines, some with a field too many; kept and dead ones counted."""
    path = staging_path(spark, "csv")
    extra = F.when(F.col("o_orderstatus") == "P", ",surplus").otherwise("")
    line = F.concat(F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_orderpriority"), extra)
    header = "o_orderkey,o_orderstatus,o_orderpriority"
    _read(spark, folder, "orders").select(line.alias(header)).write.csv(path, header=True, sep="\u0001")
    read = readers.read_delimited(
        spark, path, "orders", ["o_orderkey", "o_clerk"], multi_line=False)
    kept = read.rows.select(F.lit("kept").alias("outcome"))
    dead = read.dead_letters.select(F.col("reason").alias("outcome"))
    issues = read.schema_issues.select(F.concat(F.lit("no column "), "column").alias("outcome"))
    return aggregates.value_counts(kept.unionAll(dead).unionAll(issues), "outcome")


def json_roundtrip(spark, folder):
    """Turns as pages of at most 100 nested objects, one page per line."""
    path = staging_path(spark, "json")
    turn = F.struct("turn", F.struct("role", "text").alias("said"))
    pages = (
        _read(spark, folder, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / 100).alias("page"))
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    pages.select(F.to_json(F.struct("turns")).alias("value")).write.text(path)
    schema = "turns array<struct<turn: bigint, said: struct<role: string, text: string>>>"
    read = readers.read_nested(
        spark, path, "talk", schema, "turns", code_column="said_role",
        codes={"user": "U", "assistant": "A"}, multi_line=False)
    return read.rows.select("turn", "said_role", F.md5("said_text").alias("text_md5"), "source")


def xml_roundtrip(spark, folder):
    """Customers as elements; some lack a child, some have an empty one."""
    path = staging_path(spark, "xml")
    segment = F.col("c_mktsegment")
    _read(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("employee_id"),
        F.when(segment != "FURNITURE", F.when(segment == "MACHINERY", "").otherwise(segment)).alias("plan_type"),
        F.col("c_name").alias("coverage_level"),
    ).write.format("xml").options(rootTag="enrollments", rowTag="enrollment").save(path)
    read = readers.read_tagged(spark, path, expected=["employee_id", "plan_type", "coverage_level"])
    dead = read.dead_letters.select(
        F.get_json_object("record", "$.employee_id").alias("employee_id"),
        F.lit(None).cast("string").alias("plan_type"),
        F.get_json_object("record", "$.coverage_level").alias("coverage_level"),
        F.col("reason").alias("source"),
    )
    return read.rows.unionByName(dead)


def _write_workbooks(folder: str):
    """A function for mapInPandas that writes a workbook of each Arrow batch to the shared folder and gives its name."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        system.create_dir(root)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            rows = [list(batch.columns), *batch.astype(object).values.tolist()]
            name = f"{task:05d}-{number:05d}.xlsx"  # a task that runs again writes the same
            with system.open_output_stream(f"{root}/{name}") as stream:
                stream.write(workbook(rows))
            yield pd.DataFrame({"name": [name]})

    return write


def xlsx_roundtrip(spark, folder):
    """Suppliers and customers as workbook files of one Arrow batch each, read back."""
    path = staging_path(spark, "workbook-files")
    payroll = _payroll(spark, folder).select(
        F.col("employee_id").cast("bigint").alias("employee_id"),
        F.col("company_origin").alias("source"), "base_salary", "currency")
    stage(payroll.mapInPandas(_write_workbooks(path), "name string"), "workbook-names")
    read = readers.read_workbooks(
        spark, path, "payroll", ["employee_id", "source", "base_salary", "currency"], {"source": "company_origin"})
    return read.rows


def golden_roundtrip(spark, folder):
    """Write both companies, rewrite one, read both: the other is untouched."""
    out = staging_path(spark, "golden")
    balance = F.col("c_acctbal")
    golden = _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", COMPANY_B).otherwise(COMPANY_A).alias("company_origin"),
        F.date_add(F.lit("1990-01-01").cast("date"), balance.cast("int")).alias("hire_date"),
        F.lit("ok").alias("hire_date_flag"),
        F.lit("first").alias("version"),
    )
    exports.write_golden(golden, out)
    second = golden.where(F.col("company_origin") == COMPANY_B).withColumn("version", F.lit("second"))
    path = exports.write_golden(second, out)
    return spark.read.parquet(path).select("employee_id", "company_origin", "hire_date", "version")


ALL = [
    parties, source_counts, format_ids, other_origins, party_report, code_map, code_map_table, unmapped_values,
    clean_names, parse_dates, annual_amount, payroll_counts, benefit_ids, unknown_category,
    unknown_category_table, flatten_json, page_stats, exact_dedup, exact_dedup_null_key,
    priority_dedup, priority_edges, shared_hosts, order_merge, drop_rows, linkage_candidates,
    linkage_matches, linkage_review, review_export, review_actions, url_candidates, url_matches,
    url_review, golden_provenance, match_edges, removed_by_step, stage_summary, ghosts, ghost_rate,
    ghost_export, ghost_file, review_file, report_file, page_file, exported_files, quality_report, standard_report, quality_gate, all_passed, check_labels,
    quality_page, value_counts, top15, distinct_count, distinct_labels, box_stats, box_outliers,
    tenure_hist, median_tenure, tenure_years, enrollment_rate, csv_roundtrip, csv_mixed_headers, csv_dead_letters,
    json_roundtrip, xml_roundtrip, xlsx_roundtrip, golden_roundtrip,
]

QUERIES = {query.__name__: query for query in ALL}
