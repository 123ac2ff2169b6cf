"""Inputs of the registered queries, derived from the given tables.

Every view reads whole tables; nothing is sampled, cut or made up on the side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.plans.sizes import spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts, spread over the cores for the costly text rules."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_name() -> Column:
    """File name of a document; the language stands for the file type."""
    return F.concat(
        F.lit("cases/doc_"),
        F.col("doc_id").cast("string"),
        F.when(F.col("lang") == "en", ".pdf")
        .when(F.col("lang") == "fr", ".PDF")
        .when(F.col("lang") == "de", "")
        .otherwise(".tar.gz"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a store."""
    return table(spark, sf_dir, "documents").select(
        listing_name().alias("file_name"),
        F.col("n_chars").alias("size_bytes"),
        F.timestamp_add("MINUTE", F.col("n_chars").cast("int"), F.lit("2020-01-01").cast("timestamp")).alias(
            "last_modified"
        ),
    )


def label_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as the ledger's state: documents of good quality are ingested."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id", listing_name().alias("file_name")
    )
    return table(spark, sf_dir, "labels").join(files, "doc_id").select(
        "file_name", (F.col("quality") == 1).alias("ingested")
    )


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the ledger log of one file per user."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("cases/doc_"), F.col("user_id").cast("string"), F.lit(".pdf")).alias("file_name"),
        F.col("event_type").isin("purchase", "signup", "view").alias("ingested"),
        F.col("ts").alias("event_ts"),
        F.col("event_id").alias("run_id"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log of ingest runs; an ``error`` event is a failed run."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("ts").alias("completed_at"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )


def opinions(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Every document dressed as a legal opinion.

    The order with the document's number and its customer and nation give the
    header; a document without an order keeps a header of blanks.  ``parts`` is the number of
    partitions, by default Spark's choice.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), "o_custkey", "o_orderstatus", "o_orderdate"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Headers are made of narrow rows first, so the texts move once, by their own key.
    headers = (
        orders.join(docs.select("doc_id"), "doc_id", "left_semi")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    dealt = docs.repartition("doc_id") if parts is None else docs.repartition(parts, "doc_id")
    joined = dealt.join(headers, "doc_id", "left")
    doc, name = F.col("doc_id").cast("string"), F.coalesce("n_name", F.lit("NOWHERE"))
    customer_no = F.coalesce(F.col("o_custkey"), F.lit(0)).cast("string")
    iso = F.coalesce(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("1999-12-31"))
    long = F.coalesce(F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("December 31, 1999"))
    status, segment = F.col("o_orderstatus"), F.col("c_mktsegment")
    lines = [
        F.lit("[DO NOT PUBLISH]"),
        F.lit("IN THE"),
        F.concat(
            F.lit("SUPREME COURT OF "),
            F.when(status == "F", "ILLINOIS").when(status == "O", "OHIO").otherwise("TEXAS"),
        ),
        F.lit("SECOND JUDICIAL DISTRICT"),
        F.lit("________________"),
        F.concat(F.lit("Docket No. "), doc, F.lit("-"), customer_no),
        F.when(segment == "BUILDING", "Non-Argument Calendar").otherwise("Argued"),
        F.concat(F.lit("Filed: "), long),
        F.concat(F.lit("Appeal from the Circuit Court of "), name, F.lit(" (No. 7)")),
        F.lit("1"),
        F.lit("Background"),
        F.lit("The record holds evi-"),
        F.lit("dence on   the claim."),
        F.lit("Case: 7 Page 2 of 10"),
        F.concat(
            F.lit("See USSG §3B1."), customer_no,
            F.lit(" and Roe v. Wade, 410 U.S. 113 (1973). Under Ill. Stat. § 12.4. Doe v. Roe, 12 Cal. 345, 350 (Cal. "),
            F.substring(iso, 1, 4), F.lit(")."),
        ),
        F.lit(""),
        F.lit("  "),
        F.lit("¶ 2 II. Analysis"),
        F.col("body"),
        F.lit("We hold that the claim must fail. It is well settled that costs follow."),
        F.when(
            segment.isin("BUILDING", "MACHINERY"),
            F.concat(
                F.lit("CONCLUSION\n"),
                F.when(status == "F", "AFFIRMED.")
                .when(status == "O", "REVERSED AND\nREMANDED.")
                .otherwise("DENIED."),
            ),
        ).otherwise(""),
    ]
    return joined.select(
        "doc_id",
        F.concat(
            F.lit("data/"), iso, F.lit("_"), F.lower(name), F.lit("_v._doc_"), doc, F.lit(".pdf")
        ).alias("source"),
        F.concat_ws("\n", *lines).alias("text"),
    )


def statute_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as statute files: a title per order, a chapter per flag, a section per line."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"
    )
    section = F.concat(
        F.lit('<section num="'), F.col("l_linenumber").cast("string"),
        F.lit('"><heading> Part '), F.col("l_partkey").cast("string"),
        F.lit(" </heading>\n  <p>Supplier <b>"), F.col("l_suppkey").cast("string"),
        F.lit("</b> shall &amp; must.</p>\n</section>"),
    )
    chapter = F.concat(
        F.lit('<chapter num="'), F.col("l_returnflag"), F.lit('"><num>x</num>'), section, F.lit("</chapter>")
    )
    return lines.groupBy("l_orderkey").agg(
        F.array_join(F.sort_array(F.collect_list(chapter)), "\n").alias("chapters")
    ).select(
        F.concat(F.lit("usc/"), F.col("l_orderkey").cast("string"), F.lit(".xml")).alias("path"),
        F.concat(
            F.lit('<code><title num="'), F.col("l_orderkey").cast("string"), F.lit('">'),
            F.col("chapters"), F.lit("</title></code>"),
        ).alias("value"),
    )


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as files."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return pages.select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.encode("html", "UTF-8").alias("content"),
    )


def centroid_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its vectors, component by component."""
    parts = table(spark, sf_dir, "embeddings").select(
        "label", F.posexplode("embedding").alias("i", "x")
    )
    means = parts.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    # One entry per component: the group is as long as a vector, whatever the table holds.
    return means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("vector")
    ).select(F.col("label").alias("query_id"), "vector")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector")
    )
