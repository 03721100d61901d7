"""Queries that take up data in parts: folded logs, merged counts, paged
documents, rows a lookup reads. SQL twins beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.operators import extract as E
from ratebook.operators import ledger as J
from ratebook.operators import normalize as N
from ratebook.operators import summary as S
from ratebook.plans import bindings as B
from ratebook.plans.bindings import register, table
from ratebook.plans.oracles import ORACLES
from ratebook.plans.storage import folder
from ratebook.sources import sinks as K
from ratebook.sources import stages as ST
from ratebook.sources.readers import read_products


@register("ledger_fold_batches")
def q_ledger_fold_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log folded in three batches into a snapshot, one of them
    sent twice; equals the fold of the whole log."""
    log = B.event_transitions(spark, sf_dir)
    root = folder(spark, "ledger")
    for part in (0, 2, 0, 1):
        state, _ = ST.take_batch(spark, root, "ledger_state", log.where(F.col("seq") % 3 == part), J.fold_state, J.merge_states)
    led = J.ledger_of(B.event_jobs(spark, sf_dir), state)
    return led.select("job_id", "status", "retries", "content_path", "error", B._ts("created_at"), B._ts("updated_at"))


ORACLES["ledger_fold_batches"] = ORACLES["ledger_fold"]


@register("checkpoint_registry_batches")
def q_checkpoint_registry_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint registry taken up in two batches."""
    saves = B.event_saves(spark, sf_dir)
    root = folder(spark, "registry")
    for part in (1, 0):
        state, _ = ST.take_batch(spark, root, "registry", saves.where(F.col("seq") % 2 == part), J.checkpoint_state,
                                 J.merge_checkpoints)
    return J.latest_of(state).select("stage", "data_path", "row_count", B._ts("created_at"))


ORACLES["checkpoint_registry_batches"] = ORACLES["latest_checkpoint"]


@register("merged_value_counts")
def q_merged_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count tables of three loads of the orders, merged."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("string").alias("o_year"))
    cols = ["o_orderstatus", "o_orderpriority", "o_year"]
    return S.merge_counts(*[S.count_table(o.where(F.col("o_orderkey") % 3 == k), cols) for k in range(3)])


ORACLES["merged_value_counts"] = ORACLES["value_counts"]


@register("merged_summary")
def q_merged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two loads of the lineitem records, merged: rows, and
    whether the estimated codes lie within five standard errors of the exact
    number."""
    li = B.lineitem_records(spark, sf_dir).withColumn("load", F.col("ord.l_orderkey") % 2)
    merged = S.merge_sketches(*[S.load_sketch(li.where(F.col("load") == k)) for k in (0, 1)])
    exact = S.summary(li).select(F.col("unique_hsn_codes").alias("exact"))
    from ratebook.operators.joins import one_row_join
    off = F.abs(F.col("unique_hsn_codes") - F.col("exact")) / F.col("exact")
    return one_row_join(merged, exact).select("total_records", F.col("exact").alias("unique_hsn_codes"),
                                              (off <= 5 * S.SKETCH_ERROR).alias("close"))


ORACLES["merged_summary"] = """
SELECT count(*) AS total_records, count(DISTINCT l_partkey) AS unique_hsn_codes, true AS close FROM lineitem
"""


@register("stored_find_one")
def q_stored_find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + L7: the part products written with Bloom filters, clustered by
    code; point lookups of a code that is there and of one that is not."""
    path = folder(spark, "points")
    K.load_products(B.part_products(spark, sf_dir), path, mode="overwrite")
    products = read_products(spark, path)
    return S.find_one(products, "1234").unionByName(S.find_one(products, "1234x"))


ORACLES["stored_find_one"] = ORACLES["find_one"]


@register("document_pages")
def q_document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part-derived documents of three pages with two tables each
    (20 rows a table), whose rows carry the page they stood on, normalised."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t = F.floor(k / 20).cast("long")
    place = [F.floor(t / 6).cast("long").alias("doc_id"), (F.floor(t / 2) % 3 + 1).cast("int").alias("page"),
             (t % 2).cast("int").alias("table_idx")]
    name = F.concat(F.lit("doc "), F.floor(t / 6).cast("string")).alias("source_name")
    rows = p.select(*place, (k % 20 + 1).cast("int").alias("row_idx"),
                    F.array(k.cast("string"), F.col("p_name"), F.concat((F.col("p_size") % 4 * 6).cast("string"), F.lit("%")),
                            F.lit("cut")).alias("cells"), name)
    heads = p.select(*place, F.lit(0).alias("row_idx"), F.array(F.lit("HSN Code"), F.lit("Description"), F.lit("Rate")).alias("cells"),
                     name).distinct()
    raw = E.document_rows(rows.unionByName(heads))
    good, _ = N.split_errors(N.normalize(raw, keep=("ord",)))
    return good.select("ord.doc_id", "ord.page", "ord.table_idx", "hsn_code", "gst_description", "source_name",
                       F.col("igst_rate").cast("double").alias("igst_rate"), "raw_text")


ORACLES["document_pages"] = """
SELECT (p_partkey // 20) // 6 AS doc_id, CAST(((p_partkey // 20) // 2) % 3 + 1 AS INTEGER) AS page,
       CAST((p_partkey // 20) % 2 AS INTEGER) AS table_idx, CAST(p_partkey AS VARCHAR) AS hsn_code, p_name AS gst_description,
       'doc ' || CAST((p_partkey // 20) // 6 AS VARCHAR) AS source_name, CAST(p_size % 4 * 6 AS DOUBLE) AS igst_rate,
       CAST(p_partkey AS VARCHAR) || ' | ' || p_name || ' | ' || CAST(p_size % 4 * 6 AS VARCHAR) || '%' AS raw_text
FROM part
"""
