"""Registered queries of the stages that are put together from the operators, each with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import stripped, token_estimate
from leafmill.operators import catalogue, chunking, entities, payments, retrieval, segmentation, telemetry, viewer
from leafmill.plans import bindings as B
from leafmill.plans import reference as R
from leafmill.sources import exports
from leafmill.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return add


# --- retrieval and summaries -------------------------------------------------------------------------------------------------


@query("""SELECT 'payments' AS query, CAST(count(*) AS INT) AS chunks_used, list(CAST(doc_id AS VARCHAR) ORDER BY d, doc_id) AS chunk_ids, 'No model response.' AS answer FROM (
        SELECT doc_id, d, sum(n) OVER (ORDER BY d, doc_id) AS running FROM (
            SELECT v.doc_id, greatest(1, length(v.text) // 4) AS n, 1 - list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS d
            FROM documents v JOIN embeddings e ON e.vec_id = v.doc_id, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE v.text IS NOT NULL ORDER BY d, v.doc_id LIMIT 16))
    WHERE running <= 7000""")
def retrieval_qa(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").filter("text IS NOT NULL")
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), F.lit("all").alias("document_id"), token_estimate(F.col("text")).alias("token_estimate"))
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    found = retrieval.retrieve(chunks, vectors, R._query_vector(spark, sf), 16, 32, 7_000)
    done = retrieval.answer_of(found, "payments")
    return done.select("query", "chunks_used", F.transform("chunk_ids", lambda x: x.cast("string")).alias("chunk_ids"), "answer")


_LINES = f"""(SELECT document_id, segment, 'Section ' || segment || ' (pages ' || first || '–' || last || ', type: ' || kind || '): ' || CASE WHEN held THEN '[Segment ' || segment || ': could not summarize]'
        ELSE '[Segment ' || segment || ' of ' || max(segment) OVER (PARTITION BY document_id) || ', pages ' || first || '–' || last || ': no readable content]' END AS line
    FROM (SELECT document_id, segment, min(first) AS first, max(last) AS last, bool_or(held) AS held, arg_min(kind, (-n, kind)) AS kind FROM (
        SELECT s.document_id, s.segment, coalesce(s.page_type, 'text') AS kind, count(*) AS n, min(s.page_number) AS first, max(s.page_number) AS last,
            bool_or(regexp_replace(coalesce(p.text, ''), {B.STRIP}, '', 'g') <> '') AS held
        FROM {R._SEGMENTS} s JOIN {B.PAGES_SQL} p ON p.document_id = s.document_id AND p.page_number = s.page_number GROUP BY 1, 2, 3) GROUP BY 1, 2))"""


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    own = B.pages(spark, sf)
    cut = segmentation.segments(segmentation.adjacent_similarity(own))
    held = own.filter(stripped(F.col("text")) != "").select("document_id", "page_number")
    readable = cut.join(held, ["document_id", "page_number"]).select("document_id", "segment")
    return segmentation.section_lines(segmentation.segment_index(cut), readable)


@query(f"SELECT document_id, CAST(segment AS BIGINT) AS segment, line FROM {_LINES}")
def section_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _sections(spark, sf)


@query(f"""SELECT r.document_id, r.route, md5(coalesce(CASE WHEN r.route = 'segmented' THEN t.toc END, 'No readable content.')) AS summary_md5 FROM ({R.SQL['summary_route']}) r
    LEFT JOIN (SELECT document_id, string_agg(line, chr(10) ORDER BY segment) AS toc FROM {_LINES} GROUP BY 1) t USING (document_id)""")
def document_summaries(spark: SparkSession, sf: str) -> DataFrame:
    made = segmentation.document_summaries(R.summary_route(spark, sf), _sections(spark, sf))
    return made.select("document_id", "route", F.md5("summary").alias("summary_md5"))


@query("""SELECT doc_id, text FROM documents d WHERE text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id = d.doc_id AND e.doc_id % 3 = 0)""")
def changed_summaries(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").filter("text IS NOT NULL").select(F.col("doc_id").alias("document_id"), F.col("text").alias("summary"))
    stored = docs.withColumn("summary", F.when(F.col("document_id") % 3 == 0, F.col("summary")).otherwise(F.concat("summary", F.lit("!"))))
    return segmentation.changed_summaries(docs, stored).select(F.col("document_id").alias("doc_id"), F.col("summary").alias("text"))


@query(f"SELECT page_id, page_number FROM {B.PAGES_SQL} WHERE page_number >= 2 AND page_number <= 4")
def page_range(spark: SparkSession, sf: str) -> DataFrame:
    return segmentation.page_range(B.pages(spark, sf), 2, 4).select("page_id", "page_number")


@query(f"""SELECT c.chunk_id, d.doc_family, p.page_type FROM {R._CHUNKS} c JOIN (SELECT DISTINCT document_id, doc_family FROM documents WHERE status_embed = 'done') d USING (document_id)
    LEFT JOIN {B.PAGES_SQL} p ON p.page_id = c.page_id""")
def chunk_scan(spark: SparkSession, sf: str) -> DataFrame:
    own = B.pages(spark, sf)
    return chunking.scan(chunking.chunks(own), table(spark, sf, "documents"), own).select("chunk_id", "doc_family", "page_type")


# --- catalogue, names and payments -------------------------------------------------------------------------------------------


@query(f"""SELECT label, count(*) AS document_count, 'llm_map_reduce' AS method FROM ({R.SQL['group_assignment']}) GROUP BY label""")
def catalogue_build(spark: SparkSession, sf: str) -> DataFrame:
    docs = catalogue.batches(table(spark, sf, "documents").select("document_id"))
    given = R.group_assignment(spark, sf).join(docs, "document_id")
    done = catalogue.built(catalogue.heuristic_label(R._signals(spark, sf)), given)
    return done.groupBy("label", "method").agg(F.count("*").alias("document_count"))


@query("""SELECT d.document_id, md5(p.text) AS summary_md5 FROM documents d LEFT JOIN (SELECT document_id, text FROM page_results
    QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY page_number, page_id, created_at) = 1) p USING (document_id)""")
def catalogue_summaries(spark: SparkSession, sf: str) -> DataFrame:
    from leafmill.operators.pages import first_of_each

    first = first_of_each(table(spark, sf, "page_results"), "document_id", "page_number", "page_id", "created_at")
    docs = viewer.with_summaries(table(spark, sf, "documents"), first.withColumnRenamed("text", "summary_text"))
    return docs.select("document_id", F.md5("summary_text").alias("summary_md5"))


@query("""SELECT 'ent_' || substr(sha1(coalesce(kind, 'unknown') || ':' || trim(regexp_replace(lower(canonical_name), '[\\t-\\r ]+', ' ', 'g'))), 1, 12) AS entity_id, document_id, count(*) AS mentions
    FROM entity_cards WHERE trim(canonical_name) <> '' GROUP BY 1, 2""")
def entity_documents(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "entity_cards").select("document_id", F.coalesce("kind", F.lit("unknown")).alias("kind"), F.col("canonical_name").alias("name"))
    return entities.entity_documents(names)


@query("""SELECT card_id AS document_id, kind, name FROM (
        SELECT card_id, 'person' AS kind, unnest(list_filter(list_transform(aliases, lambda x: trim(x)), lambda x: x <> '')) AS name FROM entity_cards WHERE card_id % 3 <> 0
        UNION ALL SELECT card_id, 'organization', trim(canonical_name) FROM entity_cards WHERE card_id % 3 <> 0 AND trim(canonical_name) <> '')""")
def name_lists(spark: SparkSession, sf: str) -> DataFrame:
    answer = F.to_json(F.struct(F.col("aliases").alias("persons"), F.array("canonical_name").alias("organizations")))
    fenced = F.when(F.col("card_id") % 3 == 0, "no object").when(F.col("card_id") % 3 == 1, answer).otherwise(F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
    return entities.name_lists(table(spark, sf, "entity_cards").select(F.col("card_id").alias("document_id"), fenced.alias("answer")))


@query("""SELECT 'order_' || o_orderkey AS document_id, substr(sha1('order_' || o_orderkey || '|1|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || kind), 1, 16) AS paystub_id, kind AS document_type,
        CASE WHEN o_orderkey % 4 <> 1 THEN round(o_totalprice, 2) END AS gross_pay, 'EUR' AS currency, CASE o_orderkey % 4 WHEN 1 THEN 'invalid_numeric_pay_fields' WHEN 2 THEN 'net_pay_exceeds_gross_pay' END AS notes,
        CASE WHEN o_orderkey % 4 IN (1, 2) THEN 'needs_review' ELSE 'valid' END AS validation_status, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 9 AS INT) END AS page_number
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'payment_record' ELSE 'invoice' END AS kind FROM orders)""")
def payment_records(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    price = F.round("o_totalprice", 2)
    record = F.struct(
        F.when(key % 3 == 0, " ").otherwise("Invoice").alias("document_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pay_date"),
        F.when(key % 4 == 1, "twelve").otherwise(price.cast("string")).alias("gross_pay"),
        F.when(key % 4 == 2, (price + 1).cast("string")).otherwise("1").alias("net_pay"),
        F.lit(" eur").alias("currency"),
        F.array(F.struct(F.lit("part").alias("description"), F.lit(1.5).alias("amount")), F.struct(F.lit(" ").alias("description"), F.lit(None).cast("double").alias("amount"))).alias("items"),
        F.array(F.concat(F.lit("none"), key.cast("string")), F.concat(F.lit("c"), key.cast("string"))).alias("evidence_chunk_ids"),
    )
    answers = orders.select(F.concat(F.lit("order_"), key.cast("string")).alias("document_id"), F.to_json(F.struct(F.array(record).alias("records"))).alias("answer"))
    chunk_pages = orders.filter(key % 2 == 0).select(F.concat(F.lit("c"), key.cast("string")).alias("chunk_id"), (F.col("o_custkey") % 9).cast("int").alias("page_number"))
    done = payments.payments_from(answers, chunk_pages)
    return done.select("document_id", "paystub_id", "document_type", "gross_pay", "currency", "notes", "validation_status", "page_number")


# --- sources -------------------------------------------------------------------------------------------------------------------


@query("""SELECT user_id, md5(string_agg('[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' || event_type || ': ' || event_id, chr(10) ORDER BY event_id)) AS text_md5 FROM events GROUP BY user_id""")
def chat_export_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("payload", F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "event_type", F.col("event_id").cast("string")))
    lines = exports.chat_lines(exports.csv_rows(rows, "payload", "date,sender,message"), "user_id", "event_id", "payload")
    return lines.select("user_id", F.md5("text").alias("text_md5"))


@query("""SELECT document_id, CAST(1 AS INT) AS page_number, md5(text) AS text_md5 FROM documents WHERE doc_family = 'text' AND text IS NOT NULL
    UNION ALL SELECT document_id, CAST(i + 1 AS INT), md5('[UNTRANSCRIBED - ASR unavailable]') FROM (SELECT document_id, unnest(range(0, CAST(ceil(
        greatest(1, floor(coalesce(audio_duration_seconds, video_duration_seconds, 30))) / 30.0) AS BIGINT))) AS i FROM documents WHERE doc_family IN ('audio', 'video'))""")
def family_pages(spark: SparkSession, sf: str) -> DataFrame:
    def text(docs: DataFrame) -> DataFrame:
        return docs.filter("text IS NOT NULL").select("document_id", F.lit(1).alias("page_number"), "text")

    families = {"text": text, "audio": exports.media_segments, "video": exports.media_segments}
    return exports.dispatched(table(spark, sf, "documents"), families).select("document_id", "page_number", F.md5("text").alias("text_md5"))


# --- observability --------------------------------------------------------------------------------------------------------------


@query("""SELECT stage, run_id, count(*) FILTER (outcome = 'done') AS processed, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'failed') AS failed
    FROM stage_attempts GROUP BY stage, run_id""")
def stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.stage_metrics(table(spark, sf, "stage_attempts"))


@query("""SELECT user_id, count(*) AS calls, CAST(sum(greatest(0, k - 3)) AS BIGINT) AS token_input, CAST(0 AS BIGINT) AS token_output, round(sum(round(greatest(0, value - 50), 2)), 4) AS total_ms
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY user_id""")
def call_usage(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    calls = table(spark, sf, "events").select("user_id", (F.col("value") - 50).alias("duration_ms"), (k - 3).alias("token_input"), F.lit(None).cast("int").alias("token_output"))
    return telemetry.usage(telemetry.call_records(calls), "user_id").withColumn("total_ms", F.round("total_ms", 4))


@query("""SELECT event_id FROM events WHERE event_id % 5 = 0 OR event_type NOT IN ('click', 'error')""")
def jsonl_without_stages(spark: SparkSession, sf: str) -> DataFrame:
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{broken "), "event_type")).otherwise(F.to_json(F.struct(F.col("event_type").alias("stage"), "value")))
    return telemetry.without_stages(table(spark, sf, "events").withColumn("value", line), ["click", "error"]).select("event_id")


@query("SELECT count(m) AS documents, round(avg(m), 6) AS mean_confidence FROM (SELECT avg(confidence) AS m FROM page_results GROUP BY document_id)")
def confidence_overall(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.mean_of_means(table(spark, sf, "page_results")).withColumn("mean_confidence", F.round("mean_confidence", 6))
