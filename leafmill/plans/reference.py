"""Registered queries of the document pipeline's own operators, each with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import payments as P
from leafmill.functions import text as T
from leafmill.functions.ids import content_hash, document_id, entity_id
from leafmill.operators import catalogue, chunking, entities, pages, payments, retrieval, segmentation, store, telemetry, viewer
from leafmill.plans import bindings as B
from leafmill.sources import exports, files
from leafmill.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with its SQL where there is one."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


# --- sources ------------------------------------------------------------------------------------------------------------


@query("""SELECT content_id, path FROM (SELECT 'doc_' || substr(sha256(text), 1, 12) AS content_id, path FROM documents WHERE text IS NOT NULL)
    QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY path) = 1""")
def ingest_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").filter("text IS NOT NULL")
    rows = docs.select(document_id(content_hash(F.col("text"))).alias("document_id"), "path")
    return pages.new_documents(rows).withColumnRenamed("document_id", "content_id")


_MEDIA = "CASE lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in files.MEDIA.items()) + " ELSE 'application/octet-stream' END"


@query(f"""SELECT document_id, m AS detected_media_type, CASE
        WHEN e IN ('json', 'csv') AND contains(lower(n), 'chat') THEN 'chat_export' WHEN m LIKE 'text/%' THEN 'text' WHEN e = 'pdf' THEN 'pdf'
        WHEN e IN {files.IMAGES} THEN CASE WHEN contains(lower(n), 'screenshot') THEN 'screenshot' ELSE 'image' END
        WHEN e IN {files.AUDIO} THEN 'audio' WHEN e IN {files.VIDEO} THEN 'video' ELSE 'other' END AS detected_family
    FROM (SELECT document_id, {_MEDIA} AS m, lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) AS e, string_split(path, '/')[-1] AS n FROM documents)""")
def media_type_family(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    return table(spark, sf, "documents").select(
        "document_id", files.media_type(path).alias("detected_media_type"), files.doc_family(path).alias("detected_family")
    )


@query("""SELECT user_id, md5(string_agg(line, chr(10) ORDER BY event_id)) AS text_md5, count(line) AS messages FROM (
        SELECT user_id, event_id, CASE event_id % 4
            WHEN 0 THEN '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' || event_type || ': ' || props
            WHEN 1 THEN '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' || event_type || ': ' || props
            WHEN 2 THEN '[] unknown: ' || props END AS line FROM events) GROUP BY user_id""")
def chat_export_lines(spark: SparkSession, sf: str) -> DataFrame:
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kinds = [
        F.to_json(F.struct(when.alias("timestamp"), F.col("event_type").alias("sender"), F.col("props").alias("message"))),
        F.to_json(F.struct(when.alias("date"), F.col("event_type").alias("from"), F.col("props").alias("text"))),
        F.to_json(F.struct(F.lit("").alias("sender"), F.col("props").alias("text"))),
        F.lit("no object"),
    ]
    payload = F.element_at(F.array(*kinds), (F.col("event_id") % 4 + 1).cast("int"))
    lines = exports.chat_lines(table(spark, sf, "events").withColumn("payload", payload), "user_id", "event_id", "payload")
    return lines.select("user_id", F.md5("text").alias("text_md5"), F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("messages"))


@query("""SELECT document_id, document_id || '_p' || lpad((i + 1)::VARCHAR, 4, '0') AS page_id, i * 30000 AS start_ms, least(d, i * 30 + 30) * 1000 AS end_ms,
        'timestamp:' || (i * 30000) || '-' || (least(d, i * 30 + 30) * 1000) || CASE WHEN doc_family = 'video' THEN ';keyframe_every_ms:15000' ELSE '' END AS source_pointer
    FROM (SELECT *, unnest(range(0, CAST(ceil(d / 30.0) AS BIGINT))) AS i FROM (SELECT document_id, doc_family,
        greatest(1, CAST(floor(coalesce(audio_duration_seconds, video_duration_seconds, 30)) AS INT)) AS d FROM documents WHERE doc_family IN ('audio', 'video')))""")
def asr_placeholder_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = exports.media_segments(table(spark, sf, "documents"))
    return rows.select("document_id", "page_id", "start_ms", "end_ms", "source_pointer")


# --- text quality and page types -------------------------------------------------------------------------------------------


def _quality_sql(source: str, keep: str) -> str:
    """SELECT `keep`, score and fault of the column text of a source."""
    return f"""SELECT {keep}, CASE WHEN size IS NULL OR size = 0 THEN 0.0 WHEN size < 30 THEN 0.1 ELSE score END AS score,
        CASE WHEN size IS NULL OR size < 30 THEN 'empty_or_near_empty' WHEN alpha < 0.2 THEN 'low_alpha_ratio' WHEN short > 0.5 THEN 'vertical_or_fragmented_text'
            WHEN score < 0.45 THEN 'bad_text_layer' END AS fault
    FROM (SELECT *, round(greatest(0, least(1, 0.25 * least(1, alpha / 0.5) + 0.2 * printable + 0.15 * least(1, uniq / 0.3) + 0.15 * (1 - coalesce(short, 1))
            + 0.1 * (1 - spaces) + 0.15 * least(1, words))), 3) AS score
        FROM (SELECT *, length(regexp_replace(body, '[^a-zA-Z]', '', 'g')) / size AS alpha, length(regexp_replace(body, '[^ -~]', '', 'g')) / size AS printable,
                len(list_distinct(string_split(body, ''))) / least(size, 200) AS uniq, len(list_filter(lines, lambda x: length(x) <= 2)) / nullif(len(lines), 0) AS short,
                length(regexp_replace(text, '[^\\t-\\r ]', '', 'g')) / greatest(1, length(text)) AS spaces,
                len(regexp_extract_all(body, '\\b[a-zA-Z]{{3,}}\\b')) / greatest(1.0, size / 5.0) AS words
            FROM (SELECT *, length(body) AS size, list_filter(list_transform(string_split_regex(body, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]'),
                    lambda x: regexp_replace(x, '^[\\t-\\r ]+|[\\t-\\r ]+$', '', 'g')), lambda x: x <> '') AS lines
                FROM (SELECT *, regexp_replace(text, '^[\\t-\\r ]+|[\\t-\\r ]+$', '', 'g') AS body FROM ({source})))))"""


_FOLDED = f"SELECT * EXCLUDE (text), {B.FOLD_SQL} AS text FROM {B.PAGES_SQL}"


@query(_quality_sql(_FOLDED, "page_id"))
def text_quality(spark: SparkSession, sf: str) -> DataFrame:
    return T.with_quality(B.folded_pages(spark, sf).select("page_id", "text"), "text", "score", "fault").select("page_id", "score", "fault")


def _page_type_sql(source: str, keep: str) -> str:
    return f"""SELECT {keep}, CASE WHEN regexp_replace(t, '^[\\t-\\r ]+|[\\t-\\r ]+$', '', 'g') = '' THEN CASE WHEN confidence < 0.2 THEN 'handwritten' ELSE 'blank' END
            WHEN len(regexp_extract_all(t, '{T.INVOICE_WORDS}')) >= 2 THEN 'invoice'
            WHEN len(regexp_extract_all(t, '\\[\\s*[xX\\s]\\s*\\]')) >= 2 OR len(regexp_extract_all(t, '{T.FORM_LABELS}')) >= 3 THEN 'form'
            WHEN len(list_filter(lines, lambda x: len(regexp_extract_all(x, '\\b[\\d,.$%]+\\b')) >= 3)) / len(lines) > 0.3
              OR len(list_filter(lines, lambda x: len(regexp_extract_all(x, '[\\t-\\r ]{{2,}}')) >= 2)) / len(lines) > 0.4 THEN 'table'
            WHEN confidence < 0.35 AND confidence > 0 AND len(list_filter(tokens, lambda x: length(x) <= 3)) / len(tokens) > 0.5 THEN 'handwritten'
            WHEN regexp_matches(t, '{T.COMMENT_WORDS}') THEN 'comment_box' ELSE 'text' END AS page_type
    FROM (SELECT *, list_filter(string_split_regex(t, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]'), lambda x: regexp_replace(x, '^[\\t-\\r ]+|[\\t-\\r ]+$', '', 'g') <> '') AS lines,
            list_filter(string_split_regex(t, '[\\t-\\r ]+'), lambda x: x <> '') AS tokens
        FROM (SELECT *, coalesce(text, '') AS t FROM ({source})))"""


@query(_page_type_sql(_FOLDED, "page_id"))
def page_type(spark: SparkSession, sf: str) -> DataFrame:
    return B.folded_pages(spark, sf).select("page_id", T.page_type(F.col("text"), F.col("confidence")).alias("page_type"))


_CANDIDATES = f"""SELECT document_id, page_number, rank, backend, CASE rank WHEN 0 THEN text WHEN 1 THEN trim(regexp_replace(text, '[\\t-\\r ]+', ' ', 'g')) ELSE substr(text, 1, 400) END AS text
    FROM ({_FOLDED}) CROSS JOIN (VALUES (0, 'a'), (1, 'b'), (2, 'c')) v(rank, backend) WHERE page_number IS NOT NULL"""


@query(f"""SELECT document_id, page_number, backend, score FROM ({_quality_sql(_CANDIDATES, 'document_id, page_number, rank, backend')}) WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY document_id, page_number ORDER BY score DESC, rank) = 1""")
def best_candidate(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.folded_pages(spark, sf).filter("page_number IS NOT NULL")
    kinds = [F.col("text"), T.collapsed(F.col("text")), F.substring("text", 1, 400)]
    each = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(b).alias("backend"), k.alias("candidate")) for i, (b, k) in enumerate(zip("abc", kinds))))
    offered = rows.select("document_id", "page_number", F.explode(each).alias("c")).select("document_id", "page_number", "c.*")
    return pages.best_candidates(offered).select("document_id", "page_number", "backend", "score")


_LAYERS = f"SELECT page_id, CASE WHEN source_tier LIKE 'tier0%' THEN text ELSE substr(text, 1, 20) END AS text, CASE WHEN source_tier LIKE 'tier1%' THEN text END AS ocr, least(1.0, confidence) AS conf, source_tier FROM ({_FOLDED})"


@query(_page_type_sql(f"""SELECT page_id, text, CASE WHEN bad AND c < 0.5 AND 0.75 >= c THEN 0.75 ELSE c END AS confidence,
            CASE WHEN bad AND c < 0.5 AND 0.75 >= c THEN 'tier2a_llm_cleanup' WHEN takes THEN 'tier1_ocr_pdf' ELSE source_tier END AS final_tier, fault
        FROM (SELECT page_id, source_tier, fault, fault IS NOT NULL AS bad, takes, CASE WHEN takes THEN ocr ELSE text END AS text,
                CASE WHEN takes THEN conf WHEN fault IS NOT NULL AND ocr IS NULL THEN 0.0 ELSE score END AS c
            FROM (SELECT l.*, s.score, s.fault, coalesce(s.fault IS NOT NULL AND l.ocr IS NOT NULL AND o.score > s.score, false) AS takes
                FROM ({_LAYERS}) l JOIN ({_quality_sql(_LAYERS, 'page_id')}) s USING (page_id)
                JOIN ({_quality_sql(_LAYERS.replace("CASE WHEN source_tier LIKE 'tier0%' THEN text ELSE substr(text, 1, 20) END AS text, CASE WHEN source_tier LIKE 'tier1%' THEN text END AS ocr", "CASE WHEN source_tier LIKE 'tier1%' THEN text END AS text"), 'page_id')}) o USING (page_id)))""",
    "page_id, fault, final_tier, round(confidence, 6) AS final_confidence"))
def tier_escalation(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.folded_pages(spark, sf)
    layer = F.when(F.col("source_tier").like("tier0%"), F.col("text")).otherwise(F.substring("text", 1, 20))
    given = rows.select(
        "page_id", "document_id", "page_number", layer.alias("text"), "source_tier",
        F.when(F.col("source_tier").like("tier1%"), F.col("text")).alias("ocr_text"), F.least(F.lit(1.0), "confidence").alias("ocr_confidence"),
    )
    done = pages.escalated(given)
    return done.select(
        "page_id", F.col("fallback_trigger_reason").alias("fault"), F.col("source_tier").alias("final_tier"), F.round("confidence", 6).alias("final_confidence"), "page_type"
    )


# --- chunks and vectors ----------------------------------------------------------------------------------------------------

_CHUNKS = f"""(SELECT document_id, page_id, page_number, i AS chunk_index, (i - 1) * 1800 AS char_start, substr(body, (i - 1) * 1800 + 1, 2000) AS text,
        page_id || '_c' || lpad(i::VARCHAR, 4, '0') AS chunk_id
    FROM (SELECT *, unnest(range(1, CASE WHEN length(body) <= 2000 THEN 2 ELSE CAST(ceil((length(body) - 2000) / 1800.0) AS BIGINT) + 2 END)) AS i
        FROM (SELECT document_id, page_id, page_number, regexp_replace(text, {B.STRIP}, '', 'g') AS body FROM {B.PAGES_SQL}) WHERE length(body) > 0))"""


@query(f"""SELECT chunk_id, chunk_index, char_start, char_start + length(text) AS char_end, greatest(1, length(text) // 4) AS token_estimate FROM {_CHUNKS}""")
def chunk_spans(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunks(B.pages(spark, sf)).select("chunk_id", "chunk_index", "char_start", "char_end", "token_estimate")


@query(f"SELECT chunk_id, sha256(text) AS chunk_text_hash FROM {_CHUNKS}")
def chunk_hash_ids(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunks(B.pages(spark, sf)).select("chunk_id", "chunk_text_hash")


@query(f"""SELECT chunk_id FROM {_CHUNKS} c WHERE NOT EXISTS (SELECT 1 FROM vector_index v JOIN {B.PAGES_SQL} p ON v.chunk_id = p.page_id || '_c0001'
    WHERE v.embedding_version = 'v3' AND v.chunk_id = c.chunk_id AND p.hash_value = sha256(c.text))""")
def reembed_needed(spark: SparkSession, sf: str) -> DataFrame:
    own = B.pages(spark, sf)
    stored = table(spark, sf, "vector_index").join(own.select(F.concat("page_id", F.lit("_c0001")).alias("chunk_id"), F.col("hash_value").alias("chunk_text_hash")), "chunk_id")
    return chunking.to_embed(chunking.chunks(own), stored, "v3").select("chunk_id")


@query(f"""SELECT chunk_id, list_transform(range(0, 40), lambda i: round(('0x' || substr(sha256(text), CAST(2 * (i % 32) + 1 AS INT), 2))::INT / 255.0 * 2 - 1, 9)) AS vector FROM {_CHUNKS} WHERE chunk_index = 1""")
def hash_embedding(spark: SparkSession, sf: str) -> DataFrame:
    first = chunking.chunks(B.pages(spark, sf)).filter("chunk_index = 1")
    return first.select("chunk_id", F.transform(T.hash_embedding(F.col("text"), 40), lambda x: F.round(x, 9)).alias("vector"))


def _query_vector(spark: SparkSession, sf: str) -> list[float]:
    return table(spark, sf, "embeddings").filter("vec_id = 0").first().embedding  # one row


_DISTANCE = "1 - list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"


@query(f"""SELECT e.vec_id, round({_DISTANCE}, 6) AS distance FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q
    ORDER BY {_DISTANCE}, e.vec_id LIMIT 8""")
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = retrieval.nearest(table(spark, sf, "embeddings"), _query_vector(spark, sf), 8, "vec_id")
    return found.select("vec_id", F.round("distance", 6).alias("distance"))


@query(f"""SELECT e.vec_id, round({_DISTANCE}, 6) AS distance FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q
    WHERE e.label = 1 ORDER BY {_DISTANCE}, e.vec_id LIMIT 8""")
def vector_topk_scoped(spark: SparkSession, sf: str) -> DataFrame:
    own = table(spark, sf, "embeddings").filter("label = 1")
    return retrieval.nearest(own, _query_vector(spark, sf), 8, "vec_id").select("vec_id", F.round("distance", 6).alias("distance"))


@query(f"""SELECT chunk_id, running_tokens FROM (SELECT chunk_id, sum(token_estimate) OVER (ORDER BY d, chunk_id) AS running_tokens FROM (
        SELECT v.doc_id AS chunk_id, greatest(1, length(v.text) // 4) AS token_estimate, {_DISTANCE} AS d FROM documents v JOIN embeddings e ON e.vec_id = v.doc_id,
        (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE v.text IS NOT NULL ORDER BY d, v.doc_id LIMIT 24)) WHERE running_tokens <= 3000""")
def retrieve_budgeted(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").filter("text IS NOT NULL")
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), F.lit("all").alias("document_id"), T.token_estimate(F.col("text")).alias("token_estimate"))
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    return retrieval.retrieve(chunks, vectors, _query_vector(spark, sf), 24, 48, 3_000).select("chunk_id", "running_tokens")


@query(f"""SELECT document_id, md5(trim(string_agg(entry, chr(10) ORDER BY page_number, chunk_id), ' ')) AS context_md5, count(*) AS entries FROM (
        SELECT *, sum(length(entry)) OVER (PARTITION BY document_id ORDER BY page_number, chunk_id) AS running FROM (
            SELECT document_id, page_number, chunk_id, '[chunk_id:' || chunk_id || ' page:' || coalesce(page_number::VARCHAR, 'None') || ']' || chr(10)
                || regexp_replace(text, {B.STRIP}, '', 'g') || chr(10) AS entry FROM {_CHUNKS} WHERE regexp_replace(text, {B.STRIP}, '', 'g') <> ''))
    WHERE running <= 18000 GROUP BY document_id""")
def context_build(spark: SparkSession, sf: str) -> DataFrame:
    built = retrieval.contexts(chunking.chunks(B.pages(spark, sf)), "document_id", 18_000)
    return built.select("document_id", F.md5("context").alias("context_md5"), "entries")


# --- segments ----------------------------------------------------------------------------------------------------------------

_SIMILAR = f"""(SELECT document_id, page_number, page_type, CASE WHEN b IS NOT NULL THEN CASE WHEN len(list_distinct(list_concat(b, w))) = 0 THEN 1.0
            ELSE len(list_intersect(b, w)) / len(list_distinct(list_concat(b, w))) END END AS similarity
    FROM (SELECT *, lag(w) OVER (PARTITION BY document_id ORDER BY page_number) AS b FROM (SELECT document_id, page_number, page_type,
        list_distinct(list_transform(list_filter(string_split_regex(coalesce(text, ''), '[\\t-\\r ]+'), lambda x: regexp_full_match(x, '\\p{{L}}{{3,}}')), lambda x: lower(x))) AS w FROM {B.PAGES_SQL})))"""
_SEGMENTS = f"""(SELECT *, sum(CASE WHEN opens AND first THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY page_number) AS segment
    FROM (SELECT *, raw = 0 OR count(*) OVER (PARTITION BY document_id, raw) >= 3 AS opens, row_number() OVER (PARTITION BY document_id, raw ORDER BY page_number) = 1 AS first
        FROM (SELECT *, sum(CASE WHEN similarity < 0.35 THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY page_number) AS raw FROM {_SIMILAR})))"""


def _similar(spark: SparkSession, sf: str) -> DataFrame:
    return segmentation.adjacent_similarity(B.pages(spark, sf))


@query(f"SELECT document_id, page_number, round(similarity, 6) AS similarity FROM {_SIMILAR}")
def adjacent_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return _similar(spark, sf).select("document_id", "page_number", F.round("similarity", 6).alias("similarity"))


@query(f"SELECT document_id, page_number, segment FROM {_SEGMENTS}")
def segments_merged(spark: SparkSession, sf: str) -> DataFrame:
    return segmentation.segments(_similar(spark, sf)).select("document_id", "page_number", "segment")


@query(f"""SELECT document_id, segment, min(page_number) OVER w AS first_page, max(page_number) OVER w AS last_page, kind AS dominant_type FROM (
        SELECT document_id, segment, page_number, coalesce(page_type, 'text') AS kind, count(*) OVER (PARTITION BY document_id, segment, coalesce(page_type, 'text')) AS n FROM {_SEGMENTS})
    WINDOW w AS (PARTITION BY document_id, segment) QUALIFY row_number() OVER (PARTITION BY document_id, segment ORDER BY n DESC, kind, page_number) = 1""")
def segment_dominant_type(spark: SparkSession, sf: str) -> DataFrame:
    found = segmentation.segment_index(segmentation.segments(_similar(spark, sf)))
    return found.select("document_id", "segment", "first_page", "last_page", "dominant_type")


@query(f"""SELECT d.document_id, coalesce(p.n, 0) AS pages, CASE WHEN c.document_id IS NULL THEN 'empty' WHEN coalesce(p.n, 0) >= 20 THEN 'segmented' ELSE 'flat' END AS route
    FROM (SELECT DISTINCT document_id FROM documents) d LEFT JOIN (SELECT document_id, count(DISTINCT page_number) AS n FROM page_results GROUP BY 1) p USING (document_id)
    LEFT JOIN (SELECT DISTINCT document_id FROM {_CHUNKS}) c USING (document_id)""")
def summary_route(spark: SparkSession, sf: str) -> DataFrame:
    own = B.pages(spark, sf)
    return segmentation.summary_route(table(spark, sf, "documents"), own, chunking.chunks(own))


@query("""SELECT card_id, concat_ws(' | ', nullif(trim(canonical_name), ''), 'Types: ' || coalesce(kind, 'unknown'),
        CASE WHEN len(aliases) > 0 THEN 'Entities: ' || array_to_string(aliases[1:5], ', ') END, 'Dates: ' || strftime(created_at, '%Y-%m-%d'),
        CASE WHEN mentions > 5 THEN 'Amounts: ' || mentions END) AS line FROM entity_cards""")
def toc_lines(spark: SparkSession, sf: str) -> DataFrame:
    nothing = F.array().cast("array<string>")
    summary = F.struct(
        F.col("canonical_name").alias("what_this_segment_contains"),
        F.array(F.coalesce("kind", F.lit("unknown"))).alias("likely_document_types"),
        F.coalesce("aliases", nothing).alias("key_entities"),
        F.array(F.date_format("created_at", "yyyy-MM-dd")).alias("key_dates"),
        F.when(F.col("mentions") > 5, F.array(F.col("mentions").cast("string"))).otherwise(nothing).alias("key_amounts"),
        nothing.alias("uncertainties"),
    )
    rows = table(spark, sf, "entity_cards").withColumn("summary", summary)
    return rows.select("card_id", segmentation.toc_line().alias("line"))


# --- entities and edges -----------------------------------------------------------------------------------------------------

_FOLDED_CHUNKS = f"(SELECT * EXCLUDE (text), {B.FOLD_SQL} AS text FROM {_CHUNKS})"


def _found_sql() -> str:
    blocks = []
    for number, (kind, pattern) in enumerate(entities.PATTERNS.items()):
        blocks.append(
            f"""SELECT document_id, page_number, chunk_id, text, {number} AS block, '{kind}' AS kind, i, vs[i] AS value,
                CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(vs[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
            FROM (SELECT *, unnest(range(1, len(vs) + 1)) AS i FROM (SELECT *, regexp_extract_all(text, '{pattern}', 1) AS vs, string_split_regex(text, '{pattern}') AS p FROM {_FOLDED_CHUNKS}))"""
        )
    union = " UNION ALL ".join(blocks)
    key = "'ent_' || substr(sha1(kind || ':' || trim(regexp_replace(lower(value), '[\\t-\\r ]+', ' ', 'g'))), 1, 12)"
    return f"(SELECT *, {key} AS entity_id, row_number() OVER (PARTITION BY chunk_id ORDER BY block, i) - 1 AS ordinal FROM ({union}) WHERE kind <> 'name' OR length(value) >= 3)"


_FOUND = _found_sql()


def _found(spark: SparkSession, sf: str) -> DataFrame:
    return entities.mentions(_folded_chunks(spark, sf))


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunks(B.pages(spark, sf)).withColumn("text", T.ascii_only(F.col("text"))).select("document_id", "page_number", "chunk_id", "text")


def _folded_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _folded(spark, sf)
    # pairs cost far more than the bytes by which adaptive execution merges small partitions
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


@query(f"SELECT chunk_id, ordinal, kind, value, start, entity_id FROM {_FOUND}")
def entities_regex(spark: SparkSession, sf: str) -> DataFrame:
    return _found(spark, sf).select("chunk_id", "ordinal", "kind", "value", "start", "entity_id")


def _excerpt_sql(start: str, end: str) -> str:
    return f"trim(regexp_replace(substr(text, greatest(0, {start} - 60) + 1, greatest(0, least(length(text), {end} + 60) - greatest(0, {start} - 60))), '[\\t-\\r ]+', ' ', 'g'))"


@query(f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY document_id DESC, page_number DESC, chunk_id DESC, ordinal DESC) AS back FROM {_FOUND})
    SELECT entity_id, kind, a.mentions, a.aliases, a.aliases[1] AS canonical_name, e.evidence_md5 FROM (
        SELECT entity_id, kind, CAST(sum(n) AS BIGINT) AS mentions, list(value ORDER BY spot) AS aliases FROM (
            SELECT entity_id, kind, value, count(*) AS n, min((document_id, page_number, chunk_id, ordinal)) AS spot FROM f GROUP BY ALL) GROUP BY ALL) a
    JOIN (SELECT entity_id, md5(string_agg({_excerpt_sql('start', 'start + length(value)')}, '|' ORDER BY document_id, page_number, chunk_id, ordinal)) AS evidence_md5
        FROM f WHERE back <= 20 GROUP BY entity_id) e USING (entity_id)""")
def entity_cards(spark: SparkSession, sf: str) -> DataFrame:
    made = entities.cards(_found(spark, sf))
    shown = F.array_join(F.transform("evidence", lambda x: x["excerpt"]), "|")
    return made.select("entity_id", "kind", "mentions", "aliases", "canonical_name", F.md5(shown).alias("evidence_md5"))


_PAIRS = f"""(SELECT a.chunk_id, a.document_id, a.page_number, a.entity_id AS s, b.entity_id AS o, a.text, a.start AS s0, b.start + length(b.value) AS e1,
        substr(sha1(a.entity_id || '|co_mentioned|' || b.entity_id || '|' || coalesce(a.document_id, 'None') || '|' || coalesce(a.page_number::VARCHAR, 'None') || '|None|None'), 1, 16) AS edge_id
    FROM u a JOIN u b ON a.chunk_id = b.chunk_id AND a.ordinal < b.ordinal)"""


@query(f"""WITH u AS MATERIALIZED (SELECT * FROM {_FOUND} QUALIFY row_number() OVER (PARTITION BY chunk_id, entity_id ORDER BY ordinal) = 1)
    SELECT DISTINCT edge_id, s AS subject_entity_id, o AS object_entity_id, document_id, page_number FROM {_PAIRS}""")
def co_mention_edges(spark: SparkSession, sf: str) -> DataFrame:
    return entities.page_edges(_folded(spark, sf)).drop("predicate")


@query(f"""WITH u AS MATERIALIZED (SELECT * FROM {_FOUND} QUALIFY row_number() OVER (PARTITION BY chunk_id, entity_id ORDER BY ordinal) = 1)
    SELECT chunk_id, edge_id, md5({_excerpt_sql('s0', 'e1')}) AS evidence_md5 FROM {_PAIRS}""")
def edge_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return entities.co_mentions(_folded_chunks(spark, sf)).select("chunk_id", "edge_id", F.md5("evidence_excerpt").alias("evidence_md5"))


_NAMED = """(SELECT r.*, coalesce(s.canonical_name, r.subject_entity_id) AS subject_name, coalesce(o.canonical_name, r.object_entity_id) AS object_name
    FROM (SELECT DISTINCT * FROM relationships) r LEFT JOIN entity_registry s ON s.entity_id = r.subject_entity_id LEFT JOIN entity_registry o ON o.entity_id = r.object_entity_id)"""


def _named(spark: SparkSession, sf: str) -> DataFrame:
    return viewer.named_edges(B.edges(spark, sf), table(spark, sf, "entity_registry"))


@query(f"SELECT edge_id, subject_name, predicate, object_name FROM {_NAMED}")
def edge_names(spark: SparkSession, sf: str) -> DataFrame:
    return _named(spark, sf).select("edge_id", "subject_name", "predicate", "object_name")


@query(f"""SELECT edge_id, subject_name, object_name FROM {_NAMED} WHERE predicate = 'works_for'
    AND contains(lower(concat_ws(' ', subject_name, predicate, object_name, evidence_excerpt)), 'harbour') ORDER BY edge_id LIMIT 75""")
def rel_filter_page(spark: SparkSession, sf: str) -> DataFrame:
    found = viewer.search_edges(_named(spark, sf), "works_for", "Harbour")
    return viewer.page_of(found, ["edge_id"], 0).select("edge_id", "subject_name", "object_name")


@query(f"""SELECT document_id, edges, predicates, entities FROM (SELECT document_id, count(*) AS edges, count(DISTINCT predicate) AS predicates FROM {_NAMED} GROUP BY 1)
    JOIN (SELECT document_id, count(DISTINCT name) AS entities FROM (SELECT document_id, subject_name AS name FROM {_NAMED} UNION SELECT document_id, object_name FROM {_NAMED}) GROUP BY 1) USING (document_id)""")
def rel_stats(spark: SparkSession, sf: str) -> DataFrame:
    return viewer.edge_statistics(_named(spark, sf))


@query("""SELECT kind, canonical_name, list_sort(list(DISTINCT name)) AS aliases, count(DISTINCT document_id) AS documents, count(*) AS mention_count,
        'ent_' || substr(sha1(kind || ':' || canonical_name), 1, 12) AS entity_id
    FROM (SELECT document_id, coalesce(kind, 'unknown') AS kind, canonical_name AS name, trim(regexp_replace(lower(canonical_name), '[\\t-\\r ]+', ' ', 'g')) AS canonical_name FROM entity_cards WHERE trim(canonical_name) <> '')
    GROUP BY kind, canonical_name""")
def name_registry(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "entity_cards").select("document_id", F.coalesce("kind", F.lit("unknown")).alias("kind"), F.col("canonical_name").alias("name"))
    made = entities.name_registry(names)
    return made.select("kind", "canonical_name", "aliases", "documents", "mention_count", "entity_id")


@query("SELECT DISTINCT entity, document_id FROM (SELECT document_id, unnest(aliases) AS entity FROM entity_cards)")
def key_entity_index(spark: SparkSession, sf: str) -> DataFrame:
    return viewer.key_entity_index(table(spark, sf, "entity_cards").select("document_id", F.col("aliases").alias("key_entities")))


# --- payments ---------------------------------------------------------------------------------------------------------------------

_PAY = "trim(regexp_extract(text, '{}', 1))"
_AMOUNT = "TRY_CAST(nullif(regexp_replace({}, '[$€£,\\s]', '', 'g'), '') AS DOUBLE)"
_GROSS, _NET, _TOTAL = (_PAY.format(p) for p in (P.GROSS, P.NET, P.TOTAL))
_KIND = """CASE WHEN contains(lower(text), 'pay period') OR contains(lower(text), 'gross pay') OR contains(lower(text), 'net pay') THEN 'pay_stub' WHEN contains(lower(text), 'receipt') THEN 'receipt'
    WHEN contains(lower(text), 'invoice') THEN 'invoice' WHEN contains(lower(text), 'payment') OR contains(lower(text), 'amount due') THEN 'payment_sheet' ELSE 'payment_record' END"""
_ITEM_LINES = f"list_filter(string_split_regex(text, '\\r\\n|[\\n\\r]'), lambda x: regexp_matches(x, '{P.ITEM}'))"


@query(f"SELECT document_id, {_KIND} AS document_type FROM {B.INVOICES_SQL}")
def payment_type(spark: SparkSession, sf: str) -> DataFrame:
    return B.invoices(spark, sf).select("document_id", P.payment_type(F.col("text")).alias("document_type"))


@query(f"""SELECT document_id, nullif({_PAY.format(P.PERIOD)}, '') AS pay_period, nullif({_PAY.format(P.DATE)}, '') AS pay_date, {_AMOUNT.format(_GROSS)} AS gross_pay,
    {_AMOUNT.format(_NET)} AS net_pay, {_AMOUNT.format(_TOTAL)} AS total FROM {B.INVOICES_SQL}""")
def payment_fields(spark: SparkSession, sf: str) -> DataFrame:
    return payments.extracted(B.invoices(spark, sf), "document_id", "text").select("document_id", "pay_period", "pay_date", "gross_pay", "net_pay", "total")


@query(f"""SELECT document_id, trim(regexp_extract(line, '{P.ITEM}', 1)) AS description, {_AMOUNT.format(f"regexp_extract(line, '{P.ITEM}', 2)")} AS amount,
    CASE substr(trim(regexp_extract(line, '{P.ITEM}', 2)), 1, 1) WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' ELSE 'USD' END AS currency
    FROM (SELECT document_id, unnest({_ITEM_LINES}) AS line FROM {B.INVOICES_SQL})""")
def payment_items(spark: SparkSession, sf: str) -> DataFrame:
    items = B.invoices(spark, sf).select("document_id", F.explode(P.line_items(F.col("text"))).alias("i"))
    return items.select("document_id", "i.*")


@query(f"""SELECT document_id, nullif(concat_ws(',', CASE WHEN coalesce(g, n, t) IS NULL AND items = 0 THEN 'no_detectable_payment_amounts' END,
        CASE WHEN n > g THEN 'net_pay_exceeds_gross_pay' END), '') AS notes FROM (SELECT document_id, {_AMOUNT.format(_GROSS)} AS g, {_AMOUNT.format(_NET)} AS n,
        {_AMOUNT.format(_TOTAL)} AS t, len({_ITEM_LINES}) AS items FROM {B.INVOICES_SQL})""")
def payment_validate(spark: SparkSession, sf: str) -> DataFrame:
    return payments.extracted(B.invoices(spark, sf), "document_id", "text").select("document_id", "notes")


# --- catalogue -------------------------------------------------------------------------------------------------------------------

_GENERIC = "(" + ", ".join(f"'{w}'" for w in catalogue.GENERIC) + ")"
_SHORT = """CASE WHEN length(s) <= 240 THEN s ELSE regexp_replace(rtrim(substr(s, 1, 239)), ' [^ ]*$', '') || '…' END"""
_RAW_SUMMARY = """CASE doc_id % 4 WHEN 0 THEN '{"purpose": "Schedule ' || doc_id || ' of ' || coalesce(lang, 'none') || '. More.", "document_type_or_mix": "Pay_Stub"}'
    WHEN 1 THEN '{"overall_purpose": "Overview. Rest", "document_types_present": ["a", "b"]}' || chr(10) || '---' || chr(10) || 'Sections' ELSE coalesce(t, '') END"""
_SIGNALS = f"""(SELECT *, list_filter(nouns, lambda x, i: NOT list_contains(list_transform(nouns[1:i - 1], lambda y: lower(y)), lower(x)))[1:8] AS proper_nouns FROM (
    SELECT *, list_filter(regexp_extract_all(short || ' ' || name, '{catalogue.NOUN}'), lambda x: x NOT IN {_GENERIC}) AS nouns FROM (
        SELECT document_id, doc_id, doc_family, string_split(path, '/')[-1] AS name, media_type, coalesce(nullif({_SHORT}, ''), 'No readable summary.') AS short,
            CASE doc_id % 4 WHEN 0 THEN 'pay_stub' WHEN 1 THEN 'mixed' ELSE coalesce(CASE WHEN lower(trim(doc_family)) <> 'other' THEN nullif(lower(trim(doc_family)), '') END, nullif(lower(trim(media_type)), ''), 'unknown') END AS hint
        FROM (SELECT *, CASE WHEN regexp_matches(c, '[.!?] ') THEN regexp_extract(c, '^(.*?[.!?]) ', 1) ELSE c END AS s FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'Schedule ' || doc_id || ' of ' || coalesce(lang, 'none') || '. More.'
            WHEN 1 THEN 'Overview. Rest' ELSE trim(regexp_replace(coalesce(t, ''), '[\\t-\\r ]+', ' ', 'g')) END AS c FROM (SELECT *, {B.FOLD_SQL} AS t FROM documents)))))) """
_LABELLED = f"""(SELECT *, CASE WHEN contains(lower(short), 'schedule') THEN 'workplace schedules' WHEN hint NOT IN ('unknown', 'mixed', '') THEN
        CASE hint WHEN 'comment_thread' THEN 'comment thread' WHEN 'handwritten_note' THEN 'handwritten note' ELSE replace(hint, '_', ' ') END || ' documents'
        WHEN doc_family NOT IN ('', 'other') THEN lower(doc_family) || ' documents' ELSE 'uncategorized documents' END AS label FROM {_SIGNALS})"""


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    text = F.coalesce(T.ascii_only(F.col("text")), F.lit(""))
    kinds = [
        F.concat(F.lit('{"purpose": "Schedule '), F.col("doc_id").cast("string"), F.lit(" of "), F.coalesce("lang", F.lit("none")), F.lit('. More.", "document_type_or_mix": "Pay_Stub"}')),
        F.lit('{"overall_purpose": "Overview. Rest", "document_types_present": ["a", "b"]}\n---\nSections'),
        text,
        text,
    ]
    name = F.element_at(F.split("path", "/"), -1)
    return docs.withColumns({"name": name, "summary_text": F.element_at(F.array(*kinds), (F.col("doc_id") % 4 + 1).cast("int"))})


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.signals(_summaries(spark, sf))


@query(f"""SELECT document_id, j IS NOT NULL AS is_object, json_extract_string(j, '$.purpose') AS purpose FROM (SELECT document_id, CASE WHEN json_valid(x) AND x LIKE '{{%' THEN x
        WHEN json_valid(string_split(x, chr(10) || '---' || chr(10))[1]) AND x LIKE '{{%' THEN string_split(x, chr(10) || '---' || chr(10))[1] END AS j
    FROM (SELECT document_id, trim({_RAW_SUMMARY}) AS x FROM (SELECT *, {B.FOLD_SQL} AS t FROM documents)))""")
def summary_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = catalogue.summary_object(F.col("summary_text"))
    return _summaries(spark, sf).select("document_id", parsed.isNotNull().alias("is_object"), F.get_json_object(parsed, "$.purpose").alias("purpose"))


@query(f"SELECT document_id, short AS short_summary, hint AS document_type_hint FROM {_SIGNALS}")
def short_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _signals(spark, sf).select("document_id", "short_summary", "document_type_hint")


@query(f"SELECT document_id, proper_nouns FROM {_SIGNALS}")
def proper_nouns(spark: SparkSession, sf: str) -> DataFrame:
    return _signals(spark, sf).select("document_id", "proper_nouns")


@query(f"SELECT label, count(DISTINCT document_id) AS document_count FROM {_LABELLED} GROUP BY label")
def heuristic_groups(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.groups(catalogue.heuristic_label(_signals(spark, sf)))


@query(f"SELECT label, proper_nouns[1] AS subgroup, count(DISTINCT document_id) AS document_count FROM {_LABELLED} WHERE len(proper_nouns) > 0 GROUP BY 1, 2 HAVING count(DISTINCT document_id) >= 2")
def subgroups(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.subgroups(catalogue.heuristic_label(_signals(spark, sf)))


@query("""SELECT label, list_sort(list(DISTINCT g)) AS source_group_ids FROM (SELECT coalesce(nullif(rtrim(substr(lower(trim(regexp_replace(source, '[\\t-\\r ]+', ' ', 'g'))), 1, 80)), ''), 'uncategorized documents') AS label,
    'b' || (doc_id % 5) || '_g' || (doc_id % 7) AS g FROM documents) GROUP BY label""")
def default_merge(spark: SparkSession, sf: str) -> DataFrame:
    group = F.concat(F.lit("b"), (F.col("doc_id") % 5).cast("string"), F.lit("_g"), (F.col("doc_id") % 7).cast("string"))
    return catalogue.default_merge(table(spark, sf, "documents").select(F.col("source").alias("label"), group.alias("source_group_id")))


@query("SELECT document_id FROM documents WHERE document_id NOT IN (SELECT document_id FROM page_results WHERE document_id IS NOT NULL)")
def unassigned_docs(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.unassigned(table(spark, sf, "documents"), table(spark, sf, "page_results"))


@query("""SELECT d.document_id, CASE WHEN p.document_id IS NULL THEN 'uncategorized documents' ELSE p.kind END AS label, CASE WHEN p.document_id IS NULL THEN 'fallback' ELSE 'model' END AS source
    FROM documents d LEFT JOIN (SELECT document_id, coalesce(page_type, 'text') AS kind FROM page_results QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY page_number, page_id) = 1) p USING (document_id)""")
def group_assignment(spark: SparkSession, sf: str) -> DataFrame:
    docs = catalogue.batches(table(spark, sf, "documents").select("document_id"))
    answers = table(spark, sf, "page_results").join(docs, "document_id").select(
        "batch", F.col("page_number").alias("group_index"), F.coalesce("page_type", F.lit("text")).alias("label"), F.col("page_id").alias("member_index"), "document_id"
    )
    return catalogue.assigned(docs, answers)


# --- observability, store, viewer -----------------------------------------------------------------------------------------------

_CALL_MEASURES = "count(*) AS calls, round(sum(duration_ms), 4) AS total_ms, round(avg(duration_ms), 6) AS avg_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms"


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"total_ms": F.round("total_ms", 4), "avg_ms": F.round("avg_ms", 6), "p95_ms": F.round("p95_ms", 6)})


@query(f"""SELECT *, round(100.0 * cache_hits / calls, 6) AS cache_hit_rate, round(100.0 * successes / calls, 6) AS success_rate FROM (
        SELECT stage, step, call_type, location, {_CALL_MEASURES}, count(*) FILTER (cache_hit) AS cache_hits, count(*) FILTER (success) AS successes
        FROM {B.CALLS_SQL} GROUP BY ALL ORDER BY sum(duration_ms) DESC LIMIT 20)""")
def cost_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rounded(telemetry.hotspots(B.calls(spark, sf), 20))
    return rows.withColumns({"cache_hit_rate": F.round("cache_hit_rate", 6), "success_rate": F.round("success_rate", 6)})


@query(f"SELECT stage, {_CALL_MEASURES} FROM {B.CALLS_SQL} GROUP BY stage")
def cost_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(telemetry.by_stage(B.calls(spark, sf)))


@query("""SELECT unnest(['documents', 'ocr_done', 'embed_done', 'entities_done', 'pages', 'relationships', 'vectors']) AS item, unnest([(SELECT count(*) FROM documents),
    (SELECT count(*) FROM documents WHERE status_ocr = 'done'), (SELECT count(*) FROM documents WHERE status_embed = 'done'), (SELECT count(*) FROM documents WHERE status_entities = 'done'),
    (SELECT count(*) FROM page_results), (SELECT count(*) FROM relationships), (SELECT count(*) FROM vector_index)]) AS n""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    names = {"documents": "documents", "pages": "page_results", "relationships": "relationships", "vectors": "vector_index"}
    return telemetry.status({k: table(spark, sf, v) for k, v in names.items()})


@query("SELECT source_tier, count(*) AS pages FROM page_results GROUP BY source_tier")
def tier_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.tier_histogram(table(spark, sf, "page_results"))


@query("SELECT document_id, round(avg(confidence), 6) AS mean_confidence FROM page_results GROUP BY document_id")
def confidence_means(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.confidence_means(table(spark, sf, "page_results")).withColumn("mean_confidence", F.round("mean_confidence", 6))


@query("""SELECT DISTINCT substr(sha1(coalesce(document_id, '') || '|' || coalesce(page_number::VARCHAR, '') || '|' || fallback_trigger_reason || '|' || coalesce(hash_value, '')), 1, 16) AS event_id
    FROM page_results WHERE fallback_trigger_reason IS NOT NULL""")
def fallback_events(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.fallback_events(table(spark, sf, "page_results")).select("event_id")


@query("""SELECT chunk_id, embedding_version FROM vector_index WHERE embedding_version = 'v2' AND chunk_id NOT IN (SELECT chunk_id FROM vector_index WHERE embedding_version = 'v3')
    UNION SELECT chunk_id, embedding_version FROM vector_index WHERE embedding_version = 'v3'""")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "vector_index")
    old, new = rows.filter("embedding_version = 'v2'"), rows.filter("embedding_version = 'v3'")
    done = store.upsert(store.latest(old, ["chunk_id"], ["updated_at"]), new, ["chunk_id"], "updated_at")
    return done.select("chunk_id", "embedding_version")


@query("SELECT edge_id, predicate FROM (SELECT DISTINCT edge_id, predicate FROM relationships WHERE predicate <> 'paid' OR predicate IS NULL)")
def selective_delete(spark: SparkSession, sf: str) -> DataFrame:
    return store.without(B.edges(spark, sf), "predicate", ["paid"]).select("edge_id", "predicate").distinct()


@query("""SELECT d.document_id, s.stage, CASE WHEN s.stage = 'ocr' AND p.document_id IS NOT NULL OR s.stage = 'embed' AND v.document_id IS NOT NULL THEN 'done' ELSE 'pending' END AS status
    FROM documents d CROSS JOIN (VALUES ('ocr'), ('embed')) s(stage) LEFT JOIN (SELECT DISTINCT document_id FROM page_results) p ON p.document_id = d.document_id
    LEFT JOIN (SELECT DISTINCT document_id FROM vector_index) v ON v.document_id = d.document_id""")
def derived_status(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("document_id")
    return store.derived_status(docs, {"ocr": table(spark, sf, "page_results"), "embed": table(spark, sf, "vector_index")})


@query("SELECT document_id, string_split(path, '/')[-1] AS name FROM documents WHERE contains(lower(string_split(path, '/')[-1]), 'requirement')")
def doc_search(spark: SparkSession, sf: str) -> DataFrame:
    return viewer.search_documents(table(spark, sf, "documents"), "Requirement").select("document_id", "name")


@query("SELECT entity_id, kind, canonical_name FROM entity_registry ORDER BY mention_count DESC, canonical_name LIMIT 75")
def registry_chips(spark: SparkSession, sf: str) -> DataFrame:
    registry = table(spark, sf, "entity_registry")
    return viewer.page_of(registry, [F.desc("mention_count"), "canonical_name"], 0).select("entity_id", "kind", "canonical_name")


_EDGE_HASH = "substr(sha1(subject_entity_id || '|' || predicate || '|' || object_entity_id || '|' || document_id || '|' || coalesce(page_number::VARCHAR, 'None') || '|' || coalesce(timestamp_start_ms::VARCHAR, 'None') || '|' || coalesce(timestamp_end_ms::VARCHAR, 'None')), 1, 16)"


@query(f"SELECT DISTINCT {_EDGE_HASH} AS made_id FROM relationships WHERE predicate <> 'paid'")
def edge_insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    from leafmill.functions.ids import edge_id

    rows = B.edges(spark, sf).filter("predicate <> 'paid'")
    parts = ("subject_entity_id", "predicate", "object_entity_id", "document_id", "page_number", "timestamp_start_ms", "timestamp_end_ms")
    made = rows.select(edge_id(*(F.col(p) for p in parts)).alias("made_id"))
    first = made.filter(F.col("made_id") < "8").dropDuplicates(["made_id"])
    return store.insert_absent(first, made, ["made_id"])


@query("SELECT entity_id AS stored_id, 'ent_' || substr(sha1(kind || ':' || lower(trim(canonical_name))), 1, 12) AS made_id FROM entity_registry")
def entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "entity_registry").select(F.col("entity_id").alias("stored_id"), entity_id(F.col("kind"), F.col("canonical_name")).alias("made_id"))
