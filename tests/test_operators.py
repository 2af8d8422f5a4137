
import re

import pytest
from pyspark.sql import functions as F

from leafmill.operators import catalogue, chunking, entities, models, pages, payments, retrieval, segmentation, store, telemetry, viewer
from leafmill.plans import reference
from leafmill.sources import exports, files
from leafmill.streaming.ingest import available_now
from tests.conftest import rows

PAGE = "document_id string, page_id string, page_number int, page_type string, text string, _first int"


def python_chunks(text):
    text, out, start = text.strip(), [], 0
    while text:
        end = min(len(text), start + 2000)
        out.append((start, end))
        if end == len(text):
            break
        start = end - 200
    return out


@pytest.mark.parametrize("size", [0, 1, 1999, 2000, 2001, 3800, 3801, 5600])
def test_chunks_cover_the_stripped_text(spark, size):
    text = " \n" + "x" * size + "  "
    frame = spark.createDataFrame([("d", "d_p0001", 1, None, text, 0), ("d", "d_p0002", 2, None, None, 0), (None, None, None, None, "z", 0)], PAGE)
    got = [(r.char_start, r.char_end) for r in chunking.chunks(frame).orderBy("chunk_index").collect()]
    assert got == python_chunks(text)


def test_only_changed_chunks_are_embedded_again(spark):
    frame = spark.createDataFrame([("d", "p1", 1, None, "same", 0), ("d", "p2", 2, None, "new text", 0)], PAGE)
    current = chunking.chunks(frame)
    stored = current.filter("page_id = 'p1'").select("chunk_id", "chunk_text_hash", F.lit("v3").alias("embedding_version"))
    assert rows(chunking.to_embed(current, stored, "v3").select("page_id")) == [("p2",)]
    assert chunking.to_embed(current, stored, "v4").count() == 2
    assert chunking.embedded_offline(current, 8, "v3").first().embedding[0] != 0


def test_retrieval_stops_before_the_chunk_that_exceeds_the_budget(spark):
    ranked = spark.createDataFrame([(1, 5), (2, 5), (3, 1), (4, 0)], "r int, tokens int")
    assert rows(retrieval.within_budget(ranked, "tokens", 10, "r").select("r")) == [(1,), (2,)]
    assert rows(retrieval.within_budget(ranked, "tokens", 4, "r")) == []
    with pytest.raises(ValueError):
        retrieval.retrieve(ranked, ranked, [1.0], 5, 4, 10)


def test_nearest_breaks_ties_by_key_and_skips_vectors_without_direction(spark):
    frame = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("z", [0.0, 0.0]), ("n", None), ("c", [0.0, 1.0])], "chunk_id string, embedding array<double>")
    assert [r.chunk_id for r in retrieval.nearest(frame, [1.0, 0.0], 3).collect()] == ["a", "b", "c"]


def test_context_leaves_out_blank_chunks_and_stops_at_the_limit(spark):
    frame = spark.createDataFrame([("d", 1, "c1", "one"), ("d", 1, "c2", "  "), ("d", None, "c3", "three"), ("d", 2, "c4", "x" * 100)], "document_id string, page_number int, chunk_id string, text string")
    got = retrieval.contexts(frame, "document_id", 60).first()
    assert got.entries == 2 and "[chunk_id:c3 page:None]\nthree" in got.context and "c4" not in got.context


def merged_segments(sizes):
    """Page lists of raw segments, short ones joined to the one before, the first always kept."""
    out = []
    for size in sizes:
        if out and size < 3:
            out[-1] += size
        else:
            out.append(size)
    return out


@pytest.mark.parametrize("sizes", [[1], [2, 1], [1, 2, 3], [3, 1, 1, 4], [4, 2, 2, 3, 1]])
def test_segments_follow_drops_and_join_short_ones(spark, sizes):
    data, number = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            number += 1
            data.append(("d", f"p{number}", number, "table" if s % 2 else None, " ".join(f"{w}{'abcdefgh'[s]}x" for w in ("alpha", "beta", "gamma")), 0))
    frame = spark.createDataFrame(data, PAGE)
    made = segmentation.segments(segmentation.adjacent_similarity(frame))
    got = [r.n for r in made.groupBy("segment").agg(F.count("*").alias("n")).orderBy("segment").collect()]
    assert got == merged_segments(sizes)
    assert segmentation.segment_index(made).agg(F.sum("pages")).first()[0] == sum(sizes)


def test_summary_route(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "document_id string")
    p = spark.createDataFrame([("a", i) for i in range(20)] + [("b", 1), ("b", 1)], "document_id string, page_number int")
    chunks = spark.createDataFrame([("a",), ("b",)], "document_id string")
    assert rows(segmentation.summary_route(docs, p, chunks)) == [("a", 20, "segmented"), ("b", 1, "flat"), ("c", 0, "empty")]


def test_mentions_cards_and_edges(spark):
    text = "Anna Berg met Carl on 2024-05-01. Write to anna@x.org or Anna Berg."
    frame = spark.createDataFrame([("d", 1, "c1", text), ("d", 1, "c2", "Carl"), ("d", 1, "c3", ""), ("d", 1, "c4", None)], "document_id string, page_number int, chunk_id string, text string")
    found = entities.mentions(frame)
    got = [(r.kind, r.value, r.start) for r in found.filter("chunk_id = 'c1'").orderBy("ordinal").collect()]
    assert got == [("name", "Anna Berg", 0), ("name", "Carl", 14), ("name", "Write", 34), ("name", "Anna Berg", 57), ("email", "anna@x.org", 43), ("date", "2024-05-01", 22)]
    for kind, value, start in got:
        assert text[start : start + len(value)] == value
    cards = {r.canonical_name: r for r in entities.cards(found).collect()}
    assert cards["Anna Berg"].mentions == 2 and cards["Carl"].mentions == 2 and len(cards["Carl"].evidence) == 2
    edges = entities.co_mentions(frame)
    assert edges.filter("chunk_id = 'c1'").count() == 10  # five different entities
    assert entities.distinct_edges(edges.unionByName(edges)).count() == 10
    stored = entities.distinct_edges(edges).limit(4)
    assert entities.new_edges(edges, stored).count() == 6


def test_edges_of_pages_are_those_of_their_chunks(spark):
    text = "Anna Berg met Carl on 2024-05-01. Al wrote to anna@x.org and Carl to Dora."
    other = "Carl told Anna  Berg of 2024-05-01. Dora met Carl, Anna Berg and anna@x.org."
    data = [("d", 1, "c1", text), ("d", 1, "c2", other), ("d", 1, "c3", text), ("d", 2, "c4", text), ("d", None, "c5", other), ("d", 3, "c6", "Carl"), ("d", 3, "c7", ""), ("d", 3, "c8", None)]
    frame = spark.createDataFrame(data + [(None, None, "c9", text), (None, None, "c10", other)], "document_id string, page_number int, chunk_id string, text string")
    made = entities.page_edges(frame)
    assert made.count() == made.distinct().count() > 0
    assert rows(made) == rows(entities.co_mentions(frame).select(made.columns).distinct())


def test_edges_stay_on_their_page(spark, tmp_path):
    text = "Anna Berg met Carl and Dora.  "  # 30 characters, so that a chunk begins with a name
    data = [("a", "d", 1, text * 100, 1), ("a", "d", 1, "Emil met Frieda.", 2), ("b", None, None, text, 1), ("c", "None", None, text, 1), ("e", "d", 1, "Dora met Carl.", 1), ("f", "d", 2, None, 1), ("g", "d", 2, " ", 1)]
    spark.createDataFrame(data, "page_id string, document_id string, page_number int, text string, created_at int").write.parquet(f"{tmp_path}/page_results.parquet")
    made = reference.QUERIES["co_mention_edges"](spark, str(tmp_path))
    # a missing document and one that is called None have the same edge ids, as in the SQL, and stay apart
    got = made.groupBy("document_id", "page_number").count()
    assert rows(got) == sorted([("d", 1, 4), ("None", None, 3), (None, None, 3)], key=repr)
    keys = re.findall(r"Exchange \w+\(([^)]*)\)", made._jdf.queryExecution().executedPlan().toString())
    assert {re.sub(r"#\d+L?|, \d+$", "", k) for k in keys} == {"page_id", "document_id, page_number"}  # no edge is shuffled


def test_model_edges_drop_unknown_and_self_edges(spark):
    frame = spark.createDataFrame([("d", 1, "c1", "Anna Berg met Carl.")], "document_id string, page_number int, chunk_id string, text string")
    found = entities.mentions(frame)
    relations = spark.createDataFrame(
        [("c1", "anna berg", None, "CARL", "", "abc"), ("c1", "anna berg", "knows", "nobody", "", "1"), ("c1", "carl", "is", "Carl", "", None), ("c1", "Carl", "knows", "Anna Berg", " x ", "1.7")],
        "chunk_id string, subject_value string, predicate string, object_value string, evidence_excerpt string, confidence string",
    )
    assert sorted((r.predicate, r.confidence, r.evidence_excerpt) for r in entities.model_edges(relations, found).collect()) == [("knows", 1.0, "x"), ("related_to", 0.5, "")]


def test_name_registry_joins_case_and_space(spark):
    names = spark.createDataFrame([("d1", "person", "John  Smith"), ("d2", "person", "john smith"), ("d1", "organization", "John Smith"), ("d3", "person", " ")], "document_id string, kind string, name string")
    got = {(r.kind, r.canonical_name): r for r in entities.name_registry(names).collect()}
    assert got["person", "john smith"].mention_count == 2 and got["person", "john smith"].documents == 2
    assert got["person", "john smith"].entity_id != got["organization", "john smith"].entity_id


def test_payment_records(spark):
    texts = spark.createDataFrame([("a", "Pay period: May\nGross pay: $100.00\nNet pay: $120.00"), ("b", "nothing"), ("c", "Receipt\nTotal: €12.00"), ("e", None)], "id string, text string")
    got = {r.id: r for r in payments.extracted(texts, "id", "text").collect()}
    assert got["a"].notes == "net_pay_exceeds_gross_pay" and got["a"].pay_period == "May" and got["b"].notes == "no_detectable_payment_amounts"
    assert got["c"].total == 12.0 and got["c"].currency == "EUR" and got["c"].notes is None
    kind = "document_type string, pay_period string, pay_date string, gross_pay string, net_pay string, currency string, items array<struct<description:string,amount:double,currency:string>>, notes string"
    given = spark.createDataFrame([(None, " ", None, "10", "abc", "usd", [(" ", None, None), ("", 2.0, "eur")], "look"), ("Receipt", None, None, None, None, None, None, None)], kind)
    a, b = payments.normalised(given).collect()
    assert (a.document_type, a.currency, a.net_pay, a.notes) == ("payment_record", "USD", None, "invalid_numeric_pay_fields,look")
    assert [(i.description, i.amount, i.currency) for i in a.items] == [("item", 2.0, "EUR")]
    assert b.notes == "no_detectable_payment_amounts" and b.items == []


def test_catalogue_groups_every_document_once(spark):
    kind = "document_id string, name string, doc_family string, media_type string, summary_text string"
    docs = spark.createDataFrame(
        [
            ("1", "a.txt", "text", "text/plain", '{"purpose": "Shift schedule for Halden Depot. More.", "document_type_or_mix": "schedule"}'),
            ("2", "b.txt", "text", "text/plain", '{"purpose": "Weekly schedule for Halden Depot.", "document_type_or_mix": "schedule"}\n---\nrest'),
            ("3", "c.txt", "text", "text/plain", '{"purpose": "Money owed by Halden Depot", "document_type_or_mix": "Invoice"}'),
            ("4", "d.txt", "other", "", "[1, 2]"), ("5", "e.txt", "text", None, None),
        ], kind)
    labelled = catalogue.heuristic_label(catalogue.signals(docs))
    assert rows(labelled.select("document_id", "label"))[:3] == [("1", "workplace schedules"), ("2", "workplace schedules"), ("3", "invoice documents")]
    assert labelled.count() == 5
    first = catalogue.groups(labelled).first()
    assert (first.label, first.document_count) == ("workplace schedules", 2)
    answers = spark.createDataFrame([("x", 1, "A", 1, "1"), ("x", 2, "B", 1, "1"), ("x", 2, "B", 2, "unknown")], "batch string, group_index int, label string, member_index int, document_id string")
    batched = docs.select("document_id", F.lit("x").alias("batch"))
    got = rows(catalogue.assigned(batched, answers))
    assert got[0] == ("1", "a", "model") and len(got) == 5 and {s for _, _, s in got[1:]} == {"fallback"}
    assert catalogue.batches(docs.select("document_id"), 2).groupBy("batch").count().agg(F.max("count")).first()[0] <= 2
    groups = spark.createDataFrame([("b1_g1", "X "), ("b1_g2", "x"), ("b1_g3", "")], "source_group_id string, label string")
    merged = catalogue.default_merge(groups)
    assert rows(merged.select("label", F.size("source_group_ids"))) == [("uncategorized documents", 1), ("x", 2)]
    assert catalogue.merge_is_whole(merged, groups) and not catalogue.merge_is_whole(merged.limit(1), groups)


def test_candidates_and_escalation(spark):
    good = "The committee met in March and heard the report of the harbour office about the storage."
    offered = spark.createDataFrame([("d", 1, 0, "a", good), ("d", 1, 1, "b", good), ("d", 2, 0, "a", ""), ("d", 3, 0, "a", None), ("d", 3, 1, "b", "x" * 40)], "document_id string, page_number int, rank int, backend string, candidate string")
    assert rows(pages.best_candidates(offered).select("page_number", "backend")) == [(1, "a"), (3, "b")]
    kind = "document_id string, page_number int, text string, source_tier string, ocr_text string, ocr_confidence double"
    done = {r.page_number: r for r in pages.escalated(spark.createDataFrame([("d", 1, good, "t0", None, None), ("d", 2, "", "t0", good, 0.8), ("d", 3, "", "t0", None, None)], kind)).collect()}
    assert (done[1].source_tier, done[1].fallback_trigger_reason) == ("t0", None)
    assert (done[2].source_tier, done[2].confidence) == ("tier1_ocr_pdf", 0.8)
    assert (done[3].source_tier, done[3].confidence, done[3].needs_vision) == ("tier2a_llm_cleanup", 0.75, True)


def test_new_documents_by_content(spark):
    found = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", "c"), (None, "d")], "document_id string, path string")
    assert rows(pages.new_documents(found)) == [("x", "a"), ("y", "c")]
    assert rows(pages.new_documents(found, spark.createDataFrame([("x",)], "document_id string"))) == [("y", "c")]


def test_store(spark):
    table = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    changes = spark.createDataFrame([("b", 2), ("b", 3), ("c", 1)], "k string, v int")
    once = store.upsert(table, changes, ["k"], "v")
    assert rows(once) == [("a", 1), ("b", 3), ("c", 1)]
    assert rows(store.upsert(once, changes, ["k"], "v")) == rows(once)
    assert rows(store.insert_absent(table, changes, ["k"]).select("k")) == [("a",), ("b",), ("c",)]
    staged = spark.createDataFrame([("x",), ("y",), (None,)], "stage string")
    assert rows(store.without(staged, "stage", ["x"])) == [("y",), (None,)] or rows(store.without(staged, "stage", ["x"])) == [(None,), ("y",)]
    docs = spark.createDataFrame([("a",), ("b",)], "document_id string")
    assert rows(store.derived_status(docs, {"ocr": docs.limit(0)})) == [("a", "ocr", "pending"), ("b", "ocr", "pending")]


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b"), (1, "a")], "z int, a string")
    store.append_json(frame, str(tmp_path / "j"))
    store.append_json(frame, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4


def test_viewer(spark):
    edges = spark.createDataFrame([("e1", "s", "p", "o", "d", "the Harbour"), ("e2", "s", "q", "x", "d", None)], "edge_id string, subject_entity_id string, predicate string, object_entity_id string, document_id string, evidence_excerpt string")
    names = spark.createDataFrame([("s", "Sun"), ("o", "Orb")], "entity_id string, canonical_name string")
    named = viewer.named_edges(edges, names)
    assert rows(named.select("subject_name", "object_name")) == [("Sun", "Orb"), ("Sun", "x")]
    assert rows(viewer.search_edges(named, None, "HARBOUR").select("edge_id")) == [("e1",)] and viewer.search_edges(named, "q", "harbour").count() == 0
    assert rows(viewer.edge_statistics(named)) == [("d", 2, 2, 3)]
    groups = spark.createDataFrame([("g", ["1", "2", "3"], [(["1"],)])], "label string, document_ids array<string>, subgroups array<struct<document_ids:array<string>>>")
    assert viewer.ungrouped(groups).first().document_ids == ["2", "3"] and viewer.groups_with(groups, ["9"]).first().matches is False


def test_telemetry(spark):
    calls = spark.createDataFrame([("a", "s", "t", "l", 1.0, True, None), ("a", "s", "t", "l", 3.0, None, True), ("b", "s", "t", "l", 9.0, False, False)], "stage string, step string, call_type string, location string, duration_ms double, cache_hit boolean, success boolean")
    top = telemetry.hotspots(calls, 0)
    assert [(r.stage, r.calls) for r in top.collect()] == [("b", 1)]
    a = telemetry.hotspots(calls, 5, "a").first()
    assert (a.total_ms, a.p95_ms, a.cache_hit_rate, a.success_rate) == (4.0, pytest.approx(2.9), 50.0, 50.0)
    assert telemetry.by_stage(calls.limit(0)).count() == 0


def test_chat_and_media(spark):
    chat = spark.createDataFrame(
        [(1, 1, '{"timestamp": "t1", "sender": "Ann", "message": "hi"}'), (1, 2, '{"date": "t2", "from": "Bo", "text": "yo"}'), (1, 3, "no json"), (1, 4, '{"text": "who"}'), (2, 1, None)], "id int, o int, p string"
    )
    assert rows(exports.chat_lines(chat, "id", "o", "p")) == [(1, "[t1] Ann: hi\n[t2] Bo: yo\n[] unknown: who"), (2, "")]
    media = spark.createDataFrame([("a", "audio", 61.9, None), ("v", "video", None, 30.0), ("n", "audio", None, None), ("z", "audio", 0.0, None), ("p", "pdf", None, None)], "document_id string, doc_family string, audio_duration_seconds double, video_duration_seconds double")
    got = exports.media_segments(media)
    assert rows(got.filter("document_id = 'a'").select("start_ms", "end_ms")) == [(0, 30000), (30000, 60000), (60000, 61000)]
    assert rows(got.groupBy("document_id").count()) == [("a", 3), ("n", 1), ("v", 1), ("z", 1)]
    assert got.filter("document_id = 'v'").first().source_pointer == "timestamp:0-30000;keyframe_every_ms:15000"


def test_files(spark, tmp_path):
    (tmp_path / "raw" / "sub").mkdir(parents=True)
    (tmp_path / "raw" / "a.txt").write_bytes(b" hello \xff")
    (tmp_path / "raw" / "sub" / "b_chat.json").write_text("[]")
    (tmp_path / "raw" / "c.pdf").write_bytes(b"no pdf")
    found = files.raw_files(spark, str(tmp_path / "raw"))
    assert rows(found.select("doc_family")) == [("chat_export",), ("pdf",), ("text",)]
    assert files.plain_text_pages(found).first().text == "hello"
    assert files.pdf_pages(found).count() == 0
    assert files.json_artifacts(spark, str(tmp_path / "nothing" / "*.json"), "a string").count() == 0


def test_models_are_asked_only_what_the_cache_lacks(spark):
    class Loud:
        name = "loud"

        def answer(self, prompts):
            return [p.upper() for p in prompts]

    requests = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k2", "b")], "key string, prompt string")
    cache = spark.createDataFrame([("k1", "kept")], "key string, answer string")
    assert rows(models.answered(requests, cache, Loud)) == [("k1", "kept", True), ("k2", "B", False)]
    assert rows(models.answered(requests, None, models.Offline)) == [("k1", None, False), ("k2", None, False)]


def test_stream_takes_each_file_once(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    spark.createDataFrame([("a",)], "document_id string").write.parquet(source)
    work = lambda df, batch: df.write.mode("append").parquet(out)
    for expected in (1, 1):
        available_now(spark, source, "document_id string", state, work).awaitTermination()
        assert spark.read.parquet(out).count() == expected
    spark.createDataFrame([("b",)], "document_id string").write.mode("append").parquet(source)
    available_now(spark, source, "document_id string", state, work).awaitTermination()
    assert spark.read.parquet(out).count() == 2




def test_name_lists_keep_strings_of_lists_only(spark):
    answers = [("a", '{"persons": ["Ann", " ", null], "organizations": "Acme"}'), ("b", "no object"), ("c", None), ("d", '```json\n{"organizations": ["Acme "]}\n```')]
    assert rows(entities.name_lists(spark.createDataFrame(answers, "document_id string, answer string"))) == [("a", "person", "Ann"), ("d", "organization", "Acme")]


def test_sections_and_summaries_of_models_and_without(spark):
    index = spark.createDataFrame([("d", 1, 1, 3, 3, "table"), ("d", 2, 4, 9, 6, "text")], "document_id string, segment long, first_page int, last_page int, pages long, dominant_type string")
    readable = spark.createDataFrame([("d", 1)], "document_id string, segment long")
    given = spark.createDataFrame([("d", 1, "Totals."), ("d", 2, " ")], "document_id string, segment long, summary string")
    lines = segmentation.section_lines(index, readable, given)
    assert rows(lines.select("segment", "line")) == [(1, "Section 1 (pages 1–3, type: table): Totals."), (2, "Section 2 (pages 4–9, type: text): [Segment 2 of 2, pages 4–9: no readable content]")]
    routes = spark.createDataFrame([("d", "segmented"), ("e", "flat"), ("f", "empty"), ("g", "flat")], "document_id string, route string")
    flat = spark.createDataFrame([("e", "Short."), ("f", "never read")], "document_id string, summary string")
    composed = spark.createDataFrame([("d", "{}")], "document_id string, summary string")
    got = {r.document_id: r.summary for r in segmentation.document_summaries(routes, lines, flat, composed).collect()}
    assert got["d"].startswith("{}\n\n---\nSections detected: 2\nSection 1") and got["e"] == "Short." and got["f"] == got["g"] == "No readable content."


def test_answers_of_retrievals(spark):
    found = spark.createDataFrame([("c2", 0.2), ("c1", 0.1)], "chunk_id string, distance double")
    reply = '```json\n{"answer": "42", "citations": ["c1"]}\n```'
    got = retrieval.answer_of(found, "q", reply).first()
    assert (got.chunk_ids, got.answer, got.citations, got.uncertainties) == (["c1", "c2"], "42", ["c1"], [])
    assert retrieval.answer_of(found, "q", "nonsense").first().answer == "No model response."
    none = retrieval.answer_of(found.limit(0), "q", reply).first()
    assert none.answer == "No relevant chunks found." and none.chunks_used == 0 and none.citations == []


def test_catalogue_by_model_or_by_heuristic(spark):
    labelled = spark.createDataFrame([("a", "1"), ("b", "2")], "label string, document_id string")
    assert rows(catalogue.built(labelled)) == [("a", "1", "heuristic"), ("b", "2", "heuristic")]
    fallback = spark.createDataFrame([("1", "x", "fallback", "0_0")], "document_id string, label string, source string, batch string")
    assert rows(catalogue.built(labelled, fallback)) == rows(catalogue.built(labelled))
    given = spark.createDataFrame([("1", "Shifts", "model", "0_0"), ("2", "shifts", "model", "0_1"), ("3", "x", "fallback", "0_1")], "document_id string, label string, source string, batch string")
    assert rows(catalogue.built(labelled, given)) == [("shifts", "1", "llm_map_reduce"), ("shifts", "2", "llm_map_reduce"), ("x", "3", "llm_map_reduce")]


def test_exports_fall_back_to_their_text(spark):
    raw = spark.createDataFrame([("a", "date,sender,message"), ("b", " just words ")], "k string, text string")
    lines = spark.createDataFrame([("a", "[1] x: y"), ("b", "")], "k string, text string")
    assert rows(exports.with_raw_text(lines, raw, "k")) == [("a", "[1] x: y"), ("b", "just words")]


def test_transcribed_segments_have_pointers(spark):
    docs = spark.createDataFrame([("d", "video", [(0, 900, " hello ")])], "document_id string, doc_family string, segments array<struct<start_ms:long,end_ms:long,text:string>>")
    got = exports.transcribed_segments(docs).first()
    assert (got.page_id, got.page_number, got.source_pointer, got.text, got.confidence) == ("d_p0001", 1, "timestamp:0-900;keyframe_every_ms:15000", "hello", 0.8)
