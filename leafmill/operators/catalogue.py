"""The two-level catalogue of documents: signals, groups, subgroups, merges and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import compact, first_sentence, label

NOUN = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2}\b"
BATCH, MERGE, NOUNS = 40, 120, 8
FALLBACK = "uncategorized documents"
SUMMARY = (
    "purpose string, overall_purpose string, what_this_segment_contains string, document_type_or_mix string, document_type string,"
    " document_types_present array<string>, key_entities array<string>"
)
ALIASES = {"comment_thread": "comment thread", "handwritten_note": "handwritten note"}

#: Capitalised words that name nothing by themselves.
GENERIC = """
January February March April May June July August September October November December
Monday Tuesday Wednesday Thursday Friday Saturday Sunday
Invoice Receipt Report Letter Schedule Form Table Document File Attachment Summary Overview Section Appendix Exhibit Memo Notice Statement Agreement
The This That These Those A An All Each Both Some Any No There Here Where When What Which Who How Please Note See Per Re
Service Services Center Centre Office Program Department Division Group Team Board Committee Item Items Date Page Total Amount
""".split()


def summary_object(text: Column) -> Column:
    """A summary's JSON object: the whole text, else what stands before a line of three dashes, else null."""
    head = F.split(F.trim(text), "\n---\n", 2)[0]
    is_object = lambda x: F.when(F.trim(x).startswith("{") & F.try_parse_json(F.trim(x)).isNotNull(), F.trim(x))
    return F.coalesce(is_object(text), is_object(head))


def short_summary(parsed: Column, raw: Column) -> Column:
    """The first sentence of the first purpose given, else of the raw text, in 240 characters."""
    given = F.coalesce(*(F.nullif(F.trim(parsed[f]), F.lit("")) for f in ("purpose", "overall_purpose", "what_this_segment_contains")), F.trim(raw))
    return F.coalesce(F.nullif(compact(first_sentence(given)), F.lit("")), F.lit("No readable summary."))


def type_hint(parsed: Column, family: Column, media: Column) -> Column:
    """The type a summary names, mixed if it names several, else the family, else the media type."""
    text = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    listed = F.filter(F.transform(parsed["document_types_present"], lambda x: F.lower(F.trim(x))), lambda x: x != "")
    several = F.when(F.size(listed) == 1, listed[0]).when(F.size(listed) > 1, "mixed")
    own = F.when(text(family) != "other", text(family))
    return F.coalesce(text(parsed["document_type_or_mix"]), text(parsed["document_type"]), several, own, text(media), F.lit("unknown"))


def proper_nouns(text: Column, most: int = NOUNS) -> Column:
    """The first capitalised names of up to three words, each once whatever its case, without generic words."""
    found = F.filter(F.regexp_extract_all(text, F.lit(NOUN), F.lit(0)), lambda x: ~x.isin(*GENERIC))
    none = F.array().cast("array<string>")
    known = lambda kept, x: (F.size(kept) >= most) | F.exists(kept, lambda y: F.lower(y) == F.lower(x))
    return F.aggregate(found, none, lambda kept, x: F.when(known(kept, x), kept).otherwise(F.array_append(kept, x)))


def signals(documents: DataFrame) -> DataFrame:
    """(document_id, name, doc_family, media_type, short_summary, document_type_hint, proper_nouns) from documents with a
    name and a summary_text."""
    parsed = F.from_json(summary_object(F.col("summary_text")), SUMMARY)
    rows = documents.withColumn("_parsed", parsed)
    rows = rows.withColumn("short_summary", short_summary(F.col("_parsed"), F.col("summary_text")))
    hint = type_hint(F.col("_parsed"), F.col("doc_family"), F.col("media_type"))
    nouns = proper_nouns(F.concat_ws(" ", "short_summary", "name"))
    return rows.select("document_id", "name", "doc_family", "media_type", "short_summary", hint.alias("document_type_hint"), nouns.alias("proper_nouns"))


def heuristic_label(rows: DataFrame) -> DataFrame:
    """Adds `label`: schedules by their summary, else the hinted type, else the family."""
    hint = F.col("document_type_hint")
    names = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    named = F.concat(F.coalesce(F.try_element_at(names, hint), F.replace(hint, F.lit("_"), F.lit(" "))), F.lit(" documents"))
    by_family = F.when((F.col("doc_family") != "") & (F.col("doc_family") != "other"), F.concat(F.lower("doc_family"), F.lit(" documents")))
    text = (
        F.when(F.lower("short_summary").contains("schedule"), "workplace schedules")
        .when(~hint.isin("unknown", "mixed", ""), named)
        .otherwise(F.coalesce(by_family, F.lit(FALLBACK)))
    )
    return rows.withColumn("label", text)


def groups(labelled: DataFrame) -> DataFrame:
    """(label, document_count), largest first; the members stay rows of `labelled`, however many they are."""
    return labelled.groupBy("label").agg(F.countDistinct("document_id").alias("document_count")).orderBy(F.desc("document_count"), "label")


def subgroups(labelled: DataFrame) -> DataFrame:
    """(label, subgroup, document_count) by the first proper noun, of two documents or more."""
    first = labelled.select("label", "document_id", F.explode(F.slice("proper_nouns", 1, 1)).alias("subgroup"))
    rows = first.groupBy("label", "subgroup").agg(F.countDistinct("document_id").alias("document_count"))
    return rows.filter("document_count >= 2")


def batches(documents: DataFrame, size: int = BATCH, parts: int = 64) -> DataFrame:
    """Adds `batch`, of at most `size` documents: positions are counted inside hash parts, so no task orders all documents."""
    part = F.pmod(F.xxhash64("document_id"), F.lit(parts))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("document_id")) - 1
    rows = documents.withColumn("_part", part).withColumn("_batch", F.floor(place / size))
    return rows.withColumn("batch", F.concat_ws("_", "_part", "_batch")).drop("_part", "_batch")


def assigned(documents: DataFrame, answers: DataFrame) -> DataFrame:
    """(document_id, label, source): every document exactly once: its first valid assignment by a model, else the fallback.

    `answers`: batch, group_index, label, member_index, document_id.  Unknown documents and further assignments are dropped."""
    w = Window.partitionBy("document_id").orderBy("group_index", "member_index")
    valid = answers.join(documents.select("document_id", "batch"), ["document_id", "batch"], "left_semi")
    first = valid.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("document_id", label(F.col("label")).alias("label"), F.lit("model").alias("source"))
    rest = documents.select("document_id").distinct().join(first, "document_id", "left_anti")
    return first.unionByName(rest.select("document_id", F.lit(FALLBACK).alias("label"), F.lit("fallback").alias("source")))


def unassigned(documents: DataFrame, members: DataFrame) -> DataFrame:
    """Documents that no group holds."""
    return documents.select("document_id").distinct().join(members.select("document_id"), "document_id", "left_anti")


def default_merge(source_groups: DataFrame) -> DataFrame:
    """(label, source_group_ids): source groups of equal labels together, by label."""
    return source_groups.groupBy(label(F.col("label")).alias("label")).agg(F.array_sort(F.collect_set("source_group_id")).alias("source_group_ids"))


def merge_is_whole(merged: DataFrame, source_groups: DataFrame) -> bool:
    """Whether a merge holds every source group and no other; if not, the default merge takes its place."""
    held = merged.select(F.explode("source_group_ids").alias("source_group_id")).distinct()
    expected = source_groups.select("source_group_id").distinct()
    return held.join(expected, "source_group_id", "left_anti").isEmpty() and expected.join(held, "source_group_id", "left_anti").isEmpty()


def source_groups(assignments: DataFrame) -> DataFrame:
    """(source_group_id, batch, label) of the groups that batches of documents were put in: `assigned` with its batch."""
    return assignments.groupBy("batch", "label").agg(F.count("*").alias("members")).withColumn("source_group_id", F.concat_ws("_", "batch", F.sha1("label")))


def merged_members(merged: DataFrame, members: DataFrame) -> DataFrame:
    """(label, document_id): the documents of merged groups by way of their source groups; the first group by label that names a
    document keeps it.  `merged`: label, source_group_ids; `members`: source_group_id, document_id."""
    each = merged.select("label", F.explode("source_group_ids").alias("source_group_id")).join(members.select("source_group_id", "document_id"), "source_group_id")
    return each.groupBy("document_id").agg(F.min("label").alias("label")).select("label", "document_id")


def built(labelled: DataFrame, assignments: DataFrame | None = None) -> DataFrame:
    """(label, document_id, method): the catalogue's groups: by a model's assignments, merged by label, where it made any, else by the
    documents' own labels.  The method is llm_map_reduce or heuristic; no documents give no rows."""
    own = labelled.select("label", "document_id", F.lit("heuristic").alias("method")).distinct()
    if assignments is None or assignments.filter("source = 'model'").isEmpty():
        return own
    groups = source_groups(assignments)
    members = assignments.join(groups.select("batch", "label", "source_group_id"), ["batch", "label"]).select("source_group_id", "document_id")
    return merged_members(default_merge(groups), members).withColumn("method", F.lit("llm_map_reduce"))
