"""Entities found by patterns, their cards, and the edges between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.ids import edge_id, entity_id
from leafmill.functions.text import excerpt, safe_confidence, without_code_fence

# --- Fixed values: the patterns of each kind, in the order in which kinds are listed. ---------------------------------

PATTERNS = {
    "name": r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2})\b",
    "email": r"\b([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})\b",
    "date": r"\b(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4})\b",
}
EVIDENCE = 20


def _placed(number: int, kind: str, pieces: Column, values: Column):
    """A transformation of the i-th match into a mention with its position."""

    def length(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0), lambda s, x: s + F.length(x))

    def mention(value: Column, i: Column) -> Column:
        start = length(F.slice(pieces, 1, i + 1)) + length(F.slice(values, 1, i))
        return F.struct(F.lit(number).alias("block"), i.alias("place"), F.lit(kind).alias("kind"), value.alias("value"), start.alias("start"))

    return mention


def mention_list(text: Column) -> Column:
    """A text's mentions as an array of (block, place, kind, value, start): names first, then e-mails, then dates, each in order
    of position; start is the 0-based position.

    Positions come from the text's pieces between the matches, so one pass of built-in expressions does without Python."""
    kinds = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        # the text with its matches taken out, as pieces; the n-th match starts after n + 1 pieces and n matches
        pieces = F.split(text, pattern)
        kinds.append(F.transform(values, _placed(number, kind, pieces, values)))
    return F.filter(F.concat(*kinds), lambda x: (x["kind"] != "name") | (F.length(x["value"]) >= 3))


def mentions(chunks: DataFrame) -> DataFrame:
    """(chunk columns but the text, ordinal, kind, value, start, entity_id, excerpt): every mention, with the text around it."""
    rows = chunks.select("*", F.posexplode(mention_list(F.col("text"))).alias("ordinal", "m"))
    start = F.col("m.start")
    return rows.select(
        *(c for c in chunks.columns if c != "text"),
        "ordinal",
        F.col("m.kind").alias("kind"),
        F.col("m.value").alias("value"),
        start.alias("start"),
        entity_id(F.col("m.kind"), F.col("m.value")).alias("entity_id"),
        excerpt(F.col("text"), start, start + F.length("m.value")).alias("excerpt"),
    )


def cards(found: DataFrame) -> DataFrame:
    """(entity_id, kind, canonical_name, aliases, mentions, evidence): an entity's first spelling, its others in order, its
    number of mentions and its last twenty places.

    Counts and spellings are combined before the shuffle; the places are ranked and cut before they are collected, so an
    entity that is everywhere is no large group."""
    place = ["document_id", "page_number", "chunk_id", "ordinal"]
    spellings = found.groupBy("entity_id", "kind", "value").agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("at"))
    names = F.array_sort(F.collect_list(F.struct("at", "value")))
    head = spellings.groupBy("entity_id", "kind").agg(F.sum("n").alias("mentions"), F.transform(names, lambda x: x["value"]).alias("aliases"))
    part = found.withColumn("_salt", F.pmod(F.xxhash64(*place), F.lit(32)))
    last = [F.col(c).desc_nulls_last() for c in place]
    some = part.withColumn("_n", F.row_number().over(Window.partitionBy("entity_id", "_salt").orderBy(*last))).filter(F.col("_n") <= EVIDENCE)
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy("entity_id").orderBy(*last))).filter(F.col("_n") <= EVIDENCE)
    shown = F.struct(*place, "excerpt")
    evidence = some.groupBy("entity_id").agg(F.array_sort(F.collect_list(shown)).alias("evidence"))
    rows = head.join(evidence, "entity_id")
    return rows.withColumns({"canonical_name": F.col("aliases")[0], "confidence": F.lit("medium")})


def co_mentions(chunks: DataFrame) -> DataFrame:
    """(edge_id, chunk_id, subject_entity_id, predicate, object_entity_id, document_id, page_number, evidence_excerpt, confidence): an
    edge for each two entities of a chunk, in order of first mention.

    All mentions of a chunk are in its own row, so entities are deduplicated and paired inside arrays, without a shuffle; they
    are at most what 2000 characters hold."""
    entry = lambda x: F.struct(entity_id(x["kind"], x["value"]).alias("entity_id"), x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"))
    listed = lambda m: F.transform(m, entry)
    rows = chunks.select("chunk_id", "document_id", "page_number", "text", listed(mention_list(F.col("text"))).alias("m"))
    # the first of each entity; the fold reads the list once, where a look-up by place would work it out for every element
    none = F.array().cast("array<struct<entity_id: string, start: int, end: int>>")
    known = lambda kept, x: F.exists(kept, lambda y: y["entity_id"] == x["entity_id"])
    first = F.aggregate("m", none, lambda kept, x: F.when(known(kept, x), kept).otherwise(F.array_append(kept, x)))
    rows = rows.select("chunk_id", "document_id", "page_number", "text", first.alias("e")).filter(F.size("e") > 1)
    place = F.posexplode("e").alias("i", "a")
    each = rows.select("chunk_id", "document_id", "page_number", "text", "e", place)
    each = each.select("chunk_id", "document_id", "page_number", "text", F.col("a.entity_id").alias("subject_entity_id"), F.col("a.start").alias("_start"), F.explode(F.slice("e", F.col("i") + 2, F.size("e"))).alias("b"))
    nothing = F.lit(None).cast("long")
    key = edge_id(F.col("subject_entity_id"), F.lit("co_mentioned"), F.col("b.entity_id"), F.col("document_id"), F.col("page_number"), nothing, nothing)
    return each.select(
        key.alias("edge_id"),
        "chunk_id",
        "subject_entity_id",
        F.lit("co_mentioned").alias("predicate"),
        F.col("b.entity_id").alias("object_entity_id"),
        "document_id",
        "page_number",
        excerpt(F.col("text"), F.col("_start"), F.col("b.end")).alias("evidence_excerpt"),
        F.lit(0.5).alias("confidence"),
    )


def entity_list(text: Column) -> Column:
    """The ids of a text's entities in order of first mention, each once; the kinds and order of `mention_list`, no positions."""
    kinds = []
    for kind, pattern in PATTERNS.items():
        values = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        if kind == "name":
            values = F.filter(values, lambda x: F.length(x) >= 3)
        kinds.append(F.transform(values, lambda x: entity_id(F.lit(kind), x)))
    return F.array_distinct(F.concat(*kinds))


def page_edges(chunks: DataFrame) -> DataFrame:
    """(edge_id, subject_entity_id, predicate, object_entity_id, document_id, page_number): the edges of `co_mentions` once for
    each page, without evidence.

    Only edges of the same document and page can be equal, so the shuffle takes each chunk's list of ids to its page, and
    edges are made and compared behind it; none is shuffled.  Pages of one chunk, as most are, have nothing to compare."""
    page = ["document_id", "page_number"]
    spark = chunks.sparkSession
    # edges cost far more than the bytes by which adaptive execution merges small partitions
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lists = chunks.select(*page, entity_list(F.col("text")).alias("e")).repartition(parts, *page)
    # behind a window, tests of the list aren't moved to where they would work it out again
    lists = lists.withColumn("_n", F.count("*").over(Window.partitionBy(*page)))

    def pairs(rows: DataFrame) -> DataFrame:
        each = rows.select(*page, "e", F.posexplode("e").alias("i", "subject_entity_id"))
        return each.select(*page, "subject_entity_id", F.explode(F.slice("e", F.col("i") + 2, F.size("e"))).alias("object_entity_id"))

    rows = pairs(lists.filter("_n = 1")).unionAll(pairs(lists.filter("_n > 1")).distinct())
    nothing = F.lit(None).cast("long")
    key = edge_id(F.col("subject_entity_id"), F.lit("co_mentioned"), F.col("object_entity_id"), F.col("document_id"), F.col("page_number"), nothing, nothing)
    return rows.select(key.alias("edge_id"), "subject_entity_id", F.lit("co_mentioned").alias("predicate"), "object_entity_id", *page)


def distinct_edges(edges: DataFrame) -> DataFrame:
    """One row per edge id, of the least chunk: overlapping chunks of a page repeat edges."""
    columns = [c for c in edges.columns if c != "edge_id"]
    rest = ["chunk_id", *(c for c in columns if c != "chunk_id")]
    return edges.groupBy("edge_id").agg(F.min(F.struct(*rest)).alias("e")).select("edge_id", "e.*").drop("chunk_id")


def new_edges(edges: DataFrame, stored: DataFrame) -> DataFrame:
    """Edges whose id is not stored yet."""
    return distinct_edges(edges).join(stored.select("edge_id"), "edge_id", "left_anti")


def model_edges(relations: DataFrame, found: DataFrame) -> DataFrame:
    """Edges that a model named: its subjects and objects looked up among the chunk's entities, by value in lower case, the
    last entity of equal values.  Unknown ones and edges to themselves are dropped; no predicate means related_to, no number
    as confidence .5.  `relations`: chunk_id, subject_value, predicate, object_value, evidence_excerpt, confidence."""
    known = found.groupBy("chunk_id", F.lower(F.trim("value")).alias("v")).agg(F.max_by("entity_id", "ordinal").alias("id"))
    side = lambda name: known.select("chunk_id", F.col("v").alias(f"_{name}"), F.col("id").alias(f"{name}_entity_id"))
    rows = relations.withColumns({"_subject": F.lower(F.trim("subject_value")), "_object": F.lower(F.trim("object_value"))})
    rows = rows.join(side("subject"), ["chunk_id", "_subject"]).join(side("object"), ["chunk_id", "_object"])
    return rows.filter(F.col("subject_entity_id") != F.col("object_entity_id")).select(
        "chunk_id",
        "subject_entity_id",
        F.coalesce(F.nullif(F.trim("predicate"), F.lit("")), F.lit("related_to")).alias("predicate"),
        "object_entity_id",
        F.trim("evidence_excerpt").alias("evidence_excerpt"),
        safe_confidence(F.col("confidence")).alias("confidence"),
    )


def position(text: Column, value: Column) -> Column:
    """The 0-based position of a value in a text, whatever the case; 0 if it is not there."""
    return F.greatest(F.lit(0), F.instr(F.lower(text), F.lower(value)) - 1)


def canonical(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))


def name_registry(names: DataFrame) -> DataFrame:
    """(entity_id, canonical_name, kind, aliases, documents, mention_count) from (document_id, kind, name): names that are equal in
    lower case and without extra space are one entity.  Its documents are rows of `entity_documents`, however many they are."""
    rows = names.filter(F.trim("name") != "").select("document_id", "kind", F.col("name"), canonical(F.col("name")).alias("canonical_name"))
    grouped = rows.groupBy("kind", "canonical_name").agg(
        F.array_sort(F.collect_set("name")).alias("aliases"), F.countDistinct("document_id").alias("documents"), F.count("*").alias("mention_count")
    )
    return grouped.withColumn("entity_id", entity_id(F.col("kind"), F.col("canonical_name")))


def entity_documents(names: DataFrame) -> DataFrame:
    """(entity_id, document_id, mentions): the documents of each entity of the registry, a row each."""
    rows = names.filter(F.trim("name") != "").select(entity_id(F.col("kind"), canonical(F.col("name"))).alias("entity_id"), "document_id")
    return rows.groupBy("entity_id", "document_id").agg(F.count("*").alias("mentions"))


def name_lists(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """(document_id, kind, name) from a model's answers with lists of persons and organizations: strings of a list only, not blank.

    An answer that is no object, or a field that is no list, gives no names."""
    lists = F.from_json(without_code_fence(F.col(answer)), "persons array<string>, organizations array<string>")
    rows = answers.select("document_id", lists.alias("n"))

    def listed(kind: str, field: str) -> Column:
        return F.transform(F.coalesce(F.col(field), F.array().cast("array<string>")), lambda x: F.struct(F.lit(kind).alias("kind"), F.trim(x).alias("name")))

    each = F.concat(listed("person", "n.persons"), listed("organization", "n.organizations"))
    return rows.select("document_id", F.explode(each).alias("e")).select("document_id", "e.*").filter("name <> ''")
