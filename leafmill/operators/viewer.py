"""The queries behind the document viewer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named_edges(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges with the names of their subject and object; an unknown entity shows its id."""
    name = lambda side: entities.select(F.col("entity_id").alias(f"{side}_entity_id"), F.col("canonical_name").alias(f"_{side}"))
    rows = edges.join(name("subject"), "subject_entity_id", "left").join(name("object"), "object_entity_id", "left")
    return rows.withColumns(
        {"subject_name": F.coalesce("_subject", "subject_entity_id"), "object_name": F.coalesce("_object", "object_entity_id")}
    ).drop("_subject", "_object")


def search_edges(named: DataFrame, predicate: str | None, text: str) -> DataFrame:
    """Edges of a predicate, if one is given, whose subject, predicate, object or excerpt holds a text, whatever the case."""
    rows = named if predicate is None else named.filter(F.col("predicate") == predicate)
    return rows.filter(F.lower(F.concat_ws(" ", "subject_name", "predicate", "object_name", "evidence_excerpt")).contains(text.lower()))


def page_of(rows: DataFrame, order: list[str | Column], page: int, size: int = 75) -> DataFrame:
    """Page `page`, from 0, of rows in a total order."""
    return rows.orderBy(*order).offset(page * size).limit(size)


def edge_statistics(named: DataFrame) -> DataFrame:
    """(document_id, edges, predicates, entities): edges, their different predicates and different names, per document."""
    counts = named.groupBy("document_id").agg(F.count("*").alias("edges"), F.countDistinct("predicate").alias("predicates"))
    names = named.select("document_id", F.explode(F.array("subject_name", "object_name")).alias("name")).distinct()
    return counts.join(names.groupBy("document_id").agg(F.count("*").alias("entities")), "document_id")


def search_documents(documents: DataFrame, text: str) -> DataFrame:
    """Documents whose file name holds a text, whatever the case."""
    name = F.element_at(F.split("path", "/"), -1)
    return documents.withColumn("name", name).filter(F.lower("name").contains(text.lower()))


def documents_with_summary_first(documents: DataFrame) -> DataFrame:
    return documents.orderBy(F.coalesce(F.col("summary_text"), F.lit("")) == "", F.lower("name"))


def key_entity_index(summaries: DataFrame) -> DataFrame:
    """(entity, document_id): the documents whose list of key entities names it, a row each."""
    return summaries.select(F.explode("key_entities").alias("entity"), "document_id").distinct()


def entities_of_documents(registry: DataFrame) -> DataFrame:
    """(document_id, entity_id) from a registry whose entries list their documents."""
    return registry.select(F.explode("document_ids").alias("document_id"), "entity_id").distinct()


def with_summaries(documents: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every document with its summary, if it has one."""
    return documents.join(summaries.select("document_id", "summary_text"), "document_id", "left")


def groups_with(groups: DataFrame, ids: list[str]) -> DataFrame:
    """Groups marked by whether they hold any of the documents."""
    return groups.withColumn("matches", F.arrays_overlap("document_ids", F.array(*map(F.lit, ids))))


def ungrouped(groups: DataFrame) -> DataFrame:
    """(label, document_ids): the documents of a group that none of its subgroups holds."""
    inside = F.flatten(F.transform("subgroups", lambda s: s["document_ids"]))
    return groups.select("label", F.array_except("document_ids", inside).alias("document_ids"))
