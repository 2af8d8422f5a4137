"""Problem 2: splitting oversized items at natural boundaries.

Lexical cohesion: at every natural boundary in the reach of a piece the words before and after it are
compared; where their similarity has its deepest valley the topic changes, and there the piece ends.
The next piece begins the overlap before that cut.  Pages are cut by characters, each text on its own;
documents by pages, in bounded stretches of a document whose meeting points are chosen locally, so
that a document of any length is cut in parallel.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.lineage import cut as cut_lineage
from leafmill.llm import flat
from leafmill.session import spread

LIMIT_CHARS, OVERLAP_CHARS = 2_000, 200
LIMIT_PAGES, OVERLAP_PAGES = 20, 1
#: Words on either side of a boundary that are compared; pages on either side, and sizes of their word sketches.
BLOCK_WORDS, BLOCK_PAGES, SKETCH = 60, 3, 128
#: Pages of a document that one task cuts, pages around a meeting point among which it is chosen, page numbers per rank bucket.
STRETCH, REACH, BUCKET = 500, 10, 5_000
#: Oversized documents, counted, whose ids are sent to every task; beyond it both sides of the join are shuffled.
BROADCAST_DOCUMENTS = 200_000
#: Added to a valley's depth at the end of a paragraph, and of a line.
PARAGRAPH, LINE = 0.3, 0.1

#: Unicode's White_Space, and the marks that end sentences.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
END = ".!?;。！？"
JAVA_TRIM = r"(?U)^[\p{IsWhite_Space}]+|[\p{IsWhite_Space}]+$"

WORD = re.compile(r"[^\W_]{2,}|[぀-ヿ㐀-鿿]")
BOUNDARY = re.compile(rf"[\r\n  ]+|[{END}][\"”’)\]]*(?=[{SPACE}])[{SPACE}]*|[。！？]")
ANY_SPACE = re.compile(rf"[{SPACE}]+")
SOLID = re.compile(rf"[^{SPACE}{END}]{{{LIMIT_CHARS + 1},}}")


def similarity(a: Counter, b: Counter) -> float:
    """The cosine of two bags of words."""
    if not a or not b:
        return 0.0
    small, large = (a, b) if len(a) < len(b) else (b, a)
    dot = sum(n * large[w] for w, n in small.items() if w in large)
    return dot / (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5


def depths(values: np.ndarray) -> np.ndarray:
    """How far each similarity lies below the highest ones on its two sides."""
    left = np.maximum.accumulate(values)
    right = np.maximum.accumulate(values[::-1])[::-1]
    return left + right - 2 * values


def cuts(text: str, limit: int = LIMIT_CHARS, overlap: int = OVERLAP_CHARS) -> list[tuple[int, int, str]]:
    """(start, end, boundary) of the pieces of a text: each at most `limit` long, the next starting `overlap` before the
    last one's end.  boundary: paragraph, line, sentence, space, none (a hard cut) or end.  A text within the limit is one piece."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    pieces, start = [], 0
    ends: list[tuple[int, str]] = []
    for m in BOUNDARY.finditer(text):
        mark = m.group()
        breaks = mark.count("\n") or mark.count("\r")
        ends.append((m.end(), "paragraph" if breaks > 1 else "line" if breaks else "sentence"))
    at = [e for e, _ in ends]
    words = [(m.start(), m.group().lower()) for m in WORD.finditer(text)] if len(text) > limit else []
    word_at = [w for w, _ in words]
    while len(text) - start > limit:
        low, high = start + limit // 2, start + limit
        i, j = bisect.bisect_right(at, low), bisect.bisect_right(at, high)
        if i < j:
            values = []
            for e, _ in ends[i:j]:
                k = bisect.bisect_left(word_at, e)
                before = Counter(w for _, w in words[max(0, k - BLOCK_WORDS) : k])
                values.append(similarity(before, Counter(w for _, w in words[k : k + BLOCK_WORDS])))
            depth = depths(np.array(values))
            depth += [PARAGRAPH if kind == "paragraph" else LINE if kind == "line" else 0.0 for _, kind in ends[i:j]]
            best = len(depth) - 1 - int(np.argmax(depth[::-1]))
            end, kind = ends[i + best]
        else:
            spaces = [m.end() for m in ANY_SPACE.finditer(text, low, high)]
            end, kind = (spaces[-1], "space") if spaces else (high, "none")
        pieces.append((start, end, kind))
        start = end - overlap
    return [*pieces, (start, len(text), "end")]


def oversized_pages(pages: DataFrame, limit: int = LIMIT_CHARS) -> DataFrame:
    """(page_id, body): pages whose text without white space at its ends exceeds the limit."""
    long = pages.select("page_id", "text").filter(F.col("page_id").isNotNull() & (F.length("text") > limit))
    return long.select("page_id", F.regexp_replace("text", JAVA_TRIM, "").alias("body")).filter(F.length("body") > limit)


def page_pieces(pages: DataFrame, limit: int = LIMIT_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(item_id, item_kind, piece, start, end, boundary, text): the pieces of oversized pages; start and end count in the
    text without white space at its ends.  Texts within the limit, null and blank ones give no rows; a page that stands
    twice gives its pieces twice.  item_kind is page_no_boundary for a page with more than `limit` characters in a row
    without white space or sentence mark."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        solid = re.compile(rf"[^{SPACE}{END}]{{{limit + 1},}}")
        for batch in batches:
            rows = []
            for key, body in zip(batch["page_id"], batch["body"]):
                kind = "page_no_boundary" if solid.search(body) else "page"
                rows += [(key, kind, n, a, b, edge, body[a:b]) for n, (a, b, edge) in enumerate(cuts(body, limit, overlap), 1)]
            yield pd.DataFrame(rows, columns=["item_id", "item_kind", "piece", "start", "end", "boundary", "text"])

    schema = "item_id string, item_kind string, piece int, start int, end int, boundary string, text string"
    return spread(oversized_pages(pages, limit)).mapInPandas(flat.filled(work), schema)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place: dict[str, int] = {}
    for batch in batches:
        rows = []
        for text in batch["text"]:
            counts = [0] * SKETCH
            for word in WORD.findall((text or "").lower()):
                k = place.get(word)
                if k is None:
                    if len(place) > 100_000:
                        place.clear()
                    k = place[word] = zlib.crc32(word.encode("utf-8", "replace")) % SKETCH
                counts[k] += 1
            rows.append(counts)
        yield batch[["document_id", "page_number"]].assign(sketch=rows)


def document_pieces(pages: DataFrame, limit: int = LIMIT_PAGES, overlap: int = OVERLAP_PAGES) -> DataFrame:
    """(item_id, item_kind, first_page, last_page, pages): the pieces of documents with more than `limit` different page
    numbers: at most `limit` pages each, the next beginning with the last `overlap` pages of the one before.
    Rows without page number or document are no pages; a page number that stands twice counts once."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    rows = pages.select("document_id", "page_number", "text").filter(
        F.col("document_id").isNotNull() & F.col("page_number").isNotNull()
    )
    numbers = rows.select("document_id", "page_number").distinct()
    sizes = numbers.groupBy("document_id").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    large = cut_lineage(sizes.select(F.col("document_id").alias("_large")))
    if large.count() <= BROADCAST_DOCUMENTS:
        large = F.broadcast(large)
    rows = rows.join(large, F.col("document_id") == F.col("_large"), "left_semi")
    sketches = rows.mapInPandas(flat.filled(_sketch), "document_id string, page_number int, sketch array<int>")
    # read three times below; of rows of one page that differ, the greatest
    sketches = cut_lineage(sketches.groupBy("document_id", "page_number").agg(F.max("sketch").alias("sketch")))
    # the rank of a page in its document, by buckets of page numbers, so that no task orders a whole document
    bucket = F.floor(F.col("page_number") / BUCKET)
    counts = sketches.groupBy("document_id", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("document_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("document_id", "bucket").orderBy("page_number")
    counts = counts.select("document_id", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = sketches.withColumn("bucket", bucket).join(counts, ["document_id", "bucket"])
    ranked = ranked.withColumn("rank", F.col("offset") + F.row_number().over(within) - 1)
    # each stretch also gets the pages around its ends
    margin = REACH + BLOCK_PAGES + limit
    home = F.floor(F.col("rank") / STRETCH)
    stretches = F.array_distinct(
        F.array(home, F.floor((F.col("rank") + margin) / STRETCH), F.greatest(F.lit(0), F.floor((F.col("rank") - margin) / STRETCH)))
    )
    spread = ranked.select("document_id", "page_number", "rank", "sketch", F.explode(stretches).alias("stretch"))

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rank")
        rank, number = part["rank"].to_numpy(), part["page_number"].to_numpy()
        vectors = np.array(part["sketch"].tolist(), float)
        own = int(part["stretch"].iloc[0])
        total = np.vstack([np.zeros(SKETCH), np.cumsum(vectors, axis=0)])
        n = len(rank)
        gap = np.arange(1, n)
        left = total[gap] - total[np.maximum(0, gap - BLOCK_PAGES)]
        right = total[np.minimum(n, gap + BLOCK_PAGES)] - total[gap]
        norm = np.sqrt((left**2).sum(axis=1) * (right**2).sum(axis=1))
        sim = np.where(norm > 0, (left * right).sum(axis=1) / np.maximum(norm, 1e-9), 0.0)  # sim[i]: before page i + 1

        def deepest(low: int, high: int) -> int:
            """The page index in [low, high] before which the valley is deepest; the last of equals."""
            depth = depths(sim[low - 1 : high])
            return high - int(np.argmax(depth[::-1]))

        def meeting(m: int) -> int | None:
            """The index of the page with which stretch m begins: the same for both stretches that meet there."""
            first, last = np.searchsorted(rank, m * STRETCH - REACH), np.searchsorted(rank, m * STRETCH + REACH, side="right") - 1
            if m == 0 or last < first or rank[last] < m * STRETCH:
                return None
            return deepest(max(1, int(first)), int(last))

        begin, end = meeting(own), meeting(own + 1)
        begin = 0 if begin is None else max(0, begin - overlap)
        end = n if end is None else end
        pieces = []
        while end - begin > limit:
            stop = deepest(begin + limit // 2, begin + limit)
            pieces.append((begin, stop))
            begin = stop - overlap
        pieces.append((begin, end))
        return pd.DataFrame(
            [(part["document_id"].iloc[0], "document", number[a], number[b - 1], b - a) for a, b in pieces if b > a],
            columns=["item_id", "item_kind", "first_page", "last_page", "pages"],
        )

    schema = "item_id string, item_kind string, first_page int, last_page int, pages int"
    # a stretch that only holds pages of its neighbours' margins begins beyond the document's end
    real = spread.withColumn("_own", (F.floor(F.col("rank") / STRETCH) == F.col("stretch")).cast("int"))
    held = real.groupBy("document_id", "stretch").agg(F.max("_own").alias("_held")).filter("_held = 1").drop("_held")
    return real.drop("_own").join(held, ["document_id", "stretch"], "left_semi").groupBy("document_id", "stretch").applyInPandas(cut, schema)


def oversized(pages: DataFrame) -> DataFrame:
    """(item_id, item_kind): the items that had to be cut, from their pieces."""
    by_page = page_pieces(pages).select("item_id", "item_kind")
    return by_page.unionByName(document_pieces(pages).select("item_id", "item_kind")).distinct()


def p2_found(spark, sf_dir: str) -> DataFrame:
    return oversized(spark.read.parquet(f"{sf_dir}/page_results.parquet"))


def p2_page_pieces(spark, sf_dir: str) -> DataFrame:
    pieces = page_pieces(spark.read.parquet(f"{sf_dir}/page_results.parquet"))
    return pieces.select("item_id", "item_kind", "piece", "start", "end", "boundary").distinct()


def p2_document_pieces(spark, sf_dir: str) -> DataFrame:
    return document_pieces(spark.read.parquet(f"{sf_dir}/page_results.parquet"))


def p2_document_checks(spark, sf_dir: str) -> DataFrame:
    """What must hold of the pieces of a document: where they begin and end, how many pages they hold, each overlap counted once,
    whether any is too long, and whether one does not begin with the last page of the one before."""
    pieces = document_pieces(spark.read.parquet(f"{sf_dir}/page_results.parquet"))
    order = Window.partitionBy("item_id").orderBy("first_page")
    pieces = pieces.withColumn("_before", F.lag("last_page").over(order))
    return pieces.groupBy("item_id").agg(
        F.min("first_page").alias("first_page"),
        F.max("last_page").alias("last_page"),
        (F.sum("pages") - F.count("*") + 1).alias("pages"),
        F.max(F.col("pages") > LIMIT_PAGES).alias("too_long"),
        F.coalesce(F.max(F.col("_before") != F.col("first_page")), F.lit(False)).alias("torn"),
    )


QUERIES = {"p2_document_checks": p2_document_checks, "p2_found": p2_found, "p2_page_pieces": p2_page_pieces, "p2_document_pieces": p2_document_pieces}
SQL = {
    "p2_document_checks": """
        SELECT document_id AS item_id, min(page_number) AS first_page, max(page_number) AS last_page, count(DISTINCT page_number) AS pages, false AS too_long, false AS torn
        FROM page_results WHERE document_id IS NOT NULL AND page_number IS NOT NULL GROUP BY document_id HAVING count(DISTINCT page_number) > 20
    """,
    "p2_found": """
        WITH p AS (SELECT page_id, document_id, page_number,
                regexp_replace(text, '^[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+|[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+$', '', 'g') AS body
            FROM page_results)
        SELECT document_id AS item_id, 'document' AS item_kind FROM p GROUP BY document_id HAVING count(DISTINCT page_number) > 20
        UNION
        SELECT page_id, CASE WHEN list_max(list_transform(
                string_split_regex(body, '[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}.!?;。！？]'), lambda x: length(x))) > 2000
            THEN 'page_no_boundary' ELSE 'page' END
        FROM p WHERE length(body) > 2000
    """,
}
