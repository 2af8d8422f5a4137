"""Problem 3: text statistics of each page and its class (prose, list, table or junk).

The statistics of a batch of pages are computed on one array of code points, without a loop over
pages, lines or words.  A mergeable quantile sketch of each statistic is built for each language;
percentiles and robust z-scores against it flag the tails of the distributions.  The structure of
the lines tells lists and tables; what is left of a page is junk where its statistics lie in the
tails that prose of the language does not reach.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.lineage import cut
from leafmill.llm import flat
from leafmill.session import spread

CHUNK_CHARS = 1 << 19

# --- Fixed values: frequent words of each language; characters for a script without spaces. -----------------------

COMMON = {
    "en": "the of and to a in is was for that had with by not on at were as it from be an has but no which or would their are"
    " this after before two who have been you we all one other our its they will more also than only can may should must"
    " when each every under during between into about there these those any some such if both said he she his her him",
    "de": "der die das den dem des und zu im ist nicht von mit auf für über wurde wurden eine ein einer einen zum zur bis wir"
    " sie es aus bei noch dass sich als auch nach haben hat wird werden sind war am an um so aber oder wenn wie durch",
    "fr": "le la les de des du un une et à en est que pour dans sur a été pas il elle ce cette sont au aux par ne avec nous"
    " vous leur se qui ou mais plus avant depuis comme deux ont fois puis encore",
    "es": "el la los las del se un una y en que por con no fue al es su para lo como más pero sus le ha antes desde este esta"
    " son fueron ya muy todo también hasta dos veces nos han según",
    "ja": "のはをにがでとたしまれ",
}
LANGUAGES = (*COMMON, "und")
BULLETS = "-•*–·‣◦▪●○■□✓+"
VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýœ"
#: Largest spread that the robust z-scores assume for prose, and the z beyond which a value lies in a tail.
SPREAD = {"common": 0.08, "symbols": 0.03, "vowels": 0.05, "word_length": 0.8, "digits": 0.06, "letters": 0.08}
TAIL = 4.0
#: Steps of the percentile scale.
GRID = 100

# classes of code points
LETTER, DIGIT, SPACE, LINE, OTHER, KANJI = range(6)
STATISTICS = ("words", "word_length", "symbols", "punctuated", "common", "vowels", "digits", "letters")
SHARES = ("list_share", "table_share", "noise_share")
OUT = ", ".join(f"{c} double" for c in (*STATISTICS, *SHARES, "rest_chars", "total_chars", "bare"))


@functools.cache
def point_class() -> np.ndarray:
    """The class of each code point."""
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(0x20000):
        category = unicodedata.category(chr(c))
        if category[0] == "L" or category in ("Mn", "Mc"):
            kinds[c] = LETTER
        elif category[0] == "N":
            kinds[c] = DIGIT
        elif category[0] == "Z" or category == "Cc":
            kinds[c] = SPACE
    kinds[0x20000:0x32000] = KANJI
    for a, b in ((0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3), (0xF900, 0xFAFF)):
        kinds[a : b + 1] = KANJI
    for c in (10, 11, 12, 13, 0x85, 0x2028, 0x2029):
        kinds[c] = LINE
    return kinds


POWERS = np.cumprod(np.full(32, np.uint64(0x100000001B3)))


def word_hashes(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; the words lie one after another in `codes`."""
    if not len(start):
        return np.empty(0, np.uint64)
    place = np.arange(len(codes)) - np.repeat(start, length)
    return np.add.reduceat((codes.astype(np.uint64) + np.uint64(7)) * POWERS[np.minimum(place, 31)] ^ np.uint64(0x5BD1), start)


@functools.cache
def common_table() -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, language bits) of the frequent words."""
    bits: dict[int, int] = {}
    for i, language in enumerate(COMMON):
        for word in COMMON[language] if language == "ja" else COMMON[language].split():
            codes = flat.code_points(word)
            key = int(word_hashes(codes, np.array([0]), np.array([len(codes)]))[0])
            bits[key] = bits.get(key, 0) | 1 << i
    keys = np.array(sorted(bits), np.uint64)
    return keys, np.array([bits[int(k)] for k in keys], np.int64)


def _runs(flag: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """Where `flag` holds on at least `least` successive lines of one page."""
    change = np.flatnonzero((np.diff(flag.astype(np.int8), prepend=2) != 0) | (np.diff(owner, prepend=-1) != 0))
    length = np.diff(np.append(change, len(flag)))
    return flag & np.repeat(length >= least, length)


def statistics(texts: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(statistics by name, language number) of each text."""
    n = len(texts)
    codes, starts, _ = flat.join([t.lower() for t in texts], "\n")
    original, first_of, _ = flat.join(texts, "\n")
    kind = point_class()[codes]
    size = len(codes)

    # words: runs of letters, and every ideograph or kana by itself
    letter, kanji = kind == LETTER, kind == KANJI
    begins = (letter & ~np.concatenate([[False], letter[:-1]])) | kanji
    inside = letter | kanji
    word = np.flatnonzero(begins)
    packed = codes[inside]
    word_at = np.flatnonzero(begins[inside])
    word_length = np.diff(np.append(word_at, len(packed)))
    page_of_word = np.searchsorted(starts, word, side="right") - 1
    keys, bits = common_table()
    h = word_hashes(packed, word_at, word_length)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    known = np.where(keys[at] == h, bits[at], 0) if len(h) else np.empty(0, np.int64)
    by_language = np.stack([np.bincount(page_of_word, (known >> i) & 1, minlength=n) for i in range(len(COMMON))], axis=1)
    n_words = np.bincount(page_of_word, minlength=n)

    # lines without blank ones
    line_start = np.concatenate([[0], np.flatnonzero(kind == LINE) + 1])
    line_start = line_start[line_start < size]
    solid = (kind != SPACE) & (kind != LINE)
    length = np.add.reduceat(solid.astype(np.int64), line_start)
    line = np.flatnonzero(length)
    line_start_all, line_end_all = line_start, np.append(line_start[1:], size)
    solid_at = np.flatnonzero(solid)
    lo = solid_at[np.searchsorted(solid_at, line_start_all[line])] if len(line) else np.empty(0, np.int64)
    hi = solid_at[np.searchsorted(solid_at, line_end_all[line]) - 1] if len(line) else np.empty(0, np.int64)
    chars = length[line]
    owner = np.searchsorted(starts, lo, side="right") - 1

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[hi + 1] - total[lo]

    after_space = np.concatenate([[False], ~solid[:-1]])
    gap3 = solid & after_space & np.concatenate([[False] * 3, (kind[2:-1] == SPACE) & (kind[1:-2] == SPACE) & (kind[:-3] == SPACE)])[:size]
    gap3[lo] = False
    tight = np.append(solid[1:], False)
    digits = kind == DIGIT
    n_digits, n_letters, n_kanji = count(digits), count(letter), count(kanji)
    n_bar, n_tab = count(codes == 124), count(codes == 9)
    tabular = (n_bar >= 2) | (n_tab >= 2) | (count((codes == 59) & tight) >= 2) | (count(gap3) >= 2) | (count((codes == 44) & tight) >= 4)
    readable = (n_letters + n_digits + n_kanji) * 2 >= chars
    tabular &= readable | ((n_bar >= 2) & (count((codes == 45) | (codes == 124) | (codes == 58)) == chars))

    width = hi - lo + 1
    head = np.stack([codes[np.minimum(lo + i, size - 1)] for i in range(6)], axis=1)
    head_kind = np.stack([kind[np.minimum(lo + i, size - 1)] for i in range(6)], axis=1)
    bullet = np.isin(head[:, 0], flat.code_points(BULLETS)) & (head_kind[:, 1] == SPACE)
    marked = bullet.copy()
    opening = ((head[:, 0] == 40) | (head[:, 0] == 91)).astype(np.int64)
    rows = np.arange(len(lo))
    for k in range(1, 5):
        for same in (DIGIT, LETTER):
            if same == LETTER and k > 3:
                continue
            body = np.ones(len(lo), bool)
            for j in range(k):
                body &= head_kind[rows, np.minimum(opening + j, 5)] == same
            close = np.minimum(opening + k, 5)
            body &= (head[rows, close] == 41) | (head[rows, close] == 46) | (head[rows, close] == 93)
            body &= (close < 5) & (head_kind[rows, np.minimum(close + 1, 5)] == SPACE)
            marked |= body
    marked &= (n_letters + n_kanji) * 3 >= chars
    dot = codes == 46
    four = dot & np.concatenate([[False] * 3, dot[2:-1] & dot[1:-2] & dot[:-3]])[:size]
    leader = (count(four) > 0) & (n_letters > 3)
    colon = (codes == 58) & np.append(kind[1:] == SPACE, False)
    first_colon = np.full(len(lo), 10**9)
    colon_at = np.flatnonzero(colon)
    if len(colon_at):
        nearest = np.searchsorted(colon_at, lo)
        ok = nearest < len(colon_at)
        first_colon[ok] = colon_at[nearest[ok]] - lo[ok]
    shown = np.append(known > 0, False)
    common_total = np.concatenate([[0], np.cumsum(shown)])
    w_lo, w_hi = np.searchsorted(word, lo), np.searchsorted(word, hi + 1)
    line_words, line_common = w_hi - w_lo, common_total[w_hi] - common_total[w_lo]
    entry = (line_common <= 2) & (first_colon <= 30) & (first_colon >= 3) & (width <= 110) & (head_kind[:, 0] != DIGIT) & (first_colon < width)
    last = codes[hi] if len(hi) else codes[:0]
    ends_open = ~np.isin(last, flat.code_points(".,;:!?-)。！？…¬‐­"))
    upper = original[first_of[owner] + (lo - starts[owner])] != codes[lo] if len(original) == size else np.zeros(len(lo), bool)
    item = upper & ends_open & (width <= 64) & (line_common <= 1) & (line_words <= 9) & (n_letters * 2 >= chars)
    plain = ~tabular
    listed = (
        _runs(marked & plain, owner, 2)
        | (leader & plain)
        | _runs(entry & plain, owner, 3)
        | _runs(item & plain & ~marked, owner, 4)
    ) & plain
    vowel = np.isin(codes, flat.code_points(VOWELS)) & letter
    latin = letter & (codes < 0x250)
    n_vowels, n_latin = count(vowel), count(latin)
    scrambled = (n_letters >= 30) & (n_latin * 4 >= n_letters * 3) & (n_vowels < 0.22 * n_latin)
    noise = plain & ~listed & (line_common == 0) & (chars >= 12) & (
        ((n_letters + n_kanji + n_digits) * 3 < chars) | (n_letters > 25 * line_words) | scrambled | ((chars >= 40) & (n_digits * 10 > chars * 8))
    )
    rest = ~tabular & ~listed & ~noise

    def per_page(x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        x = np.broadcast_to(x, owner.shape)
        return np.bincount(owner if mask is None else owner[mask], x if mask is None else x[mask], minlength=n)

    total = np.maximum(1, per_page(chars))
    rest_chars = np.maximum(1, per_page(chars, rest))
    rest_words = np.maximum(1, per_page(line_words, rest))
    result = {
        "words": n_words.astype(float),
        "word_length": per_page(n_letters + n_kanji, rest) / rest_words,
        "symbols": per_page(chars - n_letters - n_digits - n_kanji) / total,
        "punctuated": per_page(~ends_open) / np.maximum(1, per_page(1)),
        "common": per_page(line_common, rest) / rest_words,
        "vowels": (per_page(n_vowels, rest) + 4) / (per_page(n_latin, rest) + 10),
        "digits": per_page(n_digits, rest) / rest_chars,
        "letters": per_page(n_letters + n_kanji, rest) / rest_chars,
        "list_share": per_page(chars, listed) / total,
        "table_share": per_page(chars, tabular) / total,
        "noise_share": per_page(chars, noise) / total,
        "rest_chars": per_page(chars, rest).astype(float),
        "total_chars": per_page(chars).astype(float),
        "bare": per_page(n_kanji, rest) / rest_chars,
    }
    best = by_language.argmax(axis=1)
    language = np.where(by_language.max(axis=1) >= np.maximum(2, 0.02 * n_words), best, len(COMMON))
    return result, language


def page_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, language, statistics) of each non-blank text; no shuffle."""
    kind = df.schema[key].dataType.simpleString()
    names = [c.split(" ")[0] for c in OUT.split(", ")]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["_text"].tolist()
            for a, b in flat.chunks(texts, len, CHUNK_CHARS):
                values, language = statistics(texts[a:b])
                out = pd.DataFrame({"_key": batch["_key"].to_numpy()[a:b], "language": np.array(LANGUAGES)[language]})
                yield out.assign(**{c: values[c] for c in names})

    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(F.col("_text").rlike(r"(?U)\S"))
    return spread(rows).mapInPandas(flat.filled(measure), f"_key {kind}, language string, {OUT}").withColumnRenamed("_key", key)


def sketches(stats: DataFrame, columns: tuple[str, ...] = STATISTICS) -> DataFrame:
    """(language, a quantile sketch of each statistic): one row per language and one, `all`, merged from them."""
    each = stats.groupBy("language").agg(*(F.kll_sketch_agg_double(c).alias(c) for c in columns))
    both = each.unionByName(each.agg(*(F.kll_merge_agg_double(c).alias(c) for c in columns)).withColumn("language", F.lit("all")))
    return both


def standardised(stats: DataFrame, columns: tuple[str, ...] = STATISTICS) -> DataFrame:
    """The statistics with, for each, its percentile (pct_) and robust z-score (z_) in the page's language.

    Pages of no known language are held against all pages.  The spread of z is a quarter-range, but at most
    SPREAD, so that many odd pages do not make odd pages look usual.  The sketches are a handful of rows."""
    grid = F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))
    marks = sketches(stats, columns).select(
        F.col("language").alias("_language"),
        *(F.kll_sketch_get_quantile_double(F.col(c), grid).alias(f"_grid_{c}") for c in columns),
    )
    joined = stats.join(
        F.broadcast(marks), F.when(F.col("language") == "und", "all").otherwise(F.col("language")) == F.col("_language")
    )

    def percentile(c: str):
        return F.size(F.filter(f"_grid_{c}", lambda x: x < F.col(c))) / (GRID + 1)

    def z(c: str):
        low, middle, high = (F.col(f"_grid_{c}")[GRID * i // 4] for i in (1, 2, 3))
        spread = F.greatest(F.lit(1e-3), F.least((high - low) / 1.349, F.lit(SPREAD.get(c, 1e9))))
        return (F.col(c) - middle) / spread

    return joined.select(
        *stats.columns, *(percentile(c).alias(f"pct_{c}") for c in columns), *(z(c).alias(f"z_{c}") for c in columns)
    )


def classified(df: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """Statistics, percentiles, z-scores, flagged tails and text_class of each page with readable characters.

    Null, empty and blank texts give no row; of repeated keys every row is measured.  Extra columns are not read.
    The statistics are cut from the text by a checkpoint, as both the sketches and the scores read them."""
    scored = standardised(cut(page_statistics(df, key, text)))
    unreadable = (F.col("z_common") < -TAIL / 2) & (F.col("common") < 0.15) & (F.col("bare") < 0.3) & (
        (F.col("z_vowels") < -TAIL) | (F.col("letters") < 0.5) | (F.col("z_word_length") > 2 * TAIL) | (F.col("word_length") < 2)
    )
    tails = F.array_compact(F.array(*(F.when(F.abs(F.col(f"z_{c}")) > TAIL, F.lit(c)) for c in STATISTICS)))
    noise = F.col("noise_share")
    rest = 1 - F.col("list_share") - F.col("table_share") - noise
    share = {
        "list": F.col("list_share"),
        "table": F.col("table_share"),
        "junk": noise + F.when(unreadable, rest).otherwise(0.0),
        "prose": F.when(unreadable, 0.0).otherwise(rest),
    }
    best = F.greatest(*share.values())
    label = F.coalesce(*(F.when(v == best, F.lit(k)) for k, v in share.items()))
    return scored.withColumn("tails", tails).withColumn("text_class", label)


def p3_found(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/page_results.parquet")
    return classified(pages).filter(F.col("text_class") != "prose").select("page_id", "text_class").distinct()


def p3_statistics(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/page_results.parquet")
    conf = pages.groupBy("page_id").agg(F.max("confidence").alias("confidence"))
    found = classified(pages).dropDuplicates(["page_id"])
    shown = [F.round(c, 6).alias(c) for c in (*STATISTICS, *SHARES)]
    return found.join(conf, "page_id", "left").select("page_id", "language", "confidence", *shown, "tails", "text_class")


QUERIES = {"p3_found": p3_found, "p3_statistics": p3_statistics}
SQL: dict[str, str] = {}
