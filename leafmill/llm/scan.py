"""Problem 1: noise in the text of scanned pages, and its repair.

The first pass counts the words of the corpus.  A word type is misread if undoing one or two known
confusions of characters gives a type that is very much more frequent.  The second pass leaves one row
of each page: the layout features of all its lines, the lines that may be headers or hold page numbers,
the words broken at line ends, and the words that may be misread types, by a hash filter of fixed size;
a join with the types decides.  How often a line and a distance between printed and counted page number
recur in a document are aggregations over those rows.  A hidden Markov model that runs from each edge
inwards, over all lines until both runs meet, labels the lines as header, page number, break or body.
Its transitions and emissions are fitted to all lines by expectation and maximisation, from emissions
counted on lines that the features settle by themselves.  Where a line stands decides what its
recurrence says: it is counted on all lines for a first labelling, and for the last one on the lines
that this leaves outside the body and the outermost line of the body.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm import flat

from leafmill.lineage import cut
from leafmill.session import spread

#: Least share of the pages of a document, or of the span of pages it stands on, from which a line that fills
#: the page's width and goes on below is a header all the same.
HEADER_SHARE, RUN_SHARE = 0.2, 0.5
#: How many times as frequent the true word must be; for words of letters only, and for words with digits or marks.
RATIO_LETTERS, RATIO_MARKS = 12, 2
#: Bits of the hash filter of misread types that is sent to every task, and of a part of it.
FILTER_BITS, PART_BITS = 22, 12
#: Rounds of expectation and maximisation.
ROUNDS = 3
#: Characters of the longest word; a longer run without spaces is no word that was printed, and not restored.
LONGEST_WORD = 40
#: Word types that a task of the first pass keeps before it passes their counts on.
FLUSH_TYPES = 200_000
#: Lines that the fit works on at once in a task; a longer page stands alone.
FIT_LINES = 50_000

# --- Fixed values: characters as printed and as recognised. --------------------------------------------------------

CONFUSIONS = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("i", "!"), ("i", "|"), ("l", "|"), ("l", "!"), ("s", "5"), ("g", "9"), ("b", "6"),
    ("e", "c"), ("t", "f"), ("h", "b"), ("i", "l"), ("n", "ri"), ("a", "ci"), ("d", "cl"), ("u", "ii"), ("m", "rn"),
    ("w", "vv"), ("li", "h"), ("cl", "d"), ("rn", "m"),
)
BREAK_MARKS = "-‐‑¬­"
PAGE_WORDS = "page|p|pg|pag|pág|página|seite|s|blatt|folio|fol|ページ|頁"
FREQUENT = frozenset(
    "the of and to a in is was for that had with by not on at were as it from be an has but no which would their this after before"
    " der die das den dem und zu im ist nicht von mit auf für über wurde wurden le la les des du un une et à en est que pour dans sur"
    " été el los las del se una y por con fue al o ou aux par il aus bei noch zur bis wir eine".split()
)

# --- Patterns -------------------------------------------------------------------------------------------------------

_W = r"[^\W_]"
#: A word starts only where none stands before, so that a long run of letters is scanned once.
_START = r"(?<![\w’'-])"
BROKEN = re.compile(rf"{_START}({_W}[\w’'-]*)[{BREAK_MARKS}][ \t\u00a0]*(?:\r\n|[\n\r\x0b\x0c\x85\u2028\u2029])\s*({_W}[\w’'-]*)")
END_BROKEN = re.compile(rf"{_START}({_W}[\w’'-]*)[{BREAK_MARKS}]\s*$")
MARK_AT_END = re.compile(rf"[{BREAK_MARKS}][ \t\u00a0]*[\r\n\x0b\x0c\x85\u2028\u2029]")
DIGIT = re.compile(r"\d")
#: No word begins so; a capital I that was misread does.
CAPITAL_I = re.compile(r"l[bcdfgkmnpqrstvwxz]")
AROUND = ".,;:()[]{}\"“”„«»—–_?…/\\*#=<>+&%$€£~^`@'’‘-。、"
NUMERAL = r"(?:\d{1,4}|[ivxl]{1,7})"
ALONE = re.compile(
    rf"^[\W_]{{0,4}}(?:(?:{PAGE_WORDS})\b\.?\s*(?:no\.?|nr\.?)?\s*)?[-–—.\[(|~*:#\s]{{0,6}}(?P<n>{NUMERAL})"
    rf"(?:\s*(?:/|of|von|de|sur|di|-)\s*\d{{1,4}})?[-–—.\])|~*\s]{{0,6}}$",
    re.IGNORECASE,
)
BESIDE = re.compile(
    rf"^(?:(?P<a>\d{{1,4}})\s{{3,}}(?P<x>\S.*)|(?P<y>.*?\S)(?:\s{{3,}}|\s*[|·•]\s*|\s+[-–—]\s+)(?:(?:{PAGE_WORDS})\.?\s*)?(?P<b>\d{{1,4}})"
    rf"|(?:{PAGE_WORDS})\.?\s*(?P<c>\d{{1,4}})\s*[|·•–—-]\s*(?P<z>\S.*))$",
    re.IGNORECASE,
)
#: What a line of BESIDE that doesn't end with a digit begins with.
BESIDE_STARTS = frozenset(c for c in map(chr, range(0x110000)) if c.isdecimal()) | frozenset("ſ" + "".join(w[0] + w[0].upper() for w in PAGE_WORDS.split("|")))
SENTENCE_END = re.compile(r"[^\W\d_]{3}[.!?] ")
ITEM = re.compile(r"\s*(?:(?:\(?\d{1,3}[.)]|\(?[a-z]{1,3}[.)]|[-•*–·‣◦▪])\s+\S|\|)")
CELLS = re.compile(r"\S(?:\t|;|\s{2,}|\s*\|\s*)(?=\S)")

# codes of a line: number, sentence, lower case, item, blank beside, fills the width and goes on below
NONE, BARE, DECORATED, WITH_TEXT = range(4)
HEADER, NUMBER, BREAK, BODY, INNER = range(5)


def roman(text: str) -> int | None:
    """The value of a Roman numeral in its usual form."""
    values = {"i": 1, "v": 5, "x": 10, "l": 50}
    digits = [values[c] for c in text.lower()]
    total = sum(-d if any(d < e for e in digits[i + 1 : i + 2]) else d for i, d in enumerate(digits))
    ones, tens = divmod(total, 10)
    usual = ("", "x", "xx", "xxx", "xl", "l", "lx", "lxx", "lxxx")[min(ones, 8)] + (
        "", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"
    )[tens]
    return total if usual == text.lower() else None


#: Each character and the one that stands for its class.
_ONE_FORM = str.maketrans({"0": "o", "5": "s", "9": "g", "i": "l", "1": "l", "!": "l", "|": "l", "c": "e", "f": "t", "6": "u", "b": "u", "h": "u", "d": "a"})


def skeleton(text: str) -> str:
    """A form of a line in which printed and misread characters fall together: single characters first, then the pairs that
    stand for one, in classes wide enough for both."""
    text = text.casefold().translate(_ONE_FORM)
    for pair, single in (("rn", "m"), ("vv", "w"), ("rl", "n"), ("el", "a"), ("ll", "u")):
        text = text.replace(pair, single)
    return re.sub(r"[\W_]+", " ", text).strip()


def broken_at(text: str) -> list[re.Match]:
    """The matches of BROKEN in a text that has a word character before a mark at a line's end; most texts have none.

    A match ends its first word at such a mark, so only the words there are tried."""
    found, end, marked = [], 0, False
    for mark in MARK_AT_END.finditer(text):
        at = start = mark.start()
        marked = marked or (at > 0 and (text[at - 1].isalnum() or text[at - 1] == "_"))
        while start > end and (text[start - 1].isalnum() or text[start - 1] in "_’'-"):
            start -= 1
        if start < at and (m := BROKEN.match(text, start)):
            found.append(m)
            end = m.end()
    return found if marked else []


def _replaced(text: str, broken: list[re.Match], by: str) -> str:
    """The text with `by` in place of each broken word."""
    parts, end = [], 0
    for m in broken:
        parts += text[end : m.start()], m.expand(by)
        end = m.end()
    return "".join(parts) + text[end:]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def out(raw: Counter) -> pd.DataFrame:
        counts: Counter = Counter()
        for token, n in raw.items():
            word = token.strip(AROUND)
            if 1 < len(word) <= LONGEST_WORD:
                counts[word] += n
        return pd.DataFrame(counts.items(), columns=["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(_replaced(text, broken_at(text), " ").lower().split())
            if len(counts) > FLUSH_TYPES:
                yield out(counts)
                counts = Counter()
    yield out(counts)


def word_bit(word: str) -> int:
    """The place of a word in the filter of misread types."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) >> (32 - FILTER_BITS)


class TokenCodes(dict):
    """For each raw token four counts in one integer: maybe misread, frequent, characters of a plausible word, characters that
    ought to be words (long tokens, and short ones without digits that hold a letter)."""

    def __init__(self, types: bytes):
        super().__init__()
        self.types = types

    def suspected(self, word: str) -> bool:
        """Whether a word may be a misread type; False is certain."""
        at = word_bit(word)
        return bool(self.types[at >> 3] >> (at & 7) & 1)

    def __missing__(self, token: str) -> int:
        if len(self) > FLUSH_TYPES:
            self.clear()
        word = token.strip(AROUND)
        plausible = 2 <= len(word) <= 24 and any(c in VOWELS or c > "\u024f" for c in word) or word[:1] > "\u3000"
        claims = len(token) > 40 or (any(map(str.isalpha, word)) and not any(map(str.isdigit, word)))
        size = len(word) if plausible and claims else 0
        code = self.suspected(word) | ((word in FREQUENT) << 20) | (size << 40) | ((max(size, len(word) or len(token)) if claims else 0) << 72)
        self[token] = code
        return code

    def of(self, text: str) -> tuple[int, int, int, int]:
        """(maybe misread, frequent, plausible characters, characters that ought to be words) of a lower-case text."""
        total = sum(map(self.__getitem__, text.split()))
        return total & 0xFFFFF, (total >> 20) & 0xFFFFF, (total >> 40) & 0xFFFFFFFF, total >> 72


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts, without words broken at line ends; combined in each task before the shuffle."""
    rows = df.select(F.col(text).alias("text")).filter(F.col("text").isNotNull())
    return spread(rows).mapInPandas(flat.filled(_count_words), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def restored(word: str) -> set[str]:
    """What a word may have been: one confusion undone at one place, all its places, or two of them undone."""

    def once(w: str) -> set[str]:
        found = set()
        for true, seen in CONFUSIONS:
            at = w.find(seen)
            while at >= 0:
                found.add(w[:at] + true + w[at + len(seen) :])
                at = w.find(seen, at + 1)
        return found

    first = once(word)
    marked = {w for w in first if any(c in "0123456789!|" for c in w)}
    return (first | {v for w in marked for v in once(w)}) - {word}


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for word, n in zip(batch["word"], batch["n"]):
            letters = sum(map(str.isalpha, word))
            marks = len(word) - letters - word.count("-") - word.count("'") - word.count("’")
            if letters < 3 or marks > 3:  # two places at most are restored
                continue
            ratio = RATIO_MARKS if marks else RATIO_LETTERS
            for true in restored(word):
                if not any(c in "0123456789!|" for c in true):
                    rows.append((word, true, n * ratio, marks))
        yield pd.DataFrame(rows, columns=["word", "true_word", "least", "marks"])


def misread_types(counts: DataFrame) -> DataFrame:
    """(word, true_word): the word types that are misreadings of very much more frequent ones, with the most frequent."""
    variants = counts.mapInPandas(flat.filled(_variants), "word string, true_word string, least long, marks int")
    known = counts.select(F.col("word").alias("true_word"), F.col("n").alias("true_n")).filter("true_n > 1")
    long_enough = (F.col("marks") > 0) | (F.length("word") >= 4)
    pairs = variants.join(known, "true_word").filter(long_enough & (F.col("true_n") >= F.col("least")))
    return pairs.groupBy("word").agg(F.max(F.struct("true_n", "true_word"))["true_word"].alias("true_word"))


# --- The second pass ---------------------------------------------------------------------------------------------------


def is_item(line: str) -> bool:
    """Whether a line begins as an item or a row, or holds a row of dots."""
    return "...." in line or ITEM.match(line) is not None


def edge_code(line: str, blank_beside: bool, runs_on: bool = False) -> tuple[str, int, int]:
    """(core, code, printed number or -1) of a line; the core is empty where the line can be no header.
    A line that `runs_on` fills the page's width and goes on in lower case."""
    text = line.strip()
    value, core, number, item = -1, text, NONE, False
    if len(text) <= 24 and (len(text) <= 12 or DIGIT.search(text)) and (found := ALONE.match(text)):
        digits = found["n"]
        value = int(digits) if digits.isdigit() else roman(digits) or -1
        if value >= 0:
            number, core = (BARE if text.isdigit() else DECORATED), ""
            if text.endswith(".") and text[:-1].isdigit():
                number, value = NONE, -1
    elif 0 < len(text) <= 100 and (text[-1].isdecimal() or (text[0] in BESIDE_STARTS and text[-1] not in ".,;")) and (beside := BESIDE.match(text)):
        digits, rest = beside["a"] or beside["b"] or beside["c"], beside["x"] or beside["y"] or beside["z"]
        if not CELLS.search(rest) and not rest.endswith(".."):
            number, value, core = WITH_TEXT, int(digits), rest
    long = len(core) > 90
    low = core.lower()
    tokens = low.split()
    sentence = bool(core) and (
        runs_on
        or long
        or (core[-1] in ".,;:?!。" and not core.endswith(("Inc.", "Ltd.", "Co.")))
        or sum(map(FREQUENT.__contains__, tokens)) >= 3
        or ((". " in core or "! " in core or "? " in core) and SENTENCE_END.search(core) is not None)
    )
    lower = core[:1].islower() and not CAPITAL_I.match(core)
    if not sentence:
        gaps = len(low) >= sum(map(len, tokens)) + len(tokens) or "\t" in core or ";" in core or "|" in core
        item = is_item(line) or (gaps and len(CELLS.findall(core)) >= 2)
    if sentence or lower or item or long or sum(map(str.isalpha, core)) < 3:
        core = ""
    code = number | (sentence << 2) | (lower << 3) | (item << 4) | (blank_beside << 5)
    return core, code, value


def type_filter(types: DataFrame) -> bytes:
    """The hash filter of the misread types: 2**FILTER_BITS bits, however many types there are."""

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(np.fromiter(map(word_bit, batch["word"]), np.int64, len(batch)))
            yield pd.DataFrame({"part": (at >> PART_BITS).astype(np.int32), "at": (at & ((1 << PART_BITS) - 1)).astype(np.int32)})

    held = np.zeros(1 << FILTER_BITS, np.uint8)
    parts = types.select("word").mapInPandas(flat.filled(bits), "part int, at int").groupBy("part").agg(F.collect_set("at").alias("at"))
    for row in parts.collect():  # at most the filter's bits
        held[(row.part << PART_BITS) + np.array(row.at)] = 1
    return np.packbits(held, bitorder="little").tobytes()


def placed(text: str, place: int, tokens: TokenCodes) -> Iterator[tuple[int, str, int]]:
    """(place, word, n) of the words of a lower-case text that may be misread types."""
    words = Counter(t.strip(AROUND) for t in text.split())
    return ((place, w, n) for w, n in words.items() if tokens.suspected(w))


def observe(text: str, tokens: TokenCodes) -> tuple:
    """What a page leaves: how readable it is, the codes of its lines, the lines that may be headers or hold a number (their places
    among the filled lines, cores, numbers and what they go on to), its broken words, the word it goes on with, the word broken at
    its end, and the words of the page (place -1) and of its lines that may be misread types.

    The code of a line holds seven bits as seen from the top and seven as seen from the bottom; what a line goes on to is 1 for
    text below one that fills the page's width, 3 if that begins in lower case."""
    lines = text.splitlines()
    bare = [line.strip() for line in lines]
    filled = [i for i, line in enumerate(bare) if line]
    pairs = broken_at(text)
    broken = [f"{m[1]}\n{m[2]}".lower() for m in pairs]
    lower = (_replaced(text, pairs, r"\1\2") if pairs else text).lower()
    bad, common, readable, solid = tokens.of(lower)
    codes, at, cores, values, on, aside = [], [], [], [], [], []
    words = [*placed(lower, -1, tokens)] if bad else []
    suspects = {w for _, w, _ in words}
    wide = 0.75 * max(map(len, bare), default=0)
    last = len(bare) - 1
    for place, i in enumerate(filled):
        below = bare[i + 1] if i < last else ""
        fills = len(bare[i]) >= wide
        core, code, value = edge_code(lines[i], False)
        top = edge_code(lines[i], False, True)[1] if fills and core and below[:1].islower() else code
        codes.append(top | (i < last and not below) << 5 | (code | (i > 0 and not bare[i - 1]) << 5) << 7)
        aside.append(bool(core) or code & 3 in (BARE, DECORATED))
        if core or value >= 0:
            at.append(place)
            cores.append(skeleton(core) if core else "")
            values.append(value)
            on.append(0 if not fills else 3 if below[:1].islower() else int(any(map(str.isalpha, below))))
        if suspects:
            held = lines[i].lower()
            if len(suspects) > 8 or any(w in held for w in suspects):
                words += (w for w in placed(held, place, tokens) if w[1] in suspects)
    first = ""
    for place, i in enumerate(filled):  # below lines that may be headers or numbers
        line = bare[i]
        if line[0].islower() and len(line) > 3 and line[1] not in ".)":
            first = line.split()[0].strip(".,;:)").lower()
        if first or not aside[place]:
            break
    end = ""
    for place, i in reversed([*enumerate(filled)]):  # above such lines
        if bare[i][-1] in BREAK_MARKS and (m := END_BROKEN.search(lines[i])):
            end = m[1].lower()
        if end or not aside[place]:
            break
    return readable / max(1, solid), common, codes, at, cores, values, on, broken, first, end, words


VOWELS = frozenset("aeiouyäöüàáâåæèéêëìíîïòóôõøùúû")
OBSERVED = (
    "page_id string, document_id string, page_number int, readable double, common int, codes array<smallint>, at array<int>,"
    " cores array<string>, numbers array<int>, goes_on array<int>, broken array<string>, first string, last string"
)


def observations(pages: DataFrame, types: DataFrame) -> DataFrame:
    """One short row of each page, checkpointed; pages that stand twice count once."""
    spark = pages.sparkSession
    rows = pages.select("page_id", "document_id", F.col("page_number").cast("int").alias("page_number"), "text").filter(
        F.col("text").rlike(r"(?U)\S") & F.col("page_id").isNotNull()
    )
    known = spark.sparkContext.broadcast(type_filter(types))
    names = [c.split()[0] for c in OBSERVED.split(", ")] + ["words"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenCodes(known.value)
        placed_words = pa.list_(pa.struct([("place", pa.int32()), ("word", pa.string()), ("n", pa.int32())]))
        kinds = (
            pa.float64(), pa.int32(), pa.list_(pa.int16()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()),
            pa.list_(pa.string()), pa.string(), pa.string(), placed_words,
        )
        for batch in batches:
            seen = [observe(t, tokens) for t in batch.column(3).to_pylist()]
            columns = list(zip(*seen)) if seen else [[] for _ in kinds]
            arrays = [pa.array([[dict(zip(("place", "word", "n"), w)) for w in x] for x in c] if k == placed_words else c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names)

    seen = spread(rows).mapInArrow(look, OBSERVED + ", words array<struct<place: int, word: string, n: int>>")
    # of rows of one page that differ, the greatest
    once = cut(seen.groupBy("page_id").agg(F.max(F.struct(*(c for c in names if c != "page_id"))).alias("s")).select("page_id", "s.*"))
    return cut(_joined(once, types))


def _joined(seen: DataFrame, types: DataFrame) -> DataFrame:
    """The observations with what the types say of their suspected words: body_bad, the number of misread words that are on no
    line as a whole, bad_words, and wrong, whether each line holds one."""
    words = seen.select("page_id", F.explode("words").alias("w")).select("page_id", "w.*")
    inside = F.col("place") < 0
    hit = words.join(types.select("word"), "word", "left_semi").groupBy("page_id").agg(
        F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias("_whole"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("_lines"),
        F.array_sort(F.collect_set(F.when(inside, F.col("word")))).alias("_words"),
        F.collect_set(F.when(~inside, F.col("place"))).alias("_places"),
    ).filter("_whole > 0")
    wrong = F.transform("codes", lambda _, i: F.coalesce(F.array_contains("_places", i), F.lit(False)))
    seen = seen.drop("words").join(hit, "page_id", "left")
    seen = seen.withColumn("body_bad", F.coalesce(F.greatest(F.lit(0), F.col("_whole") - F.col("_lines")), F.lit(0)).cast("int"))
    seen = seen.withColumn("bad_words", F.coalesce("_words", F.array().cast("array<string>"))).withColumn("wrong", wrong)
    return seen.drop("_whole", "_lines", "_words", "_places")


def broken_words(seen: DataFrame, counts: DataFrame) -> DataFrame:
    """(page_id, next_page, left, right, broken): every word parted by a line end (next_page null) or by the page's end.

    A pair is a compound, not broken, if it holds a digit, if the corpus has it more often with a hyphen than without, or if
    the corpus has neither but both halves as words."""
    inside = seen.select("page_id", F.explode("broken").alias("pair")).select(
        "page_id", F.lit(None).cast("string").alias("next_page"), F.split("pair", "\n")[0].alias("left"), F.split("pair", "\n")[1].alias("right")
    )
    after = seen.filter(F.col("first") != "").groupBy("document_id", (F.col("page_number") - 1).alias("page_number"))
    after = after.agg(F.min(F.struct(F.col("first").alias("right"), F.col("page_id").alias("next_page"))).alias("f"))
    ends = seen.filter(F.col("last") != "").select("page_id", "document_id", "page_number", F.col("last").alias("left"))
    across = ends.join(after.select("document_id", "page_number", "f.*"), ["document_id", "page_number"], "left")
    across = across.select("page_id", F.coalesce("next_page", F.lit("")).alias("next_page"), "left", "right")
    pairs = inside.unionByName(across).distinct()
    digit = F.col("left").rlike(r"\d") | F.coalesce(F.col("right").rlike(r"\d"), F.lit(False))
    kinds = pairs.filter(~digit).select("left", "right").distinct()
    forms = {"with": F.concat("left", F.lit("-"), "right"), "without": F.concat("left", "right"), "a": F.col("left"), "b": F.col("right")}
    wanted = kinds.select(
        "left", "right", F.explode(F.map_from_arrays(F.array(*map(F.lit, forms)), F.array(*forms.values()))).alias("form", "word")
    )
    held = wanted.join(counts, "word", "left").groupBy("left", "right").agg(
        *(F.coalesce(F.max(F.when(F.col("form") == f, F.col("n"))), F.lit(0)).alias(f"n_{f}") for f in forms)
    )
    compound = F.when(F.col("right").isNull(), F.col("n_a") >= 20).otherwise(
        (F.col("n_with") > F.col("n_without"))
        | ((F.col("n_with") == 0) & (F.col("n_without") == 0) & (F.least("n_a", "n_b") >= 20) & (F.length("right") > 2))
    )
    verdicts = held.select(F.col("left").alias("_l"), F.col("right").alias("_r"), (~compound).alias("broken"))
    match = (F.col("left") == F.col("_l")) & F.col("right").eqNullSafe(F.col("_r"))
    return pairs.join(verdicts, match, "left").select("page_id", "next_page", "left", "right", F.coalesce("broken", F.lit(False)).alias("broken"))


def marks(seen: DataFrame) -> DataFrame:
    """One row per line that may be a header or holds a number."""
    return seen.select(
        "page_id", "document_id", "page_number", F.explode(F.arrays_zip("at", "cores", "numbers", "goes_on")).alias("line")
    ).select("page_id", "document_id", "page_number", "line.*")


def recurring(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """(page_id, flags): what the documents say of the lines of a page, four times the place of each line that counts and 2 where
    it is repeated, or 1 where its number is in sequence with those of other pages."""
    goes_on = F.col("goes_on").bitwiseAND(1)
    candidates = lines.filter(F.col("cores") != "").groupBy("document_id", "cores", "page_id")
    candidates = candidates.agg(F.max(goes_on).alias("goes_on"), F.first("page_number").alias("page_number"))
    often = candidates.groupBy("document_id", "cores").agg(
        F.count("*").alias("pages"), F.sum("goes_on").alias("going_on"), (F.max("page_number") - F.min("page_number") + 1).alias("span")
    ).filter("pages >= 3")
    # a line of the body that recurs fills its line and goes on; it is neither on much of the document nor on a run of pages
    apart = F.col("going_on") * 2 <= F.col("pages")
    run = F.col("pages") >= RUN_SHARE * F.coalesce("span", F.lit(1 << 31))
    often = often.join(sizes, "document_id").filter(apart | run | (F.col("pages") >= HEADER_SHARE * F.col("size")))
    repeated = lines.join(often.select("document_id", "cores"), ["document_id", "cores"]).select("page_id", (F.col("at") * 4 + 2).alias("flag"))
    numbered = lines.filter(F.col("numbers") >= 0).withColumn("shift", F.col("numbers") - F.col("page_number")).filter(F.col("shift").isNotNull())
    steady = numbered.select("document_id", "shift", "page_id").distinct().groupBy("document_id", "shift").agg(F.count("*").alias("k")).filter("k >= 2")
    steady = numbered.join(steady.select("document_id", "shift"), ["document_id", "shift"]).select("page_id", (F.col("at") * 4 + 1).alias("flag"))
    return repeated.unionByName(steady).groupBy("page_id").agg(F.collect_list("flag").alias("flags"))


#: The features of a line that the model reads, with their numbers of values.
FEATURES = {"number": 4, "sentence": 2, "lower": 2, "item": 2, "blank": 2, "repeated": 2, "steady": 2}


#: Probabilities of the next line inwards, from each label and (the last row) from the edge, with which the fit begins.  Inside the
#: body stand lines of the body and breaks (INNER) only: a line that a line of the body parts from the edge is no header and no number.
FIRST_STEP = np.array(
    [  # header, number, break, body, break inside the body
        [0.02, 0.25, 0.23, 0.50, 0],
        [0.25, 0.02, 0.23, 0.50, 0],
        [1e-4, 1e-4, 0.10, 0.90, 0],
        [0, 0, 0, 0.99, 0.01],
        [0, 0, 0, 0.90, 0.10],
        [0.20, 0.25, 0.15, 0.40, 0],
    ]
)
#: How many lines the first values count for beside those of the corpus.
PRIOR = 50.0
SIZES = tuple(FEATURES.values())
#: The combination of features of each line code, times four, and what its document says of the line.  A line that goes on
#: below as a sentence is not repeated.
COMBINATION = np.array(
    [
        np.ravel_multi_index((c & 3, c >> 2 & 1, c >> 3 & 1, c >> 4 & 1, c >> 5 & 1, (flag >> 1) & ~(c >> 2) & 1, flag & 1), SIZES)
        for c in range(64)
        for flag in range(4)
    ]
)


def laid_out(codes: pd.Series, flags: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, combinations as seen from the top, and from the bottom) of the lines of pages, one page after another."""
    lengths = np.fromiter(map(len, codes), np.int64, len(codes))
    starts = np.cumsum(lengths) - lengths
    code = np.concatenate([*codes]).astype(np.int64)
    said = np.zeros(len(code), np.int64)
    held = [(start, f) for start, f in zip(starts, flags) if f is not None]
    if held:
        flag = np.concatenate([f for _, f in held]).astype(np.int64)
        np.bitwise_or.at(said, np.repeat([start for start, _ in held], [len(f) for _, f in held]) + (flag >> 2), flag & 3)
    return starts, lengths, COMBINATION[(code & 63) << 2 | said], COMBINATION[(code >> 7 & 63) << 2 | said]


def inwards(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, by: int) -> Iterator[np.ndarray]:
    """The lines from an edge inwards, in matrices of (sequence, line) with -1 beyond the last, the longest sequences first; of one
    page with others of about its length."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    while len(order):
        deep = lengths[order[0]]
        some, order = order[: max(1, FIT_LINES // deep)], order[max(1, FIT_LINES // deep) :]
        k = np.arange(deep)
        at = starts[some, None] + by * np.minimum(k, lengths[some, None] - 1)
        yield np.where(k < lengths[some, None], symbols[at], -1)


def halves(batch: pd.DataFrame) -> Iterator[np.ndarray]:
    """The lines of pages from each edge to the middle."""
    starts, lengths, top, bottom = laid_out(batch["codes"], batch["flags"])
    yield from inwards(top, starts, (lengths + 1) // 2, 1)
    yield from inwards(bottom, starts + lengths - 1, lengths // 2, -1)


def totals(packed: DataFrame, size: int, work) -> np.ndarray:
    """The sum over all pages of the `size` sums that `work` makes of a matrix of lines; nothing else comes to the driver."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in filter(len, batches):
            for symbols in halves(batch):
                total += work(symbols)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"k": some, "v": total[some]})

    sums = np.zeros(size)
    for row in packed.select("codes", "flags").mapInPandas(flat.filled(part), "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        sums[row.k] = row.v
    return sums


def first_emissions(packed: DataFrame) -> np.ndarray:
    """(label, combination of features): log-probabilities counted over all lines that their features settle by themselves."""
    combinations = int(np.prod(SIZES))
    counts = totals(packed, combinations, lambda symbols: np.bincount(symbols[symbols >= 0], minlength=combinations))
    tables = [np.full((5, size), 2.0) for size in SIZES]
    for at in np.flatnonzero(counts):
        row = dict(zip(FEATURES, np.unravel_index(at, SIZES)))
        if row["number"] in (BARE, DECORATED):
            label = NUMBER
        elif row["repeated"]:
            label = HEADER
        elif row["sentence"] or row["lower"] or row["item"]:
            label = BODY
        else:
            label = BREAK
        for held, name in zip(tables, FEATURES):
            held[label, row[name]] += counts[at] ** 0.75  # damped: layouts differ less than their counts
    for held in tables:
        held[INNER] = held[BREAK]
    return joint(tables)


def joint(tables: list[np.ndarray]) -> np.ndarray:
    """(label, combination): the log-probability of each combination of features, independent under a label."""
    total = np.zeros((len(tables[0]), 1))
    for t in tables:
        total = (total[:, :, None] + np.log(t / t.sum(axis=1, keepdims=True))[:, None, :]).reshape(len(t), -1)
    return total


def marginal(counts: np.ndarray) -> list[np.ndarray]:
    """The counts of each feature's values under each label, from those of the combinations."""
    cube = counts.reshape(-1, *SIZES)
    return [cube.sum(axis=tuple(i for i in range(1, cube.ndim) if i != k + 1)) for k in range(len(SIZES))]


def expected(symbols: np.ndarray, weight: np.ndarray, step: np.ndarray, emission: np.ndarray) -> np.ndarray:
    """The expected counts of transitions (a row from each label and one from the edge) and of combinations under each label, flat.

    `symbols`: (sequence, line), the combination of each line from the edge inwards, -1 beyond the last; the longest sequences
    come first, so that those that reach a line are the first ones."""
    held, symbols = np.exp(emission), np.ascontiguousarray(symbols.T)
    alive = (symbols >= 0).sum(axis=1)
    seen, forward, scale = [], [], []
    for k, n in enumerate(alive):
        seen.append(held[:, symbols[k, :n]])
        now = (step[-1][:, None] if k == 0 else step[:-1].T @ forward[-1][:, :n]) * seen[-1]
        scale.append(now.sum(axis=0))
        forward.append(now / scale[-1])
    moves, counts = np.zeros(step.shape), np.zeros(emission.shape)
    on = np.zeros((len(held), 0))
    for k in range(len(alive) - 1, -1, -1):
        n = alive[k]
        backward = np.ones((len(held), n))
        backward[:, : on.shape[1]] = step[:-1] @ on
        share = forward[k] * backward
        share *= weight[:n] / share.sum(axis=0)
        for label, row in enumerate(share):
            counts[label] += np.bincount(symbols[k, :n], row, minlength=emission.shape[1])
        on = backward * seen[k] / scale[k]
        if k == 0:
            moves[-1] = share.sum(axis=1)
        else:
            moves[:-1] += step[:-1] * ((forward[k - 1][:, :n] * weight[:n]) @ on.T)
    return np.concatenate([moves.ravel(), counts.ravel()])


def fitted(packed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(log-transitions, log-emissions) after ROUNDS of expectation and maximisation over all lines of all pages, each page as two
    sequences from its edges to its middle."""
    emission = first_emissions(packed)
    step, prior = FIRST_STEP, PRIOR * FIRST_STEP
    first = [PRIOR * np.exp(t) for t in _tables(emission)]
    for _ in range(ROUNDS):
        sums = totals(packed, step.size + emission.size, lambda symbols, step=step, emission=emission: expected(symbols, np.ones(len(symbols)), step, emission))
        moves = sums[: step.size].reshape(step.shape) + prior
        emission = joint([t + p for t, p in zip(marginal(sums[step.size :].reshape(emission.shape)), first)])
        step = moves / moves.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore"):
        return np.log(step), emission


def _tables(emission: np.ndarray) -> list[np.ndarray]:
    """The log-probability of each feature's values under each label, from those of the combinations."""
    return [np.log(t) for t in marginal(np.exp(emission))]


def _steps(starts: np.ndarray, lengths: np.ndarray, by: int) -> Iterator[np.ndarray]:
    """From an edge inwards, the lines at each step of the pages that reach it, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    begin, left = starts[order], -lengths[order]
    for k in range(-left[0] if len(left) else 0):
        yield begin[: np.searchsorted(left, -k)] + by * k


def _best(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, by: int, step: np.ndarray, emission: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, back, slot): for each label and slot the score of the best labels from an edge up to there, and the label before it
    on that path; and the slot of each line."""
    steps = [*_steps(starts, lengths, by)]
    lines = np.concatenate(steps)
    slot = np.empty(len(lines), np.int64)
    slot[lines] = np.arange(len(lines))
    score, back = np.take(emission, symbols[lines], axis=1), np.zeros((len(emission), len(lines)), np.int8)
    begin, before = 0, None
    for at in steps:
        here = slice(begin, begin + len(at))
        if before is None:
            score[:, here] += step[-1][:, None]
        else:
            before = before[:, : len(at)]
            if len(at) < 100:  # the same in fewer calls
                through = before[:, None] + step[:-1, :, None]
                back[:, here], best = through.argmax(axis=0), through.max(axis=0)
            else:
                best, origin = before[0] + step[0][:, None], back[:, here]
                for label in range(1, len(emission)):
                    other = before[label] + step[label][:, None]
                    better = other > best
                    np.copyto(origin, label, where=better)
                    np.copyto(best, other, where=better)
            score[:, here] += best
        before = score[:, here]
        begin += len(at)
    return score, back, slot


def _path(score: np.ndarray, back: np.ndarray, slot: np.ndarray, starts: np.ndarray, lengths: np.ndarray, by: int, label: np.ndarray) -> None:
    """Write the best labels of the first lines from an edge, `lengths` of each page."""
    state = np.zeros(0, np.int64)
    for at in reversed([*_steps(starts, lengths, by)]):
        place = slot[at]
        state = np.concatenate([state, score[:, place[len(state) :]].argmax(axis=0)])
        label[at] = state
        state = back[state, place].astype(np.int64)


def decoded(starts: np.ndarray, lengths: np.ndarray, top: np.ndarray, bottom: np.ndarray, step: np.ndarray, emission: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label of each line, lines of each page that belong to its top): the Viterbi paths from both edges inwards, which meet where
    they are best together.  A page of one line is all top; of others each edge has one line at least.

    A line looks otherwise from either edge, so that labels score by their odds to the body's: a line of the body weighs the same
    for both."""
    ends = starts + lengths - 1
    emission = emission - emission[BODY]
    down, up = _best(top, starts, lengths, 1, step, emission), _best(bottom, ends, lengths, -1, step, emission)
    together, other = (score.max(axis=0)[slot] for score, _, slot in (down, up))
    together[:-1] += other[1:]
    together[ends[lengths > 1]] = -np.inf  # the last line is the bottom's
    page = np.repeat(np.arange(len(starts)), lengths)
    best = np.flatnonzero(together >= np.maximum.reduceat(together, starts)[page] - 1e-6)
    aside = np.abs(2 * (best - starts[page[best]]) - (lengths[page[best]] - 2))
    best = best[np.lexsort((aside, page[best]))]  # of several the one nearest to the middle
    meet = best[np.unique(page[best], return_index=True)[1]] - starts + 1
    label = np.zeros(len(page), np.int64)
    _path(*down, starts, meet, 1, label)
    _path(*up, ends, lengths - meet, -1, label)
    label[label == INNER] = BREAK
    return label, meet


def place_of(distance, bottom):
    """One number for a line's distance from an edge and which edge it is, at any distance."""
    return (distance >> 3 << 4) | (bottom << 3) | (distance & 7)


LABELLED = "page_id string, place long, label long, number long, steady long, repeated long, wrong boolean"


def labelled(seen: DataFrame) -> DataFrame:
    """(page_id, place, label, number, steady, repeated, wrong): the lines that are not plain body, or hold a misread word or a
    number that recurs, with the label of each by the Viterbi paths from the edges inwards."""
    lines, sizes = marks(seen), seen.groupBy("document_id").agg(F.count("*").alias("size"))
    pages = seen.select("page_id", "codes", "wrong")
    packed = cut(pages.join(recurring(lines, sizes), "page_id", "left"))
    step, emission = fitted(packed)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The places of the body's outermost lines."""
        for batch in filter(len, batches):
            starts, lengths, top, bottom = laid_out(batch["codes"], batch["flags"])
            label, meet = decoded(starts, lengths, top, bottom, step, emission)
            k = np.arange(len(label)) - np.repeat(starts, lengths)
            over = k < np.repeat(meet, lengths)
            first = np.minimum.reduceat(np.where(over & (label == BODY), k, np.repeat(meet - 1, lengths)), starts)
            last = np.maximum.reduceat(np.where(~over & (label == BODY), k, np.repeat(meet, lengths)), starts)
            yield pd.DataFrame({"page_id": batch["page_id"], "first": first, "last": last})

    bounds = cut(packed.select("page_id", "codes", "flags").mapInPandas(flat.filled(around), "page_id string, first long, last long"))
    outer = lines.join(bounds, "page_id").filter((F.col("at") <= F.col("first")) | (F.col("at") >= F.col("last")))
    sentence = (F.col("at") <= F.col("first")) & (F.col("goes_on") == 3)
    outer = outer.withColumn("cores", F.when(sentence, F.lit("")).otherwise(F.col("cores"))).drop("first", "last")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            starts, lengths, top, bottom = laid_out(batch["codes"], batch["flags"])
            label, meet = decoded(starts, lengths, top, bottom, step, emission)
            page = np.repeat(np.arange(len(starts)), lengths)
            k = np.arange(len(label)) - starts[page]
            low = k >= meet[page]
            values = dict(zip(FEATURES, np.unravel_index(np.where(low, bottom, top), SIZES)))
            wrong = np.concatenate([*batch["wrong"]]).astype(bool)
            some = np.flatnonzero((label != BODY) | wrong | ((values["number"] != NONE) & (values["steady"] == 1)))
            place = place_of(np.where(low, lengths[page] - 1 - k, k), low.astype(np.int64))
            found = {"page_id": batch["page_id"].to_numpy()[page[some]], "place": place[some], "label": label[some]}
            yield pd.DataFrame(found | {n: values[n][some] for n in ("number", "steady", "repeated")} | {"wrong": wrong[some]})

    return pages.join(recurring(outer, sizes), "page_id", "left").mapInPandas(flat.filled(decode), LABELLED)


def _numbered() -> Column:
    """Whether a labelled line holds the page's printed number."""
    named = F.col("label") == HEADER
    return (F.col("number") != NONE) & (
        (F.col("label") == NUMBER) | ((F.col("number") == WITH_TEXT) & ((F.col("steady") == 1) | named))
    )


def _surveyed(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(word counts, misread types, readable pages, labelled lines), checkpointed where they are read again."""
    counts = cut(word_counts(pages))
    types = cut(misread_types(counts))
    seen = observations(pages, types)
    fair = seen.filter(F.col("readable") >= F.when(F.col("common") > 0, 0.5).otherwise(0.7))
    return counts, types, fair, cut(labelled(fair))


def scan_noise(pages: DataFrame) -> DataFrame:
    """(page_id, noise): one row per page and kind of noise.

    Null and blank texts give no row, and pages whose characters are mostly unreadable give none.  A page that stands
    twice counts once.  A null page number takes a page out of the sequence of its document, nothing else; extra columns
    are not read."""
    counts, _, fair, lines = _surveyed(pages)
    aside = F.col("label").isin(HEADER, NUMBER)
    misread = fair.filter(F.col("body_bad") > 0).select("page_id").unionByName(lines.filter(F.col("wrong") & ~aside).select("page_id"))
    found = {
        "hyphenation": broken_words(fair, counts).filter("broken"),
        "misread": misread,
        "header": lines.filter(F.col("label") == HEADER),
        "pageno": lines.filter(_numbered()),
    }
    parts = [d.select("page_id", F.lit(noise).alias("noise")) for noise, d in found.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.distinct()


def rebuilt(text: str, aside: frozenset[int], headings: frozenset[int], compounds: frozenset[str], fixes: dict[str, str], carry: str, drop: str) -> list[str]:
    """The paragraphs of a page: without its headers and page numbers (`aside`, places of lines), with its broken words
    joined, its misread words restored, the end of its last word taken from the next page (`carry`) and a first word that
    the page before has finished left out (`drop`).  Items of lists and rows of tables stay lines of their own."""
    lines = text.splitlines()
    filled = [i for i, line in enumerate(lines) if line and not line.isspace()]
    places = {i: {place_of(k, 0), place_of(len(filled) - 1 - k, 1)} for k, i in enumerate(filled)} if aside or headings else dict.fromkeys(filled, set())
    kept = [(i, lines[i].strip()) for i in filled if not places[i] & aside]
    wide = max((len(t) for _, t in kept), default=0)
    paragraphs: list[str] = []
    last = last_kind = None
    for i, line in kept:
        if drop and line[: len(drop)].lower() == drop and not line[len(drop) : len(drop) + 1].isalnum():
            line, drop = line[len(drop) :].lstrip(" .,;:") if line[len(drop) :].strip(" .,;:") else "", ""
            if not line:
                continue
        own = is_item(line) or len(CELLS.findall(line)) >= 2
        kind = "own" if own or places[i] & headings else "text"
        before = paragraphs[-1] if paragraphs else ""
        parted = bool(before) and before[-1] in BREAK_MARKS and before[-2:-1].isalnum()
        apart = last is None or kind == "own" or last_kind == "own"
        if not apart and not parted:
            blank = any(not lines[j] or lines[j].isspace() for j in range(last + 1, i))
            ended = before[-1:] in ".!?。！？" and len(lines[last].strip()) < 0.7 * wide
            apart = (blank and not line[:1].islower()) or ended
        if apart and not (parted and last_kind == kind == "text"):
            paragraphs.append(line)
        elif parted:
            left = re.search(r"[\w’'-]*$", before[:-1])[0].lower()
            right = re.match(r"[\w’'-]*", line)[0].lower()
            mark = "-" if f"{left}\n{right}" in compounds else ""
            paragraphs[-1] = before[:-1] + mark + line
        else:
            paragraphs[-1] = f"{before} {line}"
        last, last_kind = i, kind
    if carry and paragraphs and paragraphs[-1][-1] in BREAK_MARKS:
        paragraphs[-1] = paragraphs[-1][:-1] + carry
    if fixes:
        paragraphs = [re.sub(r"\S+", lambda m: _restored(m[0], fixes), p) for p in paragraphs]
    return paragraphs


def _restored(token: str, fixes: dict[str, str]) -> str:
    word = token.strip(AROUND)
    true = fixes.get(word.lower())
    if not true:
        return token
    true = true.upper() if word.isupper() and len(word) > 1 else true.capitalize() if word[:1].isupper() else true
    return token.replace(word, true, 1)


def repaired(pages: DataFrame) -> DataFrame:
    """(page_id, paragraphs, text): each page's text as continuous paragraphs, parted by blank lines.

    Unreadable and blank pages give no row, a page that stands twice gives one.  What a page needs is joined to its text by
    its id: no table of words or lines is sent to the tasks."""
    counts, types, fair, lines = _surveyed(pages)
    off = lines.filter((F.col("label") == HEADER) | (_numbered() & (F.col("label") != BODY)))
    off = off.groupBy("page_id").agg(F.collect_list("place").alias("aside"))
    heads = lines.filter(F.col("label") == BREAK).groupBy("page_id").agg(F.collect_list("place").alias("headings"))
    words = cut(broken_words(fair, counts))
    joined = F.concat("left", F.lit("\n"), "right")
    compounds = words.filter(F.col("next_page").isNull() & ~F.col("broken")).groupBy("page_id").agg(F.collect_set(joined).alias("compounds"))
    across = words.filter(F.col("broken") & (F.col("next_page") != ""))
    carry = across.groupBy("page_id").agg(F.min("right").alias("carry"))
    drop = across.groupBy(F.col("next_page").alias("page_id")).agg(F.min("right").alias("drop"))
    wrong = fair.select("page_id", F.explode("bad_words").alias("word")).join(types, "word")
    fixes = wrong.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "true_word"))).alias("fixes"))
    plan = fair.select("page_id")
    for part in (off, heads, compounds, carry, drop, fixes):
        plan = plan.join(part, "page_id", "left")
    once = pages.select("page_id", "text").filter(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("text").alias("text"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def some(x):
            return x if isinstance(x, (str, dict)) else () if x is None or isinstance(x, float) else x

        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                done = rebuilt(
                    r.text, frozenset(some(r.aside)), frozenset(some(r.headings)), frozenset(some(r.compounds)), dict(some(r.fixes)), some(r.carry) or "", some(r.drop) or ""
                )
                rows.append((r.page_id, len(done), "\n\n".join(done)))
            yield pd.DataFrame(rows, columns=["page_id", "paragraphs", "text"])

    needed = once.join(plan, "page_id").select("page_id", "text", "aside", "headings", "compounds", "fixes", "carry", "drop")
    return needed.mapInPandas(flat.filled(build), "page_id string, paragraphs int, text string")


def p1_found(spark, sf_dir: str) -> DataFrame:
    return scan_noise(spark.read.parquet(f"{sf_dir}/page_results.parquet"))


def p1_paragraphs(spark, sf_dir: str) -> DataFrame:
    return repaired(spark.read.parquet(f"{sf_dir}/page_results.parquet"))


QUERIES = {"p1_found": p1_found, "p1_paragraphs": p1_paragraphs}
SQL: dict[str, str] = {}
