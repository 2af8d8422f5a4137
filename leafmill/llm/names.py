"""Problem 6: variant spellings of names typed by people.

Names become vectors of hashed character n-grams, weighted by their rarity over all forms of the
registry.  The different names of the cards and the registry's forms meet in a block-wise sparse cosine
join; every pair of at least the threshold is kept, however many there are.  A comparison of the parts of
the two names follows, which refuses what only looks alike: another first name, another line of business.
The forms of an entity are a cluster; of the clusters that remain a card joins the one of the greatest
average linkage, that is, the mean cosine to all forms of the entity.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.lineage import cut
from leafmill.llm import flat

#: Registry entries and different names that meet in one group of the join, about.
BLOCK_ENTRIES, BLOCK_NAMES = 10_000, 20_000
#: Least cosine of a name and one of an entity's forms.
LEAST = 0.25
#: Bits of the hash of an n-gram of either length.
BITS = 16
#: Cosines that one matrix holds.
CELLS = 1 << 21
#: Parts into which the cards of one name are dealt.
SALT = 32

# --- Fixed values: familiar forms of first names, titles, legal forms and their short forms. ------------------------

FAMILIAR = """
abigail abby gail|adrian ade|agnes aggie nessa|albert al bert bertie|alexander alex sandy xander alec|alice ali allie|amanda mandy|andrew andy drew
|angela angie|ann anne anna annie nan|anthony tony ant|arthur art artie|barbara barb babs barbie|benjamin ben benny benji|bernard bernie|beth bess
|caroline carol carrie|catherine cathy cate kate katie kitty cat|charles charlie chuck chas|charlotte lottie charlie|christina chris tina chrissie christy
|christopher chris kit topher|daniel dan danny|david dave davy|deborah deb debbie debra|dominic dom nick|donald don donny|dorothy dot dottie dolly
|edith edie|edward ed eddie ned ted teddy|eleanor ellie nell nora lena|elizabeth liz beth betty lizzie eliza lisa bess betsy libby|emily em emmy millie
|eric rick|ernest ernie|eugene gene|evelyn eve evie|florence flo flossie|frances fran frankie fanny|francis frank|frederick fred freddie rick|gabriel gabe
|george georgie|gerald gerry jerry|gertrude trudy gert|gregory greg gregg|hannah hanna annie|harold harry hal|helen nell nellie|helena lena helen nell
|henry hank harry hal|irene rene|isabella bella izzy isabel belle|jacob jake jack|james jim jimmy jamie|jane janie jenny|jennifer jen jenny jenn
|jeremy jerry|jessica jess jessie|john jack johnny jon|jonathan jon jonny nathan|joseph joe joey|josé pepe|judith judy jude|julia julie jules|jürgen jurg
|karen kari|katherine kathy kate katie kat kay kitty|kenneth ken kenny|larry lars|laura laurie|lawrence larry lorry laurie|leonard leo len lenny|louise lou lulu
|madeleine maddie|margaret peggy meg maggie marge margie greta rita daisy|maria mary mia|martha marty patty|martin marty|matthew matt matty|maximilian max
|michael mike mick mickey|miriam mimi mim miri|monica mona|natalie nat nattie|nathaniel nat nate|nicholas nick nicky nico|nicole nicky nikki|norman norm
|oliver ollie|olivia liv livvy ollie|oscar ozzie oz|pamela pam pammy|patricia pat patty tricia trish|patrick pat paddy rick|paula polly|peter pete petey
|philip phil pip|philippa pippa pip phil|phyllis phyl|rachel rae rach|raymond ray|rebecca becky becca beck|renée rene|richard rick dick rich richie ricky
|robert rob bob bobby robbie bert|roger rog|ronald ron ronnie|rosalind ros roz rosie|rose rosie|rosemary rosie rose|russell russ|ruth ruthie|samuel sam sammy
|samantha sam|sandra sandy|sarah sally sadie|sebastian seb bas|sophia sophie soph|stephanie steph|stephen steve stevie|steven steve|susan sue susie suzy
|susanna sue susie suzy anna sanna|theodore ted teddy theo|theresa terry tess tessa|thomas tom tommy|timothy tim timmy|ursula ursa urs|veronica vera ronnie nica
|victor vic|victoria vicky tori vic|vincent vin vince vinnie|virginia ginny|walter walt wally|william will bill billy liam willie|zachary zach zack zac
"""
TITLES = frozenset("mr mrs ms miss mx dr prof professor sir dame lord lady rev capt captain sgt lt col gen herr frau mme mlle sr sra jr hon".split())
LEGAL = {
    "inc": "inc", "incorporated": "inc", "ltd": "ltd", "limited": "ltd", "llc": "llc", "gmbh": "gmbh", "coop": "cooperative",
    "cooperative": "cooperative", "co": "co", "company": "co", "corp": "corp", "corporation": "corp", "group": "group", "grp": "group",
    "gp": "group", "gr": "group", "holdings": "holdings", "hldgs": "holdings", "holding": "holdings", "hldg": "holdings", "trust": "trust", "tr": "trust", "trst": "trust",
    "plc": "plc", "ag": "ag", "sa": "sa", "firm": "co", "the": "", "and": "",
}
LETTERS = str.maketrans({"ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d", "ð": "d", "þ": "th", "ı": "i"})


@functools.cache
def families() -> dict[str, frozenset[int]]:
    """The groups of first names that each first name, full or familiar, belongs to."""
    found: dict[str, set[int]] = {}
    for i, group in enumerate(FAMILIAR.replace("\n", " ").split("|")):
        for name in group.split():
            found.setdefault(folded(name), set()).add(i)
    return {k: frozenset(v) for k, v in found.items()}


@functools.cache
def full_first() -> frozenset[str]:
    """First names in full."""
    return frozenset(folded(g.split()[0]) for g in FAMILIAR.replace("\n", " ").split("|") if g.split())


def folded(text: str) -> str:
    """Lower case without marks on letters."""
    text = unicodedata.normalize("NFKD", text.casefold().translate(LETTERS))
    return "".join(c for c in text if not unicodedata.combining(c))


def parts(name: str) -> tuple[list[str], list[bool], bool]:
    """(tokens, which of them ended in a dot, whether a comma parted them), without titles, places in brackets or dots."""
    text = folded(re.sub(r"[(\[].*?[)\]]", " ", name)).replace("s/w", "sw")
    comma = "," in text
    text = re.sub(r"\b(?:[a-z]\.\s?){3,}", lambda m: re.sub(r"[^a-z]", "", m.group()) + " ", text)
    tokens, dots = [], []
    for m in re.finditer(r"([^\W_]+(?:['’-][^\W_]+)*)(\.?)", text):
        word = re.sub(r"[^a-z0-9]", "", m[1]) or m[1]
        if word in TITLES and len(tokens) < 2 and not (m[2] and word in ("lt", "gen", "col")):
            continue
        tokens.append(word)
        dots.append(bool(m[2]))
    return tokens, dots, comma


def distance(a: str, b: str, most: int) -> int:
    """Edits, neighbouring letters swapped counting as one, or most + 1."""
    if a == b:
        return 0
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    if abs(len(a) - len(b)) > most or len(set(a) ^ set(b)) > 2 * most:
        return most + 1
    # bit vectors of the columns of the table of distances, a bit for each letter of `a`
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, same, before, total = full, 0, 0, 0, len(a)
    for c in b:
        at = where.get(c, 0)
        same = (((at & up) + up) ^ up) | at | down | (((~same & at) << 1) & before)
        plus, minus = down | (~(same | up) & full), same & up
        total += ((plus & last) != 0) - ((minus & last) != 0)
        plus, minus = ((plus << 1) | 1) & full, (minus << 1) & full
        up, down = minus | (~(same | plus) & full), plus & same
        before = at
    return min(total, most + 1)


def allowed(length: int) -> int:
    """Edits that typing may have made to a word."""
    return 0 if length < 4 else 1 if length < 7 else 2 if length < 14 else 3


def plain_umlauts(word: str) -> str:
    """A word with ae, oe and ue as one letter, as typed for the German letters."""
    return word.replace("oe", "o").replace("ue", "u").replace("ae", "a")


@functools.lru_cache(1 << 16)
def pairs_of(word: str) -> frozenset[str]:
    """The pairs of neighbouring letters of a word; an edit changes three of them at most."""
    return frozenset(map("".join, itertools.pairwise(word)))


def holds(word: str, part: str, edits: int = 2) -> bool:
    """Whether a word may hold a part but for some edits; False is certain."""
    return len(pairs_of(word) & pairs_of(part)) >= len(pairs_of(part)) - 3 * edits


def alike(a: str, b: str) -> bool:
    """Whether one word may be the other with typing errors."""
    if a == b:
        return True
    most = allowed(max(len(a), len(b)))
    if not most:
        return False
    p, q = plain_umlauts(a), plain_umlauts(b)
    return (holds(a, b, most) and distance(a, b, most) <= most) or (holds(p, q, most) and distance(p, q, most) <= most - (most > 1))


def same_first(token: str, dotted: bool, first: str) -> bool:
    """Whether a token may stand for a first name: itself, an initial, a short or familiar form, or with typing errors."""
    if token == first or token == first[0]:
        return True
    groups = families()
    mine, other = groups.get(token, frozenset()), groups.get(first, frozenset())
    if mine & other:
        return True
    if token in full_first() and first in full_first():
        return False
    if first.startswith(token) and (dotted or len(token) >= 3):
        return True
    if mine and not mine & other and token not in first:
        return False
    return len(token) >= 4 and alike(token, first)


def abbreviates(token: str, word: str) -> bool:
    """Whether a token is a word, its beginning, its letters with some left out, or it with typing errors."""
    if token == word or (len(token) >= 3 and (word.startswith(token) or (token.startswith(word) and len(word) >= 5))):
        return True
    if len(token) >= 2 and token[0] == word[0] and len(token) < len(word):
        rest = iter(word)
        if all(c in rest for c in token) and len(token) <= len(word) * 0.75:
            return True
    return len(word) >= 5 and len(token) >= 4 and alike(token, word)


class Word:
    """The word of an entity's name that must stand in any spelling of it, for a cheap look before names are compared."""

    def __init__(self, word: str):
        self.pairs = [pairs_of(w) for w in {word, plain_umlauts(word)}]
        edits = max(2, allowed(len(word) + 3))
        self.least = [len(p) - 3 * edits for p in self.pairs]

    def may_stand_in(self, pairs: frozenset[str]) -> bool:
        """Whether a name of these pairs of letters may hold the word, typing errors granted; False is certain."""
        return any(len(pairs & p) >= n for p, n in zip(self.pairs, self.least))


class Person:
    def __init__(self, name: str):
        tokens, _, _ = parts(name)
        self.first, self.last = (tokens[0], tokens[-1]) if len(tokens) > 1 else ("", tokens[0] if tokens else "")
        self.middle = tokens[1][0] if len(tokens) > 2 else ""
        self.word = Word(self.last)

    def verdict(self, tokens: list[str], dots: list[bool], comma: bool) -> int:
        """2: the same name; 1: nothing against it; 0: the surname is another; -1: the surname fits, the first name does not."""
        if not tokens or not self.last or not self.first:
            return 0
        if len(tokens) == 1:
            return 2 if self._glued(tokens[0]) else 0
        order = [len(tokens) - 1, 0, *range(1, len(tokens) - 1)]
        at = next((i for i in order if tokens[i] == self.last), None)
        if at is None:
            at = next((i for i in order if len(tokens[i]) > 3 and alike(tokens[i], self.last)), None)
        if at is None:
            joined = "".join(tokens)
            return 2 if self._glued(joined) else 0
        rest = [(t, d) for i, (t, d) in enumerate(zip(tokens, dots)) if i != at]
        token, dot = rest[0]
        if len(rest) > 1 and len(token) == 1 and len(rest[1][0]) > 1 and not same_first(token, dot, self.first):
            token, dot = rest[1]
        if not same_first(token, dot, self.first):
            return -1
        initials = [t for t, _ in rest[1:] if len(t) == 1]
        if self.middle and initials and initials[0] != self.middle:
            return -1
        return 2

    @functools.cached_property
    def _names(self) -> list[str]:
        return sorted({self.first} | {n for n, g in families().items() if g & families().get(self.first, frozenset())})

    def _glued(self, word: str) -> bool:
        if not holds(word, self.last):
            return False
        for name in self._names:
            for form in (name + self.last, self.last + name):
                if word == form or (name == self.first or len(name) > 2) and abs(len(word) - len(form)) < 3 and distance(word, form, 2) <= 2:
                    if name != self.first or not any(
                        word.startswith(n) or word.endswith(n) for n in full_first() if n != self.first and len(n) > 3 and n not in self.last and not self.first.startswith(n)
                    ):
                        return True
            middle = name + self.middle + self.last
            if self.middle and word == middle:
                return True
        return False


class Firm:
    def __init__(self, name: str):
        tokens, _, _ = parts(name)
        tokens = [t for t in tokens if t != "the"]
        self.legal = [LEGAL[t] for t in tokens[1:] if LEGAL.get(t)]
        core = [t for i, t in enumerate(tokens) if i == 0 or t not in LEGAL]
        self.name, self.trade = (core[0] if core else ""), core[1:]
        self.word = Word(self.name)
        words = [self.name, *self.trade, *(t for t in tokens[1:] if t in LEGAL)]
        self.acronyms = {self.name[:3] + "".join(w[0] for w in words[1:]), self.name[:2] + "".join(w[0] for w in words[1:])} if len(words) > 1 else set()

    def verdict(self, tokens: list[str], dots: list[bool], comma: bool) -> int:
        if not tokens or not self.name:
            return 0
        if len(tokens) == 1:
            word = tokens[0]
            if word in self.acronyms and len(word) >= 4:
                return 2
            return 2 if self._glued(word) else 0
        if len("".join(tokens)) <= 7 and "".join(tokens) in self.acronyms:
            return 2
        rest = [t for t in tokens if t not in LEGAL]
        at = next((i for i, t in enumerate(rest) if t == self.name), None)
        if at is None:
            at = next((i for i, t in enumerate(rest) if len(t) > 3 and alike(t, self.name)), None)
        if at is None:
            return 2 if self._glued("".join(rest)) else 0
        others = [t for i, t in enumerate(rest) if i != at]
        if not self.trade:
            return 2 if not others else -1
        if not others:
            return 1
        return 2 if all(any(abbreviates(o, t) for t in self.trade) for o in others) else -1

    def _glued(self, word: str) -> bool:
        if not holds(word, self.name):
            return False
        tails = ["", *self.legal, "".join(self.legal)]
        for tail in tails:
            form = self.name + "".join(self.trade) + tail
            if self.trade and (word == form or distance(word, form, 2) <= 2 and word[-4:] == form[-4:]):
                return True
        return False


def plain(name: str) -> str:
    """A name as its n-grams read it: folded, without places in brackets, spaces and marks."""
    return re.sub(r"[^a-z0-9]", "", plain_umlauts(folded(re.sub(r"[(\[].*?[)\]]", " ", name)))) or folded(name).strip()


def grams(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, count): the hashed two- and three-character pieces of each name, marked at its ends."""
    codes, starts, lengths = flat.join([f"^{plain(n)}$" for n in names], "\n")
    row = np.repeat(np.arange(len(names)), lengths + 1)
    found = []
    for k, n in enumerate((2, 3)):
        h = flat.gram_hash(codes, n, BITS).astype(np.int64) + (k << BITS)
        inside = row[: len(h)] == row[n - 1 :]
        inside &= codes[n - 1 :] != 10
        found.append((row[: len(h)][inside] << (BITS + 1)) | h[inside])
    key, count = np.unique(np.concatenate(found), return_counts=True)
    return key >> (BITS + 1), key & ((1 << (BITS + 1)) - 1), count


def weighted(names: list[str], rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, weight): the unit vectors of names."""
    row, gram, count = grams(names)
    weight = (1 + np.log(count)) * rarity[gram]
    norm = np.sqrt(np.bincount(row, weight**2, minlength=len(names)))
    return row, gram, weight / np.maximum(norm[row], 1e-9)


def model(kind: str, name: str) -> Person | Firm:
    return Firm(name) if kind == "organization" else Person(name)


def forms(kind: str, name: str, aliases: list[str]) -> list[str]:
    """The spellings of an entry that are known: its name, its aliases and, of a firm, its acronyms."""
    return list(dict.fromkeys([name, *aliases, *sorted(getattr(model(kind, name), "acronyms", ()))]))


class Block:
    """The forms of some registry entries as sparse n-gram vectors, with their postings by n-gram."""

    def __init__(self, ids: list[str], names: list[str], kinds: list[str], aliases: list[list[str]], rarity: np.ndarray):
        self.ids, self.rarity = ids, rarity
        self.model = [model(k, n) for k, n in zip(kinds, names)]
        own = [forms(k, n, a) for k, n, a in zip(kinds, names, aliases)]
        self.spread = np.array([len(x) for x in own], np.int64)
        self.first = np.cumsum(self.spread) - self.spread
        form, gram, weight = weighted([x for f in own for x in f], rarity)
        order = np.argsort(gram, kind="stable")
        self.form, self.weight = form[order], weight[order].astype(np.float32)
        self.start = np.searchsorted(gram[order], np.arange(len(rarity) + 1))
        self.n = int(self.spread.sum())

    def near(self, names: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(name, entries, linkage): for each name the entries with a form of at least LEAST, and the mean cosine of all of
        an entry's forms to it."""
        step = max(1, CELLS // max(1, self.n))
        for a in range(0, len(names), step):
            part = names[a : a + step]
            row, gram, weight = weighted(part, self.rarity)
            length = self.start[gram + 1] - self.start[gram]
            at = np.repeat(self.start[gram] - np.cumsum(length) + length, length) + np.arange(length.sum())
            cosine = np.bincount(
                np.repeat(row, length) * self.n + self.form[at], np.repeat(weight, length) * self.weight[at], minlength=len(part) * self.n
            ).reshape(len(part), self.n)
            best = np.maximum.reduceat(cosine, self.first, axis=1)
            mean = np.add.reduceat(cosine, self.first, axis=1) / self.spread
            r, k = np.nonzero(best >= LEAST)
            ends = np.searchsorted(r, np.arange(len(part) + 1))
            for i, (x, y) in enumerate(itertools.pairwise(ends)):
                yield a + i, k[x:y], mean[i, k[x:y]]

    def verdicts(self, names: list[str]) -> Iterator[tuple[str, str, int, float]]:
        """(name, entity_id, verdict, linkage) where a verdict speaks for or against an entry."""
        for i, entries, linkage in self.near(names):
            told = parts(names[i])
            joined = "".join(told[0])
            pairs = pairs_of(joined) | pairs_of(plain_umlauts(joined))
            for e, s in zip(entries.tolist(), linkage.tolist()):
                # short words may be acronyms
                if len(joined) > 7 and not self.model[e].word.may_stand_in(pairs):
                    continue
                verdict = self.model[e].verdict(*told)
                if verdict in (2, -1):
                    yield names[i], self.ids[e], verdict, s


def entries(registry: DataFrame) -> DataFrame:
    """(entity_id, canonical_name, kind, aliases) of the entries that have an id and a name, each id once."""
    rows = registry.select("entity_id", "canonical_name", "kind", "aliases").filter(
        F.col("entity_id").isNotNull() & (F.trim("canonical_name") != "")
    )
    first = F.min(F.struct("canonical_name", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases")))
    return rows.groupBy("entity_id").agg(first.alias("e")).select("entity_id", "e.canonical_name", "e.kind", F.filter("e.aliases", lambda x: F.trim(x) != "").alias("aliases"))


def rarity(listed: DataFrame) -> np.ndarray:
    """The weight of each hashed n-gram over all forms of the registry: at most 2 * 2**BITS numbers, whatever its size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(2 << BITS, np.int64), 0
        for batch in batches:
            own = [f for k, name, a in zip(batch["kind"], batch["canonical_name"], batch["aliases"]) for f in forms(k, name, list(a))]
            seen += np.bincount(grams(own)[1], minlength=2 << BITS)
            n += len(own)
        held = np.flatnonzero(seen)
        yield pd.DataFrame({"gram": np.append(held, -1), "n": np.append(seen[held], n)})

    counts = np.zeros((2 << BITS) + 1)
    for row in listed.mapInPandas(flat.filled(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row.gram] = row.n
    # never near zero: an n-gram that all entries of a registry hold still makes names alike
    return (1 + np.log(1 + counts[-1] / np.maximum(1.0, counts[:-1])) / 2).astype(np.float32)


def _compared(names: DataFrame, listed: DataFrame) -> DataFrame:
    """(name, entity_id, verdict, linkage): the sparse cosine join of names and registry entries and the comparison of its pairs.

    Both sides are dealt into blocks of bounded size, and each block of names meets each block of entries in one task.  Weights
    are those of the whole registry and no list is cut, so the result is the same for any number of blocks."""
    blocks, parts = max(1, -(-listed.count() // BLOCK_ENTRIES)), max(1, -(-names.count() // BLOCK_NAMES))
    weights = listed.sparkSession.sparkContext.broadcast(rarity(listed))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["name", "entity_id", "verdict", "linkage"])
        right = right.sort_values("entity_id")
        block = Block(right["entity_id"].tolist(), right["canonical_name"].tolist(), right["kind"].tolist(), [list(a) for a in right["aliases"]], weights.value)
        return pd.DataFrame(block.verdicts(left["name"].tolist()), columns=["name", "entity_id", "verdict", "linkage"])

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = names.select("name", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int").alias("part"), every(blocks).alias("block"))
    right = listed.select("*", F.pmod(F.xxhash64("entity_id"), F.lit(blocks)).cast("int").alias("block"), every(parts).alias("part"))
    both = left.groupBy("part", "block").cogroup(right.groupBy("part", "block"))
    return both.applyInPandas(meet, "name string, entity_id string, verdict int, linkage double")


def linked_cards(cards: DataFrame, registry: DataFrame) -> DataFrame:
    """(card_id, entity_id): each card with the registry entry that it means; cards without one give no row.

    An entry qualifies by the card's name, or by an alias where the name leaves it open; an alias or a name that fits an entry
    but for its first name or trade speaks against it.  Of several the one found by the name, then the best linkage wins, ties
    going to the lesser id.  The kind of a card is often wrong or missing and is not read.  Null and blank names match by their
    aliases only.  Repeated cards give one row.  An empty registry gives no rows; extra columns are not read.

    Each different name is compared once.  A name that very many cards bear is dealt into SALT parts where cards and verdicts meet."""
    typed = F.array_compact(F.concat(F.array(F.struct(F.lit(1.0).alias("weight"), F.col("canonical_name").alias("name"))), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(F.lit(0.5).alias("weight"), a.alias("name")))))
    salt = F.pmod(F.xxhash64("card_id"), F.lit(SALT)).cast("int")
    spelled = cards.select(F.col("card_id").cast("long").alias("card_id"), F.explode(typed).alias("t")).select("card_id", "t.weight", "t.name", salt.alias("salt"))
    spelled = spelled.filter(F.trim("name") != "")
    names = cut(spelled.groupBy("name").agg(F.collect_set("salt").alias("salts")))
    told = _compared(names, cut(entries(registry)))
    said = told.groupBy("name").agg(F.collect_list(F.struct("entity_id", "verdict", "linkage")).alias("said"))
    said = said.join(names, "name").select("name", F.explode("salts").alias("salt"), "said")
    met = spelled.join(said, ["name", "salt"]).select("card_id", "weight", F.explode("said").alias("s")).select("card_id", "weight", "s.*")
    pro = F.col("verdict") == 2
    scored = met.groupBy("card_id", "entity_id").agg(
        F.max(F.when(pro, F.col("weight"))).alias("by"), F.max(F.when(pro, F.col("weight") * F.col("linkage"))).alias("linkage"), F.count_if(~pro).alias("against")
    )
    good = scored.filter(F.col("by").isNotNull() & (F.col("against") == 0))
    best = F.min(F.struct((-F.col("by")).alias("by"), (-F.col("linkage")).alias("linkage"), "entity_id"))
    return good.groupBy("card_id").agg(best["entity_id"].alias("entity_id"))


def p6_found(spark, sf_dir: str) -> DataFrame:
    cards = spark.read.parquet(f"{sf_dir}/entity_cards.parquet")
    return linked_cards(cards, spark.read.parquet(f"{sf_dir}/entity_registry.parquet"))


QUERIES = {"p6_found": p6_found}
SQL: dict[str, str] = {}
