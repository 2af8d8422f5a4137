"""Problem 5: personal information inside free text.

Generators of high recall propose overlapping spans of e-mail addresses, phone numbers, identity
numbers, street addresses and names.  Boosted trees score every span by its format and by the words
around it; of overlapping spans the likeliest wins, if it reaches the threshold of its type.  The
trees are fitted on sentences that a seeded generator writes, personal items and look-alikes among
them, and the thresholds are set on further sentences of that generator.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import pickle
import random
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.lineage import artifact
from leafmill.llm import boosting, flat
from leafmill.llm.boosting import BoostedTrees
from leafmill.session import spread

#: Sentences written to fit the trees, and to set the thresholds; both bound the work of fitting.
FIT_SENTENCES, HELD_SENTENCES = 9_000, 3_000
TYPES = ("email", "phone", "id_number", "street_address", "person_name")

# --- Fixed values: words that stand around or in personal items. ---------------------------------------------------

FIRST_NAMES = """
adam adrian agnes albert alexander alice amanda andrew angela anna anne anthony arthur barbara benjamin bernard beth boris brian
carl carol caroline catherine charles charlotte christian christina christopher claire daniel david deborah dennis diana dominic
donald dorothy edith edward eleanor elena elizabeth ellen emil emily emma eric ernest eva evelyn felix florence frances frank frederick
gabriel george gerald gloria grace greta gregory hannah harold harriet helen helena henry howard hugo ian ida ingrid irene isaac
isabella jack jacob james jane janet jason jean jeffrey jennifer jessica joan john jonas jonathan jorge joseph josé joyce judith judy
julia jürgen karen karl katherine kathleen keith kenneth kevin larry laura lawrence leonard liam linda lisa louis louise luca lucas lucy
luka luke madeleine manuel marcus margaret maria marie mark martha martin mary mateo matthew max maximilian megan michael miriam monica
natalie nathan nicholas nicole nina noah nora norman oliver olivia oscar otto pablo pamela patricia patrick paul paula peter philip
philippa phyllis rachel ralph raymond rebecca renée richard robert roger rosa rosalind rosemary roy ruth samuel sandra sara sarah
sebastian sharon simon sofia sophia sophie søren stefan stephanie stephen steven susan susanna sven sylvia teresa theodore theresa
thomas timothy ursula valerie vera veronica victor victoria vincent virginia walter wendy william yvonne zachary zoe
"""
TITLES = "mr mrs ms miss mx dr prof professor sir dame lady lord rev reverend father sister brother capt captain sgt herr frau fräulein mme mlle monsieur madame señor señora señorita sr sra don doña"
ORGANISATION = (
    "ltd llc inc gmbh group holdings trust cooperative company co corp corporation plc ag foods logistics dental pharma shipping glass"
    " energy timber textiles software security analytics catering printing instruments marine bank university hospital school council"
    " office board committee team crew desk department ministry agency foundation institute association union club society works depot"
)
STREETS = (
    "street|st|road|rd|lane|ln|avenue|ave|boulevard|blvd|drive|dr|way|place|pl|square|sq|court|ct|crescent|cres|terrace|close|row|hill"
    "|quay|gardens|grove|mews|walk|parade|highway|parkway|alley|wynd|wharf"
)
CUES = {
    "email": "mail|e-mail|mailto|email|write|contact|reply|address|cc|bcc|courriel|correo",
    "phone": "tel|phone|telephone|mobile|cell|fax|rang|ring|call|called|dial|reachable|reach|hotline|whatsapp|sms|text|téléphone|telefon|teléfono|móvil",
    "id": "id|ssn|identity|passport|licence|license|insurance|security|national|social|permit|tax|ausweis|reisepass|passeport|pasaporte|dni|nie|nif|cpf|bsn|pesel|card|personal|identification|driver's|personnummer|steuernummer",
    "home": "lives|living|lived|residing|resident|moved|home|delivered|deliver|keys|address|adresse|dirección|wohnhaft|domicilio|domicile|demeurant|anschrift|left|sent|house|post|parcel",
    "person": "employee|handed|according|told|signed|patient|tenant|witness|spoke|behalf|attn|attention|owner|applicant|colleague|named|interview|mother|father|son|daughter|wife|husband|care|by|ask|met|with|dear|regards|visited|nurse|teacher|driver|approved|collected|from|for",
    "other": "invoice|bill|part|parts|numbers|reference|ref|order|batch|build|version|meter|gauge|reading|section|paragraph|file|article|item|items|serial|lot|case|docket|room|total|price|list|units|numéro|rechnung|factura|chapter|page|row|account|code",
    "organisation": "firm|company|supplier|vendor|branch|works|depot",
}
AFTER = "kwh|kg|km|m|ml|litres|liters|units|percent|euro|dollars|pages|copies|days|hours|degrees|millimetres|metres|visitors|each|per|pieces|points|votes|was|were|had|has|is|are"
#: What persons do, right after their names.
DOES = "signed called wrote said says asked told attended replied came left met lives works visited has was is will agreed knows thanks"
#: Capitalised words that begin sentences or name dates and places in an address, not persons.
NO_NAME = (
    "january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday"
    " north south east west new old upper lower great little saint dear regards sincerely please thank thanks page chapter section figure table box flat unit"
    " invoice order reference file case account serial number street road lane avenue dossier expediente vorgang office hall library museum hotel station airport"
    " when where while after before since until although however meanwhile according because during under over both each all some any every no not only then there"
    " here now today yesterday tomorrow he she they we you i his her their our my your who what which why how if but or so as"
)

# --- Generators -----------------------------------------------------------------------------------------------------

_L = r"[^\W\d_]"
_CAP = rf"(?:{_L}[^\W\d_’'-]*(?:[’'-]{_L}+)*)"
AT = re.compile(r"\s?@\s?|\s?[(\[{]\s?at\s?[)\]}]\s?|(?<=\w) at (?=[\w-]+ dot |[\w.-]+\.(?:com|org|net|example|test|invalid)\b)")
_DOT = r"(?:\.| dot |\s?[(\[{]\s?dot\s?[)\]}]\s?)"
USER = re.compile(rf"[\w+-]+(?:{_DOT}[\w+-]+)*$")
HOST = re.compile(rf"[\w-]+(?:(?:{_DOT}|\s\.\s?)[\w-]+)+")
NUMBER = re.compile(
    r"(?<![\w@.,/+-])(?:(?!(?:ID|NO|NR|PO|TA)\b)[A-Z]{1,2}[ -]?)?(?:\+|\((?=\+?\d+\))\+?|00)?\d+\)?(?:[ ./-]?(?:\(\d+\)|\d+))+(?:[ -]?[A-Z](?![\w]))?(?![\w@])"
)
DATE = re.compile(r"^(?:\d{4}-\d\d?-\d\d?|\d\d?[./]\d\d?[./]\d{2,4}|(?:19|20)\d\d)$")
BOXES, WAYS_BEFORE, WAYS_AFTER, WAYS_OF = r"p\.?\s?o\.?\s?box|postfach|bo[iî]te postale|apartado", "calle|avenida|plaza|paseo|camino|carrera|via|viale|piazza", "rue|avenue|boulevard|place|chemin|impasse|allée|quai|route", "am|an der|auf dem|in der"
ADDRESS = re.compile(
    rf"(?:\b(?:flat|apt\.?|apartment|unit|suite|room)\s\w+,\s)?\b\d{{1,5}}[a-z]?,?\s(?:{_L}[\w’'.-]*\s){{1,3}}(?:{STREETS})\b\.?"
    rf"|\b(?:{BOXES})\s\d+"
    rf"|\b(?:{WAYS_BEFORE})\s(?:{_L}[\w’'-]*\s){{1,4}}\d+"
    rf"|\b\d{{1,4}}(?:\sbis)?,?\s(?:{WAYS_AFTER})\s(?:{_L}[\w’'-]*\s?){{1,4}}"
    rf"|\b(?:{WAYS_OF})\s{_L}+\s\d+\w?,\s\d{{5}}"
)
#: What a text with an address holds, of the same alternatives; cheaper to look for than the address.
ADDRESS_SIGN = re.compile(rf"\s(?:{STREETS}|{WAYS_AFTER})\b|\b(?:{BOXES}|{WAYS_BEFORE})\s|\b(?:{WAYS_OF})\s{_L}+\s\d")
WAY = re.compile(r"(?:weg|straße|strasse|str\.|platz|allee|gasse|ring|ufer|damm)\s\d+\w?")
WAY_START = re.compile(rf"{_L}+$")
#: A house number, words with a capital and a comma before a place: a street of a kind that has no word of its own here.
HOUSE = re.compile(r"(?<![\w.,/-])\d{1,4}[a-z]?,?\s(?:[A-ZÀ-Þ][\w’'-]+\s?){1,3}(?=,\s[A-ZÀ-Þ])")

def _trie(words: list[str]) -> str:
    """An alternation of words that branches letter by letter at its first two letters."""
    groups: dict[str, dict[str, list[str]]] = {}
    for w in sorted(words, reverse=True):
        groups.setdefault(w[0], {}).setdefault(w[1:2], []).append(w[2:])
    return "|".join(
        a + "(?:" + "|".join(b + "(?:" + "|".join(map(re.escape, rest)) + ")" for b, rest in g.items()) + ")" for a, g in groups.items()
    )


_FIRST = _trie(sorted(set(FIRST_NAMES.split())))
_PARTICLE = r"(?:(?:van|von|de|del|della|da|di|la|le|der|den|ten|ter|al|bin|o’|o')\s)*"
FORENAME = re.compile(rf"\b(?:{_FIRST})(?:-{_L}+)?\b(?![@_+])")
AFTER_FIRST = re.compile(rf"(?:\s{_L}\.?)?\s+{_PARTICLE}{_CAP}")
BEFORE_FIRST = re.compile(rf"(?<![\w@.]){_CAP},\s$")
INITIAL = re.compile(rf"(?<![\w.@-])(?:[A-ZÀ-Þ]\.\s?){{1,3}}{_PARTICLE}[A-ZÀ-Þ][\w’'-]+")
LAST_INITIAL = re.compile(r"(?<![\w.@-])[A-ZÀ-Þ][\w’'-]+,\s(?:[A-ZÀ-Þ]\.\s?){1,3}(?!\w)")
TITLE = re.compile(rf"\b(?:{_trie(sorted(set(TITLES.split())))})\b\.?\s+")
_UP = r"[A-ZÀ-Þ][\w’'-]*"
TITLED_NAME = re.compile(rf"(?:{_L}\.\s?)?{_PARTICLE}{_CAP}")
TITLED_MORE = re.compile(rf"(?:\s{_L}\.)?\s{_PARTICLE}{_UP}")
#: Two to four words with capitals in a row; which of them are a name, if any, is for the trees to say.
CAPITALS = re.compile(rf"(?<![\w@.’'-]){_UP}(?:[ \u00a0](?:[A-ZÀ-Þ]\.[ \u00a0])?{_PARTICLE}{_UP}){{1,3}}")
CUE = re.compile(r"\b(?:handed to|as told by|told by|signed by|approved by|collected by|for the patient|patient|tenant|witness|employee|spoke (?:to|with)|on behalf of|according to|contact|ask|met)\s+")
CUED_NAME = re.compile(rf"(?:{_UP}(?:\s{_L}\.)?\s{_UP}|{_UP},\s{_UP})")

CUE_OF = {w: i for i, words in enumerate(CUES.values()) for w in words.split("|")}
FIRST_SET, ORGANISATION_SET, TITLE_SET = frozenset(FIRST_NAMES.split()), frozenset(ORGANISATION.split()), frozenset(TITLES.split())
AFTER_SET = frozenset(AFTER.split("|"))
SMALL = frozenset("the a an of in on at to and for by with from as was is were be had has not no or its this that it one two three der die das und le la les et des de du el los y en con".split())
NO_NAME_SET = frozenset(NO_NAME.split()) | SMALL | frozenset(CUE_OF) | TITLE_SET
DOES_SET = frozenset(DOES.split())
NO_NAME_END = ORGANISATION_SET | frozenset(STREETS.split("|"))
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def named_spans(text: str, start: int, run: str) -> Iterator[tuple[int, int]]:
    """The spans of a run of words with capitals that may be a name: words that begin sentences taken off, none of a firm or street."""
    words = [(start + m.start(), start + m.end(), m.group().lower().strip(".")) for m in re.finditer(r"\S+", run)]
    while words and words[0][2] in NO_NAME_SET:
        del words[0]
    if len(words) < 2 or any(w in NO_NAME_END for _, _, w in words[1:]) or words[1][2] in NO_NAME_SET and words[1][1] - words[1][0] > 2:
        return
    if (following := WORD.match(text, words[-1][1] + 1)) and following.group().lower() in ORGANISATION_SET:
        return
    for stop in range(2, len(words) + 1):
        yield words[0][0], words[stop - 1][1]


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, type number, set of bits of its generators) of every proposed span, overlapping ones among them."""
    found: list[tuple[int, int, int, int]] = []
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose lower case is longer; offsets must stay
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if "@" in text or "at" in lower:
        for m in AT.finditer(lower):
            low = max(0, m.start() - 90)
            user, host = USER.search(lower[low : m.start()]), HOST.match(lower, m.end())
            if user and host:
                found.append((low + user.start(), host.end(), 0, 0 if m.group() == "@" else 1))
    for m in NUMBER.finditer(text):
        span = m.group()
        digits = sum(map(str.isdigit, span))
        if digits < 6 or DATE.match(span):
            continue
        a = m.start()
        found.append((a, m.end(), 2, 2 if span[0].isalpha() else 3))
        if not span[-1].isalpha():
            if not span[0].isalpha():
                found.append((a, m.end(), 1, 4))
        elif span[-2] in " -" and not span[0].isalpha():
            found.append((a, m.end() - 2, 1, 5))
    if ADDRESS_SIGN.search(lower):
        for m in ADDRESS.finditer(lower):
            found.append((m.start(), m.end(), 3, 6))
    for m in HOUSE.finditer(text):
        if not any(w in NO_NAME_SET for w in m.group().lower().split()[1:2]):
            found.append((m.start(), m.end(), 3, 14))
    for m in WAY.finditer(lower):
        start = WAY_START.search(lower[max(0, m.start() - 40) : m.start()])
        if start:
            found.append((max(0, m.start() - 40) + start.start(), m.end(), 3, 6))
    for m in FORENAME.finditer(lower):
        if after := AFTER_FIRST.match(text, m.end()):
            found.append((m.start(), after.end(), 4, 7))
        if before := BEFORE_FIRST.search(text, max(0, m.start() - 40), m.start()):
            end = m.end()
            found.append((before.start(), end, 4, 8))
    if "." in text:
        for m in INITIAL.finditer(text):
            found.append((m.start(), m.end(), 4, 9))
        for m in LAST_INITIAL.finditer(text):
            found.append((m.start(), m.end(), 4, 10))
    for m in TITLE.finditer(lower):
        if name := TITLED_NAME.match(text, m.end()):
            found.append((name.start(), name.end(), 4, 11))
            # a second word only where both have capitals
            if text[name.start()].isupper() and (more := TITLED_MORE.match(text, name.end())):
                found.append((name.start(), more.end(), 4, 11))
    for m in CAPITALS.finditer(text):
        for start, end in named_spans(text, m.start(), m.group()):
            found.append((start, end, 4, 13))
    for m in CUE.finditer(lower):
        if name := CUED_NAME.match(text, m.end()):
            found.append((name.start(), name.end(), 4, 12))
    if len(found) < 2:
        return [(start, end, kind, 1 << generator) for start, end, kind, generator in found]
    spans: dict[tuple[int, int, int], int] = {}
    for start, end, kind, generator in found:
        spans[start, end, kind] = spans.get((start, end, kind), 0) | 1 << generator
    return [(*span, generators) for span, generators in spans.items()]


#: Numbers of generators and of cues; where the features of either begin.
GENERATORS = 15
CUE_AT = 5 + GENERATORS
REST = CUE_AT + len(CUES)
N_FEATURES = REST + 27


def features(text: str, start: int, end: int, kind: int, generators: int) -> list[float]:
    """Format and context of a span."""
    span = text[start:end]
    row = [0.0] * N_FEATURES
    row[kind] = 1
    for g in range(GENERATORS):
        row[5 + g] = float(generators >> g & 1)
    before = WORD.findall(text[max(0, start - 34) : start].lower())[-4:]
    for distance, word in enumerate(reversed(before)):
        cue = CUE_OF.get(word)
        if cue is not None and not row[CUE_AT + cue]:
            row[CUE_AT + cue] = 4 - distance
    following = WORD.findall(text[end : end + 24].lower())[:2]
    row[REST + 0] = 2.0 * (bool(following) and following[0] in ORGANISATION_SET) or float(len(following) > 1 and following[1] in ORGANISATION_SET)
    row[REST + 1] = float(bool(following) and following[0] in AFTER_SET)
    row[REST + 2] = float(not before or text[:start].rstrip()[-1:] in ".!?\n/;")
    words = WORD.findall(span)
    low = [w.lower() for w in words]
    row[REST + 3] = len(words)
    row[REST + 4] = sum(w in FIRST_SET for w in low)
    row[REST + 5] = sum(w in ORGANISATION_SET for w in low)
    row[REST + 6] = sum(w[0].isupper() for w in words)
    row[REST + 7] = float(span.isupper())
    row[REST + 8] = float(span.islower())
    row[REST + 9] = sum(w in SMALL for w in low)
    groups = re.findall(r"\d+", span) if kind in (1, 2, 3) else []
    row[REST + 10] = sum(map(len, groups))
    row[REST + 11] = len(groups)
    for i, g in enumerate(groups[:4]):
        row[REST + 12 + i] = len(g)
    row[REST + 16] = 8 * ("/" in span) + 4 * ("." in span) + 2 * ("-" in span) + (" " in span)
    row[REST + 17] = float("+" in span) + 2 * float("(" in span) + 4 * float(span[:1] == "0")
    row[REST + 18] = len(span)
    row[REST + 19] = float(bool(before) and before[-1] in TITLE_SET)
    row[REST + 21] = float(bool(before) and before[-1] in FIRST_SET)
    row[REST + 20] = float(span[-1:].isalpha() and kind in (1, 2))
    # a name with capitals goes on with another word of the kind
    more = text[end : end + 1] in " \u00a0" and text[end + 1 : end + 2].isupper() and bool(following) and following[0] not in NO_NAME_SET
    row[REST + 24] = float(more and bool(words) and words[-1][0].isupper())
    row[REST + 26] = generators.bit_count()
    row[REST + 25] = float(bool(words) and words[-1].lower() in NO_NAME_SET)
    row[REST + 23] = float(bool(following) and following[0] in DOES_SET)
    row[REST + 22] = sum(w in NO_NAME_SET for w in low)
    return row


# --- Sentences to learn from ---------------------------------------------------------------------------------------------


class Writer:
    """Writes sentences of everyday correspondence with labelled personal items and with look-alikes, from a seed."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.known = FIRST_NAMES.split()

    def pick(self, *options):
        return self.r.choice(options)

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def stem(self) -> str:
        """A made-up surname, place or firm."""
        onset = ("B", "Br", "C", "Ch", "D", "F", "G", "Gr", "H", "J", "K", "Kh", "L", "M", "N", "Ng", "P", "Pr", "R", "S", "Sh", "T", "Tr", "V", "W", "X", "Y", "Z", "Mc", "O'")
        vowel = ("a", "e", "i", "o", "u", "ai", "ou", "ö", "ee", "ya")
        middle = ("", "", "l", "r", "nd", "st", "m", "k", "ntr", "bb", "gar", "levi", "mur", "hil")
        coda = ("a", "an", "er", "son", "sen", "ton", "ski", "ov", "ova", "ez", "ng", "ko", "wala", "ford", "by", "stein", "mann", "dotti", "oglu", "ides", "ura", "eh", "well")
        return self.pick(*onset) + self.pick(*vowel) + self.pick(*middle) + self.pick(*vowel) + self.pick(*coda)

    def first(self) -> str:
        """A first name: a listed one, or a made-up one of any origin."""
        return self.pick(*self.known).title() if self.r.random() < 0.55 else self.stem().replace("'", "").capitalize()

    def last(self) -> str:
        roll = self.r.random()
        return f"{self.pick('Al', 'El', 'Ben')}-{self.stem()}" if roll < 0.04 else f"{self.stem()}-{self.stem()}" if roll < 0.07 else f"{self.pick('van', 'de', 'von', 'di')} {self.stem()}" if roll < 0.1 else self.stem()

    def place(self) -> str:
        return self.stem()

    def organisation(self) -> str:
        trade = self.pick(*(w.capitalize() for w in ORGANISATION.split() if len(w) > 4))
        name = self.stem() if self.r.random() < 0.8 else self.first()
        end = self.pick("Ltd", "LLC", "Inc", "GmbH", "Group", "Holdings", "Trust", "Cooperative", "Company", "")
        return f"{name} {trade} {end}".strip()

    def date(self) -> str:
        y, m, d = self.r.randint(1950, 2030), self.r.randint(1, 12), self.r.randint(1, 28)
        month = ("January February March April May June July August September October November December").split()[m - 1]
        return self.pick(f"{y}-{m:02d}-{d:02d}", f"{d}.{m}.{y}", f"{d} {month} {y}", f"{month} {d}, {y}", f"{m}/{d}/{y}")

    def email(self) -> str:
        f, l = self.pick(*self.known), re.sub(r"\W", "", self.stem().lower())
        user = self.pick(f"{f}.{l}", f"{f[0]}{l}", f"{f}_{l}", f"{f[:4]}-{l}", f"{l}{self.digits(2)}", f"{f}.{l}{self.digits(2)}", f"{f}{l}+post")
        host = f"{re.sub(r'[^a-z]', '', self.stem().lower())}.{self.pick('example', 'test', 'invalid', 'com', 'org', 'net', 'co.uk', 'edu')}"
        mail = self.pick("{u}@{h}", "{u}@{h}", "{u} @ {h}", "{u}(at){h}", "{u} (at) {h}", "{u}[at]{h}", "{u} at {d}").format(u=user, h=host, d=host.replace(".", " dot "))
        return mail.upper() if self.r.random() < 0.08 else mail

    def phone(self) -> str:
        d = self.digits
        return self.pick(
            f"+1 {d(3)} {d(3)} {d(4)}", f"+1{d(10)}", f"({d(3)}) {d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)}-{d(4)}",
            f"+44 7{d(3)} {d(6)}", f"07{d(3)} {d(6)}", f"020 {d(4)} {d(4)}", f"0044 (0)7{d(3)} {d(3)} {d(3)}", f"+49 (0){d(2)} {d(5)} {d(3)}",
            f"+33 1 {d(2)} {d(2)} {d(2)} {d(2)}", f"+49 {d(3)} {d(7)}", f"0{d(2)}/{d(7)}", f"+34 {d(3)} {d(3)} {d(3)}", f"+91 {d(5)} {d(5)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}",
        )

    def identity(self) -> str:
        d, c = self.digits, self.r.choice("ABCDEFGHJKLMNPRSTX")
        return self.pick(
            f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}", d(9), f"{c}{c} {d(2)} {d(2)} {d(2)} {self.pick('A', 'B', 'C', 'D')}", f"{c}{d(3)}-{d(4)}-{d(4)}",
            f"{d(2)}-{d(3)}-{d(4)}-{c}", f"{c}{self.pick('X', 'Y', 'K')}{d(7)}", f"{c}{d(8)}", f"{d(8)}-{c}", f"{d(8)}{c}", d(10), f"{d(6)}-{d(4)}",
            d(11), d(12), f"{d(4)} {d(4)} {d(4)}", f"{d(6)}/{d(4)}", f"{d(2)} {d(3)} {d(3)} {d(3)}", f"{d(3)} {d(3)} {d(4)}",
        )

    def street(self) -> str:
        n, p, z = self.r.randint(1, 599), self.place(), self.digits(5)
        name = self.pick("Elm", "Victoria", "King's", "Garden", "Bridge", "Long Acre", "St Mary's", "Orchard", "West Park", "Acacia", self.stem(), self.stem())
        kind = self.pick("Road", "Street", "Lane", "Avenue", "Blvd", "St.", "Drive", "Crescent", "Close", "Way", "Court", "Place", "Terrace", "Wynd", "Row", "Square")
        out = self.pick(
            f"{n} {name} {kind}, {p} {z}", f"{n} {name} {kind}", f"{n} {name} {kind}, {p}", f"Flat {self.r.randint(1, 40)}, {n} {name} {kind}, {p}", f"P.O. Box {self.digits(4)}, {p} {z}",
            f"{self.pick('Calle', 'Avenida', 'Plaza')} {self.pick('de la Paz', 'Cervantes', 'Real', 'del Carmen', self.stem())} {n}, {z} {p}",
            f"{n} {self.pick('rue', 'avenue', 'place')} {self.pick('Victor Hugo', 'de la Paix', 'du Moulin', 'des Lilas', self.stem())}, {z} {p}",
            f"{self.pick('Wald', 'Schul', 'Berg', 'Rosen', 'Bahnhof')}{self.pick('weg', 'straße', 'platz', 'allee', 'gasse', 'str.')} {n}, {z} {p}",
        )
        odd = f"{n} {self.stem()} {self.pick('Brae', 'Loan', 'Croft', 'Holme', 'Rise')}, {p}"
        roll = self.r.random()
        return out.lower() if roll < 0.08 and "Box" not in out else odd if roll > 0.92 else out

    def person(self) -> tuple[str, int]:
        """A name as written, and where it begins in that."""
        f, l = self.first(), self.last()
        i = self.r.choice("ABCDEGHKLMPRST")
        roll = self.r.random()
        if roll < 0.16:
            title = self.pick("Mr", "Mrs", "Ms", "Dr.", "Dr", "Herr", "Frau", "Prof.", "Ms.", "Mme")
            rest = self.pick(l, l, f"{f} {l}", f"{f[0]}. {l}")
            return f"{title} {rest}", len(title) + 1
        known = self.pick(*self.known).title()  # in other forms only a known first name tells a name
        name = self.pick(f"{f} {l}", f"{f} {l}", f"{f} {l}", f"{f} {i}. {l}", f"{f[0]}. {l}", f"{l}, {known}", f"{l}, {f[0]}.", f"{f[0]}. {i}. {l}")
        roll = self.r.random()
        if roll < 0.24 and "." not in name and "," not in name:
            name = f"{known} {l}"
        return (name.upper() if roll < 0.12 else name.lower() if roll < 0.24 and "." not in name and "," not in name else name), 0

    def personal(self) -> tuple[str, str, str, str]:
        """(what stands before, the item, what stands behind, its type)."""
        roll = self.r.randrange(5)
        if roll == 0:
            return self.pick("E-mail ", "Contact: ", "Write to ", "mailto:", "cc ", "My mail is <", "reply to ", ""), self.email(), "", "email"
        if roll == 1:
            return self.pick("Tel. ", "Tel:", "Phone: ", "Mobile ", "Fax ", "Rang from ", "Reachable on ", "Call ", "call me on ", "text ", ""), self.phone(), "", "phone"
        if roll == 2:
            cue = self.pick(
                "SSN ", "National ID: ", "Passport no. ", "Driver's licence ", "Identity card ", "Social security number ", "national insurance number ", "personal identity no. ", "ID ", "DNI ",
                "identity number ", "Tax ID ", "passport ", "licence number ", "Steuernummer ", "insured under ID no. ", "social security ",
            )
            return cue, self.identity(), "", "id_number"
        if roll == 3:
            return self.pick("Lives at ", "Home address: ", "residing at ", "They moved to ", "Please deliver to ", "send the parcel to ", "resident of ", "Address: ", "the flat at "), self.street(), "", "street_address"
        item, at = self.person()
        cue = self.pick(
            "Handed to ", "According to ", "told by ", "Signed by ", "the patient ", "Tenant ", "Witness ", "employee ", "I spoke to ", "on behalf of ", "Owner ", "", "approved by ", "collected by ",
            "please ask ", "please contact ", "ask for ", "we met ", "dear ", "a letter from ", "her teacher ", "his wife ", "the driver was ", "Contact ", "with regards, ",
        )
        after = self.pick("", "", "", " signed", " called twice", " was at home", " said so", " agreed", " wrote back", " has left", " attended the lesson")
        return cue + item[:at], item[at:], after, "person_name"

    def file_number(self) -> str:
        c, d = self.r.choice("ABDFGHKLMNPRSTVWXZ"), self.digits
        return self.pick(f"{c}-{d(4)}/{d(2)}", f"{c}{c}/{d(5)}", f"No. {d(2)}-{c}{d(4)}", f"file {d(3)}", f"{d(4)}/{d(4)}", f"{c}{d(4)}-{d(2)}", f"{d(2)}-{d(3)}-{d(2)}", f"2{d(3)}-{d(2)}-{d(4)}", f"{c}{c}{d(2)}")

    def harmless(self) -> str:
        d, o, p = self.digits, self.organisation(), self.place()
        n = str(self.r.randint(2, 9000))
        thing = self.pick("garden gate", "choir rehearsal", "library book", "boiler", "school trip", "new curtain", "football match", "harvest fair")
        who = self.pick("the teacher", "our neighbour", "a nurse", "the plumber", "the committee", "the gardener", "the tenant", "the witness", "an employee")
        return self.pick(
            f"According to {o}, nobody had seen the {thing} before {self.date()}.", f"We handed it to {o}.", f"Signed by {o}.", f"{o} wants {n} tickets for the {thing}.", f"{o} opened a shop in {p}.",
            f"The bill {self.file_number()} was settled with {o}.", f"Spares {self.file_number()} and {self.file_number()} suit the {thing}.", f"The gauge showed {d(3)} {d(3)} {d(3)} {self.pick('litres', 'kWh', 'km', 'units')} at {p}.",
            f"Counter: {d(3)} {d(3)} {self.pick(d(2), d(3))} {self.pick('litres', 'kWh', 'km', 'kg')}.", f"Firmware {d(2)}.{d(2)}.0.{d(1)} runs in {p} since {self.date()}.", f"{self.pick('Reference', 'Ticket', 'Order', 'Expediente', 'Dossier', 'Vorgang', 'réf.')} {self.file_number()}: {self.pick('closed', 'noted', 'abgelehnt', 'approved')}.",
            f"{self.pick('About', 'In the matter of', 'Regarding', 'Under')} {self.file_number()}, {who} is content.", f"Pictures of the {thing} are kept under {self.file_number()}.", f"Order {self.file_number()} has {n} pencils at {d(3)}.{d(2)} each.",
            f"Chapter {d(4)}, verse {d(3)}, mentions the {thing}.", f"The {p} {self.pick('Lane', 'Street', 'Road')} bakery closed in May; {n} streets lost their lamps.", f"The {self.r.randint(2, 60)} {self.stem()} samples came from {p}.",
            f"It cost {self.pick('$', '£', 'EUR ')}{n},{d(3)}.{d(2)}, and {d(2)} % was paid before.", f"Lot {self.file_number()} lies at 4 degrees in {p}.", f"Follow @{re.sub('[^a-z]', '', p.lower())}news for the {thing}.",
            f"Pens: {d(1)} @ {d(2)}.50, {d(1)} @ {d(2)}.00, for the {thing}.", f"It rained at {p}.", f"{who.capitalize()} spoke about the {thing} in general terms.", f"According to an old rule, {who} may leave early.",
            f"{who.capitalize()} and the landlord could not agree.", f"The market at {p} ends in {self.pick('May', 'June')}.", "The school keeps H2O, B12 and 3l bottles apart.", f"Serial number {d(4)}-{d(4)}-{d(4)} is on the {thing}.",
            f"{o} was named after its founders and lasted {n} years.", f"{p}, {self.date()}.", f"Please send the {thing} to the {p} office without delay.", f"The account {d(10)} was charged EUR {n},{d(3)}.00.",
            f"In {p}, {who} put the {thing} away on {self.date()}.", f"We walked from {p} to {self.place()} with {who}.", f"The {p} Library and the {self.place()} Museum open at nine.", f"On {self.pick('Monday', 'Friday')}, {p} and {self.place()} played.",
            f"{self.pick('Nach', 'Wie')} {p} fährt am {self.date()} ein Bus.", f"À {p}, la fête est finie.", f"En {p} no llovió.", f"As agreed, {o} and {self.organisation()} share the {thing}.", f"Costs for {p} rose by {d(2)} %.",
        )

    def sentence(self) -> tuple[str, set[tuple[int, int, int]]]:
        """A text and the (start, end, type number) of its personal items."""
        text, truth = "", set()
        for _ in range(self.r.randint(1, 3)):
            if text:
                text += self.pick(" ", " ", "\n", ". ", ", ", "; ", " / ")
            if self.r.random() < 0.5:
                text += self.harmless()
                continue
            cue, item, after, kind = self.personal()
            if text and self.r.random() < 0.5:
                cue = cue[:1].lower() + cue[1:]
            elif not text:
                cue = cue[:1].upper() + cue[1:]
            text += cue
            truth.add((len(text), len(text) + len(item), TYPES.index(kind)))
            text += item + (">" if cue.endswith("<") else "") + after + self.pick("", ".", " (see above).", ", as I heard.", f" on {self.date()}.")
        return text, truth


def _right(start: int, end: int, kind: int, truth: set[tuple[int, int, int]]) -> bool:
    """Whether a span is an item: where it begins, and for a name where it ends too."""
    return any(kind == k and start == a and (kind != 4 or end == b) for a, b, k in truth)


def _examples(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    writer, rows, labels = Writer(seed), [], []
    for _ in range(n):
        text, truth = writer.sentence()
        for start, end, kind, generator in candidates(text):
            rows.append(features(text, start, end, kind, generator))
            labels.append(_right(start, end, kind, truth))
    return np.array(rows, np.float32), np.array(labels, float)


@functools.cache
def model() -> tuple[BoostedTrees, np.ndarray]:
    """The fitted trees and, by type, the threshold nearest to a half of those of about the best balance of precision and
    recall on held-out sentences."""
    trees = BoostedTrees().fit(*_examples(1, FIT_SENTENCES))
    x, y = _examples(2, HELD_SENTENCES)
    p = trees.probability(x)
    limits = []
    for k in range(len(TYPES)):
        own = x[:, k] == 1
        reached = {t: _f1(p[own] >= t, y[own] == 1) for t in np.arange(0.2, 0.81, 0.05).round(2)}
        good = [t for t, f in reached.items() if f >= max(reached.values()) - 0.005]
        limits.append(min(good, key=lambda t: abs(t - 0.5)))
    return trees, np.array(limits)


def stored_model(spark: SparkSession) -> tuple[BoostedTrees, np.ndarray]:
    """The model as an artifact of the shared folder: fitted by the first session that needs it, read by the others.

    Its name is a digest of the sources that it is made from, so another version never reads it."""
    made = hashlib.sha256("".join(inspect.getsource(m) for m in (sys.modules[__name__], boosting)).encode()).hexdigest()[:16]
    return pickle.loads(artifact(spark, f"personal-{made}", lambda: pickle.dumps(model())))


def _f1(said: np.ndarray, true: np.ndarray) -> float:
    return 2 * (said & true).sum() / max(1, said.sum() + true.sum())


def find(texts: list[str], trees: BoostedTrees, limits: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, end, type number) of the personal items of each text, without overlaps, in order."""
    spans, rows = [], []
    for i, text in enumerate(texts):
        for start, end, kind, generator in candidates(text):
            spans.append((i, start, end, kind))
            rows.append(features(text, start, end, kind, generator))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not rows:
        return out
    p = trees.probability(np.array(rows, np.float32))
    taken: dict[int, list] = {}
    for j in np.lexsort(([s[1] - s[2] for s in spans], -p.round(3))):
        i, start, end, kind = spans[j]
        if p[j] < limits[kind]:
            continue
        mine = taken.setdefault(i, [])
        if all(end <= a or start >= b for a, b, _ in mine):
            mine.append((start, end, kind))
    for i, mine in taken.items():
        out[i] = sorted(mine)
    return out


def redact(text: str, items: list[tuple[int, int, int]]) -> str:
    """The text with each item replaced by its type in square brackets."""
    parts, last = [], 0
    for start, end, kind in items:
        parts += [text[last:start], f"[{TYPES[kind].upper()}]"]
        last = end
    return "".join([*parts, text[last:]])


def _scan(df: DataFrame, key: str, text: str, items: bool) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    fitted = df.sparkSession.sparkContext.broadcast(stored_model(df.sparkSession))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, limits = fitted.value
        for batch in batches:
            texts = [t or "" for t in batch["_text"]]
            found = find(texts, trees, limits)
            if items:
                rows = [(i, TYPES[k], s) for i, mine in enumerate(found) for s, _, k in mine]
                at = np.array([r[0] for r in rows], np.int64)
                yield pd.DataFrame({"_key": batch["_key"].to_numpy()[at], "pii_type": [r[1] for r in rows], "start_char": [r[2] for r in rows]})
            else:
                clean = [None if t is None else redact(t, mine) for t, mine in zip(batch["_text"], found)]
                yield pd.DataFrame({"_key": batch["_key"], "redacted": clean, "items": [len(m) for m in found]})

    schema = "pii_type string, start_char long" if items else "redacted string, items long"
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return spread(rows).mapInPandas(flat.filled(work), f"_key {kind}, {schema}").withColumnRenamed("_key", key)


def personal_items(df: DataFrame, key: str = "edge_id", text: str = "evidence_excerpt") -> DataFrame:
    """(key, pii_type, start_char): one row per personal item.  Null and empty texts have none; repeated rows give
    repeated results; a null key stays null; extra columns are not read.  No shuffle."""
    return _scan(df, key, text, True)


def redacted(df: DataFrame, key: str = "edge_id", text: str = "evidence_excerpt") -> DataFrame:
    """(key, redacted, items): each text with typed placeholders for its personal items; null stays null."""
    return _scan(df, key, text, False)


def p5_found(spark, sf_dir: str) -> DataFrame:
    return personal_items(spark.read.parquet(f"{sf_dir}/relationships.parquet")).distinct()


def p5_redacted(spark, sf_dir: str) -> DataFrame:
    return redacted(spark.read.parquet(f"{sf_dir}/relationships.parquet")).distinct()


QUERIES = {"p5_found": p5_found, "p5_redacted": p5_redacted}
SQL: dict[str, str] = {}
