"""Problem 10: template residue and error-page text.

Character n-gram models are fitted for filler, error messages, script notices and the furniture of
web pages, on phrase patterns written out below, and for natural text, on the n-gram counts of the
corpus: each text once however often it is repeated, and without texts that are mostly the classes'
own n-grams, so that no group of residue is its own background.  A window whose mean log-likelihood ratio against natural text is high belongs to its
best class; the share of a text that a class covers decides.  Placeholders stand amid real content:
they are matched by their delimiters in texts that hold such characters.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm import flat
from leafmill.session import spread

N, BITS, WINDOW = 4, 16, 24
#: Mean log-likelihood ratio of a window from which it belongs to a class.
LEVEL = 0.3
#: Shares of a text: of filler; of errors; of all residue beside which a notice or an error counts.
FILLER_SHARE, ERROR_SHARE, SCRIPT_SHARE, RESIDUE_SHARE = 0.3, 0.1, 0.03, 0.35
#: Share of a text's characters that begin n-grams of one class, from which it is no natural text to count.
STRONG_SHARE = 0.5
#: Words of a window in which a few words over and over are looked for; a shorter text is one window.
REPEAT_WORDS = 1000
CHUNK_CHARS = 1 << 19
CLASSES = ("filler", "error_page", "script_notice", "furniture")

# --- Fixed values: phrases of each class; a pattern's alternatives in ( | ) are all taken. -------------

FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat
duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur
excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum
cras mattis consectetur purus sit amet fermentum. donec id elit non mi porta gravida at eget metus. nulla vitae elit libero, a pharetra augue.
vestibulum id ligula porta felis euismod semper. maecenas sed diam eget risus varius blandit sit amet non magna. aenean lacinia bibendum nulla sed consectetur.
cum sociis natoque penatibus et magnis dis parturient montes, nascetur ridiculus mus. integer posuere erat a ante venenatis dapibus posuere velit aliquet.
curabitur blandit tempus porttitor. praesent commodo cursus magna, vel scelerisque nisl consectetur et. morbi leo risus, porta ac consectetur ac, vestibulum at eros.
etiam porta sem malesuada magna mollis euismod. nullam quis risus eget urna mollis ornare vel eu leo. duis mollis, est non commodo luctus, nisi erat porttitor ligula.
pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas. sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque.
fusce dapibus, tellus ac cursus commodo, tortor mauris condimentum nibh, ut fermentum massa justo sit amet risus. vivamus sagittis lacus vel augue laoreet rutrum faucibus dolor auctor.
phasellus viverra, suspendisse potenti, quisque rhoncus, mauris tincidunt, in hac habitasse platea dictumst, proin sodales libero, ut imperdiet ipsum ultricies.
(bacon|hipster|cupcake|pirate) ipsum dolor amet (pork belly short ribs brisket|swine tenderloin sirloin|meatball jerky ham hock pancetta|gluten-free artisan tattooed|tart muffin jelly-o candy canes).
(insert|add|put|write|enter|type|place|paste) (your|a short|some|the) (text|wording|introduction|description|title|copy|content|paragraph) (here|later|before release|in this box).
(insert|add|put|write|type|paste) (your|a short|some) (summary|heading|caption|message|body text) (here|before printing|below|in this space).
(your|body|main) (text|copy|content) goes here (your|body|main) (text|copy|content) goes here
type your paragraph here. click to edit this text. add as much as you like.
(click|tap|double-click) (here|) to (edit|add|change) this (text|paragraph|title).
this is (dummy|sample|placeholder|filler) text. replace it with your own (content|text|words) before (printing|publishing|release).
(placeholder|dummy|filler) (copy|text). final (wording|text|copy) to follow from the (communications|editorial|marketing|design) team.
(text|content|title|description) (to be supplied|to come|to follow|coming soon|pending).
text text text text text. text text text text. heading text text text.
(sample|dummy|test|filler|example) (text|content) (sample|dummy|test|filler|example) (text|content)
test test test 000 test test testing testing one two three this is a test
dummy dummy dummya dummyf dummy dummya
foo bar foo bara foo barf foo bar baz foo bar
asdf asdf asdf jkl jkl asdf qwer asdf asd asda asd asdf qwerty asdfgh zxcv xxx xxx xxx xxxx
the quick brown fox jumps over the lazy dog the quick brown fox
blah blah blah bla bla bla
blindtext blindtext blindtext, hier steht (später|bald) der (richtige|eigentliche) inhalt.
(hier steht ein|dies ist ein) (blindtext|platzhaltertext|mustertext). bitte (ersetzen|durch eigenen text ersetzen).
(ceci est un|texte de) (texte de remplissage|remplissage). remplacez-le par votre texte. (faux texte|texte fictif), le vrai contenu viendra plus tard.
(este es un|texto de) (texto de relleno|relleno). reemplácelo por su propio texto. aquí va el texto definitivo.
ダミーテキストです。ここに本文を入れてください。ここにテキストが入ります。
"""

ERROR = """
(error|http|status|http error|error code|code) 000(:| -|) (not found|forbidden|unauthorized|bad request|internal server error|internal error|bad gateway|service unavailable|service temporarily unavailable|gateway timeout|gone|too many requests|request timeout)
(error|http|status|status:|) 000(:| -:| -|) (the link is no longer valid|you are not allowed to read this item|timed out while fetching the file|server is not responding|resource not available|unexpected condition|request could not be completed|the page could not be found|access to this resource is denied|permission required).
000 (not found|forbidden|unauthorized|bad request|internal server error|bad gateway|service unavailable|service temporarily unavailable|gateway timeout|gone)
000 (-|-:|) (the link is no longer valid|you are not allowed to read this item|timed out while fetching the file|server is not responding|resource not available|unexpected condition|request could not be completed)
upstream (closed|reset) the connection. connection (refused|reset by peer|timed out).
oops! we can't find the page you are looking for. sorry, this page isn't available.
(the link is no longer valid|you are not allowed to read this item|timed out while fetching the file|server is not responding|resource not available|unexpected condition|request could not be completed) (0000-00-00)
(unexpected condition|request could not be completed|server is not responding|resource not available) ((january|february|march|april|may|june|july|august|september|october|november|december) 00, 0000)
(unexpected condition|request could not be completed|server is not responding|resource not available) (00 (january|february|march|april|may|june|july|august|september|october|november|december) 0000)
(the link is no longer valid|timed out while fetching the file|resource not available) (00.0.0000). reference no. 00-a0000
(incident|error reference|reference) (no. 00-a0000|aa-0000/00|a-0000/00|file 000 of)
error 000: the requested (file|page|url|document|record) aa-0000/00 (does not exist|could not be found|was not found) on this server.
access denied. you do not have permission to (open|view|access) (the document|this page|the file|this record). incident
your session has expired. please (sign|log) in again to continue.
(this|the requested) (record|page|file|document) has been (removed|deleted|moved) or its link has expired.
too many requests. slow down and (retry|try again) (after|in) 00 seconds.
(database|server) connection failed: timeout after 00 s
the (archive|site|server|service) is down for maintenance. (try again|please try again|come back) (in 00 minutes|later).
something went wrong while (loading|opening) this (record|page|document). please (try again later|reload the page).
preview not available. the file is password protected or damaged.
the viewer could not open the (file|document) (code 0x00f). contact your administrator.
traceback (most recent call last):
  file "render.py", line 00, in show
keyerror: 'body' valueerror: typeerror: nullpointerexception stack trace exception in thread main
uncaught exception. fatal error: call to undefined function. segmentation fault (core dumped)
an (unexpected|internal|unknown) error (occurred|has occurred). (please|contact) the administrator. reference
page not found. the page you (requested|are looking for) (does not exist|could not be found|is no longer available).
seite nicht gefunden. die angeforderte (akte|seite|datei) ist nicht mehr (vorhanden|verfügbar). zugriff verweigert. (es ist ein|interner) fehler aufgetreten.
accès refusé. votre demande n’a pas abouti (réf. 0000). page introuvable. une erreur est survenue. le document demandé n’existe plus.
acceso denegado. no tiene permiso para (abrir|ver) este documento. página no encontrada. se ha producido un error.
permission denied. you do not have (permission|the rights) to open the (folder|item|record). you are not authorised to view this.
(whoops|oh no|sorry|oops|uh oh), (that|this|it) didn't work. (our engineers|our team|the administrators) (have|has) been notified. we are working on (it|a fix).
erreur (interne du serveur|du serveur|000). le service est (temporairement indisponible|indisponible). veuillez réessayer (plus tard|ultérieurement). la page demandée est introuvable.
error (interno del servidor|del servidor|000). el servicio no está disponible. (inténtelo de nuevo|vuelva a intentarlo) más tarde.
(interner serverfehler|serverfehler|fehler 000). der dienst ist (zurzeit|derzeit|vorübergehend) nicht (verfügbar|erreichbar). bitte versuchen sie es später erneut.
ページが見つかりません。アクセスが拒否されました。エラーが発生しました。
"""

SCRIPT = """
(please|kindly|you have to|you need to|you must|it is necessary to|) (enable|activate|turn on|allow|unblock) (javascript|js|scripts|scripting|ecmascript|active content) (in your browser|for this site|in the settings|and reload) (to|before) (view|open|load|run|reading) (the document|this document|this record|page 0|the file viewer|this viewer|the page).
before (reading|opening|viewing) (page 0|this record|the document|the file viewer), (please|) (enable|activate|turn on|allow|unblock) (javascript|scripts|active content).
(javascript|scripting) is (disabled|required|turned off|not enabled). the (reader|viewer|page) cannot (start|be shown).
(scripts|javascript) (are|is) blocked, so the page viewer cannot be (shown|displayed).
this (site|page|application) requires (cookies and javascript|javascript|scripts). turn (them|it) on and reload.
noscript: the (application|site|page|viewer) will not work unless (js|javascript) is (allowed|enabled).
checking your browser before opening the (archive|site|page). this needs (scripts|javascript) to be (allowed|enabled).
your browser does not support (javascript|scripts) or it is (disabled|blocked). (javascript|scripts) must be enabled.
bitte aktivieren sie (javascript|skripte), um die (akte|seite|datei) anzuzeigen. javascript ist deaktiviert. (diese seite|dieser betrachter) benötigt javascript.
activez (javascript|les scripts) pour (consulter|afficher|lire) ce (dossier|document). javascript est (désactivé|nécessaire|requis).
active (javascript|el uso de scripts) en su navegador para (ver|leer|abrir) el documento. es necesario activar javascript. javascript está desactivado.
この文書を表示するにはjavascriptを有効にしてください。ブラウザのjavascriptが無効です。
"""

FURNITURE = """
menu
home | records | contact | log in
home | about | contact | login | register | sign in | sign up
skip to content
skip to main content
back to start
back to top
search documents
search
(privacy notice|privacy policy|cookie policy|imprint|legal notice) - (terms|terms of use|contact)
© records portal. all rights reserved.
© 0000 all rights reserved.
help desk: weekdays 0 to 00
help desk: weekdays 00 to 00
share this page print this page download pdf
"""

#: Words that name a field of a template.
FIELD = (
    "name|first|last|date|address|company|recipient|signatory|amount|due|case|client|customer|period|pay|supplier|sender"
    "|number|no|id|phone|email|e-mail|title|city|street|invoice|account|reference|ref|subject|salutation|value|text|field"
    "|insert|your|order|user|employee|patient|contract|total|price|product|year|month|day|time|place|country|department"
)

_NAME = rf"\s*(?:[A-Z][A-Z_]{{2,29}}|[a-z]+_[a-z_]+|[a-z]+\.[a-z.]+|(?i:(?:{FIELD})(?:[ _.-]\w+){{0,3}}|\w+[ _.-](?:{FIELD})))\s*"
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}"
    r"|\$\{[^{}\n]{1,60}\}"
    r"|<%=?[^%\n]{1,60}%>"
    r"|<\?=?[^?\n]{1,60}\?>"
    r"|\[\[[^\[\]\n]{1,60}\]\]"
    r"|<<[^<>\n]{1,60}>>"
    r"|@@[^@\n]{1,40}@@"
    r"|\$\$[A-Za-z][^$\n]{1,40}\$\$"
    r"|##[A-Za-z][^#\n]{1,40}##"
    r"|~~[A-Za-z][^~\n]{1,40}~~"
    r"|\|\*[^|\n]{1,40}\*\|"
    rf"|\{{{_NAME}\}}"
    rf"|«{_NAME}»"
    r"|%[A-Za-z](?:[\w.]| (?=\w)){1,30}%(?!\w)"
    r"|#[A-Za-z](?:[\w.]| (?=\w)){1,30}#(?!\w)"
    r"|\b__[A-Za-z](?:[\w.]| (?=\w)){0,30}?__(?!\w)"
    r"|%\d\$[sd]|%\([a-z_]+\)[sd]"
    r"|[\[<](?i:insert|enter|add|type|your|fill in|choose|select)\b[^\[\]<>\n]{1,40}[\]>]"
    r"|\[[^\[\]\n]{2,40} here\]"
    r"|\[(?:Name|Date|Address|Title|Company|Company Name|Recipient|Your [A-Z]\w+|First Name|Last Name|Amount|City)\]"
    r"|\bXX/XX/(?:XX|20)\w\w\b|\bXX\.XX\.(?:XX|20)\w\w\b|\bTT\.MM\.JJJJ\b"
)
#: A sentence that speaks of placeholders: what stands before one, or the sentence's own words.
SPOKEN_OF = re.compile(
    r"(?i)(?:\bsuch as|\blike|\be\.\s?g\.|\bfor example|\bfields?|\bplaceholders?|\bmarkers?|\btags?|\bvariables?|\bcalled|[“\"'‘`„])\s*$"
)
#: What an error message beside a script notice must hold; the two share many n-grams.
ERROR_CUE = re.compile(
    r"(?i)\b[45]\d\d\b|error|denied|expired|removed|failed|went wrong|too many|not (?:available|found|allowed)|maintenance|could not"
    r"|does not exist|didn't work|indisponible|no está disponible|traceback|exception|password|fehler|nicht (?:gefunden|mehr)|refus|introuvable|erreur|denegad|encontrad"
)
#: What a script notice must name.
SCRIPT_CUE = re.compile(r"(?i)script|skript|\bjs\b|active content|スクリプト|скрипт")
DELIMITERS = re.compile(r"[{}\[\]<>«%@#$~|_]|XX|TT\.")


def spelled_out(pattern: str) -> list[str]:
    """Every sentence of a pattern of literal pieces and ( | ) choices without nesting."""
    pieces = re.split(r"(\([^()]*\|[^()]*\))", pattern)
    return ["".join(x) for x in itertools.product(*(p[1:-1].split("|") if p.startswith("(") and "|" in p else [p] for p in pieces))]


def _folded(text: str) -> np.ndarray:
    """Lower-case code points with every ASCII digit as 0."""
    codes = flat.code_points(text.lower())
    return np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)


def class_counts() -> np.ndarray:
    """(class, n-gram): n-gram counts of the phrases; each pattern weighs the same however many it spells out."""
    table = np.zeros((len(CLASSES), 1 << BITS))
    for row, patterns in zip(table, (FILLER, ERROR, SCRIPT, FURNITURE)):
        for pattern in filter(None, patterns.split("\n")):
            sentences = [s.strip() for s in spelled_out(pattern)]
            grams = flat.gram_hash(_folded("\n" + "\n".join(sentences) + "\n"), N, BITS)
            np.add.at(row, grams, 1 / max(1.0, len(sentences) / 8))
    return table


def strong(grams: np.ndarray, solid: np.ndarray, starts: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each text is mostly n-grams of one class (`known`: class, n-gram), which no corpus can change."""
    own = np.stack([np.add.reduceat((row[grams] & solid).astype(np.int64), starts) for row in known])
    return own.max(axis=0) >= STRONG_SHARE * np.maximum(1, np.add.reduceat(solid.astype(np.int64), starts))


def _corpus_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(1 << BITS, np.int64)
    known = class_counts()[: CLASSES.index("furniture")] > 0
    for batch in batches:
        texts = [t.lower() for t in batch["text"] if t]
        for a, b in flat.chunks(texts, len, CHUNK_CHARS):
            codes, starts, lengths = flat.join(texts[a:b], "\n")
            codes = np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)
            grams = flat.gram_hash(np.append(codes, np.full(N - 1, 10, np.uint32)), N, BITS)
            natural = np.repeat(~strong(grams, codes > 32, starts, known), lengths + 1)
            counts += np.bincount(grams[natural], minlength=1 << BITS)
    seen = np.flatnonzero(counts)
    yield pd.DataFrame({"gram": seen.astype(np.int32), "n": counts[seen]})


def corpus_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): hashed n-gram counts over the distinct natural texts; at most 2**BITS rows, whatever the corpus.

    Texts that differ in case and digits only are one text."""
    rows = df.select(F.col(text).alias("text")).filter(F.col("text").isNotNull())
    one = F.xxhash64(F.translate(F.lower("text"), "123456789", "000000000"))
    rows = rows.groupBy(one.alias("one")).agg(F.first("text").alias("text")).select("text")
    return spread(rows).mapInPandas(flat.filled(_corpus_grams), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def ratio_table(natural: np.ndarray) -> np.ndarray:
    """(n-gram, class): clipped log-likelihood ratios against natural text."""
    known = class_counts()
    share = (known + 1e-9) / known.sum(axis=1, keepdims=True)
    base = (natural + 0.5) / (natural.sum() + 0.5 * len(natural))
    ratio = np.clip(np.log(share / base), -1.5, 5.0)
    ratio[known < 1e-6] = -1.5
    return np.ascontiguousarray(ratio.T.astype(np.float32))


def class_shares(texts: list[str], table: np.ndarray) -> np.ndarray:
    """(text, class): the share of each text's characters, without white space, in the windows of each class.

    A window is a line, or a piece of WINDOW characters of a longer line."""
    codes, starts, _ = flat.join([t.lower() for t in texts], "\n")
    codes = np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)
    # the gram at i - 1 begins with the line end before i; a first line takes the line end of its predecessor
    framed = np.concatenate([[np.uint32(10)], codes, np.full(N, 10, np.uint32)])
    score = table[flat.gram_hash(framed, N, BITS)[: len(codes)]]
    line = np.concatenate([[0], np.flatnonzero(codes == 10) + 1])
    line = np.union1d(line[line < len(codes)], starts[starts < len(codes)])
    pieces = np.maximum(1, np.diff(np.append(line, len(codes))) // WINDOW)
    first = np.cumsum(pieces) - pieces
    window = np.repeat(line, pieces) + WINDOW * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    solid = np.add.reduceat((codes > 32).astype(np.int64), window)
    sums = np.add.reduceat(score, window, axis=0)
    length = np.diff(np.append(window, len(codes)))
    best = sums.argmax(axis=1)
    strong = sums[np.arange(len(best)), best] >= LEVEL * length
    owner = np.searchsorted(starts, window, side="right") - 1
    size = np.maximum(1, np.bincount(owner, solid, minlength=len(texts)))
    covered = np.bincount(owner[strong] * len(CLASSES) + best[strong], solid[strong], minlength=len(texts) * len(CLASSES))
    return covered.reshape(len(texts), len(CLASSES)) / size[:, None]


def repetition(text: str) -> bool:
    """Whether a text is a few words over and over, by the share of its words in windows that are.

    The windows have one size, since the share of distinct words falls with the length of any text."""
    words = text.split()
    if len(words) < 12:
        return False
    pieces = max(1, len(words) // REPEAT_WORDS)
    ends = [i * len(words) // pieces for i in range(pieces + 1)]
    repeated = sum(j - i for i, j in itertools.pairwise(ends) if len(set(words[i:j])) * 6 <= j - i)
    return repeated >= FILLER_SHARE * len(words)


def has_placeholder(text: str) -> bool:
    """Whether an unfilled field stands in the text itself, not as something the text speaks of."""
    for m in PLACEHOLDER.finditer(text):
        before = text[max(0, m.start() - 40) : m.start()]
        if not SPOKEN_OF.search(before):
            return True
    return False


def kinds(texts: list[str], table: np.ndarray) -> list[list[str]]:
    """The kinds of residue of each text."""
    shares = class_shares(texts, table)
    out = []
    for text, (filler, error, script, furniture) in zip(texts, shares):
        found = []
        if DELIMITERS.search(text) and has_placeholder(text):
            found.append("placeholder")
        residue = filler + error + script + furniture
        if filler >= FILLER_SHARE or repetition(text):
            found.append("filler")
        if error >= ERROR_SHARE and residue >= RESIDUE_SHARE and (not script or ERROR_CUE.search(text)):
            found.append("error_page")
        if script >= SCRIPT_SHARE and residue >= RESIDUE_SHARE and SCRIPT_CUE.search(text):
            found.append("script_notice")
        out.append(found)
    return out


def residue(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, residue): the kinds of residue of each row; rows without any, null, empty and blank texts give none.

    A row may have several kinds.  Repeated rows give repeated results; a null key stays null; extra columns
    are not read.  A text of any length is read whole."""
    kind = df.schema[key].dataType.simpleString()
    natural = np.zeros(1 << BITS)
    for row in corpus_counts(df, text).collect():  # at most 2**BITS rows
        natural[row.gram] = row.n
    table = df.sparkSession.sparkContext.broadcast(ratio_table(natural))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["_text"].notna()]
            texts = batch["_text"].tolist()
            found: list[list[str]] = []
            for a, b in flat.chunks(texts, len, CHUNK_CHARS):
                found += kinds(texts[a:b], table.value)
            batch = batch.assign(residue=found)[["_key", "residue"]]
            yield batch[batch["residue"].map(bool)]

    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    scored = spread(rows).mapInPandas(flat.filled(score), f"_key {kind}, residue array<string>")
    return scored.select(F.col("_key").alias(key), F.explode("residue").alias("residue"))


def without_residue(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` that hold no residue, with all their columns."""
    found = residue(df, key, text).select(F.col(key).alias("_residue_key")).distinct()
    return df.join(found, F.col(key).eqNullSafe(F.col("_residue_key")), "left_anti")


def p10_found(spark, sf_dir: str) -> DataFrame:
    return residue(spark.read.parquet(f"{sf_dir}/documents.parquet")).distinct()


def p10_split(spark, sf_dir: str) -> DataFrame:
    """Every document with whether it is excluded, and why."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = residue(docs).groupBy("doc_id").agg(F.array_sort(F.collect_set("residue")).alias("residue"))
    rows = docs.select("doc_id").join(found, "doc_id", "left")
    return rows.select("doc_id", F.col("residue").isNotNull().alias("excluded"), "residue")


QUERIES = {"p10_found": p10_found, "p10_split": p10_split}
SQL: dict[str, str] = {}
