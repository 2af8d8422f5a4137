import difflib
import itertools
import random
import re

import numpy as np
import pytest

from leafmill.llm import scan as S
from tests.conftest import rows

KIND = "page_id string, document_id string, page_number int, text string, noise string"
BODY = [
    "The committee thanked the clerk and moved on to the second\ninvoice of the storage room.",
    "Nobody at the harbour office remembered who had approved\nthe storage permit in the meantime.",
    "Photographs of the storage room were taken by the clerk and\nsent to the committee in good time.",
    "The office considers the second invoice closed, although the\nclerk asked the committee again.",
]


def pages(spark, texts, document="d"):
    return [(f"{document}_p{i}", document, i, t, "x") for i, t in enumerate(texts, 1)]


@pytest.fixture(scope="module")
def found(spark):
    data = pages(spark, [f"Storage report — Halden\n{BODY[i % 4]}\n- {i + 11} -" for i in range(5)])
    data += pages(spark, [BODY[0].replace("committee", "cornmittee"), "The commit-\ntee and the clerk met at the office.", "A long-\nterm plan and a long-term lease, a long-term view.", "The clerk sent the stor-", "age permit to the office."], "e")
    data += pages(spark, ["xq zvb|t ~~ qq!1 |jt" * 20, None, " ", ""], "f")
    data += pages(spark, [f"{BODY[i % 4]}" for i in range(12)] * 3, "g")
    data += data[:2]
    return set(rows(S.scan_noise(spark.createDataFrame(data, KIND))))


def test_headers_and_page_numbers(found):
    assert {(f"d_p{i}", k) for i in range(1, 6) for k in ("header", "pageno")} <= found
    assert not any(k in ("header", "pageno") for p, k in found if p[0] in "efg")


def test_misread_words(found):
    assert ("e_p1", "misread") in found
    assert {p for p, k in found if k == "misread"} == {"e_p1"}


def test_broken_words(found):
    assert ("e_p2", "hyphenation") in found  # inside the page
    assert ("e_p3", "hyphenation") not in found  # a compound's own hyphen
    assert ("e_p4", "hyphenation") in found and ("e_p5", "hyphenation") not in found  # across the page's end


def test_junk_and_blank_pages_are_no_cases(found):
    assert not any(p.startswith("f_") for p, _ in found)


def test_empty_table(spark):
    assert S.scan_noise(spark.createDataFrame([], KIND)).count() == 0


@pytest.mark.parametrize("line,number", [("- 12 -", 12), ("[5]", 5), (".3.", 3), ("Page 7 of 20", 7), ("12 / 17", 12), ("PAGE 4", 4), ("iv", 4), ("Seite 9", 9), ("p. 1", 1), ("2019.", -1), ("mix", -1), ("12 drums", -1)])
def test_printed_numbers(line, number):
    assert S.edge_code(line, False)[2] == number


def test_restored_words():
    assert "committee" in S.restored("cornmittee") and "should" in S.restored("sh0uld") and "wurden" in S.restored("wiirden")


def test_long_runs_of_letters_are_scanned_in_linear_time():
    text = "a" * 300_000
    assert S.observe(text, S.TokenCodes(bytes(1 << S.FILTER_BITS >> 3)))[4] is not None


def test_rebuilt_paragraphs():
    text = "Storage report\n\nThe cornmittee and the cle-\nrk met for a long-\nterm plan.\n\nThe next paragraph ends in a stor-\n- item one\n- 4 -"
    got = S.rebuilt(text, frozenset({0, 8}), frozenset(), frozenset({"long\nterm"}), {"cornmittee": "committee"}, "", "")
    assert got == ["The committee and the clerk met for a long-term plan.", "The next paragraph ends in a stor-", "- item one"]
    assert S.rebuilt("It is a stor-", frozenset(), frozenset(), frozenset(), {}, "age", "") == ["It is a storage"]
    assert S.rebuilt("age permit. Next", frozenset(), frozenset(), frozenset(), {}, "", "age") == ["permit. Next"]
    assert S.rebuilt("", frozenset(), frozenset(), frozenset(), {}, "", "") == []


def test_repaired_pages(spark):
    data = pages(spark, [f"Storage report — Halden\n{BODY[i % 4]}\n- {i + 11} -" for i in range(5)])
    data += pages(spark, ["The clerk sent the stor-", "age permit to the office.", None, " "], "e") + pages(spark, [f"{BODY[i % 4]}" for i in range(12)], "g")
    got = {r.page_id: r.text for r in S.repaired(spark.createDataFrame(data + data[:1], KIND)).collect()}
    assert got["d_p1"] == BODY[0].replace("\n", " ")
    assert got["e_p1"] == "The clerk sent the storage" and got["e_p2"] == "permit to the office."
    assert "e_p3" not in got and "e_p4" not in got


@pytest.mark.parametrize("a,b", [("Cooling unit", "Coo1ing unit"), ("Confidential draft", "Corifidential draft"), ("Minutes of clerk", "Minutcs of clcrk"), ("Schedule", "Schcdiile")])
def test_skeletons_of_misread_headers_are_equal(a, b):
    assert S.skeleton(a) == S.skeleton(b)


def test_headers_of_chapters_in_long_documents(spark):
    said = "Bitte senden Sie die unterschriebene Vereinbarung bis zum\n20 November zurück, wie der Rat es wünscht."
    chapter = {**{i: "Annex of the depot" for i in range(20, 25)}, **{i: "Survey — Halden" for i in (3, 30, 60)}}
    texts = [(f"{chapter[i]}\n" if i in chapter else f"{said}\n" if i in (8, 33, 50) else "") + BODY[i % 4] for i in range(64)]
    seen = S.scan_noise(spark.createDataFrame(pages(spark, texts), KIND)).filter("noise = 'header'")
    assert {r.page_id for r in seen.collect()} == {f"d_p{i + 1}" for i in chapter}


def test_the_filter_of_misread_types_changes_nothing(spark, monkeypatch):
    """With every word suspected, as by a filter that very many types have filled, the join gives the same."""
    texts = [f"Storage cornmittee\n{BODY[i % 4]}\n{BODY[(i + 1) % 4]}\n- {i + 11} -" for i in range(4)]
    texts += ["The office asked ‹cornmittee› and «cornmittee».\n" + "\n".join(BODY), "\n".join(BODY) + "\nand the corn-\nmittee of the clerk met.\n" + "\n".join(BODY)]
    frame = spark.createDataFrame(pages(spark, texts) + pages(spark, [BODY[i % 4] for i in range(12)], "g"), KIND)
    types = spark.createDataFrame([("cornmittee", "committee")], "word string, true_word string")
    usual = rows(S.observations(frame, types))
    found = rows(S.scan_noise(frame))
    assert sum(r.body_bad for r in S.observations(frame, types).collect()) == 1  # inside the page, broken over two lines
    assert sum(map(sum, (r.wrong for r in S.observations(frame, types).collect()))) == 5  # four headers, a first line
    full = bytes([255]) * (1 << S.FILTER_BITS >> 3)
    monkeypatch.setattr(S, "type_filter", lambda types: full)
    assert rows(S.observations(frame, types)) == usual
    assert rows(S.scan_noise(frame)) == found


def test_filter_holds_every_type(spark):
    words = [f"wørd{i}" for i in range(5_000)]
    held = S.TokenCodes(S.type_filter(spark.createDataFrame([(w, "x") for w in words], "word string, true_word string")))
    assert all(map(held.suspected, words)) and sum(held.suspected(f"other{i}") for i in range(5_000)) < 50


def test_expected_counts_equal_the_sum_over_all_paths():
    r = np.random.default_rng(2)
    step = r.dirichlet(np.ones(4), 5)
    emission = np.log(r.dirichlet(np.ones(6), 4))
    symbols, weight = np.array([[0, 3, 5], [2, 1, -1], [4, -1, -1]]), np.array([2.0, 1.0, 5.0])
    moves, held = np.zeros((5, 4)), np.zeros((4, 6))
    for line, w in zip(symbols, weight):
        line = line[line >= 0]
        paths = list(itertools.product(range(4), repeat=len(line)))
        p = np.array([np.prod([step[4 if i == 0 else path[i - 1], x] * np.exp(emission[x, line[i]]) for i, x in enumerate(path)]) for path in paths])
        for path, share in zip(paths, p / p.sum() * w):
            for i, x in enumerate(path):
                moves[4 if i == 0 else path[i - 1], x] += share
                held[x, line[i]] += share
    got = S.expected(symbols, weight, step, emission)
    assert np.allclose(got, np.concatenate([moves.ravel(), held.ravel()]))


def test_planted_noise_is_repaired(spark):
    """Clean paragraphs, broken by a seeded scanner into lines with headers, page numbers, hyphens and misread letters."""
    r = random.Random(4)
    vocabulary = sorted(set(re.findall(r"[a-z]{2,}", " ".join(BODY).lower()) + "harbour minutes meeting lantern bridge window summer winter garden engine market river".split()))
    clean, scanned = [], []
    for d in range(6):
        for n in range(12):
            paragraphs = [" ".join(r.choice(vocabulary) for _ in range(r.randint(30, 50))).capitalize() + "." for _ in range(3)]
            lines = []
            for p in paragraphs:
                line = ""
                for word in p.split(" "):
                    word = word.replace("m", "rn", 1) if r.random() < 0.02 else word
                    if len(line) + len(word) > 60:
                        if len(word) > 7 and r.random() < 0.5:
                            lines.append(f"{line} {word[:4]}-")
                            line = word[4:]
                            continue
                        lines.append(line)
                        line = word
                    else:
                        line = f"{line} {word}".strip()
                lines += [line, ""]
            clean.append("\n\n".join(paragraphs))
            scanned.append((f"doc{d}_p{n}", f"doc{d}", n + 1, "\n".join([f"Annual survey — {'ABCDEF'[d]}", "", *lines, f"- {n + 3} -"]), "x"))
    got = {x.page_id: x.text for x in S.repaired(spark.createDataFrame(scanned, KIND)).collect()}
    accuracy = [difflib.SequenceMatcher(None, text, got[row[0]], autojunk=False).ratio() for row, text in zip(scanned, clean)]
    assert sum(accuracy) / len(accuracy) > 0.99
    assert not any("Annual" in t for t in got.values())


def test_a_header_on_a_few_of_many_pages(spark):
    for size in (10, 40):
        texts = [("Survey of the depot\n" if i % (size // 6) == 0 and i < size // 6 * 6 else "") + BODY[i % 4] for i in range(size)]
        seen = S.scan_noise(spark.createDataFrame(pages(spark, texts), KIND)).filter("noise = 'header'")
        assert seen.count() == sum(t.startswith("Survey") for t in texts)


def test_lines_at_any_distance_from_the_edges(spark):
    """Headers and footers of many lines, a page number below them, and a body that is shorter than they are."""
    head = ["Harbour Office of Halden", "Storage Department", "Quay Street 14", "Halden 4770", "Telephone 555 0134"]
    foot = ["Annual Survey", "Second Volume", "Depot Series", "Restricted Copy", "Printed at Halden"]
    texts = ["\n".join([*head, *(BODY if i % 2 else BODY[i % 4 : i % 4 + 1]), f"- {i + 11} -", *foot]) for i in range(6)]
    data = pages(spark, texts) + pages(spark, [BODY[i % 4] for i in range(12)], "g")
    frame = spark.createDataFrame(data, KIND)
    got = {r.page_id: r.text for r in S.repaired(frame).collect()}
    for i in range(6):
        want = BODY if i % 2 else BODY[i % 4 : i % 4 + 1]
        assert got[f"d_p{i + 1}"].split() == " ".join(want).split()
    found = set(rows(S.scan_noise(frame)))
    assert found == {(f"d_p{i}", k) for i in range(1, 7) for k in ("header", "pageno")}


def test_numbers_and_recurring_lines_inside_the_body_are_none(spark):
    texts = ["\n".join([BODY[i % 4], "Storage Room", f"§ {i + 1}", BODY[(i + 1) % 4], BODY[(i + 2) % 4]]) for i in range(8)]
    found = S.scan_noise(spark.createDataFrame(pages(spark, texts), KIND))
    assert found.filter("noise in ('header', 'pageno')").count() == 0


def test_a_word_broken_at_the_page_end_above_and_below_many_lines():
    tokens = S.TokenCodes(bytes(1 << S.FILTER_BITS >> 3))
    short = S.observe("Annual Survey\nThe clerk sent the stor-\n- 4 -", tokens)
    long = S.observe("Annual Survey\n" * 6 + "age permit to the office and the stor-\n" + "Second Volume\n" * 6 + "- 4 -", tokens)
    assert short[9] == long[9] == "stor" and long[8] == "age"


def test_broken_words_are_those_of_the_pattern():
    r = random.Random(3)
    for _ in range(20_000):
        text = "".join(r.choice("ab_1-‐’¬ \n\r\x0b-\n") for _ in range(r.randint(1, 40)))
        gate = re.search(rf"\w[{S.BREAK_MARKS}][ \t\u00a0]*[\r\n\x0b\x0c\x85\u2028\u2029]", text)
        assert [m.span() for m in S.broken_at(text)] == ([m.span() for m in S.BROKEN.finditer(text)] if gate else [])


def test_paths_from_both_edges_are_the_best_of_all():
    r = np.random.default_rng(5)
    with np.errstate(divide="ignore"):
        step = np.log(S.FIRST_STEP)
    emission = np.log(r.dirichlet(np.ones(12), 5))
    odds = emission - emission[S.BODY]
    for n in [1, 2, 3, 4, 5] * 4:
        top, bottom = r.integers(0, 12, n), r.integers(0, 12, n)

        def value(path, meet):
            sides = [(range(meet), top), (range(n - 1, meet - 1, -1), bottom)]
            return sum(sum(odds[path[i], x[i]] + step[path[at[k - 1]] if k else -1, path[i]] for k, i in enumerate(at)) for at, x in sides)

        every = itertools.product(itertools.product(range(5), repeat=n), [1] if n == 1 else range(1, n))
        best = max(every, key=lambda x: value(*x))[0]
        label = S.decoded(np.array([0]), np.array([n]), top, bottom, step, emission)[0]
        assert label.tolist() == [S.BREAK if x == S.INNER else x for x in best]


def test_a_number_below_a_header_with_a_misread_capital(spark):
    texts = ["\n".join([("lncomplete" if i == 3 else "Incomplete") + " notice — Halden", f"PAGE {i + 11}", *BODY]) for i in range(6)]
    found = set(rows(S.scan_noise(spark.createDataFrame(pages(spark, texts), KIND))))
    assert {("d_p4", "header"), ("d_p4", "pageno")} <= found
