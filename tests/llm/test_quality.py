import pytest

from leafmill.llm import quality as Q

PROSE = "The harbour office wants to know why the pump assembly was booked twice in May.\nCosts for the depot rose by 4 percent, mainly because of the water samples.\nThe committee thanked the clerk and moved on to the second invoice.\n"
TEXTS = {
    "prose": PROSE,
    "german": "Die Mitarbeiter wurden rechtzeitig über den Umzug informiert. Das Gutachten wurde zweimal verschoben und schließlich abgelehnt.",
    "russian": "Протокол осмотра склада был составлен комиссией в присутствии двух свидетелей и подписан.",
    "japanese": "請求書の金額は69円です。署名済みの契約書を期日までに返送してください。",
    "list1": "\n".join(f"{i}. storage permit {i}" for i in range(1, 12)),
    "list2": "\n".join(f"- lease amendment TA/{i}" for i in range(12)),
    "list3": "\n".join(f"Pension statement {'.' * 12} {i}" for i in range(12)),
    "list4": "\n".join(["Pension statement QB/92", "Storage permit", "Water samples", "Shift roster", "Second invoice", "Customs declaration"]),
    "list5": "\n".join(["certificate: lease amendment", "procedure: tender documents", "agreement: water samples", "notice: shift roster"]),
    "table1": "\n".join(f"item {i};{i};3.{i};K{i}" for i in range(12)),
    "table2": "\n".join(f"| item {i} | {i} | 3.{i} |" for i in range(12)),
    "table3": "\n".join(f"item {i}     {i}      3.{i}      K{i}" for i in range(12)),
    "table4": "\n".join(f"item\t{i}\t3.{i}" for i in range(12)),
    "junk1": "kjbd fvcb qqzt wrrt mnbv xzzt plkj " * 12,
    "junk2": "=" * 70 + "\n" + "x" * 60 + "\n" + "#" * 70,
    "junk3": "6930645 36 2817858 6 408058 7738914 98694 5 8273 4617 " * 6,
    "junk4": "~,l ;it~i - -t !;|, rtt,l -t- n..'| ji~j " * 12,
    "junk5": "The clerk met the board.\n" + "q" * 900 + "\nThe board met.",
    "mixed": PROSE + "\n- one item\n- two items",
}


def test_classes(spark):
    data = [(k, v, 1.0) for k, v in TEXTS.items()] + [(f"p{i}", PROSE * (1 + i % 3), 0.5) for i in range(40)]
    frame = spark.createDataFrame(data, "page_id string, text string, words double")
    got = {r.page_id: r.text_class for r in Q.classified(frame).collect()}
    want = {k: next((c for c in ("list", "table", "junk") if k.startswith(c)), "prose") for k in TEXTS}
    assert {k: got[k] for k in TEXTS} == want


def test_statistics_of_a_known_text():
    values, language = Q.statistics(["The cat sat.\nIt is 4!", "的"])
    assert values["words"].tolist() == [5, 1] and Q.LANGUAGES[language[0]] == "en"
    assert values["word_length"][0] == pytest.approx(13 / 5)
    assert values["punctuated"][0] == 1.0
    assert values["symbols"][0] == pytest.approx(2 / 16)


def test_a_batch_measures_each_text_as_alone():
    texts = list(TEXTS.values())
    together, _ = Q.statistics(texts)
    for i, t in enumerate(texts):
        alone, _ = Q.statistics([t])
        assert all(alone[k][0] == pytest.approx(together[k][i]) for k in alone)


def test_nulls_blanks_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([("a", None), ("b", " \n　"), ("c", PROSE), ("c", PROSE), (None, PROSE)], "page_id string, text string")
    assert Q.classified(frame).count() == 3
    assert Q.classified(frame.limit(0)).count() == 0


def test_percentiles_and_tails(spark):
    frame = spark.createDataFrame([(f"p{i}", PROSE) for i in range(60)] + [("odd", "The of and to in " + "a-b! " * 60)], "page_id string, text string")
    odd = Q.classified(frame).filter("page_id = 'odd'").first()
    assert "symbols" in odd.tails and odd.pct_symbols > 0.95
