import pytest

from leafmill.llm import personal as P

CASES = [
    ("Write to mailto:a.berg@depot.example now.", [("email", "a.berg@depot.example")]),
    ("Contact: rosa (at) depot.example", [("email", "rosa (at) depot.example")]),
    ("Cc tom dot berg at depot dot example.", [("email", "tom dot berg at depot dot example")]),
    ("Tel. +49 (0)30 23125 782 (see file).", [("phone", "+49 (0)30 23125 782")]),
    ("Fax (616) 555-0128, as noted.", [("phone", "(616) 555-0128")]),
    ("Call 07700 900586.", [("phone", "07700 900586")]),
    ("SSN 941 36 8155.", [("id_number", "941 36 8155")]),
    ("Passport no. QQ 45 35 21 B (see file).", [("id_number", "QQ 45 35 21 B")]),
    ("Driver's licence D940-4004-5665.", [("id_number", "D940-4004-5665")]),
    ("Home address: Flat 25, 181 Mill Road, Halden.", [("street_address", "Flat 25, 181 Mill Road")]),
    ("Lives at P.O. Box 7066, Halden 44006.", [("street_address", "P.O. Box 7066")]),
    ("Residing at Gartenweg 59, 93782 Halden.", [("street_address", "Gartenweg 59")]),
    ("Keys left at 28 rue des Forges, 14972 Halden.", [("street_address", "28 rue des Forges")]),
    ("Handed to Adrian Berg on 20 October 2015.", [("person_name", "Adrian Berg")]),
    ("Signed by HENRY T. BERG.", [("person_name", "HENRY T. BERG")]),
    ("Tenant Herr Bergmann, as noted.", [("person_name", "Bergmann")]),
    ("As told by Berg, Adrian.", [("person_name", "Berg, Adrian")]),
    ("Witness hannah berg (see file).", [("person_name", "hannah berg")]),
    ("According to Halden Shipping GmbH, the order was late.", []),
    ("Invoice 2024-31-0191 was paid to Halden Logistics LLC.", []),
    ("Part numbers 12-345-21 and 12-346-31 fit the pump.", []),
    ("Meter reading 900 555 066 kWh at Halden.", []),
    ("With regard to K-8927/93, the letter of 22.10.2023 came on 2024-01-05.", []),
    ("The Halden Lane works closed in May; 14 roads were affected.", []),
    ("The total came to $38,952.03, of which 54 % had already been paid.", []),
    ("", []),
    ("It was collected by Dmitri Volkov.", [("person_name", "Dmitri Volkov")]),
    ("Approved by Ngozi Adeyemi.", [("person_name", "Ngozi Adeyemi")]),
    ("Please ask Priya Raghunathan.", [("person_name", "Priya Raghunathan")]),
    ("Please contact Xiaoming Zhang.", [("person_name", "Xiaoming Zhang")]),
    ("Fatima Al-Sayed signed.", [("person_name", "Fatima Al-Sayed")]),
    ("Dr. Chaudhry and Mr Nakamura attended.", [("person_name", "Chaudhry"), ("person_name", "Nakamura")]),
    ("The identity number 482917365520 is known.", [("id_number", "482917365520")]),
    ("She lives at 14 Acacia Wynd, Leith.", [("street_address", "14 Acacia Wynd")]),
    ("We attach the patient diary of June 2020, in the view of the clerk.", []),
    ("The Vrinda Museum and the Ostrava Library open at nine.", []),
]


@pytest.fixture(scope="module")
def model():
    return P.model()


@pytest.mark.parametrize("text,items", CASES)
def test_items(model, text, items):
    found = P.find([text], *model)[0]
    assert [(P.TYPES[k], s) for s, _, k in found] == [(kind, text.index(item)) for kind, item in items]
    # no word beyond a name is taken
    assert all(text[s:e] == item for (s, e, k), (kind, item) in zip(found, items) if kind == "person_name")


#: Sentences written apart from the generator of the sentences that the trees learn from.
APART = [
    ("Minutes were taken by Oluwaseun Bakare and checked twice.", ["Oluwaseun Bakare"]), ("Nobody told Ingeborg Haugland about the leak.", ["Ingeborg Haugland"]),
    ("Ring Thabo Nkosi on 011 482 7719 after six.", ["Thabo Nkosi", "011 482 7719"]), ("Mrs. Papadopoulou lost her passport, no. X4471902.", ["Papadopoulou", "X4471902"]),
    ("My new address is 7 Larkspur Close, Whitby.", ["7 Larkspur Close"]), ("Send it to j.okafor@harbour.example, please.", ["j.okafor@harbour.example"]),
    ("Signed by Mei-Ling Chow in the presence of Dr Arvind Menon.", ["Mei-Ling Chow", "Arvind Menon"]), ("The Northern Ballet played in Leeds on 3 May 2021.", []),
    ("Professor Lindqvist asked for two more weeks.", ["Lindqvist"]), ("Counter 4471 2290 was read on Friday.", []), ("Smith & Daughters Ltd paid 1,204.50 for part 88-120-4.", []),
    ("Her social security number is 078-05-1120.", ["078-05-1120"]), ("Er wohnt Am Anger 12, 99084 Erfurt.", ["Am Anger 12"]), ("Reference QT/77120 was closed by the clerk.", []),
    ("Elena Petrova called twice.", ["Elena Petrova"]), ("Write to ravi (at) post dot example.", ["ravi (at) post dot example"]),
]


def test_sentences_written_apart(model):
    due = {(i, text.index(item)) for i, (text, items) in enumerate(APART) for item in items}
    got = {(i, s) for i, (text, _) in enumerate(APART) for s, _, _ in P.find([text], *model)[0]}
    assert len(due & got) / len(due) >= 0.75 and len(due & got) / len(got) >= 0.9


def test_a_cheap_look_is_no_narrower_than_the_patterns():
    for text in ["12 rue de Lyon", "5 route de Lyon", "9 quai du Port", "boîte postale 44", "carrera norte 12", "3 elm cres", "am markt 4, 12345", "po box 17", "via roma 8"]:
        assert P.ADDRESS.search(text) and P.ADDRESS_SIGN.search(text)
    for text in ["a.b@c.org", "a ( at ) c.org", "a{at}c.net", "a at host.invalid", "a at host dot org"]:
        assert any(k == 0 for _, _, k, _ in P.candidates(text))


def test_held_out_accuracy(model):
    trees, limits = model
    x, y = P._examples(3, 1_500)
    p = trees.probability(x)
    for k in range(len(P.TYPES)):
        own = x[:, k] == 1
        assert P._f1(p[own] >= limits[k], y[own] == 1) > 0.93


def test_generators_propose_nearly_every_item():
    writer = P.Writer(9)
    missed = total = 0
    for _ in range(1_500):
        text, truth = writer.sentence()
        offered = {(s, k) for s, _, k, _ in P.candidates(text)}
        missed, total = missed + len({(s, k) for s, _, k in truth} - offered), total + len(truth)
    assert missed / total < 0.01


def test_redaction_keeps_the_rest(model):
    text = "Handed to Adrian Berg; Tel. 414-555-0153."
    assert P.redact(text, P.find([text], *model)[0]) == "Handed to [PERSON_NAME]; Tel. [PHONE]."


def test_operator_on_nulls_repeats_long_texts_and_clashing_columns(spark):
    long = "The depot was closed. " * 20_000 + "Call 07700 900586."
    frame = spark.createDataFrame([("a", None, "x"), ("b", "", "x"), ("c", "SSN 941 36 8155.", "x"), ("c", "SSN 941 36 8155.", "x"), ("d", long, "x"), (None, "SSN 941 36 8155.", "x")], "edge_id string, evidence_excerpt string, pii_type string")
    got = sorted((tuple(r) for r in P.personal_items(frame).collect()), key=repr)
    assert got == [("c", "id_number", 4)] * 2 + [("d", "phone", len(long) - 13)] + [(None, "id_number", 4)]
    assert {r.edge_id: r.redacted for r in P.redacted(frame).collect()}["a"] is None
    assert P.personal_items(frame.limit(0)).count() == 0
