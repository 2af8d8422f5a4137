import numpy as np
import pytest

from leafmill.llm import residue as R

PROSE = "The harbour office wants to know why the pump assembly was booked twice in May. Costs for the depot rose by 4 percent, mainly because of the water samples. "


@pytest.fixture(scope="module")
def table():
    natural = np.bincount(R.flat.gram_hash(R._folded(PROSE * 40), R.N, R.BITS), minlength=1 << R.BITS).astype(float)
    return R.ratio_table(natural)


CASES = [
    ("404 Not Found", ["error_page"]),
    ("Menu\nAccess denied. You do not have permission to open the file.\nPrivacy notice - Terms", ["error_page"]),
    ("Please enable JavaScript in your browser to view this document.", ["script_notice"]),
    ("Bitte aktivieren Sie JavaScript, um die Akte anzuzeigen.", ["script_notice"]),
    ("502 Bad Gateway\nupstream closed the connection\nScripts are blocked, so the page viewer cannot be shown.", ["error_page", "script_notice"]),
    ("Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor.", ["filler"]),
    ("Cras mattis consectetur purus sit amet fermentum. Donec id elit non mi porta gravida at eget metus.", ["filler"]),
    ("Bacon ipsum dolor amet pork belly short ribs brisket, meatball jerky ham hock pancetta.", ["filler"]),
    ("Whoops, that didn't work. Our engineers have been notified.", ["error_page"]),
    ("Erreur interne du serveur. Le service est temporairement indisponible, veuillez réessayer plus tard.", ["error_page"]),
    ("Interner Serverfehler. Bitte versuchen Sie es später erneut.", ["error_page"]),
    ("Heading\n\n" + "Insert your text here.\n" * 3, ["filler"]),
    ("Title\n\n" + "zob zoba zobf zob zob zoba " * 6, ["filler"]),
    (PROSE + "Dear {{first_name}}, the total is due.", ["placeholder"]),
    (PROSE + "Signed by [INSERT signatory] on XX/XX/20XX.", ["placeholder"]),
    (PROSE + "Dear <%= client.name %>", ["placeholder"]),
    (PROSE + "The team pointed out that template fields such as {{first_name}} must be filled before mailing.", []),
    (PROSE + "The specimen sheet still showed lorem ipsum, which the auditor criticised.", []),
    (PROSE * 2 + "The portal answered with “404 Not Found” and the clerk filed a complaint about it.", []),
    (PROSE * 2 + "Users were advised to enable JavaScript in the older viewer.", []),
    (PROSE + "Name: ______________  Date: ____________", []),
    (PROSE + 'Line four reads [illegible]; set {a, b}; {"site": "Korsund", "k": 4}; « bonjour ».', []),
    (PROSE, []),
    ("", []),
    (" \n ", []),
]


@pytest.mark.parametrize("text,kinds", CASES)
def test_kinds(table, text, kinds):
    assert R.kinds([text], table) == [kinds]


def test_a_batch_gives_what_each_text_gives_alone(table):
    texts = [t for t, _ in CASES] + ["x" * 100_000]
    assert R.kinds(texts, table) == [R.kinds([t], table)[0] for t in texts]


def test_operator_on_nulls_repeats_and_empty_tables(spark):
    kind = "doc_id long, text string, residue string, _text string"
    frame = spark.createDataFrame([(1, None, "", ""), (2, "404 Not Found", "", ""), (2, "404 Not Found", "", ""), (3, "", "", ""), (None, "404 Not Found", "", ""), (4, PROSE, "", "")] + [(5 + i, PROSE, "", "") for i in range(20)], kind)
    got = [(r.doc_id, r.residue) for r in R.residue(frame).collect()]
    assert sorted(got, key=repr) == [(2, "error_page"), (2, "error_page"), (None, "error_page")]
    assert R.residue(frame.limit(0)).count() == 0
    assert R.without_residue(frame).count() == frame.count() - 3


HOT = ["Lorem ipsum dolor sit amet consectetur adipiscing elit.", "Access denied. You do not have permission to open the file."]


@pytest.mark.parametrize("text,kind", list(zip(HOT, ["filler", "error_page"])))
@pytest.mark.parametrize("tail", ["", "\n{0}"])  # copies, and texts that differ a little
def test_a_hot_group_of_residue_is_not_its_own_background(spark, text, kind, tail):
    letters = "abcdefghijklmnopqrstuvwxyz"
    data = [(i, text + tail.format(letters[i % 26] + letters[i // 26])) for i in range(300)]
    data += [(1000 + i, f"{letters[i]}. {PROSE}{PROSE[::-1]}") for i in range(20)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted((r.doc_id, r.residue) for r in R.residue(frame).collect()) == [(i, kind) for i in range(300)]


def test_repetition_does_not_depend_on_length():
    prose = " ".join(f"word{(i * i + 7 * i) % 1187}" for i in range(20_000))  # many distinct words, each often
    assert not R.repetition(prose) and not R.repetition(prose[:5_000])
    assert R.repetition("zob zoba zobf zob zob zoba " * 3) and R.repetition("zob zoba zobf zob zob zoba " * 3_000)
    assert R.repetition(prose[: len(prose) // 2] + " zob zoba" * 10_000) and not R.repetition(prose + " zob zoba" * 1_000)
