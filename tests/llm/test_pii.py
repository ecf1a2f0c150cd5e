import pytest

from tallyhouse.llm.pii import Feistel, find_pii, luhn, pseudonymise, replace_pii

REAL = {
    "email": "Anna.34@mail7.example.com", "phone": "+1 (487) 555-7209", "card": "4111 1111 1111 1111", "ip": "97.51.17.173", "date": "2024-02-29",
    "ssn": "078-05-1120", "iban": "DE89 3704 0044 0532 0130 00",
}


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1000])
def test_a_permutation_without_gaps(size):
    f = Feistel(b"k", "x")
    assert sorted(f.permute(v, size) for v in range(size)) == list(range(size))
    even = lambda v: v % 2 == 0
    assert sorted(f.permute(v, size, even) for v in range(0, size, 2)) == list(range(0, size, 2))


@pytest.mark.parametrize("kind", REAL)
def test_each_kind_changes_keeps_its_form_and_is_found_again(kind):
    text, found = pseudonymise(f"é ({REAL[kind]}) end")
    assert [f["kind"] for f in found] == [kind] and REAL[kind] not in text and len(text) == len(REAL[kind]) + 8
    again = pseudonymise(text)[1]
    assert again == found  # a pseudonym is valid too
    assert pseudonymise(f"other place: {REAL[kind]}.")[0] == f"other place: {text[3:-5]}."
    assert pseudonymise(REAL[kind], b"other key")[0] != text[3:-5]


def test_equal_numbers_in_other_spacing_stay_linked():
    a, b = pseudonymise("4111 1111 1111 1111")[0], pseudonymise("4111111111111111")[0]
    assert a.replace(" ", "") == b and luhn(b) % 10 == 0
    assert pseudonymise("bob.1@x.example.com")[0] == pseudonymise("BOB.1@X.example.com")[0].lower()


@pytest.mark.parametrize("text", ["1353681299978556", "999.1.1.1", "2023-02-29", "31/11/1999", "000-12-3456", "DE89 3704 0044 0532 0130 01", "version 4.0", "a@b", "0000000000000000", "1.2.3.4.5"])
def test_what_fails_validation_is_left(text):
    assert pseudonymise(text) == (text, [])


def test_rows(spark):
    rows = [(1, f"mail {REAL['email']}"), (1, f"mail {REAL['email']}"), (2, None), (3, ""), (None, REAL["card"] + " x" * 20000)]
    docs = spark.createDataFrame([(d, t, "kept", 9) for d, t in rows], "doc_id long, text string, found string, n_chars long")
    got = find_pii(docs).collect()
    assert sorted(r.n_found for r in got) == [0, 0, 1, 1, 1] and {r.doc_id for r in got if r.text is None} == {2}
    out = replace_pii(docs)
    assert out.columns == docs.columns and {r.found for r in out.collect()} == {"kept"}
    assert {r.text for r in out.collect() if r.doc_id == 1} == {pseudonymise(rows[0][1])[0]}
    assert find_pii(docs.limit(0)).collect() == []
