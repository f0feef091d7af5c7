import pytest

from playtrail.llm.pii import KINDS, Transducer, all_spans, base_spans, find_pii, in_order, masked
from tests.llm.cases import ROWS, table


@pytest.fixture(scope="module")
def transducer():
    return Transducer()


@pytest.mark.parametrize(
    "text,spans",
    [
        ("mail a.b+c@d-e.org, x", [("email", 5, 18)]),
        ("a@b.co@d.com", [("email", 0, 6)]),
        ("a@b and c@d.e", [("email", 8, 13)]),
        ("1.2.3.4.5.6.7.8 999.1.1.1", [("ip", 0, 7), ("ip", 8, 15)]),
        ("4111 1111-1111 1111 or 4111111111111112", [("card", 0, 19)]),
        ("+1 (017) 555-7713!", [("phone", 0, 17)]),
        ("+1 23", []),
        ("", []),
    ],
)
def test_base(text, spans):
    assert base_spans(text) == spans


def test_base_is_what_the_patterns_find():
    for text in ["x@y.z@w.v +49 30 1234567 " * 3, "5500 0000 0000 0004.1.2.3", "a@@b.c", "@.@a.b"]:
        found = [s for s in base_spans(text) if s[0] == "email"]
        assert found == [("email", *m.span()) for m in KINDS["email"].finditer(text)]


@pytest.mark.parametrize(
    "text,kind,hidden",
    [
        ("write john.doe (at) example (dot) com", "email", "john.doe (at) example (dot) com"),
        ("jane at mail7 dot example dot com it is", "email", "jane at mail7 dot example dot com"),
        ("user[at]host[.]org", "email", "user[at]host[.]org"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("call ＋１ (415) 555-0199 now", "phone", "＋１ (415) 555-0199"),
        ("plus one four one five five five five zero one nine nine", "phone", "plus one four one five five five five zero one nine nine"),
        ("4111 one one one one 1111 one one one one", "card", "4111 one one one one 1111 one one one one"),
        ("at one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
        ("4l11 1111 1111 1111", "card", "4l11 1111 1111 1111"),
        ("4111​111111111111", "card", "4111​111111111111"),
    ],
)
def test_disguises_map_back_to_the_source(transducer, text, kind, hidden):
    base, spans = all_spans(text, transducer)
    assert set(base) <= set(spans)
    assert hidden in {text[start:end] for k, start, end in spans if k == kind}


@pytest.mark.parametrize(
    "kind,hidden",
    [
        ("email", "jane@example . com"),
        ("email", "jane at example . com"),
        ("email", "jane at example.com"),
        ("email", "kontakt at firma punkt de"),
        ("email", "ana arroba empresa punto es"),
        ("email", "bob at mail dot example dot museum"),
        ("email", "jane at cs dot uni dot it"),
        ("phone", "plus one 415 five 555 zero 1234"),
        ("phone", "+1 415 five 55 0199"),
        ("card", "4111 one 111 1111 1111"),
        ("ip", "192 dot 168 dot 1 dot 10"),
        ("ip", "192 dot one six eight dot 1 dot 10"),
    ],
)
def test_more_disguises_in_any_surroundings(transducer, kind, hidden):
    """Found alone, in a sentence, and beside text that another rule applies to."""
    for text in (hidden, f"so write {hidden}, please", f"user[at]host[.]org {hidden} é７", f"{hidden} of us"):
        assert hidden in {text[start:end] for k, start, end in all_spans(text, transducer)[1] if k == kind}, text


@pytest.mark.parametrize("mark", ["-", " - ", ", ", ".", "\n", "  ", " ( ", " + "])
def test_numbers_do_not_need_another_sign(transducer, mark):
    """Whatever stands between digits as words: the same spans with and without a sign elsewhere in the text."""
    for numbers in (["plus one", "415", "five", "555", "zero", "1234"], ["4111", "one", "111", "1111", "1111"]):
        text = mark.join(numbers)
        assert all_spans(text, transducer)[1] == [s for s in all_spans(text + " user[at]host[.]org", transducer)[1] if s[0] != "email"]


@pytest.mark.parametrize(
    "text",
    ["visit us at example.com", "it turns at boiling point it says", "at home . It is", "at this point in time", "met at home.It was", "the six of 1990 and one dot"],
)
def test_sentences_stay_alone(transducer, text):
    assert all_spans(text, transducer) == ([], [])


@pytest.mark.parametrize(
    "text",
    ["we met at home.Then he left", "look at the dot on the map", "one two three go", "un deux trois quatre", "né à l'été, çà et là",
     "point com", "0O0 1l1", "two plus two dot"],
)
def test_plain_texts_stay_alone(transducer, text):
    assert all_spans(text, transducer) == ([], [])


def test_tape_keeps_places(transducer):
    text = "é１ four five six (at) x"
    plain, begins, ends = transducer(text)
    assert len(plain) == len(begins) == len(ends) and begins == sorted(begins)
    assert text[begins[plain.index("4")] : ends[plain.index("6")]] == "four five six"


def test_long_digits_end_soon(transducer):
    all_spans("1 2 3 4 " * 20_000 + "one two", transducer)
    all_spans("9" * 20_000 + " seven", transducer)


def test_masked():
    text = "a@b.co +49 30 1234567"
    assert masked(text, base_spans(text)) == "[email] [phone]"
    assert in_order([("phone", 1, 2), ("email", 1, 3)]) == [("email", 1, 3), ("phone", 1, 2)]


def test_rows(spark):
    found = find_pii(table(spark)).collect()
    assert len(found) == len(ROWS) and {r.spans for r in found} == {""}
