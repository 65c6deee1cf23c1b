import unicodedata

from hypothesis import given
from hypothesis import strategies as st

from weftline.llm.textform import FOLD, fold, words, words_with_offsets

ODD = st.text(alphabet="aéé b.-​Ｘ１ оАνё­　\n٣_'Ωｅ́", max_size=25)


def test_forms_that_look_the_same_fold_to_one():
    assert fold("Ｈｅｌｌо​ w ó") == "Hello w ó"
    assert fold("ёЁ") == fold("ëË") and fold("Ά") == "Á"


def test_what_is_visible_stays():
    for t in ("a  b", "A", "é", "a\tb", "a\nb", "a–b", "a-b", "ß", "漢字"):
        assert fold(t) == t


@given(ODD)
def test_fold_is_the_table_and_composition(t):
    assert fold(t) == unicodedata.normalize("NFC", t.translate(FOLD))


@given(ODD)
def test_offsets_select_the_words(t):
    found = words_with_offsets(t)
    assert [w for w, _, _ in found] == words(t)
    assert all(words(t[a:b]) == [w] for w, a, b in found)
