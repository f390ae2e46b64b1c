import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm.tokens import TextEncoder, json_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
plain = Tokenizer.from_file(PATH)
plain.encode_special_tokens = True
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n a", "it's  'll 're ' s", "x'r e", "<|endoftext|> a <|endoftext|>", "  a　 b \x1c c\x85 d", "漢字 かな  " * 5, "a" * 5000, "é\t\tb  \r\n"]


@pytest.mark.parametrize("text", TEXTS)
def test_words_give_the_ids_of_the_text(text):
    assert json_encoder(PATH).ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab's.1 \n\t \x1cé漢")), max_size=30))
def test_any_text(text):
    assert json_encoder(PATH).ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded_and_keeps_what_is_met_again(monkeypatch):
    from riskloom.llm import common

    monkeypatch.setattr(common, "MOST_REMEMBERED", 3)
    made = []
    memory = common.Recent(lambda key: made.append(key) or -key)
    for key in (1, 2, 3, 1, 4, 1, 5, 6, 1, 2):
        assert memory[key] == -key
        assert len(memory) <= 3 and len(memory.old) <= 3
    assert made.count(1) == 1 and made.count(2) == 2


def test_long_unspaced_texts_are_not_remembered():
    encode = json_encoder(PATH)
    before = len(encode.first) + len(encode.later)
    for i in range(10_000):
        encode(chr(0x4E00 + i) * 100)
    assert len(encode.first) + len(encode.later) == before


@pytest.mark.parametrize("text", ["\n".join(["abc"] * 5000), "x " + "\n".join(["Abc", "é", "1"] * 2000) + ".", "\n\nab\ncd\n\nef\n"])
def test_a_word_a_line(text):
    assert json_encoder(PATH).ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("asÈß%'.#_\n 1漢")), max_size=30))
def test_any_text_of_marks_and_lines(text):
    assert json_encoder(PATH).ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_words_before_runs_of_marks_and_lines_of_any_latin_letter_are_known_without_them():
    asked = []

    def encode(text):
        asked.append(text)
        return plain.encode(text, add_special_tokens=False).ids

    encoder = TextEncoder(encode, letters=lambda word: plain.encode(word, add_special_tokens=False).ids)
    text = "tree rock%%% sand### tree%%% rock### lac.\nÉté lac.\nÉté"
    assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == ["\n", "###", "%%%", "."]
