import public_tokenizers
import pytest

from strata.llm.encoding import Encoder, id_bytes

TEXTS = [
    "One word.\nOther WORD, Äpfel ÄPFEL.\nOne",
    "\n\nOne  \n two\n\nthree \n",
    " \n",
    "\nA",
    "tab\tand\r\nreturn\x0b\x85\u2028x\n y",
    "H\u0331 h\u0331 W\u030A \n\u0308 A\u030A\nJ\u030C",
    "ΟΔΟΣ\nΟΔΟΣ. İstanbul\nI\u0307 ẞ K \u212A",
    "<|StartOfText|>\n<|startoftext|> a\n<|ENDOFTEXT|>",
    "No token <|END\nOFTEXT|> here",
    "It'S\nDON'T we'LL",
    "a\u0000B\nC 12\n34",
    None,
    "",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_levelled_texts_have_the_tokenizers_own_ids(name):
    encode = Encoder(public_tokenizers.path(name))
    for some in (TEXTS, [f"{a}{b}{c}" for a in TEXTS for b in ("", " ", "\n") for c in TEXTS]):
        own = encode.tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)
        assert list(encode(some)) == [id_bytes(one.ids) for one in own]


def test_line_breaks_and_capitals_make_no_new_parts():
    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    list(encode(["first one\nTwo TWO Zwölf\nzwölf one"]))
    assert set(encode.known) == {"one", "two", "zwölf"}


def test_a_vocabulary_that_tells_them_apart_keeps_them():
    encode = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    list(encode(["first one\nTwo TWO"]))
    assert set(encode.known) == {"one\nTwo", "TWO"}
