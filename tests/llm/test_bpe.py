import random

from tokenizers import Tokenizer
import public_tokenizers as P

from gridtide.llm.bpe import Bpe, decode, encode, read_spec


def test_like_the_library():
    rng = random.Random(1)
    library, own = Tokenizer.from_file(P.path("word_bpe_49k.json")), Bpe(read_spec())
    letters = "abcdefghijklmnoprstuvwxyz      ''\n\t0123ÀéßΣσςİK中文字عر🙂\x1c\x1f\x85\xa0 ́!?.,<|>"
    texts = ["", "   ", "<|endoftext|>x<|startoftext|>", "don't WE'LL o'clock", "ΌΣΟΣ", "a" * 5000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False)
        got = own.encode(t)
        assert got.tolist() == want.ids, t
        assert own.decode(got).decode() == library.decode(want.ids, skip_special_tokens=False)


def test_every_token_encodes_to_itself():
    own = Bpe(read_spec())
    for i, text in own.texts.items():
        if text.endswith("\0"):
            assert own.word(text[:-1]) == [i]


def test_operator(docs, corpus, nothing):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    odd = docs.selectExpr("*", "1 AS token_ids", "2 AS decoded_text")
    rows = encode(odd, decoded="decoded_text").collect()
    assert len(rows) == len(corpus)
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.token_ids) == want and r.decoded_text == library.decode(want, skip_special_tokens=False)
    again = decode(encode(docs.limit(20))).collect()
    assert all(r.decoded_text == library.decode(list(r.token_ids), skip_special_tokens=False) for r in again)
    assert encode(nothing).count() == 0
