"""The encoder on many texts at a time."""
import random

from finlake.llm import token_files
from finlake.llm.queries import tokenizer_file

ALPHABET = [*" \n\t.,!?'sdl aé&#9中", "<|endoftext|>", "it's", "word", " word,", "\x85", "\x00", "!! ,", "\U0001f600"]


def test_texts_together_equal_whole_texts(monkeypatch):
    enc, rng = token_files.Encoder(tokenizer_file()), random.Random(4)
    texts = [None, "", " ", "\n", "a ", " a", "a\n", "x" * 40, *["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(2000)]]
    want = [enc._whole(t or "") for t in texts]
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(token_files, "SLICE", size)
        monkeypatch.setattr(token_files, "KEPT", size)  # words are forgotten, too
        assert list(token_files.Encoder(tokenizer_file()).encode_all(texts, None)) == want


def test_new_words_are_tokenised_as_one_text():
    enc = token_files.Encoder(tokenizer_file())
    calls = []

    class Counted:
        def __getattr__(self, name, of=enc.tokenizer):
            calls.append(name)
            return getattr(of, name)

    enc.tokenizer = Counted()
    together, rows = enc._together, []
    enc._together = lambda words: rows.append(len(words)) or together(words)
    texts = [f"of some w{k} and, x{k}" for k in range(50)]
    assert [len(x) > 0 for x in enc.encode_all(texts)] == [True] * 50
    assert rows == [102] and calls.count("encode_batch_fast") == 1


def test_first_words_of_lines_are_tokenised_as_one_text():
    enc = token_files.Encoder(tokenizer_file())
    words = ["The", "a", "b'c", "x,y", "中文", "#1", "été", "..."]
    want, whole, alone = [enc._whole(w) for w in words], enc._whole, []
    enc._whole = lambda text: alone.append(text) or whole(text)
    assert enc._learn([*words, "\n", ""]) == [*want, whole("\n"), b""]
    assert alone == ["\n", ""]
    assert enc._as_lines(["a", "b<|endoftext|>"]) == [whole("a"), whole("b<|endoftext|>")]
