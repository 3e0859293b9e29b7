"""Decontamination: products summed within a task, candidates that words rule out."""
import numpy as np

from finlake.llm import decontam


def _weighted(items, texts, s):
    block = decontam._block(list(enumerate(items)))
    rng = np.random.default_rng(5)
    block.idf = rng.random(len(block.terms)) * (rng.random(len(block.terms)) < 0.8)
    return block, list(decontam._found(texts, block, s))


def test_products_equal_the_passages():
    s, rng = decontam.Search(window=12, step=4), np.random.default_rng(3)
    words = np.array([f"w{k}" for k in range(40)])
    items = [" ".join(rng.choice(words, 9)) for _ in range(6)]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 3, 4, 5, 11, 12, 13, 40, 97)] + ["none of these", None, " ".join(["w1"] * 50)]
    block, found = _weighted(items, texts, s)
    omega = rng.standard_normal((len(block.terms), 7))
    want, gram = np.zeros_like(omega), decontam.Gram(len(block.terms))
    for f in found:
        gram.add(f, block.idf, s)
        for v in decontam._vectors(f, block.idf, s):
            v.add_transposed(v.times(omega) / v.square[:, None], want)
    assert np.abs(want).max() > 1 and np.allclose(gram.times(omega), want)


def test_only_items_whose_words_are_there_are_compared(monkeypatch):
    s = decontam.Search()
    items = ["alpha beta gamma delta epsilon zeta.", "alpha one two three four five."]
    texts = ["so alpha beta gamma delta epsilon zeta it is"]
    block, _ = _weighted(items, texts, s)
    block.idf = np.ones(len(block.terms))
    block.basis = np.ones((len(block.terms), 1), np.float32)  # every passage is near every item
    block.latent = np.ones((2, 1), np.float32)
    compared, lcs = [], decontam.lcs
    monkeypatch.setattr(decontam, "lcs", lambda item, m, text: compared.append(item) or lcs(item, m, text))
    masks, answers = [decontam.masks(w) for w in block.words], [decontam.masks(w) for w in block.answers]
    got = decontam._match(texts, block, decontam._holds(block), masks, answers, s)
    assert [[h["item_id"] for h in hits] for hits in got] == [[0]]
    assert masks[0] in compared and masks[1] not in compared
