"""What a worker holds of a language model."""

import pickle
import tracemalloc

import numpy as np

from marquee.llm import langid


def test_model_of_many_terms_is_small():
    """200,000 words and as many n-grams in four languages: arrays of hashes
    and log frequencies, no dictionaries of texts."""
    words = [f"wort{i}" for i in range(200_000)]
    keys = np.sort(langid.term_keys(words))
    assert len(np.unique(keys)) == len(words)
    sent = pickle.dumps(langid.Model(list("abcd"), keys, keys, np.zeros((400_000, 4)), 4))
    del words, keys
    tracemalloc.start()
    model = pickle.loads(sent)
    scorer = langid.Scorer.of(model)
    scorer.batch([" ".join(f"w{i}x" for i in range(20_000))])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 30 << 20
    assert isinstance(model.words, np.ndarray) and isinstance(model.grams, np.ndarray)


def test_keys_do_not_follow_the_call():
    terms = ["a", "ab", "ba", "ß", "日本", "x" * 5000, " a", "a "]
    assert len(set(langid.term_keys(terms).tolist())) == len(terms)
    assert [int(langid.term_keys([t])[0]) for t in terms] == langid.term_keys(terms).tolist()
    assert len(langid.term_keys([])) == 0
