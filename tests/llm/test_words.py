"""Hash helpers: equal words hash alike wherever they stand, cuts never change a hash."""
import numpy as np

from edustar.llm import words
from edustar.llm.text_stats import text_stats


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    texts = ["a b c", None, "", "x a  b\tc\n", "Ünï c"]
    h, first = words.word_hashes(texts)
    assert first.tolist() == [0, 3, 3, 3, 7, 9]
    assert h[:3].tolist() == h[4:7].tolist() and h[8] == h[2]
    long = ["word%d " % (i % 50) * 3 for i in range(200)] + ["z" * 5000]
    whole = words.word_hashes(long)
    monkeypatch.setattr(words, "BLOCK", 64)
    cut = words.word_hashes(long)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_shingles_match_brute_force():
    texts = ["a b c d e f g", "a b", "", "b c d e f"]
    w, first = words.word_hashes(texts)
    s, at = words.shingle_hashes(w, first, 5)
    assert np.diff(at).tolist() == [3, 1, 0, 1]
    assert s[1] == s[4]  # "b c d e f" in both texts
    assert len(set(s.tolist())) == 4


def test_text_stats():
    got, _, _ = text_stats(["THE!! CAT!!", "a a a a", "x | y\nx | y", "", None, "The cat sat, and the dog."])
    assert got["n_words"].tolist() == [2, 4, 6, 0, 0, 6]
    assert got["repeated"][1] == 0.75 and got["upper"][0] == 1.0 and got["same_lines"][2] == 0.5
    assert got["plain"][5] == 1.0 and got["plain"][0] == 0.0 and got["function"][5] == 0.5
