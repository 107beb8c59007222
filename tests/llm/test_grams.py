"""Hashes of words: equal for equal words, different for words made to collide."""

import numpy as np

from tidemart.llm import grams, jaccard_join, quality_rules


def thue_morse(letters: str) -> str:
    """1,024 letters on which sums of powers modulo a power of two agree with those of the complement."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(1024))


def test_equal_spans_anywhere_and_lengths_around_eight():
    words = [b"a" * k for k in range(1, 40)] + [b"x" * 1023, b"x" * 1024, b"x" * 1025, b"x" * 5000]
    text = b" ".join(words + words)
    data = np.frombuffer(text, np.uint8)
    _, _, _, hashes = grams.words(data, np.array([0, len(data)]))
    n = len(words)
    assert hashes[:n].tolist() == hashes[n:].tolist() and len(set(hashes.tolist())) == n


def test_words_that_collide_in_a_sum_of_powers(docs):
    one, other = thue_morse("ab"), thue_morse("ba")
    rows = {r.doc_id: r for r in jaccard_join.jaccard_join(docs((1, one), (2, other))).collect()}
    assert rows[1].component_id == 1 and rows[2].component_id == 2
    words = " ".join(f"w{i}" for i in range(30))
    text = f"{words} {one} {words}\n{words} {other} {words}"
    lines = f"{one}\n{other}\n"
    found = {r.doc_id: r for r in quality_rules.judge(docs((3, text), (4, lines))).collect()}
    assert found[3].n_repeat_words == 120  # windows of w0 ... w29 only, never one over both long words
    assert found[4].n_dup_lines == 0
