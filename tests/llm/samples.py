"""Small texts for the tests."""

import random

WORDS = ["river", "stone", "Light", "over", "the", "quiet", "house", "winter", "seven", "garden", "paper", "blue",
         "walk", "under", "bridge", "table", "night", "song", "green", "field", "open", "door", "small", "road"]


def text(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def edited(base: str, seed: int, changes: int) -> str:
    r, words = random.Random(seed), base.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


EDGES = [(900, None), (901, ""), (902, " \t\n "), (None, "word of a row without id"), (903, "one"), (904, "ñandú é 東京 😀 ß"),
         (905, "one"), (906, "x" * 200_000), (907, "\x00 a \x1f b \x85 c"), (905, "one")]
