import random
import re

SMALL = "/root/testdata/sf0.001"
WORDS = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you".split()
_WORD = re.compile(r"[^\x20\x09-\x0d]+")


def words(t):
    return _WORD.findall(t)


def prose(seed, n):
    """Random words in mixed endings."""
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) for _ in range(n))
