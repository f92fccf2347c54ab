"""Made-up prose for the tests."""

import random

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango uniform victor whiskey xray yankee zulu".split()


def prose(seed: int, n: int = 80) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(("", "", "", ",", ".")) for _ in range(n))
