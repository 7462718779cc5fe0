import random


def prose(seed: int, n: int) -> str:
    """n pronounceable words that differ from text to text."""
    rng = random.Random(seed)
    syllables = ["ba", "ke", "li", "mo", "nu", "ra", "si", "to", "ve", "zu"]
    words = ["".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."
