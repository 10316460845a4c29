"""Random words for the tests of this folder."""


def sentence(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
