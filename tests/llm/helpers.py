SENTENCE = "the quick brown fox jumps over a lazy dog while rain falls on green hills and rivers run down to the sea"


def words(n: int, seed: int = 0) -> str:
    """n words that no other seed has."""
    return " ".join(f"w{seed}x{i}" for i in range(n))
