"""Texts that share every linear hash modulo a power of two."""


def complements(size: int) -> tuple[str, str]:
    """Two runs of ``size`` (a power of two) letters a and b: the doubling sequence and its complement."""
    t = [0]
    while len(t) < size:
        t += [1 - x for x in t]
    return "".join("ab"[x] for x in t), "".join("ba"[x] for x in t)
