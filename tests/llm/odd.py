"""Small tables of odd rows, and brute-force versions."""

from __future__ import annotations

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, line string, _keep long, score double, tokens string, count long"


def documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    base = "the quick brown fox jumps over the lazy dog and runs away from the old red barn near the river " * 3
    texts = [
        (1, base, "en", "src0"),
        (2, base, "en", "src0"),
        (3, base.upper(), "en", "src1"),
        (4, base + "again", "en", "src1"),
        (5, None, "en", "src0"),
        (6, "", "en", None),
        (7, " \n\t ", None, "src2"),
        (8, "two words", "fr", "src2"),
        (8, "two words", "fr", "src2"),
        (9, "12345 !!! ###", "de", "src2"),
        (None, "no id at all here", "en", "src0"),
        (None, None, None, None),
        (10, "été à la plage, où les élèves jouent. " * 40, "fr", "src3"),
        (11, "word " * 60_000, "en", "src3"),
        (12, "x" * 200_000, "en", "src3"),
        (13, "der alte Mann und das Meer, die Straße ist lang. " * 30, "de", "src4"),
    ]
    rows = [(i, t, g, s, len(t) if t else None, 1, "line", 2, 0.5, "x", 3) for i, t, g, s in texts]
    return spark.createDataFrame(rows, DOCS)


def none_of(spark):
    return spark.createDataFrame([], DOCS)


def simhash(text: str | None) -> int:
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words).replace(b"\x0b", b" ").split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """{node: smallest node reachable} by brute force over all pairs."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    order = sorted(nodes)
    for a, x in enumerate(order):
        for y in order[a + 1 :]:
            if linked(x, y):
                p, q = sorted((find(x), find(y)))
                parent[q] = p
    return {n: find(n) for n in order}
