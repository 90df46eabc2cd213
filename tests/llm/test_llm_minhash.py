"""MinHash near-duplicates against brute force over all pairs."""

import random

from corpus_cases import DOCS, edited, words

from folioflow.llm.minhash_dedup import least_matches, near_duplicates


def shingles(text, size=4):
    ws = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    ws = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", ws) if w]
    if not ws:
        return set()
    if len(ws) < size:
        return {tuple(ws)}
    return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        comp = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), comp, d is not None and d == comp))
    return sorted(out, key=str)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        base = words(rng, rng.randint(5, 300))
        rows.append((10 * i, base))
        for j in range(1, rng.randint(1, 5)):
            rows.append((10 * i + j, edited(rng, base, rng.randint(0, 6))))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "A b"), (904, "a B"), (905, "a b c")]
    rows += [(None, rows[0][1]), (None, "lonely words only here"), (906, rows[3][1]), rows[5], rows[5]]
    rows += [(907, "W " * 5000), (908, "w " * 4999)]
    df = spark.createDataFrame([(d, t, "en", "s", 0, "x", "y", "z", "q") for d, t in rows], DOCS)
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    expected = brute(rows)
    assert sum(1 for r in expected if not r[3]) > 30
    assert got == expected


def test_thresholds_of_the_steps_grow():
    least = least_matches()
    assert len(least) == 8 and all(a <= b for a, b in zip(least, least[1:])) and least[-1] < 0.8 * 128


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
