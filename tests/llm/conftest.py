import random

import pytest

#: Names that operators use inside or return; as extra input columns they must not matter.
CLASHING = ("id", "blob", "bits", "size", "shard", "slot", "part", "tid", "length", "score", "spans", "component_id", "fingerprint", "raw", "quick", "rule", "path", "__rank", "n_links", "label2")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


def documents(seed=1, n=60):
    """Rows with null ids and texts, empty and long texts, copies, near copies, repeated rows and equal ids."""
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.choice([0, 1, 3, 20, 80, 200]))) for k in range(n)]
    rows += [(n + k, rows[k * 3][1]) for k in range(8)]
    rows += [(n + 20 + k, rows[k * 5][1] + " tail") for k in range(8)]
    rows += [(None, rows[4][1]), (None, None), (n + 40, None), (n + 41, ""), (n + 42, " \n\t "), (3, "another text under id three"), rows[7], rows[7]]
    rows += [(n + 50, "long " * 30_000), (n + 51, "ünï " * 2_000 + "x" * 5_000), (n + 52, "a" * 120)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents with clashing extra columns."""

    def make(rows, key="doc_id"):
        df = spark.createDataFrame(rows, f"{key} long, text string").repartition(3)
        return df.selectExpr("*", *[f"'x' as `{name}`" for name in CLASHING])

    return make


def groups(n, links):
    """Least member of each one's component, by brute force."""
    parent = list(range(n))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def same(left, right):
    """Equal rows, whatever their order and nulls."""
    key = lambda row: tuple((v is None, "" if v is None else str(v)) for v in row)
    left, right = sorted(map(tuple, left), key=key), sorted(map(tuple, right), key=key)
    assert left == right, next((a, b) for a, b in zip(left + [None], right + [None]) if a != b)
