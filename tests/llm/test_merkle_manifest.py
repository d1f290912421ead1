import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from fundglean.llm import merkle_manifest as mm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, place int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    said = [row[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in said])


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return found


def plain(rows):
    """Rows of the query by building every tree whole."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        by_source[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = levels_of([leaf(r) for r in by_source[name]])
    top = levels_of([trees[n][-1][0] for n in names])
    out = []
    for t, name in enumerate(names):
        for i, row in enumerate(by_source[name]):
            seen = dict(row)
            said = "" if row["doc_id"] is None else str(row["doc_id"])
            if zlib.crc32(said.encode()) % 2 == 0 and row["text"] is not None:
                seen["text"] = row["text"].replace("\n", "")
            node, siblings = leaf(seen), []
            for tree, at in ((trees[name], i), (top, t)):
                for level in tree[:-1]:
                    first = at // 3 * 3
                    run = level[first : first + 3]
                    siblings += run[: at - first] + run[at - first + 1 :]
                    node = sha(*run[: at - first], node, *run[at - first + 1 :])
                    at //= 3
            root = top[-1][0]
            out.append((row["doc_id"], leaf(row), trees[name][-1][0], root, sha(*siblings), node, node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows(n, sources, seed=1):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        text = rng.choice([None, "", "a\nb", "é\n\nü", "x" * 50, "one line"])
        source = rng.choice(sources)
        made.append({"doc_id": i, "text": text, "lang": rng.choice([None, "en"]), "source": source,
                     "n_chars": None if text is None else len(text), "leaf": "x", "place": 7})
    return made


@pytest.mark.parametrize("n, levels", [(1, 2), (2, 1), (9, 2), (10, 2), (28, 1), (400, 1), (400, 2), (400, 7)])
def test_against_whole_trees(spark, n, levels):
    given = rows(n, [None, "", "a", "b", "é", "hot", "hot", "hot"])
    if n > 20:
        given += [dict(given[3]), dict(given[3]), given[5] | {"text": "y\n" * 9_000}, given[6] | {"doc_id": None}]
    docs = spark.createDataFrame([tuple(r.values()) for r in given], SCHEMA).repartition(3)
    tree = mm.manifest(docs, mm.without_newlines(), levels)
    got = [tuple(r) for r in mm.proofs(tree).select(*COLUMNS).collect()]
    assert Counter(got) == Counter(plain(given))


def test_chosen_leaves(spark):
    given = rows(300, ["a", "b", "hot", "hot"])
    docs = spark.createDataFrame([tuple(r.values()) for r in given], SCHEMA)
    tree = mm.manifest(docs, mm.without_newlines(), 2)
    chosen = spark.createDataFrame([(3,), (4,), (77,), (299,), (9999,)], "doc_id long")
    got = [tuple(r) for r in mm.proofs(tree, chosen).select(*COLUMNS).collect()]
    assert sorted(got) == sorted(r for r in plain(given) if r[0] in (3, 4, 77, 299))


def test_what_a_partition_fetches_is_the_smallest_set():
    rng = random.Random(5)
    for size in (1, 2, 3, 4, 26, 27, 28, 100):
        at = np.array(sorted(rng.sample(range(size), rng.randint(1, size))))
        known, n, level, found = set(at.tolist()), size, 0, dict(mm.missing(at, size))
        while n > 1:
            needed = {m for k in known for m in range(k // 3 * 3, min(n, k // 3 * 3 + 3))}
            assert set(found.pop(level).tolist()) == needed - known
            known, n, level = {k // 3 for k in known}, -(-n // 3), level + 1
        assert not found


def test_one_character_changes_the_root(spark):
    given = rows(50, ["a", "b"])
    other = [dict(r) for r in given]
    other[7]["lang"] = "fr"
    roots = []
    for some in (given, other):
        docs = spark.createDataFrame([tuple(r.values()) for r in some], SCHEMA)
        roots.append({r["root"] for r in mm.proofs(mm.manifest(docs)).collect()})
    assert len(roots[0]) == len(roots[1]) == 1 and roots[0] != roots[1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    got = mm.proofs(mm.manifest(docs))
    assert set(COLUMNS) <= set(got.columns) and got.collect() == []
